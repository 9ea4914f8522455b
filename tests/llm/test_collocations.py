"""Phrase collocations against counting every phrase; tries against sets of sequences."""

import random
import re
from collections import Counter

import numpy as np
import pytest

from shelfmatch.llm import collocations as C
from shelfmatch.llm import registered
from shelfmatch.llm.tries import build, digit_count


def brute(rows, top=2000):
    words_of, counts = Counter(), {}
    for lang, text in rows:
        lang = "und" if lang is None else lang
        lowered = re.sub("[A-Z]", lambda m: m.group().lower(), text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", lowered):
            words = re.findall(r"[^\x20\x09]+", piece)
            words_of[lang] += len(words)
            for size in (1, 2, 3):
                for i in range(len(words) - size + 1):
                    counts.setdefault(lang, Counter())[" ".join(words[i : i + size])] += 1
    out = []
    for lang, f in counts.items():
        found = {p: a for p, a in f.items() if a >= 10 and " " in p}
        ranked = []
        for phrase, a in found.items():
            w = phrase.split(" ")
            if any(100 * b >= 50 * a and f" {phrase} " in f" {longer} " for longer, b in found.items() if longer != phrase and len(longer.split(" ")) > len(w)):
                continue
            cuts = []
            for k in range(1, len(w)):
                left, right = f[" ".join(w[:k])], f[" ".join(w[k:])]
                cuts.append((1000000 * a * a // (left * right), k, left, right))
            score, _, left, right = min(cuts)
            ranked.append((-score, -a, phrase.encode(), left, right))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(ranked)[:top], 1):
            out.append((lang, rank, phrase.decode(), -a, left, right, words_of[lang], -score))
    return sorted(out)


def some_texts(seed, n):
    rng = random.Random(seed)
    names = ["New York", "new York city", "Ärger im Büro", "it's so", "machine learning model", "中 文", "a a", "x"]
    out = []
    for _ in range(n):
        parts = []
        for _ in range(rng.randrange(0, 60)):
            parts.append(rng.choice(names) if rng.random() < 0.5 else "w" + str(int(rng.paretovariate(1))))
            parts.append(rng.choice([" ", " ", " ", "  ", "\t", ". ", ",", "\n", " !? ", "\x0b", "\r\n"]))
        out.append((rng.choice(["en", "en", "de", None, "und", ""]), "".join(parts)))
    return out + [("en", None), (None, None), ("fr", ""), ("fr", " ., "), ("en", "a " * 5000), ("es", "rare words only")]


@pytest.fixture(scope="module")
def rows():
    return some_texts(1, 900)


def as_docs(spark, rows):
    return spark.createDataFrame([(k, t, lang, "x", 1) for k, (lang, t) in enumerate(rows)], "doc_id long, text string, lang string, phrase string, n int")


def collected(df):
    return sorted(map(tuple, df.select("lang", "rank", "phrase", "a", "l", "r", "n", "score").collect()))


def test_equals_brute_force(spark, rows):
    want = brute(rows)
    assert len({r[0] for r in want}) >= 4 and len(want) > 100
    assert collected(C.collocations(as_docs(spark, rows))) == want


def test_blocks_chunks_and_crowded_maps_change_nothing(spark, rows, monkeypatch):
    monkeypatch.setattr(C, "BLOCK", 60)
    monkeypatch.setattr(C, "BITS", 18)
    monkeypatch.setattr(C, "TOGETHER", 500)
    assert collected(C.collocations(as_docs(spark, rows[:300]))) == brute(rows[:300])


def test_more_candidates_are_counted_until_none_could_be_listed(spark, rows, monkeypatch):
    monkeypatch.setattr(C, "AHEAD", 1)
    tries = []
    whole = C.count_phrases
    monkeypatch.setattr(C, "count_phrases", lambda docs, phrases: tries.append(1) or whole(docs, phrases))
    assert collected(C.collocations(as_docs(spark, rows), top=3)) == brute(rows, top=3)
    assert len(tries) > 1


def test_words_that_share_a_hash_start_the_search_again(spark, rows, monkeypatch):
    whole = C.word_hashes

    def crowded(words, seed):
        hashes = whole(words, seed)
        return hashes % np.uint64(50) if seed == 0 else hashes

    monkeypatch.setattr(C, "word_hashes", crowded)
    assert collected(C.collocations(as_docs(spark, rows[:300]), top=50)) == brute(rows[:300], top=50)


def test_first_of_each_language(spark, rows):
    assert collected(C.collocations(as_docs(spark, rows), top=5)) == brute(rows, top=5)


def test_ties_overlaps_and_dropped_phrases(spark):
    rows = [("en", "b c. a b c, " * 10 + "d e; " * 10), ("en", "z z z z z z z z z z z z z z"), ("de", "p q. " * 9)]
    assert collected(C.collocations(as_docs(spark, rows))) == brute(rows)


def test_products_beyond_64_bits(spark):
    big = 3_000_000_000
    frequent = spark.createDataFrame(
        [("en", 1, "a", big + 7), ("en", 1, "b", big + 11), ("en", 2, "a b", big)], "lang string, size int, phrase string, a long"
    )
    assert [r["score"] for r in C.scored(frequent).collect()] == [1000000 * big * big // ((big + 7) * (big + 11))]


def test_tables_without_phrases(spark):
    assert C.collocations(as_docs(spark, [("en", "one two"), (None, None)])).count() == 0
    assert C.collocations(as_docs(spark, rows=[("en", "x")]).where("doc_id < 0")).count() == 0


@pytest.mark.parametrize("numbers", [3, 300, 100_000])
def test_tries_hold_just_their_sequences(numbers):
    rng = np.random.default_rng(numbers)
    rows = (rng.zipf(1.4, (5000, 4)) - 1) % numbers
    rows[np.arange(4) >= rng.integers(1, 5, 5000)[:, None]] = -1
    rows = np.unique(rows, axis=0)
    trie, states = build(rows, numbers)
    assert trie.width == digit_count(numbers)
    known = {tuple(r[r >= 0].tolist()): s for r, s in zip(rows, states.tolist())}
    prefixes = {p[:k] for p in known for k in range(1, 5)}
    assert len(set(known.values())) == len(known)
    tries = (rng.zipf(1.4, (20000, 4)) - 1) % numbers
    at = np.zeros(len(tries), np.int32)
    for k in range(4):
        at = trie.step(at, tries[:, k])
        for row, state in zip(tries[:, : k + 1].tolist(), at.tolist()):
            assert (state >= 0) == (tuple(row) in prefixes)
            if tuple(row) in known:
                assert known[tuple(row)] == state


def test_registered_query_reads_all_documents(spark):
    sf = "/root/testdata/sf0.001"
    rows = [(r["lang"], r["text"]) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    assert collected(registered.SPARK["op12_collocations"](spark, sf)) == brute(rows)
