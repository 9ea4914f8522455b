"""Periodic runs against a brute-force search over all periods."""

import hashlib
import random
import zlib

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from shelfmatch.llm import registered
from shelfmatch.llm.periodic_runs import collapse, digest, find_runs, periodic_runs, repeat_tail, split_words


def brute_runs(words):
    """Every period tried on its own; a stretch counts for its smallest period only."""
    n, runs = len(words), {}
    for q in range(1, n // 3 + 1):
        i = q
        while i < n:
            if words[i] != words[i - q]:
                i += 1
                continue
            e = i
            while e < n and words[e] == words[e - q]:
                e += 1
            start, length = i - q, e - i + q
            if length >= max(24, 3 * q):
                runs.setdefault((start, length), q)
            i = e
    return sorted(((s, n, q) for (s, n), q in runs.items()), key=lambda r: (r[0], r[2]))


def brute_collapse(words, runs):
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    return b" ".join(w for i, w in enumerate(words) if i not in gone)


def brute_row(doc_id, words):
    runs = brute_runs(words)
    best = None
    for s, n, q in runs:
        if best is None or n * best[2] > best[1] * q:
            best = (s, n, q)
    sha = lambda b: hashlib.sha256(b).hexdigest()
    text = "".join(f"{s},{n},{q}\n" for s, n, q in runs).encode()
    greatest = (*best, 1000 * best[1] // best[2]) if best else (None,) * 4
    return (doc_id, len(runs), *greatest, sha(text), sha(brute_collapse(words, runs)))


def pieces(rng, size):
    """Words with repeats in them: loops, loops of loops, and noise."""
    out = []
    while len(out) < size:
        kind = rng.randrange(4)
        if kind == 0:
            out += [rng.choice("abcdefghij") for _ in range(rng.randrange(1, 30))]
        else:
            unit = [rng.choice("ab" if kind == 1 else "abcdefgh") for _ in range(rng.randrange(1, 60 if kind == 3 else 9))]
            copies = unit * rng.randrange(2, 12)
            out += copies[: len(copies) - rng.randrange(len(unit))]
    return [w.encode() for w in out]


@pytest.mark.parametrize("seed", range(40))
def test_runs_equal_brute_force(seed):
    rng = random.Random(seed)
    documents = [pieces(rng, rng.choice([0, 5, 30, 200, 700])) if rng.random() < 0.9 else [] for _ in range(8)]
    assert find_runs(documents) == [brute_runs(w) for w in documents]
    for words, runs in zip(documents, find_runs(documents)):
        assert collapse(words, runs) == brute_collapse(words, runs)


@given(st.lists(st.lists(st.sampled_from([b"a", b"b"]), max_size=90), max_size=4))
@settings(max_examples=300, deadline=None)
def test_two_letter_texts(documents):
    assert find_runs(documents) == [brute_runs(w) for w in documents]


def test_a_very_long_document_of_one_word_is_linear():
    assert find_runs([[b"w"] * 2_000_000]) == [[(0, 2_000_000, 1)]]


def test_long_periods():
    rng = random.Random(5)
    unit = [str(rng.randrange(10**6)).encode() for _ in range(5000)]
    assert find_runs([[b"x", *unit * 3, b"y"], unit * 2]) == [[(1, 15000, 5000)], []]


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(11)
    texts = {i: " \n".join(w.decode() for w in pieces(rng, rng.choice([10, 60, 300]))) for i in range(1, 60)}
    texts[60] = None
    texts[61] = " \t\n "
    texts[62] = ""
    return [(i, t, "x", i, None) for i, t in texts.items()] + [(7, texts[7], "y", 0, None), (None, "u v " * 40, "z", 0, None), (None, None, None, None, None)]


def test_query_equals_brute_force(spark, rows):
    docs = spark.createDataFrame(rows, "doc_id long, text string, runs string, n_words int, _best string")
    got = digest(periodic_runs(docs, repeat_tail)).drop("n_words").collect()
    assert sorted(map(tuple, got), key=str) == sorted((brute_row(i, repeat_tail(i, t or "")) for i, t, *_ in rows), key=str)


def test_tails_follow_the_formula():
    for doc_id in range(300):
        words = [str(k) for k in range(doc_id % 37)]
        h = zlib.crc32(str(doc_id).encode())
        g, n = h // 10, len(words)
        want = list(words)
        if h % 10 == 0 and n:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            want = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
        assert [w.decode() for w in repeat_tail(doc_id, " ".join(words))] == want
    assert split_words(0, "a\x0bb\x0cc d\x1ce  ") == [b"a", b"b", "c d\x1ce".encode()]


def test_empty_table(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    assert digest(periodic_runs(none)).count() == 0


def test_registered_query_reads_all_documents(spark):
    sf = "/root/testdata/sf0.001"
    docs = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    got = registered.SPARK["op11_periodic_runs"](spark, sf).drop("n_words").collect()
    assert len(got) == len(docs)
    short = {i for i, t in docs.items() if len(t or "") < 4000}
    assert {tuple(r) for r in got if r["doc_id"] in short} == {brute_row(i, repeat_tail(i, docs[i] or "")) for i in short}
