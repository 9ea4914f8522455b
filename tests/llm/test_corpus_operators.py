"""Operators that compare documents with each other: against brute force over small tables, and the pipeline."""

import hashlib
import random
from collections import Counter

import numpy as np
import pytest
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st

import corpus_pipeline
from shelfmatch.llm import decontaminate, line_dedup, simhash, suffix_dedup
from shelfmatch.llm.common import links_to_roots
from shelfmatch.llm.suffix_arrays import common_prefixes, suffix_array

SCHEMA = "doc_id long, text string, source string, id string, mark string"


def rows_of(docs, *columns):
    return sorted((tuple(r[c] for c in columns) for r in docs.collect()), key=str)


@pytest.fixture(scope="module")
def corpus():
    """Texts with exact and near copies, shared passages, odd values and repeated rows."""
    rng = random.Random(11)
    word = lambda: "".join(rng.choice(("ba", "ko", "ri", "tu", "ne", "lo")) for _ in range(rng.randint(1, 4)))
    line = lambda n: " ".join(word() for _ in range(n))
    texts = ["\n".join(line(rng.randint(8, 30)) for _ in range(rng.randint(2, 6))) for _ in range(60)]
    shared = line(60)
    rows = list(enumerate(texts))
    rows += [(100 + i, texts[0]) for i in range(4)]
    rows += [(200 + i, texts[1].replace(texts[1].split()[3 + i], "changed", 1)) for i in range(6)]
    rows += [(300 + i, f"{line(20)}\n{shared}\n{line(15)}") for i in range(5)]
    rows += [(400, None), (401, ""), (402, " \n\t"), (None, texts[2]), (None, None), (403, "a" * 900), (404, "é" * 250), (405, texts[5]), (405, texts[5])]
    rows += [(500, texts[7][10:209]), (501, texts[7][10:210])]
    return [(i, t, "s", "x", None) for i, t in rows]


@pytest.fixture(scope="module")
def docs(spark, corpus):
    return spark.createDataFrame(corpus, SCHEMA)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


@given(st.lists(st.integers(1, 4), max_size=60) | st.lists(st.integers(1, 250), max_size=200) | st.lists(st.sampled_from([1, 2]), min_size=1, max_size=20).map(lambda x: x * 9))
@settings(max_examples=200, deadline=None)
def test_suffix_array(values):
    t = [*values, 0]
    order = sorted(range(len(t)), key=lambda i: t[i:])
    sa = suffix_array(np.array(t))
    assert sa.tolist() == order
    shared = common_prefixes(np.array(t), sa)
    for a, b in zip(order, order[1:]):
        n = 0
        while t[a + n] == t[b + n]:
            n += 1
        assert shared[b] == n


def brute_repeats(texts, length=200):
    seen = Counter(t[i : i + length] for t in texts for i in range(len(t) - length + 1))
    for t in texts:
        gone = np.zeros(len(t) + 1, bool)
        for i in range(len(t) - length + 1):
            if seen[t[i : i + length]] > 1:
                gone[i : i + length] = True
        kept = bytes(b for b, g in zip(t, gone) if not g)
        yield len(t), int(gone.sum()), int((np.diff(gone.astype(int), prepend=0) == 1).sum()), hashlib.sha256(kept).hexdigest()


@pytest.mark.parametrize("crowded", [4096, 0])
def test_suffix_dedup(docs, none, corpus, monkeypatch, crowded):
    monkeypatch.setattr(suffix_dedup, "CROWDED", crowded)
    found = rows_of(suffix_dedup.digest(suffix_dedup.remove_repeated(docs)), "doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")
    wanted = [(i, *x) for (i, *_), x in zip(corpus, brute_repeats([(t or "").encode() for _, t, *_ in corpus]))]
    assert found == sorted(wanted, key=str)
    assert suffix_dedup.remove_repeated(none).count() == 0


def test_anchors_of_a_long_text_do_not_depend_on_the_cut(monkeypatch):
    rng = random.Random(4)
    text = bytes(rng.randrange(97, 101) for _ in range(5000))
    covered = lambda found: [int(h) for h, n in zip(found[0], found[2]) for _ in range(n)]
    whole = covered(suffix_dedup.text_anchors([text])[0])
    monkeypatch.setattr(suffix_dedup, "AT_ONCE", 700)
    assert covered(suffix_dedup.text_anchors([text])[0]) == whole and len(whole) == 4801


def brute_lines(corpus):
    order = sorted({(-1 if i is None else i, t or "") for i, t, *_ in corpus}, key=lambda x: x[0])
    lines = [(i, t, n, w) for i, t in order for n, x in enumerate(t.split("\n")) if len(w := line_dedup.line_words(x.encode())) >= 5]
    gone: dict = {}
    for k, (i, t, n, w) in enumerate(lines):
        if any(9 * len(w & v) >= 4 * (len(w) + len(v)) for *_, v in lines[:k]):
            gone.setdefault((i, t), set()).add(n)
    return gone


@pytest.mark.parametrize("chunk", [2048, 3])
def test_line_dedup(docs, none, corpus, monkeypatch, chunk):
    monkeypatch.setattr(line_dedup, "CHUNK", chunk)
    gone = brute_lines(corpus)
    wanted = []
    for i, t, *_ in corpus:
        mine = gone.get((-1 if i is None else i, t or ""), ())
        lines = (t or "").split("\n")
        wanted.append((i, len(lines), len(mine), "\n".join(x for n, x in enumerate(lines) if n not in mine)))
    assert rows_of(line_dedup.line_dedup(docs), "doc_id", "n_lines", "n_removed", "kept") == sorted(wanted, key=str)
    assert line_dedup.line_dedup(none).count() == 0 and line_dedup.keep_new_lines(none).columns == none.columns


def test_lines_of_many_variants(spark):
    """A group of variants: each line but the first goes, though most are asked for more than one partner."""
    rng = random.Random(2)
    words = [f"w{i}" for i in range(40)]
    rows = [(i, " ".join([*rng.sample(words, 30), f"v{i}", "end"])) for i in range(150)]
    gone = brute_lines([(i, t) for i, t in rows])
    found = {r["doc_id"] for r in line_dedup.line_dedup(spark.createDataFrame(rows, "doc_id long, text string")).where("n_removed > 0").collect()}
    assert found == {i for i, _ in gone}


def test_lines_beside_columns_of_any_name(spark):
    line = "one line of seven quite different words"
    rows = [(1, line, 5, "a"), (2, f"{line}\nand another line that has enough words", 6, "b"), (3, f"{line} {line}", 7, "c")]
    kept = line_dedup.keep_new_lines(spark.createDataFrame(rows, "doc_id long, text string, _ int, gone string"))
    assert sorted(map(tuple, kept.collect())) == [(1, line, 5, "a"), (2, "and another line that has enough words", 6, "b")]


@pytest.mark.parametrize("chunk", [2, 64])
def test_crowded_words_and_open_sets(spark, monkeypatch, chunk):
    """Lines that share all their rare words and mostly just fail, so that every step of the join has work."""
    monkeypatch.setattr(line_dedup, "CHUNK", chunk)
    monkeypatch.setattr(line_dedup, "WIDER", 1)
    monkeypatch.setattr(line_dedup, "PARTNERS", 1)
    rng = random.Random(6)
    words = [f"w{i}" for i in range(26)]
    rows = [(i, " ".join(rng.sample(words, rng.randint(19, 22)))) for i in range(90)]
    gone = brute_lines(rows)
    assert 0 < len(gone) < len(rows)
    found = {r["doc_id"] for r in line_dedup.line_dedup(spark.createDataFrame(rows, "doc_id long, text string")).where("n_removed > 0").collect()}
    assert found == {i for i, _ in gone}


def brute_print(text):
    words = (text or "").encode().lower().split()
    shingles = [b" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << k for k in range(64) if 2 * sum(h >> k & 1 for h in hashes) > len(hashes))


def components(prints):
    label = list(range(len(prints)))
    for _ in prints:
        new = [min(label[j] for j in range(len(prints)) if (prints[i] ^ prints[j]).bit_count() <= 3) for i in range(len(prints))]
        if new == label:
            break
        label = new
    return label


def test_simhash(docs, none, corpus):
    prints = [brute_print(t) for _, t, *_ in corpus]
    label = components(prints)
    least = {x: min((i for (i, *_), y in zip(corpus, label) if y == x and i is not None), default=None) for x in set(label)}
    wanted = sorted(((i, f"{p:016x}", least[x]) for (i, *_), p, x in zip(corpus, prints, label)), key=str)
    found = simhash.simhash(docs).select("doc_id", simhash.hex_print("print").alias("fingerprint"), "component_id")
    assert rows_of(found, "doc_id", "fingerprint", "component_id") == wanted
    assert simhash.simhash(none).count() == 0
    kept = simhash.keep_one_each(docs)
    assert kept.columns == docs.columns
    assert sorted(r["doc_id"] for r in kept.where("doc_id is not null").collect()) == sorted({x for x in least.values() if x is not None})


def test_one_of_each_component_whatever_the_ids(spark):
    t, u, v, w = ("here is a text of several words", "some entirely other text with more words", "a third one unlike them both", "the last of four")
    rows = [(2, t, 1), (2, u, 2), (5, u, 3), (7, t, 4), (None, t, 5), (None, v, 6), (None, v, 6), (8, w, 7), (8, w, 7), (None, w, 8)]
    kept = simhash.keep_one_each(spark.createDataFrame(rows, "doc_id long, text string, id_key int"))
    assert sorted(map(tuple, kept.collect()), key=str) == sorted([(2, t, 1), (2, u, 2), (None, v, 6), (8, w, 7)], key=str)


@pytest.mark.parametrize("chunk", [1024, 4])
def test_links_between_fingerprints(spark, monkeypatch, chunk):
    monkeypatch.setattr(simhash, "CHUNK", chunk)
    rng = random.Random(8)
    prints = [rng.getrandbits(64) for _ in range(40)]
    for p in prints[:12]:
        q = p
        for _ in range(6):  # chains that only links in between hold together
            for k in rng.sample(range(64), rng.randint(1, 4)):
                q ^= 1 << k
            prints.append(q)
    prints = sorted(set(prints))
    frame = spark.createDataFrame([(p - (1 << 64) if p >> 63 else p,) for p in prints], "print long")
    roots = {r["node"] & (1 << 64) - 1: r["root"] for r in links_to_roots(simhash.near_links(frame)).collect()}
    label = components(prints)
    same = lambda names: {frozenset(p for p, x in zip(prints, names) if x == y) for y in names}
    assert same([roots.get(p, p - (1 << 64) if p >> 63 else p) for p in prints]) == same(label)


def test_components_of_a_long_chain(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(200)] + [(500, 501), (501, 500), (7, 7)], "a long, b long")
    roots = {r["node"]: r["root"] for r in links_to_roots(links).collect()}
    assert roots == {**{i: 0 for i in range(201)}, 500: 500, 501: 500}


def edit_distance(item, text):
    row = [0] * (len(text) + 1)
    for i, c in enumerate(item, 1):
        last, row = row, [i] + [0] * len(text)
        for j, d in enumerate(text, 1):
            row[j] = min(last[j] + 1, row[j - 1] + 1, last[j - 1] + (c != d))
    return min(row)


def test_decontamination(spark, docs, none, corpus):
    rng = random.Random(6)
    item = "the quick  brown fox jumps over the lazy dog and runs away from the old farm house at night\nwhile it rains"
    other = " ".join("".join(rng.choice("abcdefgh") for _ in range(6)) for _ in range(20))
    items = [(1, item), (2, other), (3, None), (4, ""), (5, item), (6, "tiny")]
    benchmark = spark.createDataFrame(items, "item_id int, text string")
    plain = decontaminate.plain(item)
    texts = [(i, t) for i, t, *_ in corpus]
    for n in range(14):  # so many edits, in the middle of other words
        t = list(plain)
        for at in rng.sample(range(len(t)), n):
            t[at] = rng.choice(["", "x", t[at] + "q"])
        texts.append((1000 + n, "Before it. " + "".join(t).upper() + " after"))
    texts += [(2000, "tiny"), (2001, other[: len(other) // 2])]
    found = {}
    for r in decontaminate.contamination(spark.createDataFrame(texts, "doc_id long, text string"), benchmark).collect():
        found.setdefault(r["doc_id"], (r["n_items"], r["item_ids"], r["least_distance"]))
    for i, t in texts:
        if i is not None:
            d = {k: edit_distance(p, decontaminate.plain(t or "")) for k, x in items if (p := decontaminate.plain(x or ""))}
            within = sorted(k for k in d if d[k] <= len(decontaminate.plain(dict(items)[k])) // 15)
            assert found[i] == (len(within), within, min((d[k] for k in within), default=None))
    empty = spark.createDataFrame([], "item_id int, text string")
    assert decontaminate.contamination(docs, empty).where("n_items > 0").count() == 0
    assert decontaminate.contamination(none, benchmark).count() == 0
    kept = decontaminate.keep_clean(docs, benchmark)
    assert kept.columns == docs.columns and kept.count() == len(corpus)


def test_blocks_of_a_benchmark_are_one(spark, monkeypatch):
    """The same rows, one for each document, however many blocks the benchmark is cut into."""
    rng = random.Random(9)
    items = [(k, "".join(rng.choice("abcdefgh ") for _ in range(60))) for k in range(12)] + [(12, None)]
    texts = [(i, f"before {items[i % 12][1]} between {items[5 * i % 12][1]} after") for i in range(20)]
    texts += [(3, texts[3][1]), (None, texts[4][1]), (100, "nothing here"), (101, None)]
    docs, benchmark = spark.createDataFrame(texts, "doc_id long, text string"), spark.createDataFrame(items, "item_id int, text string")
    columns = "doc_id", "n_items", "least_distance", "item_ids"
    whole = rows_of(decontaminate.contamination(docs, benchmark), *columns)
    monkeypatch.setattr(decontaminate, "BLOCK_CHARS", 200)
    assert len([b for b in decontaminate.blocks(benchmark) if b.items]) > 1
    assert rows_of(decontaminate.contamination(docs, benchmark), *columns) == whole
    assert len(whole) == len(texts) and any(r[1] > 1 for r in whole)
    assert sorted(r["doc_id"] for r in decontaminate.keep_clean(docs, benchmark).collect()) == [100, 101]


def test_pipeline_keeps_clean_documents_and_drops_planted_ones(spark, tmp_path):
    rng = random.Random(21)
    word = lambda: "".join(rng.choice(("ba", "ko", "ri", "tu", "ne", "lo", "sam", "wip")) for _ in range(rng.randint(2, 5)))
    text = lambda n: "\n".join(" ".join(word() for _ in range(20)) for _ in range(n))
    clean = [(i, text(6)) for i in range(40)]
    item = " ".join(word() for _ in range(25))
    copies = [(100 + i, clean[0][1]) for i in range(3)]
    near = [(200, clean[1][1].replace(clean[1][1].split()[5], "other", 1))]
    leaked = [(300, f"{text(3)}\n{item}\n{text(2)}")]
    poor = [(400, "too short"), (401, "spam spam spam " * 40), (402, None)]
    rows = [(i, t, "en", f"src{i % 3}", len(t or "")) for i, t in [*clean, *copies, *near, *leaked, *poor]]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(0, item)], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    docs = spark.read.parquet(str(tmp_path / "documents.parquet"))
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, str(tmp_path))
        assert out.columns == docs.columns
        out.write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
    assert {r["doc_id"]: r["text"] for r in docs.collect()} == dict(clean)
    packed = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert {r["doc_id"] for r in packed} == {i for i, _ in clean}
    stages = [(spark, docs.limit(0), str(tmp_path))]
    for _, stage in corpus_pipeline.STAGES:
        assert stage(*stages[0]).count() == 0
