"""Near-duplicates by chosen paths against a comparison of all pairs."""

import random

import numpy as np
import pytest

from shelfmatch.llm import minhash, registered
from shelfmatch.llm.minhash import children, linked, near_duplicates, shingle_sets


def brute_set(text):
    words = (text or "").encode().lower().split()
    return {tuple(words[k : k + 5]) for k in range(max(1, len(words) - 4))} if words else set()


def brute(rows):
    """doc_id, n_shingles, component_id, kept by comparing all pairs of rows that share a shingle."""
    sets = [brute_set(t) for _, t in rows]
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    holders = {}
    for k, s in enumerate(sets):
        for shingle in s:
            holders.setdefault(shingle, []).append(k)
    seen = set()
    for group in holders.values():
        for x, a in enumerate(group):
            for b in group[x + 1 :]:
                if (a, b) not in seen:
                    seen.add((a, b))
                    common = len(sets[a] & sets[b])
                    if 100 * common >= 85 * (len(sets[a]) + len(sets[b]) - common):
                        parent[find(b)] = find(a)
    least = {}
    for k, (i, _) in enumerate(rows):
        if i is not None:
            least[find(k)] = min(least.get(find(k), i), i)
    return sorted([(i, len(sets[k]), least.get(find(k)), i == least.get(find(k))) for k, (i, _) in enumerate(rows)], key=str)


def near_copies(rng, bases, copies, words, changes):
    out = []
    for _ in range(bases):
        base = [rng.choice("abcdefghijklmnop") + str(rng.randrange(400)) for _ in range(words)]
        out.append(base)
        for _ in range(copies):
            copy = list(base)
            for _ in range(rng.randrange(changes + 1)):
                copy[rng.randrange(words)] = "x" + str(rng.randrange(10**6))
            out.append(copy)
    return [" ".join(w) for w in out]


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(3)
    texts = near_copies(rng, 40, 6, 150, 6) + near_copies(rng, 200, 1, 60, 1) + near_copies(rng, 1, 300, 200, 5) + near_copies(rng, 30, 2, 30, 1)
    texts += ["a b c", "A  b\tC", "a b c d", "", None, None, " \n", "one", "One", *texts[:30], "long " * 30000, "long " * 29000, texts[0] + " " + "w " * 5]
    rng.shuffle(texts)
    rows = list(enumerate(texts, 1))
    return rows + [(None, texts[5]), (None, "no id at all here anyway"), (7, texts[6]), (7, texts[300]), (-3, texts[9])]


def collected(df):
    return sorted(map(tuple, df.select("doc_id", "n_shingles", "component_id", "kept").collect()), key=str)


def as_docs(spark, rows):
    return spark.createDataFrame([(i, t, "x", None, 1) for i, t in rows], "doc_id long, text string, key string, path string, n int")


def wanted(rows):
    """Brute force, but for rows without id and without a partner that has one: their component is null and they are kept."""
    return sorted(((i, n, c, True if i is None and c is None else k) for i, n, c, k in brute(rows)), key=str)


def test_equals_brute_force(spark, rows):
    assert collected(near_duplicates(as_docs(spark, rows))) == wanted(rows)


@pytest.mark.parametrize(("small", "depth"), [(4, 3), (16, 2), (8, 1)])
def test_large_nodes_branch_and_are_then_split_into_chunks(spark, rows, monkeypatch, small, depth):
    monkeypatch.setattr(minhash, "SMALL", small)
    monkeypatch.setattr(minhash, "DEPTH", depth)
    got, want = collected(near_duplicates(as_docs(spark, rows), trees=12)), wanted(rows)
    assert sum(a == b for a, b in zip(got, want)) >= 0.99 * len(want)


def test_recall_of_pairs_at_the_threshold(spark):
    """Pairs that are hardly similar enough, in a table whose root and first children are large nodes."""
    rng = random.Random(9)
    texts = []
    for k in range(1500):
        base = [str(rng.randrange(10**5)) for _ in range(100)]
        copy = list(base)
        copy[20 + k % 60] = "changed"
        if k % 2:
            copy[-1] = "end"  # 96 shingles each; 91 or 90 in common
        texts += [" ".join(base), " ".join(copy)]
    rows = list(enumerate(texts))
    got = {r[0]: r[2] for r in collected(near_duplicates(as_docs(spark, rows)))}
    want = {r[0]: r[2] for r in brute(rows)}
    pairs = [i for i in want if want[i] != i]
    assert len(pairs) == 1500
    assert sum(got[i] == want[i] for i in pairs) >= 0.99 * len(pairs)
    assert all(got[i] in (i, want[i]) for i in want)


def test_a_path_alone_chooses_its_places():
    rng = np.random.default_rng(1)
    tokens = rng.integers(0, 9, (4000, minhash.TOKENS)).astype(np.uint16)
    paths = np.repeat(rng.integers(0, 2**63, 2000).astype(np.uint64), 2)
    row, child = children(paths, tokens)
    assert 1.14 < len(row) / 4000 < 1.22
    same = tokens.copy()
    same[1::2] = same[::2]
    row, child = children(paths, same)
    assert {(r // 2, c) for r, c in zip(row[row % 2 == 0].tolist(), child[row % 2 == 0].tolist())} == {
        (r // 2, c) for r, c in zip(row[row % 2 == 1].tolist(), child[row % 2 == 1].tolist())
    }


def test_links_are_exact():
    rng = random.Random(2)
    sets = [set(rng.sample(range(60), rng.randrange(1, 40))) for _ in range(80)]
    sets += [s | {99} for s in sets]
    arrays = [np.array(sorted(s), np.uint64) for s in sets]
    a, b = linked(arrays)
    label = list(range(len(sets)))
    for x in range(len(sets)):
        for y in range(x):
            if 100 * len(sets[x] & sets[y]) >= 85 * len(sets[x] | sets[y]):
                old, new = max(label[x], label[y]), min(label[x], label[y])
                label = [new if v == old else v for v in label]
    got = list(range(len(sets)))
    for x, y in zip(a.tolist(), b.tolist()):
        got[y] = x
    assert got == label


def test_sets():
    for text in ("", "a", "a b c d e", "a b c d e f", "x y " * 9, "Ä b C d É f g"):
        assert len(shingle_sets([text])[0]) == len(brute_set(text))
    assert (shingle_sets(["A b c"])[0] == shingle_sets(["a\x0bB\nC"])[0]).all()


def test_empty_table(spark):
    assert near_duplicates(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_registered_query_reads_all_documents(spark):
    sf = "/root/testdata/sf0.01"
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    assert collected(registered.SPARK["op13_minhash"](spark, sf)) == brute(rows)
