"""Operators on single texts, files and models: against brute force, exact round trips or held-out accuracy."""

import bisect
import hashlib
import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from shelfmatch.llm import lm_score, quality, secrets, token_files, toxicity
from shelfmatch.llm.packing import Places, configurations, pack, plan, solve
from shelfmatch.llm.tokens import encoder

BYTE, WORD = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("word_bpe_49k.json")

#: Null, empty, blank, repeated and long texts, and a column whose name operators use themselves.
ODD = [
    (1, "One two three.\nOne two three.\n\n  four  five\tsix", "a", "x"), (2, None, "a", None), (3, "", None, "x"), (4, " \n\t ", "b", "x"),
    (5, "lang é ß 中文 ²³ it's we'll  two   blanks\r\nend ", "b", "x"), (None, "no id here", "b", "x"), (7, "same", "a", "x"), (7, "same", "a", "x"),
    (8, "word " * 6000 + "end.", "a", "x"), (9, "<|endoftext|> and more", "a", "x"),
]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(ODD, "doc_id long, text string, source string, hash string")


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], "doc_id long, text string, source string, hash string")


@given(st.lists(st.text(alphabet=st.sampled_from("ab 'sé1²,.\n\t\xa0\x85\x1cΣ中"), max_size=40), min_size=1, max_size=5))
@settings(max_examples=150, deadline=None)
def test_encoder_equals_the_library(texts):
    for path in (BYTE, WORD):
        ids, bounds = encoder(path).encode(pa.array(texts))
        library = Tokenizer.from_file(path) if not hasattr(test_encoder_equals_the_library, path) else getattr(test_encoder_equals_the_library, path)
        setattr(test_encoder_equals_the_library, path, library)
        for k, t in enumerate(texts):
            assert ids[bounds[k] : bounds[k + 1]].tolist() == library.encode(t, add_special_tokens=False).ids


@given(st.lists(st.integers(0, 2**32 - 1) | st.integers(0, 300), max_size=70))
@settings(max_examples=100, deadline=None)
def test_numbers_round_trip(values):
    x = np.array(values, np.uint32)
    assert (token_files.decode_numbers(*token_files.encode_numbers(x), len(x)) == x).all()


def expected_ids(path, text):
    return [*Tokenizer.from_file(path).encode(text or "", add_special_tokens=False).ids, 0]


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


def test_token_files(spark, docs, none, tmp_path):
    token_files.write_token_files(docs, BYTE, str(tmp_path / "f"))
    rows = token_files.crc_of(token_files.read_token_files(spark, str(tmp_path / "f"))).orderBy("start").collect()
    assert [r["doc_id"] for r in rows] == [None, 1, 2, 3, 4, 5, 7, 7, 8, 9]
    at = 0
    for r in rows:
        ids = expected_ids(BYTE, next(t for i, t, *_ in ODD if i == r["doc_id"]))
        assert (r["start"], r["n_tokens"], r["ids_crc32"]) == (at, len(ids), crc(ids))
        at += len(ids)
    token_files.write_token_files(none, BYTE, str(tmp_path / "e"))
    assert token_files.read_token_files(spark, str(tmp_path / "e")).count() == 0


@pytest.mark.parametrize("lengths", [[], [1], [2048] * 3, [700] * 10, list(range(1, 400)), [1030] * 5 + [1000] * 7 + [18] * 30])
def test_plan_places_every_piece_once(lengths):
    histogram = {n: lengths.count(n) for n in set(lengths)}
    patterns = plan(histogram)
    assert all(sum(n * c for n, c in p) <= 2048 for p, _ in patterns)
    places, taken = Places(patterns), []
    for n, many in histogram.items():
        sequence, offset = places.of(n, np.arange(many))
        taken += zip(sequence.tolist(), offset.tolist(), [n] * many)
    assert len(taken) == len(set(taken)) == len(lengths)
    by: dict = {}
    for s, o, n in sorted(taken):
        assert by.get(s, 0) == o  # gapless from 0
        by[s] = o + n
    assert len(by) <= -(-sum(lengths) // 2048) * 1.5 + 1


def fewest(pieces, capacity):
    """The least number of sequences, by trying for each set of pieces which piece comes last."""
    best = {0: (0, 0)}  # set -> (full sequences, room taken in the open one)
    for chosen in range(1, 1 << len(pieces)):
        ways = []
        for i, n in enumerate(pieces):
            if chosen >> i & 1:
                full, taken = best[chosen ^ 1 << i]
                ways.append((full, taken + n) if taken + n <= capacity else (full + 1, n))
        best[chosen] = min(ways)
    full, taken = best[(1 << len(pieces)) - 1]
    return full + (taken > 0)


@pytest.mark.parametrize("seed", range(12))
def test_plan_against_every_packing(seed):
    pieces = np.random.default_rng(seed).integers(1, 21, 10).tolist()
    histogram = Counter(pieces)
    lengths = np.array(sorted(histogram))
    least = fewest(pieces, 30)
    assert solve(lengths, np.array([histogram[n] for n in lengths.tolist()], float), 30).bound <= least + 1e-9
    assert least <= sum(n for _, n in plan(histogram, 30)) <= least + (least > 4)


def best_fit(histogram, capacity):
    rooms, sequences = [], 0
    for n in sorted(histogram, reverse=True):
        for _ in range(histogram[n]):
            k = bisect.bisect_left(rooms, n)
            sequences += k == len(rooms)
            bisect.insort(rooms, (rooms.pop(k) if k < len(rooms) else capacity) - n)
    return sequences


@pytest.mark.parametrize("low, high", [(1, 700), (300, 1500), (600, 1100)])
def test_plan_comes_from_configurations(low, high):
    histogram = Counter(np.random.default_rng(1).integers(low, high, 2500).tolist())
    lengths = np.array(sorted(histogram))
    left = np.array([histogram[n] for n in lengths.tolist()])
    bound = solve(lengths, left.astype(float), 2048).bound
    made = sum(n for _, n in configurations(lengths, left, 2048))
    total = sum(n for _, n in plan(histogram))
    assert made > 0.9 * total
    assert bound <= total <= 1.005 * best_fit(histogram, 2048)


def test_pack(docs, none):
    rows = pack(docs, WORD).collect()
    assert len({(r["sequence_id"], r["offset"]) for r in rows}) == len(rows)
    for doc, text, *_ in ODD:
        ids = expected_ids(WORD, text)
        mine = sorted((r for r in rows if r["doc_id"] == doc), key=lambda r: r["piece"])[:: 2 if doc == 7 else 1]
        assert [(r["start"], r["length"]) for r in mine] == [(a, min(2048, len(ids) - a)) for a in range(0, len(ids), 2048)]
        assert [r["ids_crc32"] for r in mine] == [crc(ids[a : a + 2048]) for a in range(0, len(ids), 2048)]
    ends: dict = {}
    for r in sorted(rows, key=lambda r: (r["sequence_id"], r["offset"])):
        assert r["offset"] == ends.get(r["sequence_id"], 0)
        ends[r["sequence_id"]] = r["offset"] + r["length"]
    assert max(ends.values()) <= 2048
    assert pack(none, WORD).count() == 0


def brute_rules(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    repeated = sum(any(0 <= j < len(windows) and windows.count(windows[j]) > 1 for j in (i - 2, i - 1, i)) for i in range(len(words)))
    lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), repeated


def test_quality_features(docs, none):
    for text in ["a b c a b c d", "a a a a", "x # y\n\nx # y\n x", *(t for i, t, *_ in ODD if i != 8)]:
        assert quality.text_rules(text or "")[:5] == brute_rules(text)
    rows = quality.quality_rules(docs).collect()
    assert len(rows) == len(ODD) and quality.quality_rules(none).count() == 0
    assert quality.keep_good(docs).columns == docs.columns and quality.keep_good(none).count() == 0


def test_common_lines_deplete_all_but_the_first(spark):
    words = [f"w{i}" for i in range(500)]
    rng = random.Random(1)
    common = " ".join(words[:60])
    shared = [(i, f"{common.upper() if i % 2 else common}\n{' '.join(rng.sample(words, 30))}", "h") for i in range(8)]
    clean = [(100 + i, " ".join(rng.sample(words, 80)), "h") for i in range(8)]
    elsewhere = [(200, f"{common}\n{' '.join(rng.sample(words, 30))}", "other")]
    copies = [(300 + i, " ".join(words[100:170]), "h") for i in range(9)]  # one document, however often
    kept = {r["doc_id"]: r["kept"] for r in quality.quality_rules(spark.createDataFrame(shared + clean + elsewhere + copies, "doc_id long, text string, source string"), max_documents=5).collect()}
    assert [kept[i] for i in range(8)] == [True] + [False] * 7
    assert all(kept[i] for i in kept if i >= 100)


def test_common_lines_of_documents_without_ids_beside_columns_of_any_name(spark):
    rng = random.Random(3)
    words = [f"w{i}" for i in range(3000)]
    common = "Click here 4 more of this page"
    rows = [(None, f"{' '.join(rng.sample(words, 60))}\n{common}", "h", i, "x") for i in range(8)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, source string, gone int, _gone string")
    kept = quality.keep_good(frame, max_documents=5)
    assert kept.schema == frame.schema
    found = kept.collect()
    assert sorted(r["gone"] for r in found) == list(range(8)) and {r["_gone"] for r in found} == {"x"}
    first = min(rows, key=lambda r: hashlib.md5(r[1].encode()).digest())
    assert [r["gone"] for r in found if common in r["text"]] == [first[3]]


def test_kept_documents_lose_common_lines(spark):
    rng = random.Random(7)
    words = [f"w{i}" for i in range(3000)]
    common, own = "Click here 4 more of this page", lambda: " ".join(rng.sample(words, 40))
    rows = [(i, f"{own()}\n{common.replace('4', str(i % 10))}\n\n {own()} ", "h") for i in range(8)]
    rows += [(50, rows[3][1], "h"), (51, rows[0][1], "h"), (60, f"{own()}\n{common}\n{own()}", "other"), (61, None, "h"), (62, "\n".join([own(), *[common] * 5]), "h")]
    frame = spark.createDataFrame(rows, "doc_id long, text string, source string")
    left = {i: t if i in (0, 51, 60) or t is None else "\n".join(x for x in t.split("\n") if not x.startswith("Click")) for i, t, _ in rows}  # the first document keeps its copy
    found = {r["doc_id"]: r for r in quality.quality_rules(frame, max_documents=5).collect()}
    for i, text, _ in rows:
        assert found[i]["removed_words"] == len((text or "").split()) - len((left[i] or "").split())
        assert found[i]["kept_sha256"] == hashlib.sha256((left[i] or "").encode()).hexdigest()
    kept = quality.keep_good(frame, max_documents=5)
    assert kept.schema == frame.schema
    assert {r["doc_id"]: r["text"] for r in kept.collect()} == {i: t for i, t in left.items() if i != 61}
    assert found[62]["removed_words"] == 35 and quality.keep_good(frame).count() == len(rows) - 1


def brute_secrets(text):
    found = []
    for m in re.finditer(r"""([pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]|[tT][oO][kK][eE][nN]|[aA][pP][iI]_?[kK][eE][yY])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", text):
        if len(m[2]) >= 8:
            found.append((m.start(), 0, "assign", m.end()))
    for k, (kind, pattern, least) in enumerate((("access", "AKIA[A-Z0-9]+", 16), ("hex", "[0-9a-f]+", 32)), 1):
        found += [(m.start(), k, kind, m.end()) for m in re.finditer(pattern, text) if len(m[0]) >= least]
    return [(kind, a, b) for a, _, kind, b in sorted(found)]


@given(st.text(alphabet=st.sampled_from("token:=\"' AKI09af-ſKpaswdr_"), max_size=80) | st.lists(st.sampled_from(["token: ", "Secret=", "api_key = '", "AKIA", "A1B2", "0123456789abcdef", "deadbeef", " ", "x", "é"]), max_size=12).map("".join))
@settings(max_examples=200, deadline=None)
def test_base_secrets(text):
    assert secrets.base_findings(text) == brute_secrets(text)


def test_secrets(spark, none):
    rng = random.Random(3)
    key = lambda n: "".join(rng.choice("0123456789abcdef") for _ in range(n))
    rows = [(i, f'some text here token = "{key(40)}" and more') for i in range(300)]
    rows += [(1000 + i, f"the {'thinger' * rng.randint(3, 5)} and card {rng.randint(10**15, 10**16 - 1)} here") for i in range(300)]
    rows += [(5000, f"unnamed {key(28)} key"), (5001, None), (5002, "")]
    found = {r["doc_id"]: r for r in secrets.digest(secrets.find_secrets(spark.createDataFrame(rows, "doc_id long, text string"))).collect()}
    assert len(found) == len(rows)
    for i, text in rows:
        base = brute_secrets(text or "")
        assert found[i]["base_sha256"] == hashlib.sha256(secrets.joined(base).encode()).hexdigest()
        assert [s for s in found[i]["spans"].split(",") if s and not s.startswith("network")] == [f"{k}:{a}:{b}" for k, a, b in base]
    assert found[5000]["spans"].startswith("network:8:")
    assert sum("network" in found[i]["spans"] for i in found if 1000 <= i < 2000) < 10
    assert secrets.digest(secrets.find_secrets(none)).count() == 0


def test_long_candidates_are_read_whole():
    network = secrets.Network()
    short, long = secrets.codes(("a = ", "q" * 40, " b")), secrets.codes(("a = ", "q" * 5000 + "Z9" + "q" * 40, " b"))
    x = np.array([long])
    whole = np.maximum(network._responses(x).max(axis=1), 0) @ network.unit + network.rest
    assert np.allclose(network.raw([short, long])[1], whole[0], atol=1e-5)


def test_toxicity(spark, docs, none):
    rng = random.Random(5)
    plain = [f"{a}{b}" for a in ("ba", "ko", "ri", "tu", "ne") for b in ("la", "mi", "so", "pe")]
    bad = ["grumbleba", "grumbleko", "grumbleri"]
    rows, labels = [], []
    for i in range(600):
        toxic = i % 6 == 0
        words = [rng.choice(plain) for _ in range(60)]
        for _ in range(4 * toxic):
            words[rng.randrange(60)] = rng.choice(bad)
        rows.append((i, " ".join(words)))
        labels.append((i, int(toxic)))
    texts, marks = spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame([*labels, (None, 1), (99999, 1), (3, None)], "doc_id long, toxic int")
    model = toxicity.fit(texts, marks.where("doc_id < 400 or doc_id is null"))
    scores = {r["doc_id"]: r["score"] for r in toxicity.score(texts, model).collect()}
    wrong = sum((scores[i] >= 0.3) != bool(t) for i, t in labels if i >= 400)
    assert wrong <= 10 and all(0 <= s <= 1 for s in scores.values())
    assert model.difference("grumblexyz grumbletu") > model.difference("balami koso")  # a new form of a known stem
    assert toxicity.score(docs, model).count() == len(ODD) and toxicity.score(none, model).count() == 0
    assert toxicity.fit(texts, marks.where("toxic = 0")) == 0.0


def test_lm_score(spark, docs, none):
    rows = [(1, "a b a b a b"), (2, "c d c d c d"), (3, "a b c zz"), (4, None), (None, "a c")]
    found = {r["doc_id"]: r for r in lm_score.lm_score(spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame([(1,), (None,)], "doc_id long"), size=6, prior=2.0).collect()}
    words = [w for t in ("a b a b a b", "c d c d c d", "a b c zz", "a c") for w in t.split()]
    number = {w: i for i, w in enumerate(sorted(set(words), key=lambda w: (-words.count(w), w))[:4], 2)}

    def pairs(text):
        ids = [1, *(number.get(w, 0) for w in text.split())]
        return list(zip(ids, ids[1:]))

    def loss(text, train, scale):
        seen = [p for t in train for p in pairs(t)]
        n = len(seen) * scale
        share = lambda w: (sum(b == w for _, b in seen) * scale + 1) / (n + 6)
        p = [(seen.count((a, b)) * scale + 2 * share(b)) / (sum(x == a for x, _ in seen) * scale + 2) for a, b in pairs(text)]
        return -np.log(p).mean()

    every = [t for _, t in rows if t]
    for i, text in rows:
        if text:
            assert np.isclose(found[i]["target_loss"], loss(text, [rows[0][1]], 1), atol=1e-5)
            assert np.isclose(found[i]["background_loss"], loss(text, every, 6 / sum(len(t.split()) for t in every)), atol=1e-5)
    assert found[4]["difference"] is None and found[1]["difference"] < found[2]["difference"]
    assert lm_score.lm_score(none, docs).count() == 0
    assert lm_score.lm_score(docs, none).count() == len(ODD)


@pytest.mark.parametrize("size", [4, 12, 2048])
def test_lm_score_knows_every_word(spark, monkeypatch, size):
    """Losses of the whole vocabulary, however many words are in the tables that every task gets."""
    monkeypatch.setattr(lm_score, "BUCKET_TOKENS", 100)
    rng = random.Random(12)
    word = lambda: f"w{int(rng.expovariate(0.08))}"
    rows = [(i, " ".join(word() for _ in range(rng.randint(1, 30)))) for i in range(60)]
    rows += [(100, " same  rare\nrare ends rare"), (101, "same rare rare ends rare"), (102, None), (103, " \n"), (None, "w1 odd w2"), (104, "w1 zero w2"), (105, "w1 zeta w2"), (5, rows[5][1])]
    chosen = {*range(20), 100, 104}
    found = lm_score.lm_score(spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame([(i,) for i in chosen], "doc_id long"), size=size, prior=3.0).collect()
    pairs = {t: list(zip(["", *t.split()], t.split())) for t in (t or "" for _, t in rows)}
    every = [p for _, t in rows for p in pairs[t or ""]]
    target = [p for i, t in rows if i in chosen for p in pairs[t or ""]]
    n_words = len({b for _, b in every})

    def loss(text, seen, scale):
        share = lambda w: (sum(b == w for _, b in seen) * scale + 1) / (len(seen) * scale + n_words + 1)
        return -np.log([(seen.count((a, b)) * scale + 3 * share(b)) / (sum(x == a for x, _ in seen) * scale + 3) for a, b in pairs[text]]).mean()

    wanted = [(i, len(pairs[t or ""]), *((loss(t, target, 1), loss(t, every, len(target) / len(every))) if pairs[t or ""] else (None, None))) for i, t in rows]
    got = sorted(((r["doc_id"], r["n_tokens"], r["target_loss"], r["background_loss"]) for r in found), key=lambda r: str(r[:2]))
    for a, b in zip(got, sorted(wanted, key=lambda r: str(r[:2])), strict=True):
        assert a[:2] == b[:2] and (a[2:] == b[2:] if b[2] is None else np.allclose(a[2:], b[2:], atol=1e-5))
    by = {r["doc_id"]: r["target_loss"] for r in found}
    assert by[104] < by[105]  # they differ in a rare word only
