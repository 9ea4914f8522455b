import datetime
import random
from decimal import Decimal

import numpy as np
import pandas as pd
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from registry import inputs as I
from registry.matching import TokenOverlap
from shelfmatch.functions.scorer import bound_violations
from shelfmatch.functions.similarity import Scoring
from shelfmatch.operators import best_match as B
from shelfmatch.operators import reports
from shelfmatch.operators.best_match import best_match

from . import brute


def names(n, seed):
    random.seed(seed)
    words = ["coca cola", "leche lala", "lalalala\x03light", "agua natural", "vino tinto", "cerveza", "teq cuervocuervo", "sopa", "pan", "x"]
    unit = ["355ml", "600ml", "12pz", "1.5lt", "900g", "24pz", "6pz", "2lt", ".5lt", "12pz", "7g", "9ml", "3oz", "8pz"]
    out = set()
    while len(out) < n:
        many = random.random() < 0.1
        out.add(" ".join(random.sample(words, random.randint(0, 3)) + random.choices(unit, k=random.randint(9, 14) if many else random.randint(0, 3))))
    return sorted(out)


def collect(df):
    return {r[0]: (r[-2], r[-1]) for r in df.collect()}


@pytest.fixture(scope="module")
def sides(spark):
    left, right = names(120, 1), names(150, 2)
    ids = [f"{i:04d}" for i in range(len(right))]
    random.shuffle(ids)
    catalog = list(zip(ids, right)) + [("9999", right[0])]
    ldf = spark.createDataFrame([(x,) for x in left + left[:10]] + [(None,)], "comp_sku_name_clean string")
    rdf = spark.createDataFrame(catalog + [("0000", None)], "sku string, mkp_sku_name_clean string")
    return left, catalog, ldf, rdf


@pytest.mark.parametrize("threshold", [0.0, 0.4, 0.75])
@pytest.mark.parametrize("block_chars", [1 << 20, 300])
def test_equals_brute_force(sides, threshold, block_chars):
    left, catalog, ldf, rdf = sides
    got = collect(best_match(ldf, rdf, threshold=threshold, block_chars=block_chars))
    assert got == brute.best(left, catalog, threshold)


def test_small_tiles_equal_brute_force(sides, monkeypatch):
    left, catalog, ldf, rdf = sides
    monkeypatch.setattr(B, "TILE", (7, 11))
    assert collect(best_match(ldf, rdf)) == brute.best(left, catalog, 0.4)


def test_first_version_weights(sides):
    left, catalog, ldf, rdf = sides
    got = collect(best_match(ldf, rdf, threshold=0.6, scoring=Scoring.first_version()))
    assert got == brute.best(left, catalog, 0.6, unit_weight=0.1, decay=1.1, digits=2)


def test_one_match_per_group(spark, sides):
    left, catalog, ldf, rdf = sides
    grouped = rdf.withColumn("shop", F.concat(F.lit("s"), (F.col("sku").cast("int") % 3).cast("string")))
    got = {(r.comp_sku_name_clean, r.shop): (r.sku, r.confidence) for r in best_match(ldf, grouped, threshold=0.5, by="shop", block_chars=2000).collect()}
    expected = {}
    for s in range(3):
        mine = [(i, b) for i, b in catalog if int(i) % 3 == s]
        expected |= {(a, f"s{s}"): v for a, v in brute.best(left, mine, 0.5).items()}
    assert got == expected


def test_one_form_for_all_names(spark):
    """All names share one unit-free form: the hottest key there can be."""
    left = [f"agua {m}ml {p}pz" for m in range(1, 30) for p in range(1, 8)]
    right = [(f"{i:05d}", f"agua {m * 2}ml {p * 3}pz") for i, (m, p) in enumerate((m, p) for m in range(1, 40) for p in range(1, 6))]
    ldf = spark.createDataFrame([(x,) for x in left], "comp_sku_name_clean string")
    rdf = spark.createDataFrame(right, "sku string, mkp_sku_name_clean string")
    assert collect(best_match(ldf, rdf, block_chars=1000)) == brute.best(left, right, 0.4)


def test_long_names(spark):
    left = ["palabra " * 40 + "500ml", "otra cosa " * 30, "ab"]
    right = [("1", "palabra " * 38 + "500ml"), ("2", "otra cosas " * 30), ("3", "zz")]
    ldf = spark.createDataFrame([(x.strip(),) for x in left], "comp_sku_name_clean string")
    rdf = spark.createDataFrame([(i, x.strip()) for i, x in right], "sku string, mkp_sku_name_clean string")
    expected = brute.best([x.strip() for x in left], [(i, x.strip()) for i, x in right], 0.4)
    assert collect(best_match(ldf, rdf, block_chars=500)) == expected


def test_partition_count_does_not_matter(spark, sides):
    _, _, ldf, rdf = sides
    one = collect(best_match(ldf.coalesce(1), rdf.coalesce(1)))
    assert collect(best_match(ldf.repartition(13), rdf.repartition(7))) == one


def test_empty_side(spark, sides):
    _, _, ldf, rdf = sides
    assert best_match(ldf, rdf.where("false")).collect() == []
    assert best_match(ldf.where("false"), rdf).columns == ["comp_sku_name_clean", "sku", "confidence"]


def test_no_pairing_operator_in_the_plan(sides):
    _, _, ldf, rdf = sides
    plan = best_match(ldf, rdf)._jdf.queryExecution().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_numeric_ids_keep_their_type_and_order(spark):
    left = spark.createDataFrame([("leche lala 1lt",)], "comp_sku_name_clean string")
    right = spark.createDataFrame([(10, "leche lala 1lt"), (9, "leche lala 1lt"), (-3, "pan"), (2, "lala leche 1lt")], "sku bigint, mkp_sku_name_clean string")
    found = best_match(left, right.where("sku > 2"))
    assert [tuple(r) for r in found.select("comp_sku_name_clean", "sku").collect()] == [("leche lala 1lt", 9)]
    none = best_match(left, right.where("false"))
    assert none.schema.simpleString() == found.schema.simpleString() and none.count() == 0


def test_one_name_in_many_groups(spark):
    left = spark.createDataFrame([("pan bimbo 600g",), ("agua 1lt",)], "comp_sku_name_clean string")
    right = spark.range(3000).select(F.col("id").cast("string").alias("sku"), F.lit("pan bimbo 600g").alias("mkp_sku_name_clean"), F.concat(F.lit("shop"), "id").alias("shop"))
    found = best_match(left, right, by="shop", block_chars=20_000)
    assert found.where("comp_sku_name_clean = 'pan bimbo 600g' and confidence = 1 and shop = concat('shop', sku)").count() == 3000


@pytest.mark.parametrize("scoring", [Scoring(), Scoring.first_version()])
def test_confidence_equals_the_column(spark, sides, scoring):
    """The blocks score with arrays what ``score_pairs`` scores with Columns: bit for bit the same."""
    from shelfmatch.functions.similarity import score_pairs

    _, _, ldf, rdf = sides
    found = best_match(ldf, rdf, threshold=0.05, scoring=scoring).withColumnRenamed("confidence", "found")
    pairs = score_pairs(found.join(rdf.dropna(), "sku"), "comp_sku_name_clean", "mkp_sku_name_clean", scoring)
    assert pairs.count() > 50 and pairs.where("found != confidence").count() == 0


# ------------------------------------------------------------- scorers and blocks


def described(texts):
    """The columns that the scorers read, made without Spark."""
    base = [brute.without_units(t) for t in texts]
    return pd.DataFrame({
        "text": texts, "form_text": [brute.token_sort(b) for b in base], "form_chars": ["".join(sorted(set(b))) for b in base],
        "units": [brute.units(t) for t in texts], "tokens": [list(dict.fromkeys(t.split(" "))) for t in texts],
    })


some_names = st.lists(st.text("ab lo1 2ml", max_size=25) | st.sampled_from(names(60, 5)), min_size=2, max_size=12)


@given(some_names, some_names)
@settings(max_examples=150, deadline=None)
def test_no_score_is_above_its_bound(left, right):
    pairs = [(a.strip(), b.strip()) for a in left for b in right]
    a, b = described([p[0] for p in pairs]), described([p[1] for p in pairs])
    for scorer in (B.ConfidenceScorer(), B.ConfidenceScorer(Scoring.first_version()), TokenOverlap()):
        assert not len(bound_violations(scorer, a, b))


def test_scores_of_the_confidence_scorer():
    left, right = names(40, 7), names(40, 8)
    got = np.round(B.ConfidenceScorer().score(described(left), described(right)), 4)
    assert got.tolist() == [brute.confidence(a, b) for a, b in zip(left, right)]


def test_a_bound_that_is_too_low_is_found():
    class Wrong(TokenOverlap):
        def bound(self, *ends):
            return super().bound(*ends) * 0.9

    rows = described(["pan bimbo", "agua"])
    assert bound_violations(Wrong(), rows, rows).tolist() == [0, 1]


@pytest.mark.parametrize("threshold", [0.3, 0.6])
def test_a_scorer_of_the_caller(sides, threshold):
    left, catalog, ldf, rdf = sides

    def overlap(a, b):
        a, b = set(a.split(" ")), set(b.split(" "))
        return round(len(a & b) / len(a | b), 4)

    expected = {}
    for a in left:
        score, sku = min((-overlap(a, b), i) for i, b in catalog)
        if -score >= threshold:
            expected[a] = (sku, -score)
    assert collect(best_match(ldf, rdf, threshold=threshold, scorer=TokenOverlap(), block_chars=500)) == expected


@pytest.mark.parametrize("scorer", [None, TokenOverlap()])
def test_skipped_pairs_of_blocks_hold_no_match(sides, monkeypatch, scorer):
    """Making all pairs of blocks changes nothing, and there are fewer without."""
    _, _, ldf, rdf = sides
    kept = B.kept_pairs
    shares = []

    def some(*args):
        pairs = kept(*args)
        shares.append(pairs.mean())
        return pairs

    monkeypatch.setattr(B, "kept_pairs", some)
    found = collect(best_match(ldf, rdf, threshold=0.8, scorer=scorer, block_chars=200))
    monkeypatch.setattr(B, "kept_pairs", lambda *args: np.ones_like(kept(*args)))
    assert collect(best_match(ldf, rdf, threshold=0.8, scorer=scorer, block_chars=200)) == found
    assert shares[0] < 0.9


def test_blocks_are_even(spark, sides, monkeypatch):
    """No pair of blocks has more than its share, one form of a third of all names included."""
    groups = []
    kept = B.kept_pairs

    def sizes(a, b, *args):
        groups.append([np.repeat(s.texts / s.parts, s.parts) for s in (a, b)])
        return kept(a, b, *args)

    monkeypatch.setattr(B, "kept_pairs", sizes)
    rows = spark.createDataFrame([(f"agua {k}ml",) for k in range(400)] + [(f"{n} {k}",) for k, n in enumerate(names(800, 3))], "name string").selectExpr("name", "name as id")
    best_match(rows, rows, left_name="name", right_name="name", right_id="id", threshold=0.9)
    left, right = groups[0]
    assert np.outer(left, right).max() / np.outer(left, right).sum() < 1 / (2 * spark.sparkContext.defaultParallelism)


@pytest.mark.parametrize(("kind", "ids"), [
    ("decimal(10,1)", [Decimal("10.0"), Decimal("9.5"), Decimal("-3.0")]),
    ("date", [datetime.date(2026, 2, 1), datetime.date(999, 1, 1), datetime.date(2025, 1, 1)]),
    ("double", [10.0, 9.0, 1e-7]),
])
def test_ids_of_other_types_keep_their_order(spark, kind, ids):
    left = spark.createDataFrame([("leche lala 1lt",)], "comp_sku_name_clean string")
    right = spark.createDataFrame([(i, "leche lala 1lt") for i in ids] + [(None, "leche lala 1lt")], f"sku {kind}, mkp_sku_name_clean string")
    found = best_match(left, right)
    assert found.schema["sku"].dataType == right.schema["sku"].dataType
    assert [r["sku"] for r in found.collect()] == [min(ids)]


def test_reverse_match_pairs_names_not_rows(spark, monkeypatch):
    rows = [("c1", "coca cola 355ml", "Coca", float(1 + i % 7), f"u{i % 5}") for i in range(200)] + [("c2", "coca cola 600ml", "Cola", 3.0, None)] * 50
    scraped = spark.createDataFrame(rows, "competitor_name string, sku_name_clean string, competitor_sku_name string, competitor_price double, competitor_url string")
    own = spark.createDataFrame([("1", "coca cola 355ml"), ("2", "coca cola 355ml"), ("2", "coca cola 355ml")], "sku string, sku_name_clean string")
    seen = []
    monkeypatch.setattr(reports, "best_match", lambda left, right, **options: seen.append(right.count()) or best_match(left, right, **options))
    got = sorted(map(tuple, reports.reverse_match(own, scraped, threshold=0.5).collect()))
    assert seen == [2]
    first = [r for r in got if r[1] == "c1"]
    assert first == [(sku, "c1", "Coca", 1.0, "u0", 1.0) for sku in ("1", "2", "2")]
    assert [r[:5] for r in got if r[1] == "c2"] == [(sku, "c2", "Cola", 3.0, None) for sku in ("1", "2", "2")]


def test_rows_of_one_small_file_are_dealt_over_all_cores(spark, tmp_path):
    part = spark.range(40).selectExpr("id as p_partkey", "'blue ring' as p_name", "'SMALL' as p_type", "cast(id % 9 as int) as p_size", "cast(id as double) as p_retailprice")
    part.coalesce(1).write.parquet(str(tmp_path / "part.parquet"))
    for sql in (I.CATALOG, I.SCRAPED):
        plain, dealt = (I.read(spark, str(tmp_path), sql, **options) for options in ({}, {"dealt": True}))
        assert plain.rdd.getNumPartitions() == 1 and dealt.rdd.getNumPartitions() == 8
        assert sorted(map(str, dealt.collect())) == sorted(map(str, plain.collect()))
