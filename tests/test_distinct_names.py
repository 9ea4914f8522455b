"""Best-match queries hand on distinct names, however many rows have them."""

from __future__ import annotations

import pytest

from registry import matching
from shelfmatch.operators import reports
from shelfmatch.plans import daily


@pytest.fixture(scope="module")
def repeated(spark, tmp_path_factory):
    """Parts whose names repeat: keys that are alike in all remainders the names are made of, 50 times over, and a null name."""
    folder = tmp_path_factory.mktemp("repeated")
    rows = [(k + 840 * copy, name, "Brand#1", kind, 7, 900.0 + copy) for copy in range(50) for k, (name, kind) in enumerate([("red bolt", "PROMO"), ("old ring", "SMALL"), ("blue pipe", "ECONOMY")], 1)]
    rows.append((4, None, "Brand#1", "PROMO", 7, 900.0))
    spark.createDataFrame(rows, "p_partkey long, p_name string, p_brand string, p_type string, p_size int, p_retailprice double").write.parquet(f"{folder}/part.parquet")
    return str(folder)


def _seen(monkeypatch, module, name):
    counts, inner = [], getattr(module, name)

    def spy(left, right, *args, **kwargs):
        counts.append((left.count(), right.count()))
        return inner(left, right, *args, **kwargs)

    monkeypatch.setattr(module, name, spy)
    return counts


@pytest.mark.parametrize("query", ["top_confidence", "best_match_strict", "best_match_custom", "price_report"])
def test_names_not_rows_are_matched(spark, repeated, monkeypatch, query):
    counts = _seen(monkeypatch, matching, "best_match")
    matching.SPARK[query](spark, repeated)
    assert counts == [(3, 3)]


def test_least_sku_of_a_name(spark, repeated):
    assert {r["sku"] for r in matching.best_match_join(spark, repeated).collect()} <= {"00000001", "00000002", "00000003"}


def test_reverse_match_takes_names(spark, repeated, monkeypatch):
    counts = _seen(monkeypatch, reports, "best_match")
    got = matching.competitor_counts(spark, repeated).collect()
    assert counts == [(3, 3)]
    assert sum(r["n_evaluated"] for r in got) == 150 - len([k for copy in range(50) for k in (1, 2, 3) if (k + 840 * copy) % 13 == 0])
    assert {r["n_matched"] + r["n_unmatched"] for r in got} == {150}


def test_first_product_of_a_name(spark):
    rows = [("a", "x", 2.0, None), ("a", "x", 1.0, "v"), ("a", "x", 1.0, "u"), ("b", "x", 3.0, "u"), ("b", "y", 3.0, None)]
    scraped = spark.createDataFrame(rows, "competitor_name string, competitor_sku_name string, competitor_price double, competitor_url string")
    got = reports.first_products(scraped, "competitor_sku_name").drop("product_id")
    assert sorted(tuple(r[c] for c in scraped.columns) for r in got.collect()) == [("a", "x", 1.0, "u"), ("b", "x", 3.0, "u"), ("b", "y", 3.0, None)]


def test_day_matches_names(spark, monkeypatch):
    counts = _seen(monkeypatch, daily, "best_match")
    scraped = spark.createDataFrame([("agua mineral 1l",)] * 20 + [(None,)], "competitor_sku_name string")
    catalog = spark.createDataFrame([(f"{k}", "agua mineral 1l") for k in range(5, 9)], "sku string, sku_name string")
    got = daily.match_day(scraped, catalog).collect()
    assert counts == [(1, 1)]
    assert [(r["competitor_sku_name"], r["sku"]) for r in got] == [("agua mineral 1l", "5")] * 20
