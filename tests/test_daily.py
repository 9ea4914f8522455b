import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from shelfmatch.operators import checks
from shelfmatch.operators.checks import DataCheckError
from shelfmatch.plans.daily import run_day

from .test_sources import HEADER, line, write, write_prices


@pytest.fixture(scope="module")
def world(spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("daily"))
    prices, scraped = f"{root}/prices", f"{root}/scraped"
    os.makedirs(f"{prices}/MX")
    rows = [("2026-01-05", "north", "001", "LALA LECHE ENTERA 1L - 12 PZS", 100.0, 1), ("2026-01-05", "north", "002", "BOING FRESA 500ML 24PZ", 50.0, 1),
            ("2026-01-05", "north", "003", "Not in the master catalogue 1L", 1.0, 1)]
    write_prices(spark, f"{prices}/MX", "MX-2026-05-01.parquet", rows)
    head = "<s>".join(HEADER)
    write(f"{scraped}/05-01-26", "a-shop.txt", [head, line(name="Leche Entera Lala 1L Desde 12 UNID"), line(name="jugo boing fresa 500ml - 24pz"), line(name="Zapato de cuero negro"), line(name="Leche Entera Lala 1L Desde 12 UNID", country="CO")])
    spark.sql("create database if not exists daily")
    spark.createDataFrame([("MX", "1"), ("MX", "2")], "country string, sku string").write.mode("overwrite").saveAsTable("daily.master_catalog_mkp")
    return prices, scraped


def test_run_twice_is_run_once(spark, world):
    prices, scraped = world
    result = run_day(spark, "MX", "05-01-26", "daily", prices, scraped)
    rows = {r.competitor_sku_name: (r.sku, r.confidence) for r in result.matched.collect()}
    assert {k: v[0] for k, v in rows.items()} == {"Leche Entera Lala 1l Desde 12 Unid ": "1", "Jugo Boing Fresa 500ml - 24pz ": "2"}
    assert all(v[1] >= 0.4 for v in rows.values())
    with pytest.raises(DataCheckError):
        run_day(spark, "MX", "05-01-26", "daily", prices, scraped)  # every competitor is done
    # the name of a file says "shop", and so do its rows: a new competitor is taken up
    write(f"{scraped}/05-01-26", "a-new.txt", ["<s>".join(HEADER)] + [line(name="boing fresa botella 500ml 24pz", company="new")] * 3)
    run_day(spark, "MX", "05-01-26", "daily", prices, scraped)
    table = spark.table("daily.matched_skus_webscraping")
    assert {(r.competitor_name, r["count"]) for r in table.groupBy("competitor_name").count().collect()} == {("shop", 2), ("new", 3)}
    assert spark.table("daily.mktp_prices_catalog").count() == 3


def test_no_files_stops_the_job(spark, world):
    prices, scraped = world
    with pytest.raises(Exception):
        run_day(spark, "MX", "06-01-26", "daily", prices, scraped)


def test_checks(spark):
    df = spark.createDataFrame([(dt.date(2026, 1, 5), "a", 1.0), (dt.date(2026, 1, 6), "a", None)], "date date, k string, v double")
    with pytest.raises(DataCheckError):
        checks.check_single_date(df, dt.date(2026, 1, 5))
    checks.check_single_date(df.where("v = 1"), dt.date(2026, 1, 5))
    with pytest.raises(DataCheckError):
        checks.check_unique(df, "k")
    checks.check_unique(df, "date")
    with pytest.raises(DataCheckError):
        checks.check_columns(df, ["k", "z"])
    with pytest.raises(DataCheckError):
        checks.check_not_empty(df.where("false"), "empty")
    assert {tuple(r) for r in checks.null_profile(df).collect()} == {("date", 2, 2, 0), ("k", 2, 2, 0), ("v", 2, 1, 1)}


def matches(spark, database):
    return sorted(map(tuple, spark.table(f"{database}.matched_skus_webscraping").select("competitor_name", "competitor_sku_name", "sku", "confidence").collect()))


def a_world(spark, root, database):
    """Prices, three scrape files (one of them holds rows of another's competitor) and the master catalogue."""
    prices, scraped = f"{root}/prices", f"{root}/scraped"
    os.makedirs(f"{prices}/MX")
    write_prices(spark, f"{prices}/MX", "MX-2026-05-01.parquet", [
        ("2026-01-05", "north", "001", "LALA LECHE ENTERA 1L - 12 PZS", 100.0, 1), ("2026-01-05", "north", "002", "BOING FRESA 500ML 24PZ", 50.0, 1)])
    head = "<s>".join(HEADER)
    write(f"{scraped}/05-01-26", "a-shop.txt", [head, line(name="Leche Entera Lala 1L Desde 12 UNID"), line(name="jugo boing fresa 500ml - 24pz"), line(name="jugo boing fresa 500ml - 24pz")])
    write(f"{scraped}/05-01-26", "a-new.txt", [head] + [line(name="boing fresa botella 500ml 24pz", company="new")] * 3)
    write(f"{scraped}/05-01-26", "a-other.txt", [head] + [line(name="leche lala entera 12pz 1lt", company="shop")] * 3)
    spark.sql(f"create database if not exists {database}")
    spark.createDataFrame([("MX", "1"), ("MX", "2")], "country string, sku string").write.mode("overwrite").saveAsTable(f"{database}.master_catalog_mkp")
    return prices, scraped


@pytest.fixture(scope="module")
def one_clean_run(spark, tmp_path_factory):
    world = a_world(spark, str(tmp_path_factory.mktemp("clean") / "a"), "clean_run")
    run_day(spark, "MX", "05-01-26", "clean_run", *world)
    return matches(spark, "clean_run")


@pytest.mark.parametrize("failing", ["before the matches", "after some matches", "inside the prices"])
def test_a_job_that_was_killed_may_run_again(spark, tmp_path, monkeypatch, one_clean_run, failing):
    """Whichever write fails, a second run leaves the tables as one clean run does."""
    from shelfmatch.sources import tables

    database = f"killed_{failing.replace(' ', '_')}"
    again = a_world(spark, str(tmp_path / "b"), database)
    whole = tables.put_rows

    def killed(df, table, *args):
        if "matched" in table and failing == "before the matches":
            raise KeyboardInterrupt
        if "matched" in table and failing == "after some matches":
            whole(df.where("competitor_name = 'new'"), table, *args)
            raise KeyboardInterrupt
        if "prices" in table and failing == "inside the prices":
            whole(df.where("false"), table, *args)
            raise KeyboardInterrupt
        whole(df, table, *args)

    monkeypatch.setattr(tables, "put_rows", killed)
    with pytest.raises(KeyboardInterrupt):
        run_day(spark, "MX", "05-01-26", database, *again)
    monkeypatch.setattr(tables, "put_rows", whole)
    run_day(spark, "MX", "05-01-26", database, *again)
    assert matches(spark, database) == one_clean_run and len(one_clean_run) == 9
    assert spark.table(f"{database}.mktp_prices_catalog").count() == 2
    if failing == "after some matches":
        # a file whose rows name another competitor is read again each time; its rows are there once
        run_day(spark, "MX", "05-01-26", database, *again)
        assert matches(spark, database) == one_clean_run
