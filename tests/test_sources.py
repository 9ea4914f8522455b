import datetime as dt
import json
import os

import pytest
from pyspark.sql import functions as F

from shelfmatch.sources import delimited, listing, tables
from shelfmatch.sources.prices import price_file, read_prices
from shelfmatch.sources.scraped import SCRAPED_SCHEMA, read_scraped

HEADER = ["name", "company", "url", "price", "date", "zone", "type", "country", "quantity", "specialPrice"]


def line(name="Leche Lala entera 1l", company="shop", url="https://shop.example.com/1", price="$10.50", date="05-01-26",
         zone="unique", kind="online", country="MX", quantity="", special=""):
    return "<s>".join([name, company, url, price, date, zone, kind, country, quantity, special])


def write(folder, name, lines):
    os.makedirs(folder, exist_ok=True)
    with open(os.path.join(folder, name), "w", encoding="utf-8") as f:
        f.write("\n".join(lines) + "\n")


@pytest.fixture(scope="module")
def scrape_folder(tmp_path_factory):
    d = str(tmp_path_factory.mktemp("scrape"))
    head = "<s>".join(HEADER)
    write(d, "x-good.txt", [
        "﻿" + head, line(), "", line(name="corto"), line(price="n/a"), line(date="2026-01-05"),
        line() + "<s>surplus", "<s>".join(line().split("<s>")[:8]), line(name="Agua Santa Maria 1l + vaso", quantity="6", zone="north", special="9.5"),
        line(url="short"), line(country=""), head,
    ])
    write(d, "x-tiny.txt", [head, line()][:1])
    write(d, "x-nocols.txt", ["name<s>company<s>url<s>date"] + ["a<s>b<s>c<s>d"] * 100)
    write(d, "x-noprice.txt", [head] + [line(price="?")] * 5)
    write(d, "x-noname.txt", [head] + [line(name="x")] * 5)
    other = HEADER[::-1]
    write(d, "x-reordered.txt", ["<s>".join(other)] + ["<s>".join(line(company="re").split("<s>")[::-1])] * 4)
    write(d, "x-ignored.csv", [head, line()])
    return d


def test_scraped_rows(spark, scrape_folder):
    scan = read_scraped(spark, scrape_folder)
    assert scan.rows.columns == SCRAPED_SCHEMA.fieldNames()
    rows = [tuple(r) for r in scan.rows.where("competitor_name = 'shop'").orderBy("competitor_sku_name", "competitor_url").collect()]
    day = dt.date(2026, 1, 5)
    milk = ("online", "MX", "Nacional", day, "shop", "Leche Lala Entera 1l ", 10.5, None)
    assert rows == [
        ("online", "MX", "north", day, "shop", "Agua Santa Maria 1l 6", 10.5, 9.5, "https://shop.example.com/1", "vaso"),
        (*milk, None, "None"), (*milk, "https://shop.example.com/1", "None"), (*milk, "https://shop.example.com/1", "None"),
    ]
    assert scan.rows.where("competitor_name = 're'").count() == 4


def test_scraped_reports(spark, scrape_folder):
    scan = read_scraped(spark, scrape_folder)
    reasons = {r.competitor: r.reason for r in scan.files.collect()}
    assert reasons == {
        "good": None, "reordered": None, "tiny": "empty or not a valid file", "noprice": "incorrect price values",
        "noname": "incorrect name values", "nocols": "missing columns: price, zone, type, country"}
    dropped = {r.reason: r["count"] for r in scan.dropped.where("file like '%good%'").groupBy("reason").count().collect()}
    assert dropped == {"bad name": 1, "bad price": 1, "bad date": 1, "too many fields": 1, "missing type, country or zone": 1}


def test_processed_competitors_are_skipped(spark, scrape_folder):
    done = spark.createDataFrame([("good",), ("noprice",)], "competitor_name string")
    scan = read_scraped(spark, scrape_folder, processed=done)
    assert {r[0] for r in scan.rows.select("competitor_name").distinct().collect()} == {"re"}
    assert "good" not in {r.competitor for r in scan.files.collect()}


def test_header_is_found_when_a_file_is_split(spark, tmp_path):
    write(str(tmp_path), "x-big.txt", ["<s>".join(HEADER)] + [line(name=f"Leche Lala numero {i}") for i in range(500)])
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    try:
        scan = read_scraped(spark, str(tmp_path))
        assert scan.rows.count() == 500
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)


def write_prices(spark, root, name, rows, schema="date string, region_name string, sku string, sku_name string, price double, extra int"):
    path = os.path.join(root, name)
    spark.createDataFrame(rows, schema).coalesce(1).write.parquet(path + ".dir")
    part = next(f for f in os.listdir(path + ".dir") if f.endswith(".parquet"))
    os.rename(os.path.join(path + ".dir", part), path)
    return path


def test_prices(spark, tmp_path):
    root = str(tmp_path)
    row = ("2026-01-05", "north", "0012 ", "leche", 10.128, 1)
    good = write_prices(spark, root, "MX-2026-05-01.parquet", [
        row, ("2026-01-05", "north", "12", "second of the key", 9.0, 1), ("2026-01-05", None, "13", "x", 1.0, 1),
        ("2026-01-05", "south", "12", None, 1.0, 1), ("2026-01-05", "south", "12", "lost with the first of its key", 1.0, 1)])
    bad_country = write_prices(spark, root, "XX-2026-05-01.parquet", [row])
    bad_date = write_prices(spark, root, "CO-2026-05-01.parquet", [row, ("5th of May", "north", "1", "x", 1.0, 1)])
    scan = read_prices(spark, [good, bad_country, bad_date])
    assert [tuple(r) for r in scan.rows.collect()] == [("MX", dt.date(2026, 1, 5), "north", "12", "leche", 10.13)]
    assert {r.country: r.reason for r in scan.files.collect()} == {"MX": None, "XX": "invalid country", "CO": "bad date"}
    with pytest.raises(ValueError, match="price"):
        read_prices(spark, write_prices(spark, root, "PE-2026-05-01.parquet", [("2026-01-05", "a", "1", "x")], "date string, region_name string, sku string, sku_name string"))


def test_price_file_name_has_the_day_first():
    assert price_file("/p", "MX", dt.date(2023, 10, 11)) == "/p/MX/MX-2023-11-10.parquet"


def test_listing(spark, tmp_path):
    for name in ("05-01-26_a-one.txt", "06-01-26_a-two_COL.txt", "2026-1-7_a-three.txt", "nodate-four.txt"):
        write(str(tmp_path), name, ["x"])
    files = listing.list_files(spark, str(tmp_path), "*.txt")
    assert {r.file_size for r in files.collect()} == {2}
    dates = listing.available_dates(files)
    assert [r.str_date for r in dates.orderBy("date").collect()] == ["05-01-26", "06-01-26", "07-01-26"]
    assert listing.nth_date(dates, 2).first().week_num == 1
    kept = listing.exclude_files(files, "_COL")
    assert {r[0] for r in kept.select(listing.competitor_of(F.col("file_name"))).collect()} == {"one", "three", "four"}
    with pytest.raises(FileNotFoundError):
        listing.require_files(files.where("false"), "none")


def test_csv_and_source_rules(spark, tmp_path):
    write(str(tmp_path), "05-01-26_Shop_MX.csv", ["Store,Category,Price,Quantity,Url,Estado"] + [f"Shop,leche {i},,2,u,A" for i in range(3)])
    write(str(tmp_path), "05-01-26_Shop_COL.csv", ["Store,Category,Price,Quantity,Url,Estado", "Shop,x,007,1,u,B"])
    df = delimited.read_csv_strings(spark, str(tmp_path), exclude=("_COL",))
    assert df.columns == ["Store", "Category", "Price", "Quantity", "Url", "file_name"] and df.count() == 3
    rows = spark.createDataFrame([("a", None, "1"), ("a", None, "2"), ("b", None, "3"), ("b", "9", "4")], "Store string, Price string, Unit_price string")
    filled = delimited.price_from_unit(rows, "Store", limit=1)
    assert {(r.Store, r.Price) for r in filled.collect()} == {("a", "1"), ("a", "2"), ("b", None), ("b", "9")}
    kept = delimited.keep_state(rows.withColumn("Estado", F.col("Unit_price")), F.col("Store") == "a", "Estado", "2")
    assert kept.count() == 3


def test_expected_json(spark, tmp_path):
    path = tmp_path / "expected.json"
    path.write_text(json.dumps({"own": {"k1": ["other", 0.5, ">="], "k2": ["third", 1, "=="]}}))
    rows = {tuple(r) for r in delimited.read_expected(spark, str(path)).collect()}
    assert rows == {("own", "k1", "other", 0.5, ">="), ("own", "k2", "third", 1.0, "==")}


def test_sinks(spark, tmp_path):
    df = spark.createDataFrame([("MX", dt.date(2026, 1, 5), 1), ("CO", dt.date(2026, 1, 5), 2)], "country string, date date, v int")
    tables.ensure_database(spark, "sinks")
    for _ in range(2):
        tables.insert_if_absent(df, "sinks.t")
    tables.insert_if_absent(df.withColumn("date", F.date_add("date", 1)), "sinks.t")
    assert spark.table("sinks.t").count() == 4
    plan = spark.table("sinks.t").where("country = 'MX'")._jdf.queryExecution().toString()
    assert "PartitionFilters: [isnotnull(country" in plan
    tables.write_csv(df, str(tmp_path / "csv"))
    tables.write_parquet(df, str(tmp_path / "pq"))
    assert spark.read.csv(str(tmp_path / "csv"), header=True).count() == spark.read.parquet(str(tmp_path / "pq")).count() == 2


def test_insert_reads_the_given_partitions_only(spark):
    df = spark.createDataFrame([("MX", dt.date(2026, 1, 5), 1)], "country string, date date, v int")
    tables.ensure_database(spark, "sinks")
    tables.append_table(df, "sinks.pruned")
    rows = tables.absent_rows(df, spark.table("sinks.pruned"), given={"country": "MX", "date": dt.date(2026, 1, 5)})
    plan = rows._jdf.queryExecution().toString()
    assert "PartitionFilters: [isnotnull(country" in plan and "(date" in plan
    assert rows.count() == 0


def test_store_name_of_unit_prices(spark):
    rows = spark.createDataFrame([("a", None, "1", "s"), ("b", "9", "4", "t")], "file string, Price string, Unit_price string, Store string")
    filled = delimited.price_from_unit(rows, "file", limit=0, store="Store", store_name="Other")
    assert {(r.file, r.Price, r.Store) for r in filled.collect()} == {("a", "1", "Other"), ("b", "9", "t")}


def test_a_sample_of_a_given_size_does_not_depend_on_partitions(spark):
    from shelfmatch.operators.catalog import sample_rows

    df = spark.range(1000).select(F.col("id").cast("string").alias("k"))
    one = sorted(r.k for r in sample_rows(df.coalesce(1), 50, "k").collect())
    assert len(one) == 50 and sorted(r.k for r in sample_rows(df.repartition(17), 50, "k").collect()) == one
    assert sorted(r.k for r in sample_rows(df, 50, "k", seed=1).collect()) != one
    assert sample_rows(df, 2000, "k").count() == 1000


def test_reports_come_in_order(spark):
    from shelfmatch.operators import reports

    rows = [("1", "x", 10.0, c, n, conf, 9.0, None) for c, n, conf in [("b", "m", 0.9), ("a", "n", 0.8), ("b", "o", 0.75), ("a", "p", 1.0), ("c", "q", 0.8)]]
    long = spark.createDataFrame(rows, "sku string, sku_name string, price double, competitor_name string, competitor_sku_name string, confidence double, competitor_price double, competitor_url string")
    report = reports.long_report(long.repartition(5), F.lit("2026-01-05").cast("date"), ordered=True)
    assert [(r[0], r[9]) for r in report.collect()] == [("a", 0.8), ("a", 1.0), ("b", 0.75), ("b", 0.9), ("c", 0.8)]
    own = spark.createDataFrame([("1", "x", 10.0, "nx"), ("2", "y", 5.0, "ny")], "mkp_sku_id string, mkp_sku_name string, mkp_price double, mkp_sku_name_clean string")
    scraped = spark.createDataFrame([(k, "shop", f"n{k}", 9.0, None, f"c{k}") for k in range(4)], "scrap_id int, competitor_name string, competitor_sku_name string, competitor_price double, competitor_url string, comp_sku_name_clean string")
    matches = spark.createDataFrame([("c0", "2", 0.5), ("c1", "1", 0.6), ("c2", "2", 0.9), ("c3", "1", 0.7)], "comp_sku_name_clean string, mkp_sku_id string, confidence double")
    report = reports.price_report(scraped.repartition(3), own, matches, F.lit("2026-01-05").cast("date"), ordered=True)
    assert [(r.mkp_sku_id, r.confidence) for r in report.collect()] == [("1", 0.7), ("1", 0.6), ("2", 0.9), ("2", 0.5)]


def test_rows_put_twice_are_there_once(spark):
    tables.ensure_database(spark, "sinks")
    schema = "v int, country string, date date"
    day = dt.date(2026, 1, 5)
    first = spark.createDataFrame([(1, "MX", day), (1, "MX", day), (2, "CO", day), (None, None, day)], schema)
    more = spark.createDataFrame([(1, "MX", day), (3, "MX", day), (4, "PE", day)], schema)
    for df in (first, first, more, more, first.where("false")):
        tables.put_rows(df, "sinks.put")
    got = sorted(map(tuple, spark.table("sinks.put").select("v", "country").collect()), key=str)
    assert got == sorted([(1, "MX"), (1, "MX"), (3, "MX"), (2, "CO"), (4, "PE"), (None, None)], key=str)
    assert spark.conf.get("spark.sql.sources.partitionOverwriteMode", "STATIC").upper() == "STATIC"
    with pytest.raises(ValueError, match="partitioned by country, date"):
        tables.put_rows(first, "sinks.put", ("country",))


def test_tables_dealt_by_a_key_are_joined_without_a_shuffle(spark):
    tables.ensure_database(spark, "sinks")
    left = spark.range(500).select(F.col("id").cast("string").alias("sku"), "id")
    tables.write_bucketed(left, "sinks.left", "sku", 4)
    tables.write_bucketed(left.withColumnRenamed("id", "other"), "sinks.right", "sku", 4)
    joined = spark.table("sinks.left").join(spark.table("sinks.right").hint("merge"), "sku")
    assert "Exchange" not in joined._jdf.queryExecution().executedPlan().toString()
    assert joined.where("id = other").count() == 500


def test_the_map_report_holds_any_number_of_competitors(spark):
    from shelfmatch.operators import reports

    own = spark.createDataFrame([("1", "x", 10.0), ("2", "y", 5.0)], "sku string, sku_name string, price double")
    found = spark.range(3000).selectExpr("'1' as sku", "concat('shop ', id) as competitor_name", "concat('n', id) as competitor_sku_name", "0.9 as confidence", "1.0 as competitor_price", "cast(null as string) as competitor_url")
    report = reports.match_map(own, found)
    assert {(r.sku, -1 if r.matches is None else len(r.matches)) for r in report.collect()} == {("1", 3000), ("2", -1)}
    assert reports.map_to_long(report).select(*found.columns).exceptAll(found).isEmpty() and reports.map_to_long(report).count() == 3000
