"""Queries that write rows of the given tables as files or tables into a work folder, and read them back."""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfmatch.operators import evaluation
from shelfmatch.operators.lineage import cut_to_files, work_folder
from shelfmatch.plans.daily import with_clean_names
from shelfmatch.sources import delimited, listing, tables
from shelfmatch.sources.prices import clean_prices, price_file, read_prices
from shelfmatch.sources.scraped import SCRAPED_SCHEMA, read_scraped

from . import duck as D
from . import fields as FQ
from . import inputs as I
from . import names as NQ

SPARK, SQL = {}, {}


def query(name: str, sql: str | None = None):
    def register(fn):
        SPARK[name] = fn
        if sql is not None:
            SQL[name] = sql
        return fn
    return register


# ------------------------------------------------------------- scrape files

HEADER = ["name", "company", "url", "price", "date", "zone", "type", "country", "quantity", "specialPrice"]
LINES = f"""
select row_key, company, name, price, concat_ws('<s>', {", ".join(f"coalesce({c}, '')" for c in HEADER)}) as line from ({I.SCRAPED})
"""
# a folder for each competitor, and four whose files are rejected
FOLDERS = f"""
select company as folder, row_key as place, line from ({LINES})
union all select 'no_prices', row_key, line from ({LINES}) where price = 'n.d.'
union all select 'no_names', row_key, concat('x', substring(line, length(name) + 1)) from ({LINES}) where row_key % 7 = 0
union all select 'no_columns', row_key, substring(line, 1, 20) from ({LINES}) where row_key % 5 = 0
union all select distinct case when row_key % 5 = 0 then 'header_only' else company end, -1, '{"<s>".join(HEADER)}' from ({LINES}) where row_key % 5 < 5
union all select distinct case when row_key % 3 = 0 then 'no_prices' else 'no_names' end, -1, '{"<s>".join(HEADER)}' from ({LINES}) where row_key % 3 < 2
union all select distinct 'no_columns', -1, 'name<s>company<s>url' from ({LINES})
union all select distinct company, -1, '{"<s>".join(HEADER)}' from ({LINES}) where row_key % 5 = 0
"""


def _scrape_folder(spark: SparkSession, sf: str) -> str:
    """One file per folder, its header first."""
    path = work_folder(spark, "scrape-files")
    lines = I.read(spark, sf, FOLDERS).repartition("folder").sortWithinPartitions("folder", "place")
    lines.select("folder", "line").write.partitionBy("folder").text(path)
    return path


def _folder_of(file: Column) -> Column:
    return F.regexp_extract(file, "folder=([^/]+)/", 1)


@query("scrape_files", FQ.SQL["scraped_clean"])
def scrape_files(spark, sf):
    """Clean rows of scrape files: the rejected files hold none."""
    return read_scraped(spark, _scrape_folder(spark, sf)).rows.select(*SCRAPED_SCHEMA.fieldNames())


@query("scrape_report", f"""
with f as ({FOLDERS}),
kept as (select competitor_name as folder, count(*) as n_kept from ({FQ.SQL["scraped_clean"]}) group by 1)
select folder, sum(octet_length(encode(line)) + 1)::bigint as file_size,
       case when folder in ('header_only', 'no_columns') then 0 else count(*) filter (place >= 0) end as n_rows, coalesce(any_value(n_kept), 0) as n_kept,
       case folder when 'header_only' then 'empty or not a valid file' when 'no_columns' then 'missing columns: price, date, zone, type, country'
                   when 'no_prices' then 'incorrect price values' when 'no_names' then 'incorrect name values' end as reason
from f left join kept using (folder) group by folder""")
def scrape_report(spark, sf):
    """What became of every file, and its size."""
    files = read_scraped(spark, _scrape_folder(spark, sf)).files
    return files.select(_folder_of(F.col("file")).alias("folder"), "file_size", "n_rows", "n_kept", "reason")


@query("scrape_new_files", f"select * from ({FQ.SQL['scraped_clean']}) where competitor_name not in ('competitor_1', 'competitor_4')")
def scrape_new_files(spark, sf):
    """Files of a day that were not processed yet: the folder of the day is listed, the competitors done are left out."""
    root, day = work_folder(spark, "scrape-days"), dt.date(2026, 1, 5)
    folder = f"{root}/{day:%d-%m-%y}"
    lines = I.read(spark, sf, FOLDERS).where("folder like 'competitor%'").repartition("folder").sortWithinPartitions("folder", "place")
    lines.select("folder", "line").write.partitionBy("folder").text(folder)
    files = listing.require_files(listing.list_files(spark, folder, "*.txt"), "no files")
    rows = read_scraped(spark, [f"{folder}/folder={r.name}" for r in _names(files) if r.name not in ("competitor_1", "competitor_4")]).rows
    return rows.select(*SCRAPED_SCHEMA.fieldNames())


def _names(files: DataFrame) -> list:
    """The few competitors of a day."""
    return files.select(_folder_of(F.col("file")).alias("name")).distinct().orderBy("name").collect()


# ------------------------------------------------------------- lists, prices, expected matches

CSV = f"select company as \"Store\", name as \"Category\", price as \"Price\", quantity as \"Quantity\", url as \"Url\" from ({I.SCRAPED})"


@query("csv_files", CSV)
def csv_files(spark, sf):
    """Lists as CSV files with a header, every field a text."""
    path = work_folder(spark, "csv-files")
    names = {"company": "Store", "name": "Category", "price": "Price", "quantity": "Quantity", "url": "Url"}
    tables.write_csv(I.read(spark, sf, I.SCRAPED).select(*names).withColumnsRenamed(names), path)
    return delimited.read_csv_strings(spark, path).drop("file_name")


def _price_files(spark: SparkSession, sf: str):
    """Prices without repeated keys as one set of files per country; those of CO have a date that is none."""
    root, day = work_folder(spark, "price-files"), dt.date(2026, 1, 5)
    # every country reads them
    rows = cut_to_files(clean_prices(I.read(spark, sf, I.PRICES), F.col("country"), [], F.struct(*FQ.PRICE_ORDER.split(", "))))
    scans = []
    for country in ("MX", "CO", "XX"):
        own = rows.where(F.col("country") == country).drop("country")
        date = F.col("date").cast("string") if country != "CO" else F.concat(F.lit("the "), F.col("date"))
        path = price_file(root, country, day)
        tables.write_parquet(own.withColumn("date", date), path)
        scans.append(read_prices(spark, path, country))
    return scans


@query("price_files", f"select * from ({FQ.CLEAN_PRICES_SQL}) where country = 'MX'")
def price_files(spark, sf):
    """Prices of the files that are not rejected."""
    first, *others = [scan.rows for scan in _price_files(spark, sf)]
    for rows in others:
        first = first.unionByName(rows)
    return first


@query("price_file_report", f"""
select country, count(*) as n_rows, case when country = 'CO' then count(*) else 0 end as n_bad_dates,
       case country when 'XX' then 'invalid country' when 'CO' then 'bad date' end as reason
from ({FQ.CLEAN_PRICES_SQL}) group by country""")
def price_file_report(spark, sf):
    first, *others = [scan.files for scan in _price_files(spark, sf)]
    for files in others:
        first = first.unionByName(files)
    return first.groupBy("country", "reason").agg(F.sum("n_rows").alias("n_rows"), F.sum("n_bad_dates").alias("n_bad_dates"))


@query("expected_file", NQ.SQL["expectation_check"])
def expected_file(spark, sf):
    """Expected pairs as JSON files of some hundred pairs each, read and checked."""
    path = work_folder(spark, "expected-files")
    pairs = I.read(spark, sf, NQ.EXPECTED).withColumn("file", F.expr("cast(own_key as bigint) div 500"))
    entry = F.struct("own_key", F.array("competitor_name", F.col("expected").cast("string"), "op").alias("v"))
    own = pairs.groupBy("file", "own_name").agg(F.map_from_entries(F.collect_list(entry)).alias("pairs"))
    docs = own.groupBy("file").agg(F.to_json(F.map_from_entries(F.collect_list(F.struct("own_name", "pairs")))).alias("doc"))
    docs.select("file", "doc").write.partitionBy("file").text(path)
    expected = delimited.read_expected(spark, path).withColumnRenamed("key", "own_key")
    return evaluation.check_expected(expected).select("own_key", "confidence", "passed")


# ------------------------------------------------------------- tables

MATCH_TABLE = f"select country, date, region_name, sku, price from ({FQ.CLEAN_PRICES_SQL})"


def _table(spark: SparkSession, name: str) -> str:
    tables.ensure_database(spark, "registry_files")
    return f"registry_files.{name}_{uuid.uuid4().hex}"


@query("repeated_append", MATCH_TABLE)
def repeated_append(spark, sf):
    """Rows added in two steps, the first of them twice, as by a job that was killed and ran again."""
    rows = clean_prices(I.read(spark, sf, I.PRICES), F.col("country"), [], F.struct(*FQ.PRICE_ORDER.split(", "))).select("region_name", "sku", "price", "country", F.trunc("date", "year").alias("year"), "date")
    rows = cut_to_files(rows)
    table = _table(spark, "appended")
    some = rows.where("region_name in ('ASIA', 'EUROPE')")
    for part in (some, some, rows.where("region_name not in ('ASIA', 'EUROPE')")):
        tables.put_rows(part, table, ("country", "year"))
    return spark.table(table).select("country", "date", "region_name", "sku", "price")


@query("insert_given", f"""
with new as (select country, date, region_name, sku, price, year(date) as y from ({FQ.CLEAN_PRICES_SQL}))
select country, date, region_name, sku, price from new where (country = 'MX' and y = 1995) or region_name = 'ASIA' and y = 1996""")
def insert_given(spark, sf):
    """Prices of a country and year, inserted where the table has none of them; a second insert of that year adds nothing."""
    rows = clean_prices(I.read(spark, sf, I.PRICES), F.col("country"), [], F.struct(*FQ.PRICE_ORDER.split(", "))).select("date", "region_name", "sku", "price", "country", F.year("date").alias("y"))
    # one join and aggregation for the three of them
    rows = cut_to_files(rows.where("(country = 'MX' and y in (1995, 1996)) or (region_name = 'ASIA' and y = 1996)"))
    table = _table(spark, "inserted")
    tables.put_rows(rows.where("region_name = 'ASIA' and y = 1996"), table, ("country", "y"))
    for year in (1995, 1996):
        given = {"country": "MX", "y": year}
        tables.put_if_absent(rows.where(f"country = 'MX' and y = {year}"), table, ("country", "y"), given=given)
    return spark.table(table).select("country", "date", "region_name", "sku", "price")


BUCKETS = 8


@query("bucketed_join_back", f"""
select sku, c.name as mkp_sku_name_clean, s.row_key from (select sku, x as name from ({D.normalize(I.CATALOG, 'sku_name')})) c join ({I.SCRAPED}) s on c.sku::bigint = s.row_key""")
def bucketed_join_back(spark, sf):
    """Rows joined back to the catalogue by key, both from tables dealt by it."""
    own, rows = _table(spark, "catalog"), _table(spark, "rows")
    tables.write_bucketed(with_clean_names(I.read(spark, sf, I.CATALOG), "sku_name", "mkp_sku_name_clean").select("sku", "mkp_sku_name_clean"), own, "sku", BUCKETS)
    tables.write_bucketed(I.read(spark, sf, I.SCRAPED).select(F.lpad(F.col("row_key").cast("string"), 8, "0").alias("sku"), "row_key"), rows, "sku", BUCKETS)
    return spark.table(rows).join(spark.table(own).hint("merge"), "sku").select("sku", "mkp_sku_name_clean", "row_key")
