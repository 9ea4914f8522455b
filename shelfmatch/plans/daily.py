"""The daily job: one country and day, from files to the match table.

Running a day twice adds nothing: prices are inserted only where their country
and day are absent, and competitors already matched that day are skipped.  Both tables are
written by whole partitions (``put_rows``), so a job that was killed between or inside the two writes can run again.
"""

from __future__ import annotations

import datetime as dt
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.dates import as_date
from ..functions.names import NameRules, normalize_names, spread
from ..functions.similarity import Scoring
from ..operators.best_match import best_match
from ..operators.catalog import catalog_names
from ..operators.checks import DataCheckError, check_not_empty, check_single_date
from ..operators.lineage import cut_lineage
from ..operators.reports import matched_rows
from ..sources import tables
from ..sources.listing import list_files, require_files
from ..sources.prices import price_file, read_prices
from ..sources.scraped import read_scraped

PRICES, MASTER, MATCHES = "mktp_prices_catalog", "master_catalog_mkp", "matched_skus_webscraping"


class DailyResult(NamedTuple):
    """Rows added for the day, and the report of every scrape file."""

    matched: DataFrame
    files: DataFrame


def clean_names(df: DataFrame, source: str, target: str, *firsts: Column, rules: NameRules | None = None, normalizer=None) -> DataFrame:
    """The distinct texts of a column with their normalised names and the aggregates ``firsts`` of their rows, written down:
    filters on the result would otherwise run all the rules a second time.  What needs names only goes on from these, not from rows."""
    texts = df.where(F.col(source).isNotNull()).groupBy(source).agg(*firsts) if firsts else df.select(source).where(F.col(source).isNotNull()).distinct()
    return cut_lineage(normalize_names(spread(texts, source), source, target, rules, normalizer))


def with_clean_names(df: DataFrame, source: str, target: str, rules: NameRules | None = None, normalizer=None) -> DataFrame:
    """Add the normalised name.  Every distinct text is normalised once."""
    return df.join(clean_names(df, source, target, rules=rules, normalizer=normalizer), source)


def match_day(
    scraped: DataFrame, catalog: DataFrame, threshold: float = 0.40, rules: NameRules | None = None,
    scoring: Scoring = Scoring(), normalizer=None,
) -> DataFrame:
    """Scraped rows with the best catalogue sku and its confidence.

    ``scraped`` has competitor_sku_name, ``catalog`` sku and sku_name.  Names are
    normalised once per distinct text.
    """
    names = clean_names(scraped, "competitor_sku_name", "comp_sku_name_clean", rules=rules, normalizer=normalizer)
    own = clean_names(catalog, "sku_name", "mkp_sku_name_clean", F.min("sku").alias("sku"), rules=rules, normalizer=normalizer)
    matches = best_match(names, own, threshold=threshold, scoring=scoring)
    scraped = scraped.join(names, "competitor_sku_name")
    return matched_rows(scraped, matches, threshold=threshold)


def load_prices(spark: SparkSession, prices_root: str, country: str, day: dt.date, database: str) -> None:
    """The price file of the day into the price table, once."""
    rows, files = read_prices(spark, price_file(prices_root, country, day), country)
    rejected = files.where("reason is not null").first()
    if rejected is not None:
        raise DataCheckError(f"the price file was rejected: {rejected.reason}")
    check_single_date(rows, day)
    tables.ensure_database(spark, database)
    tables.put_if_absent(rows, f"{database}.{PRICES}", given={"country": country, "date": day})


def run_day(
    spark: SparkSession, country: str, day: str | dt.date, database: str, prices_root: str, scraped_root: str,
    threshold: float = 0.40, days: int = 15, rules: NameRules | None = None, scoring: Scoring = Scoring(),
) -> DailyResult:
    """Load the prices, match the scrape files not yet matched, append the matches."""
    day = as_date(day)
    load_prices(spark, prices_root, country, day, database)
    as_of: Column = F.lit(day)
    catalog = catalog_names(spark.table(f"{database}.{PRICES}"), spark.table(f"{database}.{MASTER}"), as_of, days, country)
    folder = f"{scraped_root}/{day:%d-%m-%y}"
    require_files(list_files(spark, folder, "*.txt"), f"there are no scrape files for {day}")
    processed = tables.processed_competitors(spark, f"{database}.{MATCHES}", country, day)
    scan = read_scraped(spark, folder, processed=processed)
    rows = scan.rows.where(F.col("country") == country)
    check_not_empty(rows, f"no scrape data to process for {day}")
    matched = cut_lineage(match_day(rows, catalog, threshold, rules, scoring).select(*rows.columns, "sku", "confidence"))
    tables.put_rows(matched, f"{database}.{MATCHES}", ("country", "date", "competitor_name"))
    return DailyResult(matched, scan.files)
