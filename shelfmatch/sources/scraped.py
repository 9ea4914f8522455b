"""Scan of scraped product lists: text files with a header and a long separator.

The files are read as lines, so a large file is split over many tasks.  One pass finds the headers (the first line of
a file's first block), a second one splits and cleans all lines and writes them down with the reason why a line is
dropped; the rows, the dropped lines and the report of every file are read from there.
"""

from __future__ import annotations

import re
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, DoubleType, StringType, StructField, StructType

from ..functions import fields as C
from ..functions.dates import parse_dmy
from ..operators.lineage import cut_lineage
from .listing import competitor_of, list_files

SEPARATOR = "<s>"
MIN_BYTES = 300

# Columns a scrape file must have; the last three are used without
# being declared required by the file layout.
REQUIRED = ["name", "company", "url", "price", "date", "zone", "type", "country"]
OPTIONAL = ["quantity", "specialPrice"]

SCRAPED_SCHEMA = StructType([
    StructField("type", StringType(), False),
    StructField("country", StringType(), False),
    StructField("locality", StringType(), False),
    StructField("date", DateType(), False),
    StructField("competitor_name", StringType()),
    StructField("competitor_sku_name", StringType()),
    StructField("competitor_price", DoubleType()),
    StructField("special_price", DoubleType()),
    StructField("competitor_url", StringType()),
    StructField("gift_or_extra_prod", StringType()),
])


class ScrapedScan(NamedTuple):
    """Clean rows, one report row per file, and the rows dropped with their reason."""

    rows: DataFrame
    files: DataFrame
    dropped: DataFrame


def clean_scraped(raw: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """Fields of a scrape (all text) to typed fields, and ``reason`` where a row is to be dropped."""
    keep = keep or []
    product, gift = C.split_gift(F.coalesce(F.col("name"), F.lit("nan")))
    parsed = raw.select(
        *keep,
        F.col("type"),
        F.col("country"),
        C.replace_zone(F.col("zone")).alias("locality"),
        parse_dmy(F.col("date")).alias("date"),
        F.col("company").alias("competitor_name"),
        C.with_quantity(C.check_name(product), F.col("quantity")).alias("competitor_sku_name"),
        C.parse_price(F.col("price")).alias("competitor_price"),
        C.parse_price(F.col("specialPrice")).alias("special_price"),
        C.check_url(F.col("url")).alias("competitor_url"),
        gift.alias("gift_or_extra_prod"),
    )
    must = F.col("type").isNull() | F.col("country").isNull() | F.col("locality").isNull()
    reason = (
        F.when(F.col("competitor_sku_name").isNull(), "bad name")
        .when(F.col("competitor_price").isNull(), "bad price")
        .when(F.col("date").isNull(), "bad date")
        .when(must, "missing type, country or zone")
    )
    return parsed.withColumn("reason", reason)


def split_lines(lines: DataFrame, sep: str = SEPARATOR) -> DataFrame:
    """Lines with their ``header`` to the named fields; ``too_long`` marks lines with surplus fields."""
    tokens = F.split(F.col("line"), sep, -1)

    def field(name: str) -> Column:
        value = F.get(F.col("tokens"), F.array_position("header", name).cast("int") - 1)
        return C.missing_to_null(value).alias(name)

    return (
        lines.withColumn("tokens", tokens)
        .withColumn("too_long", F.size("tokens") > F.size("header"))
        .select("file", "file_name", "too_long", *[field(c) for c in REQUIRED + OPTIONAL])
    )


def read_headers(lines: DataFrame, sep: str = SEPARATOR) -> DataFrame:
    """file, header: the first line that is not blank of the first block of every file."""
    first = (
        lines.where("block_start = 0 and line != ''")
        .withColumn("_at", F.monotonically_increasing_id())
        .groupBy("file")
        .agg(F.min_by("line", "_at").alias("header_line"))
    )
    header = F.split(F.regexp_replace("header_line", "^﻿", ""), sep, -1)
    return first.select("file", "header_line", header.alias("header"))


def read_scraped(
    spark: SparkSession,
    path: str | list[str],
    sep: str = SEPARATOR,
    min_bytes: int = MIN_BYTES,
    pattern: str = "*.txt",
    processed: DataFrame | None = None,
) -> ScrapedScan:
    """All scrape files under ``path``.  ``processed`` (competitor_name) names files to skip."""
    listing = list_files(spark, path, pattern)
    lines = spark.read.option("pathGlobFilter", pattern).text(path).select(
        F.regexp_replace("value", r"(?U)^\s+|\s+$", "").alias("line"),
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_name").alias("file_name"),
        F.col("_metadata.file_size").alias("file_size"),
        F.col("_metadata.file_block_start").alias("block_start"),
    )
    if processed is not None:
        done = processed.select(F.col("competitor_name").alias("_done")).distinct()
        listing = listing.join(done, competitor_of(F.col("file_name")) == F.col("_done"), "left_anti")
        lines = lines.join(done, competitor_of(F.col("file_name")) == F.col("_done"), "left_anti")
    big_enough = lines.where(F.col("file_size") > min_bytes)
    headers = cut_lineage(read_headers(big_enough, sep))
    required = F.array(*[F.lit(c) for c in REQUIRED])
    checked = headers.withColumn("missing", F.array_except(required, F.col("header")))
    good = checked.where(F.size("missing") == 0).select("file", "header_line", "header")
    data = big_enough.join(good, "file").where("line != '' and line != header_line")
    fields = split_lines(data.select("file", "file_name", "line", "header"), sep)
    cleaned = clean_scraped(fields, ["file", "file_name", "too_long"]).withColumn(
        "reason", F.when(F.col("too_long"), "too many fields").otherwise(F.col("reason"))
    )
    cleaned = cut_lineage(cleaned)
    rows = cleaned.where("reason is null").select(*SCRAPED_SCHEMA.fieldNames())
    counts = cleaned.groupBy("file").agg(
        F.count("*").alias("n_rows"),
        F.count_if(F.col("reason").isNull()).alias("n_kept"),
        F.count_if(~F.col("too_long") & (F.col("competitor_sku_name").isNotNull())).alias("n_names"),
    )
    reason = (
        F.when(F.col("file_size") <= min_bytes, "empty or not a valid file")
        .when(F.col("missing").isNull(), "no header")
        .when(F.size("missing") > 0, F.concat(F.lit("missing columns: "), F.array_join("missing", ", ")))
        .when(F.coalesce("n_names", F.lit(0)) == 0, "incorrect name values")
        .when(F.col("n_kept") == 0, "incorrect price values")
    )
    files = (
        listing.join(checked.select("file", "missing"), "file", "left")
        .join(counts, "file", "left")
        .select(
            "file", "file_name", competitor_of(F.col("file_name")).alias("competitor"), "file_size",
            F.coalesce("n_rows", F.lit(0)).alias("n_rows"), F.coalesce("n_kept", F.lit(0)).alias("n_kept"),
            reason.alias("reason"),
        )
    )
    dropped = cleaned.where("reason is not null").select("file", "reason", *SCRAPED_SCHEMA.fieldNames())
    return ScrapedScan(rows, files, dropped)


def separator_pattern(text: str) -> str:
    """A literal separator as the pattern ``read_scraped`` takes."""
    return re.escape(text)
