"""Scan of price files (parquet, one country and day per file)."""

from __future__ import annotations

import datetime as dt
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.fields import COUNTRIES, strip_zeros
from ..functions.rounding import round_scaled
from .listing import country_of

# The columns a price file must have.
PRICE_COLUMNS = ["date", "region_name", "sku", "sku_name", "price"]


class Scan(NamedTuple):
    """Clean rows, and one report row per file."""

    rows: DataFrame
    files: DataFrame


def price_file(root: str, country: str, day: dt.date) -> str:
    """``<root>/<country>/<country>-YYYY-dd-mm.parquet``: the day comes before the month."""
    return f"{root}/{country}/{country}-{day:%Y-%d-%m}.parquet"


def clean_prices(raw: DataFrame, country: Column, keys: list[str], order: Column) -> DataFrame:
    """Typed and deduplicated prices: first row per (keys, date, sku, region), then no nulls.

    ``order`` says which of several equal rows comes first.
    """
    typed = raw.select(
        *keys,
        country.alias("country"),
        F.col("date").try_cast("date").alias("date"),
        F.col("region_name"),
        strip_zeros(F.col("sku")).alias("sku"),
        F.struct("sku_name", round_scaled(F.col("price").try_cast("double"), 2).alias("price")).alias("rest"),
        order.alias("_order"),
    )
    return (
        typed.groupBy(*keys, "country", "date", "sku", "region_name")
        .agg(F.min_by("rest", "_order").alias("rest"))
        .select("country", "date", "region_name", "sku", "rest.sku_name", "rest.price")
        .dropna("any")
    )


def read_prices(spark: SparkSession, path: str | list[str], country: str | None = None) -> Scan:
    """All price files under ``path`` in one scan.

    A file is rejected as a whole when its country is unknown or a date or a
    price in it does not parse; ``files`` says why.
    """
    raw = spark.read.parquet(*([path] if isinstance(path, str) else path))
    missing = [c for c in PRICE_COLUMNS if c not in raw.columns]
    if missing:
        raise ValueError(f"required columns were not found: {', '.join(missing)}")
    raw = raw.select(
        *PRICE_COLUMNS,
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_name").alias("file_name"),
        F.col("_metadata.row_index").alias("row_index"),
    )
    code = country_of(F.col("file_name")) if country is None else F.lit(country)
    bad_date = F.col("date").isNotNull() & F.col("date").try_cast("date").isNull()
    bad_price = F.col("price").isNotNull() & F.col("price").try_cast("double").isNull()
    files = (
        raw.groupBy("file", code.alias("country"))
        .agg(
            F.count("*").alias("n_rows"),
            F.count_if(bad_date).alias("n_bad_dates"),
            F.count_if(bad_price).alias("n_bad_prices"),
        )
        .withColumn(
            "reason",
            F.when(~F.col("country").isin(COUNTRIES), "invalid country")
            .when(F.col("n_bad_dates") > 0, "bad date")
            .when(F.col("n_bad_prices") > 0, "bad price"),
        )
    )
    kept = raw.join(files.where("reason is null").select("file"), "file", "left_semi")
    return Scan(clean_prices(kept, code, ["file"], F.col("row_index")), files)
