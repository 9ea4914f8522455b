"""Table-level checks and profiles; each is one aggregation."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.fields import COUNTRIES


class DataCheckError(ValueError):
    """A check a job cannot go on without has failed."""


def date_summary(df: DataFrame, column: str = "date") -> DataFrame:
    """n_dates (different ones), first_date, last_date; dates are grouped before they are counted."""
    dates = df.groupBy(F.col(column).alias("date")).agg(F.count("*").alias("n"))
    return dates.agg(F.count("date").alias("n_dates"), F.min("date").alias("first_date"), F.max("date").alias("last_date"))


def check_single_date(df: DataFrame, day: dt.date, column: str = "date") -> None:
    """Exactly one date, and the requested one."""
    row = date_summary(df, column).first()
    if row.n_dates != 1 or row.first_date != day:
        raise DataCheckError(f"expected the single date {day}, found {row.n_dates}, {row.first_date} to {row.last_date}")


def duplicate_keys(df: DataFrame, *keys: str) -> DataFrame:
    """Key values that occur more than once, with their count."""
    return df.groupBy(*keys).agg(F.count("*").alias("n")).where("n > 1")


def check_unique(df: DataFrame, *keys: str) -> None:
    if not duplicate_keys(df, *keys).isEmpty():
        raise DataCheckError(f"duplicate values of {', '.join(keys)}")


def valid_country(col: Column) -> Column:
    return col.isin(COUNTRIES)


def check_columns(df: DataFrame, required: list[str]) -> None:
    missing = [c for c in required if c not in df.columns]
    if missing:
        raise DataCheckError(f"missing columns: {', '.join(missing)}")


def check_not_empty(df: DataFrame, message: str) -> None:
    if df.isEmpty():
        raise DataCheckError(message)


def null_profile(df: DataFrame, *columns: str) -> DataFrame:
    """column_name, n_rows, n_not_null, n_null of every column, from one pass."""
    columns = columns or tuple(df.columns)
    counted = df.agg(F.count("*").alias("n_rows"), *[F.count(F.col(c)).alias(f"c{i}") for i, c in enumerate(columns)])
    entries = F.array(*[
        F.struct(F.lit(c).alias("column_name"), F.col(f"c{i}").alias("n_not_null")) for i, c in enumerate(columns)
    ])
    return (
        counted.select("n_rows", F.explode(entries).alias("e"))
        .select("e.column_name", "n_rows", "e.n_not_null", (F.col("n_rows") - F.col("e.n_not_null")).alias("n_null"))
    )


def omit_profile(df: DataFrame, column: str) -> DataFrame:
    """How many values are zero or less, null, both, and the percentage of all rows."""
    zero, null = F.count_if(F.col(column) <= 0), F.count_if(F.col(column).isNull())
    return df.agg(F.count("*").alias("n_rows"), zero.alias("n_zero"), null.alias("n_null")).select(
        "n_rows", "n_zero", "n_null",
        (F.col("n_zero") + F.col("n_null")).alias("n_omit"),
        ((F.col("n_zero") + F.col("n_null")) * 100 / F.col("n_rows")).alias("pct_omit"),
    )


def drop_unpriced(df: DataFrame, name: str, price: str) -> DataFrame:
    """Rows with a name and a price above zero."""
    return df.where(F.col(name).isNotNull() & (F.col(price) > 0))
