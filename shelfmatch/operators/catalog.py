"""The own catalogue: look-back, newest name, duplicates, sizes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.dates import in_lookback


def lookback(prices: DataFrame, as_of: Column, days: int = 15, country: str | None = None) -> DataFrame:
    """Prices of the last ``days`` days; the filter reaches the scan (and the partitions)."""
    recent = prices.where(in_lookback(F.col("date"), as_of, days))
    return recent if country is None else recent.where(F.col("country") == country)


def in_master(prices: DataFrame, master: DataFrame) -> DataFrame:
    """Rows whose (country, sku) the master catalogue lists."""
    return prices.join(master.select("country", "sku"), ["country", "sku"], "left_semi")


def newest_names(prices: DataFrame) -> DataFrame:
    """One name per (country, sku): of the newest date, the first in name order."""
    newest = F.struct((-F.unix_date("date")).alias("d"), F.col("sku_name"))
    return (
        prices.groupBy("country", "sku")
        .agg(F.min(newest).alias("n"))
        .select("country", "sku", "n.sku_name")
    )


def catalog_names(prices: DataFrame, master: DataFrame, as_of: Column, days: int = 15, country: str | None = None) -> DataFrame:
    """country, sku, sku_name of the catalogue to match against."""
    return newest_names(in_master(lookback(prices, as_of, days, country), master))


def dedup_first(df: DataFrame, keys: list[str], order: Column) -> DataFrame:
    """One row per key, the first by ``order`` (which must be total for a fixed result)."""
    rest = [c for c in df.columns if c not in keys]
    picked = df.groupBy(*keys).agg(F.min_by(F.struct(*rest), order).alias("r"))
    return picked.select(*keys, "r.*").select(*df.columns)


def row_key(*columns: str) -> Column:
    """A stable surrogate id: the same content, nulls and their places included, has the same id in every run."""
    return F.sha2(F.to_json(F.struct(*columns), {"ignoreNullFields": "false"}), 256)


def evaluation_size(left: DataFrame, right: DataFrame) -> DataFrame:
    """n_left, n_right and their product, the number of evaluations; two counts, no pairing."""
    both = left.agg(F.count("*").alias("n")).select(F.lit("l").alias("s"), "n").unionByName(
        right.agg(F.count("*").alias("n")).select(F.lit("r").alias("s"), "n")
    )
    return both.agg(
        F.max(F.when(F.col("s") == "l", F.col("n"))).alias("n_left"),
        F.max(F.when(F.col("s") == "r", F.col("n"))).alias("n_right"),
    ).withColumn("n_evals", F.col("n_left") * F.col("n_right"))


def geo_mean(col: Column) -> Column:
    """Geometric mean through logarithms, which cannot overflow."""
    return F.exp(F.avg(F.log(col)))


def with_group_max(df: DataFrame, keys: list[str], column: str, target: str) -> DataFrame:
    """Add the largest value of every key.  Aggregated before the shuffle and joined
    back, so a hot key does not end up in one window task."""
    return df.join(df.groupBy(*keys).agg(F.max(column).alias(target)), keys)


def sample_rows(df: DataFrame, n: int, *keys: str, seed: int = 0) -> DataFrame:
    """``n`` rows at random, always the same ones for the same rows and seed, however they are partitioned.

    They are the rows of smallest md5 of their key columns, so a top-n: every task keeps n rows at most.
    """
    order = F.md5(F.concat_ws("|", F.lit(str(seed)), *[F.coalesce(F.col(k).cast("string"), F.lit("")) for k in keys]))
    return df.orderBy(order, *keys).limit(n)
