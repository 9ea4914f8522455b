"""Table scans and sinks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.lineage import cut_to_files

_OVERWRITE = "spark.sql.sources.partitionOverwriteMode"


def ensure_database(spark: SparkSession, database: str) -> None:
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")


def append_table(df: DataFrame, table: str, partition_by: tuple[str, ...] = ("country", "date"), fmt: str = "parquet") -> None:
    """Append to a table, created on first use; partitioned so that a day is pruned, not scanned.

    The rows of one partition are brought together over many tasks, not one: AQE
    splits a partition that is too large (rebalance).
    """
    if partition_by:
        df = df.hint("rebalance", *[F.col(c) for c in partition_by])
    df.write.format(fmt).mode("append").partitionBy(*partition_by).saveAsTable(table)


def put_rows(df: DataFrame, table: str, partition_by: tuple[str, ...] = ("country", "date"), fmt: str = "parquet") -> None:
    """Add rows so that adding them again changes nothing: each partition is written as a whole or not at all.

    Rows that the partitions concerned hold already, and that are not among the new ones, are kept.  The new partitions
    are staged beside the table and moved into place one by one; a job that is killed leaves every partition
    as it was or as it is to be, and may simply run again.
    """
    spark = df.sparkSession
    if not spark.catalog.tableExists(table):
        df.limit(0).write.format(fmt).partitionBy(*partition_by).saveAsTable(table)
    old = spark.table(table)
    found = tuple(c.name for c in spark.catalog.listColumns(table) if c.isPartition)
    if found != partition_by:
        raise ValueError(f"{table} is partitioned by {', '.join(found) or 'nothing'}, not by {', '.join(partition_by)}")
    df = cut_to_files(df.select(*old.columns))
    wanted = df.select(*partition_by).distinct()
    keys = [wanted[c].eqNullSafe(old[c]) for c in partition_by]
    held = old.join(wanted, keys, "left_semi")
    # rows of new partitions only are complete as they are
    if not held.isEmpty():
        # written down first: a table cannot be read while it is overwritten
        df = cut_to_files(df.unionByName(held.exceptAll(df)))
    rows = df.hint("rebalance", *[F.col(c) for c in partition_by])
    before = spark.conf.get(_OVERWRITE, None)
    spark.conf.set(_OVERWRITE, "dynamic")
    try:
        rows.write.mode("overwrite").insertInto(table)
    finally:
        spark.conf.unset(_OVERWRITE) if before is None else spark.conf.set(_OVERWRITE, before)


def put_if_absent(df: DataFrame, table: str, keys: tuple[str, ...] = ("country", "date"), fmt: str = "parquet",
                  given: dict[str, object] | None = None) -> None:
    """``insert_if_absent`` by whole partitions: the keys are those of the partitions."""
    if df.sparkSession.catalog.tableExists(table):
        df = absent_rows(df, df.sparkSession.table(table), keys, given)
    put_rows(df, table, keys, fmt)


def write_bucketed(df: DataFrame, table: str, key: str, buckets: int, fmt: str = "parquet") -> None:
    """Write a table dealt and sorted by a key: joins of such tables on the key, with as many buckets, need no shuffle.

    Every bucket is one file per task, so the rows are brought together by the key first.
    """
    dealt = df.repartition(buckets, key)
    dealt.write.format(fmt).mode("overwrite").bucketBy(buckets, key).sortBy(key).saveAsTable(table)


def insert_if_absent(df: DataFrame, table: str, keys: tuple[str, ...] = ("country", "date"), fmt: str = "parquet",
                     given: dict[str, object] | None = None) -> None:
    """Append the rows whose key combination is not in the table yet; ``given`` as in ``absent_rows``."""
    spark = df.sparkSession
    if spark.catalog.tableExists(table):
        df = absent_rows(df, spark.table(table), keys, given)
    append_table(df, table, keys, fmt)


def absent_rows(df: DataFrame, existing: DataFrame, keys: tuple[str, ...] = ("country", "date"), given: dict[str, object] | None = None) -> DataFrame:
    """Rows of ``df`` whose keys do not occur in ``existing``.

    ``given``: key values that all rows of ``df`` have; only these partitions of ``existing`` are read.
    """
    for column, value in (given or {}).items():
        existing = existing.where(F.col(column) == F.lit(value))
    return df.join(existing.select(*keys).distinct(), list(keys), "left_anti")


def processed_competitors(spark: SparkSession, table: str, country: str, day) -> DataFrame | None:
    """Competitors already matched for the country and day; None before the first run."""
    if not spark.catalog.tableExists(table):
        return None
    return (
        spark.table(table)
        .where((F.col("country") == country) & (F.col("date") == F.lit(day)))
        .select("competitor_name").distinct()
    )


def write_parquet(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    df.write.mode(mode).parquet(path)


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    df.write.mode(mode).option("header", True).csv(path)
