"""CSV lists of the first version, and the expected matches of a test set."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# The columns kept of a CSV scrape.
CSV_COLUMNS = ["Store", "Category", "Price", "Quantity", "Url"]


def read_csv_strings(spark: SparkSession, path: str | list[str], columns: list[str] | None = None, exclude: tuple[str, ...] = (), pattern: str = "*.csv") -> DataFrame:
    """CSV files with a header, every field a string; files whose name holds a mark are skipped."""
    df = spark.read.option("pathGlobFilter", pattern).csv(path, header=True, inferSchema=False, encoding="utf-8")
    for mark in exclude:
        df = df.where(~F.col("_metadata.file_name").contains(mark))
    columns = columns or CSV_COLUMNS
    return df.select(*columns, F.col("_metadata.file_name").alias("file_name"))


def keep_state(df: DataFrame, source: Column, state: str, wanted: str) -> DataFrame:
    """Rows of the given source only where ``state`` is the wanted one; other rows as they are."""
    return df.where(~source | F.coalesce(F.col(state) == wanted, F.lit(False)))


def price_from_unit(df: DataFrame, by: str, price: str = "Price", unit_price: str = "Unit_price", limit: int = 100,
                    store: str | None = None, store_name: str | None = None) -> DataFrame:
    """Take the unit price, and set the store name if one is given, in sources where more than ``limit`` prices are missing."""
    gaps = df.groupBy(by).agg(F.count_if(F.col(price).isNull()).alias("_gaps"))
    new = {price: F.when(F.col("_gaps") > limit, F.col(unit_price)).otherwise(F.col(price))}
    if store is not None:
        new[store] = F.when(F.col("_gaps") > limit, F.lit(store_name)).otherwise(F.col(store))
    return df.join(gaps, by).withColumns(new).drop("_gaps")


def read_expected(spark: SparkSession, path: str) -> DataFrame:
    """own_name, key, competitor_name, expected, op of ``{own: {key: [name, value, op]}}`` files."""
    doc = F.from_json("value", "map<string,map<string,array<string>>>")
    return (
        spark.read.text(path, wholetext=True)
        .select(F.explode(doc).alias("own_name", "pairs"))
        .select("own_name", F.explode("pairs").alias("key", "v"))
        .select(
            "own_name", "key",
            F.get("v", F.lit(0)).alias("competitor_name"),
            F.get("v", F.lit(1)).cast("double").alias("expected"),
            F.get("v", F.lit(2)).alias("op"),
        )
    )
