"""File listings as DataFrames: facts that the file names and sizes carry."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.dates import parse_two_formats, week_of_year


def competitor_of(file_name: Column) -> Column:
    """Text behind the last dash of a scrape file, without ``.txt``."""
    return F.replace(F.element_at(F.split(file_name, "-"), -1), F.lit(".txt"), F.lit(""))


def country_of(file_name: Column) -> Column:
    """First two characters of a price file."""
    return F.substring(file_name, 1, 2)


def date_prefix_of(file_name: Column) -> Column:
    return F.substring(file_name, 1, 8)


def list_files(spark: SparkSession, path: str | list[str], pattern: str = "*") -> DataFrame:
    """file, file_name, file_size of every file; the contents are not read."""
    return (
        spark.read.format("binaryFile").option("pathGlobFilter", pattern).load(path)
        .select(
            F.col("_metadata.file_path").alias("file"),
            F.col("_metadata.file_name").alias("file_name"),
            F.col("length").alias("file_size"),
        )
    )


def require_files(files: DataFrame, message: str) -> DataFrame:
    """The listing itself, or an error when it is empty."""
    if files.isEmpty():
        raise FileNotFoundError(message)
    return files


def exclude_files(files: DataFrame, *marks: str, column: str = "file_name") -> DataFrame:
    """Drop files whose name contains one of the marks."""
    for mark in marks:
        files = files.where(~F.col(column).contains(mark))
    return files


def available_dates(names: DataFrame, column: str = "file_name") -> DataFrame:
    """date, str_date, week_num of the distinct date prefixes that parse in one of two formats."""
    date = parse_two_formats(date_prefix_of(F.col(column)))
    return (
        names.select(date.alias("date")).where("date is not null").distinct()
        .select("date", F.date_format("date", "dd-MM-yy").alias("str_date"), week_of_year(F.col("date")).alias("week_num"))
    )


def nth_date(dates: DataFrame, n: int) -> DataFrame:
    """The n-th date (from 1) in ascending order; a top-n, not a full sort in one task."""
    return dates.orderBy("date").offset(n - 1).limit(1)
