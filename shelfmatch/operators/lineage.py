"""Cutting a lineage through the shared checkpoint folder of the cluster."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession


def work_folder(spark: SparkSession, name: str) -> str:
    """A new folder under ``spark.checkpoint.dir``, or the warehouse of a session that names none."""
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.sql.warehouse.dir")
    return f"{root.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def cut_lineage(df: DataFrame) -> DataFrame:
    """Write ``df`` once to the reliable checkpoint folder and read it from there.

    The folder is the one in ``spark.checkpoint.dir``.  A session that names none, as on a single machine, uses one in
    its warehouse; on a cluster the setting must name a folder that driver and executors share.
    """
    spark = df.sparkSession
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        shared = spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_checkpoints"
        sc.setCheckpointDir(spark.conf.get("spark.checkpoint.dir", None) or shared)
    return df.checkpoint()


def cut_to_files(df: DataFrame) -> DataFrame:
    """``df`` written once as compressed files to the work folder and read from there: for many plain rows.

    These are a fraction of what a checkpoint of the rows takes, and filters and columns are read from them selectively.
    """
    folder = work_folder(df.sparkSession, "rows")
    df.write.option("compression", "zstd").parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)
