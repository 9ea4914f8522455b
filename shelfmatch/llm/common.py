"""Helpers that several operators share."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

_CLEAN_UP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def work_folder(spark: SparkSession, name: str) -> str:
    """A new folder that driver and executors share: under ``spark.checkpoint.dir``, or the warehouse where that is unset."""
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.sql.warehouse.dir")
    return f"{root.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once to the shared folder and go on from the files; later failures do not compute it again.

    The shuffle files of the job are removed when it is done, as nothing needs them any more.
    """
    spark = df.sparkSession
    folder = work_folder(spark, name)
    before = spark.conf.get(_CLEAN_UP, None)
    spark.conf.set(_CLEAN_UP, "true")
    try:
        df.write.option("compression", "zstd").parquet(folder)
    finally:
        if before is None:
            spark.conf.unset(_CLEAN_UP)
        else:
            spark.conf.set(_CLEAN_UP, before)
    return spark.read.schema(df.schema).parquet(folder)


def text_of(docs: DataFrame) -> Column:
    """The text, empty for null."""
    return F.coalesce(docs["text"], F.lit(""))


def text_key(text: Column) -> Column:
    """128 bits that stand for a text."""
    return F.unhex(F.md5(text))


def free_name(docs: DataFrame, name: str) -> str:
    """``name``, with underscores in front of it until no column of ``docs`` is called so."""
    taken = {c.lower() for c in docs.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def text_array(column: pa.Array) -> pa.Array:
    """A text column as an array with 64-bit offsets, whatever its length."""
    return column.cast(pa.large_string())


def slices(values: np.ndarray, bounds: np.ndarray) -> pa.Array:
    """A binary array of the stretches of ``values`` between neighbouring ``bounds``."""
    width = values.dtype.itemsize
    return pa.Array.from_buffers(pa.large_binary(), len(bounds) - 1, [None, pa.py_buffer((bounds * width).astype(np.int64)), pa.py_buffer(np.ascontiguousarray(values))]).cast(pa.binary())


_POWER = np.uint64(0x9E3779B97F4A7C15)
#: What each byte stands for in the hash of a word.
_SPELLING = np.random.default_rng(7).integers(0, (1 << 64) - 1, 256, np.uint64, endpoint=True)


def spelled(words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all words one after the other, and where each word's begin (and the end)."""
    _, bounds, data = words.buffers()
    if not len(words):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    bounds = np.frombuffer(bounds, np.int64)[words.offset : words.offset + len(words) + 1]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[bounds[0] : bounds[-1]], bounds - bounds[0]


def word_hashes(words: pa.Array) -> np.ndarray:
    """64 bits for each word, by the bytes in it; computed in arrays, as there may be a hundred thousand in a few megabytes."""
    data, bounds = spelled(words)
    sizes = np.diff(bounds)
    powers = np.cumprod(np.full(int(sizes.max(initial=0)) + 1, _POWER))
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_SPELLING[data] * powers[np.arange(len(data)) - np.repeat(bounds[:-1], sizes)], out=sums[1:])
    h = sums[bounds[1:]] - sums[bounds[:-1]]
    h = (h ^ (h >> np.uint64(31))) * _POWER
    return h ^ (h >> np.uint64(29))


#: Rows of a table of a few numbers that a join may send to every task.
SMALL_ROWS = 100_000


def small_side(df: DataFrame, name: str) -> DataFrame:
    """``df``, written once, to be joined: sent to every task if it has few rows, left to the planner if not."""
    df = staged(df, name)
    return F.broadcast(df) if df.count() <= SMALL_ROWS else df


#: Bytes of a batch whose values are Python objects at a time.
AT_ONCE = 2 << 20


Batches = Iterator[pa.RecordBatch]


def lean(fn: Callable[[Batches], Batches]) -> Callable[[Batches], Batches]:
    """A mapInArrow function whose worker gives freed memory back after each batch; it would keep it over all its later tasks."""

    def run(batches):
        def each():
            for b in batches:
                yield b
                del b
                pa.default_memory_pool().release_unused()

        return fn(each())

    return run


def in_parts(batches: Batches) -> Batches:
    """The batches in slices of about ``AT_ONCE`` bytes."""
    for b in batches:
        rows = max(1, b.num_rows * AT_ONCE // max(AT_ONCE, b.nbytes))
        for k in range(0, b.num_rows, rows):
            yield b.slice(k, rows)


def by_batch(fn: Callable[..., dict], schema: pa.Schema) -> Callable[[Batches], Batches]:
    """A mapInArrow function from one that takes the columns of a batch as lists and returns columns; row by row, so batches go in parts."""

    def run(batches):
        for b in in_parts(batches):
            out = fn(*(c.to_pylist() for c in b.columns))
            yield pa.RecordBatch.from_arrays([pa.array(out[f.name], f.type) for f in schema], schema=schema)

    return lean(run)


def table(schema: pa.Schema, **columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(columns[f.name], f.type) for f in schema], schema=schema)


def links_to_roots(links: DataFrame, rounds: int = 60) -> DataFrame:
    """Connected components of ``links`` (a, b): a row (node, root) for each node, root the smallest of its component.

    Alternates two steps until nothing changes: every node's larger neighbours are tied to its smallest
    neighbour, then the smaller ones are.  A step is a grouping and a join, so no component meets in one
    task, and long chains shrink by half or more in a round.  Each round is cut by ``checkpoint()``.
    """
    spark = links.sparkSession
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(spark.conf.get("spark.checkpoint.dir", None) or work_folder(spark, "checkpoint"))

    def tie(edges: DataFrame, larger: bool) -> DataFrame:
        both = edges.select(F.col("a").alias("n"), F.col("b").alias("m"))
        if larger:
            both = both.union(edges.select("b", "a"))
        low = both.groupBy("n").agg(F.least(F.min("m"), F.first("n")).alias("low"))
        tied = both.join(low, "n")
        if larger:
            out = tied.where("m > n").select(F.col("m").alias("a"), F.col("low").alias("b"))
        else:
            out = tied.select(F.col("m").alias("a"), F.col("low").alias("b")).union(low.select("n", "low"))
        return out.where("a != b").distinct()

    edges = links.where("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct().checkpoint()
    before = None
    for _ in range(rounds):
        edges = tie(tie(edges, larger=True), larger=False).checkpoint()
        now = edges.agg(F.count("*"), F.sum(F.hash("a", "b").cast("long")), F.bit_xor(F.xxhash64("a", "b"))).first()
        if now == before:
            break
        before = now
    else:
        raise RuntimeError(f"components did not settle in {rounds} rounds")
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).union(edges.select("b", "b").distinct())
