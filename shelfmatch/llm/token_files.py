"""Token ids in a compact binary format: frequency-ranked ids, byte-aligned, control bytes apart.

Ids are numbered anew by how often the corpus uses them (0 the most frequent), so that most take one byte.  Four
numbers share a control byte with two bits each for their lengths in bytes; control bytes and data bytes of a block
are separate byte strings.  Decoding takes the lengths of four numbers at a time from a table by control byte.

A file holds blocks of whole documents in ascending doc_id (null first); blocks are rows of Parquet files that
Spark's committer publishes, so a lost executor leaves nothing half-written.  The rank table is a file of its own.

Nulls and empty texts give the end id alone.  Repeated rows are encoded each; their order among themselves is open.
An empty table gives empty files.  Other columns of ``docs`` are not read.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import lean, slices, staged, table, text_array, text_of
from .tokens import encoder

#: Ids in a block, about; a document is never split.
BLOCK_IDS = 1 << 18

#: For each control byte, how many bytes each of its four numbers has behind the first.
_MORE = (np.arange(256)[:, None] >> np.array([0, 2, 4, 6]) & 3).astype(np.uint8)


def _places(more: np.ndarray) -> np.ndarray:
    """Where in the data each number begins (and the end)."""
    return np.concatenate(([0], np.cumsum(more, dtype=np.int64) + np.arange(1, len(more) + 1)))


def encode_numbers(x: np.ndarray) -> tuple[bytes, bytes]:
    """(control bytes, data bytes) of unsigned 32-bit numbers."""
    x = np.ascontiguousarray(x, "<u4")
    more = (x > 0xFF).astype(np.uint8) + (x > 0xFFFF) + (x > 0xFFFFFF)
    at = _places(more)
    data = np.empty(int(at[-1]), np.uint8)
    data[at[:-1]] = x.astype(np.uint8)
    for k in (1, 2, 3):
        has = np.flatnonzero(more >= k)
        data[at[has] + k] = (x[has] >> np.uint32(8 * k)).astype(np.uint8)
    four = np.zeros(-(-len(x) // 4) * 4, np.uint8)
    four[: len(x)] = more
    control = four.reshape(-1, 4) << np.array([0, 2, 4, 6], np.uint8)
    return np.bitwise_or.reduce(control, axis=1).tobytes(), data.tobytes()


def decode_numbers(control: bytes, data: bytes, n: int) -> np.ndarray:
    more = _MORE[np.frombuffer(control, np.uint8)].reshape(-1)[:n]
    at, data = _places(more)[:-1], np.frombuffer(data, np.uint8)
    out = data[at].astype("<u4")
    for k in (1, 2, 3):
        has = np.flatnonzero(more >= k)
        out[has] |= data[at[has] + k].astype("<u4") << np.uint32(8 * k)
    return out


def numbers(column: pa.Array, width: str = "<u4") -> tuple[np.ndarray, np.ndarray]:
    """Where each row's numbers begin (and the end), and all rows' numbers, of a binary column."""
    sizes = pc.binary_length(column).to_numpy(zero_copy_only=False).astype(np.int64) // np.dtype(width).itemsize
    raw = column.buffers()[2]
    first = column.buffers()[1]
    at = int(np.frombuffer(first, "<i4", 1, 4 * column.offset)[0]) if len(column) else 0
    bounds = np.concatenate(([0], np.cumsum(sizes)))
    return bounds, np.frombuffer(raw, width, int(bounds[-1]), at) if bounds[-1] else np.zeros(0, width)


def token_ids(docs: DataFrame, path: str, end_id: int | None = 0, width: str = "<u4") -> DataFrame:
    """doc_id and ``ids``: little-endian unsigned ids of the whole text, then ``end_id``."""
    schema = pa.schema([("doc_id", pa.int64()), ("ids", pa.binary())])

    def run(batches):
        parts = encoder(path).parts
        for b in batches:
            for first, flat, bounds in parts(text_array(b.column(1))):
                if end_id is not None:
                    flat, bounds = np.insert(flat, bounds[1:], end_id), bounds + np.arange(len(bounds))
                yield table(schema, doc_id=b.column(0).slice(first, len(bounds) - 1), ids=slices(flat.astype(width), bounds))

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of(docs).alias("text")).mapInArrow(lean(run), "doc_id long, ids binary")


def frequency_ranks(tokens: DataFrame, width: str = "<u4") -> np.ndarray:
    """The corpus's ids, most frequent first (ties: smaller id).  As long as the vocabulary, whatever the corpus."""

    def count(batches):
        total = np.zeros(0, np.int64)
        for b in batches:
            n = np.bincount(numbers(b.column(0), width)[1])
            if len(n) < len(total):
                n, total = total, n
            n[: len(total)] += total
            total = n
        ids = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(ids), pa.array(total[ids])], names=["id", "n"])

    counts = tokens.select("ids").mapInArrow(count, "id long, n long").groupBy("id").agg(F.sum("n").alias("n"))
    rows = sorted(((-r["n"], r["id"]) for r in counts.collect()))
    return np.array([i for _, i in rows], np.uint32)


def write_token_files(docs: DataFrame, path: str, folder: str, end_id: int = 0) -> None:
    """Tokenize ``docs`` and write the files and the rank table under ``folder``."""
    spark = docs.sparkSession
    narrow = "<u2" if max(len(encoder(path).bytes), end_id + 1) <= 1 << 16 else "<u4"
    tokens = staged(token_ids(docs, path, end_id, narrow), "token-ids")
    order = frequency_ranks(tokens, narrow)
    rank = np.zeros(int(order.max()) + 1 if len(order) else 1, np.uint32)
    rank[order] = np.arange(len(order), dtype=np.uint32)
    known = spark.sparkContext.broadcast(rank)
    small = pa.schema([("doc_id", pa.int64()), ("n", pa.int64()), ("ranks", pa.binary())])
    block = pa.schema([("part", pa.int64()), ("block", pa.int64()), ("ahead", pa.int64()), ("doc_ids", pa.list_(pa.int64())), ("lengths", pa.list_(pa.int64())), ("control", pa.binary()), ("data", pa.binary())])
    width = "<u2" if len(order) <= 1 << 16 else "<u4"

    def renumber(batches):
        for b in batches:
            bounds, ids = numbers(b.column(1), narrow)
            yield table(small, doc_id=b.column(0), n=np.diff(bounds), ranks=slices(known.value[ids].astype(width), bounds))

    def blocks(batches):
        part, number, ahead, held, size = TaskContext.get().partitionId(), 0, 0, [], 0

        def full():
            control, data = encode_numbers(np.concatenate([np.frombuffer(r, width).astype("<u4") for _, _, r in held]))
            return table(block, part=[part], block=[number], ahead=[ahead], doc_ids=[[d for d, _, _ in held]], lengths=[[n for _, n, _ in held]], control=[control], data=[data])

        for b in batches:
            for d, n, r in zip(*(c.to_pylist() for c in b.columns)):
                held.append((d, n, r))
                size += n
                if size >= BLOCK_IDS:
                    yield full()
                    number, ahead, held, size = number + 1, ahead + size, [], 0
        if held:
            yield full()

    ranked = tokens.mapInArrow(renumber, "doc_id long, n long, ranks binary")
    files = ranked.repartitionByRange("doc_id").sortWithinPartitions("doc_id")
    files.mapInArrow(blocks, "part long, block long, ahead long, doc_ids array<long>, lengths array<long>, control binary, data binary").write.parquet(f"{folder}/blocks")
    spark.createDataFrame([(i, int(x)) for i, x in enumerate(order)], "rank int, id long").coalesce(1).write.parquet(f"{folder}/ranks")


def read_token_files(spark: SparkSession, folder: str) -> DataFrame:
    """doc_id, start (ids of all documents before it), n_tokens and ``ids`` (little-endian unsigned 32-bit)."""
    blocks = spark.read.parquet(f"{folder}/blocks")
    order = np.array([r["id"] for r in spark.read.parquet(f"{folder}/ranks").orderBy("rank").collect()], np.uint32)
    ids_of = spark.sparkContext.broadcast(order)
    sizes = blocks.select("part", "block", F.aggregate("lengths", F.lit(0).cast("long"), lambda a, x: a + x).alias("n")).groupBy("part").agg(F.sum("n").alias("n"))
    before, total = {}, 0
    for r in sizes.orderBy("part").collect():  # one row for each file part
        before[r["part"]], total = total, total + r["n"]
    schema = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64()), ("ids", pa.binary())])

    def decode(batches):
        for b in batches:
            for part, ahead, docs, lengths, control, data in zip(*(c.to_pylist() for c in b.columns)):
                ids = ids_of.value[decode_numbers(control, data, sum(lengths))].astype("<u4")
                ends = np.cumsum(lengths)
                starts = ends - lengths
                yield table(schema, doc_id=docs, start=(starts + before[part] + ahead), n_tokens=lengths, ids=slices(ids, np.concatenate(([0], ends))))

    return blocks.select("part", "ahead", "doc_ids", "lengths", "control", "data").mapInArrow(decode, "doc_id long, start long, n_tokens long, ids binary")


def crc_of(tokens: DataFrame) -> DataFrame:
    """The columns of ``tokens`` with ids_crc32 (unsigned) for ``ids``."""
    return tokens.withColumn("ids_crc32", F.crc32("ids")).drop("ids")


def crc32(ids: np.ndarray) -> int:
    return zlib.crc32(np.ascontiguousarray(ids, "<u4").tobytes())
