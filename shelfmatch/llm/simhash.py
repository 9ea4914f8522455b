"""SimHash near-duplicates, found with tables of distances to reference fingerprints.

A fingerprint bit is the majority bit of the XXH64 hashes (seed 42) of a text's three-word shingles.  Fingerprints
that differ in at most ``MAX_BITS`` bits are linked; a document's component is what links reach.

The search never compares all pairs.  Each distinct fingerprint gets its Hamming distances to fixed references:

* The zero fingerprint and the 16 with one block of four bits set.  From their distances follows how many bits a
  fingerprint has set in each block.  A link changes at most three of these 16 numbers.  With the blocks in six
  groups, three groups at least keep all theirs, so linked fingerprints meet in one of the 20 cells that three
  groups' numbers name.
* 32 mixed references.  By the triangle inequality two distances of a linked pair to one reference differ by at most
  ``MAX_BITS``.  Pairs of a cell are discarded by the greatest such difference, reference after reference; the
  survivors' own distance decides.

A crowded cell is split into pairs of chunks, each a task's work of bounded size.  A task returns a spanning star per
linked set, so no list of all pairs arises.

Null and empty texts have fingerprint zero, linked like any other.  Repeated rows share fingerprint and component.  A
component without any doc_id has a null id.  An empty table gives an empty result.  Other columns are left alone.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import by_batch, free_name, links_to_roots, small_side, staged, text_key, text_of

MAX_BITS = 3
#: Fingerprints of a cell that a task compares with each other, or chunk with chunk.
CHUNK = 1024

_BLOCKS = np.array([0xF << (4 * k) for k in range(16)], np.uint64)
_MIXED = np.array([xxhash.xxh64_intdigest(str(k), 7) for k in range(32)], np.uint64)
_GROUPS = [(0, 1, 2), (3, 4, 5), (6, 7, 8), (9, 10, 11), (12, 13), (14, 15)]
_CELLS = [sum((_GROUPS[g] for g in three), ()) for three in combinations(range(6), 3)]


def fingerprint(text: str) -> int:
    words = text.encode().lower().split()  # bytes: A-Z only, and the six ASCII blanks
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words])
    first = [0, *ends[:-3].tolist()] if len(words) > 3 else [0]
    last = (ends[2:] - 1).tolist() if len(words) > 3 else [len(joined)]
    digest = xxhash.xxh64_intdigest
    hashes = np.array([digest(joined[a:b], 42) for a, b in zip(first, last)], np.uint64)
    ones = np.zeros(64, np.int64)
    for i in range(0, len(hashes), 1 << 14):
        some = hashes[i : i + (1 << 14)].astype("<u8").view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(some, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = np.packbits(2 * ones > len(hashes), bitorder="little")
    return int(bits.view("<u8")[0])


def distances(prints: np.ndarray, references: np.ndarray) -> np.ndarray:
    return np.bitwise_count(prints[:, None] ^ references[None, :])


def cells(prints: np.ndarray) -> np.ndarray:
    """The numbers of the 20 cells of each fingerprint, from its distances to zero and to the block references."""
    to_zero = np.bitwise_count(prints).astype(np.int64)
    inside = (to_zero[:, None] + 4 - distances(prints, _BLOCKS)) // 2
    out = np.empty((len(prints), len(_CELLS)), np.int64)
    for k, blocks in enumerate(_CELLS):
        code = np.full(len(prints), k, np.int64)
        for b in blocks:
            code = code * 5 + inside[:, b]
        out[:, k] = code * len(_CELLS) + k
    return out


def linked(prints: np.ndarray, group: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links (two positions) inside runs of equal ``group``: pairs that pass every reference, then verified."""
    table = distances(prints, _MIXED).astype(np.int8)
    left, right = [], []
    shift = 1
    while True:
        a = np.flatnonzero(group[shift:] == group[:-shift])
        if not len(a):
            break
        b = a + shift
        for k in range(table.shape[1]):
            near = np.abs(table[a, k] - table[b, k]) <= MAX_BITS
            a, b = a[near], b[near]
            if not len(a):
                break
        same = np.bitwise_count(prints[a] ^ prints[b]) <= MAX_BITS
        left.append(a[same])
        right.append(b[same])
        shift += 1
    return np.concatenate([*left, np.zeros(0, np.int64)]), np.concatenate([*right, np.zeros(0, np.int64)])


def stars(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """For each of n nodes the smallest node that the links a-b tie it to."""
    label = np.arange(n)
    while len(a):
        before = label.copy()
        np.minimum.at(label, a, label[b])
        np.minimum.at(label, b, label[a])
        label = label[label]
        if (label == before).all():
            break
    return label


def _find_links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (cell, i, j, print) sorted by the first three: links between prints of one group."""
    held: list[np.ndarray] = []

    def links(rows: np.ndarray):
        prints = rows[:, 3].copy().view(np.uint64)
        group = np.concatenate(([0], np.cumsum((np.diff(rows[:, :3], axis=0) != 0).any(axis=1))))
        a, b = linked(prints, group)
        label = stars(len(prints), a, b)
        tied = np.flatnonzero(label != np.arange(len(prints)))
        return pa.RecordBatch.from_arrays([pa.array(rows[tied, 3]), pa.array(rows[label[tied], 3])], names=["a", "b"])

    for batch in batches:
        rows = np.stack([c.to_numpy() for c in batch.columns], axis=1)
        if not len(rows):
            continue
        held.append(rows)
        ends = np.flatnonzero((rows[:, :3] != rows[-1, :3]).any(axis=1))
        if len(ends):  # all but the last group are complete
            whole = np.concatenate([*held[:-1], rows[: ends[-1] + 1]])
            held = [rows[ends[-1] + 1 :]]
            yield links(whole)
    if held:
        yield links(np.concatenate(held))


def near_links(prints: DataFrame) -> DataFrame:
    """Links (a, b) that span each set of linked fingerprints; ``prints`` has the distinct ones as ``print``."""

    def expand(batches):
        for b in batches:
            x = b.column(0).to_numpy()
            codes = cells(x.view(np.uint64))
            yield pa.RecordBatch.from_arrays([pa.array(codes.reshape(-1)), pa.array(np.repeat(x, codes.shape[1]))], names=["cell", "print"])

    rows = prints.mapInArrow(expand, "cell long, print long")
    crowded = small_side(rows.groupBy("cell").agg(F.count("*").alias("n")).where(F.col("n") > CHUNK), "crowded")
    chunks = F.coalesce(F.ceil(F.col("n") / CHUNK), F.lit(1)).cast("long")
    placed = rows.join(crowded, "cell", "left").select("cell", "print", chunks.alias("k")).withColumn("mine", F.pmod(F.xxhash64("print"), F.col("k")))
    placed = placed.select("cell", "print", "mine", F.explode(F.sequence(F.lit(0).cast("long"), F.col("k") - 1)).alias("other"))
    groups = placed.select("cell", F.least("mine", "other").alias("i"), F.greatest("mine", "other").alias("j"), "print")
    return groups.repartition("cell", "i", "j").sortWithinPartitions("cell", "i", "j").mapInArrow(_find_links, "a long, b long")


def _labelled(docs: DataFrame) -> DataFrame:
    """doc_id, mark (stands for the text), print (long), component_id (smallest doc_id reachable) and root of its component per document."""
    schema = pa.schema([("doc_id", pa.int64()), ("mark", pa.binary()), ("print", pa.int64())])

    def prints_of(doc_id, mark, text):
        return {"doc_id": doc_id, "mark": mark, "print": np.array([fingerprint(t) for t in text], np.uint64).view(np.int64)}

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_key(text_of(docs)).alias("mark"), text_of(docs).alias("text"))
    own = staged(rows.mapInArrow(by_batch(prints_of, schema), "doc_id long, mark binary, print long"), "prints")
    distinct = staged(own.groupBy("print").agg(F.min("doc_id").alias("first_doc")), "distinct-prints")
    roots = links_to_roots(near_links(distinct.select("print")))
    labels = distinct.join(roots, distinct["print"] == roots["node"], "left").select("print", "first_doc", F.coalesce("root", "print").alias("root"))
    ids = labels.groupBy("root").agg(F.min("first_doc").alias("component_id"))
    return own.join(labels.join(ids, "root").select("print", "root", "component_id"), "print")


def simhash(docs: DataFrame) -> DataFrame:
    """doc_id, print (long), component_id (smallest doc_id reachable) per document."""
    return _labelled(docs).select("doc_id", "print", "component_id")


def hex_print(col):
    return F.lower(F.lpad(F.hex(col), 16, "0"))


def keep_one_each(docs: DataFrame) -> DataFrame:
    """One row of ``docs`` for each component: that of the smallest doc_id, a null one last; of several texts with this
    doc_id the one of smallest MD5; of rows alike in both any one.

    Texts stay where they are unless the rows to drop are many: what is joined with them is doc_id and MD5 of those.
    """
    rows = staged(_labelled(docs).groupBy("root", "doc_id", "mark").agg(F.count("*").alias("n")), "labelled")
    order = F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "mark")
    first = rows.groupBy("root").agg(F.min(order).alias("at")).select(F.col("root").alias("first_root"), "at.doc_id", "at.mark")
    same = (rows["root"] == first["first_root"]) & rows["doc_id"].eqNullSafe(first["doc_id"]) & (rows["mark"] == first["mark"])
    kept = rows.join(first, same, "left_semi")
    late = small_side(rows.join(first, same, "left_anti").select("doc_id", "mark"), "late")
    repeated = small_side(kept.where("n > 1").select("doc_id", "mark"), "repeated")

    def is_in(keys: DataFrame):
        return docs["doc_id"].cast("long").eqNullSafe(keys["doc_id"]) & (text_key(text_of(docs)) == keys["mark"])

    out = docs.join(late, is_in(late), "left_anti")
    if repeated.isEmpty():
        return out
    twice = docs.join(repeated, is_in(repeated), "left_semi")
    id_name, text_name = free_name(docs, "id_key"), free_name(docs, "text_key")
    one_each = twice.withColumns({id_name: twice["doc_id"].cast("long"), text_name: text_key(text_of(twice))}).dropDuplicates([id_name, text_name]).drop(id_name, text_name)
    once = late.union(repeated)
    return docs.join(once, is_in(once), "left_anti").union(one_each)
