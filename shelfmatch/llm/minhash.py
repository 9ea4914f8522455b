"""MinHash near-duplicates by chosen-path set similarity join, confirmed on full sets.

A document's set are its distinct five-word shingles (lower-cased A-Z); with fewer words the whole sequence is the one
element, without a word the set is empty and linked with nothing.  Sets are linked at Jaccard similarity ``SIMILAR`` or
more, and a document's component is what links reach.

1. *Sets.*  Documents of equal sets are one node from here on.  A set has ``TOKENS`` minwise tokens of 16 bits.
2. *Branching.*  A tree starts with all sets in its root.  A node chooses one or two of the token places, by a hash of
   its path, and every set in it goes on to the child that its token at a chosen place names.  Two sets of similarity s
   stay together on a chosen place with probability s; with ``BRANCHES`` = 1 / 0.85 places on average the expected number
   of common children of a linked pair stays one or more, however deep the tree, while the number of other common
   pairs falls at every level.
3. *Small nodes.*  Nodes of at most ``SMALL`` sets are compared exhaustively on their tokens; larger ones branch again.
   After ``DEPTH`` levels a node that is still large (sets that are alike throughout) is split into pairs of
   chunks, each of which is compared as a small node is.
4. *Confirmation.*  Sets that the tokens tie together inside a node (at ``NEAR`` of them or more) form a cell.  The full
   sets of those in a cell are made from the texts again (a map of ``2 ** BITS`` bits, 16 MB whatever the corpus, tells
   nearly all others apart), brought together, and every pair of a cell is intersected; a task returns a
   spanning forest of the links that hold, never the list of pairs.
5. *Recall.*  ``TREES`` independent trees repeat this.  A pair at 0.85 survives a level with probability 0.87 (0.85 with
   one place, 0.98 with two), so at four levels a tree finds it with probability 0.57 and eight miss it with 0.001; pairs of
   higher similarity, and nodes that become small earlier, are found more often.  The test measures it.

No task gets more than a node of bounded size: sizes are counted by a pre-aggregated grouping, and only rows of nodes
that are small, or chunks, are brought together.

Null and empty texts have an empty set and are a component of their own.  Rows without doc_id take part; their component
is the smallest doc_id reachable, null if there is none, and such a row counts as kept.  Repeated rows share a component.
An empty table gives an empty result.  Columns other than doc_id and text are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import links_to_roots, small_side, staged, text_of
from .simhash import stars

SHINGLE = 5
#: Least Jaccard similarity of a link, in hundredths.
SIMILAR = 85
TOKENS = 64
#: Equal tokens from which a pair is worth a look at the full sets: four standard deviations below 0.85 of 64.
NEAR = 42
TREES = 8
BRANCHES = 100 / SIMILAR
SMALL = 512
DEPTH = 8
#: Bits of the map of sets in cells, as a power of two.
BITS = 27
#: Words of documents whose sets are made together.
TOGETHER = 1 << 19

_ODD = np.array([xxhash.xxh64_intdigest(str(k), 11) | 1 for k in range(TOKENS)], np.uint64)
_PLACES = np.array([xxhash.xxh64_intdigest(str(k), 12) | 1 for k in range(SHINGLE)], np.uint64)


def _mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class _Hashes(dict):
    """XXH64 of words."""

    def __missing__(self, word):
        self[word] = h = xxhash.xxh64_intdigest(word)
        return h


def shingle_sets(texts: list[str]) -> list[np.ndarray]:
    """The sorted 64-bit hashes of each text's distinct shingles."""
    hashes, out = _Hashes(), []
    for text in texts:
        words = text.encode().lower().split()  # bytes: A-Z only, and the six ASCII blanks
        if not words:
            out.append(np.zeros(0, np.uint64))
            continue
        h = np.fromiter(map(hashes.__getitem__, words), np.uint64, len(words))
        width = min(SHINGLE, len(words))
        sums = np.zeros(len(words) - width + 1, np.uint64)
        for k in range(width):
            sums += _mixed(h[k : len(words) - width + 1 + k]) * _PLACES[k]
        out.append(np.unique(_mixed(sums)))
        if len(hashes) > TOGETHER:
            hashes.clear()
    return out


def minwise(sets: list[np.ndarray]) -> np.ndarray:
    """The tokens, one row for each set (sets must not be empty)."""
    starts = np.cumsum([0, *map(len, sets)])[:-1]
    values = np.concatenate(sets)
    out = np.empty((len(sets), TOKENS), np.uint16)
    for k in range(TOKENS):
        least = np.minimum.reduceat(values * _ODD[k], starts)
        out[:, k] = _mixed(least) >> np.uint64(48)
    return out


_SETS = "doc_id long, key binary, n long, tokens binary"


def _together(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[list, list[np.ndarray], list[bytes | None]]]:
    """Ids, sets and keys of some documents (doc_id, text) at a time; an empty set has no key."""
    for batch in batches:
        ids, texts, size = [], [], 0
        for k, (doc_id, text) in enumerate(zip(batch.column(0).to_pylist(), batch.column(1)), 1):
            ids.append(doc_id)
            texts.append(text.as_py())
            size += len(texts[-1]) // 6 + 1
            if size >= TOGETHER or k == batch.num_rows:
                sets = shingle_sets(texts)
                yield ids, sets, [xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None for s in sets]
                ids, texts, size = [], [], 0


def _make_sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for ids, sets, keys in _together(batches):
        full = [s for s in sets if len(s)]
        tokens = iter(minwise(full)) if full else iter(())
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(ids, pa.int64()),
                pa.array(keys, pa.binary()),
                pa.array([len(s) for s in sets], pa.int64()),
                pa.array([next(tokens).tobytes() if len(s) else None for s in sets], pa.binary()),
            ],
            names=["doc_id", "key", "n", "tokens"],
        )


def _bit_of(key: bytes) -> int:
    return int.from_bytes(key[:8], "little") >> (64 - BITS)


def _key_map(keys: DataFrame) -> np.ndarray:
    """A bit for each key: at most 2 ** BITS / 32768 rows of 4 kB reach the driver."""

    def positions(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([_bit_of(k) + 1 for k in batch.column(0).to_pylist()], pa.int64())], names=["at"])

    at = keys.select("key").mapInArrow(positions, "at long")
    parts = at.select(F.bitmap_bucket_number("at").alias("part"), F.bitmap_bit_position("at").alias("bit"))
    out = np.zeros(1 << (BITS - 3), np.uint8)
    for part, bits in parts.groupBy("part").agg(F.bitmap_construct_agg("bit")).toLocalIterator():
        out[(part - 1) * 4096 : part * 4096] = np.frombuffer(bits, np.uint8)
    return out


def _members(rows: DataFrame, keys: DataFrame) -> DataFrame:
    """(key, members) of the documents (doc_id, text) whose sets are among the distinct ``keys``, one row for each key."""
    known = rows.sparkSession.sparkContext.broadcast(_key_map(keys))

    def pick(batches):
        seen = set()
        for _, sets, own in _together(batches):
            found = [(k, s) for k, s in zip(own, sets) if k is not None and known.value[_bit_of(k) >> 3] >> (_bit_of(k) & 7) & 1]
            new = {k: s.tobytes() for k, s in found if k not in seen}
            seen.update(new)
            if new:
                yield pa.RecordBatch.from_arrays([pa.array(list(new), pa.binary()), pa.array(list(new.values()), pa.binary())], names=["key", "members"])

    picked = rows.mapInArrow(pick, "key binary, members binary").join(keys, "key", "left_semi")
    out = staged(picked.groupBy("key").agg(F.any_value("members").alias("members")), "cell-members")
    known.destroy()
    return out


def _tokens(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint16).reshape(-1, TOKENS)


def children(paths: np.ndarray, tokens: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row, path of the child) for the places that each row's node chooses; what is chosen depends on the path only."""
    first = _mixed(paths ^ np.uint64(0x9E3779B97F4A7C15))
    other = _mixed(first)
    one = (first % np.uint64(TOKENS)).astype(np.int64)
    two = ((one + 1 + (other % np.uint64(TOKENS - 1)).astype(np.int64)) % TOKENS).astype(np.int64)
    second = np.flatnonzero((other >> np.uint64(11)) < np.uint64(int((BRANCHES - 1) * 2**53)))
    row = np.concatenate((np.arange(len(paths)), second))
    place = np.concatenate((one, two[second]))
    named = tokens[row, place].astype(np.uint64) * np.uint64(TOKENS) + place.astype(np.uint64) + np.uint64(1)
    return row, _mixed(paths[row] * np.uint64(0x2545F4914F6CDD1D) + named)


def _branch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (path, key, n, tokens) to the rows of the children."""
    for batch in batches:
        if not batch.num_rows:
            continue
        paths = batch.column(0).to_numpy().view(np.uint64)
        row, path = children(paths, _tokens(batch.column(2)))
        taken = batch.select([1, 2]).take(pa.array(row))
        yield pa.RecordBatch.from_arrays([pa.array(path.view(np.int64)), *taken.columns], names=["path", "key", "tokens"])


def _groups(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[pa.RecordBatch]:
    """Runs of at least two rows with equal values in the first ``width`` columns (whole numbers), from sorted batches."""
    held: pa.RecordBatch | None = None
    for batch in batches:
        if not batch.num_rows:
            continue
        rows = batch if held is None else pa.concat_batches([held, batch])
        ids = np.stack([rows.column(k).to_numpy() for k in range(width)], axis=1)
        cuts = np.concatenate(([0], np.flatnonzero((ids[1:] != ids[:-1]).any(axis=1)) + 1))
        sizes = np.diff(cuts)
        for k in np.flatnonzero(sizes > 1).tolist():
            yield rows.slice(int(cuts[k]), int(sizes[k]))
        held = rows.slice(int(cuts[-1]))
    if held is not None and held.num_rows > 1:
        yield held


def _cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (path, i, j, key, tokens) by node: the cells (number, key) of sets that their tokens tie together."""
    cells, keys = [], []

    def out():
        return pa.RecordBatch.from_arrays([pa.array(cells, pa.binary()), pa.array(keys, pa.binary())], names=["cell", "key"])

    for node in _groups(batches, 3):
        tokens = _tokens(node.column(4))
        left, right = [], []
        for a in range(node.num_rows - 1):
            near = np.flatnonzero((tokens[a + 1 :] == tokens[a]).sum(axis=1, dtype=np.int16) >= NEAR)
            if len(near):
                right.append(near + a + 1)
                left.append(np.full(len(near), a))
        if not left:
            continue
        names = node.column(3).to_pylist()
        label = stars(node.num_rows, np.concatenate(left), np.concatenate(right))
        for root in np.unique(label[np.concatenate(right)]).tolist():
            tied = sorted(names[k] for k in np.flatnonzero(label == root).tolist())
            cells += [xxhash.xxh3_128_digest(b"".join(tied))] * len(tied)
            keys += tied
        if len(keys) > 10_000:
            yield out()
            cells.clear()
            keys.clear()
    if keys:
        yield out()


def linked(sets: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of positions of ``sets`` that span each set of links; every pair is intersected in full."""
    values, member = np.unique(np.concatenate(sets), return_inverse=True)
    sizes = np.array([len(s) for s in sets])
    starts = np.concatenate(([0], np.cumsum(sizes)[:-1]))
    here = np.zeros(len(values), np.int64)
    left, right = [], []
    for a in range(len(sets) - 1):
        own = member[starts[a] : starts[a] + sizes[a]]
        here[own] = 1
        common = np.add.reduceat(here[member[starts[a + 1] :]], starts[a + 1 :] - starts[a + 1])
        here[own] = 0
        held = np.flatnonzero(100 * common >= SIMILAR * (sizes[a] + sizes[a + 1 :] - common))
        right.append(held + a + 1)
        left.append(np.full(len(held), a))
    label = stars(len(sets), np.concatenate(left), np.concatenate(right))
    tied = np.flatnonzero(label != np.arange(len(sets)))
    return label[tied], tied


def _confirm(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (head, tail, key, members) by cell to links (a, b)."""
    for cell in _groups(batches, 2):
        keys = cell.column(2).to_pylist()
        a, b = linked([np.frombuffer(m, np.uint64) for m in cell.column(3).to_pylist()])
        if len(a):
            yield pa.RecordBatch.from_arrays([pa.array([keys[k] for k in a.tolist()], pa.binary()), pa.array([keys[k] for k in b.tolist()], pa.binary())], names=["a", "b"])


def _compare(rows: DataFrame) -> DataFrame:
    """Cells (cell, key) of the nodes or chunk pairs (path, i, j) of ``rows``."""
    together = rows.repartition("path", "i", "j").sortWithinPartitions("path", "i", "j")
    return together.mapInArrow(_cells, "cell binary, key binary")


def candidate_cells(sets: DataFrame, trees: int = TREES) -> DataFrame:
    """Cells (cell, key) from all nodes of all trees; ``sets`` has key and tokens of distinct sets that are not empty."""
    roots = [int(x) for x in _mixed(np.arange(1, trees + 1, dtype=np.uint64)).view(np.int64)]
    rows = sets.select(F.explode(F.array(*(F.lit(r) for r in roots))).alias("path"), "key", "tokens")
    cells = None
    for level in range(DEPTH + 1):
        if level < DEPTH:
            rows = rows.mapInArrow(_branch, "path long, key binary, tokens binary")
            rows = staged(rows, "node-rows") if level else rows
            large = small_side(rows.groupBy("path").agg(F.count("*").alias("size")).where(F.col("size") > SMALL), "large-nodes")
            ready = rows.join(large, "path", "left_anti").select("path", F.lit(0).alias("i"), F.lit(0).alias("j"), "key", "tokens")
            rows = rows.join(large, "path")
        else:
            ready = _chunk_pairs(rows)
        found = staged(_compare(ready), "cells")
        cells = found if cells is None else cells.unionByName(found)
        if large.isEmpty():
            break
    return cells


def _chunk_pairs(rows: DataFrame) -> DataFrame:
    """Rows (path, key, tokens, size) of large nodes, a copy for each pair of chunks that a row's chunk is in."""
    half = SMALL // 2
    k = F.ceil(F.col("size") / half).cast("int")
    placed = rows.select("path", "key", "tokens", k.alias("k")).withColumn("mine", F.pmod(F.hash("key"), F.col("k")))
    copies = placed.select("path", "key", "tokens", "mine", F.explode(F.sequence(F.lit(0), F.col("k") - 1)).alias("other"))
    return copies.select("path", F.least("mine", "other").alias("i"), F.greatest("mine", "other").alias("j"), "key", "tokens")


def near_links(sets: DataFrame, rows: DataFrame, trees: int = TREES) -> DataFrame:
    """Links (a, b) between the keys of ``sets`` (key, tokens: the distinct ones that are not empty) of documents ``rows``."""
    cells = staged(candidate_cells(sets, trees).distinct(), "distinct-cells")
    full = _members(rows, small_side(cells.select("key").distinct(), "cell-keys"))
    head, tail = F.xxhash64("cell").alias("head"), F.xxhash64("cell", F.lit(1)).alias("tail")
    by_cell = cells.join(full, "key").select(head, tail, "key", "members")
    return by_cell.repartition("head", "tail").sortWithinPartitions("head", "tail").mapInArrow(_confirm, "a binary, b binary")


def near_duplicates(docs: DataFrame, trees: int = TREES) -> DataFrame:
    """doc_id, n_shingles, component_id (smallest doc_id reachable) and kept, per document."""
    rows = docs.select(docs["doc_id"].cast("long").alias("doc_id"), text_of(docs).alias("text"))
    own = staged(rows.mapInArrow(_make_sets, _SETS).withColumn("row", F.monotonically_increasing_id()), "sets")
    named = own.where("key is not null")
    distinct = named.groupBy("key").agg(F.min("row").alias("row"), F.min("doc_id").alias("first_doc"), F.count("*").alias("copies"))
    distinct = staged(distinct, "distinct-sets")
    first = distinct.select("row")
    sets = staged(named.select("row", "key", "tokens").join(first, "row", "left_semi").select("key", "tokens"), "distinct-tokens")
    roots = links_to_roots(staged(near_links(sets, rows, trees), "links"))
    labels = distinct.join(roots.withColumnRenamed("node", "key"), "key", "left").where("copies > 1 or root is not null")
    labels = staged(labels.select("key", "first_doc", F.coalesce("root", "key").alias("root")), "labels")
    ids = labels.groupBy("root").agg(F.min("first_doc").alias("component_id"))
    shared = small_side(labels.join(ids, "root").select("key", "component_id", F.lit(True).alias("shared")), "shared")
    found = own.select("doc_id", "key", "n").join(shared, "key", "left")
    component = F.when(F.col("shared"), F.col("component_id")).otherwise(F.col("doc_id"))
    out = found.select("doc_id", F.col("n").alias("n_shingles"), component.alias("component_id"))
    return out.withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))
