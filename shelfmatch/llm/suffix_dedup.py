"""Removal of every byte that a repeated string of ``LENGTH`` bytes covers, by suffix arrays over shards.

1. Anchors.  The anchor of a 200-byte window is the leftmost smallest hash of the 32-byte grams inside it, so equal
   windows have equal anchors at the same place.  Neighbouring windows share anchors; each anchor's windows are a run,
   and the bytes they cover its piece.  Anchors whose gram occurs once in the whole corpus are done: their windows are
   unique.
2. Equal pieces are counted: all windows of a piece that occurs twice are repeated, wherever it stands.  Anchors with
   other pieces, too, stay open, and each different piece of theirs goes on once.
3. Shards.  The pieces of an open anchor meet in one task, which joins whole anchors to texts of bounded size.  (An
   anchor with over ``CROWDED`` different pieces is split by content instead: its windows are counted one by one.)
4. A suffix array of each shard by induced sorting, and the permuted common prefixes: a window is repeated if its
   suffix shares 200 bytes with a neighbour in order.
5. Repeated windows go back to the documents, where their bytes are removed.

Every window of every text takes part, overlaps of a text with itself included.  Texts are UTF-8 bytes; null is empty.
Texts under 200 bytes lose nothing.  Rows that repeat are repetitions of each other, and each gets its result.  An
empty table gives an empty result.  Other columns are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import staged, table, text_of
from .suffix_arrays import common_prefixes, suffix_array

LENGTH = 200
GRAM = 32
#: Different pieces of an anchor that share a suffix array.
CROWDED = 4096
#: Bytes of a shard's text, about; an anchor's pieces stay together.
SHARD_BYTES = 1 << 20
#: Bytes whose anchors are found at a time.
AT_ONCE = 1 << 20

_BYTE = np.random.default_rng(20).integers(1, 1 << 63, 256, np.uint64)
_STEP = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F], np.uint64)


def gram_hashes(data: np.ndarray) -> np.ndarray:
    """64-bit hashes of all ``GRAM``-byte grams."""
    h, width = _BYTE[data], 1
    for step in _STEP:
        h = h[:-width] * step + h[width:]
        h ^= h >> np.uint64(29)
        width *= 2
    return h


def anchors(data: np.ndarray, length: int = LENGTH) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """hash, first window and number of windows of each anchor of one stretch of bytes."""
    if len(data) < length:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    h = gram_hashes(data)
    wide = length - GRAM + 1
    value = (h * np.uint64(0x9FB21C651E98DF25)) >> np.uint64(32)
    value, at = value.astype(np.uint32), np.arange(len(h), dtype=np.int32)
    width = 1
    while width < wide:
        step = min(width, wide - width)
        keep = value[:-step] <= value[step:]
        value, at = np.minimum(value[:-step], value[step:]), np.where(keep, at[:-step], at[step:])
        width += step
    first = np.concatenate(([0], np.flatnonzero(np.diff(at)) + 1))
    return h[at[first]], first, np.diff(np.append(first, len(at)))


def text_anchors(texts: list[bytes], length: int = LENGTH):
    """Anchors of each text; short texts are done together, windows across their borders left out."""
    out: list = [None] * len(texts)
    i = 0
    while i < len(texts):
        j, size = i, 0
        while j < len(texts) and (j == i or size + len(texts[j]) <= AT_ONCE):
            size += len(texts[j])
            j += 1
        if j == i + 1 and size > AT_ONCE:
            data = np.frombuffer(texts[i], np.uint8)
            parts = []
            for a in range(0, len(data) - length + 1, AT_ONCE):
                h, first, n = anchors(data[a : a + AT_ONCE + length - 1], length)
                parts.append((h, first + a, n))
            out[i] = tuple(np.concatenate(x) for x in zip(*parts))
        else:
            data = np.frombuffer(b"".join(texts[i:j]), np.uint8)
            h, first, n = anchors(data, length)
            ends = np.cumsum([len(t) for t in texts[i:j]])
            begin = 0
            for k, end in zip(range(i, j), ends.tolist()):
                lo, hi = begin, end - length + 1  # windows of this text
                if hi > lo:
                    a, b = np.searchsorted(first, lo, side="right") - 1, np.searchsorted(first, hi)
                    starts = np.maximum(first[a:b], lo)
                    stops = np.minimum(first[a:b] + n[a:b], hi)
                    out[k] = (h[a:b], starts - lo, stops - starts)
                else:
                    out[k] = (h[:0], first[:0], n[:0])
                begin = end
        i = j
    return out


def _keyed(docs: DataFrame) -> DataFrame:
    """id and mark name a text: rows alike in both are repetitions of one another."""
    text = text_of(docs)
    doc_id = docs["doc_id"].cast("long")
    return docs.select(F.coalesce(doc_id, F.lit(-1).cast("long")).alias("id"), F.xxhash64(text).alias("mark"), doc_id.alias("doc_id"), text.cast("binary").alias("text"))


def _first():
    """The first window of a place, which is that and the number of windows (at most LENGTH) in one number."""
    return F.shiftright("place", 16)


def _many():
    return F.col("place").bitwiseAND(0xFFFF)


def places(rows: DataFrame, length: int = LENGTH) -> DataFrame:
    """hash, piece (its hash), id, mark, place for every anchor whose gram is seen twice or more in the corpus."""
    schema = pa.schema([("id", pa.int64()), ("mark", pa.int64()), ("hash", pa.list_(pa.int64())), ("piece", pa.list_(pa.int64())), ("place", pa.list_(pa.int64()))])

    def find(batches):
        digest = xxhash.xxh3_64_intdigest
        for b in batches:
            for i in range(0, b.num_rows, 1000):
                some = b.slice(i, 1000)
                texts = some.column(2).to_pylist()
                found = text_anchors(texts, length)
                cut = [[digest(t[a : a + n + length - 1]) for a, n in zip(f[1].tolist(), f[2].tolist())] for t, f in zip(texts, found)]
                yield table(schema, id=some.column(0), mark=some.column(1), hash=[f[0].view(np.int64) for f in found],
                            piece=[np.array(c, np.uint64).view(np.int64) for c in cut], place=[f[1].astype(np.int64) << 16 | f[2] for f in found])

    seen = staged(rows.select("id", "mark", "text").mapInArrow(find, "id long, mark long, hash array<long>, piece array<long>, place array<long>"), "anchors")
    again = seen.select(F.explode("hash").alias("hash")).groupBy("hash").agg(F.count("*").alias("seen")).where("seen > 1").select("hash")
    each = seen.select("id", "mark", F.explode(F.arrays_zip("hash", "piece", "place")).alias("a")).select(F.col("a.hash").alias("hash"), F.col("a.piece").alias("piece"), "id", "mark", F.col("a.place").alias("place"))
    return each.join(again, "hash")


def cut_pieces(rows: DataFrame, wanted: DataFrame, length: int = LENGTH) -> DataFrame:
    """``wanted`` (id, mark, place, hash, copies) with the bytes of its pieces."""
    schema = pa.schema([("hash", pa.int64()), ("id", pa.int64()), ("mark", pa.int64()), ("place", pa.int64()), ("copies", pa.int64()), ("bytes", pa.binary())])

    def cut(batches):
        for b in batches:
            for i in range(0, b.num_rows, 500):
                out: list = [[] for _ in schema]
                for doc, mark, text, many in zip(*(c.to_pylist() for c in b.slice(i, 500).columns)):
                    for r in many:
                        first, n = r["place"] >> 16, r["place"] & 0xFFFF
                        for column, value in zip(out, (r["hash"], doc, mark, r["place"], r["copies"], text[first : first + n + length - 1])):
                            column.append(value)
                yield table(schema, **dict(zip(schema.names, out)))

    texts = rows.select("id", "mark", "text")
    grouped = wanted.groupBy("id", "mark").agg(F.collect_set(F.struct("place", "hash", "copies")).alias("many"))
    # rows that repeat cut the same pieces again; one of each is enough
    return texts.join(grouped, ["id", "mark"]).mapInArrow(cut, "hash long, id long, mark long, place long, copies long, bytes binary")


def _solve(texts: list[bytes], copies: list[int], length: int) -> list[np.ndarray]:
    """Which windows of each text are repeated in a shard."""
    sizes = np.array([len(t) + 1 for t in texts])
    ends = np.cumsum(sizes)
    data = np.frombuffer(b"".join(t + b"\0" for t in texts), np.uint8).astype(np.int64) + 2
    data[ends - 1] = 1  # between pieces; 0 ends the text
    t = np.append(data, 0)
    sa = suffix_array(t)
    long = common_prefixes(t, sa) >= length
    twice = long.copy()
    twice[sa[:-1][long[sa[1:]]]] = True
    return [np.ones(s - length, bool) if n > 1 else twice[a : a + s - length] for s, n, a in zip(sizes.tolist(), copies, (ends - sizes).tolist())]


def _spans(marks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    edges = np.flatnonzero(np.diff(np.concatenate(([0], marks.astype(np.int8), [0]))))
    return edges[::2], edges[1::2]


def repeated_windows(rows: DataFrame, length: int = LENGTH) -> DataFrame:
    """id, mark, from, to: runs of repeated windows (``to`` behind the last)."""
    found = staged(places(rows, length), "places")
    distinct = found.groupBy("hash", "piece").agg(F.count("*").alias("copies"), F.min(F.struct("id", "mark", "place")).alias("one"))
    distinct = staged(distinct.select("hash", "piece", "copies", "one.*"), "distinct-pieces")
    of_anchor = distinct.groupBy("hash").agg(F.count("*").alias("different"), F.min("copies").alias("least"))
    copied = distinct.where("copies > 1").select("hash", "piece")
    whole = found.join(copied, ["hash", "piece"]).select("id", "mark", _first().alias("from"), (_first() + _many()).alias("to"))
    open_anchors = of_anchor.where("least = 1 and different > 1").select("hash", (F.col("different") > CROWDED).alias("crowded"))
    wanted = distinct.join(open_anchors, "hash")
    cut = staged(cut_pieces(rows, wanted.select("id", "mark", "place", "hash", "copies"), length).join(open_anchors, "hash"), "pieces")
    spans = pa.schema([("id", pa.int64()), ("mark", pa.int64()), ("from", pa.int64()), ("to", pa.int64())])

    def answer(some):
        out: list = [[] for _ in spans]
        marks = _solve([x[5] for x in some], [x[4] for x in some], length)
        for (_, doc, mark, place, copies, _), m in zip(some, marks):
            if copies == 1:  # the places of copied pieces are answered already
                for a, b in zip(*_spans(m)):
                    for column, value in zip(out, (doc, mark, (place >> 16) + a, (place >> 16) + b)):
                        column.append(value)
        return table(spans, **dict(zip(spans.names, out)))

    def shards(batches):
        held, size = [], 0
        for b in batches:
            for row in zip(*(c.to_pylist() for c in b.columns)):
                if size >= SHARD_BYTES and row[0] != held[-1][0]:
                    yield answer(held)
                    held, size = [], 0
                held.append(row)
                size += len(row[5]) + 1
        if held:
            yield answer(held)

    kept = ["hash", "id", "mark", "place", "copies", "bytes"]
    few = cut.where("not crowded").select(kept).repartition("hash").sortWithinPartitions("hash", "id", "mark", "place")
    few = few.mapInArrow(shards, "id long, mark long, from long, to long")
    each = F.posexplode(F.transform(F.sequence(F.lit(1), F.octet_length("bytes") - (length - 1)), lambda i: F.md5(F.substring("bytes", i, length)))).alias("at", "window")
    many = cut.where("crowded").select("id", "mark", "place", "copies", each)
    twice = many.groupBy("window").agg(F.sum("copies").alias("n")).where("n > 1").select("window")
    many = many.where("copies = 1").join(twice, "window").select("id", "mark", (_first() + F.col("at")).alias("from"), (_first() + F.col("at") + 1).alias("to"))
    return whole.union(few).union(many)


def remove_repeated(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans and ``kept`` (the bytes left) per document."""
    rows = _keyed(docs)
    runs = repeated_windows(rows, length).groupBy("id", "mark").agg(F.collect_set(F.struct("from", "to")).alias("runs"))
    schema = pa.schema([("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_removed", pa.int64()), ("n_spans", pa.int64()), ("kept", pa.binary())])

    def remove(batches):
        for b in batches:
            for i in range(0, b.num_rows, 500):
                some = b.slice(i, 500)
                out: list = [[] for _ in schema]
                for doc, text, runs in zip(*(c.to_pylist() for c in some.columns)):
                    change = np.zeros(len(text) + 1, np.int64)
                    for r in runs or ():
                        change[r["from"]] += 1
                        change[r["to"] + length - 1] -= 1
                    gone = np.cumsum(change)[:-1] > 0
                    starts, _ = _spans(gone)
                    kept = np.frombuffer(text, np.uint8)[~gone].tobytes() if len(starts) else text
                    for column, value in zip(out, (doc, len(text), len(text) - len(kept), len(starts), kept)):
                        column.append(value)
                yield table(schema, **dict(zip(schema.names, out)))

    joined = rows.join(runs, ["id", "mark"], "left").select("doc_id", "text", "runs")
    return joined.mapInArrow(remove, "doc_id long, n_bytes long, n_removed long, n_spans long, kept binary")


def digest(removed: DataFrame) -> DataFrame:
    """The columns of ``removed`` with the sha256 of what is kept in its place."""
    return removed.withColumn("kept_sha256", F.sha2("kept", 256)).drop("kept")
