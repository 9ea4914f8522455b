"""Documents scored by the cross-entropy difference of a target and a background language model.

Both are models of word pairs over one shared vocabulary: every word of the corpus.  The background is counted on every
document, the target on the documents chosen as such; background counts are brought to the target's size, so that both
are smoothed alike (pair counts with ``PRIOR`` pseudo-counts of the word's own share; the share has one count for each
word and one for words never seen).  A document's score is its loss per token under the target less that under the
background: the lower, the more it looks like the target.

What is counted grows with the corpus and stays in partitions:

* Pairs of two of the ``size`` most frequent words have their losses in two tables that go to every task.  The size of
  the tables changes where a loss is looked up, never its value; a pair that crowds a key is always one of these.
* Every other pair has a word outside of them: its second word, or else its first.  The pairs of each document, counted
  there, go to the bucket of that word, known by 63 bits of its hash.  A bucket has all documents' counts of its pairs,
  and all of its own words, so it counts and scores in one go and returns a sum for each document.
* The sums of a block of documents meet in a second shuffle.

Null and empty texts have no tokens and null losses.  Repeated rows count and score each.  A null doc_id is in the
background only.  Without target documents the target model is uniform over the vocabulary.  An empty table gives an
empty result.  Other columns are not read.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import small_side, staged, table, text_of

#: Numbers of frequent words, with 0 (any other) and 1 (start), in the tables that go to every task.
VOCABULARY = 2048
PRIOR = 200.0
#: Tokens of the corpus for each bucket, and bytes of text in a block of documents.
BUCKET_TOKENS = 1 << 19
BLOCK_BYTES = 2 << 20

START = 1
_RARE = np.uint64(1 << 63)


def words_of(text: str) -> list[bytes]:
    return text.lower().encode().split()


def word_counts(texts: DataFrame) -> DataFrame:
    """word, n: every word of all texts."""

    def count(batches):
        seen: Counter = Counter()
        for b in batches:
            for t in b.column(0).to_pylist():
                seen.update(words_of(t))
                if len(seen) > 500_000:
                    yield from _counted(seen)
                    seen.clear()
        yield from _counted(seen)

    return texts.mapInArrow(count, "word binary, n long").groupBy("word").agg(F.sum("n").alias("n"))


def _counted(seen: Counter):
    rows = list(seen.items())
    for i in range(0, len(rows), 100_000):
        some = rows[i : i + 100_000]
        yield pa.RecordBatch.from_arrays([pa.array([w for w, _ in some], pa.binary()), pa.array([n for _, n in some], pa.int64())], names=["word", "n"])


def coded(batches: Iterator[pa.RecordBatch], number: dict[bytes, int]) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """(rows, codes of their words, bounds): parts of batches whose second column is text; a code is a word's number or, with the top bit set, its hash."""
    for batch in batches:
        size = np.cumsum(pc.binary_length(batch.column(1)).to_numpy(zero_copy_only=False).astype(np.int64))
        first = 0
        while first < batch.num_rows:
            last = max(first + 1, int(np.searchsorted(size, (size[first - 1] if first else 0) + BLOCK_BYTES, side="right")))
            part = batch.slice(first, last - first)
            lower = pa.array([t.lower() for t in part.column(1).to_pylist()], pa.large_string())
            words = pc.ascii_split_whitespace(lower)
            bounds = words.offsets.to_numpy().astype(np.int64)
            known = words.flatten().dictionary_encode()
            different = [w.encode() for w in known.dictionary.to_pylist()]
            code = np.fromiter((number.get(w) or xxhash.xxh3_64_intdigest(w) | 1 << 63 for w in different), np.uint64, len(different))
            at = known.indices.to_numpy(zero_copy_only=False)
            if b"" in different:  # blanks at the ends of a text
                kept = at != different.index(b"")
                bounds = np.concatenate(([0], np.cumsum(kept)))[bounds]
                at = at[kept]
            yield part, code[at], bounds
            first = last


def _neighbours(codes: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """The code before each, START at the beginning of a text."""
    before = np.concatenate(([START], codes[:-1])).astype(np.uint64)[: len(codes)]
    before[bounds[:-1][bounds[:-1] < bounds[1:]]] = START
    return before


def pair_counts(marked: DataFrame, words: list[bytes]) -> DataFrame:
    """first, second, background, target: counts of neighbours, by number; ``marked`` has is_target and text."""
    shared = marked.sparkSession.sparkContext.broadcast({w: i for i, w in enumerate(words, 2)})
    size = len(words) + 2

    def count(batches):
        total = np.zeros((2, size * size), np.int64)
        for part, codes, bounds in coded(batches, shared.value):
            small = lambda x: np.where(x >= _RARE, 0, x).astype(np.int64)
            pairs = small(_neighbours(codes, bounds)) * size + small(codes)
            total[0] += np.bincount(pairs, minlength=size * size)
            chosen = np.repeat(part.column(0).to_numpy(zero_copy_only=False).astype(bool), np.diff(bounds))
            total[1] += np.bincount(pairs[chosen], minlength=size * size)
        seen = np.flatnonzero(total[0])
        for i in range(0, len(seen), 200_000):
            some = seen[i : i + 200_000]
            yield pa.RecordBatch.from_arrays([pa.array((some // size).astype(np.int32)), pa.array((some % size).astype(np.int32)), pa.array(total[0][some]), pa.array(total[1][some])], names=["first", "second", "background", "target"])

    rows = marked.select("is_target", "text").mapInArrow(count, "first int, second int, background long, target long")
    return rows.groupBy("first", "second").agg(F.sum("background").alias("background"), F.sum("target").alias("target"))


class Frequent:
    """Losses of pairs of frequent words, and what the other pairs need; row 0 is the target, row 1 the background."""

    def __init__(self, pairs: DataFrame, size: int, different: int, prior: float):
        single = np.zeros((2, size))
        for r in pairs.groupBy("second").agg(F.sum("background").alias("b"), F.sum("target").alias("t")).collect():  # a row for each number
            single[:, r["second"]] = r["t"], r["b"]
        self.prior, self.scale = prior, np.array([1.0, single[0].sum() / single[1].sum() if single[0].sum() else 1.0])
        single[1] *= self.scale[1]
        #: Tokens and one count for each word.
        self.all = single.sum(axis=1) + different + 1
        self.share = (single + 1) / self.all[:, None]
        share, scale = self.share, self.scale

        def rows_of(t: pa.Table) -> pa.Table:
            counts = np.zeros((2, size))
            at = t.column("second").to_numpy()
            counts[0, at] = t.column("target").to_numpy()
            counts[1, at] = t.column("background").to_numpy()
            counts *= scale[:, None]
            context = np.log(counts.sum(axis=1, keepdims=True) + prior)
            loss = context - np.log(counts + prior * share)
            return pa.table({"first": pa.array([t.column("first")[0].as_py()], pa.int32()), "loss": [loss.astype("<f4").tobytes()], "context": [context.tobytes()]})

        self.context = np.full((2, size), np.log(prior))
        self.loss = np.repeat((np.log(prior) - np.log(prior * share)).astype(np.float32)[:, None, :], size, axis=1)
        for r in pairs.groupBy("first").applyInArrow(rows_of, "first int, loss binary, context binary").toLocalIterator():  # a row for each number
            self.loss[:, r["first"]] = np.frombuffer(r["loss"], "<f4").reshape(2, size)
            self.context[:, r["first"]] = np.frombuffer(r["context"])


def _packed(first: np.ndarray, second: np.ndarray, row: np.ndarray, mark: np.ndarray) -> bytes:
    """Pairs sorted by their second word, byte by byte of each column, compressed."""
    planes = [np.ascontiguousarray(x).view(np.uint8).reshape(len(x), -1).T.tobytes() for x in (second, first, row, mark)]
    return zstandard.ZstdCompressor(level=1).compress(b"".join(planes))


def _unpacked(blob: bytes) -> tuple[np.ndarray, ...]:
    raw = np.frombuffer(zstandard.ZstdDecompressor().decompress(blob), np.uint8)
    n, at, out = len(raw) // 24, 0, []
    for kind in (np.uint64, np.uint64, np.uint32, np.uint32):
        wide = np.dtype(kind).itemsize
        out.append(np.ascontiguousarray(raw[at : at + wide * n].reshape(wide, n).T).view(kind).reshape(-1))
        at += wide * n
    second, first, row, mark = out
    return first, second, row, mark


_DOCUMENT = np.dtype([("known", "?"), ("doc_id", "<i8"), ("n", "<i8"), ("sums", "<f8", 2)])
_SUMS = np.dtype([("row", "<u4"), ("sums", "<f4", 2)])


def _dealt(batches: Iterator[pa.RecordBatch], number: dict, frequent: Frequent, buckets: int) -> Iterator[pa.RecordBatch]:
    """Rows (is_target, text, doc_id) as (bucket, block, blob): pairs for the buckets; below zero, a block's documents with their sums so far."""
    size, task, k = frequent.share.shape[1], TaskContext.get().partitionId(), 0
    table_of = frequent.loss.reshape(2, -1)
    for part, codes, bounds in coded(batches, number):
        block, k = task << 32 | k, k + 1
        n = np.diff(bounds)
        row = np.repeat(np.arange(len(n)), n)
        before = _neighbours(codes, bounds)
        rare, rare_before = codes >= _RARE, before >= _RARE
        docs = np.zeros(len(n), _DOCUMENT)
        ids = part.column(2)
        docs["known"], docs["doc_id"], docs["n"] = ids.is_valid().to_numpy(zero_copy_only=False), ids.fill_null(0).to_numpy(), n
        both = ~rare & ~rare_before
        at = (before[both] * np.uint64(size) + codes[both]).astype(np.int64)
        only = rare & ~rare_before  # what the first word adds to a pair is known here
        contexts = before[only].astype(np.int64)
        for i in (0, 1):
            docs["sums"][:, i] = np.bincount(row[both], table_of[i][at], len(n)) + np.bincount(row[only], frequent.context[i][contexts], len(n))
        out: list = [[-1 - block], [block], [docs.tobytes()]]
        last = np.zeros(len(codes), bool)
        last[bounds[1:][n > 0] - 1] = True
        target = part.column(0).to_numpy(zero_copy_only=False).astype(bool)
        where = np.flatnonzero(~both)
        if len(where):
            first, second, row, last = before[where], codes[where], row[where], last[where]
            bucket = (np.where(second >= _RARE, second, first) >> np.uint64(8)) % np.uint64(buckets)
            order = np.lexsort((row, first, second, bucket))
            bucket, first, second, row, last = (x[order] for x in (bucket, first, second, row, last))
            new = np.concatenate(([True], (second[1:] != second[:-1]) | (first[1:] != first[:-1]) | (row[1:] != row[:-1])))
            start = np.flatnonzero(new)
            mark = np.diff(np.append(start, len(row))) * 4 + np.bitwise_or.reduceat(last, start) * 2 + target[row[start]]
            bucket, first, second, row, mark = bucket[start], first[start], second[start], row[start].astype(np.uint32), mark.astype(np.uint32)
            cuts = np.concatenate((np.flatnonzero(np.diff(bucket, prepend=bucket[:1] + np.uint64(1))), [len(bucket)]))
            for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist()):
                for x, value in zip(out, (int(bucket[a]), block, _packed(first[a:b], second[a:b], row[a:b], mark[a:b]))):
                    x.append(value)
        yield pa.RecordBatch.from_arrays([pa.array(out[0], pa.int64()), pa.array(out[1], pa.int64()), pa.array(out[2], pa.binary())], names=["bucket", "block", "blob"])


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, list, list]]:
    """(key, second column, third column) for each run of equal keys in the first column."""
    key, held = None, ([], [])
    for b in batches:
        for k, *rest in zip(*((x.as_py() for x in c) for c in b.columns)):  # a blob at a time
            if k != key:
                if key is not None:
                    yield key, *held
                key, held = k, ([], [])
            for x, value in zip(held, rest):
                x.append(value)
    if key is not None:
        yield key, *held


def bucket_sums(first, second, mark, frequent: Frequent) -> np.ndarray:
    """Losses (target, background) that the rows of a bucket add to their documents."""
    n, last, target = (mark >> 2).astype(np.float64), mark >> 1 & 1, (mark & 1).astype(np.float64)
    order = np.lexsort((first, second))
    changed = (np.diff(second[order], prepend=0) != 0) | (np.diff(first[order], prepend=0) != 0)
    changed[:1] = True
    pair, word = np.empty(len(n), np.int64), np.empty(len(n), np.int64)
    pair[order] = np.cumsum(changed) - 1
    changed = np.diff(second[order], prepend=0) != 0
    changed[:1] = True
    word[order] = np.cumsum(changed) - 1
    rare, as_first = second >= _RARE, n - last
    number = np.where(rare, 0, second).astype(np.int64)
    out = np.empty((len(n), 2))
    for i, weight in enumerate((target, np.ones(len(n)))):
        scale = frequent.scale[i]
        count = np.bincount(pair, n * weight)[pair] * scale
        share = np.where(rare, (np.bincount(word, n * weight)[word] * scale + 1) / frequent.all[i], frequent.share[i][number])
        context = np.log(np.bincount(word, as_first * weight)[word] * scale + frequent.prior)
        out[:, i] = np.where(rare, as_first * context, 0) - n * np.log(count + frequent.prior * share)
    return out


def _scored(batches: Iterator[pa.RecordBatch], frequent: Frequent) -> Iterator[pa.RecordBatch]:
    """Sorted rows (bucket, block, blob) as (block, place, blob): sums of each block's documents; the documents themselves have place 0."""
    for bucket, blocks, blobs in _runs(batches):
        if bucket < 0:
            yield pa.RecordBatch.from_arrays([pa.array(blocks, pa.int64()), pa.array([0] * len(blocks), pa.int64()), pa.array(blobs, pa.binary())], names=["block", "place", "blob"])
            continue
        parts = [_unpacked(x) for x in blobs]
        first, second, row, mark = (np.concatenate(x) for x in zip(*parts))
        sums = bucket_sums(first, second, mark, frequent)
        out, a = [], 0
        for part in parts:
            b = a + len(part[2])
            rows, inverse = np.unique(row[a:b], return_inverse=True)
            some = np.zeros(len(rows), _SUMS)
            some["row"] = rows
            for i in (0, 1):
                some["sums"][:, i] = np.bincount(inverse.reshape(-1), sums[a:b, i])
            out.append(some.tobytes())
            a = b
        yield pa.RecordBatch.from_arrays([pa.array(blocks, pa.int64()), pa.array([bucket + 1] * len(out), pa.int64()), pa.array(out, pa.binary())], names=["block", "place", "blob"])


def lm_score(docs: DataFrame, targets: DataFrame, size: int = VOCABULARY, prior: float = PRIOR) -> DataFrame:
    """doc_id, n_tokens, target_loss, background_loss, difference per document; ``targets`` has the doc_id of target documents."""
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of(docs).alias("text"))
    counts = staged(word_counts(texts.select("text")), "words")
    different, n_tokens = counts.agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
    words = [bytes(r["word"]) for r in counts.orderBy(F.desc("n"), "word").limit(size - 2).collect()]
    chosen = small_side(targets.select(F.col("doc_id").cast("long").alias("doc_id")).where("doc_id is not null").distinct().withColumn("is_target", F.lit(True)), "targets")
    marked = texts.join(chosen, "doc_id", "left").select(F.coalesce("is_target", F.lit(False)).alias("is_target"), "text", "doc_id")
    context = docs.sparkSession.sparkContext
    number = context.broadcast({w: i for i, w in enumerate(words, 2)})
    frequent = context.broadcast(Frequent(staged(pair_counts(marked, words), "pair-counts"), len(words) + 2, different, prior))
    buckets = n_tokens // BUCKET_TOKENS + 1
    schema = pa.schema([("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("target_loss", pa.float64()), ("background_loss", pa.float64())])

    def deal(batches):
        return _dealt(batches, number.value, frequent.value, buckets)

    def score(batches):
        return _scored(batches, frequent.value)

    def add(batches):
        for _, places, blobs in _runs(batches):
            docs = np.frombuffer(blobs[places.index(0)], _DOCUMENT).copy()
            for place, blob in zip(places, blobs):
                if place:
                    some = np.frombuffer(blob, _SUMS)
                    docs["sums"][some["row"]] += some["sums"]
            mean = [[float(s / n) if n else None for s, n in zip(docs["sums"][:, i].tolist(), docs["n"].tolist())] for i in (0, 1)]
            ids = pa.array(docs["doc_id"], mask=~docs["known"])
            yield table(schema, doc_id=ids, n_tokens=docs["n"], target_loss=mean[0], background_loss=mean[1])

    dealt = marked.mapInArrow(deal, "bucket long, block long, blob binary")
    sums = dealt.repartition("bucket").sortWithinPartitions("bucket", "block").mapInArrow(score, "block long, place long, blob binary")
    scored = sums.repartition("block").sortWithinPartitions("block", "place").mapInArrow(add, "doc_id long, n_tokens long, target_loss double, background_loss double")
    return scored.withColumn("difference", F.col("target_loss") - F.col("background_loss"))
