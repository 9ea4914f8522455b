"""Removal of lines that match an earlier line, by an exact set-similarity join of their words.

A line is the set of its words (runs without ASCII white space, A-Z in lower case); lines of fewer than ``MIN_WORDS``
different words take no part.  Two lines match at a Jaccard similarity of 0.8 or more.  A line goes if any earlier line
of the corpus (by doc_id, then place in the text) matches it.

* Words are ordered by rarity: by how often the corpus has the words of their hash bucket, then by hash.  The table
  has ``BUCKETS`` entries, whatever the corpus; any order gives right results, a good one short groups.
* Equal sets are one set with its earliest place.  Sets are numbered in order of place.
* Prefix filter: sets that match share one of their rarest ``n - ceil(0.8 n) + 1`` words, or two of one more.  A set
  goes to the group of each of these words but those that the corpus has once only.
* In a group, pairs must pass the length filter, the positional filter (the words behind the shared one must still
  suffice) and a bitmap filter (256 parities of hashed words differ in no more places than the sets may).
* Three steps, each for the sets that the one before left open; a match is decided on the words themselves:

  1. Groups of a word, a crowded one dealt over chunks.  A set names its earliest partner of each chunk, so the
     variants of one line, thousands or not, are settled by the few that come first.
  2. Sets whose partner failed, or that have a crowded word: a crowded word's group is cut by the second shared word,
     and what is still crowded into pairs of chunks.  Only the open sets look for partners, 16 in each group.
  3. Sets with still more partners: the groups get the words along and verify on the spot, naming no pairs.

Null texts have no lines.  Rows alike in doc_id and text are one document.  A null doc_id counts as -1 in the order.
Empty and blank lines stay.  An empty table gives an empty result.  Other columns are left alone.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, LongType, StringType, StructField, StructType

from .common import free_name, in_parts, lean, small_side, staged, table, text_of, word_hashes

MIN_WORDS = 5
#: Entries of the table of word frequencies.
BUCKETS = 1 << 20
#: Sets of a word's group that a task compares with each other, or chunk with chunk.
CHUNK = 2048
#: As many times larger are the chunks in which only open sets look for partners.
WIDER = 8

#: Bytes of text whose words are looked at together, and rows whose groups are.
AT_ONCE = 2 << 20
ROWS_AT_ONCE = 100_000

_FULL = (1 << 20) - 1
#: Longs of parities of a set.
SIGNATURE = ["b0", "b1", "b2", "b3"]
#: Partners that an open set names in each group before the groups verify on the spot.
PARTNERS = 16


def line_words(line: bytes) -> set[bytes]:
    return set(line.lower().split())


def _keyed(docs: DataFrame) -> DataFrame:
    text = text_of(docs)
    return docs.select(F.coalesce(docs["doc_id"].cast("long"), F.lit(-1).cast("long")).alias("id"), F.xxhash64(text).alias("mark"), text.alias("text"))


class Words:
    """The words of all lines of a batch of texts, and what is needed of each different word."""

    def __init__(self, texts: pa.Array):
        cut = pc.split_pattern(texts.cast(pa.large_string()), "\n")
        self.text_bounds = cut.offsets.to_numpy().astype(np.int64)
        words = pc.ascii_split_whitespace(pc.ascii_lower(cut.flatten()))
        bounds = words.offsets.to_numpy().astype(np.int64)
        coded = words.flatten().dictionary_encode()
        self.word = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        self.line = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
        empty = np.flatnonzero(pc.binary_length(coded.dictionary).to_numpy() == 0)
        if len(empty):  # blanks at the ends of a line
            kept = self.word != empty[0]
            self.word, self.line = self.word[kept], self.line[kept]
        self.hashes = word_hashes(coded.dictionary)

    @staticmethod
    def of(batches):
        """(rows, words) for parts of the batches' last column of a few megabytes."""
        for b in batches:
            size = np.cumsum(pc.binary_length(b.column(b.num_columns - 1)).to_numpy(zero_copy_only=False).astype(np.int64))
            first = 0
            while first < b.num_rows:
                last = max(first + 1, int(np.searchsorted(size, (size[first - 1] if first else 0) + AT_ONCE, side="right")))
                part = b.slice(first, last - first)
                yield part, Words(part.column(part.num_columns - 1))
                first = last


def _packed(df: DataFrame, column: str = "text") -> DataFrame:
    """``df`` with a text column compressed, for a shuffle; null stays null."""
    at = df.columns.index(column)
    schema = df.schema
    schema = StructType([StructField(f.name, BinaryType()) if i == at else f for i, f in enumerate(schema)])

    def run(batches):
        pack = zstandard.ZstdCompressor(level=1).compress
        for b in in_parts(batches):
            packed = pa.array([None if t is None else pack(t.encode()) for t in b.column(at).to_pylist()], pa.binary())
            yield pa.RecordBatch.from_arrays([*b.columns[:at], packed, *b.columns[at + 1 :]], names=b.schema.names)

    return df.mapInArrow(lean(run), schema)


def _unpacked(values: list) -> list[bytes | None]:
    read = zstandard.ZstdDecompressor().decompress
    return [None if v is None else read(v) for v in values]


def word_frequencies(rows: DataFrame) -> np.ndarray:
    """Occurrences by hash bucket of the words."""

    def count(batches):
        total = np.zeros(BUCKETS, np.int64)
        for _, w in Words.of(batches):
            np.add.at(total, (w.hashes % np.uint64(BUCKETS)).astype(np.int64), np.bincount(w.word, minlength=len(w.hashes)))
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(total[at])], names=["bucket", "n"])

    counts = rows.select("text").mapInArrow(lean(count), "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n")).toArrow()
    out = np.zeros(BUCKETS, np.int64)
    out[counts.column("bucket").to_numpy()] = counts.column("n").to_numpy()
    return out


def _mixed(h: np.ndarray, step: int) -> np.ndarray:
    h = (h ^ (h >> np.uint64(31))) * np.uint64(step)
    return h ^ (h >> np.uint64(29))


def line_sets(rows: DataFrame, frequency: np.ndarray, min_words: int) -> DataFrame:
    """id, mark, line, s1 and s2 (128 bits for the set), size, parities, prefix (32-bit hashes, rarest first, 0 for words that no other line has)."""
    shared = rows.sparkSession.sparkContext.broadcast(frequency)
    schema = pa.schema([("id", pa.int64()), ("mark", pa.int64()), ("line", pa.int32()), ("s1", pa.int64()), ("s2", pa.int64()), ("size", pa.int32()), *((c, pa.int64()) for c in SIGNATURE), ("prefix", pa.list_(pa.int32()))])

    def sets(batches):
        for part, w in Words.of(batches):
            # rank of each different word by rarity, then each line's different words in this order
            often = shared.value[(w.hashes % np.uint64(BUCKETS)).astype(np.int64)]
            order = np.lexsort((w.hashes, often))
            rank = np.empty(len(order), np.int64)
            rank[order] = np.arange(len(order))
            pairs = np.sort(w.line * len(order) + rank[w.word])
            pairs = pairs[np.diff(pairs, prepend=-1) > 0]
            line, word = pairs // max(1, len(order)), order[pairs % max(1, len(order))]
            sizes = np.bincount(line, minlength=int(w.text_bounds[-1]))
            kept = sizes[line] >= min_words
            line, word = line[kept], word[kept]
            if not len(line):
                continue
            h = w.hashes[word]
            starts = np.flatnonzero(np.concatenate(([True], np.diff(line) > 0)))
            lines, n = line[starts], np.diff(np.append(starts, len(line)))
            text = np.searchsorted(w.text_bounds, lines, side="right") - 1
            many = np.minimum(n, n + 4 * n // -5 + 2)
            inside = np.arange(len(line)) - np.repeat(starts, n)
            prefix = np.where(often[word] > 1, h.astype(np.uint32).view(np.int32), 0)[inside < np.repeat(many, n)]
            bit, place = np.uint64(1) << (h >> np.uint64(58)), (h >> np.uint64(56)) & np.uint64(3)
            bits = {c: np.bitwise_xor.reduceat(np.where(place == k, bit, np.uint64(0)), starts).view(np.int64) for k, c in enumerate(SIGNATURE)}
            s1, s2 = (np.add.reduceat(_mixed(h, k), starts).view(np.int64) for k in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F))
            lists = pa.ListArray.from_arrays(pa.array(np.concatenate(([0], np.cumsum(many))).astype(np.int32)), pa.array(prefix))
            where = pa.array(text)
            yield table(schema, id=part.column(0).take(where), mark=part.column(1).take(where), line=(lines - w.text_bounds[text]).astype(np.int32), s1=s1, s2=s2, size=n.astype(np.int32), prefix=lists, **bits)

    return rows.mapInArrow(lean(sets), f"id long, mark long, line int, s1 long, s2 long, size int, {', '.join(f'{c} long' for c in SIGNATURE)}, prefix array<int>")


_ROW = ["key", "i", "j", "meta", "set", *SIGNATURE, "asks"]
#: Values of ``asks``: a set that others may find, one that looks for an earlier one, and one that does both.
_FOUND, _LOOKS, _BOTH = 1, 2, 3


def _alike(a, b) -> bool:
    """Jaccard similarity of 0.8 or more, of sorted arrays of different words' hashes."""
    return 9 * len(np.intersect1d(a, b, assume_unique=True)) >= 4 * (len(a) + len(b))


def _candidates(batches, k: int | None):
    """Rows of ``_ROW`` sorted by the first three and the set: (later, earlier, more) pairs that pass the filters, up to
    ``k`` and one for each later set of a group.  Without ``k`` the rows end with the sets' words, and the pairs are verified ones."""
    held: list = []

    def pairs(parts: list):
        rows = np.concatenate([r for r, _ in parts])
        words = [w for _, part in parts for w in part] if k is None else None
        group = np.concatenate(([0], np.cumsum((np.diff(rows[:, :3], axis=0) != 0).any(axis=1))))
        size, place, numbers = rows[:, 3] >> 20, rows[:, 3] & _FULL, rows[:, 4]
        bits = np.ascontiguousarray(rows[:, 5:9]).view(np.uint64)
        found_by, looks = (rows[:, 9] & _FOUND) > 0, (rows[:, 9] & _LOOKS) > 0
        found, named, most = [], np.zeros(len(rows), np.int64), k or 0
        start = np.flatnonzero(np.concatenate(([True], np.diff(group) != 0)))
        length = np.diff(np.append(start, len(rows)))
        # the p-th entry of each group is offered to all that stand behind it
        p = 0
        live = np.flatnonzero(length > 1)
        while len(live):
            many = length[live] - p - 1
            live, many = live[many > 0], many[many > 0]
            if not len(live):
                break
            known = found_by[start[live] + p]
            a = np.repeat(start[live] + p, np.where(known, many, 0))
            b = a + 1 + np.arange(len(a)) - np.repeat(np.cumsum(many[known]) - many[known], many[known])
            fit = looks[b] & (named[b] <= most)
            a, b = a[fit], b[fit]
            sa, sb = size[a], size[b]
            need = -(-4 * (sa + sb) // 9)
            fit = (5 * np.minimum(sa, sb) >= 4 * np.maximum(sa, sb)) & (numbers[a] != numbers[b])
            fit &= 1 + np.minimum(sa - place[a] - 1, sb - place[b] - 1) >= need
            a, b, spare = a[fit], b[fit], (sa + sb - 2 * need)[fit]
            fit = np.bitwise_count(bits[a] ^ bits[b]).sum(axis=1, dtype=np.int64) <= spare
            a, b = a[fit], b[fit]
            if words is not None:
                fit = np.fromiter((_alike(words[x], words[y]) for x, y in zip(a, b)), bool, len(a))
                a, b = a[fit], b[fit]
            named[b] += 1
            if len(b):
                found.append((numbers[b], numbers[a], named[b] > most))
            p += 1
        later, earlier, more = (np.concatenate(x) for x in zip(*found)) if found else (np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, bool))
        return pa.RecordBatch.from_arrays([pa.array(later), pa.array(earlier), pa.array(more)], names=["later", "earlier", "more"])

    size = 0
    for batch in batches:
        rows = np.stack([c.to_numpy() for c in batch.columns[: len(_ROW)]], axis=1)
        if not len(rows):
            continue
        words = [] if k is not None else [np.array(w, np.int64) for w in batch.column(len(_ROW)).to_pylist()]
        held.append((rows, words))
        size += len(rows)
        ends = np.flatnonzero((rows[:, :3] != rows[-1, :3]).any(axis=1))
        if len(ends) and size >= ROWS_AT_ONCE:
            cut = ends[-1] + 1
            yield pairs([*held[:-1], (rows[:cut], words[:cut])])
            held = [(rows[cut:], words[cut:])]
            size = len(rows) - cut
    if held:
        yield pairs(held)


def _words_of(rows: DataFrame, sets: DataFrame) -> DataFrame:
    """set, words: the sorted hashes of the words of the given sets (set, id, mark, line), from the texts."""
    schema = pa.schema([("set", pa.int64()), ("words", pa.list_(pa.int64()))])

    def read(batches):
        for b in batches:
            for i in range(0, b.num_rows, 500):
                out: list = [[], []]
                texts, many = (c.to_pylist() for c in b.slice(i, 500).columns)
                for text, wanted in zip(_unpacked(texts), many):
                    lines = text.split(b"\n")
                    for w in wanted:
                        words = line_words(lines[w["line"]])
                        out[0].append(w["set"])
                        out[1].append(np.sort(np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words)).view(np.int64)))
                yield table(schema, set=out[0], words=out[1])

    wanted = sets.groupBy("id", "mark").agg(F.collect_list(F.struct("set", "line")).alias("wanted"))
    wanted = small_side(wanted, "wanted")
    texts = _packed(rows.join(wanted.select("id", "mark"), ["id", "mark"], "left_semi")).join(wanted, ["id", "mark"]).select("text", "wanted")
    return texts.mapInArrow(lean(read), "set long, words array<long>").dropDuplicates(["set"])


def _verified(batches):
    """Rows (later, more, a, b): later, match, more."""
    for batch in batches:
        later, more, a, b = batch.columns
        a, b = ([np.array(x, np.int64) for x in c.to_pylist()] for c in (a, b))
        match = np.fromiter(map(_alike, a, b), bool, len(a))
        yield pa.RecordBatch.from_arrays([later, pa.array(match), more], names=["later", "match", "more"])


def _sorted_groups(entries: DataFrame) -> DataFrame:
    return entries.repartition("key", "i", "j").sortWithinPartitions("key", "i", "j", "set")


def _chunks(n: str, wider: int = 1):
    return F.coalesce(F.ceil(F.col(n) / (wider * CHUNK)), F.lit(1)).cast("long")


def _part(of: str):
    return F.pmod(F.xxhash64("set"), F.col(of))


def _dealt(entries: DataFrame, asked: DataFrame) -> DataFrame:
    """Groups of bounded size in which each asked set meets every set that shares a key with it."""
    keys = entries.join(asked, "set", "left_semi").groupBy("key").agg(F.count("*").alias("n_asked"))
    entries = entries.join(staged(keys, "asked-keys"), "key")
    entries = staged(entries, "asked-entries")
    crowded = small_side(entries.groupBy("key").agg(F.count("*").alias("n")).where(F.col("n") > WIDER * CHUNK), "crowded-keys")
    entries = entries.join(crowded, "key", "left").select("key", "meta", "set", *SIGNATURE, _chunks("n", WIDER).alias("k"), _chunks("n_asked", WIDER).alias("k_asked"))
    every = lambda c: F.explode(F.sequence(F.lit(0).cast("long"), F.col(c) - 1))
    rest = ["meta", "set", *SIGNATURE]
    found = entries.select("key", _part("k").alias("i"), every("k_asked").alias("j"), *rest, F.lit(_FOUND).cast("long").alias("asks"))
    looks = entries.join(asked, "set", "left_semi").select("key", every("k").alias("i"), _part("k_asked").alias("j"), *rest, F.lit(_LOOKS).cast("long").alias("asks"))
    return found.union(looks)


def matched_sets(rows: DataFrame, sets: DataFrame) -> DataFrame:
    """The sets that match one of an earlier place."""
    prefix = "size - (4 * size + 4) div 5 + 1"  # words of which one is shared
    index = sets.where("size > 3").select("set", "size", *SIGNATURE, "prefix", F.posexplode(F.expr(f"slice(prefix, 1, cast({prefix} as int))")).alias("place", "word")).where("word != 0")
    meta = (F.shiftleft(F.col("size").cast("long"), 20) + F.least("place", F.lit(_FULL))).alias("meta")
    columns = [F.col("word").cast("long").alias("key"), meta, "set", *SIGNATURE]
    crowded = small_side(index.groupBy(F.col("word").cast("long").alias("key")).agg(F.count("*").alias("n")).where(F.col("n") > CHUNK), "crowded")

    def settled(named: DataFrame) -> tuple[DataFrame, DataFrame]:
        """The later sets of verified pairs, and those without such a pair that have more."""
        named = staged(named.groupBy("later", "earlier").agg(F.max("more").alias("more")), "named-pairs")
        ids = named.select(F.col("later").alias("set")).union(named.select("earlier")).distinct()
        words = staged(_words_of(rows, sets.join(ids, "set").select("set", "id", "mark", "line")), "words")
        pairs = named.join(words.select(F.col("set").alias("later"), F.col("words").alias("a")), "later").join(words.select(F.col("set").alias("earlier"), F.col("words").alias("b")), "earlier")
        verdicts = pairs.select("later", "more", "a", "b").mapInArrow(lean(_verified), "later long, match boolean, more boolean")
        found = staged(verdicts.groupBy(F.col("later").alias("set")).agg(F.max("match").alias("match"), F.max("more").alias("more")), "verdicts")
        return found.where("match").select("set"), found.where("more and not match").select("set")

    def named_in(groups: DataFrame, k: int | None) -> DataFrame:
        return _sorted_groups(groups).mapInArrow(lean(lambda b: _candidates(b, k)), "later long, earlier long, more boolean")

    home = index.select(*columns).join(crowded, "key", "left").withColumn("k", _chunks("n"))
    home = home.select("key", _part("k").alias("i"), F.lit(0).cast("long").alias("j"), "meta", "set", *SIGNATURE, F.lit(_BOTH).cast("long").alias("asks"))
    done, asked = settled(named_in(home, 1))
    crowds = not crowded.isEmpty()
    if crowds:
        asked = asked.union(index.select(*columns).join(crowded, "key", "left_semi").select("set").distinct().join(done, "set", "left_anti")).distinct()
    asked = small_side(asked, "asked")
    if asked.isEmpty():
        return done

    entries = index.select(*columns)
    if crowds:
        entries = entries.join(crowded, "key", "left_anti")
        among = index.withColumn("key", F.col("word").cast("long")).join(crowded, "key", "left_semi")
        second = among.select("word", "place", "size", "set", *SIGNATURE, F.explode(F.expr("slice(prefix, place + 2, size)")).alias("second")).where("second != 0")
        entries = entries.union(second.select(F.xxhash64("word", "second").alias("key"), meta, "set", *SIGNATURE))
    groups = staged(_dealt(entries, asked), "asked-groups")
    found, asked = settled(named_in(groups, PARTNERS))
    done = done.union(found)
    asked = small_side(asked, "still-asked")
    if asked.isEmpty():
        return done

    groups = _dealt(entries.join(asked.select("set"), "set", "left_semi").select("key").distinct().join(entries, "key"), asked)
    words = _words_of(rows, sets.join(groups.select("set").distinct(), "set", "left_semi").select("set", "id", "mark", "line"))
    groups = groups.join(words, "set").select(*_ROW, "words")
    found = staged(named_in(groups, None).select(F.col("later").alias("set")).distinct(), "verified")
    return done.union(found)


def removed_lines(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """id, mark and ``gone``: the numbers (from 0) of each text's lines that match an earlier one."""
    rows = _keyed(docs)
    lines = staged(line_sets(rows, word_frequencies(rows), min_words), "lines")
    first = lines.groupBy("s1", "s2").agg(F.min(F.struct("id", "mark", "line")).alias("at"), *(F.first(c).alias(c) for c in ["size", *SIGNATURE, "prefix"]))
    in_order = first.select("s1", "s2", "at.*", "size", *SIGNATURE, "prefix").orderBy("id", "mark", "line")
    sets = staged(in_order.withColumn("set", F.monotonically_increasing_id()), "line-sets")
    matched = matched_sets(rows, sets).withColumn("late", F.lit(True))
    known = sets.select("s1", "s2", "set", F.struct("id", "mark", "line").alias("at")).join(matched, "set", "left")
    seen = lines.select("s1", "s2", "id", "mark", "line").join(known, ["s1", "s2"])
    gone = seen.where(F.coalesce("late", F.lit(False)) | (F.struct("id", "mark", "line") > F.col("at")))
    return gone.groupBy("id", "mark").agg(F.array_sort(F.collect_set("line")).alias("gone"))


def _taken_out(joined: DataFrame) -> DataFrame:
    """``joined`` (with ``text`` packed, and ``gone`` last) with the text left, and the number of lines in place of ``gone``."""
    at = joined.columns.index("text")
    fields = [StructField(f.name, StringType()) if i == at else f for i, f in enumerate(joined.schema)]
    schema = StructType([*fields[:-1], StructField("n_lines", LongType())])

    def run(batches):
        for b in in_parts(batches):
            kept, n = [], []
            for text, gone in zip(_unpacked(b.column(at).to_pylist()), b.column(b.num_columns - 1).to_pylist()):
                lines = (text or b"").split(b"\n")
                n.append(len(lines))
                if gone:
                    late = set(gone)
                    text = b"\n".join(x for i, x in enumerate(lines) if i not in late)
                kept.append(None if text is None else text.decode())
            columns = [pa.array(kept, pa.string()) if i == at else c for i, c in enumerate(b.columns[:-1])]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(n, pa.int64())], names=[*b.schema.names[:-1], "n_lines"])

    return joined.mapInArrow(lean(run), schema)


def line_dedup(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """doc_id, n_lines, n_removed and ``kept`` (the text left) per document."""
    gone = removed_lines(docs, min_words)
    rows = docs.select(docs["doc_id"].cast("long").alias("doc_id"), text_of(docs).alias("text"))
    rows = rows.withColumn("id", F.coalesce("doc_id", F.lit(-1).cast("long"))).withColumn("mark", F.xxhash64("text"))
    joined = _packed(rows).join(gone, ["id", "mark"], "left")
    out = _taken_out(joined.select("doc_id", "text", F.coalesce(F.size("gone"), F.lit(0)).cast("long").alias("n_removed"), "gone"))
    return out.select("doc_id", "n_lines", "n_removed", F.col("text").alias("kept"))


def keep_new_lines(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """``docs`` with the matching lines taken out of ``text``; rows that thus lose their last word go."""
    gone = removed_lines(docs, min_words)
    rest = F.struct(*(docs[c] for c in docs.columns if c != "text"), F.lit(0).alias(free_name(docs, "_"))).alias("rest")
    text = text_of(docs)
    rows = docs.select(F.coalesce(docs["doc_id"].cast("long"), F.lit(-1).cast("long")).alias("id"), F.xxhash64(text).alias("mark"), rest, docs["text"])
    joined = _packed(rows).join(gone, ["id", "mark"], "left").select("rest", F.col("gone").isNotNull().alias("shorter"), "text", "gone")
    out = _taken_out(joined).where("not shorter or text rlike '[^ \\\\t-\\\\r]'")
    return out.select(*(F.col("text") if c == "text" else F.col("rest").getField(c).alias(c) for c in docs.columns))
