"""Phrase collocations: frequent phrases whose words come together more often than their parts would by chance.

Texts are lower-cased (A-Z), split at ``[.,;:!?]`` and line ends into pieces and those at blanks and tabs into words.
Everything is per language (null: ``und``).  A phrase of up to ``SIZE`` words is a candidate if it occurs at least
``LEAST`` times inside pieces; its score is the least of ``SCALE * a * a / (l * r)`` over the cuts into a first part
(l occurrences) and a rest (r).  Candidates inside a longer one with at least half their occurrences are dropped.

1. *Candidate search, level by level.*  A phrase of k words can be frequent only if both its phrases of k - 1 words are.
   Each task counts the phrases that pass the level before, by the hashes of their words, and Spark sums these counts;
   those of ``LEAST`` or more set a bit in a map of ``2 ** BITS`` bits (16 MB whatever the corpus), which the next level
   reads.  Collisions let phrases through and raise sums, but never keep one back: the sums are upper bounds.
2. *Order.*  With the counts of its first and last word a candidate's sum bounds its score from above.  Candidates are
   taken in the order of these bounds, ``AHEAD`` times the wanted number of each language at first, more as long as
   one that was not taken could still be listed.  So the number of candidates in a trie does not grow with the corpus.
3. *Counts.*  The candidates taken, the longer ones around them and all their parts become double-array tries over
   language and word numbers (``tries``), at most about ``BLOCK`` phrases in one, which are broadcast.  Every text
   position starts in its language's state; numpy moves all positions one word further at a time, and accepting states
   are counted by ``bincount``.  A task returns the sums of its shard, Spark adds the shards up.  All that
   is returned, and the longer phrases that push others out, come from these counts.
4. *Scores* are taken in decimals of 38 digits.  First phrases are found within salted parts of a language first.

Hashes of words have 64 bits.  Frequent words that share one, or a candidate whose count falls short of its sum, start the
search again with another seed.

Null and empty texts hold no words.  Repeated rows count as often as they occur.  A language without a candidate, and an
empty table, give no rows.  Columns other than text and lang are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import count

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import staged, text_of
from .tries import DoubleArray, build

#: Words of the longest phrase, and occurrences of the rarest.
SIZE, LEAST = 3, 10
#: A candidate goes if a longer one around it has this many hundredths of its occurrences.
SHARE = 50
SCALE = 1_000_000
#: Bits of the map of frequent hashes, as a power of two.
BITS = 27
#: Candidates that are counted at first, as a multiple of the phrases wanted.
AHEAD = 8
#: Phrases of one trie, and bytes of them.
BLOCK, BLOCK_BYTES = 500_000, 16_000_000
#: Words of documents that are looked at together.
TOGETHER = 1 << 20
#: Parts of a language whose first phrases are found on their own.
PARTS = 64

_ENDS = b".,;:!?\n\x0b\x0c\r"
#: Bytes that no text contains: the end of a piece, and that of a document.
_PIECE, _TEXT = b"\xff", b"\xfe"
_PLAIN = bytes.maketrans(b"\tABCDEFGHIJKLMNOPQRSTUVWXYZ" + _ENDS, b" abcdefghijklmnopqrstuvwxyz" + _PIECE * len(_ENDS))
#: What stands before the texts, so that the ends and the empty word between two blanks have the numbers 0, 1 and 2.
_BEFORE = _PIECE + b" " + _TEXT + b"  "
_ODD = np.array([xxhash.xxh64_intdigest(str(k), 21) | 1 for k in range(SIZE + 1)], np.uint64)


class _Numbers(dict):
    def __missing__(self, word):
        self[word] = number = len(self)
        return number


@dataclass
class Words:
    """The words of some documents, one after the other."""

    codes: np.ndarray  # number of each word in ``vocabulary``
    vocabulary: list[bytes]
    lang: np.ndarray  # number of each word's language in ``langs``
    langs: list[str]
    joined: np.ndarray  # whether the next word is in the same piece


def read_words(batches: Iterator[pa.RecordBatch]) -> Iterator[Words]:
    """Rows (lang, text) as words of about ``TOGETHER`` at a time."""

    def taken(langs: list[str], texts: list[bytes]) -> Words:
        plain = _TEXT.join(texts).translate(_PLAIN)
        plain = _BEFORE + plain.replace(_PIECE, b" \xff ").replace(_TEXT, b" \xfe ")
        words = pc.split_pattern(pa.array([plain], pa.large_binary()), b" ").flatten().dictionary_encode()
        codes = words.indices.to_numpy()[3:]
        codes = codes[codes != 2].astype(np.int64)
        lang_numbers = _Numbers()
        of_text = np.fromiter(map(lang_numbers.__getitem__, langs), np.int64, len(langs))
        at = np.flatnonzero(codes > 2)
        joined = np.append(np.diff(at) == 1, False)[: len(at)]
        lang = of_text[np.cumsum(codes == 1)[at]]
        return Words(codes[at] - 3, words.dictionary.to_pylist()[3:], lang, list(lang_numbers), joined)

    langs: list[str] = []
    texts: list[bytes] = []
    size = 0
    for batch in batches:
        for lang, text in zip(batch.column(0).to_pylist(), batch.column(1)):
            langs.append(lang)
            texts.append(text.as_py().encode())
            size += len(texts[-1]) // 6 + 1
            if size >= TOGETHER:
                yield taken(langs, texts)
                langs, texts, size = [], [], 0
    if texts:
        yield taken(langs, texts)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _together(hashes: list[np.ndarray]) -> np.ndarray:
    """One hash for phrases whose words have ``hashes``."""
    return _mixed(sum((h * odd for h, odd in zip(hashes, _ODD)), np.zeros(len(hashes[0]), np.uint64)))


def _in_map(bits: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    at = (hashes >> np.uint64(64 - BITS)).astype(np.int64)
    return (bits[at >> 3] >> (at & 7).astype(np.uint8)) & 1 == 1


def word_hashes(words: Words, seed: int) -> np.ndarray:
    """A hash of language and word for each position."""
    of_word = np.fromiter((xxhash.xxh64_intdigest(w, seed) for w in words.vocabulary), np.uint64, len(words.vocabulary))
    of_lang = np.array([xxhash.xxh64_intdigest(s, seed) for s in words.langs], np.uint64)
    return _mixed(of_word[words.codes] + of_lang[words.lang] * _ODD[SIZE])


def frequent_starts(words: Words, of_word: np.ndarray, maps: list[np.ndarray]) -> np.ndarray:
    """Where the phrases of one word more than there are maps start that all the maps let through."""
    starts = np.arange(len(of_word))
    for size, bits in enumerate(maps, 1):
        passed = np.zeros(len(of_word) + 1, bool)
        passed[starts] = _in_map(bits, _together([of_word[starts + k] for k in range(size)]))
        starts = starts[passed[starts] & words.joined[starts + size - 1] & passed[starts + 1]]
    return starts


def _word_counts(docs: DataFrame, seed: int) -> DataFrame:
    """(lang, word, h, a) of all words, written down; without word each language's number of words."""

    def count_batches(batches):
        for words in read_words(batches):
            hashes = word_hashes(words, seed)
            key = words.codes * len(words.langs) + words.lang
            found, first, n = np.unique(key, return_index=True, return_counts=True)
            total = np.bincount(words.lang, minlength=len(words.langs))
            langs, vocabulary = pa.array(words.langs), pa.array(words.vocabulary, pa.binary()).cast(pa.string())
            of_lang = pa.concat_arrays([langs.take(pa.array(words.lang[first])), langs])
            word = pa.concat_arrays([vocabulary.take(pa.array(words.codes[first])), pa.nulls(len(langs), pa.string())])
            h = np.concatenate((hashes[first].view(np.int64), np.zeros(len(langs), np.int64)))
            yield pa.RecordBatch.from_arrays([of_lang, word, pa.array(h), pa.array(np.concatenate((n, total)))], names=["lang", "word", "h", "a"])

    rows = docs.mapInArrow(count_batches, "lang string, word string, h long, a long")
    counts = rows.groupBy("lang", "word", "h").agg(F.sum("a").alias("a"))
    return staged(counts.where(F.col("word").isNull() | (F.col("a") >= LEAST)), "word-counts")


def _phrase_sums(docs: DataFrame, maps: Broadcast, size: int, seed: int) -> DataFrame:
    """(key, most): the sums, ``LEAST`` or more, of the phrases of ``size`` words; key are the words' hashes."""
    names = [f"h{k}" for k in range(size)]

    def count_batches(batches):
        for words in read_words(batches):
            of_word = word_hashes(words, seed)
            starts = frequent_starts(words, of_word, maps.value)
            hashes = [of_word[starts + k] for k in range(size)]
            _, first, n = np.unique(_together(hashes), return_index=True, return_counts=True)
            yield pa.RecordBatch.from_arrays([*(pa.array(h[first].view(np.int64)) for h in hashes), pa.array(n)], names=[*names, "n"])

    rows = docs.mapInArrow(count_batches, ", ".join(f"{c} long" for c in [*names, "n"]))
    sums = rows.groupBy(*names).agg(F.sum("n").alias("most")).where(F.col("most") >= LEAST)
    return staged(sums.select(F.array(*names).alias("key"), "most"), "phrase-sums")


def _bit_map(keys: DataFrame, size: int) -> np.ndarray:
    """The map of the first bits of ``key``: at most 2 ** BITS / 32768 rows of 4 kB reach the driver."""

    def positions(batches):
        for batch in batches:
            hashes = batch.column(0).flatten().to_numpy().view(np.uint64).reshape(-1, size)
            at = _together(list(hashes.T)) >> np.uint64(64 - BITS)
            yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int64) + 1)], names=["at"])

    at = keys.select("key").mapInArrow(positions, "at long")
    parts = at.select(F.bitmap_bucket_number("at").alias("part"), F.bitmap_bit_position("at").alias("bit"))
    out = np.zeros(1 << (BITS - 3), np.uint8)
    for part, bits in parts.groupBy("part").agg(F.bitmap_construct_agg("bit")).toLocalIterator():
        here = out[(part - 1) * 4096 : part * 4096]
        here[:] = np.frombuffer(bits, np.uint8)[: len(here)]
    return out


def candidates(docs: DataFrame, words: DataFrame, seed: int) -> DataFrame:
    """(key, size, lang, most, bound): every phrase that may be frequent, and what its count and its score are at most."""
    sc = docs.sparkSession.sparkContext
    maps = [_bit_map(words.select(F.array("h").alias("key")), 1)]
    levels = None
    for size in range(2, SIZE + 1):
        known = sc.broadcast(maps)
        sums = _phrase_sums(docs, known, size, seed)
        if size < SIZE:
            maps = [*maps, _bit_map(sums, size)]
        known.destroy()
        sums = sums.withColumn("size", F.lit(size))
        levels = sums if levels is None else levels.unionByName(sums)
    first = words.select("lang", F.col("h").alias("first"), F.col("a").alias("l"))
    last = words.select(F.col("h").alias("last"), F.col("a").alias("r"))
    ends = levels.select("*", F.col("key")[0].alias("first"), F.element_at("key", -1).alias("last")).join(first, "first").join(last, "last")
    # a part has at least the phrase's own occurrences; a pair's parts are just its words
    pair = ends.withColumn("above", _whole("most") * _whole("most") * _scale()).withColumn("below", (_whole("l") * _whole("r")).cast("decimal(38,0)"))
    bound = F.when(F.col("size") == 2, F.expr("cast(above as decimal(38,0)) div below")).otherwise(F.expr(f"({SCALE} * most) div greatest(l, r)"))
    return staged(pair.select("key", "size", "lang", "most", bound.alias("bound")), "candidates")


@dataclass
class Block:
    """A trie of phrases, with what finds its way into it."""

    trie: DoubleArray
    accepts: np.ndarray  # row of ``ids`` that a state accepts, or -1
    ids: np.ndarray
    langs: dict[str, int]
    seed: int
    digests: np.ndarray  # first halves of the words' digests, sorted, with the second halves and the words' numbers
    seconds: np.ndarray
    numbers: np.ndarray

    @staticmethod
    def of(rows: pa.Table) -> Block:
        """From rows (id, lang, phrase)."""
        langs, words = _Numbers(), _Numbers()
        of_lang = np.fromiter(map(langs.__getitem__, rows["lang"].to_pylist()), np.int64, rows.num_rows)
        phrases = [p.as_py().encode().split(b" ") for p in rows["phrase"]]
        sizes = np.array([len(p) for p in phrases], np.int64)
        flat = np.fromiter((words[w] for p in phrases for w in p), np.int64, int(sizes.sum()))
        sequences = np.full((rows.num_rows, SIZE + 1), -1, np.int64)
        sequences[:, 0] = of_lang
        starts = np.cumsum(sizes) - sizes
        for k in range(SIZE):
            on = np.flatnonzero(sizes > k)
            sequences[on, k + 1] = flat[starts[on] + k] + len(langs)
        trie, states = build(sequences, len(langs) + len(words))
        accepts = np.full(len(trie.check), -1, np.int32)
        accepts[states] = np.arange(rows.num_rows, dtype=np.int32)
        for seed in count():  # first halves that differ make one look-up enough
            halves = _digests(list(words), seed)
            order = np.argsort(halves[:, 0])
            if not (np.diff(halves[order, 0]) == 0).any():
                break
        return Block(trie, accepts, rows["id"].to_numpy(), dict(langs), seed, halves[order, 0], halves[order, 1], order + len(langs))

    def numbered(self, vocabulary: list[bytes]) -> np.ndarray:
        """The numbers of words in this block, -1 for those that are not in it."""
        halves = _digests(vocabulary, self.seed)
        at = np.minimum(np.searchsorted(self.digests, halves[:, 0]), len(self.digests) - 1)
        known = (self.digests[at] == halves[:, 0]) & (self.seconds[at] == halves[:, 1])
        return np.where(known, self.numbers[at], -1)

    def count(self, words: Words) -> np.ndarray:
        """Occurrences of each phrase: all positions at once, a word at a time."""
        number = self.numbered(words.vocabulary)[words.codes]
        of_lang = np.array([self.langs.get(s, -1) for s in words.langs])[words.lang]
        at = np.arange(len(number))
        states = self.trie.step(np.zeros(len(at), np.int32), of_lang)
        out = np.zeros(len(self.ids), np.int64)
        for k in range(SIZE):
            states = self.trie.step(states, number[at + k])
            on = states >= 0
            rows = self.accepts[states[on]]
            out += np.bincount(rows[rows >= 0], minlength=len(out))
            on[on] = words.joined[at[on] + k]
            at, states = at[on], states[on]
        return out


def _digests(words: list[bytes], seed: int) -> np.ndarray:
    return np.frombuffer(b"".join(xxhash.xxh3_128_digest(w, seed) for w in words), ">u8").astype(np.uint64).reshape(-1, 2)


def _block_counts(docs: DataFrame, block: Broadcast) -> DataFrame:
    """(id, a): the occurrences of a block's phrases, summed over the shards of text."""

    def count_batches(batches):
        total = np.zeros(len(block.value.ids), np.int64)
        for words in read_words(batches):
            total += block.value.count(words)
        found = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(block.value.ids[found]), pa.array(total[found])], names=["id", "a"])

    return docs.mapInArrow(count_batches, "id long, a long").groupBy("id").agg(F.sum("a").alias("a"))


def count_phrases(docs: DataFrame, phrases: DataFrame) -> DataFrame:
    """(lang, size, phrase, a): the occurrences of distinct ``phrases`` (lang, size, phrase)."""
    sc = docs.sparkSession.sparkContext
    phrases = staged(phrases.withColumn("id", F.monotonically_increasing_id()), "phrases")
    n, size = phrases.agg(F.count("*"), F.coalesce(F.sum(F.octet_length("phrase")), F.lit(0))).first()
    if not n:
        return docs.sparkSession.createDataFrame([], "lang string, size int, phrase string, a long")
    blocks = max(1, -(-n // BLOCK), -(-size // BLOCK_BYTES))
    counts = None
    for k in range(blocks):
        here = phrases.where(F.pmod(F.xxhash64("lang", "phrase"), F.lit(blocks)) == k).select("id", "lang", "phrase").toArrow()
        if here.num_rows:
            block = sc.broadcast(Block.of(here))
            part = staged(_block_counts(docs, block), "phrase-counts")
            block.destroy()
            counts = part if counts is None else counts.unionByName(part)
    return staged(phrases.join(counts, "id").select("lang", "size", "phrase", "a"), "counted-phrases")


def _part(words: Column, start: Column, length: Column) -> Column:
    return F.array_join(F.slice(words, start, length), " ")


def _whole(col: str) -> Column:
    return F.col(col).cast("decimal(18,0)")


def _scale() -> Column:
    return F.lit(SCALE).cast("decimal(7,0)")


def scored(frequent: DataFrame) -> DataFrame:
    """(lang, phrase, a, l, r, score) of the phrases of two words or more that no longer one stands for."""
    words = F.split("phrase", " ")
    phrases = frequent.where("size > 1")
    cuts = phrases.select("lang", "size", "phrase", "a", F.explode(F.expr("sequence(1, size - 1)")).alias("k"))
    parts = cuts.select(
        "lang", "phrase", "a", "k",
        _part(words, F.lit(1), F.col("k")).alias("first"),
        _part(words, F.col("k") + 1, F.col("size") - F.col("k")).alias("rest"),
    )
    left = frequent.select("lang", F.col("phrase").alias("first"), F.col("a").alias("l"))
    right = frequent.select("lang", F.col("phrase").alias("rest"), F.col("a").alias("r"))
    cut = parts.join(left, ["lang", "first"]).join(right, ["lang", "rest"])
    square = (_whole("a") * _whole("a") * _scale()).cast("decimal(38,0)")
    cut = cut.withColumn("square", square).withColumn("product", (_whole("l") * _whole("r")).cast("decimal(38,0)"))
    cut = cut.withColumn("score", F.expr("square div product"))
    best = cut.groupBy("lang", "phrase").agg(F.max("a").alias("a"), F.min(F.struct("score", "k", "l", "r")).alias("cut"))

    inside = phrases.where("size > 2").select("lang", "size", "phrase", F.col("a").alias("around"), F.explode(F.expr("sequence(2, size - 1)")).alias("length"))
    inside = inside.select("lang", "around", "phrase", "length", F.explode(F.expr("sequence(1, size - length + 1)")).alias("start"))
    inside = inside.select("lang", "around", _part(words, F.col("start"), F.col("length")).alias("phrase"))
    longest = inside.groupBy("lang", "phrase").agg(F.max("around").alias("around"))
    kept = best.join(longest, ["lang", "phrase"], "left").where(F.expr(f"around is null or 100 * around < {SHARE} * a"))
    return kept.select("lang", "phrase", "a", F.col("cut.l").alias("l"), F.col("cut.r").alias("r"), F.col("cut.score").alias("score"))


def _first(rows: DataFrame, order: list[Column], top: int, salt: str) -> DataFrame:
    """The first ``top`` rows of each lang with their rank, found within parts (by ``salt``) first."""
    parts = rows.withColumn("part", F.pmod(F.xxhash64(salt), F.lit(PARTS)))
    within = parts.withColumn("rank", F.row_number().over(Window.partitionBy("lang", "part").orderBy(*order))).where(F.col("rank") <= top)
    return within.drop("part").withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long")).where(F.col("rank") <= top)


def _around(pool: DataFrame, taken: DataFrame) -> DataFrame:
    """Longer candidates with a taken one inside that could push it out."""
    inside = pool.where("size > 2").select("key", "size", "most", F.explode(F.expr("sequence(2, size - 1)")).alias("length"))
    inside = inside.select("key", "most", "length", F.explode(F.expr("sequence(1, size - length + 1)")).alias("start"))
    inside = inside.select(F.col("key").alias("around"), F.col("most").alias("around_most"), F.expr("slice(key, start, length)").alias("key"))
    found = inside.join(taken.select("key", "most"), "key").where(F.expr(f"100 * around_most >= {SHARE} * most"))
    return found.select(F.col("around").alias("key"))


def _with_parts(keys: DataFrame) -> DataFrame:
    """The distinct keys and all their contiguous parts."""
    lengths = keys.select("key", F.explode(F.expr("sequence(1, size(key))")).alias("length"))
    starts = lengths.select("key", "length", F.explode(F.expr("sequence(1, size(key) - length + 1)")).alias("start"))
    return starts.select(F.expr("slice(key, start, length)").alias("key")).distinct()


def _spelled(keys: DataFrame, words: DataFrame) -> DataFrame:
    """(key, lang, size, phrase) of distinct keys."""
    placed = keys.select("key", F.posexplode("key").alias("place", "h")).join(words.select("h", "lang", "word"), "h")
    spelled = placed.groupBy("key").agg(F.min("lang").alias("lang"), F.sort_array(F.collect_list(F.struct("place", "word"))).alias("words"))
    return spelled.select("key", "lang", F.size("key").alias("size"), F.array_join(F.col("words.word"), " ").alias("phrase"))


def collocations(docs: DataFrame, top: int = 2000) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: the first ``top`` phrases of each language."""
    rows = docs.select(F.coalesce(docs["lang"], F.lit("und")).alias("lang"), text_of(docs).alias("text"))
    for seed in count():
        found = _search(rows, top, seed)
        if found is not None:
            return found


def _search(rows: DataFrame, top: int, seed: int) -> DataFrame | None:
    """The result, or None if two words turn out to share a hash."""
    counts = _word_counts(rows, seed)
    words, totals = counts.where("word is not null"), counts.where("word is null").select("lang", F.col("a").alias("n"))
    if not words.groupBy("h").count().where("count > 1").isEmpty():
        return None
    pool = candidates(rows, words, seed)
    best = [F.desc("bound"), F.desc("most"), F.asc("key")]
    ahead, known = AHEAD * top, None
    while True:
        first = staged(_first(pool, best, ahead + 1, "key"), "first-candidates")
        taken, beyond = first.where(F.col("rank") <= ahead), first.where(F.col("rank") > ahead)
        keys = _with_parts(taken.select("key").union(_around(pool, taken)).distinct())
        spelled = staged(_spelled(keys, words), "spelled")
        wanted = spelled.select("lang", "size", "phrase")
        new = wanted if known is None else wanted.join(known, ["lang", "phrase"], "left_anti")
        counted = count_phrases(rows, new)
        known = counted if known is None else known.unionByName(counted)
        listed = spelled.join(taken.select("key", "most"), "key").select("lang", "phrase", "most")
        scores = staged(scored(known.where(F.col("a") >= LEAST)).join(listed, ["lang", "phrase"]), "scores")
        if not listed.join(known, ["lang", "phrase"]).where("a < most").isEmpty():
            return None
        safe = scores.join(beyond.select("lang", "bound", F.col("most").alias("next")), "lang")
        enough = safe.groupBy("lang").agg(F.count_if(F.expr("score > bound or (score = bound and a > next)")).alias("n"))
        if beyond.join(enough, "lang", "left").where(F.expr(f"n is null or n < {top}")).isEmpty():
            break
        ahead *= 4
    ranked = _first(scores, [F.desc("score"), F.desc("a"), F.asc("phrase")], top, "phrase")
    return ranked.join(totals, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
