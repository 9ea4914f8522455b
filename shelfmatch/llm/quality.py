"""Quality rules by cross-document line frequency.

Lines are normalised (lower case, digits as 0, single blanks) and hashed to 128 bits.  Per host (``source``) the
distinct documents of each line are counted; exact copies of a text are one document there, so copies do not condemn
each other.  A line in more than ``max_documents`` documents of a host is removed from all of them but the first
(smallest doc_id, a null one last; of texts with the same, smallest MD5): ``keep_good`` returns the texts without it,
``quality_rules`` their digests.  A document left with less than ``min_share`` of its words is depleted and rejected, and
so is one that fails the base rules: fewer than 50 words, or over half its words in repeated windows of three.

Null text: no words, so rejected.  Null source: the host ''.  Repeated rows get the same verdict.  An empty table gives
an empty result.  Other columns of ``docs`` are left alone, whatever their names and though they may tell of the whole text.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from .common import by_batch, free_name, lean, small_side, staged, text_key, text_of

#: Distinct documents of a host that may share a line.
MAX_DOCUMENTS = 100
#: Share of its words that a document must keep.
MIN_SHARE = 0.5

SPACE = " \t\n\x0b\x0c\r"
_SYMBOLS = "#*$%&|<>"
_ZEROS = str.maketrans("123456789", "000000000")


def repeated_words(words: list) -> int:
    """Words in a window of three that the text has twice or more, the first included."""
    if len(words) < 4:
        return 0
    number: dict = {}
    ids = np.fromiter((number.setdefault(w, len(number)) for w in words), np.int64, len(words))
    pairs = ids[:-1] * len(number) + ids[1:]
    if len(number) > 1 << 20:
        pairs = np.unique(pairs, return_inverse=True)[1].reshape(-1)
    windows = pairs[:-1] * len(number) + ids[2:]
    order = np.argsort(windows, kind="stable")
    same = np.diff(windows[order]) == 0
    twice = np.zeros(len(windows), bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    covered = np.zeros(len(words), bool)
    for k in range(3):
        covered[k : len(words) - 2 + k] |= twice
    return int(covered.sum())


def line_hash(line: str) -> bytes:
    return xxhash.xxh3_128_digest(" ".join(line.translate(_ZEROS).lower().split()))


def text_rules(text: str) -> tuple[int, int, int, int, int, list]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, [(line hash, words)]."""
    words = text.encode().split()
    chars = len(text) - sum(map(text.count, SPACE))
    seen, dup, lines = set(), 0, []
    for line in text.split("\n"):
        n = len(line.encode().split())
        if n:
            dup += line in seen
            seen.add(line)
            lines.append((line_hash(line), n))
    return len(words), chars, sum(map(text.count, _SYMBOLS)), dup, repeated_words(words), lines


_FEATURES = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


def _features(docs: DataFrame) -> DataFrame:
    schema = pa.schema([("doc_id", pa.int64()), ("host", pa.string()), ("key", pa.binary()), ("own_sha256", pa.binary()), *((c, pa.int64()) for c in _FEATURES), ("lines", pa.list_(pa.struct([("line", pa.binary()), ("words", pa.int64())])))])

    def rules(doc_id, host, key, own_sha256, text):
        found = [text_rules(t) for t in text]
        out = {c: [f[i] for f in found] for i, c in enumerate(_FEATURES)}
        return out | {"doc_id": doc_id, "host": host, "key": key, "own_sha256": own_sha256, "lines": [[{"line": h, "words": n} for h, n in f[5]] for f in found]}

    text = text_of(docs)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("source", F.lit("")).alias("host"), text_key(text).alias("key"), F.unhex(F.sha2(text, 256)).alias("own_sha256"), text.alias("text"))
    longs = ", ".join(f"{c} long" for c in _FEATURES)
    return rows.mapInArrow(by_batch(rules, schema), f"doc_id long, host string, key binary, own_sha256 binary, {longs}, lines array<struct<line: binary, words: long>>")


def lost_lines(features: DataFrame, max_documents: int = MAX_DOCUMENTS, min_share: float = MIN_SHARE) -> DataFrame:
    """host, key, removed_words, ``gone`` (hashes of the lines above the limit) and depleted, of the texts that lose lines."""
    lines = features.select("doc_id", "host", "key", F.explode("lines").alias("x"))
    per_text = lines.groupBy("host", F.col("x.line").alias("line"), "key").agg(F.min("doc_id").alias("first_doc"))
    common = per_text.groupBy("host", "line").agg(F.count("*").alias("n"), F.min("first_doc").alias("first_doc")).where(F.col("n") > max_documents)
    texts = features.select("host", "key", "n_words", "lines", "doc_id").groupBy("host", "key").agg(F.min("doc_id").alias("own_doc"), F.first("n_words").alias("n_words"), F.first("lines").alias("lines"))
    own = texts.select("host", "key", "own_doc", "n_words", F.explode("lines").alias("x")).select("host", "key", "own_doc", "n_words", F.col("x.line").alias("line"), F.col("x.words").alias("words"))
    above = staged(own.join(common.select("host", "line", "first_doc"), ["host", "line"]), "lines-above")
    firsts = above.where(F.col("own_doc").eqNullSafe(F.col("first_doc"))).groupBy("host", "line").agg(F.min("key").alias("first_key"))
    lost = above.join(firsts, ["host", "line"]).where("key != first_key")
    lost = lost.groupBy("host", "key").agg(F.sum("words").alias("removed_words"), F.first("n_words").alias("n_words"), F.collect_set("line").alias("gone"))
    return lost.select("host", "key", "removed_words", "gone", (F.col("n_words") - F.col("removed_words") < min_share * F.col("n_words")).alias("depleted"))


def text_left(text: str, gone: set[bytes]) -> str:
    """The text without the lines whose hashes are ``gone``."""
    return "\n".join(line for line in text.split("\n") if not line.strip(SPACE) or line_hash(line) not in gone)


def _taken_out(joined: DataFrame, column: str) -> DataFrame:
    """``joined`` (``gone`` last) without ``gone``, and with the lines it names taken out of the text column."""
    at = joined.columns.index(column)
    schema = StructType(joined.schema.fields[:-1])

    def run(batches):
        for b in batches:
            if b.column(b.num_columns - 1).null_count == b.num_rows:
                yield pa.RecordBatch.from_arrays(b.columns[:-1], names=b.schema.names[:-1])
                continue
            left = [t if t is None or gone is None else text_left(t, set(gone)) for t, gone in zip(b.column(at).to_pylist(), b.column(b.num_columns - 1).to_pylist())]
            columns = [pa.array(left, b.schema.field(at).type) if i == at else c for i, c in enumerate(b.columns[:-1])]
            yield pa.RecordBatch.from_arrays(columns, names=b.schema.names[:-1])

    return joined.mapInArrow(lean(run), schema)


def _keys(docs: DataFrame) -> tuple:
    return F.coalesce(docs["source"], F.lit("")), text_key(text_of(docs))


def _base_failed():
    return (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))


def _verdicts(docs: DataFrame, max_documents: int, min_share: float) -> tuple[DataFrame, DataFrame]:
    """The rows of ``quality_rules``, but for the digest, and the lines that texts lose."""
    features = staged(_features(docs), "quality")
    lost = small_side(lost_lines(features, max_documents, min_share), "lost-lines")
    out = features.drop("lines").join(lost.drop("gone"), ["host", "key"], "left").withColumn("base_failed", _base_failed())
    kept = ~F.col("base_failed") & ~F.coalesce("depleted", F.lit(False))
    return out.withColumn("kept", kept).drop("depleted").fillna(0, ["removed_words"]), lost


def quality_rules(docs: DataFrame, max_documents: int = MAX_DOCUMENTS, min_share: float = MIN_SHARE) -> DataFrame:
    """doc_id, the features, base_failed, kept and host, key, removed_words, kept_sha256 (of the text left) per document."""
    verdicts, lost = _verdicts(docs, max_documents, min_share)
    host, key = _keys(docs)
    texts = docs.select(host.alias("host"), key.alias("key"), text_of(docs).alias("text"))
    shorter = texts.join(lost.select("host", "key", "gone"), ["host", "key"]).select("host", "key", "text", "gone")
    shorter = _taken_out(shorter, "text").select("host", "key", F.sha2("text", 256).alias("left_sha256")).groupBy("host", "key").agg(F.first("left_sha256").alias("left_sha256"))
    out = verdicts.join(small_side(shorter, "texts-left"), ["host", "key"], "left")
    return out.withColumn("kept_sha256", F.coalesce("left_sha256", F.lower(F.hex("own_sha256")))).drop("left_sha256", "own_sha256")


def keep_good(docs: DataFrame, max_documents: int = MAX_DOCUMENTS, min_share: float = MIN_SHARE) -> DataFrame:
    """The rows of ``docs`` that pass, without the lines above the limit in their texts, the other columns as they are."""
    verdicts, lost = _verdicts(docs, max_documents, min_share)
    host, key = _keys(docs)
    kept = verdicts.where("kept").select(F.col("host").alias("kept_host"), F.col("key").alias("kept_key")).distinct()
    good = docs.join(kept, (host == kept["kept_host"]) & (key == kept["kept_key"]), "left_semi")
    gone = free_name(docs, "gone")
    lost = lost.select(F.col("host").alias("lost_host"), F.col("key").alias("lost_key"), F.col("gone").alias(gone))
    host, key = _keys(good)
    joined = good.join(lost, (host == lost["lost_host"]) & (key == lost["lost_key"]), "left").select(*(good[c] for c in good.columns), lost[gone])
    return _taken_out(joined, "text")
