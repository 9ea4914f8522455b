"""Periodic runs of words: stretches that repeat with a period, found by an online sparse diagonal program.

A run is a stretch of consecutive words with smallest period q (words q apart are identical) and length at least
``max(LEAST, 3 * q)`` that no neighbouring word extends keeping period q.  The words after a run's first q are repeats.

Seen as a matrix of word pairs, a run of period q is a stretch of matches on the diagonal of lag q.  The program goes
through the words once.  At each word the earlier occurrences of what starts there name lags; a lag that was named at
the word before has its match length incremented, another one begins with one, and a diagonal that is not named again
has ended: if it is long enough, its run is emitted there and then.

What keeps this sparse: a run of period q has at least ``max(24 - q, 2 * q)`` matches, so lags are put into classes
``g / 2 <= lag < g`` (the first class is 1 to 15, g = 16), and in the class of g a word counts as an occurrence only with
the g - 1 words after it.  Inside a run of period q in that class the *latest* earlier occurrence is exactly q words back:
a smaller distance d would, as d + q does not exceed the overlap g + d, give the run a period that divides q
(theorem of Fine and Wilf).  So one look-up per word and class is enough, whatever the text; multiples of the smallest
period never show up.  Occurrences of g words get their numbers by doubling, from two halves; what occurs once in a
document is left out of all longer ones, so little of ordinary text is looked at beyond two or three words.

No shuffle: every document is read whole in one task; documents are taken together up to a million words.

Null and empty texts, and texts without a word, have no run: n_runs 0, nulls for the greatest run, an empty collapsed
text.  A null doc_id is treated like any other row.  Repeated rows repeat their results; an empty table gives an empty
result.  Columns of the input other than doc_id and text are not read, so their names cannot clash.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import text_of

#: Words of the shortest run, whatever its period.
LEAST = 24
#: Words of documents that are looked at together.
TOGETHER = 1 << 20
_FIRST_GRAM = 16

Runs = list[tuple[int, int, int]]


def split_words(doc_id: int | None, text: str) -> list[bytes]:
    """Words: the stretches between ASCII blanks."""
    return text.encode().split()


def repeat_tail(doc_id: int | None, text: str) -> list[bytes]:
    """Words, those of a tenth of the documents (by a hash of the id) replaced from some word on by a repetition."""
    words = text.encode().split()
    if doc_id is None or not words:
        return words
    h = zlib.crc32(str(doc_id).encode())
    if h % 10:
        return words
    g, n = h // 10, len(words)
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    period = words[a : a + p]
    return words[:a] + (period * -(-(n - a) // p))[: n - a]


class _Numbers(dict):
    """Numbers for words in order of appearance."""

    def __missing__(self, word):
        self[word] = number = len(self)
        return number


def _numbered(documents: list[list[bytes]]) -> np.ndarray:
    """One number per word, different between documents, and one that occurs once after each document."""
    parts, base = [], 0
    for words in documents:
        numbers = _Numbers()
        part = np.empty(len(words) + 1, np.int64)
        part[:-1] = np.fromiter(map(numbers.__getitem__, words), np.int64, len(words))
        part[-1] = len(numbers)
        parts.append(part + base)
        base += len(numbers) + 1
    return np.concatenate(parts)


def _repeated(keys: np.ndarray, at: np.ndarray, n: int) -> np.ndarray:
    """Numbers 0, 1, ... for equal ``keys`` at the positions ``at``; -1 for keys that occur once, and elsewhere."""
    _, inverse, counts = np.unique(keys, return_inverse=True, return_counts=True)
    again = counts > 1
    number = np.where(again, np.cumsum(again) - 1, -1)
    out = np.full(n, -1, np.int64)
    out[at] = number[inverse]
    return out


def _doubled(numbers: np.ndarray, half: int) -> np.ndarray:
    """From the numbers of stretches of ``half`` words those of stretches of twice as many."""
    n = len(numbers)
    at = np.flatnonzero((numbers[: n - half] >= 0) & (numbers[half:] >= 0)) if n > half else np.zeros(0, np.int64)
    return _repeated(numbers[at] * np.int64(n) + numbers[at + half], at, n)


def _occurrences(numbers: np.ndarray, low: int, high: int) -> tuple[np.ndarray, np.ndarray]:
    """Positions whose stretch has its latest earlier occurrence at a lag of ``low`` to ``high`` - 1, and the lags."""
    at = np.flatnonzero(numbers >= 0)
    order = at[np.argsort(numbers[at], kind="stable")]
    same = numbers[order[1:]] == numbers[order[:-1]]
    later, lag = order[1:][same], (order[1:] - order[:-1])[same]
    wanted = (lag >= low) & (lag < high)
    later, lag = later[wanted], lag[wanted]
    order = np.argsort(later)
    return later[order], lag[order]


def _diagonals(positions: np.ndarray, lags: np.ndarray, gram: int) -> Iterator[tuple[int, int, int]]:
    """(start, length, period) of the runs of one class: the online pass over the words that have an occurrence.

    In a class a word has one lag, so one diagonal is active at a time.
    """
    active, matches, last = 0, 0, -2
    for i, lag in zip([*positions.tolist(), -2], [*lags.tolist(), 0]):
        if lag == active and i == last + 1:
            matches += 1
        else:
            if active:
                length = matches + gram - 1 + active
                if length >= max(LEAST, 3 * active):
                    yield last - matches + 1 - active, length, active
            active, matches = lag, 1
        last = i


def find_runs(documents: list[list[bytes]]) -> list[Runs]:
    """The runs (start, length, period) of each document, by start and period."""
    if not documents:
        return []
    bounds = np.concatenate(([0], np.cumsum([len(w) + 1 for w in documents])))
    longest = max(len(w) for w in documents)
    found: list[Runs] = [[] for _ in documents]
    numbers, gram = _numbered(documents), 1
    numbers = _repeated(numbers, np.arange(len(numbers)), len(numbers))
    while True:
        if gram >= _FIRST_GRAM:
            low = 1 if gram == _FIRST_GRAM else gram // 2
            if 3 * low > longest:
                break
            positions, lags = _occurrences(numbers, low, gram)
            runs = list(_diagonals(positions, lags, gram))
            owners = np.searchsorted(bounds, [r[0] for r in runs], side="right") - 1
            for owner, (start, length, period) in zip(owners.tolist(), runs):
                found[owner].append((start - int(bounds[owner]), length, period))
        if not (numbers >= 0).any():
            break
        numbers, gram = _doubled(numbers, gram), 2 * gram
    return [sorted(runs, key=lambda r: (r[0], r[2])) for runs in found]


def collapse(words: list[bytes], runs: Runs) -> bytes:
    """The words, joined by blanks, without those that a run holds after its first period."""
    steps = np.zeros(len(words) + 1, np.int64)
    for start, length, period in runs:
        steps[start + period] += 1
        steps[start + length] -= 1
    dropped = np.cumsum(steps[:-1]) > 0
    return b" ".join(w for w, gone in zip(words, dropped.tolist()) if not gone)


_SCHEMA = "doc_id long, n_words long, runs array<struct<start:long,length:long,period:long>>, collapsed string"


def periodic_runs(docs: DataFrame, words: Callable[[int | None, str], list[bytes]] = split_words) -> DataFrame:
    """doc_id, n_words, runs (by start, then period) and the collapsed text of each document.

    ``words`` makes a document's words of its doc_id and text.
    """
    run = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])

    def results(ids: list, documents: list[list[bytes]]) -> pa.RecordBatch:
        runs = find_runs(documents)
        as_rows = [[{"start": s, "length": n, "period": p} for s, n, p in r] for r in runs]
        texts = [collapse(w, r).decode() for w, r in zip(documents, runs)]
        return pa.RecordBatch.from_arrays(
            [pa.array(ids, pa.int64()), pa.array([len(w) for w in documents], pa.int64()), pa.array(as_rows, pa.list_(run)), pa.array(texts, pa.string())],
            names=["doc_id", "n_words", "runs", "collapsed"],
        )

    def scan(batches):
        for batch in batches:
            ids, held, size = [], [], 0
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                ids.append(doc_id)
                held.append(words(doc_id, text.as_py()))
                size += len(held[-1]) + 1
                if size >= TOGETHER:
                    yield results(ids, held)
                    ids, held, size = [], [], 0
            if ids:
                yield results(ids, held)

    return docs.select(docs["doc_id"].cast("long").alias("doc_id"), text_of(docs).alias("text")).mapInArrow(scan, _SCHEMA)


def digest(found: DataFrame) -> DataFrame:
    """Number of runs, the run of greatest exponent, and digests of the runs and of the collapsed text."""

    def wider(best, run):
        """The greater length / period, compared as products; the earlier start, then the smaller period, at a tie."""
        ours, theirs = run["length"] * best["period"], best["length"] * run["period"]
        return F.when(best.isNull() | (ours > theirs), run).otherwise(best)

    first = F.expr("cast(null as struct<start:long,length:long,period:long>)")
    best = F.aggregate("runs", first, wider)
    line = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    best_run = found.withColumn("_best", best).withColumn("_lines", F.array_join(line, ""))
    return best_run.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        F.col("_best.start").alias("start"),
        F.col("_best.length").alias("length"),
        F.col("_best.period").alias("period"),
        F.floor(F.expr("(1000 * _best.length) div _best.period")).alias("exponent_milli"),
        F.sha2(F.col("_lines").cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"),
        "n_words",
    )
