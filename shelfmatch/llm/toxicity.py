"""Toxicity by class-conditional Kneser-Ney models of the letters of words.

Two models are counted on labelled documents, one on toxic and one on ordinary ones; a word counts once in a document.
A model gives a letter after the ``ORDER - 1`` before it (in its word) its discounted share in the class.  What the
discount frees goes to the shared backoff, a Kneser-Ney model over both classes together whose lower orders count in
how many contexts a letter was seen.  Rare expressions thus rest on counts that both models share and say little, while
a stem that the toxic documents favour speaks in all its forms.  A text's score is the difference of its log-likelihoods
per word, put on the scale of probabilities by a logistic fit on labelled documents that the counts did not see.  The
same documents choose the discount of the classes, by the likelihood of their labels.

The models are fitted on at most ``MAX_LABELLED`` documents of each class, those of the smallest hash of their id, so
that their size does not follow the corpus.

Null and empty texts have difference 0 and the score that follows from it.  Labels of ids without a document do not
count; null labels neither.  Repeated rows get the same score.  Without labels of both classes every score is the share
of toxic labels.  An empty table gives an empty result.  Columns other than doc_id and text are not inputs.
"""

from __future__ import annotations

import math
import re
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import staged, table, text_of

#: Labelled documents of each class that the models are fitted on.
MAX_LABELLED = 4000
ORDER = 7
#: Taken off each count of a class: the one of these that rates labelled documents best.  ``SHARED_DISCOUNT`` goes off the shared counts.
DISCOUNTS = (0.75, 1.25, 2.0, 3.0)
SHARED_DISCOUNT = 0.75
#: Words whose differences a worker remembers.
REMEMBERED = 500_000

_WORD = re.compile(r"[^\W_]+")


def words_of(text: str) -> list[str]:
    return _WORD.findall(text.lower())


def grams(word: str) -> list[str]:
    """Each letter of the word, and its end, with the letters before it."""
    padded = "\x02" * (ORDER - 1) + word + "\x03"
    return [padded[i : i + ORDER] for i in range(len(word) + 1)]


def gram_counts(docs: DataFrame) -> DataFrame:
    """gram, n0, n1: by class (``toxic`` 0 or 1) how often a gram occurs in the different words of a document."""

    def count(batches):
        words = (Counter(), Counter())
        for b in batches:
            for label, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                words[label].update(set(words_of(text)))
        for label in (0, 1):
            seen: Counter = Counter()
            for w, n in words[label].items():
                for g in grams(w):
                    seen[g] += n
            rows = list(seen.items())
            for i in range(0, len(rows), 50_000):
                some = rows[i : i + 50_000]
                yield pa.RecordBatch.from_arrays([pa.array([g for g, _ in some]), pa.array([label] * len(some), pa.int32()), pa.array([n for _, n in some])], names=["gram", "toxic", "n"])

    rows = docs.select("toxic", "text").mapInArrow(count, "gram string, toxic int, n long")
    return rows.groupBy("gram").agg(*(F.sum(F.when(F.col("toxic") == c, F.col("n")).otherwise(0)).alias(f"n{c}") for c in (0, 1)))


def _contexts(counts: dict, discount: float) -> dict[str, tuple[float, float]]:
    """For each context: its count, and the share that the discount frees."""
    total, freed = Counter(), Counter()
    for g, n in counts.items():
        total[g[:-1]] += n
        freed[g[:-1]] += min(discount, n)
    return {c: (n, freed[c] / n) for c, n in total.items()}


class Model:
    """Differences of the classes' log-likelihoods by gram, and by context for letters not seen after it."""

    def __init__(self, counts: list[tuple[str, int, int]], discount: float):
        shared = {g: a + b for g, a, b in counts}
        orders = [shared]
        for _ in range(ORDER - 1):
            orders.append(dict(Counter(g[1:] for g in orders[-1])))
        orders = [(x, _contexts(x, SHARED_DISCOUNT)) for x in reversed(orders)]
        letters = len(orders[0][0]) + 1
        classes = [{g: n for g, *both in counts if (n := both[c])} for c in (0, 1)]
        contexts = [_contexts(x, discount) for x in classes]

        def backoff(gram: str) -> float:
            p = 1 / letters
            for size, (seen, known) in enumerate(orders, 1):
                g = gram[-size:]
                if (c := known.get(g[:-1])) is not None:
                    p = max(seen.get(g, 0) - SHARED_DISCOUNT, 0) / c[0] + c[1] * p
            return p

        self.gram, self.context = {}, {}
        free = {c: [k.get(c, (0, 1.0))[1] for k in contexts] for c in contexts[0].keys() | contexts[1].keys()}
        for g in shared:
            p = backoff(g)
            chance = []
            for c in (0, 1):
                n, freed = contexts[c].get(g[:-1], (1, 1.0))
                chance.append(max(classes[c].get(g, 0) - discount, 0) / n + freed * p)
            self.gram[g] = math.log(chance[1] / chance[0])
        self.context = {c: math.log(x[1] / x[0]) for c, x in free.items()}
        self.scale, self.shift = 1.0, 0.0
        self.words: dict[str, float] = {}

    def word(self, word: str) -> float:
        """Log-likelihood of a word as toxic less that as ordinary."""
        gram, context = self.gram.get, self.context.get
        return sum(x if (x := gram(g)) is not None else context(g[:-1], 0.0) for g in grams(word))

    def difference(self, text: str) -> float:
        """The mean difference over the words of a text."""
        words = words_of(text)
        if not words:
            return 0.0
        if len(self.words) > REMEMBERED:
            self.words.clear()
        known = self.words
        for w in set(words):
            if w not in known:
                known[w] = self.word(w)
        return sum(map(known.__getitem__, words)) / len(words)

    def score(self, text: str) -> float:
        return float(1 / (1 + np.exp(-np.clip(self.scale * self.difference(text) + self.shift, -60, 60))))


def logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> tuple[float, float]:
    """Scale and shift of the weighted logistic fit of y to x."""
    unit = x.std() or 1.0
    z = x / unit
    a = b = 0.0
    for _ in range(60):
        p = 1 / (1 + np.exp(-np.clip(a * z + b, -60, 60)))
        w = weight * p * (1 - p)
        h = np.array([[(w * z * z).sum() + 1e-3, (w * z).sum()], [(w * z).sum(), w.sum() + 1e-9]])
        d = np.linalg.solve(h, [(weight * (y - p) * z).sum() - 1e-3 * a, (weight * (y - p)).sum()])
        a, b = a + np.clip(d[0], -5, 5), b + np.clip(d[1], -5, 5)
    return float(max(a, 0.0) / unit), float(b)


def log_loss(x: np.ndarray, y: np.ndarray, weight: np.ndarray, scale: float, shift: float) -> float:
    """Weighted mean of -log of the chance that the logistic curve gives each y."""
    z = np.clip(scale * x + shift, -60, 60)
    return float((weight * (np.logaddexp(0, z) - y * z)).sum() / weight.sum())


def fit(docs: DataFrame, labels: DataFrame, usable: Column | None = None) -> Model | float:
    """A model from the labelled documents, or the share of toxic labels where a class has none."""
    spark = docs.sparkSession
    named = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic")).where("toxic in (0, 1) and doc_id is not null")
    if usable is not None:
        named = named.where(usable)
    named = named.groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    n = {r["toxic"]: r["n"] for r in named.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    order = F.xxhash64("doc_id")
    chosen = [named.where(F.col("toxic") == c).orderBy(order, "doc_id").limit(MAX_LABELLED) for c in (0, 1)]
    some = F.broadcast(chosen[0].union(chosen[1]))  # twice MAX_LABELLED rows at most
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of(docs).alias("text"))
    known = staged(texts.join(some, "doc_id").withColumn("held", F.pmod(F.hash("doc_id"), F.lit(4)) == 0), "labelled")
    counts = gram_counts(known.where("not held")).toArrow()  # of a bounded sample
    counts = list(zip(*(counts.column(c).to_pylist() for c in ("gram", "n0", "n1"))))
    if not all(any(r[k] for r in counts) for k in (1, 2)):
        return n.get(1, 0) / max(1, sum(n.values()))
    held = known.where("held").select("toxic", "text")
    best: tuple[tuple[float, float], Model] | None = None
    for discount in DISCOUNTS:
        model = Model(counts, discount)
        shared = spark.sparkContext.broadcast(model)

        def rate(batches, shared=shared):
            for b in batches:
                yield pa.RecordBatch.from_arrays([b.column(0), pa.array([shared.value.difference(x) for x in b.column(1).to_pylist()])], names=["toxic", "x"])

        rated = held.mapInArrow(rate, "toxic int, x double").collect()  # of a bounded sample
        shared.destroy()  # the driver's copies, too
        x, y = np.array([r["x"] for r in rated]), np.array([float(r["toxic"]) for r in rated])
        if len(set(y.tolist())) < 2:  # nothing to choose or to calibrate by
            return model
        share, true = y.mean(), n[1] / (n[0] + n[1])
        weight = np.where(y == 1, true / share, (1 - true) / (1 - share))
        model.scale, model.shift = logistic(x, y, weight)
        loss = log_loss(x, y, weight, model.scale, model.shift), discount
        # the others are let go: each is as large as the counts
        best = (loss, model) if best is None or loss < best[0] else best
        del model, shared, rate
    return best[1]


def score(docs: DataFrame, model: Model | float) -> DataFrame:
    """doc_id and score per document."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    schema = pa.schema([("doc_id", pa.int64()), ("score", pa.float64())])

    def run(batches):
        m = shared.value
        for b in batches:
            yield table(schema, doc_id=b.column(0), score=[m if isinstance(m, float) else m.score(t) for t in b.column(1).to_pylist()])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of(docs).alias("text")).mapInArrow(run, "doc_id long, score double")
