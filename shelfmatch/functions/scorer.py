"""Scorers: a measure of two names, with a bound that lets most pairs be skipped.

``Scorer`` is for any caller's measure.  It says what the measure depends on, bounds it from that, and computes it; the
best-match join does the filtering, the verification and the spreading of the work.
"""

from __future__ import annotations

import abc

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# rows x columns of one matrix of bounds inside a task, and pairs scored at once
TILE = (512, 4096)
PAIRS = 1 << 16
# the bound a pair must miss by before it is dropped, against float noise
SLACK = 1e-9


class Scorer(abc.ABC):
    """A score from 0 to 1 of two texts, rounded to ``digits`` decimals."""

    digits: int = 4

    @abc.abstractmethod
    def features(self, texts: pd.DataFrame) -> np.ndarray:
        """One row of whole numbers for each row of ``texts`` (column ``text`` and what ``prepared`` adds)."""

    @abc.abstractmethod
    def bound(self, low_a: np.ndarray, high_a: np.ndarray, low_b: np.ndarray, high_b: np.ndarray) -> np.ndarray:
        """At least the score of any two texts whose features lie between; arrays are broadcast, features come last."""

    @abc.abstractmethod
    def score(self, a: pd.DataFrame, b: pd.DataFrame) -> np.ndarray:
        """The scores of equally many rows of both sides."""

    def prepared(self, names: DataFrame, text: str) -> DataFrame:
        """Add the columns that ``features`` and ``score`` read besides the text; ``columns`` names them."""
        return names

    columns: tuple[str, ...] = ()

    def size(self, text: str) -> Column:
        """What a text adds to the size of its block."""
        return F.length(text) + 1

    def least(self, threshold: float) -> float:
        """The bound below which a rounded score stays under ``threshold``."""
        return threshold - 0.5 * 10**-self.digits - SLACK

    def match(self, left: pd.DataFrame, right: pd.DataFrame, threshold: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Positions of the left rows with a match, of their best right rows (the first at a tie), and the scores."""
        fl, fr = self.features(left), self.features(right)
        best = np.full(len(left), -1, np.int64)
        reached = np.full(len(left), self.least(threshold))

        def take(li: np.ndarray, ri: np.ndarray) -> None:
            for at in range(0, len(li), PAIRS):
                a, b = li[at : at + PAIRS], ri[at : at + PAIRS]
                rounded = np.rint(self.score(left.iloc[a], right.iloc[b]) * 10**self.digits).astype(np.int64)
                np.maximum.at(best, a, rounded * len(right) + (len(right) - 1 - b))
                np.maximum.at(reached, a, rounded / 10**self.digits - 0.5 * 10**-self.digits - SLACK)

        for r0 in range(0, len(right), TILE[1]):
            b = fr[None, r0 : r0 + TILE[1]]
            for l0 in range(0, len(left), TILE[0]):
                a = fl[l0 : l0 + TILE[0], None]
                bound = self.bound(a, a, b, b)
                # the most promising pair of each name first, then what can still beat it
                li = np.arange(bound.shape[0])
                ri = bound.argmax(axis=1)
                hopeful = bound[li, ri] >= reached[l0 : l0 + len(li)]
                li, ri = li[hopeful], ri[hopeful]
                take(li + l0, ri + r0)
                bound[li, ri] = -np.inf
                li, ri = np.nonzero(bound >= reached[l0 : l0 + bound.shape[0], None])
                take(li + l0, ri + r0)
        scores = best // max(len(right), 1) / 10**self.digits
        li = np.flatnonzero((best >= 0) & (scores >= threshold))
        return li, len(right) - 1 - best[li] % len(right), scores[li]


def common_bound(low_a: np.ndarray, high_a: np.ndarray, low_b: np.ndarray, high_b: np.ndarray, chunk: int = 8) -> np.ndarray:
    """At most how much two rows of counts between the envelopes have in common."""
    shape = np.broadcast_shapes(high_a.shape, high_b.shape)
    out = np.zeros(shape[:-1], np.int64)
    for k in range(0, shape[-1], chunk):
        out += np.minimum(high_a[..., k : k + chunk], high_b[..., k : k + chunk]).sum(axis=-1)
    return out


def bound_violations(scorer: Scorer, a: pd.DataFrame, b: pd.DataFrame) -> np.ndarray:
    """Positions of pairs (rows of ``a`` and ``b``, equally many) that score above a bound: none, if the scorer is right.

    Every pair is held against its own bound and against that of the envelopes of all rows.
    """
    fa, fb, score = scorer.features(a), scorer.features(b), scorer.score(a, b)
    own = scorer.bound(fa, fa, fb, fb)
    wide = scorer.bound(fa.min(axis=0), fa.max(axis=0), fb.min(axis=0), fb.max(axis=0))
    return np.flatnonzero((score > own + SLACK) | (score > wide + SLACK))
