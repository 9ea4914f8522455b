"""Blocks of like texts, and the pairs of blocks that can hold a match.

A scorer describes every text by a row of whole numbers, its features.  The texts of a side are cut into cells by a tree
of medians over the features, so that a cell holds texts of about the same length and letters.  Each cell has an
envelope, the least and greatest value of every feature in it, and a scorer bounds the score of any two texts from
the envelopes they lie in.  Pairs of cells whose bound misses the threshold are never made into work.

Where the cuts lie is learned from a bounded sample and decides about speed only.  Envelopes and sizes are of all rows.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# rows of a side that the cuts are learned from
SAMPLE = 20_000
# blocks of a side at most: their pairs, 4 bytes each, are known to the driver and reach every task
MOST_BLOCKS = 2048
# pairs of blocks per core that a job is divided into at least
PAIRS_PER_CORE = 4


def median_cuts(rows: np.ndarray, cells: int) -> list[tuple[int, int]]:
    """Cuts (feature, value) of a binary tree in heap order, each at the median of the feature of widest spread."""
    depth = max(0, math.ceil(math.log2(max(cells, 1))))
    cuts, level = [], [rows]
    for _ in range(depth):
        below = []
        for part in level:
            feature, value = 0, 0
            if len(part) > 1:
                feature = int((np.quantile(part, 0.9, axis=0) - np.quantile(part, 0.1, axis=0) + 1e-3 * part.std(axis=0)).argmax())
                value = int(np.ceil(np.median(part[:, feature])))
                if value == part[:, feature].min():
                    value += 1
            low = part[:, feature] < value if len(part) else np.zeros(0, bool)
            cuts.append((feature, value))
            below += [part[low], part[~low]]
        level = below
    return cuts


def cells_of(rows: np.ndarray, cuts: list[tuple[int, int]]) -> np.ndarray:
    """The cell of each row of features."""
    at = np.zeros(len(rows), np.int64)
    features, values = np.array([c[0] for c in cuts], np.int64), np.array([c[1] for c in cuts], np.int64)
    for _ in range(int(math.log2(len(cuts) + 1))):
        at = 2 * at + 1 + (rows[np.arange(len(rows)), features[at]] >= values[at])
    return at - len(cuts)


@dataclass
class Side:
    """One side of a match, cut into blocks."""

    rows: DataFrame  # with ``cell`` and the hash ``h``
    cells: np.ndarray  # numbers of the cells that have rows
    low: np.ndarray
    high: np.ndarray
    parts: np.ndarray  # blocks that a cell is split into, at random
    texts: np.ndarray  # rows of a cell

    @property
    def first(self) -> np.ndarray:
        """Number of the first block of each cell."""
        return np.cumsum(self.parts) - self.parts


def block_count(chars: int, block_chars: int, parallelism: int) -> int:
    """Blocks of a side: bounded in characters, and enough pairs of them for all cores."""
    return min(MOST_BLOCKS, max(math.ceil(chars / block_chars), math.ceil(math.sqrt(PAIRS_PER_CORE * parallelism))))


def cut_side(rows: DataFrame, block_chars: int) -> Side | None:
    """Blocks of ``rows`` (h, size, features); None if there are none."""
    spark = rows.sparkSession
    n, chars = rows.agg(F.count("*"), F.coalesce(F.sum("size"), F.lit(0))).first()
    if not n:
        return None
    blocks = block_count(int(chars), block_chars, spark.sparkContext.defaultParallelism)
    sample = [r[0] for r in rows.orderBy("h").limit(SAMPLE).select("features").collect()]
    cuts = median_cuts(np.array(sample, np.int64), min(blocks, len(sample)))

    @F.pandas_udf("int")
    def cell(features: pd.Series) -> pd.Series:
        return pd.Series(cells_of(np.stack(features.to_numpy()), cuts).astype(np.int32))

    placed = rows.withColumn("cell", cell("features"))
    width = len(sample[0])
    ends = [f(F.col("features")[k]).alias(f"{name}{k}") for name, f in (("low", F.min), ("high", F.max)) for k in range(width)]
    found = placed.groupBy("cell").agg(F.count("*").alias("n"), *ends).orderBy("cell").toPandas()
    sizes = found["n"].to_numpy()
    target = max(1.0, n / blocks)
    parts = np.maximum(1, np.rint(sizes / target).astype(np.int64))
    table = found.to_numpy()[:, 2:].astype(np.int64)
    return Side(placed, found["cell"].to_numpy(), table[:, :width], table[:, width:], parts, sizes)


def kept_pairs(left: Side, right: Side, bound, least: float) -> np.ndarray:
    """True for the pairs of cells whose texts can reach the score ``least``."""
    kept = np.zeros((len(left.cells), len(right.cells)), bool)
    for k in range(len(left.cells)):
        kept[k] = bound(left.low[k][None], left.high[k][None], right.low, right.high) >= least
    return kept


def with_partners(side: Side, other: Side, kept: np.ndarray) -> DataFrame:
    """The rows of a side, once for each block of the other side that their cell meets: columns own, partner.

    The table of partners has a row for each cell, of which there are at most ``MOST_BLOCKS`` or so.
    """
    spark = side.rows.sparkSession
    blocks = [np.concatenate([np.arange(f, f + p) for f, p in zip(other.first[row], other.parts[row])] or [np.zeros(0, int)]) for row in kept]
    table = [(int(c), int(f), int(p), b.tolist()) for c, f, p, b in zip(side.cells, side.first, side.parts, blocks)]
    cells = spark.createDataFrame(table, "cell int, first int, parts int, partners array<int>")
    rows = side.rows.join(F.broadcast(cells), "cell")
    own: Column = F.col("first") + F.pmod(F.col("h"), F.col("parts")).cast("int")
    return rows.withColumn("own", own).withColumn("partner", F.explode("partners")).drop("cell", "first", "parts", "partners", "features", "h", "size")
