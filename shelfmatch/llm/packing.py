"""Best-fit packing of documents into sequences by the configuration linear program.

Documents become token ids with an end id; those longer than a sequence are cut, nothing else is.  All pieces of one
length are alike, so the plan is made on the histogram of lengths, which has as many entries as a sequence has tokens,
whatever the corpus:

1. The linear program: as few sequences as possible, each filled by a configuration (a multiset of lengths that fits),
   together holding every length as often as it occurs.
2. Multiplicative weights solve it: a length weighs exponentially less the more of its demand is met.  A knapsack
   dynamic program prices the lengths by their weights; it gives the best configuration and, for each length, the best
   one that holds it.  Those near the best are raised a little, and the weights follow.  Every pricing bounds the
   number of sequences from below.
3. Rounding: amounts are rounded down, and the program is solved again for what is left, from the weights that it
   ended with; once little is rounded down, fractions are rounded up, full sequences first.  When no configuration fits any more,
   the few pieces left go by best-fit decreasing into the room of the sequences made, then into new ones.

Each piece finds its place by its rank among the pieces of its length.  Ranks are counted per task and offset by the
counts of earlier tasks, so a length that a third of all pieces share meets in no task.

Null text: empty, one end id.  Repeated rows are packed each.  An empty table packs into nothing.  Other columns of
``docs`` are not read.
"""

from __future__ import annotations

import bisect
import zlib
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import lean, staged, table, text_array, text_of
from .tokens import encoder

CAPACITY = 2048

#: Phases of the program, (rate at which weights follow what is met, rounds): the first time, and for what rounding leaves.
PHASES = ((1.0, 60), (0.3, 40))
PHASES_AGAIN = ((0.3, 20),)
#: Distance from the dual bound at which a phase ends.
GAP = 0.01
#: Share of a length's demand that a round meets at most; configurations this near the best are raised.
STEP = 0.2
NEAR = 0.03
#: Share of a sequence from which it counts as full when fractions are rounded up.
FULL = 0.99

Pattern = tuple[tuple[int, int], ...]


def knapsack(lengths: np.ndarray, prices: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For each room: the highest price that fits, the length (index) to take first for it, and the room that this fills at most."""
    least = int(lengths[0])
    price, number = np.full(capacity + 1, -1.0), np.full(capacity + 1, -1)
    price[lengths], number[lengths] = prices, np.arange(len(lengths))
    best, take, used = np.zeros(capacity + 1), np.full(capacity + 1, -1), np.zeros(capacity + 1, np.int64)
    for room in range(least, capacity + 1):
        sums = best[room - least :: -1] + price[least : room + 1]
        i = int(sums.argmax())
        if sums[i] > best[room - 1]:
            best[room], take[room], used[room] = sums[i], number[i + least], room
        else:
            best[room], used[room] = best[room - 1], used[room - 1]
    return best, take, used


class Fill:
    """Configurations that the knapsack takes, with no more copies of a length than there are pieces of it."""

    def __init__(self, lengths: list[int], pieces: list[int], prices: np.ndarray, best: np.ndarray, take: np.ndarray, used: np.ndarray):
        self.lengths, self.pieces, self.prices, self.best = lengths, pieces, prices, best
        self.take, self.used, self.sizes = take.tolist(), used.tolist(), np.array(lengths)
        self.others: dict[tuple, int] = {}

    def _other(self, room: int, chosen: dict[int, int]) -> int:
        """The best length for a room where those of ``chosen`` that are used up cannot be taken; -1: none fits."""
        fits = bisect.bisect_right(self.lengths, room)
        gone = tuple(sorted(i for i, n in chosen.items() if i < fits and n >= self.pieces[i]))
        if (found := self.others.get((room, gone))) is None:
            worth = self.prices[:fits] + self.best[room - self.sizes[:fits]]
            worth[list(gone)] = -1.0
            found = int(worth.argmax()) if len(gone) < fits else -1
            self.others[room, gone] = found
        return found

    def around(self, first: int, capacity: int) -> dict[int, int]:
        """Index -> copies: ``first`` and then what is best for the room left."""
        chosen = {first: 1}
        room = self.used[capacity - self.lengths[first]]
        while room:
            i = self.take[room]
            if chosen.get(i, 0) >= self.pieces[i]:
                if (i := self._other(room, chosen)) < 0:
                    break
            chosen[i] = chosen.get(i, 0) + 1
            room = self.used[room - self.lengths[i]]
        return chosen


class Solution(NamedTuple):
    """Amounts of configurations (index, copies), the sequences they stand for, the dual bound and the prices behind it."""

    amounts: dict[Pattern, float]
    sequences: float
    bound: float
    prices: np.ndarray


def solve(lengths: np.ndarray, demand: np.ndarray, capacity: int, prices: np.ndarray | None = None, phases: tuple = PHASES, gap: float = GAP) -> Solution:
    """The configuration program, by multiplicative weights in phases of ever smaller steps.

    Prices begin in proportion to the lengths (or at ``prices``), and each phase at the best ones so far.  Any prices
    bound the program from below: what all pieces are worth, by what one sequence can be worth.  Amounts are scaled to
    meet the demand on average; what they leave unmet counts as sequences of one length.  A phase ends within ``gap``
    of the bound or after its rounds, the program with the last phase.
    """
    weight = lengths * demand / (lengths @ demand)
    alone = demand / (capacity // lengths)
    sizes, wanted = lengths.tolist(), demand.tolist()
    prices, bound = lengths.astype(float) if prices is None else prices, 0.0
    for rate, rounds in phases:
        base, met, amounts, mean = prices, np.zeros(len(lengths)), {}, np.zeros(len(lengths))
        for r in range(rounds + 1):
            last = r == rounds  # the mean prices of a phase are tried once, for the bound only
            now = mean / rounds if last else base * np.exp(-rate * (met - weight @ met))
            mean += now
            best, take, used = knapsack(lengths, now, capacity)
            if (value := float(now @ demand / best[capacity])) > bound:
                bound, prices = value, now
            if last:
                break
            fill, gained = Fill(sizes, wanted, now, best, take, used), [0.0] * len(sizes)
            value = now + best[capacity - lengths]
            order = np.argsort(-value, kind="stable")
            for first in order[value[order] >= (1 - NEAR) * best[capacity]].tolist():
                if gained[first] >= STEP:
                    continue
                chosen = fill.around(first, capacity)
                amount = min((STEP - gained[i]) * wanted[i] / n for i, n in chosen.items())
                if amount > 0:
                    for i, n in chosen.items():
                        gained[i] += amount * n / wanted[i]
                    key = tuple(sorted(chosen.items()))
                    amounts[key] = amounts.get(key, 0.0) + amount
            met += gained
            scale = float(weight @ met)
            sequences = sum(amounts.values()) / scale + float(alone @ np.maximum(1 - met / scale, 0))
            if sequences <= (1 + gap) * bound:
                break
    return Solution({k: x / scale for k, x in amounts.items()}, sequences, bound, prices)


def _rounded(solution: Solution, lengths: np.ndarray, left: np.ndarray, capacity: int) -> list[tuple[Pattern, int]]:
    """Whole sequences of the configurations, taken off ``left``.

    Amounts are rounded down; where that makes less than three quarters of the bound, fractions are rounded up until it
    does: full sequences first, of these the ones with the longest pieces, as short ones fill what is made later.
    """
    chosen, made = [], 0
    by_amount = sorted(solution.amounts.items(), key=lambda x: -x[1])
    by_fill = sorted(by_amount, key=lambda x: (sum(int(lengths[i]) * c for i, c in x[0]) < FULL * capacity, -x[0][-1][0], -x[1]))
    for up, candidates in ((False, by_amount), (True, by_fill)):
        for key, amount in candidates:
            if up and made >= 0.75 * solution.bound:
                break
            n = min(1 if up else int(amount + 1e-9), *(int(left[i]) // c for i, c in key))
            if n > 0:
                for i, c in key:
                    left[i] -= n * c
                chosen.append((key, n))
                made += n
    return chosen


def configurations(lengths: np.ndarray, left: np.ndarray, capacity: int) -> list[tuple[dict[int, int], int]]:
    """[(length -> copies, sequences)]: the program solved and rounded again and again, until its configurations no longer fit what is ``left``."""
    groups, prices, phases = [], lengths.astype(float), PHASES
    while left.any():
        has = np.flatnonzero(left)
        some = left[has]
        solution = solve(lengths[has], some.astype(float), capacity, prices[has], phases)
        chosen = _rounded(solution, lengths[has], some, capacity)
        if not chosen:
            break
        prices[has], left[has], phases = solution.prices, some, PHASES_AGAIN
        groups += [({int(lengths[has[i]]): c for i, c in key}, n) for key, n in chosen]
    return groups


def plan(histogram: dict[int, int], capacity: int = CAPACITY) -> list[tuple[Pattern, int]]:
    """[((length, copies), ...), sequences]: every piece of the histogram in a sequence, none over capacity."""
    if not histogram:
        return []
    lengths = np.array(sorted(histogram))
    left = np.array([histogram[n] for n in lengths.tolist()], np.int64)
    by_room: dict[int, list[tuple[dict[int, int], int]]] = {}
    for copies, n in configurations(lengths, left, capacity):
        by_room.setdefault(capacity - sum(x * c for x, c in copies.items()), []).append((copies, n))

    def put(copies, room, n, length, many):
        filled = {**copies, length: copies.get(length, 0) + many}
        by_room.setdefault(room - length * many, []).append((filled, n))

    for i in range(len(lengths) - 1, -1, -1):
        length, rest = int(lengths[i]), int(left[i])
        for room in sorted(r for r in by_room if r >= length):
            while rest and by_room[room]:
                copies, n = by_room[room].pop()
                each = min(room // length, rest)
                use = min(n, rest // each)
                if use < n:
                    by_room[room].append((copies, n - use))
                put(copies, room, use, length, each)
                rest -= use * each
        each = capacity // length
        if rest >= each:
            put({}, capacity, rest // each, length, each)
            rest %= each
        if rest:
            put({}, capacity, 1, length, rest)
    merged: dict[Pattern, int] = {}
    for alike in by_room.values():
        for copies, n in alike:
            key = tuple(sorted(copies.items(), reverse=True))
            merged[key] = merged.get(key, 0) + n
    return sorted(merged.items(), reverse=True)


class Places:
    """Where the r-th piece of each length goes."""

    def __init__(self, patterns: list[tuple[Pattern, int]]):
        per: dict[int, list[tuple[int, int, int, int]]] = {}
        first = 0
        for pattern, n in patterns:
            offset = 0
            for length, copies in pattern:
                per.setdefault(length, []).append((n * copies, first, copies, offset))
                offset += length * copies
            first += n
        self.sequences = first
        self.per = {}
        for length, rows in per.items():
            many, begin, copies, offset = (np.array(x, np.int64) for x in zip(*rows))
            self.per[length] = (np.cumsum(many) - many, begin, copies, offset)

    def of(self, length: int, ranks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        start, begin, copies, offset = self.per[length]
        k = np.searchsorted(start, ranks, side="right") - 1
        inside = ranks - start[k]
        return begin[k] + inside // copies[k], offset[k] + inside % copies[k] * length


def pieces(docs: DataFrame, path: str, capacity: int = CAPACITY, end_id: int = 0) -> DataFrame:
    """Pieces with their token ids' crc32, the task that made them and their rank in it among those of their length."""
    schema = pa.schema([("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64()), ("task", pa.int64()), ("nth", pa.int64())])
    end = np.array([end_id], "<u4").tobytes()

    def run(batches):
        parts = encoder(path).parts
        task, seen = TaskContext.get().partitionId(), np.zeros(capacity + 1, np.int64)
        for b in batches:
            docs = b.column(0).to_pylist()
            for begin, flat, bounds in parts(text_array(b.column(1))):
                rows = []
                raw, bounds = flat.astype("<u4").tobytes(), (4 * bounds).tolist()
                for doc, first, last in zip(docs[begin:], bounds, bounds[1:]):
                    ids = raw[first:last] + end
                    for k, at in enumerate(range(0, len(ids), 4 * capacity)):
                        part = ids[at : at + 4 * capacity]
                        n = len(part) // 4
                        rows.append((doc, k, at // 4, n, zlib.crc32(part), task, int(seen[n])))
                        seen[n] += 1
                yield table(schema, **dict(zip(schema.names, map(list, zip(*rows)))))

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of(docs).alias("text"))
    return rows.mapInArrow(lean(run), "doc_id long, piece int, start long, length long, ids_crc32 long, task long, nth long")


def pack(docs: DataFrame, path: str, capacity: int = CAPACITY, end_id: int = 0) -> DataFrame:
    """A row per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset."""
    cut = staged(pieces(docs, path, capacity, end_id), "pieces")
    counts = staged(cut.groupBy("task", "length").agg(F.count("*").alias("n")), "piece-counts")
    histogram = {r["length"]: r["n"] for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}  # at most ``capacity`` rows
    places = cut.sparkSession.sparkContext.broadcast(Places(plan(histogram, capacity)))
    earlier = Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    before = counts.select("task", "length", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))
    ranked = cut.join(before, ["task", "length"]).select("doc_id", "piece", "start", "length", "ids_crc32", (F.col("before") + F.col("nth")).alias("rank"))

    def place(batches):
        for b in batches:
            length, rank = (b.column(i).to_numpy() for i in (3, 5))
            sequence, offset = np.empty(len(length), np.int64), np.empty(len(length), np.int64)
            order = np.argsort(length, kind="stable")
            for group in np.split(order, np.flatnonzero(np.diff(length[order])) + 1):
                if len(group):
                    sequence[group], offset[group] = places.value.of(int(length[group[0]]), rank[group])
            yield pa.RecordBatch.from_arrays([*b.columns[:5], pa.array(sequence), pa.array(offset)], names=["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"])

    return ranked.mapInArrow(place, "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long")
