"""Best-match join: for every left name the right name of highest confidence.

Names are cut into blocks of like texts, pairs of blocks that cannot hold a match are
skipped (see ``blocks``), one task scores one block of each side, and all it returns is the
best right name per left name; so neither the pairs of names nor those of forms
are ever listed.  Any ``Scorer`` can be the measure.

The confidence of a pair is ``closeness - unit_weight * unit_distance``, calibrated, and closeness
depends on the names *without* their units only, their forms.  Inside a task

1. matrix products of character counts bound the closeness of all forms,
2. an exact LCS runs where the bound can still win,
3. units are compared only for names whose forms are close enough to win,
   whatever their units, and not name by name: the names of a form are found by the units they share
   with a unit list (see ``functions.shared``).

The result is exact.  Ties in the rounded confidence go to the smallest id, in the order of the id's own type.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, StructType
from pyspark.util import inheritable_thread_target

from ..functions.lcs import encode, indel_percents, lcs_pairs
from ..functions.names import distinct_texts, spread
from ..functions.scorer import Scorer, common_bound
from ..functions.shared import NAMES, SharedItems, distinct_sets, expanded
from ..functions.similarity import Scoring, mix_distances, percent_to_distance
from .blocks import cut_side, kept_pairs, with_partners
from .lineage import cut_lineage

# characters of text in one block: 2^20 are 32k names of 32 characters
BLOCK_CHARS = 1 << 20
# rows x columns of one matrix of forms inside a task
TILE = (512, 4096)
# name pairs compared at once inside a task
PAIRS = 1 << 20
# the bound a pair must miss by before it is dropped, against float noise
SLACK = 1e-6


# ---------------------------------------------------------------- the confidence as a scorer

# letters whose counts are features of their own; all other characters share the last one
_LETTERS = " 0123456789abcdefghijklmnopqrstuvwxyz"


@dataclass(frozen=True)
class ConfidenceScorer(Scorer):
    """The match confidence of two normalised names."""

    scoring: Scoring = Scoring()
    columns = ("form_text", "form_chars", "units")

    @property
    def digits(self) -> int:
        return self.scoring.digits

    def prepared(self, names: DataFrame, text: str) -> DataFrame:
        """Add ``form_text`` and ``form_chars`` (what closeness depends on) and ``units``."""
        from ..functions import similarity as S  # here: a scorer is sent to the tasks, these Columns are not

        base = F.col("_base")
        featured = names.withColumn("_base", S.remove_units(F.col(text)))
        return featured.withColumns({
            "form_text": S.token_sort(base), "form_chars": F.array_join(S.char_set(base), ""), "units": S.extract_units(F.col(text)),
        }).drop("_base")

    def features(self, texts: pd.DataFrame) -> np.ndarray:
        """Length of the form, and how often it has each letter."""
        forms = texts["form_text"].tolist()
        out = np.zeros((len(forms), len(_LETTERS) + 2), np.int64)
        lengths = np.fromiter(map(len, forms), np.int64, len(forms))
        points = np.frombuffer("".join(forms).encode("utf-32-le", "surrogatepass"), np.uint32)
        column = np.full(128, len(_LETTERS) + 1)
        column[[ord(c) for c in _LETTERS]] = np.arange(len(_LETTERS)) + 1
        np.add.at(out, (np.repeat(np.arange(len(forms)), lengths), column[np.minimum(points, 127)]), 1)
        out[:, 0] = lengths
        return out

    def bound(self, low_a, high_a, low_b, high_b):
        """Closeness at most, with as much in common as the letters allow, and all units equal."""
        common = common_bound(low_a[..., 1:], high_a[..., 1:], low_b[..., 1:], high_b[..., 1:])
        la, lb = low_a[..., 0], low_b[..., 0]
        # the texts have at least their least length, and at least what they have in common
        total = np.maximum(la, common) + np.maximum(lb, common)
        # lengths that do not meet: the longer text cannot be matched in full
        shorter = np.minimum(high_a[..., 0], high_b[..., 0])
        longer = np.maximum(la, lb)
        ratio = np.where(total == 0, 1.0, 2.0 * common / np.maximum(np.where(common < longer, la + lb, total), 1))
        apart = np.where(shorter < longer, 2.0 * shorter / np.maximum(shorter + longer, 1), 1.0)
        percent = np.rint(np.minimum(np.minimum(ratio, apart), 1.0) * 100 + SLACK) + 1e-9
        lev = percent_to_distance(np.minimum(percent, 100.0))
        closeness = 1 - mix_distances(lev, 0.0, self.scoring.dice_weight)
        return np.where(closeness > 0, np.exp(1 - np.maximum(closeness, 1e-3) ** -self.scoring.decay), 0.0)

    def least(self, threshold: float) -> float:
        return threshold - 0.5 * 10**-self.digits - SLACK

    def score(self, a: pd.DataFrame, b: pd.DataFrame) -> np.ndarray:
        """The confidences, pair by pair: by the arrays that ``match`` uses."""
        codes, lengths, k = encode([*a["form_text"], *b["form_text"]])
        pairs = np.arange(len(a)), np.arange(len(a)) + len(a)
        total = (lengths[: len(a)] + lengths[len(a) :]).astype(np.float64)
        chars = [(set(x), set(y)) for x, y in zip(a["form_chars"], b["form_chars"])]
        sizes = np.array([len(x) + len(y) for x, y in chars], np.float64)
        shared = np.array([len(x & y) for x, y in chars], np.float64)
        dice = np.where(sizes == 0, 0.0, 1 - shared * 2.0 / np.maximum(sizes, 1))
        close = _closeness(lcs_pairs(codes, lengths, k, *pairs), total, dice, self.scoring)
        units = _Units(a["units"].tolist(), b["units"].tolist())
        return _confidence(close - units.distance(np.arange(len(a)), np.arange(len(a))) * self.scoring.unit_weight, self.scoring)

    def match(self, left: pd.DataFrame, right: pd.DataFrame, threshold: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        return score_block(left, right, self.scoring, threshold)


# ---------------------------------------------------------------- inside a task


def _presence(codes: np.ndarray, k: int) -> np.ndarray:
    """Which characters each row of codes has."""
    flat = np.zeros((len(codes), k + 1), np.float32)
    flat[np.repeat(np.arange(len(codes)), codes.shape[1]), codes.reshape(-1)] = 1
    flat[:, 0] = 0
    return flat


def _most_shared(codes: np.ndarray, k: int, n_left: int) -> np.ndarray:
    """How often each character can be shared: an occurrence the other side never has cannot."""
    most = np.zeros((2, k + 1), np.int64)
    for start in range(0, len(codes), TILE[1]):
        for side, part in enumerate((codes[start : min(start + TILE[1], n_left)], codes[max(start, n_left) : start + TILE[1]])):
            if len(part):
                rows = np.repeat(np.arange(len(part)), part.shape[1])
                counts = np.bincount(rows * (k + 1) + part.reshape(-1), minlength=len(part) * (k + 1)).reshape(len(part), k + 1)
                np.maximum(most[side], counts.max(axis=0), out=most[side])
    return most.min(axis=0)


def _counted(codes: np.ndarray, k: int, most: np.ndarray) -> np.ndarray:
    """Thermometer code of the character counts: products give shared counts."""
    rows = np.repeat(np.arange(len(codes)), codes.shape[1])
    counts = np.zeros((len(codes), k + 1), np.int64)
    np.add.at(counts, (rows, codes.reshape(-1)), 1)
    parts = [counts[:, c : c + 1] > np.arange(most[c]) for c in range(1, k + 1)]
    return np.concatenate(parts, axis=1).astype(np.float32) if parts else np.zeros((len(codes), 1), np.float32)


def _dice(a: np.ndarray, b: np.ndarray, na: np.ndarray, nb: np.ndarray) -> np.ndarray:
    total = (na[:, None] + nb[None, :]).astype(np.float64)
    shared = (a @ b.T).astype(np.float64)
    return np.where(total == 0, 0.0, 1 - shared * 2.0 / np.maximum(total, 1))


def _closeness(lcs: np.ndarray, total: np.ndarray, dice: np.ndarray, scoring: Scoring) -> np.ndarray:
    """The closeness of ``similarity``, on arrays and with the same operations."""
    return 1 - mix_distances(percent_to_distance(indel_percents(lcs, total)), dice, scoring.dice_weight)


def _confidence(raw: np.ndarray, scoring: Scoring) -> np.ndarray:
    return np.where(raw > 0, np.exp(1 - np.maximum(raw, 1e-3) ** -scoring.decay), 0.0)


def _least_closeness(raw: np.ndarray, scoring: Scoring, least_raw: float) -> np.ndarray:
    """Closeness a form needs to beat or tie a name that has reached ``raw``, units at their best."""
    reached = np.exp(1 - np.maximum(raw, 1e-3) ** -scoring.decay) - 10**-scoring.digits
    floor = (1 - np.log(np.maximum(reached, 1e-300))) ** (-1 / scoring.decay)
    return np.maximum(np.where(reached > 0, floor, -np.inf), least_raw) - SLACK


def _distance(shared: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Jaccard distance of sets of ``a`` and ``b`` items; two empty sets are equal."""
    union = a + b - shared
    return 1 - np.where(union == 0, 1.0, shared / np.maximum(union, 1))


class _Units:
    """Unit lists of both sides as padded id arrays, for distances of many name pairs."""

    def __init__(self, left: list, right: list):
        lists = [list(u) for u in left] + [list(u) for u in right]
        self.n_left = len(left)
        self.single = np.array([len(u) == 1 for u in lists])
        self.whole, self.whole_n = self._ids([set(u) for u in lists])
        self.parts, self.parts_n = self._ids([_unit_parts(u) for u in lists])

    @staticmethod
    def _ids(sets: list[set]) -> tuple[np.ndarray, np.ndarray]:
        ids: dict[str, int] = {}
        sizes = np.array([len(s) for s in sets])
        out = np.full((len(sets), max(1, int(sizes.max(initial=0)))), -1, np.int32)
        for row, s in enumerate(sets):
            for col, u in enumerate(s):
                out[row, col] = ids.setdefault(u, len(ids))
        return out, sizes

    @staticmethod
    def _distance(ids: np.ndarray, sizes: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        shared = np.zeros(len(a), np.int64)
        ids_b = ids[b]
        for col in range(int(sizes[a].max(initial=0))):
            mine = ids[a, col]
            shared += ((ids_b == mine[:, None]).any(axis=1)) & (mine >= 0)
        return _distance(shared, sizes[a], sizes[b])

    def distance(self, li: np.ndarray, ri: np.ndarray) -> np.ndarray:
        b = ri + self.n_left
        out = self._distance(self.whole, self.whole_n, li, b)
        both = np.flatnonzero(self.single[li] & self.single[b])
        out[both] = self._distance(self.parts, self.parts_n, li[both], b[both])
        return out


def _unit_parts(units: list) -> set:
    """What a single unit is compared by, with another single one."""
    return set(re.split(r"(\d+)", units[0])) if len(units) == 1 else set()


class _UnitGroups:
    """The names of every right form, to be found by what they share with a unit list.

    Two single units are compared by their parts, all other lists by their units.
    """

    def __init__(self, left: list, right: list, form_of: np.ndarray, n_forms: int):
        left, right = [list(u) for u in left], [list(u) for u in right]
        mine, theirs = np.array([len(u) == 1 for u in left], bool), np.array([len(u) == 1 for u in right], bool)
        self.listed_left, self.listed_right = np.ones(len(left), bool), np.ones(len(right), bool)
        self.tables = []
        for sets, lefts, rights in (
            (_unit_parts, mine, theirs), (set, mine, ~theirs), (set, ~mine, np.ones(len(right), bool)),
        ):
            li, ri = np.flatnonzero(lefts), np.flatnonzero(rights)
            if not len(li) or not len(ri):
                continue
            left_set, left_sets = distinct_sets([sets(left[i]) for i in li])
            right_set, right_sets = distinct_sets([sets(right[i]) for i in ri])
            table = SharedItems(left_sets, right_sets, form_of[ri], right_set, ri, n_forms)
            set_of = np.full(len(left), -1, np.int64)
            set_of[li] = left_set
            self.tables.append((table, set_of))
            self.listed_left[li] &= table.left.listed[left_set]
            self.listed_right[ri] &= table.right.listed[right_set]

    def find(self, li: np.ndarray, forms: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """For pairs of a left name and a right form: chunks of (position of the pair, right name, unit distance at most).

        The best name of the form, the first at a tie, is among them with its exact distance, if both are listed.
        """
        for table, set_of in self.tables:
            asked = np.flatnonzero(set_of[li] >= 0)
            if len(asked):
                pair, shared, size, place = table.find(set_of[li[asked]], forms[asked])
                yield asked[pair], place, _distance(shared, table.left.size[set_of[li[asked[pair]]]], size)


class _Members:
    """Names of every form: positions sorted by form, with start and count; ``some`` says which names."""

    def __init__(self, form_of: np.ndarray, n_forms: int, some: np.ndarray | None = None):
        names = np.arange(len(form_of)) if some is None else np.flatnonzero(some)
        self.order = names[np.argsort(form_of[names], kind="stable")]
        self.count = np.bincount(form_of[names], minlength=n_forms)
        self.start = np.cumsum(self.count) - self.count


def _in_chunks(counts: np.ndarray, most: int) -> Iterator[slice]:
    """Neighbours with at most ``most`` together, or one."""
    ends = np.cumsum(counts)
    at = 0
    while at < len(counts):
        done = ends[at - 1] if at else 0
        to = max(at + 1, int(np.searchsorted(ends, done + most, side="right")))
        yield slice(at, to)
        at = to


def _left_names(fi: np.ndarray, left: _Members) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Chunks of (position in fi, left name)."""
    for some in _in_chunks(left.count[fi], NAMES):
        pair, at = expanded(left.start[fi[some]], left.count[fi[some]])
        yield pair + some.start, left.order[at]


def _name_pairs(fi: np.ndarray, gi: np.ndarray, left: _Members, right: _Members) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Chunks of (position in fi, left name, right name) for pairs of forms, at most PAIRS or the names of one form in each."""
    for pair, li in _left_names(fi, left):
        for some in _in_chunks(right.count[gi[pair]], PAIRS):
            name, at = expanded(right.start[gi[pair[some]]], right.count[gi[pair[some]]])
            yield pair[some][name], li[some][name], right.order[at]


def score_block(left: pd.DataFrame, right: pd.DataFrame, scoring: Scoring, threshold: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Per left name with a match: its position, the position of the best right name (the first at a tie), the confidence."""
    least_raw = scoring.least_raw(threshold)
    lf, left_forms = pd.factorize(pd.MultiIndex.from_frame(left[["form_text", "form_chars"]]))
    rf, right_forms = pd.factorize(pd.MultiIndex.from_frame(right[["form_text", "form_chars"]]))
    nl, nr = len(left_forms), len(right_forms)
    codes, lengths, k = encode([f[0] for f in left_forms] + [f[0] for f in right_forms])
    sets, set_sizes, letters = encode([f[1] for f in left_forms] + [f[1] for f in right_forms])
    most = _most_shared(codes, k, nl)
    groups = _UnitGroups(left.units.tolist(), right.units.tolist(), rf, nr)
    short = groups.listed_left
    lm, rm = _Members(lf, nl, short), _Members(rf, nr)
    # names of very many units are compared one by one
    long_l, long_r = _Members(lf, nl, ~short), _Members(rf, nr, ~groups.listed_right)
    units = None if short.all() and groups.listed_right.all() else _Units(left.units.tolist(), right.units.tolist())
    reached = np.full(len(left), -np.inf)
    best = np.full(len(left), -1, np.int64)

    def keep(li, ri, raw):
        rounded = np.rint(_confidence(raw, scoring) * 10**scoring.digits).astype(np.int64)
        np.maximum.at(best, li, rounded * len(right) + (len(right) - 1 - ri))
        np.maximum.at(reached, li, raw)

    def take(fi, gi, close):
        """Compare the names of pairs of forms and keep the best."""
        for pair, li in _left_names(fi, lm):
            hopeful = close[pair] >= _least_closeness(reached[li], scoring, least_raw)
            pair, li = pair[hopeful], li[hopeful]
            for at, ri, distance in groups.find(li, gi[pair]):
                keep(li[at], ri, close[pair[at]] - distance * scoring.unit_weight)
        for some_l, some_r in ((lm, long_r), (long_l, rm)) if units else ():
            for pair, li, ri in _name_pairs(fi, gi, some_l, some_r):
                c = close[pair]
                hopeful = c >= _least_closeness(reached[li], scoring, least_raw)
                li, ri = li[hopeful], ri[hopeful]
                keep(li, ri, c[hopeful] - units.distance(li, ri) * scoring.unit_weight)

    def needed() -> np.ndarray:
        """Least closeness that helps any name of a left form."""
        floor = np.full(nl, np.inf)
        np.minimum.at(floor, lf, _least_closeness(reached, scoring, least_raw))
        return floor

    for r0 in range(0, nr, TILE[1]):
        r1 = min(nr, r0 + TILE[1])
        tall_r = _counted(codes[nl + r0 : nl + r1], k, most)
        sets_r = _presence(sets[nl + r0 : nl + r1], letters)
        for l0 in range(0, nl, TILE[0]):
            l1 = min(nl, l0 + TILE[0])
            total = (lengths[l0:l1, None] + lengths[None, nl + r0 : nl + r1]).astype(np.float64)
            shared = (_counted(codes[l0:l1], k, most) @ tall_r.T).astype(np.float64)
            dice = _dice(_presence(sets[l0:l1], letters), sets_r, set_sizes[l0:l1], set_sizes[nl + r0 : nl + r1])
            bound = _closeness(shared, total, dice, scoring)

            def exact(fi, gi):
                lcs = lcs_pairs(codes, lengths, k, fi + l0, gi + nl + r0)
                return _closeness(lcs, total[fi, gi], dice[fi, gi], scoring)

            # the most promising form first, then what can still beat it
            fi = np.arange(l1 - l0)
            gi = bound.argmax(axis=1)
            hopeful = bound[fi, gi] >= needed()[l0:l1]
            fi, gi = fi[hopeful], gi[hopeful]
            take(fi + l0, gi + r0, exact(fi, gi))
            bound[fi, gi] = -np.inf
            fi, gi = np.nonzero(bound >= needed()[l0:l1, None])
            close = exact(fi, gi)
            near = close >= needed()[l0:l1][fi]
            order = np.argsort(-close[near], kind="stable")
            take(fi[near][order] + l0, gi[near][order] + r0, close[near][order])

    confidence = (best // len(right)) / 10**scoring.digits
    li = np.flatnonzero((best >= 0) & (confidence >= threshold))
    return li, len(right) - 1 - best[li] % len(right), confidence[li]


# ---------------------------------------------------------------- the operator


def _no_match(left: DataFrame, right: DataFrame, left_name: str, right_id: str, by: str | None) -> DataFrame:
    keys = [F.col(left_name)] if by is None else [F.col(left_name), F.lit(None).cast(right.schema[by].dataType).alias(by)]
    return left.where(F.lit(False)).select(
        *keys, F.lit(None).cast(right.schema[right_id].dataType).alias(right_id), F.lit(None).cast("double").alias("confidence"))


def _described(names: DataFrame, scorer: Scorer) -> DataFrame:
    """``names`` (text, ...) with the scorer's columns, ``size``, the hash ``h`` and ``features``, written down."""
    rows = scorer.prepared(names, "text").withColumns({"size": scorer.size("text").cast("long"), "h": F.xxhash64(*names.columns)})
    schema = StructType(list(rows.schema.fields)).add("features", ArrayType(IntegerType()))

    def add(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield batch.assign(features=list(scorer.features(batch).astype(np.int32)))

    return cut_lineage(rows.mapInPandas(add, schema))


def best_match(
    left: DataFrame,
    right: DataFrame,
    left_name: str = "comp_sku_name_clean",
    right_name: str = "mkp_sku_name_clean",
    right_id: str = "sku",
    threshold: float = 0.40,
    scoring: Scoring = Scoring(),
    by: str | None = None,
    block_chars: int = BLOCK_CHARS,
    scorer: Scorer | None = None,
) -> DataFrame:
    """One row per distinct left name with a match: left_name, [by,] right_id (in its own type), confidence.

    With ``by``, a column of ``right``, every left name gets one match per value of it.  ``scorer`` may be any measure;
    without one it is the confidence with the weights of ``scoring``.
    """
    scorer = scorer or ConfidenceScorer(scoring)
    id_type = right.schema[right_id].dataType
    group = F.lit("") if by is None else F.col(by)
    texts = distinct_texts(left, left_name).select(F.col(left_name).alias("text"))
    names = (
        right.where(F.col(right_name).isNotNull() & group.isNotNull() & F.col(right_id).isNotNull())
        .groupBy(group.cast("string").alias("grp"), F.col(right_name).alias("text"))
        .agg(F.min(right_id).alias("id"))
    )
    # the sides do not depend on each other: their jobs run side by side
    with ThreadPoolExecutor(2) as pool:
        jobs = [pool.submit(inheritable_thread_target(lambda side=side: cut_side(_described(side, scorer), block_chars))) for side in (texts, spread(names, "grp", "text"))]
        ours, theirs = (job.result() for job in jobs)
    if ours is None or theirs is None:
        return _no_match(left, right, left_name, right_id, by)
    kept = kept_pairs(ours, theirs, scorer.bound, scorer.least(threshold))

    def score(a: pd.DataFrame, b: pd.DataFrame) -> pd.DataFrame:
        columns = {"name": [np.zeros(0, object)], "grp": [np.zeros(0, object)], "id": [b.id.to_numpy()[:0]], "confidence": [np.zeros(0)]}
        for g, rows in b.sort_values("id", kind="stable").groupby("grp") if len(a) else []:
            li, ri, confidence = scorer.match(a, rows.reset_index(drop=True), threshold)
            for column, values in zip(columns.values(), (a.text.to_numpy(object)[li], np.full(len(li), g, object), rows.id.to_numpy()[ri], confidence)):
                column.append(values)
        # plain arrays: pandas may hold texts in chunks, which a struct cannot be made of
        joined = {c: np.concatenate(v) for c, v in columns.items()}
        return pd.DataFrame({c: pd.Series(v, dtype=v.dtype) for c, v in joined.items()})

    columns = ["text", *scorer.columns]
    mine = with_partners(ours, theirs, kept).select(F.col("own").alias("l"), F.col("partner").alias("r"), *columns)
    other = with_partners(theirs, ours, kept.T).select(F.col("partner").alias("l"), F.col("own").alias("r"), "grp", "id", *columns)
    schema = StructType().add("name", "string").add("grp", "string").add("id", id_type).add("confidence", "double")
    scored = mine.groupBy("l", "r").cogroup(other.groupBy("l", "r")).applyInPandas(score, schema)
    best = scored.groupBy("name", "grp").agg(F.min(F.struct((-F.col("confidence")).alias("c"), "id")).alias("b"))
    keys = [F.col("name").alias(left_name)]
    if by is not None:
        keys.append(F.col("grp").cast(right.schema[by].dataType).alias(by))
    return best.select(*keys, F.col("b.id").alias(right_id), (-F.col("b.c")).alias("confidence"))
