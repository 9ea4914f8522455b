"""Units, distances and confidence of normalised product names."""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .binding import let
from .lcs import indel_percent
from .rounding import round_exact

# Letters that may follow the number of a measure unit.
UNIT = r"\d*[\.]?\d+[ml|lt|pz|g|oz|kg]+"
UNIT_TAIL = r"\d+[ml|lt|pz|g|oz|kg]+(\s|$)"


@dataclass(frozen=True)
class Scoring:
    """Weights of a confidence.

    ``Scoring()`` is the current formula.  ``Scoring.first_version()`` is the
    earlier one: lighter units, steeper calibration, two decimals, no clamp.
    """

    dice_weight: float = 0.7
    unit_weight: float = 0.17
    decay: float = 1.01
    digits: int = 4
    clamp: bool = True

    @classmethod
    def first_version(cls) -> Scoring:
        return cls(unit_weight=0.1, decay=1.1, digits=2, clamp=False)

    def least_raw(self, threshold: float) -> float:
        """Raw score below which the rounded confidence stays under ``threshold``."""
        t = threshold - 0.5 * 10**-self.digits
        if t <= 0:
            return -math.inf
        return (1 / (1 - math.log(t))) ** (1 / self.decay) - 1e-9


def extract_units(name: Column) -> Column:
    """All number-plus-unit tokens, in order."""
    return F.regexp_extract_all(name, F.lit(UNIT), F.lit(0))


def remove_units(name: Column) -> Column:
    """The name without its unit tokens (their blank goes with them), trimmed."""
    return F.trim(F.regexp_replace(name, UNIT_TAIL, ""))


def token_sort(name: Column) -> Column:
    """Lower-cased word tokens in order, joined by blanks."""
    words = F.regexp_replace(F.regexp_replace(name, "[\u0080-ÿ]+", ""), r"(?U)\W", " ")
    tokens = F.filter(F.split(F.lower(words), r"\s+"), lambda t: t != "")
    return F.array_join(F.array_sort(tokens), " ")


def char_set(text: Column) -> Column:
    """Distinct characters, sorted."""
    return F.array_sort(F.array_distinct(F.filter(F.split(text, ""), lambda c: c != "")))


def token_sort_ratio(a: Column, b: Column) -> Column:
    """Indel similarity of the sorted tokens, integer percent; two empty texts are equal."""
    return indel_percent(token_sort(a), token_sort(b))


def percent_to_distance(percent: Column) -> Column:
    return (100 - percent) * 0.01


def token_sort_distance(a: Column, b: Column) -> Column:
    return percent_to_distance(token_sort_ratio(a, b))


def dice_of_sets(sa: Column, sb: Column) -> Column:
    def dice(v: Column) -> Column:
        shared = F.size(F.array_intersect(v["a"], v["b"]))
        total = F.size(v["a"]) + F.size(v["b"])
        return F.when(total == 0, 0.0).otherwise(1 - shared * 2.0 / total)

    return let(F.struct(sa.alias("a"), sb.alias("b")), dice)


def dice_distance(a: Column, b: Column) -> Column:
    """Sorensen-Dice distance of the distinct characters; two empty texts are equal."""
    return dice_of_sets(char_set(a), char_set(b))


def mix_distances(lev: Column, dice: Column, dice_weight: float) -> Column:
    return (lev * (2 - dice_weight) + dice * dice_weight) / 2


def combined_distance(a: Column, b: Column, dice_weight: float = 0.7) -> Column:
    """Mean of token-sort and character-set distance of the names without units."""
    ba, bb = remove_units(a), remove_units(b)
    return mix_distances(token_sort_distance(ba, bb), dice_distance(ba, bb), dice_weight)


def jaccard_similarity(a: Column, b: Column) -> Column:
    """Jaccard similarity of two arrays as sets; two empty arrays are equal."""
    def jaccard(v: Column) -> Column:
        union = F.size(F.array_union(v["a"], v["b"]))
        return F.when(union == 0, 1.0).otherwise(F.size(F.array_intersect(v["a"], v["b"])) / union)

    return let(F.struct(a.alias("a"), b.alias("b")), jaccard)


def unit_parts(unit: Column) -> Column:
    """Number and letter runs of a unit; an empty text leads when it starts with a digit."""
    runs = F.regexp_extract_all(unit, F.lit(r"\d+|\D+"), F.lit(0))
    lead = F.when(unit.rlike(r"^\d"), F.array(F.lit(""))).otherwise(F.array().cast("array<string>"))
    return F.concat(lead, runs)


def unit_distance(a: Column, b: Column) -> Column:
    """Jaccard distance of the units; two single units are compared by their parts."""
    return unit_list_distance(extract_units(a), extract_units(b))


def unit_list_distance(ua: Column, ub: Column) -> Column:
    def distance(v: Column) -> Column:
        both_single = (F.size(v["a"]) == 1) & (F.size(v["b"]) == 1)
        parts = jaccard_similarity(unit_parts(F.get(v["a"], F.lit(0))), unit_parts(F.get(v["b"], F.lit(0))))
        return 1 - F.when(both_single, parts).otherwise(jaccard_similarity(v["a"], v["b"]))

    return let(F.struct(ua.alias("a"), ub.alias("b")), distance)


def raw_confidence(closeness: Column, unit_dist: Column, scoring: Scoring = Scoring()) -> Column:
    raw = closeness - unit_dist * scoring.unit_weight
    return F.greatest(F.lit(0.0), raw) if scoring.clamp else raw


def calibrate(raw: Column, decay: float = 1.02) -> Column:
    """``exp(1 - 1/x^decay)``; 0 at 0 and, without a clamp, below."""
    return let(raw, lambda x: F.when(x <= 0, 0.0).otherwise(F.exp(1 - 1 / F.pow(x, F.lit(decay)))))


def confidence_of(closeness: Column, unit_dist: Column, scoring: Scoring = Scoring()) -> Column:
    """Rounded confidence from ``1 - combined_distance`` and the unit distance."""
    value = calibrate(raw_confidence(closeness, unit_dist, scoring), scoring.decay)
    return let(value, lambda v: round_exact(v, scoring.digits))


def confidence(a: Column, b: Column, scoring: Scoring = Scoring()) -> Column:
    """Match confidence of two normalised names, 0 to 1."""
    closeness = 1 - combined_distance(a, b, scoring.dice_weight)
    return confidence_of(closeness, unit_distance(a, b), scoring)


def with_confidence(df: DataFrame, scoring: Scoring = Scoring()) -> DataFrame:
    """Add ``confidence`` from columns ``closeness`` and ``unit_dist``, in plain steps that compile."""
    x = F.col("_raw")
    value = F.when(x <= 0, 0.0).otherwise(F.exp(1 - 1 / F.pow(x, F.lit(scoring.decay))))
    return (
        df.withColumn("_raw", raw_confidence(F.col("closeness"), F.col("unit_dist"), scoring))
        .withColumn("_value", value)
        .withColumn("confidence", round_exact(F.col("_value"), scoring.digits))
        .drop("_raw", "_value")
    )


def score_pairs(pairs: DataFrame, a: str, b: str, scoring: Scoring = Scoring()) -> DataFrame:
    """Add ``closeness`` (1 - combined distance), ``unit_dist`` and ``confidence`` of two name columns.

    The features of a name are computed once per row, whatever the columns hold.
    """
    ba, bb = remove_units(F.col(a)), remove_units(F.col(b))
    featured = pairs.withColumns({"_ba": ba, "_bb": bb}).withColumn("_percent", token_sort_ratio(F.col("_ba"), F.col("_bb")))
    closeness = 1 - mix_distances(percent_to_distance(F.col("_percent")), dice_distance(F.col("_ba"), F.col("_bb")), scoring.dice_weight)
    scored = featured.withColumns({"closeness": closeness, "unit_dist": unit_distance(F.col(a), F.col(b))})
    return with_confidence(scored.drop("_ba", "_bb", "_percent"), scoring)
