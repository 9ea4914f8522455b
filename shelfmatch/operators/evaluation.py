"""Quality of a match against labels (0/1) and scores.

Scores are grouped first, then cumulated.  The running totals are taken in two levels: the distinct scores are dealt by
range, each partition is summed up inside, and the totals of the partitions before it are added.  So no task holds all
distinct scores, whatever their distribution, and nothing of them passes through the driver.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import similarity as S
from ..functions.names import NameRules, distinct_texts, normalize_names
from ..functions.similarity import Scoring
from .lineage import cut_lineage


def confusion(df: DataFrame, label: str = "label", score: str = "score", threshold: float = 0.8) -> DataFrame:
    """tn, fp, fn, tp at a threshold, as counts and as shares of all rows."""
    actual, predicted = F.col(label) == 1, F.col(score) >= threshold
    counts = df.where(F.col(label).isNotNull() & F.col(score).isNotNull()).agg(
        F.count_if(~actual & ~predicted).alias("tn"),
        F.count_if(~actual & predicted).alias("fp"),
        F.count_if(actual & ~predicted).alias("fn"),
        F.count_if(actual & predicted).alias("tp"),
    )
    total = F.col("tn") + F.col("fp") + F.col("fn") + F.col("tp")
    return counts.select("*", *[F.try_divide(F.col(c), total).alias(f"{c}_share") for c in ("tn", "fp", "fn", "tp")])


def class_report(df: DataFrame, label: str = "label", score: str = "score", threshold: float = 0.8) -> DataFrame:
    """precision, recall, f1 and support per class, accuracy, macro and weighted averages."""
    def entry(name: str, p: Column, r: Column, f1: Column, support: Column) -> Column:
        return F.struct(F.lit(name).alias("class"), p.alias("precision"), r.alias("recall"), f1.alias("f1"), support.alias("support"))

    def ratio(a: Column, b: Column) -> Column:
        return F.coalesce(F.try_divide(a.cast("double"), b.cast("double")), F.lit(0.0))

    tn, fp, fn, tp = (F.col(c) for c in ("tn", "fp", "fn", "tp"))
    c = confusion(df, label, score, threshold).select(
        ratio(tn, tn + fn).alias("p0"), ratio(tn, tn + fp).alias("r0"), ratio(2 * tn, 2 * tn + fn + fp).alias("f0"), (tn + fp).alias("n0"),
        ratio(tp, tp + fp).alias("p1"), ratio(tp, tp + fn).alias("r1"), ratio(2 * tp, 2 * tp + fp + fn).alias("f1"), (tp + fn).alias("n1"),
        ratio(tp + tn, tn + fp + fn + tp).alias("acc"),
    )
    n = F.col("n0") + F.col("n1")

    def macro(x: str) -> Column:
        return (F.col(f"{x}0") + F.col(f"{x}1")) / 2

    def weighted(x: str) -> Column:
        return ratio(F.col(f"{x}0") * F.col("n0") + F.col(f"{x}1") * F.col("n1"), n)

    rows = F.array(
        entry("0", F.col("p0"), F.col("r0"), F.col("f0"), F.col("n0")),
        entry("1", F.col("p1"), F.col("r1"), F.col("f1"), F.col("n1")),
        entry("accuracy", F.col("acc"), F.col("acc"), F.col("acc"), n),
        entry("macro avg", macro("p"), macro("r"), macro("f"), n),
        entry("weighted avg", weighted("p"), weighted("r"), weighted("f"), n),
    )
    return c.select(F.explode(rows).alias("e")).select("e.*")


def score_points(df: DataFrame, label: str = "label", score: str = "score") -> DataFrame:
    """Per distinct score: own counts (n_pos, n_neg), running counts (tp, fp) and totals."""
    by_score = (
        df.where(F.col(label).isNotNull() & F.col(score).isNotNull())
        .groupBy(F.col(score).alias("score"))
        .agg(F.count_if(F.col(label) == 1).alias("n_pos"), F.count_if(F.col(label) != 1).alias("n_neg"))
    )
    # written down with the partition, as ranges are cut anew whenever they are computed
    parts = cut_lineage(by_score.repartitionByRange(F.desc("score")).withColumn("part", F.spark_partition_id()))
    # a row for each partition
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    everywhere = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    totals = (
        parts.groupBy("part").agg(F.sum("n_pos").alias("p"), F.sum("n_neg").alias("n"))
        .select(
            "part",
            F.coalesce(F.sum("p").over(before), F.lit(0)).alias("tp_before"),
            F.coalesce(F.sum("n").over(before), F.lit(0)).alias("fp_before"),
            F.sum("p").over(everywhere).alias("positives"),
            F.sum("n").over(everywhere).alias("negatives"),
        )
    )
    inside = Window.partitionBy("part").orderBy(F.desc("score")).rowsBetween(Window.unboundedPreceding, 0)
    return parts.join(F.broadcast(totals), "part").select(
        "score", "n_pos", "n_neg",
        (F.col("tp_before") + F.sum("n_pos").over(inside)).alias("tp"),
        (F.col("fp_before") + F.sum("n_neg").over(inside)).alias("fp"),
        "positives", "negatives",
    )


def roc_points(df: DataFrame, label: str = "label", score: str = "score") -> DataFrame:
    """score, fpr, tpr at every distinct score (the origin, above all scores, is left out)."""
    return score_points(df, label, score).select(
        "score",
        F.try_divide(F.col("fp"), F.col("negatives")).alias("fpr"),
        F.try_divide(F.col("tp"), F.col("positives")).alias("tpr"),
    )


def pr_points(df: DataFrame, label: str = "label", score: str = "score") -> DataFrame:
    """score, precision, recall at every distinct score."""
    return score_points(df, label, score).select(
        "score",
        (F.col("tp") / (F.col("tp") + F.col("fp"))).alias("precision"),
        F.try_divide(F.col("tp"), F.col("positives")).alias("recall"),
    )


def roc_auc(df: DataFrame, label: str = "label", score: str = "score") -> DataFrame:
    """Area under the ROC points by trapezoids, in whole numbers up to the last division."""
    doubled = F.col("n_neg").cast("decimal(20,0)") * (2 * F.col("tp") - F.col("n_pos")).cast("decimal(20,0)")
    return score_points(df, label, score).agg(
        F.sum(doubled).alias("a"), F.max("positives").alias("p"), F.max("negatives").alias("n")
    ).select(F.try_divide(F.col("a").cast("double"), 2.0 * F.col("p") * F.col("n")).alias("roc_auc"))


def average_precision(df: DataFrame, label: str = "label", score: str = "score") -> DataFrame:
    """Precision averaged over the steps of recall."""
    step = F.col("n_pos") * F.col("tp") / (F.col("tp") + F.col("fp"))
    return score_points(df, label, score).agg(
        F.sum(step).alias("s"), F.max("positives").alias("p")
    ).select(F.try_divide(F.col("s"), F.col("p").cast("double")).alias("average_precision"))


def positive_rate(df: DataFrame, label: str = "label") -> DataFrame:
    """Share of positives, the base line of a precision-recall curve."""
    return df.agg(F.avg(F.col(label).cast("double")).alias("positive_rate"))


def with_normalized(df: DataFrame, names: dict[str, str], rules: NameRules | None = None) -> DataFrame:
    """Add the normalised form of several columns (source to target); each distinct text is normalised once."""
    texts = None
    for source in names:
        own = df.select(F.col(source).alias("_name"))
        texts = own if texts is None else texts.union(own)
    done = cut_lineage(normalize_names(distinct_texts(texts, "_name"), "_name", "_normal", rules))
    for source, target in names.items():
        known = done.select(F.col("_name").alias(f"_{target}"), F.col("_normal").alias(target))
        df = df.join(known, df[source] == F.col(f"_{target}"), "left").drop(f"_{target}")
    return df


def explain_pairs(pairs: DataFrame, a: str, b: str, rules: NameRules | None = None, scoring: Scoring = Scoring()) -> DataFrame:
    """Normalised names, partial and combined scores and units of every pair."""
    cleaned = with_normalized(pairs, {a: "a_clean", b: "b_clean"}, rules)
    scored = S.score_pairs(cleaned, "a_clean", "b_clean", scoring)
    return scored.select(
        *cleaned.columns,
        F.round("closeness", 2).alias("lvd_conf"),
        F.round(1 - F.col("unit_dist"), 2).alias("jac_conf"),
        F.col("confidence").alias("comb_conf"),
        S.extract_units(F.col("a_clean")).alias("a_units"),
        S.extract_units(F.col("b_clean")).alias("b_units"),
    )


def check_expected(expected: DataFrame, rules: NameRules | None = None, scoring: Scoring = Scoring()) -> DataFrame:
    """Expected pairs with their confidence and ``passed``; an unknown operator does not pass."""
    cleaned = with_normalized(expected, {"own_name": "_a", "competitor_name": "_b"}, rules)
    passed = (
        F.when(F.col("op") == "==", F.col("confidence") == F.col("expected"))
        .when(F.col("op") == "<=", F.col("confidence") <= F.col("expected"))
        .when(F.col("op") == ">=", F.col("confidence") >= F.col("expected"))
        .otherwise(False)
    )
    scored = S.score_pairs(cleaned, "_a", "_b", scoring)
    return scored.select(*expected.columns, "confidence").withColumn("passed", passed)
