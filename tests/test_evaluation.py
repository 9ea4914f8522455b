import math
import random

import pytest
from pyspark.ml.evaluation import BinaryClassificationEvaluator

from shelfmatch.operators import evaluation as E


@pytest.fixture(scope="module")
def labelled(spark):
    random.seed(2)
    rows = [(int(random.random() < 0.4), round(random.random(), 3)) for _ in range(800)]
    rows = [(y, min(1.0, s + 0.2 * y)) for y, s in rows]
    return rows, spark.createDataFrame(rows, "label int, score double")


def test_confusion(spark):
    df = spark.createDataFrame([(1, 0.8), (1, 0.7), (0, 0.9), (0, 0.1), (0, 0.2), (1, None)], "label int, score double")
    row = E.confusion(df).first()
    assert (row.tn, row.fp, row.fn, row.tp) == (2, 1, 1, 1) and row.tp_share == 0.2
    report = {r["class"]: r for r in E.class_report(df).collect()}
    assert report["1"].precision == 0.5 and report["0"].recall == pytest.approx(2 / 3) and report["accuracy"].f1 == 0.6
    assert report["macro avg"].support == 5


def test_curves(labelled):
    rows, df = labelled
    points = {r.score: (r.tp, r.fp) for r in E.score_points(df).collect()}
    for s, (tp, fp) in points.items():
        assert tp == sum(y for y, x in rows if x >= s) and fp == sum(1 - y for y, x in rows if x >= s)
    roc = E.roc_points(df).orderBy("score").first()
    assert (roc.fpr, roc.tpr) == (1.0, 1.0)


def test_auc_agrees_with_the_built_in_evaluator(labelled):
    _, df = labelled
    value = E.roc_auc(df).first().roc_auc
    spark_value = BinaryClassificationEvaluator(rawPredictionCol="score", labelCol="label", numBins=0).evaluate(df)
    assert value == pytest.approx(spark_value, abs=1e-9)


def test_average_precision(spark):
    df = spark.createDataFrame([(0, 0.1), (0, 0.4), (1, 0.35), (1, 0.8)], "label int, score double")
    assert E.average_precision(df).first()[0] == pytest.approx(0.8333333333)
    assert E.roc_auc(df).first()[0] == 0.75
    assert E.positive_rate(df).first()[0] == 0.5


def test_scores_outside_the_bands(spark):
    df = spark.createDataFrame([(1, 5.0), (0, -3.0), (1, 7.0), (0, 6.0)], "label int, score double")
    assert {r.score: (r.tp, r.fp) for r in E.score_points(df).collect()} == {7.0: (1, 0), 6.0: (1, 1), 5.0: (2, 1), -3.0: (2, 2)}


def test_expectations(spark):
    rows = [("agua 1l", "Agua 1L", 1.0, "=="), ("agua 1l", "zapato", 0.5, "<="), ("agua 1l", "zapato", 0.5, ">="), ("a", "a", 1.0, "?")]
    df = spark.createDataFrame(rows, "own_name string, competitor_name string, expected double, op string")
    assert sorted(r.passed for r in E.check_expected(df).collect()) == [False, False, True, True]


def test_explained_pair(spark):
    df = spark.createDataFrame([("boing fresa 500ml 24pz", "jugo boing surtidos 500ml - 24pz")], "a string, b string")
    row = E.explain_pairs(df, "a", "b").first()
    assert row.a_clean == "boing" * 5 + "\x03fresa 500ml 24pz" and row.b_clean == "boing" * 5 + "\x03500ml 24pz"
    assert row.a_units == row.b_units == ["500ml", "24pz"] and row.jac_conf == 1.0
    assert 0 < row.comb_conf < 1 and not math.isnan(row.lvd_conf)


def test_no_band_holds_more_than_its_share(spark):
    rows = [(i % 2, float(i) / 200) for i in range(20_000)]  # scores from 0 to 100
    points = E.score_points(spark.createDataFrame(rows, "label int, score double"))
    assert points.count() == 20_000
    last = points.orderBy("score").first()
    assert (last.tp, last.fp, last.positives, last.negatives) == (10_000, 10_000, 10_000, 10_000)


def test_no_partition_holds_all_scores(spark):
    """Running totals are taken inside ranges of scores, one crowded range included."""
    from pyspark.sql import functions as F

    df = spark.range(40_000).select((F.col("id") % 3 == 0).cast("int").alias("label"), F.when(F.col("id") % 2 == 0, F.col("id") * 1e-12).otherwise(F.col("id") * 1.0).alias("score"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # few rows would share a task
    try:
        points = E.score_points(df)
        assert points.withColumn("part", F.spark_partition_id()).groupBy("part").count().agg(F.max("count")).first()[0] < 20_000
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    last = points.orderBy("score").first()
    assert (last.tp, last.fp) == (last.positives, last.negatives) == (13334, 26666)
