from __future__ import annotations

import random

import pytest
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.sql import functions as F

from riskflow.operators import evaluation


def test_metrics_by_hand(spark):
    rows = [(1, 1), (1, 0), (0, 1), (0, 0), (0, 0)]
    df = spark.createDataFrame(rows, "label int, prediction int")
    m = evaluation.evaluate(df, "label", "prediction", by=None).first()
    assert (m["tp"], m["fn"], m["fp"], m["tn"], m["n"]) == (1, 1, 1, 2, 5)
    assert (m["accuracy"], m["precision"], m["recall"], m["f1"]) == (0.6, 0.5, 0.5, 0.5)
    cells = {(r["label"], r["prediction"]): r["n"] for r in evaluation.confusion(df, "label", "prediction").collect()}
    assert cells == {(1, 1): 1, (1, 0): 1, (0, 1): 1, (0, 0): 2}


def test_no_positives_gives_zeros(spark):
    df = spark.createDataFrame([(0, 0)], "label int, prediction int")
    m = evaluation.evaluate(df, "label", "prediction", by=None).first()
    assert (m["accuracy"], m["precision"], m["recall"], m["f1"]) == (1.0, 0.0, 0.0, 0.0)
    empty = evaluation.evaluate(df.where("false"), "label", "prediction", by=None).first()
    assert (empty["n"], empty["f1"]) == (0, 0.0)
    assert evaluation.confusion(df, "label", "prediction").count() == 4


def test_weights_and_names(spark):
    df = spark.createDataFrame([("val", 1, 1, 3.0), ("val", 0, 1, 1.0)], "split string, label int, prediction int, w double")
    metrics = evaluation.evaluate(df, "label", "prediction", weight="w")
    assert metrics.first()["precision"] == 0.75
    named = {r["name"]: r["value"] for r in evaluation.prefixed(metrics).collect()}
    assert named["val_precision"] == 0.75 and named["val_tp"] == 3.0
    wide = {r["metric"]: r for r in evaluation.side_by_side(metrics).collect()}
    assert wide["precision"]["val"] == 0.75 and wide["precision"]["train"] is None


def test_auc_by_hand_and_by_pairs(spark):
    df = spark.createDataFrame([(1, 0.9), (0, 0.8), (1, 0.7), (0, 0.1)], "label int, score double")
    assert evaluation.areas(df, "label", "score").first()["roc_auc"] == 0.75
    draw = random.Random(1)
    rows = [(draw.randrange(2), draw.randrange(12) / 10) for _ in range(300)]
    df = spark.createDataFrame(rows, "label int, score double").repartition(6)
    pos = [s for label, s in rows if label == 1]
    neg = [s for label, s in rows if label == 0]
    pairs = sum((p > n) + 0.5 * (p == n) for p in pos for n in neg) / (len(pos) * len(neg))
    assert evaluation.areas(df, "label", "score").first()["roc_auc"] == pytest.approx(pairs)


def test_auc_equals_the_built_in_evaluator(spark):
    draw = random.Random(2)
    rows = [(float(draw.random() < 0.3), draw.random()) for _ in range(400)]
    df = spark.createDataFrame(rows, "label double, score double").repartition(4)
    built_in = BinaryClassificationEvaluator(rawPredictionCol="score", numBins=0).evaluate(df)
    assert evaluation.areas(df, "label", "score").first()["roc_auc"] == pytest.approx(built_in)


def test_curves_match_brute_force(spark):
    draw = random.Random(4)
    rows = [(draw.randrange(2), draw.randrange(30) / 30) for _ in range(400)]
    df = spark.createDataFrame(rows, "label int, score double").repartition(5)
    pos, neg = sum(label for label, _ in rows), sum(1 - label for label, _ in rows)
    roc = evaluation.roc_curve(df, "label", "score").collect()
    pr = {r["threshold"]: r for r in evaluation.pr_curve(df, "label", "score").collect()}
    assert len(roc) == len({s for _, s in rows})
    for r in roc:
        tp = sum(label for label, s in rows if s >= r["threshold"])
        fp = sum(1 - label for label, s in rows if s >= r["threshold"])
        assert (r["tpr"], r["fpr"]) == pytest.approx((tp / pos, fp / neg))
        assert pr[r["threshold"]]["precision"] == pytest.approx(tp / (tp + fp))
    binned = evaluation.roc_curve(df, "label", "score", bins=10)
    assert binned.count() == 10


def test_one_class_only(spark):
    df = spark.createDataFrame([(1, 0.2), (1, 0.4)], "label int, score double")
    assert evaluation.areas(df, "label", "score").first()["roc_auc"] is None
    assert evaluation.roc_curve(df, "label", "score").agg(F.max("fpr")).first()[0] == 0.0
