"""Classifier metrics, confusion table, ROC and precision-recall curves."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from riskflow.functions.columns import FRACTIONAL, known, ratio, require, type_of
from riskflow.plans.ordering import running_sums

LOG_FLOOR = 1e-15


def _sum_if(condition: Column, weight: Column) -> Column:
    return F.coalesce(F.sum(F.when(condition, weight)), F.lit(0))


def evaluate(
    df: DataFrame,
    label: str,
    prediction: str,
    score: str | None = None,
    by: str | Sequence[str] | None = "split",
    weight: str | None = None,
) -> DataFrame:
    """Counts of the confusion table and the metrics made of them, one row per part.

    Label 1 is the positive class. A quotient with nothing below the line is 0.
    ``score`` (probability of label 1) adds the log loss.
    """
    keys = [by] if isinstance(by, str) else list(by or [])
    require(df, [label, prediction, *keys, *([score] if score else []), *([weight] if weight else [])])
    w = F.col(weight) if weight else F.lit(1)
    is_label, is_predicted = F.col(label) == 1, F.col(prediction) == 1
    both_known = F.col(label).isNotNull() & F.col(prediction).isNotNull()
    aggs = [
        _sum_if(is_label & is_predicted, w).alias("tp"),
        _sum_if(~is_label & is_predicted, w).alias("fp"),
        _sum_if(~is_label & ~is_predicted, w).alias("tn"),
        _sum_if(is_label & ~is_predicted, w).alias("fn"),
        _sum_if(both_known, w).alias("n"),
    ]
    if score:
        p = F.least(F.greatest(F.col(score), F.lit(LOG_FLOOR)), F.lit(1 - LOG_FLOOR))
        loss = F.when(is_label, -F.log(p)).otherwise(-F.log(F.lit(1.0) - p))
        aggs.append(_sum_if(both_known, loss * w).alias("_loss"))
    counts = df.groupBy(*keys).agg(*aggs) if keys else df.agg(*aggs)
    tp, fp, tn, fn, n = (F.col(c) for c in ("tp", "fp", "tn", "fn", "n"))
    metrics = counts.select(
        *keys,
        "tp",
        "fp",
        "tn",
        "fn",
        "n",
        ratio(tp + tn, n).alias("accuracy"),
        ratio(tp, tp + fp).alias("precision"),
        ratio(tp, tp + fn).alias("recall"),
        ratio(2 * tp, 2 * tp + fp + fn).alias("f1"),
        *([ratio(F.col("_loss"), n).alias("log_loss")] if score else []),
    )
    return metrics


PARTS = ("train", "val", "test")


def side_by_side(
    metrics: DataFrame,
    by: str = "split",
    names: Sequence[str] = ("accuracy", "precision", "recall", "f1"),
    parts: Sequence[str] | None = None,
) -> DataFrame:
    """One row per metric, one column per part, from the rows of ``evaluate``.

    Without ``parts``, all that the rows name: train, val and test first if any of them is there.
    """
    if parts is None:
        found = [r[0] for r in metrics.select(by).distinct().collect()]
        usual = list(PARTS) if set(found) & set(PARTS) else []
        parts = [*usual, *sorted(p for p in found if p is not None and p not in usual)]
    long = metrics.select(
        by, F.explode(F.array(*[F.struct(F.lit(m).alias("metric"), F.col(m).alias("value")) for m in names])).alias("_m")
    ).select(by, "_m.*")
    return long.groupBy("metric").pivot(by, list(parts)).agg(F.first("value"))


def prefixed(metrics: DataFrame, by: str = "split") -> DataFrame:
    """(name, value) rows with names such as ``val_f1``; rows without a part are named ``none_f1``."""
    names = [c for c in metrics.columns if c != by]
    part = F.coalesce(F.col(by).cast("string"), F.lit("none"))
    entries = F.array(
        *[F.struct(F.concat(part, F.lit(f"_{c}")).alias("name"), F.col(c).cast("double").alias("value")) for c in names]
    )
    return metrics.select(F.explode(entries).alias("_e")).select("_e.*")


def confusion(
    df: DataFrame, label: str, prediction: str, weight: str | None = None, classes: Sequence = (0, 1)
) -> DataFrame:
    """Rows (or their weight) per pair of label and prediction, both as they are.

    Every pair of ``classes`` is there, and every other pair that occurs. Labels keep their type (a
    prediction may have another); -0.0 counts as 0.0, and NaN as missing.
    """
    require(df, [label, prediction])
    w = F.col(weight) if weight else F.lit(1)
    pair = {}
    for name, source in (("label", label), ("prediction", prediction)):
        value = known(df, source)
        pair[name] = value + F.lit(0.0) if isinstance(type_of(df, source), FRACTIONAL) else value
    pairs = df.select(*[v.alias(n) for n, v in pair.items()], w.alias("_w")).dropna(subset=["label", "prediction"])
    counts = pairs.groupBy("label", "prediction").agg(F.sum("_w").alias("n"))
    wanted = df.sparkSession.createDataFrame([(a, b) for a in classes for b in classes], ["_label", "_prediction"])
    wanted = wanted.select(*[F.col(f"_{n}").cast(counts.schema[n].dataType).alias(n) for n in ("label", "prediction")])
    # an outer join of two small tables: one row per pair of classes
    whole = wanted.join(counts, ["label", "prediction"], "full")
    return whole.withColumn("n", F.coalesce("n", F.lit(0)))


def threshold_counts(
    df: DataFrame, label: str, score: str, bins: int | None = None, weight: str | None = None
) -> DataFrame:
    """(threshold, pos, neg, tp, fp, all_pos, all_neg) per distinct score.

    tp and fp count what is scored at or above the threshold. The rows are first
    combined per score. With ``bins``, scores in [0, 1] are cut down to that many
    steps, and the running sum is over at most bins + 1 rows.
    """
    require(df, [label, score])
    step = F.col(score)
    if bins is not None:
        # scores outside [0, 1] go to the first or last step, so there are bins + 1 rows at most
        step = F.floor(F.least(F.greatest(step, F.lit(0.0)), F.lit(1.0)) * bins) / F.lit(float(bins))
    w = F.col(weight) if weight else F.lit(1)
    both = F.col(label).isNotNull() & F.col(score).isNotNull()
    per_score = (
        df.where(both)
        .groupBy(step.alias("threshold"))
        .agg(_sum_if(F.col(label) == 1, w).alias("pos"), _sum_if(F.col(label) != 1, w).alias("neg"))
    )
    if bins is None:
        totals = {"all_pos": "pos", "all_neg": "neg"}
        return running_sums(per_score, [F.desc("threshold")], {"tp": "pos", "fp": "neg"}, totals=totals)
    window = W.partitionBy().orderBy(F.desc("threshold")).rowsBetween(W.unboundedPreceding, 0)
    whole = W.partitionBy()
    return per_score.withColumns(
        {
            "tp": F.sum("pos").over(window),
            "fp": F.sum("neg").over(window),
            "all_pos": F.sum("pos").over(whole),
            "all_neg": F.sum("neg").over(whole),
        }
    )


def roc_curve(df: DataFrame, label: str, score: str, bins: int | None = None, weight: str | None = None) -> DataFrame:
    """(threshold, fpr, tpr) per distinct score, from high to low; the point (0, 0) is left implicit."""
    counts = threshold_counts(df, label, score, bins, weight)
    return counts.select(
        "threshold",
        ratio(F.col("fp"), F.col("all_neg")).alias("fpr"),
        ratio(F.col("tp"), F.col("all_pos")).alias("tpr"),
    )


def pr_curve(df: DataFrame, label: str, score: str, bins: int | None = None, weight: str | None = None) -> DataFrame:
    """(threshold, precision, recall) per distinct score."""
    counts = threshold_counts(df, label, score, bins, weight)
    return counts.select(
        "threshold",
        ratio(F.col("tp"), F.col("tp") + F.col("fp")).alias("precision"),
        ratio(F.col("tp"), F.col("all_pos")).alias("recall"),
    )


def areas(df: DataFrame, label: str, score: str, bins: int | None = None, weight: str | None = None) -> DataFrame:
    """One row: area under the ROC curve (trapezoids) and average precision (steps).

    Both are sums of one term per distinct score that needs no neighbour: the point
    before is the running sum less the score's own counts. Null without both classes.
    """
    counts = threshold_counts(df, label, score, bins, weight)
    tp, fp, pos, neg = (F.col(c).cast("double") for c in ("tp", "fp", "pos", "neg"))
    sums = counts.agg(
        F.sum("pos").alias("_pos"),
        F.sum("neg").alias("_neg"),
        F.sum(neg * (tp - pos / 2)).alias("_roc"),
        F.sum(pos * tp / (tp + fp)).alias("_pr"),
    )
    return sums.select(
        F.try_divide(F.col("_roc"), F.col("_pos").cast("double") * F.col("_neg")).alias("roc_auc"),
        F.try_divide(F.col("_pr"), F.col("_pos").cast("double")).alias("average_precision"),
    )
