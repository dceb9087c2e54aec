"""Folds that keep groups together, and cross-validated metrics."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskflow.functions.columns import key_hash, quoted, require
from riskflow.operators.evaluation import evaluate
from riskflow.operators.training import FeatureSpec, fit_pipeline
from riskflow.plans.lookup import lookup_join
from riskflow.plans.ordering import running_sums
from riskflow.plans.shared import materialize


def with_folds(df: DataFrame, group: str, k: int = 5, seed: int = 0, out: str = "fold") -> DataFrame:
    """Add a fold 0..k-1; all rows of a group share it, and folds hold about the same number of rows.

    Groups stand in the order of their hashed key. A group goes to the fold in whose k-th of all rows
    its middle lies, so folds differ by at most the size of the groups at their ends. Rows are counted
    per group and positions are running sums over the groups, in ranges, so no task sees all
    groups. Rows without a group have no fold.
    """
    require(df, [group])
    if k < 1:
        raise ValueError(f"k must be at least 1, not {k}")
    key = F.col(quoted(group))
    sizes = df.where(key.isNotNull()).groupBy(key.alias("_group")).agg(F.count(F.lit(1)).alias("_n"))
    placed = running_sums(
        sizes.withColumn("_hash", key_hash(F.col("_group"), seed)), ["_hash", "_group"], {"_upto": "_n"}, totals={"_all": "_n"}
    )
    middle = 2 * F.col("_upto") - F.col("_n")
    fold = F.least(F.floor(F.lit(k) * middle / (2 * F.col("_all"))), F.lit(k - 1)).cast("int")
    table = materialize(placed.select("_group", "_n", fold.alias(out)), "folds")
    return lookup_join(df, table, [(group, "_group")], [out], weight="_n")


def cross_validate(
    df: DataFrame,
    label: str,
    spec: FeatureSpec,
    group: str,
    k: int = 5,
    seed: int = 0,
    fit: Callable[[DataFrame], PipelineModel] | None = None,
) -> DataFrame:
    """(fold, tp, fp, tn, fn, n, metrics): each fold measured by a model of all others.

    By default the model is the balanced logistic one. Rows are given their folds once, in a stored
    table that all fits read; k models are trained one after the other.
    """
    require(df, [label, *spec.columns()])
    known = df.where(F.col(quoted(label)).isNotNull()).withColumn(label, F.col(quoted(label)).cast("double"))
    stored = materialize(with_folds(known, group, k, seed).where("fold is not null"), "folds")
    train = fit or (lambda rows: fit_pipeline(rows, spec, label, C=1.0, balance=True))
    parts = []
    for fold in range(k):
        held = F.col("fold") == fold
        model = train(stored.where(~held))
        parts.append(evaluate(model.transform(stored.where(held)), label, "prediction", by="fold"))
    return materialize(reduce(DataFrame.unionByName, parts), "cross_validated")
