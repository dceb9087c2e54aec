"""How far one column tells another: conditional entropy and Cramér's V from contingency counts.

All pairs of columns are counted in one aggregate of (pair, value, value) cells, which
combines on the map side. Entropies are sums of n * ln(n) over cells and margins and need no
join; Cramér's V needs the margin of one side beside each cell, which is looked up.
"""

from __future__ import annotations

from collections.abc import Sequence
from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskflow.functions.columns import known, ratio, require
from riskflow.plans.lookup import lookup_join
from riskflow.plans.shared import materialize


def _text(df: DataFrame, name: str) -> Column:
    """A value as text that no other value has, missing ones included."""
    return F.coalesce(F.concat(F.lit("="), known(df, name).cast("string")), F.lit(""))


def _n_log_n(n: Column) -> Column:
    return F.sum(n.cast("double") * F.ln(n.cast("double")))


def association(df: DataFrame, pairs: Sequence[tuple[str, str]], digits: int = 6) -> DataFrame:
    """One row per pair (source, target): what knowing the source leaves open of the target.

    ``entropy`` of the target and ``conditional_entropy`` given the source are in nats;
    ``explained`` is the share of the entropy that is gone, 1 where the source gives the target
    away, null for a constant target. ``cramers_v`` is symmetric, null where either is constant.
    A missing value counts as a value of its own. No rows, no lines.
    """
    names = list(dict.fromkeys(c for pair in pairs for c in pair))
    require(df, names)
    entries = [
        F.struct(F.lit(i).alias("pair"), _text(df, a).alias("source_value"), _text(df, b).alias("target_value"))
        for i, (a, b) in enumerate(pairs)
    ]
    long = df.select(F.explode(F.array(*entries)).alias("_cell")).select("_cell.*")
    counts = long.groupBy("pair", "source_value", "target_value").agg(F.count(F.lit(1)).alias("n"))
    cells = materialize(counts, "cells")
    targets = materialize(cells.groupBy("pair", "target_value").agg(F.sum("n").alias("target_n")), "margins")
    # one of the margins is enough: the other is the group the cells are summed in
    beside = lookup_join(cells, targets, [("pair", "pair"), ("target_value", "target_value")], ["target_n"])
    n = F.col("n").cast("double")
    sources = beside.groupBy("pair", "source_value").agg(
        F.sum("n").alias("source_n"),
        _n_log_n(F.col("n")).alias("_cells"),
        F.sum(n * n / F.col("target_n")).alias("_squares"),
    )
    by_source = sources.groupBy("pair").agg(
        F.sum("source_n").alias("n"),
        F.count(F.lit(1)).alias("n_source"),
        F.sum("_cells").alias("_cells"),
        _n_log_n(F.col("source_n")).alias("_sources"),
        F.sum(F.col("_squares") / F.col("source_n")).alias("_phi"),
    )
    by_target = targets.groupBy("pair").agg(F.count(F.lit(1)).alias("n_target"), _n_log_n(F.col("target_n")).alias("_targets"))
    # one row per pair on both sides
    joined = by_source.join(F.broadcast(by_target), "pair")
    total = F.col("n").cast("double")
    entropy = F.greatest(F.ln(total) - F.col("_targets") / total, F.lit(0.0))
    left = F.greatest((F.col("_sources") - F.col("_cells")) / total, F.lit(0.0))
    smaller = F.least("n_source", "n_target") - 1
    v = F.sqrt(F.greatest(F.try_divide(F.col("_phi") - 1, smaller.cast("double")), F.lit(0.0)))
    label = F.array(*[F.struct(F.lit(a).alias("source"), F.lit(b).alias("target")) for a, b in pairs])[F.col("pair")]
    return joined.select(
        label["source"].alias("source"),
        label["target"].alias("target"),
        "n",
        "n_source",
        "n_target",
        F.round(entropy, digits).alias("entropy"),
        F.round(left, digits).alias("conditional_entropy"),
        F.when(F.col("n_target") > 1, F.round(1 - ratio(left, entropy), digits)).alias("explained"),
        F.when(smaller > 0, F.round(v, digits)).alias("cramers_v"),
    )


def association_with(df: DataFrame, label: str, cols: Sequence[str] | None = None) -> DataFrame:
    """association() of every column with the label."""
    names = [c for c in (cols or df.columns) if c != label]
    return association(df, [(c, label) for c in names])


def association_matrix(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """association() of every two columns, each pair once; a row becomes one cell per pair before it is counted."""
    return association(df, list(combinations(cols, 2)))
