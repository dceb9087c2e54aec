"""Filling missing values and standardising numbers.

Statistics are fitted in one aggregate and kept as plain numbers, one per column,
so applying them is a projection.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskflow.functions.columns import known, quoted, require, type_of
from riskflow.operators.encoding import long_values
from riskflow.operators.profiling import quantiles, quantiles_of, type_is_numeric, value_frequencies
from riskflow.plans.lookup import lookup_join
from riskflow.plans.shared import materialize

STRATEGIES = ("mean", "median", "mode", "literal")


def fit_impute(df: DataFrame, cols: Sequence[str], strategy: str = "mean") -> dict[str, object]:
    """Fill value per column: mean, exact median, or most common value (ties: the smallest)."""
    require(df, cols)
    if strategy in ("mean", "median"):
        _need_numbers(df, cols, strategy)
    if strategy == "mean":
        row = df.agg(*[F.avg(known(df, c)).cast("double").alias(f"_{i}") for i, c in enumerate(cols)]).first()
        fills = {c: row[f"_{i}"] for i, c in enumerate(cols)}
    elif strategy == "median":
        rows = quantiles(df, cols, [0.5]).collect()
        fills = {r["column"]: r["value"] for r in rows}
    elif strategy == "mode":
        long, families, order = long_values(df, cols)
        counts = long.groupBy("column", *order).agg(F.count(F.lit(1)).alias("n"))
        fills = _modes(counts, cols, families)
    else:
        raise ValueError(f"strategy must be one of {', '.join(STRATEGIES)}, not {strategy!r}")
    _need_fills(cols, fills)
    return fills


def _need_numbers(df: DataFrame, cols: Sequence[str], strategy: str) -> None:
    text = [c for c in cols if not type_is_numeric(df, c)]
    if text:
        raise ValueError(f"{strategy} needs numbers; {', '.join(text)} hold none")


def _need_fills(cols: Sequence[str], fills: Mapping[str, object]) -> None:
    empty = [c for c in cols if fills.get(c) is None]
    if empty:
        raise ValueError(f"no value to impute from in {', '.join(empty)}")


def _mode_of(column: str, family: str) -> Column:
    """Value of a column with the most rows among (column, value, n), the smallest one on a tie."""
    value = F.col(family)
    # smallest (-n, value): most rows, then the smallest value
    counted = F.struct((-F.col("n")).alias("n"), value.alias("value"))
    return F.min(F.when((F.col("column") == column) & value.isNotNull(), counted))["value"]


def _modes(counts: DataFrame, cols: Sequence[str], families: Mapping[str, str]) -> dict[str, object]:
    """Most common value of each column, all from one aggregate."""
    row = counts.agg(*[_mode_of(c, families[c]).alias(f"_{i}") for i, c in enumerate(cols)]).first()
    return {c: row[f"_{i}"] for i, c in enumerate(cols)}


def apply_impute(df: DataFrame, fills: Mapping[str, object]) -> DataFrame:
    """Fill missing values; a fractional fill turns an integer column into doubles."""
    filled = {}
    for c, value in fills.items():
        filled[c] = F.coalesce(known(df, c), F.lit(value))
    return df.withColumns(filled)


def impute(
    df: DataFrame,
    cols: Sequence[str],
    strategy: str = "mean",
    by: Sequence[str] | None = None,
    value: object = None,
) -> DataFrame:
    """Fill missing values by a statistic of the column, of the row's group (``by``), or a literal.

    A group without values, and a row whose group is null, takes the statistic of the whole column.
    """
    require(df, [*cols, *(by or [])])
    if strategy == "literal":
        if value is None:
            raise ValueError("a literal strategy needs a value")
        return apply_impute(df, {c: value for c in cols})
    if not by:
        return apply_impute(df, fit_impute(df, cols, strategy))
    stats, fills = _fit_by_group(df, list(cols), strategy, list(by))
    joined = lookup_join(
        df, stats, [(g, f"_by_{g}") for g in by], [f"_fill_{c}" for c in cols], weight="_group_rows"
    )
    own = {c: F.coalesce(known(df, c), F.col(quoted(f"_fill_{c}"))) for c in cols}
    return apply_impute(joined.withColumns(own).drop(*[f"_fill_{c}" for c in cols]), fills)


def _fit_by_group(df: DataFrame, cols: list[str], strategy: str, by: list[str]) -> tuple[DataFrame, dict]:
    """Stored fills per group, and those of whole columns, both from one scan of the data."""
    if strategy in ("mean", "median"):
        _need_numbers(df, cols, strategy)
    if strategy == "mean":
        sums = [F.sum(known(df, c).cast("double")).alias(f"_sum_{c}") for c in cols]
        counts = [F.count(known(df, c)).alias(f"_count_{c}") for c in cols]
        stored = materialize(df.groupBy(*by).agg(F.count(F.lit(1)).alias("_group_rows"), *sums, *counts), "groups")
        mean = {c: F.try_divide(F.col(f"_sum_{c}"), F.col(f"_count_{c}")).alias(f"_fill_{c}") for c in cols}
        stats = stored.select(*by, "_group_rows", *mean.values())
        row = stored.agg(
            *[F.try_divide(F.sum(f"_sum_{c}"), F.sum(f"_count_{c}")).alias(f"_{i}") for i, c in enumerate(cols)]
        ).first()
        fills = {c: row[f"_{i}"] for i, c in enumerate(cols)}
    elif strategy == "median":
        stored = materialize(value_frequencies(df, cols, by, missing=True), "frequencies")
        present = stored.where(F.col("value").isNotNull())
        medians = quantiles_of(present, [0.5], by)
        rows = stored.where(F.col("column") == cols[0]).groupBy(*by).agg(F.sum("n").alias("_group_rows"))
        per_column = [F.max(F.when(F.col("column") == c, F.col("value"))).alias(f"_fill_{c}") for c in cols]
        stats = rows.join(medians.groupBy(*by).agg(*per_column), by, "left")
        overall = present.groupBy("column", "value").agg(F.sum("n").alias("n"))
        found = quantiles_of(overall, [0.5]).collect()  # one row per column
        fills = {r["column"]: r["value"] for r in found}
    elif strategy == "mode":
        long, families, order = long_values(df, cols, missing=True, keep=by)
        counted = long.groupBy(*by, "column", *order).agg(F.count(F.lit(1)).alias("n"))
        stored = materialize(counted, "frequencies")
        rows = F.sum(F.when(F.col("column") == cols[0], F.col("n"))).alias("_group_rows")
        stats = stored.groupBy(*by).agg(rows, *[_mode_of(c, families[c]).cast(type_of(df, c)).alias(f"_fill_{c}") for c in cols])
        overall = stored.groupBy("column", *order).agg(F.sum("n").alias("n"))
        fills = _modes(overall, cols, families)
    else:
        raise ValueError(f"strategy must be one of {', '.join(STRATEGIES)}, not {strategy!r}")
    _need_fills(cols, fills)
    return materialize(stats.withColumnsRenamed({g: f"_by_{g}" for g in by}), "groups"), fills


def fit_standardize(df: DataFrame, cols: Sequence[str], ddof: int = 0) -> dict[str, tuple[float, float]]:
    """(mean, standard deviation) per column; a column without spread gets 1."""
    require(df, cols)
    spread = F.stddev_pop if ddof == 0 else F.stddev_samp
    aggs = []
    for i, c in enumerate(cols):
        value = known(df, c).cast("double")
        aggs += [F.avg(value).alias(f"m{i}"), spread(value).alias(f"s{i}")]
    row = df.agg(*aggs).first()
    fitted = {}
    for i, c in enumerate(cols):
        if row[f"m{i}"] is None:
            raise ValueError(f"no value to standardise {c} by")
        fitted[c] = (row[f"m{i}"], row[f"s{i}"] or 1.0)
    return fitted


def apply_standardize(df: DataFrame, fitted: Mapping[str, tuple[float, float]]) -> DataFrame:
    require(df, list(fitted))
    return df.withColumns(
        {c: (known(df, c).cast("double") - F.lit(mean)) / F.lit(std) for c, (mean, std) in fitted.items()}
    )


def standardize(df: DataFrame, cols: Sequence[str], ddof: int = 0) -> DataFrame:
    """(x - mean) / std, by default with the population standard deviation."""
    return apply_standardize(df, fit_standardize(df, cols, ddof))


def as_double(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    return df.withColumns({c: F.col(quoted(c)).cast("double") for c in cols if type_of(df, c).typeName() != "double"})
