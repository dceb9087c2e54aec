"""Profiles that add up: one stored row per delivery and column, merged without reading the data again.

Counts, ranges and moments are exact; distinct counts come from HyperLogLog and quantiles
from KLL sketches, which unite without loss over what one sketch of all rows would give.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from riskflow.functions.columns import NUMERIC, count_if, is_missing, known, ratio, require, type_of
from riskflow.operators.runlog import latest_per_key
from riskflow.sources.tables import append_evolving, read_evolving

#: 2**HLL_BITS registers: a relative standard error of 1.04 / sqrt(registers), 1.6 % for 12.
HLL_BITS = 12
#: Size of a quantile sketch: with 800 the rank of a quantile is off by about 0.4 %.
KLL_SIZE = 800


def sketch(df: DataFrame, cols: Sequence[str] | None = None, by: str | Column = "all", moment: datetime | None = None) -> DataFrame:
    """One row (delivery, moment, column, ...) per delivery and column, from one scan of ``df``.

    ``by`` names the delivery of all rows, or is an expression that gives it for each. Numbers have
    ``min``, ``max``, ``mean``, ``m2`` (squares about the mean) and a quantile sketch, all columns text bounds and
    a distinct sketch. NaN counts as missing.
    """
    names = list(cols or df.columns)
    require(df, names)
    delivery = F.lit(by) if isinstance(by, str) else by
    aggs: list[Column] = []
    none = F.lit(None)
    for i, c in enumerate(names):
        value, text = known(df, c), known(df, c).cast("string")
        number = value.cast("double") if isinstance(type_of(df, c), NUMERIC) else None
        if number is not None:
            number = number + F.lit(0.0)  # -0.0 is 0.0
        fields = {
            "n": F.count(value),
            "n_null": count_if(is_missing(df, c)),
            "first_value": F.min(value).cast("string"),
            "last_value": F.max(value).cast("string"),
            "min": F.min(number) if number is not None else none.cast("double"),
            "max": F.max(number) if number is not None else none.cast("double"),
            "mean": F.avg(number) if number is not None else none.cast("double"),
            "m2": F.var_pop(number) * F.count(number) if number is not None else none.cast("double"),
            "distinct": F.hll_sketch_agg(text, HLL_BITS),
            "quantiles": F.kll_sketch_agg_double(number, F.lit(KLL_SIZE)) if number is not None else none.cast("binary"),
        }
        aggs.append(F.struct(F.lit(c).alias("column"), *[v.alias(k) for k, v in fields.items()]).alias(f"_{i}"))
    rows = df.groupBy(delivery.cast("string").alias("delivery")).agg(*aggs)
    long = rows.select("delivery", F.explode(F.array(*[f"_{i}" for i in range(len(names))])).alias("_row"))
    stamp = F.lit(moment or datetime.now(timezone.utc)).cast("timestamp")
    return long.select("delivery", stamp.alias("moment"), "_row.*")


def add_delivery(df: DataFrame, path: str, cols: Sequence[str] | None = None, by: str | Column = "all", moment: datetime | None = None) -> None:
    """Append the sketches of a delivery; one that is added again counts with its newest rows alone."""
    append_evolving(sketch(df, cols, by, moment).coalesce(1), path)


def read_deliveries(spark: SparkSession, path: str) -> DataFrame:
    return latest_per_key(read_evolving(spark, path), ["delivery", "column"], ["moment"])


def merged_profile(sketches: DataFrame, shares: Sequence[float] = (0.5,)) -> DataFrame:
    """One row per column over all deliveries, from the stored sketches alone.

    n, n_null, min, max, mean, std (sample) are those of the whole table; n_distinct and the quantiles
    carry the error of the sketches. Text columns have no numbers.
    """
    whole = sketches.groupBy("column").agg(
        F.sum("n").alias("n"),
        F.sum("n_null").alias("n_null"),
        F.count(F.lit(1)).alias("n_deliveries"),
        F.min("min").alias("min"),
        F.max("max").alias("max"),
        F.sum(F.col("n") * F.col("mean")).alias("_sum"),
        F.sum(F.when(F.col("mean").isNotNull(), F.col("n"))).alias("_numbers"),
        F.collect_list(F.when(F.col("n") > 0, F.struct("n", "mean", "m2"))).alias("_parts"),
        F.hll_sketch_estimate(F.hll_union_agg("distinct", F.lit(True))).alias("n_distinct"),
        F.kll_merge_agg_double(F.when(F.col("n") > 0, F.col("quantiles"))).alias("_quantiles"),
    )
    mean = F.try_divide(F.col("_sum"), F.col("_numbers").cast("double"))
    # squares about the common mean: those of each part, and of its mean
    squares = F.aggregate(
        "_parts", F.lit(0.0), lambda total, p: total + p["m2"] + p["n"] * (p["mean"] - F.col("mean")) * (p["mean"] - F.col("mean"))
    )
    found = whole.withColumn("mean", mean).withColumn("std", F.when(F.col("n") > 1, F.sqrt(squares / (F.col("n") - 1))))
    quantile = [
        F.when(F.col("_numbers") > 0, F.kll_sketch_get_quantile_double("_quantiles", F.lit(float(s)))).alias(f"p{s * 100:g}".replace(".", "_"))
        for s in shares
    ]
    return found.select(
        "column", "n", "n_null", "n_deliveries", "min", "max", "mean", "std", "n_distinct", *quantile
    )


def rank_errors(df: DataFrame, col: str, values: Sequence[tuple[float, float]]) -> DataFrame:
    """(share, value, error): how far each value's rank among the column's numbers is from the share.

    A value of many equal rows has a range of ranks; one that holds the share has no error.
    """
    number = known(df, col).cast("double")
    counts = df.agg(
        F.count(number).alias("_n"),
        *[F.struct(count_if(number < v).alias("below"), count_if(number <= v).alias("upto")).alias(f"_{i}") for i, (_, v) in enumerate(values)],
    )
    parts = []
    for i, (share, value) in enumerate(values):
        low, high = (ratio(F.col(f"_{i}.{end}"), F.col("_n")) for end in ("below", "upto"))
        error = F.greatest(low - F.lit(share), F.lit(share) - high, F.lit(0.0))
        parts.append(F.struct(F.lit(float(share)).alias("share"), F.lit(float(value)).alias("value"), error.alias("error")))
    return counts.select(F.explode(F.array(*parts)).alias("_e")).select("_e.*")
