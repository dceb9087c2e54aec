"""The run log: one row per training run, in a folder whose columns may grow."""

from __future__ import annotations

import math
from collections.abc import Callable, Mapping, Sequence
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskflow.functions.columns import FRACTIONAL, quoted, require, type_of
from riskflow.sources.tables import append_versioned, current_version, delete_where, read_versioned

BASE_FIELDS = [T.StructField("name", T.StringType()), T.StructField("date", T.TimestampType())]


def _field(name: str, value: object) -> T.StructField:
    if isinstance(value, bool):
        return T.StructField(name, T.BooleanType())
    if isinstance(value, (int, float)):  # a metric may be 1 in one run and 0.5 in the next
        return T.StructField(name, T.DoubleType())
    return T.StructField(name, T.StringType())


def log_run(spark: SparkSession, path: str, name: str, values: Mapping[str, object], date: datetime | None = None) -> None:
    """Append one run. Names that are new to the log become null in earlier rows."""
    moment = date or datetime.now(timezone.utc)
    known = {k: float(v) if isinstance(v, int) and not isinstance(v, bool) else v for k, v in values.items() if v is not None}
    schema = T.StructType([*BASE_FIELDS, *[_field(k, v) for k, v in known.items()]])
    append_versioned(spark.createDataFrame([(name, moment, *known.values())], schema), path)


def read_log(spark: SparkSession, path: str) -> DataFrame:
    """All runs, or an empty log when nothing has been written."""
    if current_version(spark, path) is None:
        return spark.createDataFrame([], T.StructType(BASE_FIELDS))
    return read_versioned(spark, path)


def latest_run(df: DataFrame, name: str, date: str = "date", name_col: str = "name", ties: str | None = None) -> DataFrame:
    """The newest run of a name, or no row."""
    order = [F.col(date).desc_nulls_last(), *([F.col(ties).asc()] if ties else [])]
    return df.where(F.col(name_col) == name).orderBy(*order).limit(1)


def latest_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The row with the highest order value per key. Rows without an order value do not count.

    An aggregate and not a window: tasks send on one row per key, however many rows
    the key has.
    """
    require(df, [*keys, *order])
    rest = [c for c in df.columns if c not in keys]
    ordered = df
    for c in order:
        ordered = ordered.where(F.col(quoted(c)).isNotNull())
    best = ordered.groupBy(*keys).agg(F.max_by(F.struct(*rest), F.struct(*order)).alias("_best"))
    return best.select(*keys, "_best.*").select(*df.columns)


def best_run(
    df: DataFrame, metric: str, status: str | None = "FINISHED", status_col: str = "status", ties: str = "run_id"
) -> DataFrame:
    """The run with the highest metric; runs without one (or with NaN) come last, ties by id."""
    require(df, [metric, ties])
    value = F.col(quoted(metric))
    if isinstance(type_of(df, metric), FRACTIONAL):
        value = F.when(~F.isnan(value), value)
    finished = df if status is None else df.where(F.col(status_col) == status)
    return finished.orderBy(value.desc_nulls_last(), F.col(ties).asc()).limit(1)


def reset_runs(spark: SparkSession, path: str, name: str) -> None:
    """Forget the runs of a name."""
    delete_where(spark, path, F.col("name") == name)


def get_or_train(
    spark: SparkSession,
    path: str,
    name: str,
    train: Callable[[], Mapping[str, object]],
    force: bool = False,
) -> DataFrame:
    """The latest run of a name; when there is none (or ``force``), train and log one first."""
    if force:
        reset_runs(spark, path, name)
    if not latest_run(read_log(spark, path), name).isEmpty():
        return latest_run(read_log(spark, path), name)
    values = {k: (None if isinstance(v, float) and math.isnan(v) else v) for k, v in train().items()}
    log_run(spark, path, name, values)
    return latest_run(read_log(spark, path), name)
