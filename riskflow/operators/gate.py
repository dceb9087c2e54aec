"""Checks a model version has to pass, and the decision made from them.

Checks are rows (version, check, value, detail). Values: ``1``/``0``, or
``pass``/``fail``/``none`` for the slice test.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.ml import PipelineModel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskflow.functions.columns import count_if, quoted, ratio, require
from riskflow.operators.profiling import sliced_accuracy
from riskflow.operators.scoring import check_signature, score
from riskflow.plans.shared import materialize

CHECK_SCHEMA = "version string, check string, value string, detail string"
CHECKS = ("has_description", "has_signature", "predicts", "slice_test")
MIN_DESCRIPTION = 21
SLICE_THRESHOLD = 0.55
FAILED = ("0", "fail")


def check_row(version: str | Column, check: str, value: Column, detail: Column) -> list[Column]:
    v = F.lit(version) if isinstance(version, str) else version
    return [v.alias("version"), F.lit(check).alias("check"), value.alias("value"), detail.alias("detail")]


def flag(ok: Column) -> Column:
    return F.when(ok, F.lit("1")).otherwise(F.lit("0"))


def check_predicts(model: PipelineModel, df: DataFrame) -> tuple[bool, str]:
    """Whether the model gives every row a prediction; the error text when it cannot."""
    try:
        row = score(model, df).agg(F.count(F.lit(1)).alias("rows"), F.count("prediction").alias("scored")).first()
    except (PySparkException, Py4JJavaError, ValueError) as error:
        return False, str(error)
    return row["rows"] == row["scored"], f"{row['scored']} of {row['rows']} rows scored"


def predicts_check(version: str, model: PipelineModel, df: DataFrame) -> DataFrame:
    ok, detail = check_predicts(model, df)
    return df.sparkSession.createDataFrame([(version, "predicts", "1" if ok else "0", detail)], CHECK_SCHEMA)


def signature_check(version: str, df: DataFrame, schema: T.StructType | None) -> DataFrame:
    """0 without a signature, or when the table does not fit it."""
    if not schema:
        return df.sparkSession.createDataFrame([(version, "has_signature", "0", "no signature")], CHECK_SCHEMA)
    found = check_signature(df, schema)
    bad = count_if(~F.col("ok"))
    detail = F.concat(bad.cast("string"), F.lit(" inputs do not fit"))
    return found.agg(bad.alias("_bad"), detail.alias("_detail")).select(
        *check_row(version, "has_signature", flag(F.col("_bad") == 0), F.col("_detail"))
    )


def description_check(spark: SparkSession, version: str, description: str | None, min_len: int = MIN_DESCRIPTION) -> DataFrame:
    rows = spark.createDataFrame([(version, description)], "version string, description string")
    return description_checks(rows, min_len)


def description_checks(versions: DataFrame, min_len: int = MIN_DESCRIPTION) -> DataFrame:
    """One check per row (version, description): is the description long enough."""
    length = F.coalesce(F.length("description"), F.lit(0))
    return versions.select(
        *check_row(
            F.col("version"),
            "has_description",
            flag(length >= min_len),
            F.concat(length.cast("string"), F.lit(" characters")),
        )
    )


def slice_gate(
    slices: DataFrame | None,
    threshold: float = SLICE_THRESHOLD,
    mode: str = "strict",
    spark: SparkSession | None = None,
) -> DataFrame:
    """One row (result, worst, best, n_slices).

    ``strict`` wants every slice at or above the threshold, ``compat`` any slice above 0.
    Without slices the result is ``none``.
    """
    if mode not in ("strict", "compat"):
        raise ValueError(f"mode must be strict or compat, not {mode!r}")
    schema = "result string, worst double, best double, n_slices bigint"
    if slices is None:
        return (spark or SparkSession.active()).createDataFrame([("none", None, None, 0)], schema)
    found = slices.agg(
        F.min("pct_acc").alias("worst"), F.max("pct_acc").alias("best"), F.count(F.lit(1)).alias("n_slices")
    )
    passes = F.col("worst") >= threshold if mode == "strict" else F.col("best") > 0
    result = F.when(F.col("n_slices") == 0, F.lit("none")).when(passes, F.lit("pass")).otherwise(F.lit("fail"))
    return found.select(result.alias("result"), "worst", "best", "n_slices")


def slice_check(
    version: str,
    scored: DataFrame,
    slice_cols: str | Sequence[str] | None,
    label: str,
    prediction: str = "prediction",
    threshold: float = SLICE_THRESHOLD,
    mode: str = "strict",
    min_obs: int = 0,
) -> DataFrame:
    slices = sliced_accuracy(scored, slice_cols, label, prediction, min_obs) if slice_cols else None
    gate = slice_gate(slices, threshold, mode, scored.sparkSession)
    detail = F.concat(F.col("n_slices").cast("string"), F.lit(" slices"))
    return gate.select(*check_row(version, "slice_test", F.col("result"), detail))


def run_checks(
    version: str,
    model: PipelineModel,
    features: DataFrame,
    schema: T.StructType | None,
    label: str,
    slice_cols: str | Sequence[str] | None,
    description: str | None,
    threshold: float = SLICE_THRESHOLD,
    mode: str = "strict",
    min_obs: int = 0,
) -> DataFrame:
    """All checks of one version. A model that cannot score the table fails the slice test too.

    The table is scored once: rows, predictions and right predictions per slice are counted and
    stored, and both the predictions and the slices are judged from that.
    """
    spark = features.sparkSession
    names = [c.strip() for c in slice_cols.split(",")] if isinstance(slice_cols, str) else list(slice_cols or [])
    try:
        require(features, [label, *names])
        counted = score(model, features, "_prediction").groupBy(*map(quoted, names)).agg(
            F.count(F.lit(1)).alias("obs"),
            F.count("_prediction").alias("_scored"),
            count_if(F.col(quoted(label)) == F.col("_prediction")).alias("acc"),
        )
        slices = materialize(counted.withColumn("pct_acc", ratio(F.col("acc"), F.col("obs"))), "slices")
        row = slices.agg(F.coalesce(F.sum("obs"), F.lit(0)).alias("rows"), F.coalesce(F.sum("_scored"), F.lit(0)).alias("scored")).first()
        ok, detail = row["rows"] == row["scored"], f"{row['scored']} of {row['rows']} rows scored"
    except (PySparkException, Py4JJavaError, ValueError) as error:
        ok, detail, slices = False, str(error), None
    predicts = spark.createDataFrame([(version, "predicts", "1" if ok else "0", detail)], CHECK_SCHEMA)
    if ok:
        wanted = slices.where(F.col("obs") >= min_obs) if names else None
        gate = slice_gate(wanted, threshold, mode, spark)
        judged = gate.select(
            *check_row(version, "slice_test", F.col("result"), F.concat(F.col("n_slices").cast("string"), F.lit(" slices")))
        )
    else:
        judged = spark.createDataFrame([(version, "slice_test", "fail", "no predictions")], CHECK_SCHEMA)
    parts = [
        signature_check(version, features, schema),
        predicts,
        judged,
        description_check(spark, version, description),
    ]
    return reduce(lambda a, b: a.unionByName(b), parts)


def checks_wide(checks: DataFrame, names: Sequence[str] | None = None) -> DataFrame:
    """One row per version, one column per check: the known ones, then all others found."""
    if names is None:
        found = sorted(r["check"] for r in checks.select("check").distinct().collect())
        names = [*CHECKS, *(c for c in found if c not in CHECKS)]
    return checks.groupBy("version").pivot("check", list(names)).agg(F.first("value"))


def decide(checks: DataFrame) -> DataFrame:
    """accept or reject per version; a check without a value fails, ``none`` does not."""
    passed = F.coalesce(~F.col("value").isin(*FAILED), F.lit(False))
    return checks.groupBy("version").agg(
        F.when(F.bool_and(passed), F.lit("accept")).otherwise(F.lit("reject")).alias("decision"),
        count_if(~passed).alias("n_failed"),
    )


def quality_gate(df: DataFrame, rules: Mapping[str, Column | str]) -> DataFrame:
    """Per rule: rows that break it or leave it unknown. One pass for all rules."""
    names = list(rules)
    conditions = [F.expr(r) if isinstance(r, str) else r for r in rules.values()]
    counts = df.agg(
        F.count(F.lit(1)).alias("_rows"),
        *[count_if(~F.coalesce(c, F.lit(False))).alias(f"_{i}") for i, c in enumerate(conditions)],
    )
    entries = [
        F.struct(
            F.lit(name).alias("rule"),
            F.col("_rows").alias("n_rows"),
            F.col(f"_{i}").alias("n_failed"),
            (F.col(f"_{i}") == 0).alias("ok"),
        )
        for i, name in enumerate(names)
    ]
    return counts.select(F.explode(F.array(*entries)).alias("_e")).select("_e.*")
