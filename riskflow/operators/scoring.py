"""Batch scoring, stored models and the input contract."""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskflow.functions.columns import is_missing, count_if, linear, logistic, quoted, require
from riskflow.sources.tables import read_table, write_table


def score(model: PipelineModel, df: DataFrame, out: str = "prediction") -> DataFrame:
    """All columns of the input and the prediction. The work stays in the JVM."""
    predicted = model.transform(df)
    return predicted.select(*[F.col(quoted(c)) for c in df.columns if c != out], F.col("prediction").alias(out))


def score_fixed(
    df: DataFrame,
    intercept: float,
    coefficients: Mapping[str, float],
    out: str = "score",
    threshold: float = 0.5,
    prediction: str = "prediction",
    digits: int = 6,
) -> DataFrame:
    """A logistic model with given coefficients, as a column expression."""
    require(df, list(coefficients))
    scored = df.withColumn(out, F.round(logistic(linear(intercept, dict(coefficients))), digits))
    return scored.withColumn(prediction, F.when(F.col(out) >= threshold, F.lit(1)).when(F.col(out).isNotNull(), F.lit(0)))


def score_to_table(
    model: PipelineModel, df: DataFrame, key: str, target: str, out: str = "prediction"
) -> DataFrame:
    """Write all columns with the prediction; returns (key, prediction) as written."""
    scored = score(model, df, out)
    write_table(scored, target)
    return read_table(df.sparkSession, target).select(key, out)


def signature(df: DataFrame, cols: Sequence[str]) -> T.StructType:
    """Named, typed inputs of a model."""
    require(df, cols)
    return T.StructType([df.schema[c] for c in cols])


def save_model(model: PipelineModel, schema: T.StructType, path: str) -> None:
    """Keep a model and its signature side by side."""
    model.write().overwrite().save(f"{path}/model")
    spark = SparkSession.active()
    spark.createDataFrame([(schema.json(),)], "value string").coalesce(1).write.mode("overwrite").text(f"{path}/signature")


def load_model(path: str) -> tuple[PipelineModel, T.StructType]:
    model = PipelineModel.load(f"{path}/model")
    text = SparkSession.active().read.text(f"{path}/signature").first()["value"]
    return model, T.StructType.fromJson(json.loads(text))


def check_signature(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Per expected input: missing values, values the type cannot hold unchanged, and whether it can be used.

    One pass over the table. An absent column is not ok and has no counts; columns
    that are not in the signature are ignored.
    """
    present = [f for f in schema if f.name in df.columns]
    aggs = [F.count(F.lit(1)).alias("_rows")]
    for i, f in enumerate(present):
        value = F.col(quoted(f.name))
        aggs.append(count_if(is_missing(df, f.name)).alias(f"null{i}"))
        if df.schema[f.name].dataType == f.dataType:
            aggs.append(F.lit(0).cast("bigint").alias(f"bad{i}"))
        else:
            there = value.try_cast(f.dataType)
            bad = there.isNull()
            if not isinstance(df.schema[f.name].dataType, T.StringType):
                bad = bad | ~there.try_cast(df.schema[f.name].dataType).eqNullSafe(value)
            aggs.append(count_if(~is_missing(df, f.name) & bad).alias(f"bad{i}"))
    counts = df.agg(*aggs)
    position = {f.name: i for i, f in enumerate(present)}
    none = F.lit(None).cast("bigint")
    entries = []
    for f in schema:
        i = position.get(f.name)
        n_null, n_bad = (none, none) if i is None else (F.col(f"null{i}"), F.col(f"bad{i}"))
        entries.append(
            F.struct(
                F.lit(f.name).alias("column"),
                F.lit(f.dataType.simpleString()).alias("expected"),
                n_null.alias("n_null"),
                n_bad.alias("n_bad"),
                (F.lit(False) if i is None else (n_bad == 0)).alias("ok"),
            )
        )
    return counts.select(F.explode(F.array(*entries)).alias("_e")).select("_e.*")
