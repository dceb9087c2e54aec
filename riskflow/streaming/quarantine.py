"""Scoring a stream whose rows may break the model's input contract.

Each batch is written to two tables: scored rows, and rows that break the contract with
the reason. A batch has a folder of its own in both, named by its number and written anew when
the batch runs again, so a restart after a failure between the two leaves each row once.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import PipelineModel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from riskflow.functions.columns import is_missing, quoted
from riskflow.operators.scoring import score

REASON = "contract_breach"


def contract_breaches(df: DataFrame, schema: T.StructType, required: Sequence[str] | None = None) -> Column:
    """What is wrong with a row, as text: null for a row that fits.

    A value breaks the contract when its type cannot hold it unchanged, or when it is missing in a
    ``required`` column (by default those that the schema says are not nullable).
    """
    must = set(required if required is not None else [f.name for f in schema if not f.nullable])
    found = []
    for f in schema:
        if f.name not in df.columns:
            found.append(F.lit(f"{f.name} is absent"))
            continue
        missing = is_missing(df, f.name)
        if f.name in must:
            found.append(F.when(missing, F.lit(f"{f.name} is missing")))
        own = df.schema[f.name].dataType
        if own != f.dataType:
            value = F.col(quoted(f.name))
            there = value.try_cast(f.dataType)
            bad = there.isNull()
            if not isinstance(own, T.StringType):
                bad = bad | ~there.try_cast(own).eqNullSafe(value)
            found.append(F.when(~missing & bad, F.lit(f"{f.name} is no {f.dataType.simpleString()}")))
    return F.nullif(F.concat_ws(", ", *found), F.lit("")) if found else F.lit(None).cast("string")


def split_by_contract(df: DataFrame, schema: T.StructType, required: Sequence[str] | None = None) -> tuple[DataFrame, DataFrame]:
    """(rows that fit, in the types of the contract; the others as they came, with the reason)."""
    judged = df.withColumn(REASON, contract_breaches(df, schema, required))
    kinds = {f.name: f.dataType for f in schema if f.name in df.columns}
    fitting = judged.where(F.col(REASON).isNull()).select(
        *[F.col(quoted(c)).try_cast(kinds[c]).alias(c) if c in kinds else F.col(quoted(c)) for c in df.columns]
    )
    return fitting, judged.where(F.col(REASON).isNotNull())


def score_or_set_aside(
    model: PipelineModel,
    rows: DataFrame,
    schema: T.StructType,
    sink: str,
    aside: str,
    checkpoint: str,
    out: str = "prediction",
    required: Sequence[str] | None = None,
    interval: str | None = None,
) -> StreamingQuery:
    """Score a stream into ``sink``, rows that break the contract into ``aside``, both with a column ``batch``.

    Without an interval the query works through all that is there and stops. Both tables are
    partitioned by ``batch``.
    """

    def write(batch: DataFrame, number: int) -> None:
        fitting, others = split_by_contract(batch, schema, required)
        score(model, fitting, out).write.mode("overwrite").parquet(f"{sink.rstrip('/')}/batch={number}")
        others.write.mode("overwrite").parquet(f"{aside.rstrip('/')}/batch={number}")

    writer = rows.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    writer = writer.trigger(processingTime=interval) if interval else writer.trigger(availableNow=True)
    return writer.start()

