"""Scoring new rows as files arrive. Stateless: each row is scored once, on its own."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from riskflow.operators.scoring import score


def read_arriving(
    spark: SparkSession, folder: str, schema: T.StructType, max_files: int | None = None, pattern: str | None = None
) -> DataFrame:
    """Parquet files of a folder as a stream; ``pattern`` limits it to matching file names."""
    reader = spark.readStream.schema(schema)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    if pattern:
        reader = reader.option("pathGlobFilter", pattern)
    return reader.parquet(folder)


def score_stream(
    model: PipelineModel,
    rows: DataFrame,
    sink: str,
    checkpoint: str,
    out: str = "prediction",
    interval: str | None = None,
) -> StreamingQuery:
    """Score a stream into a Parquet folder.

    Without an interval the query works through all files that are there and stops.
    Files and checkpoint together give each row exactly once, also after a restart.
    """
    scored = score(model, rows, out)
    writer = scored.writeStream.format("parquet").option("path", sink).option("checkpointLocation", checkpoint)
    writer = writer.trigger(processingTime=interval) if interval else writer.trigger(availableNow=True)
    return writer.outputMode("append").start()
