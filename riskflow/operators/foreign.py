"""Models that are no Spark models: a function on numpy columns, with its signature as contract.

The function is sent to the executors once and works on Arrow batches; rows stay where
they are. Inputs are cast to the types of the signature first, so the function sees the types it was
made for, whatever the table holds.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskflow.functions.columns import quoted, require

Predict = Callable[[dict[str, np.ndarray]], np.ndarray]


@dataclass(frozen=True)
class ForeignModel:
    """``predict`` takes the columns of ``schema`` by name and returns one number per row.

    Numbers come as arrays of their type; a column with missing values comes as doubles with NaN, text
    and other types as objects with None. NaN as a result means no prediction.
    """

    predict: Predict
    schema: T.StructType


def score_foreign(model: ForeignModel, df: DataFrame, out: str = "prediction") -> DataFrame:
    """All columns of ``df`` and the model's result as a double.

    An input whose value the signature's type cannot hold counts as missing; an absent one stops
    with its name. A column ``out`` of ``df`` is replaced.
    """
    names = [f.name for f in model.schema]
    require(df, names)
    kept = [c for c in df.columns if c != out]
    inputs = [F.col(quoted(f.name)).try_cast(f.dataType).alias(f"_in{i}") for i, f in enumerate(model.schema)]
    wide = df.select(*[quoted(c) for c in kept], *inputs)
    packed = df.sparkSession.sparkContext.broadcast(cloudpickle.dumps(model.predict))
    schema = T.StructType([*[df.schema[c] for c in kept], T.StructField(out, T.DoubleType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        predict = cloudpickle.loads(packed.value)
        for batch in batches:
            columns = {n: batch.column(len(kept) + i).to_numpy(zero_copy_only=False) for i, n in enumerate(names)}
            found = np.asarray(predict(columns), np.float64)
            if found.shape != (batch.num_rows,):
                raise ValueError(f"the model gave {found.shape} results for {batch.num_rows} rows")
            result = pa.array(found, mask=np.isnan(found))
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(kept)], result], names=[*kept, out])

    return wide.mapInArrow(run, schema)


def save_foreign(model: ForeignModel, path: str) -> None:
    """Keep function and signature as one row; whoever loads it runs its code."""
    row = (bytearray(cloudpickle.dumps(model.predict)), model.schema.json())
    spark = SparkSession.active()
    spark.createDataFrame([row], "predict binary, schema string").coalesce(1).write.mode("overwrite").parquet(path)


def load_foreign(spark: SparkSession, path: str) -> ForeignModel:
    row = spark.read.parquet(path).first()
    return ForeignModel(cloudpickle.loads(bytes(row["predict"])), T.StructType.fromJson(json.loads(row["schema"])))
