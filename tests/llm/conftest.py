from __future__ import annotations

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

DOCUMENT = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("lang", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("n_chars", T.LongType()),
    ]
)
LONG = " ".join(f"word{i % 977}x{i}" for i in range(60_000))
PLAIN = "the quick brown fox jumps over the lazy dog while seven other animals look on from the old stone wall"
ROWS = [
    (1, PLAIN, "en", "a", 10),
    (2, PLAIN.replace(" ", "\t \n"), "en", None, None),
    (3, None, None, "b", 0),
    (4, "", "fr", "b", 0),
    (5, " \n\t ", "fr", "b", 3),
    (6, "one", "de", "c", 3),
    (6, "one", "de", "c", 3),
    (None, "one", "de", "c", 3),
    (None, None, None, None, None),
    (7, LONG, "en", "a", len(LONG)),
    (8, "you idiot " + PLAIN, "en", "a", 20),
    (9, "é" * 400 + "　 ß\x85x <|endoftext|> \U0001f600", "fr", "d", 1),
]


@pytest.fixture(scope="session")
def odd_documents(spark):
    """Nulls, blanks, a long text, repeated rows and columns whose names clash with what operators add."""
    df = spark.createDataFrame(ROWS, DOCUMENT)
    clash = ["kept", "key", "print", "score", "part", "n", "size", "target", "digest", "component_id", "batch", "item_id"]
    return df.withColumns({c: F.lit(-1) for c in clash})


@pytest.fixture(scope="session")
def no_documents(spark):
    return spark.createDataFrame([], DOCUMENT)


@pytest.fixture(scope="session")
def texts(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/documents.parquet")
