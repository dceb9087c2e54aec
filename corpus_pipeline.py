"""A corpus pipeline of five stages; each stage's rows are written and read by the next.

Every stage works on all rows its predecessor kept. The first four return the columns of
``documents`` and drop rows; the last returns one row for each time a document is read,
in training order, with the columns of ``documents`` and ``pass``, ``words``, ``position``.

A doc_id may be null or repeated, so no stage tells rows apart by it: stages one and four
look at each row by itself, and the others give each row a key of its own first.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskflow.llm.curriculum import mix_sources, readings
from riskflow.llm.decontaminate import drop_contaminated
from riskflow.llm.exact_dedup import exact_duplicates, split_deliveries
from riskflow.llm.grouping import join_groups, without_ids
from riskflow.llm.near_dedup import near_duplicates
from riskflow.llm.toxicity import drop_toxic
from riskflow.plans.shared import materialize

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


#: Names a row within a stage.
KEY = "_row_key"


#: A file has fewer rows than two to this power.
ROW_BITS = 40


def _is_plain_read(docs: DataFrame) -> bool:
    """Whether ``docs`` is a read of files and no more, as each stage's is."""
    node = docs._jdf.queryExecution().analyzed().nodeName()
    return node.startswith("LogicalRelation") and bool(docs.inputFiles()) and "_metadata" not in docs.columns


def _keyed(docs: DataFrame, label: str) -> DataFrame:
    """The rows with a unique key that is the same whenever they are read.

    Rows read from files have it from the number of their file and their place in it, and
    stay where they are. Others, and those of a file that is read twice, are stored with
    a key, as one worked out anew may differ.
    """
    if _is_plain_read(docs):
        placed = docs.select(
            "*", F.col("_metadata.file_path").alias("_file"), F.col("_metadata.row_index").alias("_place")
        )
        rows = placed.groupBy("_file").agg(F.count("*").alias("_rows"), F.max("_place").alias("_last"))
        # one row a file: coalesced so that the numbers are small
        files = materialize(rows.coalesce(1).withColumn("_number", F.monotonically_increasing_id()), f"{label}_files")
        if files.where("_rows > _last + 1").isEmpty():
            key = F.shiftleft("_number", ROW_BITS) + F.col("_place")
            numbered = placed.join(files.select("_file", "_number"), "_file")
            return numbered.withColumn(KEY, key).select(*docs.columns, KEY)
    return materialize(docs.withColumn(KEY, F.monotonically_increasing_id()), label)


def _by_key(keyed: DataFrame) -> DataFrame:
    """What the operators need, with the key for doc_id."""
    return keyed.select(F.col(KEY).alias("doc_id"), "text")


def _first_of_groups(keyed: DataFrame, groups: DataFrame, label: str) -> DataFrame:
    """Of the rows of each (KEY, group) the one with the smallest doc_id, null last; rows without a group stay."""
    named = materialize(groups.join(keyed.select(KEY, F.col("doc_id").cast("bigint").alias("id")), KEY), label)
    turn = F.struct(F.col("id").isNull().alias("none"), "id", KEY)
    first = named.groupBy("group").agg(F.count("*").alias("n_rows"), F.min(turn).getField(KEY).alias("first"))
    first = materialize(first.where("n_rows > 1"), f"{label}_first")
    gone = join_groups(named, first, "group", "n_rows").where(F.col(KEY) != F.col("first"))
    return without_ids(keyed, KEY, materialize(gone.select(F.col(KEY).alias("id")), f"{label}_gone")).drop(KEY)


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier takes for toxic go."""
    return drop_toxic(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the row with the smallest doc_id stays."""
    keyed = _keyed(docs, "rows")
    copies = exact_duplicates(*split_deliveries(_by_key(keyed))).where("group_size > 1")
    return _first_of_groups(keyed, copies.select(F.col("doc_id").alias(KEY), F.col("keep_id").alias("group")), "copies")


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near copies stays: five words, similarity 0.8."""
    keyed = _keyed(docs, "rows")
    near = near_duplicates(_by_key(keyed))
    return _first_of_groups(keyed, near.select(F.col("doc_id").alias(KEY), F.col("component_id").alias("group")), "near_copies")


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    return drop_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix's readings in training order."""
    keyed = _keyed(docs, "rows")
    read = materialize(readings(mix_sources(keyed, KEY), KEY), "readings")
    order = ["position", "doc_id", KEY, "pass"]
    return keyed.join(read.drop("doc_id"), KEY).repartitionByRange(*order).sortWithinPartitions(*order).drop(KEY)


STAGES: list[tuple[str, Stage]] = [
    ("toxicity", toxicity),
    ("exact_dedup", exact_dedup),
    ("near_dedup", near_dedup),
    ("decontamination", decontamination),
    ("mixing", mixing),
]

#: Stages one, three and four have no SQL; tests hold each against a brute-force version.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage over the documents of ``sf_dir``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return docs
