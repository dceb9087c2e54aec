"""Intermediate tables in the cluster's shared folder.

A plan that is read more than once, or whose row numbering must not change when
a lost executor makes Spark run a stage again, is written out and read back.
The folder is the one the cluster names in ``spark.checkpoint.dir``.
"""

from __future__ import annotations

import threading
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_SETTING = "spark.checkpoint.dir"


def shared_folder(spark: SparkSession) -> str:
    """Folder every executor can reach: the checkpoint folder, else one below the warehouse."""
    folder = spark.conf.get(CHECKPOINT_SETTING, "")
    if not folder:
        folder = spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_intermediate"
    return folder.rstrip("/")


_working = threading.local()


def new_path(spark: SparkSession, label: str, lasting: bool = False) -> str:
    """A path no other run uses; inside working_tables() one that goes with them, unless ``lasting``."""
    app = spark.sparkContext.applicationId
    inner = "" if lasting else getattr(_working, "folder", "")
    return f"{shared_folder(spark)}/riskflow/{app}/{inner}{label}-{uuid.uuid4().hex}"


@contextmanager
def working_tables(spark: SparkSession) -> Iterator[None]:
    """Tables this thread stores inside the block are deleted at its end, but those that are ``lasting``.

    For steps whose result is stored before the block ends, so that large inner tables do not stay
    on disk until the session does.
    """
    before = getattr(_working, "folder", "")
    _working.folder = f"{before}work-{uuid.uuid4().hex}/"
    try:
        yield
    finally:
        folder, _working.folder = _working.folder, before
        app = spark.sparkContext.applicationId
        fs, path = file_system(spark, f"{shared_folder(spark)}/riskflow/{app}/{folder}")
        fs.delete(path, True)


def materialize(df: DataFrame, label: str, lasting: bool = False) -> DataFrame:
    """Run ``df`` once, keep its rows as Parquet in the shared folder, read them back."""
    spark = df.sparkSession
    path = new_path(spark, label, lasting)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def file_system(spark: SparkSession, path: str):
    """Hadoop file system and path object, for folder-level steps on any storage."""
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()), hadoop_path


def drop_intermediates(spark: SparkSession) -> None:
    """Delete this application's intermediate tables."""
    app = spark.sparkContext.applicationId
    fs, path = file_system(spark, f"{shared_folder(spark)}/riskflow/{app}")
    fs.delete(path, True)
