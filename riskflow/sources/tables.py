"""Reading and writing tables: CSV, Parquet, catalogue tables, versioned folders."""

from __future__ import annotations

import re
from collections.abc import Sequence
from functools import reduce

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskflow.functions.columns import count_if, known, quoted, require
from riskflow.plans.shared import file_system
from riskflow.sources import schemas


def read_csv(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """CSV with a header row. Without a schema the types are inferred, at the cost of one more scan."""
    reader = spark.read.option("header", True)
    if schema is None:
        return reader.option("inferSchema", True).csv(path)
    return reader.schema(schema).option("enforceSchema", False).csv(path)


def is_path(target: str) -> bool:
    return "/" in target


def read_table(spark: SparkSession, target: str) -> DataFrame:
    """A catalogue table by its (dotted) name, or a Parquet folder by its path."""
    if is_path(target):
        return spark.read.parquet(target)
    return spark.table(target)


def write_table(df: DataFrame, target: str) -> None:
    """Create or replace a table; the schema may differ from the one before."""
    writer = df.write.mode("overwrite")
    if is_path(target):
        writer.parquet(target)
    else:
        writer.saveAsTable(target)


def ensure_schema(spark: SparkSession, name: str, location: str | None = None) -> None:
    """Create a schema unless it is there; its tables go below ``location``."""
    parts = ".".join(quoted(part) for part in name.split("."))
    place = " LOCATION '" + location.replace("'", "\\'") + "'" if location else ""
    spark.sql(f"CREATE SCHEMA IF NOT EXISTS {parts}{place}")


def ensure_table(spark: SparkSession, name: str, schema: T.StructType) -> None:
    """Create an empty catalogue table unless it is there."""
    if not spark.catalog.tableExists(name):
        spark.createDataFrame([], schema).write.mode("ignore").saveAsTable(name)


def append_evolving(df: DataFrame, path: str) -> None:
    """Append rows; columns that are new to the folder read as null in older rows, types may differ."""
    df.write.mode("append").parquet(path)


def read_evolving(spark: SparkSession, path: str) -> DataFrame:
    """All rows of a folder whose files differ in their columns, or in the types of columns.

    Types that differ become the widest of them, see ``schemas.widest``; text where nothing else
    fits. Spark merges schemas that agree in their types by a distributed job. Only where they do
    not are the files grouped by what can be merged, and the groups cast and united.
    """
    try:
        return spark.read.option("mergeSchema", True).parquet(path)
    except (PySparkException, Py4JJavaError) as error:
        if not _is_conflict(error):
            raise
    groups = _mergeable(spark, path, data_files(spark, path))
    target = reduce(schemas.merge, [schema for _, schema in groups])
    parts = [
        schemas.conform(spark.read.schema(schema).option("basePath", path).parquet(*files), target)
        for files, schema in groups
    ]
    return reduce(DataFrame.unionByName, parts)


def _is_conflict(error: Exception) -> bool:
    return "CANNOT_MERGE" in str(error)


def data_files(spark: SparkSession, path: str) -> list[str]:
    """The data files below a folder, by name; what begins with _ or . is none."""
    fs, root = file_system(spark, path)
    listing, base, found = fs.listFiles(root, True), fs.makeQualified(root).toString().rstrip("/"), []
    while listing.hasNext():
        name = listing.next().getPath().toString()
        if not any(part.startswith(("_", ".")) for part in name[len(base) + 1 :].split("/")):
            found.append(name)
    return sorted(found)


def _mergeable(spark: SparkSession, base: str, files: list[str]) -> list[tuple[list[str], T.StructType]]:
    """Groups of files whose schemas Spark can merge; equal schemas share a group.

    A list that cannot be merged is halved, so k kinds of files among n take about
    k * log2(n) distributed merges, not n on the driver.
    """
    groups: dict[str, tuple[list[str], T.StructType]] = {}
    open_lists = [files]
    while open_lists:
        some = open_lists.pop()
        try:
            schema = spark.read.option("mergeSchema", True).option("basePath", base).parquet(*some).schema
        except (PySparkException, Py4JJavaError) as error:
            if not _is_conflict(error) or len(some) == 1:
                raise
            middle = len(some) // 2
            open_lists += [some[middle:], some[:middle]]
            continue
        groups.setdefault(schema.json(), ([], schema))[0].extend(some)
    return list(groups.values())


# --- versioned folders -------------------------------------------------------
# Parquet has no DELETE, and a job cannot overwrite the folder it reads. A table that
# changes is kept as <path>/v=<n>. A version counts once its _SUCCESS marker,
# which the committer writes last, is there. One writer at a time is assumed.


def current_version(spark: SparkSession, path: str) -> int | None:
    """Highest finished version, or None when there is no table."""
    fs, root = file_system(spark, path)
    if not fs.exists(root):
        return None
    finished = []
    for status in fs.listStatus(root):
        found = re.fullmatch(r"v=(\d+)", status.getPath().getName())
        if found:
            marker = spark._jvm.org.apache.hadoop.fs.Path(status.getPath(), "_SUCCESS")
            if fs.exists(marker):
                finished.append(int(found.group(1)))
    return max(finished, default=None)


def _version_path(path: str, version: int) -> str:
    return f"{path.rstrip('/')}/v={version}"


def read_versioned(spark: SparkSession, path: str) -> DataFrame:
    version = current_version(spark, path)
    if version is None:
        raise FileNotFoundError(f"no finished version under {path}")
    return read_evolving(spark, _version_path(path, version))


def write_versioned(df: DataFrame, path: str) -> int:
    """Write the rows as the next version and return its number."""
    version = (current_version(df.sparkSession, path) or 0) + 1
    df.write.mode("overwrite").parquet(_version_path(path, version))
    return version


def append_versioned(df: DataFrame, path: str) -> None:
    """Append to the current version, or start the first one."""
    version = current_version(df.sparkSession, path) or 1
    append_evolving(df, _version_path(path, version))


def delete_where(spark: SparkSession, path: str, predicate: Column) -> None:
    """Remove rows for which the predicate is true; no table, no error.

    Rows for which it is unknown stay, as with SQL DELETE.
    """
    if current_version(spark, path) is None:
        return
    keep = ~F.coalesce(predicate, F.lit(False))
    write_versioned(read_versioned(spark, path).where(keep), path)


# --- keyed feature tables ----------------------------------------------------


def key_check(df: DataFrame, key: str | Sequence[str]) -> DataFrame:
    """One row: rows, rows with a missing key part, keys seen more than once, and whether the key holds."""
    names = [key] if isinstance(key, str) else list(key)
    require(df, names)
    per_key = df.select(*[known(df, n).alias(n) for n in names]).groupBy(*names).agg(F.count(F.lit(1)).alias("_n"))
    no_null = F.lit(True)
    for name in names:
        no_null = no_null & F.col(name).isNotNull()
    return per_key.agg(
        F.coalesce(F.sum("_n"), F.lit(0)).alias("n_rows"),
        F.coalesce(F.sum(F.when(~no_null, F.col("_n"))), F.lit(0)).alias("n_null_keys"),
        count_if(no_null & (F.col("_n") > 1)).alias("n_duplicate_keys"),
        (count_if(~no_null | (F.col("_n") > 1)) == 0).alias("key_ok"),
    )


def write_feature_table(df: DataFrame, target: str, key: str | Sequence[str], source: DataFrame | None = None) -> None:
    """Create or replace a table after checking that its declared key holds.

    ``source`` is a cheaper table with the same keys, one to one, such as the rows before their columns were
    encoded: the check then reads only its key columns, and ``df`` is worked out once.
    """
    found = key_check(df if source is None else source, key).first()
    if not found["key_ok"]:
        raise ValueError(
            f"{key} is not a key: {found['n_null_keys']} rows with a null key, "
            f"{found['n_duplicate_keys']} keys seen more than once"
        )
    write_table(df, target)


def preview(df: DataFrame, n: int, order_by: Sequence[str | Column]) -> DataFrame:
    """First n rows in a stated order."""
    return df.orderBy(*order_by).limit(n)


def schema_rows(df: DataFrame) -> DataFrame:
    """The schema as rows (position, column, type)."""
    rows = [(i, f.name, f.dataType.simpleString()) for i, f in enumerate(df.schema)]
    return df.sparkSession.createDataFrame(rows, "position int, column string, type string")
