"""Tags of model versions: an append-only table (version, key, value, moment, turn).

The newest row of a (version, key) holds; a null value takes a tag back. Checks and
decisions are tags like any other, so that a later step reads what an earlier one found.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskflow.functions.columns import require
from riskflow.operators.runlog import latest_per_key
from riskflow.sources.tables import append_versioned, current_version, read_versioned

TAG_SCHEMA = T.StructType(
    [
        T.StructField("version", T.StringType()),
        T.StructField("key", T.StringType()),
        T.StructField("value", T.StringType()),
        T.StructField("moment", T.TimestampType()),
        T.StructField("turn", T.LongType()),
    ]
)
DETAIL = "_detail"


def write_tags(rows: DataFrame, path: str, moment: datetime | None = None) -> None:
    """Append (version, key, value) rows, all with one moment.

    ``turn`` tells rows of one moment apart: a column of that name is taken, else 0. Of rows with equal
    moment and turn the greatest value holds.
    """
    require(rows, ["version", "key", "value"])
    turn = F.col("turn").cast("bigint") if "turn" in rows.columns else F.lit(0).cast("bigint")
    stamped = rows.select(
        F.col("version").cast("string").alias("version"),
        F.col("key").cast("string").alias("key"),
        F.col("value").cast("string").alias("value"),
        F.lit(moment or datetime.now(timezone.utc)).cast("timestamp").alias("moment"),
        turn.alias("turn"),
    )
    append_versioned(stamped, path)


def set_tags(
    spark: SparkSession, path: str, version: str, values: Mapping[str, object], moment: datetime | None = None
) -> None:
    """Append tags of one version; booleans become 1 and 0, None takes a tag back."""
    texts = {k: (str(int(v)) if isinstance(v, bool) else None if v is None else str(v)) for k, v in values.items()}
    if not texts:
        return
    rows = [(version, k, v, i) for i, (k, v) in enumerate(texts.items())]
    write_tags(spark.createDataFrame(rows, "version string, key string, value string, turn bigint").coalesce(1), path, moment)


def read_tags(spark: SparkSession, path: str) -> DataFrame:
    """All rows ever written, or an empty table when nothing has been."""
    if current_version(spark, path) is None:
        return spark.createDataFrame([], TAG_SCHEMA)
    return read_versioned(spark, path)


def current_tags(tags: DataFrame) -> DataFrame:
    """(version, key, value, moment) of the newest row of each (version, key); tags taken back are left out.

    One aggregate that combines on the map side, however often a tag was written.
    """
    newest = latest_per_key(
        tags.withColumn("_value", F.coalesce("value", F.lit(""))), ["version", "key"], ["moment", "turn", "_value"]
    )
    return newest.where(F.col("value").isNotNull()).select("version", "key", "value", "moment")


def tags_wide(tags: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row per version that has any tag, one column per key, null where the tag is absent."""
    return current_tags(tags).groupBy("version").pivot("key", list(keys)).agg(F.first("value"))


def tag_values(spark: SparkSession, path: str, version: str, keys: Sequence[str]) -> dict[str, str | None]:
    """The values of some tags of one version, by one job."""
    rows = current_tags(read_tags(spark, path).where(F.col("version") == version)).where(F.col("key").isin(*keys))
    found = {r["key"]: r["value"] for r in rows.collect()}
    return {k: found.get(k) for k in keys}


def store_checks(checks: DataFrame, path: str, moment: datetime | None = None) -> None:
    """Append checks (version, check, value, detail) as tags <check> and <check>_detail."""
    pairs = F.array(
        F.struct(F.col("check").alias("key"), F.col("value").alias("value")),
        F.struct(F.concat("check", F.lit(DETAIL)).alias("key"), F.col("detail").alias("value")),
    )
    write_tags(checks.select("version", F.explode(pairs).alias("_tag")).select("version", "_tag.*").coalesce(1), path, moment)


def stored_checks(tags: DataFrame, checks: Sequence[str]) -> DataFrame:
    """(version, check, value, detail) as store_checks() has written them, the newest of each."""
    now = current_tags(tags)
    values = now.where(F.col("key").isin(*checks)).select("version", F.col("key").alias("check"), "value")
    details = now.where(F.col("key").isin(*[c + DETAIL for c in checks])).select(
        "version", F.expr(f"substring(key, 1, length(key) - {len(DETAIL)})").alias("check"), F.col("value").alias("detail")
    )
    return values.join(details, ["version", "check"], "left").select("version", "check", "value", "detail")
