"""Join rows with what is known of their group when one group may hold a third of them."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: A group with at least one row in so many is hot; so there are at most so many hot groups.
HOT_SHARE = 1000
#: Bits of an id filter. Its size is fixed; beyond about as many ids it only lets more rows through.
FILTER_BITS = 1 << 24


def join_groups(rows: DataFrame, groups: DataFrame, key: str, size: str) -> DataFrame:
    """``rows`` with the columns of ``groups``; every key of rows stands once in groups.

    ``size`` holds the rows of a group. Hot groups, HOT_SHARE of them at most, are
    broadcast, so that their rows stay where they are; the others meet in a shuffle.
    Keys must not be null.
    """
    total = groups.agg(F.coalesce(F.sum(size), F.lit(0)).alias("n")).first()["n"]
    hot = groups.where(F.col(size) * HOT_SHARE >= F.lit(total))
    marked = rows.join(F.broadcast(hot.withColumn("_hot", F.lit(True))), key, "left")
    columns = [*rows.columns, *(c for c in groups.columns if c != key)]
    cold = marked.where("_hot is null").select(*rows.columns)
    rest = groups.where(F.col(size) * HOT_SHARE < F.lit(total))
    return marked.where("_hot").select(*columns).unionByName(cold.join(rest, key).select(*columns))


def maybe_among(rows: DataFrame, column: str, ids: DataFrame) -> DataFrame:
    """``rows`` with ``_maybe``: whether an integer column may be among ``ids`` (one column ``id``).

    One bit is set for a hash of each id. The words of the filter, FILTER_BITS / 64 rows at
    most, are broadcast; false is certain, true is not. Null is never among them.
    """
    bit = F.pmod(F.xxhash64(F.col("id").cast("bigint")), F.lit(FILTER_BITS))
    one = ids.where("id is not null").select(F.floor(bit / 64).alias("_word"), (bit % 64).cast("int").alias("_at"))
    words = one.groupBy("_word").agg(F.bit_or(F.expr("shiftleft(1L, _at)")).alias("_mask"))
    own = F.pmod(F.xxhash64(F.col(column).cast("bigint")), F.lit(FILTER_BITS))
    marked = rows.withColumn("_bit", F.when(F.col(column).isNotNull(), own))
    marked = marked.join(F.broadcast(words), F.floor(F.col("_bit") / 64) == F.col("_word"), "left")
    hit = F.expr("shiftright(_mask, cast(_bit % 64 as int)) & 1 = 1")
    return marked.withColumn("_maybe", F.coalesce(hit, F.lit(False))).select(*rows.columns, "_maybe")


def without_ids(rows: DataFrame, column: str, ids: DataFrame) -> DataFrame:
    """The rows whose integer column is null or not among ``ids`` (a stored table with one column ``id``).

    Rows that an id filter clears stay where they are; only the others are shuffled.
    """
    marked = maybe_among(rows, column, ids)
    open_rows = marked.where("_maybe").drop("_maybe")
    gone = ids.where("id is not null").distinct()
    kept = open_rows.join(gone, F.col(column).cast("bigint") == F.col("id"), "left_anti")
    return marked.where("not _maybe").drop("_maybe").unionByName(kept)


def nullable(values: np.ndarray, null: np.ndarray) -> pd.Series:
    """Integers for a pandas result, with nulls where ``null`` is true."""
    if not null.any():
        return pd.Series(values)
    column = values.astype(object)
    column[null] = None
    return pd.Series(column)
