"""Left joins against a table with unique keys, safe for hot keys on the big side.

The lookup table is broadcast when its measured size is below a limit. Above the limit
it is a shuffle join. A key that fills a large share of the big side would then
land in one task, so the rows' keys are counted, and those above a share of all
rows are answered from a broadcast first, whether the table has them or not: a
share of 1/1024 can be passed by at most 1024 keys. Rows already answered, and rows with a null key, are spread by the task they
come from and match nothing in the shuffle join.

Several large tables are looked up together in long form: one (row, column, key) entry for
each key, one join on (column, key), and one fold back into the rows, which are then
shuffled once, however many columns there are.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskflow.functions.columns import quoted
from riskflow.plans.shared import materialize

MAX_BROADCAST_ROWS = 500_000
MAX_BROADCAST_BYTES = 64 * 1024 * 1024
HOT_SHARE = 1024


@dataclass(frozen=True)
class TableSize:
    rows: int
    bytes: int
    weight: int

    def fits(self, max_rows: int | None = None, max_bytes: int | None = None) -> bool:
        rows = MAX_BROADCAST_ROWS if max_rows is None else max_rows
        size = MAX_BROADCAST_BYTES if max_bytes is None else max_bytes
        return self.rows <= rows and self.bytes <= size


def measure(table: DataFrame, weight: str | None = None) -> TableSize:
    """Rows and bytes of a stored table, counted; nested values are measured as JSON text."""
    fixed = sum(16 for f in table.schema if not _is_variable(f.dataType))
    variable = [
        F.coalesce(F.octet_length(_as_text(f)), F.lit(0)).cast("bigint")
        for f in table.schema
        if _is_variable(f.dataType)
    ]
    width = reduce(lambda a, b: a + b, variable, F.lit(fixed).cast("bigint"))
    row = table.agg(
        F.count(F.lit(1)).alias("rows"),
        F.coalesce(F.sum(width), F.lit(0)).alias("bytes"),
        F.coalesce(F.sum(weight) if weight else F.lit(0), F.lit(0)).cast("bigint").alias("weight"),
    ).first()
    return TableSize(row["rows"], row["bytes"], row["weight"])


def _is_variable(kind: T.DataType) -> bool:
    return isinstance(kind, (T.StringType, T.BinaryType, T.ArrayType, T.MapType, T.StructType))


def _as_text(field: T.StructField) -> Column:
    if isinstance(field.dataType, (T.StringType, T.BinaryType)):
        return F.col(field.name)
    return F.to_json(F.struct(field.name))


def broadcast_if_small(table: DataFrame) -> DataFrame:
    """Mark a stored table for broadcast when its counted size is under the limit."""
    return F.broadcast(table) if measure(table).fits() else table


@dataclass(frozen=True)
class Lookup:
    """One value to add: ``value`` of ``table`` where its ``table_key`` equals ``key``."""

    out: str
    key: Column
    table: DataFrame
    table_key: str
    value: str
    weight: str
    size: TableSize


def lookup_many(df: DataFrame, lookups: Sequence[Lookup], max_rows: int | None = None) -> DataFrame:
    """Add several looked-up values, each from a table of its own.

    Keys are computed in one projection. Small tables are broadcast one after the other,
    with no shuffle between them, the smallest first and all together within the limit of
    one. One table that is left takes the way of ``lookup_join``, several take the long form.
    """
    budget, sent = MAX_BROADCAST_BYTES, set()
    for i in sorted(range(len(lookups)), key=lambda i: lookups[i].size.bytes):
        if lookups[i].size.fits(max_rows, budget):
            budget -= lookups[i].size.bytes
            sent.add(i)
    keyed = df.select("*", *[item.key.alias(f"_key{i}") for i, item in enumerate(lookups)])
    numbered = list(enumerate(lookups))
    for i, item in numbered:
        if i in sent:
            slim = item.table.select(F.col(item.table_key).alias(f"_match{i}"), F.col(item.value).alias(item.out))
            keyed = keyed.join(F.broadcast(slim), F.col(f"_key{i}") == F.col(f"_match{i}"), "left")
    large = [(i, item) for i, item in numbered if i not in sent]
    if len(large) == 1:
        i, item = large[0]
        named = item.table.withColumnRenamed(item.value, item.out)
        keyed = lookup_join(keyed, named, [(f"_key{i}", item.table_key)], [item.out], item.weight, item.size, 0)
    elif large:
        keyed = _lookup_long(keyed, large)
    return keyed.select(*[quoted(c) for c in df.columns], *[item.out for item in lookups])


def _lookup_long(keyed: DataFrame, large: Sequence[tuple[int, Lookup]]) -> DataFrame:
    """Add ``item.out`` for every (i, item), whose keys are in ``_key<i>``.

    The keys of all columns are counted in one aggregate. Those that fill more than 1/HOT_SHARE of
    the rows, fewer than HOT_SHARE for a column, are answered from broadcasts, and columns that have
    no others need nothing more. What is left of one column takes a salted join; what is left of
    several goes in long form: its entries meet the tables in one shuffle, and are folded back
    into the rows, which are stored with a number for it, as a number worked out again may differ.
    """
    spark = keyed.sparkSession
    key_kind = _one_kind([item.table.schema[item.table_key].dataType for _, item in large])
    value_kind = _one_kind([item.table.schema[item.value].dataType for _, item in large])
    pair = ["_column", "_match"]

    def entries(rows: DataFrame, columns: Sequence[tuple[int, Lookup]], *kept: str) -> DataFrame:
        pairs = [F.struct(F.lit(i).alias("_column"), _as_key(keyed, i, item, key_kind).alias("_match")) for i, item in columns]
        long = rows.select(*kept, F.explode(F.array(*pairs)).alias("_entry")).select(*kept, "_entry.*")
        return long.where(F.col("_match").isNotNull())

    def answers(columns: Sequence[tuple[int, Lookup]]) -> DataFrame:
        parts = [
            item.table.select(
                F.lit(i).alias("_column"),
                F.col(item.table_key).cast(key_kind).alias("_match"),
                F.col(item.value).cast(value_kind).alias("_answer"),
            )
            for i, item in columns
        ]
        return reduce(DataFrame.unionByName, parts)

    counts = entries(keyed, large).groupBy(*pair).agg(F.count(F.lit(1)).alias("_n"))
    is_hot = F.col("_n") * HOT_SHARE > F.lit(keyed.count())
    # hot keys, and one row for a column that has others
    found = counts.select("_column", F.when(is_hot, F.col("_match")).alias("_match")).distinct()
    found = _local(found)
    cold = {r["_column"] for r in found.where(F.col("_match").isNull()).select("_column").collect()}
    hot = F.broadcast(found.where(F.col("_match").isNotNull()))
    known = _local(hot.join(answers(large).join(hot, pair), pair, "left").select(*pair, "_answer"))

    rest = [(i, item) for i, item in large if i in cold]
    if len(rest) > 1:
        keyed = materialize(keyed.withColumn("_row", F.monotonically_increasing_id()), "rows")
        long = entries(keyed, rest, "_row")
        open_keys = long.join(F.broadcast(known.select(*pair)), pair, "left_anti")
        met = open_keys.join(answers(rest), pair)
        folded = met.groupBy("_row").agg(
            *[F.max(F.when(F.col("_column") == i, F.col("_answer"))).alias(f"_cold{i}") for i, _ in rest]
        )
        keyed = keyed.join(folded, "_row", "left").drop("_row")
    elif rest:
        i, item = rest[0]
        column = known.where(F.col("_column") == i)
        named = answers(rest).select("_match", F.col("_answer").alias(f"_cold{i}"))
        hot_rows = column.select(
            F.col("_match").alias("_k0"), F.struct(F.col("_answer").alias(f"_cold{i}")).alias("_hot"), F.lit(True).alias("_hot_key")
        )
        keyed = keyed.withColumn("_key_now", _as_key(keyed, i, item, key_kind))
        keyed = _salted_join(keyed, named, [("_key_now", "_match")], [f"_cold{i}"], hot_rows).drop("_key_now")
    for i, item in large:
        kind = item.table.schema[item.value].dataType
        if rest == [(i, item)]:  # its join has answered the hot keys too
            keyed = keyed.withColumn(item.out, F.col(f"_cold{i}").cast(kind))
            continue
        mine = known.where(F.col("_column") == i).select(F.col("_match").alias(f"_hot_match{i}"), F.col("_answer").alias(f"_hot{i}"))
        wanted = _as_key(keyed, i, item, key_kind)
        keyed = keyed.join(F.broadcast(mine), wanted == F.col(f"_hot_match{i}"), "left")
        answer = F.coalesce(F.col(f"_hot{i}"), F.col(f"_cold{i}")) if i in cold else F.col(f"_hot{i}")
        keyed = keyed.withColumn(item.out, answer.cast(kind))
    return keyed


def _local(df: DataFrame) -> DataFrame:
    """A table of bounded size, fetched once, so that its uses do not work it out again."""
    return df.sparkSession.createDataFrame(df.toArrow(), df.schema)


def _as_key(df: DataFrame, i: int, item: Lookup, kind: T.DataType) -> Column:
    """The key of a row as the long form compares it: what the table's type can hold unchanged."""
    own, wanted = df.schema[f"_key{i}"].dataType, item.table.schema[item.table_key].dataType
    key = F.col(f"_key{i}")
    if own != wanted:
        key = F.when(key.try_cast(wanted).try_cast(own) == key, key.try_cast(wanted))
    return key.cast(kind)


def _one_kind(kinds: Sequence[T.DataType]) -> T.DataType:
    """The type all share; else text, which tells the values of every ordered type apart."""
    return kinds[0] if all(k == kinds[0] for k in kinds) else T.StringType()


def lookup_join(
    df: DataFrame,
    table: DataFrame,
    keys: Sequence[tuple[str, str]],
    values: Sequence[str],
    weight: str | None = None,
    size: TableSize | None = None,
    max_rows: int | None = None,
) -> DataFrame:
    """Left-join ``values`` of ``table`` onto ``df``.

    ``keys`` are (column of df, column of table) pairs, unique in ``table``, which
    must be a stored table. ``weight`` names a column of ``table`` that goes into the
    measure of its size. Above the broadcast limit the keys of ``df`` are counted first.
    """
    size = size or measure(table, weight)
    if not size.fits(max_rows):
        return _salted_join(df, table, keys, values)
    key_names = [f"_k{i}" for i in range(len(keys))]
    slim = table.select(*[F.col(right).alias(name) for (_, right), name in zip(keys, key_names)], *[F.col(v) for v in values])
    return df.join(F.broadcast(slim), _equal(df, slim, keys, key_names), "left").drop(*key_names)


def _salted_join(
    df: DataFrame, table: DataFrame, keys: Sequence[tuple[str, str]], values: Sequence[str], hot_table: DataFrame | None = None
) -> DataFrame:
    """The shuffle join; ``hot_table`` has the hot keys with their answers, otherwise they are counted."""
    key_names = [f"_k{i}" for i in range(len(keys))]
    slim = table.select(*[F.col(right).alias(name) for (_, right), name in zip(keys, key_names)], *[F.col(v) for v in values])
    if hot_table is None:
        hot_table = _hot_rows(df, slim, keys, key_names, values)
    df = df.join(F.broadcast(hot_table), _equal(df, hot_table, keys, key_names), "left").drop(*key_names)
    settled = F.col("_hot_key").isNotNull()
    open_row = reduce(lambda a, b: a & b, [F.col(left).isNotNull() for left, _ in keys], ~settled)

    # pmod(.., 1) is always 0, but the optimizer cannot fold it away, so the
    # spread stays part of the shuffle key
    df = df.withColumn(
        "_spread",
        F.when(open_row, F.pmod(F.hash(*[F.col(left) for left, _ in keys]), F.lit(1)))
        .otherwise(F.spark_partition_id() + 1),
    )
    for (left, _), name in zip(keys, key_names):
        df = df.withColumn(f"_open{name}", F.when(F.col("_spread") == 0, F.col(left)))
    cold = slim.select(
        *key_names,
        F.struct(*values).alias("_cold"),
        F.pmod(F.hash(*key_names), F.lit(1)).alias("_cold_spread"),
    )
    condition = reduce(
        lambda a, b: a & b,
        [df[f"_open{name}"] == cold[name] for name in key_names],
        df["_spread"] == cold["_cold_spread"],
    )
    joined = df.join(cold, condition, "left")
    result = [
        F.coalesce(F.col(f"_hot.{v}"), F.col(f"_cold.{v}")).alias(v) for v in values
    ]
    kept = [c for c in df.columns if not c.startswith(("_hot", "_spread", "_open_k"))]
    return joined.select(*[df[c] for c in kept], *result)


def _hot_rows(
    df: DataFrame, slim: DataFrame, keys: Sequence[tuple[str, str]], names: Sequence[str], values: Sequence[str]
) -> DataFrame:
    """Keys with more than 1/1024 of the rows of ``df`` (so fewer than 1024), with their values if the table has them."""
    known = reduce(lambda a, b: a & b, [F.col(left).isNotNull() for left, _ in keys])
    total = df.count()
    counts = df.where(known).groupBy(*[F.col(left).alias(n) for (left, _), n in zip(keys, names)]).agg(F.count(F.lit(1)).alias("_n"))
    hot = counts.where(F.col("_n") * HOT_SHARE > F.lit(total)).select(*names)
    found = slim.join(F.broadcast(hot), list(names))
    return hot.join(found, list(names), "left").select(*names, F.struct(*values).alias("_hot"), F.lit(True).alias("_hot_key"))


def _equal(
    df: DataFrame, table: DataFrame, keys: Sequence[tuple[str, str]], names: Sequence[str]
) -> Column:
    return reduce(lambda a, b: a & b, [df[left] == table[n] for (left, _), n in zip(keys, names)])
