"""Label, one-hot and frequency encoding.

Fitting gives a ``LabelDomain``: a table (column, value, n, code) over a stored sort, with
one row per distinct value. All columns are fitted in one scan and one sort, whatever
their types: numbers, text and dates sit in value columns of their own, so numbers
keep their numeric order.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskflow.functions.columns import known, quoted, require, type_of
from riskflow.plans.lookup import Lookup, TableSize, lookup_many
from riskflow.plans.ordering import with_positions
from riskflow.plans.shared import materialize


def _family(kind: T.DataType) -> tuple[str, str]:
    """(value column, type) that holds values of a type in their own order."""
    if isinstance(kind, (T.ByteType, T.ShortType, T.IntegerType, T.LongType)):
        return "value_long", "bigint"
    if isinstance(kind, (T.FloatType, T.DoubleType)):
        return "value_double", "double"
    if isinstance(kind, T.DecimalType):
        return f"value_{kind.simpleString().replace('(', '_').replace(',', '_').rstrip(')')}", kind.simpleString()
    if isinstance(kind, (T.StringType, T.BooleanType, T.DateType, T.TimestampType, T.TimestampNTZType)):
        return f"value_{kind.typeName()}", kind.simpleString()
    raise TypeError(f"values of type {kind.simpleString()} have no order to encode by")


def _comparable(df: DataFrame, name: str) -> Column:
    """The value as it is kept in the domain: NaN counts as missing, -0.0 as 0.0."""
    value = known(df, name).cast(_family(type_of(df, name))[1])
    if isinstance(type_of(df, name), (T.FloatType, T.DoubleType)):
        return value + F.lit(0.0)
    return value


@dataclass
class LabelDomain:
    """Fitted values and codes; ``families`` maps a column to its value column."""

    table: DataFrame
    families: dict[str, str]
    types: dict[str, str]
    sizes: dict[str, TableSize]

    def of(self, column: str) -> DataFrame:
        """(value, n, code) of one column."""
        family = self.families[column]
        return self.table.where(F.col("column") == column).select(F.col(family).alias("value"), "n", "code")

    def values(self, column: str, limit: int | None = None) -> list:
        """Distinct values in order, for encodings with one output column each."""
        size = self.sizes[column].rows
        if limit is not None and size > limit:
            raise ValueError(f"{column} has {size} values, more than the {limit} output columns allowed")
        return [r["value"] for r in self.of(column).orderBy("code").collect()]

    def texts(self, columns: Sequence[str], limit: int | None = None) -> dict[str, list[str]]:
        """Distinct values of several columns as text, in order, in one job."""
        large = [f"{c} ({self.sizes[c].rows})" for c in columns if limit is not None and self.sizes[c].rows > limit]
        if large:
            raise ValueError(f"more than the {limit} output columns allowed: {', '.join(large)}")
        text = F.coalesce(
            *[
                F.when(F.col("column") == c, F.col(self.families[c]).cast(self.types[c]).cast("string"))
                for c in columns
            ]
        )
        rows = self.table.where(F.col("column").isin(*columns)).select("column", "code", text.alias("text")).collect()
        found: dict[str, list[str]] = {c: [] for c in columns}
        for r in sorted(rows, key=lambda r: r["code"]):
            found[r["column"]].append(r["text"])
        return found

    def save(self, path: str) -> None:
        """Keep the domain as Parquet; families and types are found again from ``columns``."""
        self.table.write.mode("overwrite").parquet(f"{path}/values")
        spark = self.table.sparkSession
        rows = [(c, self.families[c], self.types[c]) for c in self.families]
        spark.createDataFrame(rows, "column string, family string, type string").write.mode("overwrite").parquet(
            f"{path}/columns"
        )

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> LabelDomain:
        rows = spark.read.parquet(f"{path}/columns").collect()
        families = {r["column"]: r["family"] for r in rows}
        types = {r["column"]: r["type"] for r in rows}
        table = spark.read.parquet(f"{path}/values")
        return cls(table, families, types, _sizes(table, families))


def _sizes(table: DataFrame, families: Mapping[str, str]) -> dict[str, TableSize]:
    """Values, bytes and rows behind them, per column, in one pass over the domain."""
    text = "value_string" if "value_string" in table.columns else None
    length = F.coalesce(F.octet_length(text), F.lit(0)) if text else F.lit(0)
    rows = (
        table.groupBy("column")
        .agg(
            F.count(F.lit(1)).alias("rows"),
            F.sum(length + F.lit(32)).cast("bigint").alias("bytes"),
            F.sum("n").alias("weight"),
        )
        .collect()
    )
    found = {r["column"]: TableSize(r["rows"], r["bytes"], r["weight"]) for r in rows}
    return {c: found.get(c, TableSize(0, 0, 0)) for c in families}


def long_values(df: DataFrame, names: Sequence[str], missing: bool = False, keep: Sequence[str] = ()) -> tuple[DataFrame, dict[str, str], list[str]]:
    """(rows (kept columns, column, value columns), value column of each column, all value columns).

    One row per row and column; those without a value only on request. Values of one
    family share a value column, the others are null.
    """
    families = {c: _family(type_of(df, c)) for c in names}
    value_cols = sorted(set(families.values()))
    entries = [
        F.struct(
            F.lit(c).alias("column"),
            *[
                (_comparable(df, c) if families[c] == (v, kind) else F.lit(None).cast(kind)).alias(v)
                for v, kind in value_cols
            ],
        )
        for c in names
    ]
    order = [v for v, _ in value_cols]
    kept = [F.col(quoted(k)) for k in keep]
    long = df.select(*kept, F.explode(F.array(*entries)).alias("_entry")).select(*kept, "_entry.*")
    if not missing:
        long = long.where(reduce(lambda a, b: a | b, [F.col(v).isNotNull() for v in order]))
    return long, {c: family for c, (family, _) in families.items()}, order


def _counted(df: DataFrame, names: Sequence[str]) -> tuple[DataFrame, dict[str, str], list[str]]:
    """As long_values(), with one row per distinct value and ``n``, the rows that hold it."""
    long, families, order = long_values(df, names)
    return long.groupBy("column", *order).agg(F.count(F.lit(1)).alias("n")), families, order


def few_values(df: DataFrame, names: Sequence[str], limit: int) -> dict[str, list[str]] | None:
    """Distinct values of several columns as text, in order, by one job; None when there are more than ``limit``."""
    counted, families, order = _counted(df, names)
    first = counted.orderBy("column", *order).limit(limit + 1)
    text = F.coalesce(
        *[F.when(F.col("column") == c, F.col(families[c]).cast(type_of(df, c)).cast("string")) for c in names]
    )
    rows = first.select("column", text.alias("text")).collect()
    if len(rows) > limit:
        return None
    found: dict[str, list[str]] = {c: [] for c in names}
    for r in rows:
        found[r["column"]].append(r["text"])
    return found


def fit_label_encoder(df: DataFrame, cols: Sequence[str] | None = None) -> LabelDomain:
    """Code = position of a value among the sorted distinct values of its column, from 0."""
    names = list(cols or df.columns)
    require(df, names)
    distinct, by_column, order = _counted(df, names)
    coded = with_positions(distinct, order, ["column"], out="code", few_groups=True)
    table = coded.select("column", *order, "n", "code")
    types = {c: type_of(df, c).simpleString() for c in names}
    return LabelDomain(table, by_column, types, _sizes(table, by_column))


def encode(
    df: DataFrame,
    domain: LabelDomain,
    cols: Sequence[str] | None = None,
    unknown: str = "null",
    suffix: str = "",
    max_broadcast_rows: int | None = None,
) -> DataFrame:
    """Replace values by their codes (or add columns, with a suffix).

    A value outside the domain becomes null, stops the job (``error``), or gets the
    next free code (``code``). A missing value stays null.
    """
    if unknown not in ("null", "error", "code"):
        raise ValueError(f"unknown must be null, error or code, not {unknown!r}")
    names = list(cols or domain.families)
    require(df, names)
    lookups = [
        Lookup(f"_code{i}", _comparable(df, c), domain.of(c), "value", "code", "n", domain.sizes[c])
        for i, c in enumerate(names)
    ]
    found = lookup_many(df, lookups, max_broadcast_rows)
    results: dict[str, Column] = {}
    for i, c in enumerate(names):
        code, value = F.col(f"_code{i}"), _comparable(df, c)
        outside = value.isNotNull() & code.isNull()
        if unknown == "code":
            code = F.when(outside, F.lit(domain.sizes[c].rows).cast("bigint")).otherwise(code)
        elif unknown == "error":
            message = F.concat(F.lit(f"{c} has a value that was not fitted: "), value.cast("string"))
            code = F.when(outside, F.raise_error(message).cast("bigint")).otherwise(code)
        results[c] = code
    return _put(df, found, results, suffix)


def decode(
    df: DataFrame,
    domain: LabelDomain,
    cols: Sequence[str] | None = None,
    suffix: str = "",
    max_broadcast_rows: int | None = None,
) -> DataFrame:
    """Replace codes by the values they stand for; a code outside the domain becomes null."""
    names = list(cols or domain.families)
    require(df, names)
    lookups = [
        Lookup(f"_value{i}", F.col(quoted(c)), domain.of(c), "code", "value", "n", domain.sizes[c])
        for i, c in enumerate(names)
    ]
    found = lookup_many(df, lookups, max_broadcast_rows)
    results = {c: F.col(f"_value{i}").cast(domain.types[c]) for i, c in enumerate(names)}
    return _put(df, found, results, suffix)


def _put(df: DataFrame, found: DataFrame, results: Mapping[str, Column], suffix: str) -> DataFrame:
    """The columns of ``df`` with results in the place of their source, or added under a suffix."""
    if suffix:
        return found.select(*[quoted(c) for c in df.columns], *[e.alias(c + suffix) for c, e in results.items()])
    return found.select(*[results[c].alias(c) if c in results else F.col(quoted(c)) for c in df.columns])


def one_hot_name(column: str, value: object) -> str:
    text = str(value).lower() if isinstance(value, bool) else str(value)
    return f"{column}_{text}"


def unknown_name(column: str, values: Sequence) -> str:
    """Name of the indicator of unknown values, which no value has."""
    taken = {one_hot_name(column, v) for v in values}
    name = one_hot_name(column, "unknown")
    while name in taken:
        name += "_"
    return name


def one_hot(
    df: DataFrame,
    cols: Sequence[str],
    domain: LabelDomain | None = None,
    drop: str | None = None,
    unknown: str = "indicator",
    keep: bool = True,
) -> DataFrame:
    """One 0/1 column per value of the domain.

    ``unknown="indicator"`` adds a last column that is 1 for values outside the
    domain and for missing ones; with ``"ignore"`` such rows are 0 in all
    columns. ``drop="first"`` leaves out the smallest value. A value called "unknown"
    keeps its name; the indicator then gets an underscore more.
    """
    domain = domain or fit_label_encoder(df, cols)
    require(df, cols)
    added: list[tuple[str, Column]] = []
    for c in cols:
        added += one_hot_columns(_comparable(df, c), c, domain.values(c), drop, unknown)
    names = [name for name, _ in added]
    clash = sorted({n for n in names if n in df.columns or names.count(n) > 1}) if len(set(names)) < len(names) or set(names) & set(df.columns) else []
    if clash:
        raise ValueError(f"columns would share a name: {', '.join(clash)}")
    kept = df.columns if keep else [c for c in df.columns if c not in cols]
    return df.select(*[quoted(c) for c in kept], *[e.alias(n) for n, e in added])


def one_hot_columns(
    value: Column, column: str, values: Sequence, drop: str | None, unknown: str
) -> list[tuple[str, Column]]:
    """Output names and 0/1 expressions."""
    if drop not in (None, "first"):
        raise ValueError(f"drop must be None or 'first', not {drop!r}")
    if unknown not in ("indicator", "ignore"):
        raise ValueError(f"unknown must be 'indicator' or 'ignore', not {unknown!r}")
    shown = list(values)[1:] if drop == "first" else list(values)
    out = [(one_hot_name(column, v), F.when(value == F.lit(v), F.lit(1)).otherwise(F.lit(0))) for v in shown]
    if unknown == "indicator":
        seen = value.isin(list(values)) if values else F.lit(False)
        out.append((unknown_name(column, values), F.when(seen, F.lit(0)).otherwise(F.lit(1))))
    return out


def frequency_encode(df: DataFrame, cols: Sequence[str], domain: LabelDomain | None = None, suffix: str = "_n") -> DataFrame:
    """Add how many fitted rows share the value; 0 for a value outside the domain.

    Without a domain the values are counted, which needs no order and so no sort.
    """
    require(df, cols)
    if domain is None:
        counted, families, _ = _counted(df, cols)
        table = materialize(counted, "frequencies").withColumn("code", F.lit(None).cast("bigint"))
        domain = LabelDomain(table, families, {}, _sizes(table, families))
    lookups = [
        Lookup(f"_count{i}", _comparable(df, c), domain.of(c).withColumn("rows", F.col("n")), "value", "rows", "n", domain.sizes[c])
        for i, c in enumerate(cols)
    ]
    found = lookup_many(df, lookups)
    counts = {c: F.coalesce(F.col(f"_count{i}"), F.lit(0)) for i, c in enumerate(cols)}
    return found.select(*[quoted(c) for c in df.columns], *[e.alias(c + suffix) for c, e in counts.items()])
