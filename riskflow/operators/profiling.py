"""Data profiles, value counts, exact quantiles, per-slice accuracy and the leakage report."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskflow.functions.columns import NUMERIC, count_if, is_missing, known, quoted, ratio, require, type_of
from riskflow.plans.ordering import running_sums


def _long_form(row: DataFrame, cols: Sequence[str], fields: Sequence[str]) -> DataFrame:
    """One wide row with columns ``<i>_<field>`` to one row per profiled column."""
    entries = [
        F.struct(F.lit(c).alias("column"), *[F.col(f"`{i}_{f}`").alias(f) for f in fields])
        for i, c in enumerate(cols)
    ]
    return row.select(F.explode(F.array(*entries)).alias("_row")).select("_row.*")


def null_profile(df: DataFrame, max_null_share: float = 0.5, cols: Sequence[str] | None = None) -> DataFrame:
    """Per column: rows, missing values, their share, and whether the share is low enough to keep it."""
    names = list(cols or df.columns)
    require(df, names)
    counts = df.agg(
        F.count(F.lit(1)).alias("_rows"),
        *[count_if(is_missing(df, c)).alias(f"{i}_n_null") for i, c in enumerate(names)],
    )
    for i in range(len(names)):
        counts = counts.withColumn(f"{i}_n_rows", F.col("_rows"))
    long = _long_form(counts, names, ["n_rows", "n_null"])
    share = ratio(F.col("n_null"), F.col("n_rows"))
    return long.select(
        "column",
        "n_rows",
        "n_null",
        F.round(share, 6).alias("null_share"),
        (share <= F.lit(max_null_share)).alias("keep"),
    )


def rows_with_null(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """How many rows hold at least one missing value."""
    names = list(cols or df.columns)
    require(df, names)
    some = F.lit(False)
    for c in names:
        some = some | is_missing(df, c)
    return df.agg(F.count(F.lit(1)).alias("n_rows"), count_if(some).alias("n_rows_with_null"))


def value_counts(df: DataFrame, col: str, top: int | None = None) -> DataFrame:
    """Rows per value, most frequent first, ties by value."""
    require(df, [col])
    counts = df.groupBy(quoted(col)).agg(F.count(F.lit(1)).alias("n"))
    if top is None:
        return counts
    return counts.orderBy(F.desc("n"), F.asc(quoted(col))).limit(top)


def class_counts(df: DataFrame, label: str) -> DataFrame:
    return value_counts(df, label)


def value_frequencies(
    df: DataFrame, cols: Sequence[str], group: Sequence[str] = (), missing: bool = False
) -> DataFrame:
    """(group, column, value, n) of numeric columns; rows without a value only on request.

    Rows are combined on the map side, so what is shuffled is at most one row per
    distinct value and task.
    """
    pairs = F.array(*[F.struct(F.lit(c).alias("column"), known(df, c).cast("double").alias("value")) for c in cols])
    long = df.select(*[quoted(g) for g in group], F.explode(pairs).alias("_pair"))
    long = long.select(*[quoted(g) for g in group], "_pair.column", "_pair.value")
    if not missing:
        long = long.where(F.col("value").isNotNull())
    return long.groupBy(*group, "column", "value").agg(F.count(F.lit(1)).alias("n"))


def quantiles(
    df: DataFrame, cols: Sequence[str], shares: Sequence[float], group: Sequence[str] = ()
) -> DataFrame:
    """Exact quantiles (linear between neighbours) as rows (group, column, share, value).

    Works on value frequencies with running sums over the sorted values, so no task
    holds all values of a column, as the built-in exact percentile does.
    """
    require(df, [*cols, *group])
    return quantiles_of(value_frequencies(df, cols, group), shares, group)


def quantiles_of(frequencies: DataFrame, shares: Sequence[float], group: Sequence[str] = ()) -> DataFrame:
    """Quantiles from a table (group, column, value, n), one row per share."""
    wide = spread_of(frequencies, shares, group)
    entries = [F.struct(F.lit(float(s)).alias("share"), F.col(_share_name(s)).alias("value")) for s in shares]
    long = wide.select(*group, "column", F.explode(F.array(*entries)).alias("_q"))
    return long.select(*group, "column", "_q.share", "_q.value")


def spread_of(frequencies: DataFrame, shares: Sequence[float], group: Sequence[str] = ()) -> DataFrame:
    """(group, column, n_distinct, p..): distinct values and one column per quantile."""
    keys = [*group, "column"]
    ranked = running_sums(frequencies, ["value"], {"upto": "n"}, keys, {"_total": "n"}, few_groups=not group)
    first, last = F.col("upto") - F.col("n"), F.col("upto") - 1
    columns = []
    for s in shares:
        place = F.lit(float(s)) * (F.col("_total") - 1)
        low = F.max(F.when(F.floor(place).between(first, last), F.col("value")))
        high = F.max(F.when(F.ceil(place).between(first, last), F.col("value")))
        columns.append((low + (high - low) * F.max(place - F.floor(place))).alias(_share_name(s)))
    return ranked.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_distinct"), *columns)


NUMERIC_FIELDS = ["n", "n_null", "min", "max", "min_value", "max_value", "mean", "std", "skew"]
#: Numbers that a double may not hold.
WIDE = (T.LongType, T.DecimalType)
NESTED = (T.ArrayType, T.MapType, T.StructType)


def _distinct_counts(df: DataFrame, values: dict[str, Column]) -> DataFrame:
    """(column, n_distinct) of text values, nulls left out."""
    pairs = F.array(*[F.struct(F.lit(c).alias("column"), v.alias("value")) for c, v in values.items()])
    long = df.select(F.explode(pairs).alias("_pair")).select("_pair.*").where(F.col("value").isNotNull()).distinct()
    return long.groupBy("column").agg(F.count(F.lit(1)).alias("n_distinct"))


def profile_numeric(
    df: DataFrame, cols: Sequence[str], shares: Sequence[float] = (0.5,), exact: bool = True
) -> DataFrame:
    """Count, missing, distinct, range, mean, sample std, skewness and quantiles per numeric column.

    Distinct counts and the text of the range (``min_value``, ``max_value``) are of the values
    in their own type; ``min``, ``max``, moments and quantiles are doubles, and so not exact
    for 64-bit integers and decimals beyond 2^53.
    Moments come from one pass. ``exact`` takes distinct counts and quantiles from
    the value frequencies; without it they are sketched in the same pass.
    """
    require(df, cols)
    aggs: list[Column] = []
    for i, c in enumerate(cols):
        native = known(df, c)
        v = native.cast("double")
        aggs += [
            F.count(v).alias(f"{i}_n"),
            count_if(is_missing(df, c)).alias(f"{i}_n_null"),
            F.min(v).alias(f"{i}_min"),
            F.max(v).alias(f"{i}_max"),
            F.min(native).cast("string").alias(f"{i}_min_value"),
            F.max(native).cast("string").alias(f"{i}_max_value"),
            F.avg(v).alias(f"{i}_mean"),
            F.stddev_samp(v).alias(f"{i}_std"),
            F.skewness(v).alias(f"{i}_skew"),
        ]
        if not exact:
            aggs.append(F.approx_count_distinct(native).alias(f"{i}_n_distinct"))
            aggs += [F.percentile_approx(v, float(s)).alias(f"{i}_{_share_name(s)}") for s in shares]
    fields = list(NUMERIC_FIELDS)
    if not exact:
        fields += ["n_distinct", *[_share_name(s) for s in shares]]
        return _long_form(df.agg(*aggs), cols, fields)
    moments = _long_form(df.agg(*aggs), cols, fields)
    spread = spread_of(value_frequencies(df, cols), shares)
    # one row per profiled column
    joined = moments.join(F.broadcast(spread), "column", "left")
    wide = {c: F.col(quoted(c)).cast("string") for c in cols if isinstance(type_of(df, c), WIDE)}
    if wide:
        exactly = _distinct_counts(df, wide).withColumnRenamed("n_distinct", "_own")
        joined = joined.join(F.broadcast(exactly), "column", "left")
        joined = joined.withColumn("n_distinct", F.coalesce("_own", "n_distinct")).drop("_own")
    return joined.withColumn("n_distinct", F.coalesce("n_distinct", F.lit(0)))


def _share_name(share: float) -> str:
    return f"p{share * 100:g}".replace(".", "_")


def profile_string(df: DataFrame, cols: Sequence[str], exact: bool = True) -> DataFrame:
    """Count, missing, distinct, shortest and longest length, first and last value per text column."""
    require(df, cols)
    aggs: list[Column] = []
    for i, c in enumerate(cols):
        v = F.col(quoted(c)).cast("string")
        aggs += [
            F.count(v).alias(f"{i}_n"),
            count_if(v.isNull()).alias(f"{i}_n_null"),
            F.min(F.length(v)).alias(f"{i}_min_length"),
            F.max(F.length(v)).alias(f"{i}_max_length"),
            F.min(v).alias(f"{i}_min"),
            F.max(v).alias(f"{i}_max"),
        ]
        if not exact:
            aggs.append(F.approx_count_distinct(v).alias(f"{i}_n_distinct"))
    fields = ["n", "n_null", "min_length", "max_length", "min", "max"]
    if not exact:
        return _long_form(df.agg(*aggs), cols, [*fields, "n_distinct"])
    result = _long_form(df.agg(*aggs), cols, fields)
    distinct = _distinct_counts(df, {c: F.col(quoted(c)).cast("string") for c in cols})
    joined = result.join(F.broadcast(distinct), "column", "left")
    return joined.withColumn("n_distinct", F.coalesce("n_distinct", F.lit(0)))


def profile_complex(df: DataFrame, cols: Sequence[str], exact: bool = True) -> DataFrame:
    """Count, missing and distinct per array, map, struct or binary column.

    Distinct goes by the hash of a value's JSON text, or of its bytes; maps whose entries
    stand in another order differ.
    """
    require(df, cols)
    stamp = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"
    options = {"ignoreNullFields": "false", "timestampFormat": stamp + "XXX", "timestampNTZFormat": stamp}
    aggs: list[Column] = []
    hashes: dict[str, Column] = {}
    for i, c in enumerate(cols):
        v = F.col(quoted(c))
        whole = F.to_json(F.struct(v.alias("v")), options) if isinstance(type_of(df, c), NESTED) else v
        hashes[c] = F.when(v.isNotNull(), F.sha2(whole, 256))
        aggs += [F.count(v).alias(f"{i}_n"), count_if(v.isNull()).alias(f"{i}_n_null")]
        if not exact:
            aggs.append(F.approx_count_distinct(hashes[c]).alias(f"{i}_n_distinct"))
    result = _long_form(df.agg(*aggs), cols, ["n", "n_null"] if exact else ["n", "n_null", "n_distinct"])
    if not exact:
        return result
    joined = result.join(F.broadcast(_distinct_counts(df, hashes)), "column", "left")
    return joined.withColumn("n_distinct", F.coalesce("n_distinct", F.lit(0)))


def profile(df: DataFrame, exact: bool = False) -> DataFrame:
    """Profile every column: numbers by value, arrays, maps, structs and binary by hash, others by text."""
    numeric = [f.name for f in df.schema if isinstance(f.dataType, NUMERIC)]
    nested = [f.name for f in df.schema if isinstance(f.dataType, (*NESTED, T.BinaryType))]
    other = [f.name for f in df.schema if f.name not in numeric and f.name not in nested]
    parts = []
    if numeric:
        parts.append(profile_numeric(df, numeric, exact=exact))
    if other:
        text = profile_string(df, other, exact=exact)
        parts.append(text.withColumnsRenamed({"min": "first_value", "max": "last_value"}))
    if nested:
        parts.append(profile_complex(df, nested, exact=exact))
    if not parts:
        raise ValueError("no column can be profiled")
    result = parts[0]
    for part in parts[1:]:
        result = result.unionByName(part, allowMissingColumns=True)
    return result


def sliced_accuracy(
    df: DataFrame, slice_cols: str | Sequence[str], label: str, prediction: str, min_obs: int = 0
) -> DataFrame:
    """Right predictions, rows and their quotient per slice; ``slice_cols`` may be a comma list."""
    names = [c.strip() for c in slice_cols.split(",")] if isinstance(slice_cols, str) else list(slice_cols)
    require(df, [*names, label, prediction])
    right = count_if(F.col(label) == F.col(prediction))
    rows = F.count(F.lit(1))
    slices = df.groupBy(*names).agg(
        right.alias("acc"), rows.alias("obs"), ratio(right, rows).alias("pct_acc")
    )
    return slices.where(F.col("obs") >= min_obs) if min_obs else slices


def leakage_report(
    df: DataFrame,
    label: str,
    cols: Sequence[str] | None = None,
    max_distinct_share: float = 0.9,
    min_purity: float = 0.999,
) -> DataFrame:
    """Per column: how far its values alone give away the row or the label.

    ``purity`` is the share of rows that carry the most common label of their value.
    It is read against ``base_purity``, the share of the most common label overall.
    A missing value counts as a value of its own.
    """
    names = list(cols or [c for c in df.columns if c != label])
    require(df, [*names, label])
    pairs = F.array(
        *[F.struct(F.lit(c).alias("column"), F.col(quoted(c)).cast("string").alias("value")) for c in names]
    )
    long = df.select(F.col(quoted(label)).alias("_label"), F.explode(pairs).alias("_pair"))
    cells = long.groupBy("_pair.column", "_pair.value", "_label").agg(F.count(F.lit(1)).alias("_n"))
    values = cells.groupBy("column", "value").agg(F.sum("_n").alias("_n"), F.max("_n").alias("_top"))
    labels = df.groupBy(quoted(label)).agg(F.count(F.lit(1)).alias("_n"))
    base = labels.agg(F.round(ratio(F.max("_n"), F.sum("_n")), 6)).first()[0]
    report = values.groupBy("column").agg(
        F.count(F.lit(1)).alias("n_distinct"),
        F.round(ratio(F.count(F.lit(1)), F.sum("_n")), 6).alias("distinct_share"),
        F.round(ratio(F.sum("_top"), F.sum("_n")), 6).alias("purity"),
    )
    report = report.withColumn("base_purity", F.lit(base))
    return report.select(
        "column",
        "n_distinct",
        "distinct_share",
        "purity",
        "base_purity",
        (F.col("distinct_share") >= max_distinct_share).alias("looks_like_key"),
        ((F.col("purity") >= min_purity) & (F.col("base_purity") < min_purity)).alias("gives_away_label"),
    )


def type_is_numeric(df: DataFrame, name: str) -> bool:
    return isinstance(type_of(df, name), NUMERIC)
