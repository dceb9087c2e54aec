"""Header clean-up, projection, filters and row cleaning."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskflow.functions.columns import all_of, any_positive, count_if, is_missing, quoted, ratio, require


def rename(df: DataFrame, mapping: Mapping[str, str]) -> DataFrame:
    """Rename columns; names that are absent are ignored."""
    return df.withColumnsRenamed(dict(mapping))


def normalized_names(names: Sequence[str], extra: bool = True) -> list[str]:
    """Trimmed, lower-case names with ``_`` for blanks.

    With ``extra``, runs of other non-word characters become one ``_`` too, and
    repeated names get ``_2``, ``_3``, since a table cannot hold a name twice.
    """
    fixed = [name.strip().replace(" ", "_").lower() for name in names]
    if not extra:
        return fixed
    fixed = [re.sub(r"_+", "_", re.sub(r"\W+", "_", name)).strip("_") or "column" for name in fixed]
    taken: set[str] = set()
    unique = []
    for name in fixed:
        candidate, n = name, 1
        while candidate in taken:
            n += 1
            candidate = f"{name}_{n}"
        taken.add(candidate)
        unique.append(candidate)
    return unique


def normalize_header(df: DataFrame, extra: bool = True) -> DataFrame:
    return df.toDF(*normalized_names(df.columns, extra))


def select_columns(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Keep a fixed list of columns; further input columns are ignored."""
    require(df, cols)
    return df.select(*[quoted(c) for c in cols])


def drop_columns(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    return df.drop(*cols)


def where_any_positive(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    return df.where(any_positive(df, cols))


def with_binary_label(df: DataFrame, cols: Sequence[str], out: str = "label") -> DataFrame:
    """1 when a count is above zero, else 0, also when that is unknown."""
    return df.withColumn(out, F.when(any_positive(df, cols), F.lit(1)).otherwise(F.lit(0)))


def drop_missing(
    df: DataFrame, cols: Sequence[str] | None = None, how: str = "any", thresh: int | None = None
) -> DataFrame:
    """Drop rows with missing values.

    The common case (any) is written as plain ``IS NOT NULL`` tests, which reach the
    Parquet reader; ``na.drop`` hides them in one opaque test.
    """
    names = list(cols) if cols is not None else df.columns
    require(df, names)
    present = [~is_missing(df, c) for c in names]
    if thresh is not None:
        enough = sum((F.when(p, 1).otherwise(0) for p in present), F.lit(0))
        return df.where(enough >= thresh)
    if how == "all":
        nothing = all_of([is_missing(df, c) for c in names])
        return df.where(~nothing) if names else df
    if how != "any":
        raise ValueError(f"how must be 'any' or 'all', not {how!r}")
    return df.where(all_of(present)) if names else df


def to_numeric(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Cast to double; text that is no number becomes null."""
    require(df, cols)
    return df.withColumns({c: F.col(quoted(c)).try_cast("double") for c in cols})


def as_category(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Cast to string, so that values are labels and not amounts."""
    require(df, cols)
    return df.withColumns({c: F.col(quoted(c)).cast("string") for c in cols})


def with_correct(df: DataFrame, label: str, prediction: str, out: str = "correct") -> DataFrame:
    """1 when label and prediction are equal, else 0."""
    return df.withColumn(out, F.when(F.col(label) == F.col(prediction), F.lit(1)).otherwise(F.lit(0)))


def row_count(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("n_rows"))


def positive_rate(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Rows, positive rows and their share in percent, in one pass; null rate over no rows."""
    positives = count_if(any_positive(df, cols))
    rows = F.count(F.lit(1))
    return df.agg(
        rows.alias("n_rows"),
        positives.alias("n_positive"),
        F.round(F.try_divide(positives * F.lit(100.0), rows), 4).alias("positive_pct"),
    )


def reduction_summary(df: DataFrame, cols: Sequence[str], label_cols: Sequence[str]) -> DataFrame:
    """Rows and positives before and after dropping rows with missing values, in one scan."""
    require(df, cols)
    complete = all_of([~is_missing(df, c) for c in cols])
    positive = any_positive(df, label_cols)
    counts = df.agg(
        F.count(F.lit(1)).alias("rows_before"),
        count_if(complete).alias("rows_after"),
        count_if(positive).alias("positives_before"),
        count_if(positive & complete).alias("positives_after"),
    )
    return counts.select(
        "*",
        _share("rows_after", "rows_before", "rows_kept"),
        _share("positives_after", "positives_before", "positives_kept"),
        _share("positives_before", "rows_before", "rate_before"),
        _share("positives_after", "rows_after", "rate_after"),
    )


def _share(part: str, whole: str, out: str) -> Column:
    return F.round(ratio(F.col(part), F.col(whole), default=None), 6).alias(out)
