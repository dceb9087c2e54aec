"""Column expressions shared by the operators. All are built-in functions, so they stay in codegen."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

FRACTIONAL = (T.FloatType, T.DoubleType)
NUMERIC = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType, T.DecimalType)


def require(df: DataFrame, cols: Sequence[str]) -> None:
    """Stop with the names that are absent."""
    absent = [c for c in cols if c not in df.columns]
    if absent:
        raise ValueError(f"columns not found: {', '.join(absent)}; the table has {', '.join(df.columns)}")


def type_of(df: DataFrame, name: str) -> T.DataType:
    return df.schema[name].dataType


def quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def is_missing(df: DataFrame, name: str) -> Column:
    """Null, or NaN in a floating-point column."""
    value = F.col(quoted(name))
    if isinstance(type_of(df, name), FRACTIONAL):
        return value.isNull() | F.isnan(value)
    return value.isNull()


def known(df: DataFrame, name: str) -> Column:
    """The value, with NaN turned into null."""
    value = F.col(quoted(name))
    if isinstance(type_of(df, name), FRACTIONAL):
        return F.when(~F.isnan(value), value)
    return value


def any_positive(df: DataFrame, cols: Sequence[str]) -> Column:
    """True when one count is above zero; unknown when none is and one is missing."""
    require(df, cols)
    return reduce(lambda a, b: a | b, [known(df, c) > 0 for c in cols])


def all_of(conditions: Sequence[Column]) -> Column:
    return reduce(lambda a, b: a & b, conditions, F.lit(True))


def count_if(condition: Column) -> Column:
    """Rows for which the condition is true; 0 over no rows."""
    return F.count(F.when(condition, F.lit(1)))


def ratio(numerator: Column, denominator: Column, default: float | None = 0.0) -> Column:
    """Quotient, or ``default`` when the denominator is 0."""
    quotient = F.try_divide(numerator.cast("double"), denominator.cast("double"))
    return quotient if default is None else F.coalesce(quotient, F.lit(default))


def key_hash(key: Column, seed: int) -> Column:
    """MD5 text of a key and a seed: the same in every run and every engine."""
    return F.md5(F.concat(key.cast("string"), F.lit(f"|{seed}")).cast("binary"))


def hash_slot(key: Column, seed: int, slots: int = 10_000) -> Column:
    """Slot 0..slots-1 of a key, from the first 32 bits of its hash."""
    leading = F.conv(F.substring(key_hash(key, seed), 1, 8), 16, 10).cast("bigint")
    return F.pmod(leading, F.lit(slots))


def logistic(margin: Column) -> Column:
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-margin))


def linear(intercept: float, terms: dict[str, float]) -> Column:
    """intercept + sum of coefficient * column."""
    return reduce(lambda a, b: a + b, [F.col(quoted(c)) * F.lit(float(w)) for c, w in terms.items()], F.lit(float(intercept)))
