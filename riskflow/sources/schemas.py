"""One schema for files that disagree: the widest type of each column, text where nothing else fits."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskflow.functions.columns import quoted

# integer types from narrow to wide, with their decimal digits
_WHOLE = {T.ByteType: 3, T.ShortType: 5, T.IntegerType: 10, T.LongType: 19}
_ORDER = list(_WHOLE)
_FLOATING = (T.FloatType, T.DoubleType)


def widest(one: T.DataType, other: T.DataType) -> T.DataType:
    """A type that holds the values of both.

    Truth values widen to numbers (1 and 0), whole numbers to longer ones, to decimals and to
    doubles (which round beyond 2^53), dates to timestamps. Structs keep all fields, arrays
    widen their elements. Everything else becomes text.
    """
    if one == other or isinstance(other, T.NullType):
        return one
    if isinstance(one, T.NullType):
        return other
    for a, b in ((one, other), (other, one)):
        if isinstance(a, T.BooleanType) and (type(b) in _WHOLE or isinstance(b, (*_FLOATING, T.DecimalType))):
            return b
        if isinstance(a, T.DecimalType) and type(b) in _WHOLE:
            whole = max(a.precision - a.scale, _WHOLE[type(b)])
            return T.DecimalType(whole + a.scale, a.scale) if whole + a.scale <= 38 else T.StringType()
        if isinstance(a, _FLOATING) and (type(b) in _WHOLE or isinstance(b, (*_FLOATING, T.DecimalType))):
            return T.DoubleType()
        if isinstance(a, T.DateType) and isinstance(b, (T.TimestampType, T.TimestampNTZType)):
            return b
    if type(one) in _WHOLE and type(other) in _WHOLE:
        return max(one, other, key=lambda kind: _ORDER.index(type(kind)))
    if isinstance(one, T.DecimalType) and isinstance(other, T.DecimalType):
        scale = max(one.scale, other.scale)
        whole = max(one.precision - one.scale, other.precision - other.scale)
        return T.DecimalType(whole + scale, scale) if whole + scale <= 38 else T.StringType()
    if isinstance(one, T.StructType) and isinstance(other, T.StructType):
        return merge(one, other)
    if isinstance(one, T.ArrayType) and isinstance(other, T.ArrayType):
        return T.ArrayType(widest(one.elementType, other.elementType))
    return T.StringType()


def merge(one: T.StructType, other: T.StructType) -> T.StructType:
    """The fields of both, in the order they are first seen."""
    kinds: dict[str, T.DataType] = {}
    for field in [*one, *other]:
        kinds[field.name] = widest(kinds[field.name], field.dataType) if field.name in kinds else field.dataType
    return T.StructType([T.StructField(name, kind) for name, kind in kinds.items()])


def converted(value: Column, kind: T.DataType, target: T.DataType) -> Column:
    """A value in a type that widest() gave; nested values become JSON text, bytes base64 text."""
    if kind == target:
        return value
    if isinstance(target, T.StringType):
        if isinstance(kind, (T.StructType, T.ArrayType, T.MapType)):
            return F.to_json(value)
        return F.base64(value) if isinstance(kind, T.BinaryType) else value.cast("string")
    if isinstance(target, T.StructType):
        own = {f.name: f.dataType for f in kind}
        fields = [
            (converted(value.getField(f.name), own[f.name], f.dataType) if f.name in own else F.lit(None).cast(f.dataType)).alias(f.name)
            for f in target
        ]
        return F.when(value.isNotNull(), F.struct(*fields))
    if isinstance(target, T.ArrayType):
        return F.transform(value, lambda x: converted(x, kind.elementType, target.elementType))
    return value.cast(target)


def conform(df: DataFrame, target: T.StructType) -> DataFrame:
    """The rows with exactly the columns of ``target``; columns they lack are null."""
    own = {f.name: f.dataType for f in df.schema}
    return df.select(
        *[
            (converted(F.col(quoted(f.name)), own[f.name], f.dataType) if f.name in own else F.lit(None).cast(f.dataType)).alias(f.name)
            for f in target
        ]
    )
