"""How a table's schema may change from one write to the next.

A column may come and go, and its type may widen: whole numbers to longer ones, to
decimals or (up to int) to double, decimals to more digits, dates to timestamps
without a zone, and every simple type to text. All else is refused.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_WHOLE = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
#: Digits of each whole-number type.
_DIGITS = {T.ByteType: 3, T.ShortType: 5, T.IntegerType: 10, T.LongType: 20}
_COMPLEX = (T.ArrayType, T.MapType, T.StructType, T.BinaryType, T.VariantType)
_MOST_DIGITS = 38


class SchemaConflict(ValueError):
    """A column's new type and its stored type have no common wider type."""


def wider(a: T.DataType, b: T.DataType) -> T.DataType | None:
    """The narrowest type that holds all values of both, None if there is none."""
    if a == b:
        return a
    kinds = (type(a), type(b))
    if T.NullType in kinds:
        return b if isinstance(a, T.NullType) else a
    if any(isinstance(x, _COMPLEX) for x in (a, b)):
        return None
    if all(k in _WHOLE for k in kinds):
        return max(a, b, key=lambda x: _WHOLE.index(type(x)))
    if all(isinstance(x, T.DecimalType) or type(x) in _DIGITS for x in (a, b)):
        (left, scale_a), (right, scale_b) = (_decimal(x) for x in (a, b))
        scale, digits = max(scale_a, scale_b), max(left, right) + max(scale_a, scale_b)
        return T.DecimalType(digits, scale) if digits <= _MOST_DIGITS else T.StringType()
    if all(isinstance(x, T.FractionalType) and not isinstance(x, T.DecimalType) or type(x) in _WHOLE[:3] for x in (a, b)):
        return T.DoubleType()
    if set(kinds) == {T.DateType, T.TimestampNTZType}:
        return T.TimestampNTZType()
    return T.StringType()


def _decimal(x: T.DataType) -> tuple[int, int]:
    """Digits before and after the point."""
    return (x.precision - x.scale, x.scale) if isinstance(x, T.DecimalType) else (_DIGITS[type(x)], 0)


def widened(stored: T.StructType, new: T.StructType) -> T.StructType:
    """The columns of ``new``, each with a type that also holds what is stored."""
    had = {f.name: f.dataType for f in stored}
    out = T.StructType()
    for f in new:
        kind = wider(had.get(f.name, f.dataType), f.dataType)
        if kind is None:
            raise SchemaConflict(f"column {f.name} is stored as {had[f.name].simpleString()} and can't become {f.dataType.simpleString()}")
        out.add(f.name, kind, True)
    return out


def same_types(stored: T.StructType, wanted: T.StructType) -> bool:
    """Whether files written with ``stored`` can be read with ``wanted``: common columns have one type."""
    had = {f.name: f.dataType for f in stored}
    return all(had.get(f.name, f.dataType) == f.dataType for f in wanted)


def cast_to(df: DataFrame, schema: T.StructType) -> DataFrame:
    """The columns of ``schema`` in its types, missing ones as NULL; ``df`` itself where nothing changes."""
    if df.columns == schema.names and all(a.dataType == b.dataType for a, b in zip(df.schema, schema)):
        return df
    have = set(df.columns)
    return df.select(*[(F.col(f.name) if f.name in have else F.lit(None)).cast(f.dataType).alias(f.name) for f in schema])
