"""Types that widen: what holds the values of two types, and tables brought to such types.

    byte < short < int < long < decimal < double < text      float < double      date < timestamp < text

Integers and decimals meet in a decimal with room for both; where that needs more than 38 digits, in double.  Anything
else that differs meets in text.  Decimals and longs of more than 15 digits lose digits in a column that has become double.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_WHOLE: dict[type[T.DataType], int] = {T.ByteType: 3, T.ShortType: 5, T.IntegerType: 10, T.LongType: 19}
_TIMES = (T.DateType, T.TimestampNTZType, T.TimestampType)


def wider(a: T.DataType, b: T.DataType) -> T.DataType:
    """The least type of the order above that holds both."""
    if a == b:
        return a
    kinds = {type(a), type(b)}
    if T.NullType in kinds:
        return b if isinstance(a, T.NullType) else a
    if kinds <= set(_WHOLE):
        return max((a, b), key=lambda t: _WHOLE[type(t)])
    if kinds <= {*_WHOLE, T.DecimalType}:
        (p, s), (q, r) = [(t.precision, t.scale) if isinstance(t, T.DecimalType) else (_WHOLE[type(t)], 0) for t in (a, b)]
        digits = max(p - s, q - r) + max(s, r)
        return T.DecimalType(digits, max(s, r)) if digits <= 38 else T.DoubleType()
    if kinds <= {*_WHOLE, T.DecimalType, T.FloatType, T.DoubleType}:
        return T.DoubleType()
    if kinds <= set(_TIMES):
        return max((a, b), key=lambda t: _TIMES.index(type(t)))
    return T.StringType()


def unify(schemas: list[T.StructType]) -> T.StructType:
    """All columns of the schemas, in the order of their first appearance and under its spelling, in types that hold all of them."""
    found: dict[str, T.StructField] = {}
    for schema in schemas:
        for f in schema.fields:
            key = f.name.lower()
            held = found.get(key)
            found[key] = T.StructField(held.name, wider(held.dataType, f.dataType)) if held else T.StructField(f.name, f.dataType)
    return T.StructType(list(found.values()))


def widened(before: T.StructType, after: T.StructType) -> list[tuple[str, str]]:
    """(column, new type) of the columns whose type has changed."""
    old = {f.name.lower(): f.dataType for f in before.fields}
    return [(f.name, f.dataType.simpleString()) for f in after.fields if old.get(f.name.lower(), f.dataType) != f.dataType]


def as_type(column: Column, have: T.DataType, want: T.DataType) -> Column:
    """``column`` cast upwards; doubles that hold a whole number are written without a fraction as text."""
    if have == want:
        return column
    if isinstance(want, T.StringType) and isinstance(have, (T.FloatType, T.DoubleType)):
        whole = (column == F.floor(column)) & (F.abs(column) < 1e15)
        return F.when(whole, column.cast("long").cast("string")).otherwise(column.cast("string"))
    return column.cast(want)


def conform(df: DataFrame, schema: T.StructType, keys: list[str]) -> DataFrame:
    """``df`` in the columns of ``schema``, matched whatever their case, missing ones null, and the ``keys`` as they are."""
    have = {f.name.lower(): f for f in df.schema.fields}
    columns = []
    for f in schema.fields:
        own = have.get(f.name.lower())
        value = as_type(F.col(f"`{own.name}`"), own.dataType, f.dataType) if own else F.lit(None).cast(f.dataType)
        columns.append(value.alias(f.name))
    return df.select(*columns, *keys)


def hold_to(df: DataFrame, contract: T.StructType) -> DataFrame:
    """``df`` with the contract's columns in its types; ``__record`` holds the row as JSON where they don't hold a value, else null.

    A value is held if it comes back the same from the contract's type; text, if it can be cast.
    """
    wanted = {f.name.lower(): f.dataType for f in contract.fields}
    bad, columns = F.lit(False), []
    for f in df.schema.fields:
        value, want = F.col(f"`{f.name}`"), wanted.get(f.name.lower(), f.dataType)
        if want == f.dataType:
            columns.append(value)
            continue
        cast = value.try_cast(want)
        lost = cast.isNull() if isinstance(f.dataType, T.StringType) else ~cast.try_cast(f.dataType).eqNullSafe(value)
        bad = bad | value.isNotNull() & lost
        columns.append(cast.alias(f.name))
    record = F.when(bad, F.to_json(F.struct(*[F.col(f"`{c}`") for c in df.columns])))
    return df.select(*columns, record.alias("__record"))
