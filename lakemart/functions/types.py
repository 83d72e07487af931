"""Merging schemas: the common type of two, and a column of one type as another."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import (
    ArrayType, ByteType, DataType, DateType, DecimalType, DoubleType, FloatType, FractionalType, IntegerType, IntegralType,
    LongType, MapType, NullType, ShortType, StringType, StructField, StructType, TimestampNTZType, TimestampType,
)

#: Whole-number types by width, and the decimal digits each can hold.
WHOLE = [ByteType, ShortType, IntegerType, LongType]
DIGITS = {ByteType: 3, ShortType: 5, IntegerType: 10, LongType: 20}


def common_type(a: DataType, b: DataType) -> DataType:
    """The narrowest type that values of both can be cast to: whole numbers widen, whole numbers and
    decimals meet in a decimal that holds both (a double where 38 digits don't), either with a floating-point number in a
    double, dates and timestamps in the timestamp; structs field by field, arrays and maps by their items. What has
    no common form is text."""
    if a == b or isinstance(b, NullType):
        return a
    if isinstance(a, NullType):
        return b
    if isinstance(a, IntegralType) and isinstance(b, IntegralType):
        return max(a, b, key=lambda t: WHOLE.index(type(t)))
    if isinstance(a, (IntegralType, DecimalType)) and isinstance(b, (IntegralType, DecimalType)):
        parts = [(DIGITS[type(t)], 0) if isinstance(t, IntegralType) else (t.precision - t.scale, t.scale) for t in (a, b)]
        scale = max(p[1] for p in parts)
        digits = max(p[0] for p in parts) + scale
        return DecimalType(digits, scale) if digits <= 38 else DoubleType()
    numbers = (IntegralType, DecimalType, FractionalType)
    if isinstance(a, numbers) and isinstance(b, numbers):
        return FloatType() if isinstance(a, FloatType) and isinstance(b, FloatType) else DoubleType()
    times = (DateType, TimestampType, TimestampNTZType)
    if isinstance(a, times) and isinstance(b, times):
        return TimestampType() if TimestampType() in (a, b) else TimestampNTZType()
    if isinstance(a, StructType) and isinstance(b, StructType):
        return merge_schemas(a, b)
    if isinstance(a, ArrayType) and isinstance(b, ArrayType):
        return ArrayType(common_type(a.elementType, b.elementType))
    if isinstance(a, MapType) and isinstance(b, MapType) and a.keyType == b.keyType:
        return MapType(a.keyType, common_type(a.valueType, b.valueType))
    return StringType()


def merge_schemas(a: StructType, b: StructType) -> StructType:
    """The fields of ``a`` in their order, then those that only ``b`` has; a field of both gets their common type.
    Names are compared without case, the first spelling stays. All fields may be null."""
    others = {f.name.lower(): f for f in b.fields}
    out = []
    for f in a.fields:
        other = others.pop(f.name.lower(), None)
        out.append(StructField(f.name, common_type(f.dataType, other.dataType) if other else f.dataType))
    return StructType(out + [StructField(f.name, f.dataType) for f in b.fields if f.name.lower() in others])


def as_type(column: Column, own: DataType, wanted: DataType) -> Column:
    """``column`` (of type ``own``) as ``wanted``, a type that ``common_type`` made from ``own``: fields that it lacks are null."""
    if own == wanted:
        return column
    if isinstance(own, StructType) and isinstance(wanted, StructType):
        have = {f.name.lower(): f for f in own.fields}
        fields = []
        for f in wanted.fields:
            mine = have.get(f.name.lower())
            value = as_type(column.getField(mine.name), mine.dataType, f.dataType) if mine else F.lit(None).cast(f.dataType)
            fields.append(value.alias(f.name))
        return F.when(column.isNotNull(), F.struct(*fields))
    if isinstance(own, ArrayType) and isinstance(wanted, ArrayType):
        return F.transform(column, lambda v: as_type(v, own.elementType, wanted.elementType))
    if isinstance(own, MapType) and isinstance(wanted, MapType):
        return F.transform_values(column, lambda _, v: as_type(v, own.valueType, wanted.valueType))
    if isinstance(wanted, StringType) and isinstance(own, (StructType, ArrayType, MapType)):
        return F.to_json(column)
    return column.cast(wanted)
