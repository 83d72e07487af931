"""Unions and replication.

``union_by_name`` first brings both sides to one schema: equal types stay,
two numeric types widen, anything else becomes text. (Spark 4's ANSI coercion of
an int/text pair goes to BIGINT and fails on non-numeric text.)

``replicate`` builds n copies with one scan and a generator
(``explode(sequence(0, n-1))``) inside the same task, instead of an n-branch
union plan: no join, no broadcast, no shuffle.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (ByteType, DataType, DecimalType, DoubleType, FloatType, IntegerType,
                               LongType, NullType, ShortType, StringType)

_NUMERIC_ORDER = [ByteType, ShortType, IntegerType, LongType, FloatType, DoubleType]


def _rank(t: DataType) -> int | None:
    for i, cls in enumerate(_NUMERIC_ORDER):
        if isinstance(t, cls):
            return i
    if isinstance(t, DecimalType):
        return len(_NUMERIC_ORDER) - 1
    return None


def common_type(a: DataType, b: DataType) -> DataType:
    if a == b:
        return a
    if isinstance(a, NullType):
        return b
    if isinstance(b, NullType):
        return a
    ra, rb = _rank(a), _rank(b)
    if ra is not None and rb is not None:
        return _NUMERIC_ORDER[max(ra, rb)]()
    return StringType()


def union_by_name(left: DataFrame, right: DataFrame, allow_missing: bool = False) -> DataFrame:
    """Stack two frames matching columns by name; duplicates are kept."""
    lcols, rcols = left.columns, right.columns
    if not allow_missing and set(lcols) != set(rcols):
        raise ValueError(f"column sets differ: {sorted(set(lcols) ^ set(rcols))}")
    names = lcols + [c for c in rcols if c not in lcols]
    ltypes = {f.name: f.dataType for f in left.schema.fields}
    rtypes = {f.name: f.dataType for f in right.schema.fields}

    def aligned(df: DataFrame, own: dict[str, DataType]) -> DataFrame:
        cols = []
        for n in names:
            target = common_type(ltypes.get(n, NullType()), rtypes.get(n, NullType()))
            src = F.col(n) if n in own else F.lit(None)
            cols.append((src if own.get(n) == target else src.cast(target)).alias(n))
        return df.select(*cols)

    return aligned(left, ltypes).unionByName(aligned(right, rtypes))


def union_positional(*frames: DataFrame) -> DataFrame:
    """Stack frames by column position (names from the first); duplicates kept."""
    return reduce(lambda a, b: a.union(b), frames)


def replicate(df: DataFrame, times: int) -> DataFrame:
    """``times`` copies of every row (the original counts as one copy)."""
    if times < 1:
        raise ValueError("times must be >= 1")
    copy = F.explode(F.sequence(F.lit(0), F.lit(times - 1))).alias("_copy")
    return df.select("*", copy).drop("_copy")
