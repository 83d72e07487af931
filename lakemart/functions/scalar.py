"""Scalar column functions (X1-X12), all built-in Spark expressions.

Each helper returns a ``Column`` so it stays inside whole-stage codegen; none of
them needs a Python worker. The 4.x ANSI traps are handled here once: bad dates,
out-of-range array indexes and non-numeric text become null instead of failing
the task.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, StringType


def _c(col: str | Column) -> Column:
    return F.col(col) if isinstance(col, str) else col


def safe_date(col: str | Column, fmt: str | None = None) -> Column:
    """Text (or timestamp) to DATE; malformed text such as ``2024-02-30`` gives null."""
    c = _c(col)
    return F.try_to_date(c, F.lit(fmt)) if fmt else F.try_to_date(c)


def date_parts(col: str | Column) -> dict[str, Column]:
    """year / month / day-of-month of a date, as INT columns (null date -> nulls)."""
    c = _c(col)
    return {"year": F.year(c), "month": F.month(c), "day": F.dayofmonth(c)}


def lower_text(col: str | Column) -> Column:
    return F.lower(_c(col))


def title_case(col: str | Column) -> Column:
    """First letter of every space-separated word upper, the rest lower."""
    return F.initcap(_c(col))


def concat_cols(*parts: Column) -> Column:
    """``concat`` over ready-made columns; null if any input is null."""
    return F.concat(*parts)


def split_item(col: str | Column, separator_regex: str, index: int) -> Column:
    """Item ``index`` (0-based) of the split; null when missing, never an error."""
    return F.get(F.split(_c(col), separator_regex), F.lit(index))


def array_item(col: str | Column, index: int) -> Column:
    """Element ``index`` (0-based) of an array; null when out of range or null."""
    return F.get(_c(col), F.lit(index))


def floor_to(col: str | Column, step: int) -> Column:
    """Floor to a multiple of ``step`` (floors negatives, like Python's ``//``)."""
    return (F.floor(_c(col) / F.lit(step)) * F.lit(step)).cast("int")


def as_number(col: str | Column, dtype: DataType, target: str = "double") -> Column:
    """Numeric view of a column: text goes through ``try_cast`` so junk is null."""
    c = _c(col)
    if isinstance(dtype, StringType):
        return c.try_cast(target)
    return c
