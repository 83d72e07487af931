"""Aggregate column helpers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def mean(column: str, exact_scale: int | None = None) -> Column:
    """Mean of a column, nulls skipped.

    With ``exact_scale`` (for values with a fixed number of decimals, such as
    money with 2) the sum is taken in DECIMAL, which is exact and therefore
    independent of partitioning, task order and retries; the exact sum is then
    divided by the count once in double precision. Without it this is ``avg``,
    whose floating-point sum may differ in the last bits between runs.
    """
    if exact_scale is None:
        return F.avg(column)
    total = F.sum(F.col(column).cast(f"decimal(18,{exact_scale})")).cast("double")
    return total / F.count(column)
