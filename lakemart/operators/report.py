"""Age profile report (A2-A4, G5) over a whole mart.

Pandas semantics kept: null ages are not a group, null values are skipped by the
mean, buckets floor to multiples of ten (``-1`` goes to ``-10``). Both bucket
means come from one aggregation pass.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakemart.functions.aggregate import mean
from lakemart.functions.scalar import floor_to


def age_histogram(df: DataFrame, age: str = "age") -> DataFrame:
    """Frequency of each age, ascending by age."""
    return (df.filter(F.col(age).isNotNull())
              .groupBy(age).agg(F.count(F.lit(1)).alias("n"))
              .orderBy(age))


def age_bucket_means(df: DataFrame, columns: list[str], age: str = "age", step: int = 10,
                     exact_scales: dict[str, int] | None = None) -> DataFrame:
    """Mean of each of ``columns`` per ``age_bucket`` (one pass, ascending buckets).
    ``exact_scales`` names columns with a fixed number of decimals whose sums are
    taken exactly (see :func:`lakemart.functions.aggregate.mean`)."""
    scales = exact_scales or {}
    bucketed = df.select(floor_to(age, step).alias("age_bucket"), *columns)
    return (bucketed.filter(F.col("age_bucket").isNotNull())
                    .groupBy("age_bucket")
                    .agg(*[mean(c, scales.get(c)).alias(f"mean_{c}") for c in columns])
                    .orderBy("age_bucket"))
