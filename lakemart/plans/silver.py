"""Silver build (G2): join the two bronze feeds, validate, rank spend inside
country, add the global mean income, keep one row per user, normalise text.

Order is part of the contract: the rank and the global mean see the rows
*before* de-duplication, and the country is ranked on its raw text and only
title-cased at the end (so ``france`` and ``FRANCE`` are ranked apart).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakemart.functions.scalar import lower_text, title_case
from lakemart.operators.enrich import join_on_key, keep_one_per_key, rank_within, with_global_mean
from lakemart.operators.rules import Rule, shopper_rules, validate
from lakemart.plans.bronze import read_bronze
from lakemart.session import cut_lineage, qualified
from lakemart.sources.files import PARTITION_COLUMNS, date_range
from lakemart.sources.sinks import write_partitioned

# Columns of the second feed that the first feed already carries.
ACTIVITY_DROP = ("year", "month", "day", "last_purchase_date")

DEDUP_ORDER = ["last_purchase_date desc", "rank_in_country"]


def join_feeds(info: DataFrame, activity: DataFrame, key: str = "user_id") -> DataFrame:
    """Inner join of the feeds on the key; the date columns come from ``info``."""
    return join_on_key(info, activity, key, how="inner", drop_right=list(ACTIVITY_DROP))


def ranked_rows(info: DataFrame, activity: DataFrame, key: str = "user_id",
                rules: list[Rule] | None = None, rank_method: str = "ranged",
                materialize: bool = False, dedup_first: bool = False) -> tuple[DataFrame, DataFrame]:
    """(valid rows, valid rows with ``rank_in_country``), before de-duplication.

    With ``materialize`` the valid rows are written once to the shared
    checkpoint folder: the rank, the global mean and the output all read them,
    so the inputs are scanned and joined once instead of once per branch.
    ``dedup_first`` keeps one row per key before the rank, so that repeated
    users leave no gaps in it (the contract's order is to rank first).
    """
    valid = validate(join_feeds(info, activity, key), rules if rules is not None else shopper_rules(key))
    if dedup_first:
        valid = keep_one_per_key(valid, key, DEDUP_ORDER[:1])
    if materialize:
        valid = cut_lineage(valid, "silver-valid")
    ranked = rank_within(valid, "country", "average_order_value", "rank_in_country",
                         descending=True, method=rank_method)
    return valid, ranked


def silver_transform(info: DataFrame, activity: DataFrame, key: str = "user_id",
                     rules: list[Rule] | None = None, rank_method: str = "ranged",
                     materialize: bool = True, income_scale: int | None = None,
                     dedup_first: bool = False) -> DataFrame:
    """The valid rows are written, and the rank's boundary values computed, when
    this is called; the result itself is lazy. ``income_scale``: decimals of the income column (2 for money) to take
    its global mean from an exact sum; None averages the doubles as they are."""
    valid, ranked = ranked_rows(info, activity, key, rules, rank_method, materialize, dedup_first)
    with_mean = with_global_mean(ranked, "income_level", "avg_global_income", source=valid,
                                 exact_scale=income_scale)
    one = keep_one_per_key(with_mean, key, DEDUP_ORDER)
    return (one.withColumn("preferred_payment_method", lower_text("preferred_payment_method"))
               .withColumn("country", title_case("country")))


def build_silver(spark: SparkSession, info_path: str, activity_path: str, out_path: str,
                 key: str = "user_id", rank_method: str = "ranged",
                 income_scale: int | None = None, start: str | None = None,
                 end: str | None = None, dedup_first: bool = False) -> DataFrame:
    """Read both bronze datasets, transform, overwrite the silver dataset
    (partitioned by the date columns when present) and return its read-back.

    ``start`` / ``end`` (``yyyy-MM-dd``, inclusive) rewrite only the silver days in
    that range; all other days keep their files. Rank and mean are still taken over all
    bronze days, as in a full build.
    """
    out = qualified(spark, out_path)
    for p in (info_path, activity_path):
        own = qualified(spark, p)
        if own == out or own.startswith(out + "/") or out.startswith(own + "/"):
            raise ValueError("silver output must not overwrite, hold or lie in one of its inputs")
    silver = silver_transform(read_bronze(spark, info_path), read_bronze(spark, activity_path),
                              key=key, rank_method=rank_method, income_scale=income_scale, dedup_first=dedup_first)
    parts = [c for c in PARTITION_COLUMNS if c in silver.columns]
    ranged = bool(start or end)
    if ranged and len(parts) < len(PARTITION_COLUMNS):
        raise ValueError("a range of days needs the date columns")
    if ranged:
        silver = silver.filter(date_range(start, end))
    if parts:
        write_partitioned(silver, out_path, mode="overwrite", columns=parts, dynamic_overwrite=ranged)
    else:
        silver.write.mode("overwrite").parquet(out_path)
    return spark.read.parquet(out_path)


def with_date_parts(df: DataFrame, date_col: str = "last_purchase_date") -> DataFrame:
    """The bronze partition columns derived from the data's own date."""
    d = F.col(date_col)
    return df.withColumns({"year": F.year(d), "month": F.month(d), "day": F.dayofmonth(d)})
