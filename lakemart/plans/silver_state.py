"""Silver kept up day by day, without reading older bronze days again.

The state of a silver dataset holds, by day directories,

* ``rows``: the joined, validated rows of the day, before rank, mean and de-duplication,
* ``counts``: for each (country, order value) the number of rows, from which ranks are merged, and the exact sum
  and the number of the incomes, from which the mean is merged.

``update_days`` reads the bronze directories of the new days and nothing else, and replaces those days in the
state, so a day can be loaded again. ``silver_from_state`` gives the same silver as a full build over all days
so far: days' counts are added up, ranked as pairs and joined to the rows.

The feeds are joined within a day: both are cut by the same purchase date, so an info row and
the activity row of one purchase lie in the same day. (A full build also pairs a user's rows of different days.)

A new day moves ranks of earlier rows: those of a country in which a new value is higher. ``changed_days`` names the days that
hold such rows, or rows of users that came again, and ``publish_days`` rewrites them in a published dataset. The mean
is one value that changes with nearly every load; a published dataset leaves it out unless ``with_mean`` is
asked for with all days.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakemart.functions.scalar import lower_text, title_case
from lakemart.operators.enrich import join_on_key, keep_one_per_key, rank_pairs, with_ranks
from lakemart.operators.rules import Rule, shopper_rules, validate
from lakemart.plans.bronze import read_bronze
from lakemart.plans.silver import DEDUP_ORDER
from lakemart.session import cut_lineage
from lakemart.sources.evolving import path_exists
from lakemart.sources.files import PARTITION_COLUMNS, date_range
from lakemart.sources.sinks import write_partitioned

DAYS = list(PARTITION_COLUMNS)
COUNTRY, VALUE, INCOME = "country", "average_order_value", "income_level"


def _in_range(start: str | None, end: str | None, undated: bool):
    """Days of a range; rows without a date are a day of their own, before all others."""
    inside = date_range(start, end)
    no_day = F.col("year").isNull()
    return inside | no_day if undated else inside & ~no_day


def joined_days(info: DataFrame, activity: DataFrame, key: str = "user_id") -> DataFrame:
    """The feeds joined on the key within each day (rows without a date among themselves)."""
    day = F.concat_ws("-", *DAYS).alias("_day")
    right = activity.select(day, *[c for c in activity.columns if c not in (*DAYS, "last_purchase_date")])
    return join_on_key(info.select("*", day), right, [key, "_day"]).drop("_day")


def update_days(spark: SparkSession, info_path: str, activity_path: str, state_path: str, start: str | None = None,
                end: str | None = None, undated: bool | None = None, key: str = "user_id",
                rules: list[Rule] | None = None, income_scale: int = 2) -> None:
    """Bring the state up to date with the bronze days from ``start`` to ``end`` (``yyyy-MM-dd``, inclusive, either may be
    None). ``undated`` also loads the rows without a date, which is done where there is no ``start`` unless it is given."""
    undated = start is None if undated is None else undated
    wanted = _in_range(start, end, undated)
    joined = joined_days(read_bronze(spark, info_path).filter(wanted), read_bronze(spark, activity_path).filter(wanted), key)
    valid = cut_lineage(validate(joined, rules if rules is not None else shopper_rules(key)), "state-valid")
    counts = valid.groupBy(*DAYS, COUNTRY, VALUE).agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.col(INCOME).cast(f"decimal(18,{income_scale})")).alias("income"),
        F.count(INCOME).alias("n_income"))
    for name, frame in (("counts", counts), ("rows", valid)):
        path = f"{state_path.rstrip('/')}/{name}"
        if path_exists(spark, path):
            _drop_emptied(spark, path, spark.read.schema(frame.schema).parquet(path).filter(wanted).select(*DAYS), valid)
        write_partitioned(frame, path, mode="overwrite", columns=DAYS, dynamic_overwrite=True)


def _drop_emptied(spark: SparkSession, path: str, days: DataFrame, rows: DataFrame) -> None:
    """Remove those of ``days`` that have no row in ``rows`` any more (a row for each of them goes to the driver)."""
    old, new = days.distinct(), rows.select(*[F.col(c).alias(f"_{c}") for c in DAYS]).distinct()
    same = [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in DAYS]
    for day in old.join(new, same, "left_anti").collect():
        names = [f"{c}={'__HIVE_DEFAULT_PARTITION__' if day[c] is None else day[c]}" for c in DAYS]
        folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path("/".join([path.rstrip("/"), *names]))
        folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)


def _part(spark: SparkSession, state_path: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{state_path.rstrip('/')}/{name}")


def current_mean(spark: SparkSession, state_path: str) -> DataFrame:
    """One row: ``avg_global_income`` over the valid rows of all days."""
    return _part(spark, state_path, "counts").agg((F.sum("income").cast("double") / F.sum("n_income")).alias("avg_global_income"))


def current_ranks(spark: SparkSession, state_path: str) -> DataFrame:
    """``(country, average_order_value, rank_in_country)`` over all days."""
    pairs = _part(spark, state_path, "counts").groupBy(COUNTRY, VALUE).agg(F.sum("n").alias("n"))
    return rank_pairs(cut_lineage(pairs, "state-pairs"), COUNTRY, VALUE, "n", "rank_in_country")


def silver_from_state(spark: SparkSession, state_path: str, key: str = "user_id", with_mean: bool = True) -> DataFrame:
    """The silver rows of all days so far."""
    rows = with_ranks(_part(spark, state_path, "rows"), current_ranks(spark, state_path), COUNTRY, VALUE, "rank_in_country")
    if with_mean:
        rows = rows.withColumn("avg_global_income", current_mean(spark, state_path).scalar())
    one = keep_one_per_key(rows, key, DEDUP_ORDER)
    return (one.withColumn("preferred_payment_method", lower_text("preferred_payment_method"))
               .withColumn("country", title_case("country")))


def changed_days(spark: SparkSession, state_path: str, start: str | None = None, end: str | None = None,
                 key: str = "user_id") -> DataFrame:
    """``(year, month, day, n_rows)`` of the days outside the given range whose rows have another rank, or another place in
    the de-duplication, because of the days inside it: the values of a country below the highest new one
    (nulls rank last), and the rows of users that the new days hold."""
    new, rows = date_range(start, end) & F.col("year").isNotNull(), _part(spark, state_path, "rows")
    old = rows.filter(~F.coalesce(new, F.lit(False)))
    high = (_part(spark, state_path, "counts").filter(new & F.col(VALUE).isNotNull())
            .groupBy(F.col(COUNTRY).alias("_country")).agg(F.max(VALUE).alias("_high")))
    users = rows.filter(new).select(F.col(key).alias("_user")).distinct()
    hit = (old.select(*DAYS, key, COUNTRY, VALUE).join(high, F.col(COUNTRY).eqNullSafe(F.col("_country")), "left")
           .join(users, F.col(key) == F.col("_user"), "left"))
    moved = F.col("_high").isNotNull() & (F.col(VALUE).isNull() | (F.col(VALUE) < F.col("_high")))
    return hit.filter(moved | F.col("_user").isNotNull()).groupBy(*DAYS).agg(F.count(F.lit(1)).alias("n_rows"))


def publish_days(spark: SparkSession, state_path: str, out_path: str, start: str | None = None, end: str | None = None,
                 key: str = "user_id") -> DataFrame:
    """Rewrite the new days and the changed ones of a published silver dataset (without the mean), all others keep
    their files; its read-back. The first call writes all days."""
    silver = silver_from_state(spark, state_path, key, with_mean=False)
    if path_exists(spark, out_path):
        inside = F.coalesce(date_range(start, end), F.lit(False))
        days = changed_days(spark, state_path, start, end, key).select(*DAYS).unionByName(
            spark.read.parquet(out_path).filter(inside).select(*DAYS)).unionByName(silver.filter(inside).select(*DAYS))
        days = cut_lineage(days.distinct(), "state-days")
        other = days.select(*[F.col(c).alias(f"_{c}") for c in DAYS])
        silver = cut_lineage(silver.join(other, [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in DAYS], "left_semi"), "state-publish")
        _drop_emptied(spark, out_path, days, silver)
    write_partitioned(silver, out_path, mode="overwrite", columns=DAYS, dynamic_overwrite=True)
    return spark.read.parquet(out_path)
