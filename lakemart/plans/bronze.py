"""Bronze load (G1): a dated CSV feed into date-partitioned Parquet.

The partition columns come from the *data's* date, not the clock, so one load
spreads the feed over its historical days. Text that is not a valid date
(``2024-02-30``, empty) gives null year/month/day and lands in Spark's default
partition instead of failing the load.

``append`` is the reference's mode: loading the same feed twice doubles every
day. ``replace_days=True`` swaps in dynamic partition overwrite so a re-run
replaces only the days present in the feed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import DateType, StructType, TimestampNTZType, TimestampType

from lakemart.functions.scalar import date_parts, safe_date
from lakemart.sources.evolving import append_evolving, is_evolving, read_evolving
from lakemart.sources.files import PARTITION_COLUMNS, read_csv, read_parquet
from lakemart.sources.sinks import write_partitioned


def add_date_partitions(df: DataFrame, date_col: str, fmt: str | None = None) -> DataFrame:
    """year / month / day columns from ``date_col``; bad text -> null. A date or
    timestamp column is used as it is, only text is parsed."""
    dt = df[date_col]
    if isinstance(df.schema[date_col].dataType, (DateType, TimestampType, TimestampNTZType)):
        dt = dt.cast("date")
    else:
        dt = safe_date(dt.cast("string"), fmt)
    return df.withColumns({name: c for name, c in date_parts(dt).items()})


def load_bronze(spark: SparkSession, source: str, out_path: str, date_col: str = "last_purchase_date",
                schema: StructType | str | None = None, replace_days: bool = False, evolving: bool = False) -> None:
    """Read one CSV feed (header, inferred types unless ``schema``) and append it
    to ``out_path`` partitioned by year/month/day. An ``evolving`` dataset takes feeds whose columns
    or types change (see :mod:`lakemart.sources.evolving`)."""
    df = read_csv(spark, source, header=True, infer=schema is None, schema=schema)
    bronze = add_date_partitions(df, date_col)
    if evolving:
        append_evolving(bronze, out_path, replace_days)
        return
    write_partitioned(bronze, out_path, mode="overwrite" if replace_days else "append",
                      columns=PARTITION_COLUMNS, dynamic_overwrite=replace_days)


def read_bronze(spark: SparkSession, path: str) -> DataFrame:
    """A bronze dataset, evolving or plain."""
    return read_evolving(spark, path) if is_evolving(spark, path) else read_parquet(spark, path)


def load_feeds(spark: SparkSession, sources: dict[str, str], out_root: str,
               date_col: str = "last_purchase_date",
               schema: StructType | str | None = None, evolving: bool = False) -> dict[str, str]:
    """Load several named feeds; returns table name -> bronze path."""
    out = {}
    for name, path in sources.items():
        target = f"{out_root.rstrip('/')}/{name}"
        load_bronze(spark, path, target, date_col, schema=schema, evolving=evolving)
        out[name] = target
    return out
