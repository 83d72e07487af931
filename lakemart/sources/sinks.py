"""Writers (K1-K6).

Partitioned writes ask AQE to *rebalance* on the partition columns instead of
funnelling the data through one task (``repartition(1)``) or through one task per
day (``repartition(year, month, day)``): rebalancing clusters each day into few
files but splits a day that is too large across several tasks, so a day holding
a third of all rows does not become one straggler.

Coalescing of small shuffle partitions is switched off for the duration of a
partitioned write: every day hashes to one reducer whatever the reducer count,
so coalescing cannot reduce the number of files, it only serialises the file
writes of many small days into a few tasks.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from lakemart.session import scoped_conf
from lakemart.sources.files import PARTITION_COLUMNS


def _rebalanced(df: DataFrame, columns: tuple[str, ...] | list[str]) -> DataFrame:
    return df.hint("rebalance", *columns) if columns else df.hint("rebalance")


def write_partitioned(df: DataFrame, path: str, mode: str = "append",
                      columns: tuple[str, ...] | list[str] = PARTITION_COLUMNS,
                      dynamic_overwrite: bool = False) -> None:
    """Parquet partitioned by ``columns`` (K1 append, K2 overwrite).

    ``append`` keeps earlier data: loading the same day twice doubles its rows.
    ``overwrite`` replaces the whole dataset unless ``dynamic_overwrite`` is set,
    in which case only the partitions present in ``df`` are replaced.
    """
    writer = _rebalanced(df, list(columns)).write.mode(mode).partitionBy(*columns)
    if mode == "overwrite" and dynamic_overwrite:
        writer = writer.option("partitionOverwriteMode", "dynamic")
    with scoped_conf(df.sparkSession, {"spark.sql.adaptive.coalescePartitions.enabled": "false"}):
        writer.parquet(path)


def write_parquet(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Flat Parquet dataset (K3)."""
    df.write.mode(mode).parquet(path)


def ensure_database(spark: SparkSession, database: str, location: str | None = None) -> None:
    """``CREATE DATABASE IF NOT EXISTS`` (with an explicit location when given)."""
    loc = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}{loc}")


def save_table(df: DataFrame, table: str, mode: str = "overwrite",
               location: str | None = None) -> None:
    """Managed (or, with ``location``, external) catalog table (K4)."""
    writer = df.write.mode(mode).format("parquet")
    if location:
        writer = writer.option("path", location)
    writer.saveAsTable(table)


def save_bucketed(df: DataFrame, table: str, key: str | list[str], buckets: int, location: str | None = None,
                  mode: str = "overwrite") -> None:
    """Catalog table in ``buckets`` files by hash of the key, each sorted by it (K4).

    Tables of the same number of buckets join on the key without a shuffle. The rows are
    dealt to their buckets first, so a bucket is one file and needs no sort on reading. All rows of a key lie in one bucket: a
    key that holds a large share of the rows is better joined by AQE's skew join over a plain table."""
    keys = [key] if isinstance(key, str) else list(key)
    writer = df.repartition(buckets, *keys).write.mode(mode).format("parquet").bucketBy(buckets, *keys).sortBy(*keys)
    if location:
        writer = writer.option("path", location)
    writer.saveAsTable(table)


def write_csv(df: DataFrame, path: str, header: bool = True, sep: str = ",",
              mode: str = "overwrite") -> None:
    """Delimited text with a header line and no index column (K5): a directory
    of part files, one per task."""
    df.write.mode(mode).option("header", str(header).lower()).option("sep", sep).csv(path)


def write_json(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """JSON lines (used to stage nested documents)."""
    df.write.mode(mode).json(path)


def write_text(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """One line per row of the single string column."""
    df.write.mode(mode).text(path)
