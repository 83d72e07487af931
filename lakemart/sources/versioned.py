"""Datasets of numbered parts that are replaced one by one (copy on write).

A dataset is a folder with

* ``parts/load=ID/part=K``: the files of part K as a load wrote them, never changed afterwards,
* ``versions/version=N``: a small table that names for each part the load that holds it, with the part's figures
  (a row for each range of keys where a part holds several).

A load writes new files for the parts it touches and then one new version table; parts that it does not touch keep the
files they have. Readers take the highest version, so they see a load whole or not at all, and a load
that dies leaves files that no version names. One load runs at a time. The version table has one row a part or range and
is read on the driver to name the paths: their number is bounded by the caller.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakemart.sources.evolving import path_exists


def current_parts(spark: SparkSession, path: str, schema: str | None = None) -> list[dict]:
    """The rows of the highest version: ``part``, ``load`` and what else was stored; none for a new dataset.

    With ``schema``, columns that an older version was stored without are null."""
    versions = f"{path.rstrip('/')}/versions"
    if not path_exists(spark, versions):
        return []
    log = (spark.read.schema(f"{schema}, version int") if schema else spark.read).parquet(versions)
    last = log.agg(F.max("version")).first()[0]
    return [r.asDict() for r in log.filter(F.col("version") == F.lit(last)).drop("version").orderBy("part").collect()]


def current_version(spark: SparkSession, path: str) -> int:
    versions = f"{path.rstrip('/')}/versions"
    if not path_exists(spark, versions):
        return 0
    return spark.read.parquet(versions).agg(F.max("version")).first()[0] or 0


def new_load() -> str:
    return uuid.uuid4().hex[:12]


def write_parts(df: DataFrame, path: str, load: str, part: str = "part") -> None:
    """The rows of the touched parts (column ``part``), a directory each, under a new load."""
    df.write.partitionBy(part).parquet(f"{path.rstrip('/')}/parts/load={load}")


def commit(spark: SparkSession, path: str, entries: list[dict], schema: str) -> int:
    """Make ``entries`` the next version; its number. ``schema`` begins with ``part int, load string``."""
    version = current_version(spark, path) + 1
    names = [c.strip().split()[0] for c in schema.split(",")]
    rows = [tuple(e.get(n) for n in names) for e in entries]
    spark.createDataFrame(rows, schema).coalesce(1).write.parquet(f"{path.rstrip('/')}/versions/version={version}")
    return version


def read_parts(spark: SparkSession, path: str, entries: list[dict], schema) -> DataFrame:
    """The rows of the given parts, with ``part``; only their directories are opened."""
    root = f"{path.rstrip('/')}/parts"
    folders = [f"{root}/load={e['load']}/part={e['part']}" for e in entries]
    if not folders:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).option("basePath", root).parquet(*folders).drop("load")
