"""Shared Spark-side helpers of the training-data operators."""

from __future__ import annotations

import functools
import os
import shutil
import tempfile
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakemart.session import cut_lineage

LLM_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
LLM_ORACLE: dict[str, str | None] = {}


_shipped: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Send this package to the Python workers, once an application (what
    ``--py-files`` does at submit): they may not have it on their path."""
    context = spark.sparkContext
    if context.applicationId not in _shipped:
        import lakemart
        home = os.path.dirname(os.path.dirname(os.path.abspath(lakemart.__file__)))
        archive = shutil.make_archive(os.path.join(tempfile.mkdtemp(), "lakemart"), "zip", home, "lakemart")
        context.addPyFile(archive)
        _shipped.add(context.applicationId)


def llm_query(name: str, oracle: str | None = None):
    """Register ``fn(spark, sf_dir)`` under ``name``."""
    def register(fn):
        @functools.wraps(fn)
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            ship_package(spark)
            return fn(spark, sf_dir)
        LLM_QUERIES[name] = run
        LLM_ORACLE[name] = oracle
        return run
    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def named(column: str):
    """The column of this very name, whatever signs it holds."""
    return F.col("`{}`".format(column.replace("`", "``")))


def connected_components(edges: DataFrame, name: str = "components") -> DataFrame:
    """``(id, component)`` for every id in ``edges(a, b)``: the smallest id reachable.

    Alternating large-star and small-star steps: each is one aggregate and one
    join on the vertex, so a vertex with very many edges is pre-aggregated and
    its join is split by AQE. Every round is written under the shared checkpoint
    folder; rounds grow with the logarithm of the component size. It ends when
    each larger id has one edge and no smaller end is itself a larger one."""
    current = edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v")
    while True:
        both = current.union(current.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.first("u"), F.min("v")).alias("m"))
        large = both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").select("u", F.explode(F.array("v", "m")).alias("v"), "m")
        small = small.select(F.when(F.col("v") > F.col("m"), F.col("v")).otherwise(F.col("u")).alias("u"), F.col("m").alias("v"))
        current = cut_lineage(small.distinct(), name)
        ends = current.select("u", F.lit(1).alias("larger"), F.lit(0).alias("smaller")).union(
            current.select("v", F.lit(0), F.lit(1)))
        ends = ends.groupBy("u").agg(F.sum("larger").alias("larger"), F.max("smaller").alias("smaller"))
        if ends.where("larger + smaller > 1").isEmpty():
            break
    members = current.select(F.col("u").alias("id"), F.col("v").alias("component"))
    return members.union(current.select(F.col("v").alias("id"), F.col("v").alias("component")).distinct())


def block_pairs(members: DataFrame, group: str, block_rows: int, both_ways: bool = True) -> DataFrame:
    """``members`` dealt out so that each group of the columns ``only, i, j`` holds what one task
    compares: many small groups whole, or for a group of more than ``block_rows`` rows a pair of
    its blocks (each pair twice if ``both_ways``). ``is_row`` and ``is_col`` say on which side of the
    comparison a row stands. A row of a group of n rows comes n / ``block_rows`` times."""
    columns = members.columns
    sizes = members.groupBy(F.col(group).alias("_group")).agg(F.count("*").alias("_size"))
    packs = max(1, members.count() // (8 * block_rows))
    placed = members.join(sizes, F.col(group) == F.col("_group")).withColumn("_parts", F.ceil(F.col("_size") / block_rows).cast("int"))
    placed = placed.withColumn("_part", F.pmod(F.xxhash64("id", F.lit(1)), "_parts").cast("int"))
    small = placed.where("_parts = 1").select(
        F.lit(None).cast("long").alias("only"), F.pmod(F.xxhash64(group), F.lit(packs)).cast("int").alias("i"),
        F.lit(0).alias("j"), F.lit(True).alias("is_row"), F.lit(True).alias("is_col"), *columns)
    large = placed.where("_parts > 1").withColumn("_other", F.explode(F.expr("sequence(0, _parts - 1)")))
    sides = [(large.where(w), i, j, r) for w, i, j, r in (
        ("true" if both_ways else "_part <= _other", "_part", "_other", True),
        ("true" if both_ways else "_other <= _part", "_other", "_part", False))]
    for frame, i, j, r in sides:
        small = small.union(frame.select(F.col(group).alias("only"), F.col(i).alias("i"), F.col(j).alias("j"),
                                         F.lit(r).alias("is_row"), F.lit(not r).alias("is_col"), *columns))
    return small


def segments(values) -> list[tuple[int, int]]:
    """Bounds of the runs of equal values."""
    if not len(values):
        return []
    cuts = [0, *((values[1:] != values[:-1]).nonzero()[0] + 1).tolist(), len(values)]
    return list(zip(cuts[:-1], cuts[1:], strict=True))
