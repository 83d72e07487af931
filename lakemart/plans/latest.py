"""The latest row of each key as a kept table.

Keys are hashed into a fixed number of buckets, the parts of a versioned dataset. A load keeps, of
its own rows and those of the buckets that it touches, the first row of each key, and rewrites these buckets; all others keep
their files. Cost goes with the touched buckets, not with the table. A bucket holds whole keys, and no key has
more than one row after a load, so a hot key of a load is cut to one row by task before the shuffle
(see ``keep_one_per_key``).
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

from lakemart.operators.enrich import keep_one_per_key
from lakemart.session import cut_lineage
from lakemart.sources import versioned

ENTRY = "part int, load string, buckets int, n_rows long, schema string"


def _table_schema(entries: list[dict]) -> StructType:
    return StructType([*StructType.fromJson(json.loads(entries[0]["schema"])).fields, StructField("part", IntegerType())])


def read_latest(spark: SparkSession, path: str) -> DataFrame:
    """The table as of the last load, one row for each key."""
    entries = versioned.current_parts(spark, path)
    if not entries:
        raise ValueError(f"no table in {path}")
    return versioned.read_parts(spark, path, [e for e in entries if e["n_rows"]], _table_schema(entries)).drop("part")


def upsert(rows: DataFrame, path: str, key: str | list[str], order: list[str], buckets: int = 64) -> list[int]:
    """Bring ``rows`` into the table at ``path`` (made with ``buckets`` buckets if it is new); the buckets that were rewritten.

    Of equal keys the first row under ``order`` stays (sort specs, ties broken by all other columns), whether
    it is old or new, so loads may come in any order and again. Null keys are one key. ``rows`` must have the table's columns."""
    spark = rows.sparkSession
    keys = [key] if isinstance(key, str) else list(key)
    entries = versioned.current_parts(spark, path)
    if entries:
        buckets, schema = entries[0]["buckets"], _table_schema(entries)
        rows = rows.select(*[F.col(f"`{f.name}`").cast(f.dataType).alias(f.name) for f in schema.fields[:-1]])
    else:
        schema = StructType([*[StructField(f.name, f.dataType) for f in rows.schema.fields], StructField("part", IntegerType())])
        own = StructType(schema.fields[:-1]).json()
        entries = [{"part": i, "load": None, "buckets": buckets, "n_rows": 0, "schema": own} for i in range(buckets)]
    first = keep_one_per_key(rows, keys, order)
    first = cut_lineage(first.withColumn("part", F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")), "upsert-rows")
    touched = sorted(r["part"] for r in first.select("part").distinct().collect())
    if not touched:
        return []
    old = versioned.read_parts(spark, path, [e for e in entries if e["part"] in set(touched) and e["n_rows"]], schema)
    # the bucket leads the window's key, so rows are dealt to tasks by bucket and key and a bucket may span several
    merged = keep_one_per_key(old.unionByName(first), ["part", *keys], order)
    load = versioned.new_load()
    versioned.write_parts(merged.repartition("part"), path, load)
    counts = {r["part"]: r["n"] for r in spark.read.parquet(f"{path.rstrip('/')}/parts/load={load}")
              .groupBy("part").agg(F.count(F.lit(1)).alias("n")).collect()}
    versioned.commit(spark, path, [e | {"load": load, "n_rows": counts[e["part"]]} if e["part"] in counts else e for e in entries], ENTRY)
    return touched
