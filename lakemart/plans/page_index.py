"""A paged mart that takes appends.

The mart lies in key order in ranges of about ``range_rows`` rows. The
version table holds each range's first and last key and its number of rows; the prefix sums of these numbers place every
row of the mart. A page reads the one or two ranges that its row numbers fall into, a page after a key the range
that holds the key and those that follow until it is full. An append rewrites the ranges into whose
limits its keys fall, and cuts those that grew beyond twice ``range_rows``; all others keep their files, and
no row number is stored that could change.

A range is not a file: neighbours that one load writes share a part of the versioned dataset, up to ``PART_ROWS`` rows, so
the number of files follows from the rows and not from ``range_rows``. Each row carries its range's number (never given
twice), by which a reader leaves out a part's other ranges, those replaced since included.

Rows are in the order of the key, ties by all other columns; the rows of one key lie in one range. The key is one column
without nulls, a number or text. A row's range is found by halving the sorted limits. One row a range goes to the
driver and each range's limit to the tasks, so ``range_rows`` should leave some ten thousand ranges at most.
"""

from __future__ import annotations

import bisect
import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, IntegerType, StructField, StructType

from lakemart.operators.paging import PAGE_SIZE_DEFAULT, PAGE_SIZE_MAX, check_page, number_rows
from lakemart.session import cut_lineage
from lakemart.sources import versioned

RANGE_ROWS = 1_000_000
PART_ROWS = 50_000  # neighbouring ranges are stored together up to about so many rows
RANGE = "_range"
ENTRY = f"part int, load string, n_rows long, low string, high string, key string, schema string, {RANGE} int"


def _entries(spark: SparkSession, path: str) -> list[dict]:
    """The ranges in key order."""
    entries = versioned.current_parts(spark, path, ENTRY)
    for e in entries:
        e["low"], e["high"] = json.loads(e["low"]), json.loads(e["high"])
        if e[RANGE] is None:  # from before ranges shared a part
            e[RANGE] = e["part"]
    return sorted(entries, key=lambda e: (e["low"], e[RANGE]))


def _schema(entries: list[dict]) -> StructType:
    return _stored(StructType.fromJson(json.loads(entries[0]["schema"])).fields)


def _stored(fields: list[StructField]) -> StructType:
    return StructType([*fields, StructField(RANGE, IntegerType()), StructField("part", IntegerType())])


def _read_files(spark: SparkSession, path: str, entries: list[dict], schema: StructType) -> DataFrame:
    """All rows of the parts that hold the given ranges, with the number of their range."""
    parts = {(e["load"], e["part"]): e for e in entries}
    return versioned.read_parts(spark, path, list(parts.values()), schema).withColumn(RANGE, F.coalesce(RANGE, "part")).drop("part")


def _read_ranges(spark: SparkSession, path: str, entries: list[dict], schema: StructType) -> DataFrame:
    """The rows of a page's few ranges."""
    return _read_files(spark, path, entries, schema).filter(F.col(RANGE).isin([e[RANGE] for e in entries])).drop(RANGE)


def _limits_up_to(limits: list, kind: DataType, value: str) -> Column:
    """How many of the sorted ``limits`` are not above a row's ``value``, by halving."""
    if not limits:
        return F.lit(0)
    # one literal, however many limits there are; the optimizer reads it once
    bounds = F.from_json(F.lit(json.dumps(limits)), f"array<{kind.simpleString()}>", {"mode": "FAILFAST"})
    steps = F.array(*[F.lit(1 << s) for s in reversed(range(len(limits).bit_length()))])
    return F.aggregate(steps, F.lit(0), lambda at, step: F.when(
        F.get(bounds, at + step - 1) <= F.col(value), at + step).otherwise(at))


def append_rows(rows: DataFrame, path: str, key: str = "user_id", range_rows: int = RANGE_ROWS) -> list[int]:
    """Add ``rows`` to the mart at ``path`` (a new one if there is none); the numbers of the ranges that were replaced.

    An append that adds nothing makes no version."""
    spark, entries = rows.sparkSession, _entries(rows.sparkSession, path)
    schema = _schema(entries) if entries else _stored([StructField(f.name, f.dataType) for f in rows.schema.fields])
    columns, kind = [f.name for f in schema.fields[:-2]], schema[key].dataType
    # the range whose first key is the last one not above the row's; keys below the first range's go there, too
    place = _limits_up_to([e["low"] for e in entries[1:]], kind, key)
    new = cut_lineage(rows.select(*columns, place.alias("place")), "append-rows")
    touched = sorted(r["place"] for r in new.select("place").distinct().collect())
    if not touched:
        return []
    old, both = [entries[i] for i in touched] if entries else [], new
    if old:
        places = spark.createDataFrame([(entries[i][RANGE], i) for i in touched], f"{RANGE} int, place int")
        both = _read_files(spark, path, old, schema).join(F.broadcast(places), RANGE).drop(RANGE).unionByName(new)
    # dense numbers in (range, key) order, without a window over a range; a range beyond twice the size is cut evenly
    numbered = cut_lineage(number_rows(both.select("place", *columns), ["place", key]), "append-order")
    sizes = numbered.groupBy("place").agg(F.count(F.lit(1)).alias("_n"), F.min("row_no").alias("_first"))
    cuts = F.when(F.col("_n") > 2 * range_rows, F.ceil(F.col("_n") / range_rows)).otherwise(F.lit(1))
    if not entries:
        cuts = F.ceil(F.col("_n") / range_rows)
    sizes = sizes.withColumn("_cuts", cuts.cast("long")).withColumnRenamed("place", "_place")
    spread = numbered.join(F.broadcast(sizes), F.col("place") == F.col("_place")).withColumn(
        "_cut", F.expr("(row_no - _first) * _cuts div _n"))
    # the first keys of the cuts are the new ranges' limits, so the rows of one key lie in one range
    limits = sorted({r["low"] for r in spread.groupBy("place", "_cut").agg(F.min(key).alias("low")).collect()})
    first, together = max((e[RANGE] for e in entries), default=-1) + 1, max(1, PART_ROWS // range_rows)
    load = versioned.new_load()
    placed = (numbered.select(*columns, (_limits_up_to(limits, kind, key) + F.lit(first - 1)).alias(RANGE))
              .withColumn("part", F.expr(f"{RANGE} - ({RANGE} - {first}) % {together}")))
    versioned.write_parts(placed.repartition("part").sortWithinPartitions("part", key), path, load)
    figures = (spark.read.schema(schema).parquet(f"{path.rstrip('/')}/parts/load={load}").groupBy("part", RANGE)
               .agg(F.count(F.lit(1)).alias("n_rows"), F.min(key).alias("low"), F.max(key).alias("high")).collect())
    own, replaced = StructType(schema.fields[:-2]).json(), set(touched)
    kept = [e for i, e in enumerate(entries) if i not in replaced]
    made = [r.asDict() | {"load": load, "key": key, "schema": own} for r in figures]
    versioned.commit(spark, path, [e | {"low": json.dumps(e["low"]), "high": json.dumps(e["high"])} for e in kept + made], ENTRY)
    return [e[RANGE] for e in old]


def total_rows(spark: SparkSession, path: str) -> int:
    return sum(e["n_rows"] for e in _entries(spark, path))


def _ordered(df: DataFrame, key: str) -> DataFrame:
    return df.orderBy(*[F.col(f"`{c}`").asc_nulls_first() for c in [key, *[c for c in df.columns if c != key]]])


def indexed_page(spark: SparkSession, path: str, page_no: int, page_size: int = PAGE_SIZE_DEFAULT,
                 page_size_max: int = PAGE_SIZE_MAX) -> DataFrame:
    """A page by number: the ranges that hold its rows are read, and no others. Past the end it is empty."""
    start, entries, before = check_page(page_no, page_size, page_size_max), _entries(spark, path), 0
    hit, skipped = [], 0
    for e in entries:
        if before + e["n_rows"] <= start:
            skipped = before + e["n_rows"]
        elif before < start + page_size:
            hit.append(e)
        before += e["n_rows"]
    if not entries:
        raise ValueError(f"no mart in {path}")
    rows = _read_ranges(spark, path, hit, _schema(entries))
    return _ordered(rows, entries[0]["key"]).offset(start - skipped).limit(page_size)


def page_after(spark: SparkSession, path: str, after, page_size: int = PAGE_SIZE_DEFAULT,
               page_size_max: int = PAGE_SIZE_MAX) -> DataFrame:
    """The ``page_size`` rows that follow the key ``after`` (all rows of that key are passed over)."""
    check_page(1, page_size, page_size_max)
    entries, hit, sure = _entries(spark, path), [], 0
    if not entries:
        raise ValueError(f"no mart in {path}")
    key = entries[0]["key"]
    for e in entries[bisect.bisect_right([e["high"] for e in entries], after):]:
        hit.append(e)
        sure += e["n_rows"] if e["low"] > after else 0  # of the range that holds the key, any number may follow
        if sure >= page_size:
            break
    rows = _read_ranges(spark, path, hit, _schema(entries))
    return _ordered(rows.filter(F.col(key) > F.lit(after)), key).limit(page_size)
