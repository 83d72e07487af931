"""Operator 2: sharding over fixed virtual slots, with DataFrame functions only.

A record is hashed (doc_id, size, crc of the text) into one of ``VIRTUAL_SLOTS``
slots, which never changes. Bytes are summed per slot, and a versioned table maps
slots to shards: version 1 deals the slots out evenly, and a rebalance writes the
next version, in which only the slots are moved that even out the bytes. Adding a
shard is another such edit (``grow``). The law is ``bytes``.

The map and the sums have ``VIRTUAL_SLOTS`` rows whatever the input, so they are
edited on the driver. A map lives at a path of its own: a run reads its last version, adds
shards and rebalances by the sums of its records, and appends what it changed as new versions.

Equal records are counted before the shuffle and cut in pieces of ``PIECE``. Pieces are numbered
within their shard in cells: each slot is cut in ``CELLS`` by a second hash, a window adds up the
pieces of a cell, and the cells' counts (at most ``VIRTUAL_SLOTS * CELLS`` rows) give each cell its
offset; then each piece gives its rows. So a shard of any size, and a record
repeated any number of times, is numbered by many tasks.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from lakemart.llm.common import llm_query, table
from lakemart.session import cut_lineage, scratch_path

VIRTUAL_SLOTS = 4096
CELLS = 64
PIECE = 65_536  # rows that one record of the window stands for at most


def first_map(shards: int, slots: int = VIRTUAL_SLOTS) -> list[int]:
    """Version 1: slots dealt out in equal runs."""
    return [s * shards // slots for s in range(slots)]


def rebalance(owner: list[int], sizes: list[int], shards: int) -> list[int]:
    """The next version of a map: while it helps, move a slot from the fullest shard
    to the emptiest, or swap two of their slots. Ties go to the smaller number."""
    owner = list(owner)
    load, held = [0] * shards, [[] for _ in range(shards)]
    for slot, shard in enumerate(owner):
        load[shard] += sizes[slot]
        held[shard].append(slot)
    while True:
        full = min(range(shards), key=lambda s: (-load[s], s))
        spare = min(range(shards), key=lambda s: (load[s], s))
        gap = load[full] - load[spare]
        moves = [(sizes[a], a, None) for a in held[full] if 0 < sizes[a] < gap]
        best = min(moves, key=lambda m: (abs(gap - 2 * m[0]), m[1]), default=None)
        if best is None or abs(gap - 2 * best[0]) > gap // 4:
            gives, takes = sorted(held[full], key=lambda s: sizes[s]), sorted(held[spare], key=lambda s: sizes[s])
            j = 0
            for a in gives:  # for each slot the one to get back that leaves the smallest gap
                while j + 1 < len(takes) and sizes[a] - sizes[takes[j + 1]] >= gap / 2:
                    j += 1
                for b in takes[j:j + 2]:
                    change = sizes[a] - sizes[b]
                    if 0 < change < gap and (best is None or abs(gap - 2 * change) < abs(gap - 2 * best[0])):
                        best = (change, a, b)
        if best is None:
            return owner
        change, a, b = best
        held[full].remove(a)
        held[spare].append(a)
        owner[a] = spare
        if b is not None:
            held[spare].remove(b)
            held[full].append(b)
            owner[b] = full
        load[full] -= change
        load[spare] += change


def grow(owner: list[int], sizes: list[int], shards: int) -> list[int]:
    """The next version with one more shard: it takes slots from the fullest shards
    until it holds its share; no other slot moves."""
    owner = list(owner)
    load, held = [0] * (shards + 1), [[] for _ in range(shards)]
    for slot, shard in enumerate(owner):
        load[shard] += sizes[slot]
        held[shard].append(slot)
    share = sum(sizes) / (shards + 1)
    for h in held:
        h.sort(key=lambda s: (sizes[s], s))
    while any(held):
        full = min((s for s in range(shards) if held[s]), key=lambda s: (-load[s], s))
        slot = held[full].pop()
        if load[shards] + sizes[slot] > share:
            if not any(load[shards] + sizes[h[0]] <= share for h in held if h):
                break
            continue
        owner[slot] = shards
        load[full] -= sizes[slot]
        load[shards] += sizes[slot]
    return owner


def map_rows(spark: SparkSession, versions: list[list[int]], first: int = 1) -> DataFrame:
    """``(version, virtual_slot, shard)`` rows of a map's versions, the first of which has the number ``first``."""
    kind = T.ArrayType(T.ArrayType(T.IntegerType()))
    rows = spark.range(1).select(F.posexplode(F.from_json(F.lit(json.dumps(versions)), kind)).alias("v", "owners"))
    return rows.select((F.col("v") + first).alias("version"), F.posexplode("owners").alias("virtual_slot", "shard"))


def last_map(spark: SparkSession, path: str) -> tuple[int, list[int]]:
    """Number and owners of the last version stored at ``path``; 0 and no owners where there is none."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    if not place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(place):
        return 0, []
    stored = spark.read.schema("version int, virtual_slot int, shard int").parquet(path)
    last = stored.agg(F.max("version")).first()[0]
    if last is None:
        return 0, []
    rows = stored.where(F.col("version") == last).collect()  # VIRTUAL_SLOTS rows
    owner = {r["virtual_slot"]: r["shard"] for r in rows}
    if len(rows) != VIRTUAL_SLOTS or sorted(owner) != list(range(VIRTUAL_SLOTS)):
        raise ValueError(f"version {last} of the slot map at {path} does not give each of {VIRTUAL_SLOTS} slots one shard")
    return last, [owner[slot] for slot in range(VIRTUAL_SLOTS)]


def edited_map(spark: SparkSession, path: str, sizes: list[int], shards: int) -> tuple[int, list[int]]:
    """Number and owners of the map at ``path`` after its edits for these bytes per slot: a first version where
    there is none, one for each shard it lacks, one for a rebalance. Versions that change nothing are not
    stored. A map with more than ``shards`` shards is an error: slots are not taken from a shard to drop it."""
    number, owner = last_map(spark, path)
    versions = [] if number else [first_map(shards)]
    owner = owner or versions[0]
    if max(owner) >= shards:
        raise ValueError(f"the slot map at {path} has {max(owner) + 1} shards, not {shards}")
    for held in range(max(owner) + 1, shards):
        owner = grow(owner, sizes, held)
        versions.append(owner)
    even = rebalance(owner, sizes, shards)
    if even != owner:
        versions.append(even)
    if versions:  # one job, one commit: all of them or none
        map_rows(spark, versions, number + 1).coalesce(1).write.mode("append").parquet(path)
    return number + len(versions), even


def assign_shards(docs: DataFrame, shards: int = 16, map_path: str | None = None) -> tuple[DataFrame, str]:
    """``doc_id, size, text_crc32, law, shard, slot, grown_shard, virtual_slot,
    map_version`` for each row of ``docs(doc_id, text)``, and the path of the map.

    ``map_path`` keeps the map from run to run, on storage that all machines share, for one run at a time; None starts a new one in the
    application's scratch folder. ``size`` is the text's UTF-8 bytes and 1 more (null: 1; its crc is that of the
    empty text). Rows with null or repeated doc_id are hashed like any other; rows
    that agree in doc_id, size and crc share a virtual slot, and each has its own ``slot``.
    An empty table gives an empty result and leaves a stored map as it is; other columns are ignored."""
    spark = docs.sparkSession
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.select("doc_id", (F.octet_length(text) + 1).cast("long").alias("size"),
                       F.crc32(text.cast("binary")).alias("text_crc32"))
    names = ["doc_id", "size", "text_crc32"]
    record = [F.col(c) for c in names]
    pieces = rows.groupBy(*names).agg(F.count("*").alias("copies"))
    pieces = pieces.select(*names, "copies", F.explode(F.expr(f"sequence(0L, (copies - 1) div {PIECE})")).alias("piece"))
    pieces = pieces.select(
        *names, "piece", F.least(F.lit(PIECE), F.col("copies") - F.col("piece") * PIECE).alias("n"),
        F.pmod(F.xxhash64(*record), F.lit(VIRTUAL_SLOTS)).cast("int").alias("virtual_slot"),
        F.pmod(F.xxhash64(F.lit(1), *record) + F.col("piece"), F.lit(CELLS)).cast("int").alias("cell"))
    pieces = cut_lineage(pieces, "op2-pieces")
    cells = cut_lineage(pieces.groupBy("virtual_slot", "cell").agg(F.sum("n").alias("n"), F.sum(F.col("n") * F.col("size")).alias("bytes")),
                        "op2-cells")
    sizes = [0] * VIRTUAL_SLOTS
    for r in cells.groupBy("virtual_slot").agg(F.sum("bytes").alias("b")).collect():  # VIRTUAL_SLOTS rows at most
        sizes[r["virtual_slot"]] = r["b"]
    path = map_path or scratch_path(spark, "op2-slot-map")
    version, owner = edited_map(spark, path, sizes, shards)
    current = map_rows(spark, [owner], version)

    before = Window.partitionBy("shard").orderBy("virtual_slot", "cell").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (cells.join(current, "virtual_slot")
               .select("virtual_slot", "cell", "shard", "version", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("at")))
    within = (Window.partitionBy("virtual_slot", "cell").orderBy("doc_id", "text_crc32", "size", "piece")
              .rowsBetween(Window.unboundedPreceding, -1))
    numbered = pieces.withColumn("k", F.coalesce(F.sum("n").over(within), F.lit(0)))
    placed = numbered.join(offsets.hint("merge"), ["virtual_slot", "cell"])  # the window's partitions, nothing is moved again
    placed = placed.withColumn("nth", F.explode(F.expr("sequence(0L, n - 1)")))
    out = placed.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard",
                        (F.col("at") + F.col("k") + F.col("nth")).cast("long").alias("slot"),
                        F.lit(None).cast("int").alias("grown_shard"), "virtual_slot",
                        F.col("version").alias("map_version"))
    return out, path


@llm_query("op2_virtual_slot_sharding")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in 16 shards of nearly equal bytes."""
    return assign_shards(table(spark, sf_dir, "documents"), 16)[0]
