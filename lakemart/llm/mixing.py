"""Operator 6: mixing sources to target weights by Sainte-Lague apportionment.

A source's documents are dealt by hash into shards of about ``SHARD_WORDS`` words (or
as many as make ``MOST_SHARDS`` shards in all) and lie there in seeded order; a shard's words form blocks of ``BLOCK_WORDS``. The
mix is a number of blocks: seats go to sources by the highest quotients
``target / (2 * seats + 1)``, a source's seats go to its shards in the same way, and
no shard gets over twice its blocks. A shard with ``q`` seats for ``B`` blocks takes
all its blocks ``q div B`` times, and a run of ``q mod B`` blocks from a seeded start,
counted round the end. As the order is seeded, that run is a random choice of
documents, of which only those at its ends are cut.

Sums per source and per shard go to the driver: a row for each source, and
``MOST_SHARDS`` rows at most besides. Which blocks a document's words lie in follows from its
offset, so no block is ever a row.
"""

from __future__ import annotations

import heapq

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lakemart.llm.common import llm_query, named, table
from lakemart.session import cut_lineage

WORD = "[^\\x20\\x09-\\x0D]+"
WEIGHTS = (3, 1, 2)
TOTAL_SHARE = 1.5
MOST_COPIES = 2
BLOCK_WORDS = 16
SHARD_WORDS = 1 << 18
MOST_SHARDS = 1 << 17  # in all, besides one a source: shards are larger where there would be more
SEED = 2024


def targets(sizes: list[int], weights: list[int], total: float, most: float) -> list[float]:
    """Shares of ``total`` by weight; none above ``most`` times its size, the excess
    shared again by weight among the others until none is above."""
    out, free = [0.0] * len(sizes), [i for i, s in enumerate(sizes) if s > 0]
    left = float(total)
    while free:
        weight = sum(weights[i] for i in free)
        over = [i for i in free if left * weights[i] / weight > most * sizes[i]]
        if not over:
            for i in free:
                out[i] = left * weights[i] / weight
            break
        for i in over:
            out[i] = float(most * sizes[i])
            left -= out[i]
        free = [i for i in free if i not in set(over)]
    return out


def sainte_lague(votes: list[float], seats: int, caps: list[int]) -> list[int]:
    """Seats by the highest quotients votes / 1, votes / 3, ..., none above its cap.
    Equal quotients: the smaller index first. All quotients over a level are taken
    at once, the level sought by bisection; a heap deals the last ones."""
    seats = min(seats, sum(c for v, c in zip(votes, caps, strict=True) if v > 0))
    if seats <= 0:
        return [0] * len(votes)

    def above(level: float) -> list[int]:
        return [min(c, int((v / level + 1) // 2)) if v > 0 else 0 for v, c in zip(votes, caps, strict=True)]

    low, high = 0.0, max(votes) * 2
    for _ in range(200):
        level = (low + high) / 2
        if level in (low, high):
            break
        if sum(above(level)) > seats:
            low = level
        else:
            high = level
    got = above(high)
    heap = [(-v / (2 * got[i] + 1), i) for i, v in enumerate(votes) if v > 0 and got[i] < caps[i]]
    heapq.heapify(heap)
    for _ in range(seats - sum(got)):
        _, i = heapq.heappop(heap)
        got[i] += 1
        if got[i] < caps[i]:
            heapq.heappush(heap, (-votes[i] / (2 * got[i] + 1), i))
    return got


def mix(rows: DataFrame, seed: int = SEED, block: int = BLOCK_WORDS, shard_words: int = SHARD_WORDS) -> DataFrame:
    """``rows`` (with ``doc_id``, ``source``, ``size``) and what the mix takes of each:
    ``source_size, target, rounds`` (times that all is taken), ``at`` (its words' place in
    the shard) and the extra run ``[x1, y1)``, ``[x2, y2)`` in words of the shard, ``taken``.

    ``rows`` should be a table (it is read three times). Sources go by code point, null
    last, with the weights 3, 1, 2 repeating. Rows of one doc_id and size lie in the order of ``tie``, where there is one."""
    spark = rows.sparkSession
    sums = rows.groupBy("source").agg(F.sum("size").alias("n")).orderBy(F.col("source").asc_nulls_last()).collect()
    names, sizes = [r["source"] for r in sums], [r["n"] for r in sums]
    goals = targets(sizes, [WEIGHTS[i % len(WEIGHTS)] for i in range(len(sizes))], TOTAL_SHARE * sum(sizes), MOST_COPIES)
    shard_words = max(shard_words, sum(sizes) // MOST_SHARDS)
    shards = [max(1, -(-s // shard_words)) for s in sizes]
    plan = spark.createDataFrame([(names[i], i, sizes[i], goals[i], shards[i]) for i in range(len(names))],
                                 "source string, source_no int, source_size long, target double, shards long")
    dealt = (rows.withColumnRenamed("source", "own_source")
             .join(plan.withColumnRenamed("source", "plan_source"), F.expr("own_source <=> plan_source"))
             .drop("plan_source").withColumnRenamed("own_source", "source")
             .withColumn("place", F.xxhash64(F.lit(seed), "doc_id", "size"))
             .withColumn("shard", F.pmod("place", "shards")).drop("shards"))
    cells = (dealt.groupBy("source_no", "shard").agg(F.sum("size").alias("n")).orderBy("source_no", "shard").collect())
    own: list[list] = [[] for _ in names]
    for c in cells:
        own[c["source_no"]].append(c)
    blocks = [[-(-c["n"] // block) for c in cs] for cs in own]
    caps = [MOST_COPIES * sum(b) for b in blocks]
    quota = sainte_lague(goals, round(sum(goals) / block), caps)
    seats = []
    for i, cs in enumerate(own):
        per_shard = sainte_lague([c["n"] for c in cs], quota[i], [MOST_COPIES * b for b in blocks[i]])
        seats += [(i, c["shard"], c["n"], b, q) for c, b, q in zip(cs, blocks[i], per_shard, strict=True) if b]
    cell_plan = spark.createDataFrame(seats, "source_no int, shard long, shard_size long, blocks long, seats long")
    start = F.pmod(F.xxhash64(F.lit(seed), "source_no", "shard"), "blocks")
    cell_plan = (cell_plan.withColumn("rounds", F.expr("seats div blocks")).withColumn("start", start)
                 .withColumn("stop", F.col("start") + F.expr("seats % blocks"))
                 .select("source_no", "shard", "rounds", (F.col("start") * block).alias("x1"),
                         F.least(F.col("stop") * block, "shard_size").alias("y1"), F.lit(0).cast("long").alias("x2"),
                         (F.greatest(F.col("stop") - F.col("blocks"), F.lit(0)) * block).alias("y2")))
    order = Window.partitionBy("source_no", "shard").orderBy("place", "doc_id", "size", *(["tie"] if "tie" in rows.columns else []))
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    placed = dealt.withColumn("at", F.coalesce(F.sum("size").over(before), F.lit(0))).join(
        cell_plan, ["source_no", "shard"], "left")

    def overlap(x: str, y: str):
        return F.greatest(F.lit(0), F.least(F.col("at") + F.col("size"), F.col(y)) - F.greatest("at", x))

    return placed.withColumn("taken", F.coalesce(
        F.col("rounds") * F.col("size") + overlap("x1", "y1") + overlap("x2", "y2"), F.lit(0)))


def word_count(text) -> F.Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def mixture(docs: DataFrame) -> DataFrame:
    """``doc_id, size, source_size, target, taken`` for each row of ``docs(doc_id, text,
    source)``. ``size`` is the number of words (null text: 0); an empty source is a
    source; a source without words has target 0. Rows that repeat a doc_id, or have
    none, are rows like any other. An empty table gives an empty result; other columns
    are ignored. Reruns give the same rows."""
    rows = cut_lineage(docs.select("doc_id", "source", word_count(F.col("text")).alias("size")), "op6-rows")
    return mix(rows).select("doc_id", "size", "source_size", "target", "taken")


def mixed_documents(docs: DataFrame) -> DataFrame:
    """The mix as rows with the columns of ``docs``: a document that is taken twice
    gives two rows, one at the end of a run gives the words of the run, joined by
    single spaces (``n_chars``, where there is one, is that text's length). Where the run goes round the end inside
    one document, its tail and its head come as two rows. Null, empty and blank texts have no
    words and are not taken. Rows that repeat a doc_id, or have none, are rows like any other, in an order
    that follows from their values, so the mix does not depend on the order of the input. An empty table gives an empty result."""
    own = F.struct(*[named(c).alias(f"c{i}") for i, c in enumerate(docs.columns)])
    tie = F.sha2(F.to_json(own), 256).alias("tie")  # equal for equal rows alone, so their order is of no account
    rows = cut_lineage(docs.select("doc_id", "source", word_count(F.col("text")).alias("size"), own.alias("doc"), tie),
                       "op6-documents")
    at = {c: F.col(f"doc.c{i}") for i, c in enumerate(docs.columns)}
    words = F.regexp_extract_all(at["text"], F.lit(WORD), F.lit(0))

    def part(x: str, y: str):
        lo = F.greatest(F.col(x) - F.col("at"), F.lit(0))
        hi = F.least(F.col(y) - F.col("at"), F.col("size"))
        return F.slice("words", (lo + 1).cast("int"), F.greatest(hi - lo, F.lit(0)).cast("int"))

    mixed = mix(rows).where("taken > 0")
    # whole copies, then the words of the run's end that lies in the document, then those of its begin past the end
    whole = F.expr("rounds + IF(taken - rounds * size = size, 1, 0)").cast("int")
    copies = mixed.withColumn("whole", whole).withColumn(
        "words", F.when(F.expr("taken > whole * size"), words).otherwise(F.array().cast("array<string>")))
    pieces = F.filter(F.array(part("x1", "y1"), part("x2", "y2")), lambda w: F.size(w) > 0)
    cut = F.transform(F.when(F.expr("taken > whole * size"), pieces).otherwise(F.array().cast("array<array<string>>")),
                      lambda w: F.array_join(w, " "))
    copies = copies.withColumn("copy", F.explode(F.concat(
        F.array_repeat(F.lit(None).cast("string"), F.col("whole")), cut)))
    new = {"text": F.coalesce("copy", at["text"])}
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        new["n_chars"] = F.when(F.col("copy").isNotNull(), F.char_length("copy").cast(kind)).otherwise(at["n_chars"])
    return copies.select(*[new.get(c, at[c]).alias(c) for c in docs.columns])


@llm_query("op6_sainte_lague_mixing")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents, 150 % of their words, weights 3, 1, 2."""
    return mixture(table(spark, sf_dir, "documents"))
