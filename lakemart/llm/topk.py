"""Operator 7: exact top-k by inner product with no-random-access aggregation.

Vectors become integers. Candidates are dealt to blocks, queries too, and each pair of blocks
is one group of a Spark job. In a group every dimension is a list of the block's candidates
sorted by component; a query reads it from the top where its own component is positive
and from the bottom where it is negative, so that contributions fall. The lists are read in rounds
and to uneven depths: a round has a width, and each list is read on until what its unread entries can
still contribute differs by that width at most. So lists of large query components are read nearly to the
end, and lists of small ones hardly at all. What is read adds up to a partial sum for each candidate.
Its lower bound counts an unread list as the list's last contribution, its upper bound as the last one read.
Candidates whose upper bound is below the k-th best lower bound can't qualify, and their sums end. A query stops
when all but a few can't, and the scores of those few are resolved. The best of each block meet in a window by query.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lakemart.llm.common import llm_query, table
from lakemart.llm.textops import as_list_array
from lakemart.llm.vectors import by_length, matrix_of
from lakemart.session import cut_lineage

SCALE = 256
CANDIDATE_ROWS = 4096
QUERY_ROWS = 1024
WIDTHS = (1 / 4, 1 / 8, 1 / 16, *(2.0**-(j / 2) for j in range(9, 17)), 0.0)  # of the rounds, as shares of the widest list's; 0 reads all
RESOLVED = 32  # times k: so few candidates that may still qualify are resolved at once
DROPPED = 0.8  # when fewer of the rows can still qualify, the sums of the others end
EXACT = 2.0**52  # sums of integers below it, counted from the lists' ends, are exact in double precision


def integer_vectors(vectors: DataFrame, scale: int = SCALE) -> DataFrame:
    """``(vec_id, size, vector array<long>)`` of the vectors without null or non-finite components.
    A component that is beyond the long integers is held at their limit."""
    def run(batches):
        for batch in batches:
            for rows, x in by_length(batch.column("embedding")):
                with np.errstate(over="ignore"):
                    scaled = np.floor(x * scale)
                whole = np.clip(scaled, -(2.0**63), 2.0**63 - 1024).astype(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("vec_id").take(pa.array(rows)), pa.array(np.full(len(x), x.shape[1]), pa.int32()),
                     as_list_array(whole.ravel(), np.full(len(x), x.shape[1]), pa.int64())], ["vec_id", "size", "vector"])
    return vectors.where("vec_id IS NOT NULL").select(F.col("vec_id").cast("long"), F.col("embedding").cast("array<double>")).mapInArrow(
        run, "vec_id long, size int, vector array<long>")


def _best(ids: np.ndarray, scores: np.ndarray, k: int) -> np.ndarray:
    """Places of the k highest scores, ties to smaller ids."""
    return np.lexsort((ids, -scores))[:k]


def top_of_block(queries: np.ndarray, query_ids: np.ndarray, x: np.ndarray, ids: np.ndarray, k: int):
    """For each query the k best rows of a block: query places, ids, scores, and beside the best one how many
    entries of the lists were read (0 beside the others). A query's own id is no candidate."""
    big = np.abs(queries).astype(np.float64).max(initial=0) * np.abs(x).astype(np.float64).max(initial=0) * x.shape[1]
    if big >= EXACT:  # too large for exact sums in double precision: Python integers
        scores = queries.astype(object) @ x.T.astype(object)
        out = []
        for q in range(len(queries)):
            others = np.flatnonzero(ids != query_ids[q])
            order = sorted(others.tolist(), key=lambda i: (-scores[q, i], ids[i]))[:k]
            out += [(q, ids[i], min(max(scores[q, i], -(2**63)), 2**63 - 1), 0 if n else x.size) for n, i in enumerate(order)]
        return tuple(np.array([o[j] for o in out], np.int64) for j in range(4))
    x, queries = x.astype(np.float64), queries.astype(np.float64)
    order = np.argsort(x, axis=0, kind="stable").T.copy()
    values = np.take_along_axis(x.T, order, 1)
    above, below = values - values[:, :1], values[:, -1:] - values  # what an entry has beyond its list's last
    out = []
    for q, query in enumerate(queries):
        others = ids != query_ids[q]
        at, n_read = _read_lists(query, others, order, above, below, k)
        scores = x[at] @ query  # resolve the final scores of those that may still qualify
        best = _best(ids[at], scores, k)
        out.append((np.full(len(best), q), ids[at[best]], scores[best], np.where(np.arange(len(best)) == 0, n_read, 0)))
    return tuple(np.concatenate([o[j] for o in out]).astype(np.int64) if out else np.zeros(0, np.int64) for j in range(4))


def _read_lists(query: np.ndarray, others: np.ndarray, order: np.ndarray, above: np.ndarray, below: np.ndarray, k: int):
    """The candidates that may be among the ``k`` best of ``others``, and the number of entries read to tell.

    Contributions count from each list's last one, so an unread list adds nothing to a lower bound and at most
    its last read entry to an upper bound."""
    d, n = order.shape
    weight, up = np.abs(query), query > 0
    widest = above[:, -1] * weight  # contributions of each list's first entry
    widths = widest.max(initial=0) * np.array(WIDTHS)
    depths = np.zeros((d, len(WIDTHS)), np.int64)  # how deep each round reads each list
    for i in np.flatnonzero(weight).tolist():
        room = widths / weight[i]
        depths[i] = n - np.searchsorted(above[i], room, "right") if up[i] else np.searchsorted(-below[i], -room, "left")
    depths[:, -1] = n
    kept = place = np.arange(n)  # rows whose sums are still carried on, and where each row stands in them
    lower, unread = np.zeros(n), np.full(n, d)
    before, total = np.zeros(d, np.int64), 0
    for round_, after in enumerate(depths.T):
        new, whole = after - before, round_ + 1 == len(WIDTHS)
        lists = np.flatnonzero(new)
        if not len(lists) and not whole:
            continue
        if len(lists):
            cuts = [(i, slice(n - after[i], n - before[i]) if up[i] else slice(before[i], after[i])) for i in lists.tolist()]
            row = np.concatenate([order[i, cut] for i, cut in cuts])
            value = np.concatenate([(above if up[i] else below)[i, cut] for i, cut in cuts])
            value *= np.repeat(weight[lists], new[lists])
            total += len(row)
            if len(kept) < n:
                row = place[row]
                use = np.flatnonzero(row >= 0)
                row, value = row[use], value[use]
            lower += np.bincount(row, value, len(kept))
            unread -= np.bincount(row, minlength=len(kept))
        before = after
        at, final = np.arange(d), np.maximum(before, 1) - 1  # the last entries read
        last = np.where(before > 0, np.where(up, above[at, n - 1 - final], below[at, final]) * weight, widest)
        most = np.concatenate([[0], np.cumsum(-np.sort(-last))])  # what so many unread lists add at most
        upper, own = lower + most[unread], ~others[kept]
        bound = np.where(own, -np.inf, lower)
        some = min(k, len(kept))
        level = np.partition(bound, len(kept) - some)[len(kept) - some]  # the k-th best lower bound
        able = np.flatnonzero((upper >= level) & ~own)
        if whole or len(able) <= RESOLVED * k:
            break
        if len(able) < DROPPED * len(kept):
            kept, lower, unread = kept[able], lower[able], unread[able]
            place = np.full(n, -1)
            place[kept] = np.arange(len(kept))
    return kept[able], total


def top_k(queries: DataFrame, candidates: DataFrame, k: int = 5, reads: bool = False) -> DataFrame:
    """``query_id, rank, vec_id, score`` of each row of ``queries`` among ``candidates``, both of ``integer_vectors``;
    with ``reads`` also ``entries_read``, and ``entries``, those of all lists. Only vectors of one length meet; a query with fewer candidates gets all.

    Ties go to the smaller vec_id. Rows that repeat a vec_id are candidates each, but none for a query
    with that vec_id; of queries that repeat a vec_id the one with the least vector (by length, then by its components
    in order) counts. Empty tables give an empty result."""
    n_queries, n_candidates = queries.count(), candidates.count()
    parts_q, parts_c = max(1, -(-n_queries // QUERY_ROWS)), max(1, -(-n_candidates // CANDIDATE_ROWS))
    sides = []
    asked = queries.groupBy("vec_id").agg(F.min(F.struct("size", "vector")).alias("q")).select("q.size", "vec_id", "q.vector")
    for frame, own, other, parts, others, is_query in ((asked, "i", "j", parts_q, parts_c, True), (candidates, "j", "i", parts_c, parts_q, False)):
        sides.append(frame.select("size", "vec_id", "vector", F.lit(is_query).alias("asks"),
                                  F.pmod(F.xxhash64("vec_id", F.lit(7)), F.lit(parts)).cast("int").alias(own))
                     .withColumn(other, F.explode(F.expr(f"sequence(0, {others - 1})"))))

    def run(key, group):
        asks = group.column("asks").to_numpy(zero_copy_only=False).astype(bool)
        ids, x = group.column("vec_id").to_numpy(), matrix_of(group.column("vector"))
        empty = pa.table({c: pa.array([], pa.int64()) for c in ("query_id", "vec_id", "score", "n_read", "n_all")})
        if asks.all() or not asks.any():
            return empty
        q, found, score, n_read = top_of_block(x[asks], ids[asks], x[~asks], ids[~asks], k)
        n_all = np.where(n_read > 0, x[~asks].size, 0)
        return pa.table({"query_id": ids[asks][q], "vec_id": found, "score": score, "n_read": n_read, "n_all": n_all}) if len(q) else empty
    both = sides[0].unionByName(sides[1])
    best = both.groupBy("size", "i", "j").applyInArrow(run, "query_id long, vec_id long, score long, n_read long, n_all long")
    if reads:
        best = cut_lineage(best, "op7-blocks")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = (best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
              .select("query_id", "rank", "vec_id", "score"))
    if not reads:
        return ranked
    work = best.groupBy("query_id").agg(F.sum("n_read").alias("entries_read"), F.sum("n_all").alias("entries"))
    return ranked.join(work, "query_id")


ORACLE_SQL = """
WITH whole AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_sum(list_transform(range(1, len(q.v) + 1), lambda i: q.v[i] * c.v[i])) AS s
  FROM whole q JOIN whole c ON q.vec_id % 50 = 0 AND q.vec_id <> c.vec_id AND len(q.v) = len(c.v)),
ranked AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY s DESC, vec_id) AS r FROM scored)
SELECT query_id, CAST(r AS INTEGER) AS rank, vec_id, CAST(s AS BIGINT) AS score FROM ranked WHERE r <= 5"""


@llm_query("op7_no_random_access_top_k", ORACLE_SQL)
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every embedding whose vec_id is divisible by 50 against all others, the 5 best."""
    vectors = cut_lineage(integer_vectors(table(spark, sf_dir, "embeddings")), "op7-vectors")
    return top_k(vectors.where("vec_id % 50 = 0"), vectors, 5)
