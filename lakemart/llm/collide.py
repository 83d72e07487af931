"""Operator 11: nearest vectors by collision counting.

Largest inner products become smallest distances: a candidate x gets one more component that brings its
length to that of the longest, a query q is scaled to that length. A random rotation gives
``PROJECTIONS`` or more single projections. In each block of candidates every projection is a
sorted array. A query opens in each array a window centred at its own projection, of half width ``WINDOW``
times the radius (in units of a projection's deviation), and the windows in which each row's position lies are counted. Rows
with ``threshold`` collisions are verified: their inner product is computed. The radius grows (virtual rehashing: the same
arrays serve every radius, only the ends of the windows move) until ``k`` verified rows lie within it. Where
k rows are known from earlier blocks of the task, it begins with the distance of the k-th.

The threshold is such that a row at the radius reaches it with probability ``1 - MISSED``. As a query
stops only when k rows lie within the radius, a nearest row is missed with that probability at most.

Queries go out in batches whose vectors take ``BATCH_BYTES`` at most, and every task keeps the k best of each
query over its blocks, so candidates are never copied or shuffled. The best of all tasks meet in a window by query.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lakemart.llm.common import llm_query, table
from lakemart.llm.textops import as_list_array
from lakemart.llm.vectors import by_length, matrix_of
from lakemart.session import cut_lineage

PROJECTIONS = 64
WINDOW = 1.25
MISSED = 0.05
GROWTH = 1.12
START = 0.5  # first radius, as a part of the longest vector's length
BATCH_BYTES = 32 << 20
QUERY_ROWS = 64  # queries whose counts over a block are held at once
BLOCK_ROWS = 8192
SEED = 11


def usable_vectors(vectors: DataFrame) -> DataFrame:
    """``(vec_id, size, vector array<double>)`` of the rows that take part: a vec_id, and a vector that is not
    null, empty or zero and has neither null nor non-finite components."""
    def run(batches):
        for batch in batches:
            for rows, x in by_length(batch.column("embedding")):
                some = np.flatnonzero(x.any(1))
                yield pa.RecordBatch.from_arrays(
                    [batch.column("vec_id").take(pa.array(rows[some])), pa.array(np.full(len(some), x.shape[1]), pa.int32()),
                     as_list_array(x[some].ravel(), np.full(len(some), x.shape[1]), pa.float64())], ["vec_id", "size", "vector"])
    return vectors.where("vec_id IS NOT NULL").select(F.col("vec_id").cast("long"), F.col("embedding").cast("array<double>")).mapInArrow(
        run, "vec_id long, size int, vector array<double>")


def rotations(size: int, projections: int = PROJECTIONS) -> np.ndarray:
    """Random unit directions of ``size`` components: orthogonal ones, so many rotations as give ``projections``."""
    rng = np.random.default_rng((SEED, size))
    turns = [np.linalg.qr(rng.normal(size=(size, min(size, projections))))[0] for _ in range(-(-projections // min(size, projections)))]
    return np.concatenate(turns, axis=1)


def threshold(directions: np.ndarray, window: float = WINDOW, missed: float = MISSED) -> int:
    """So many collisions that a row at the radius has them with probability ``1 - missed`` (from 8,192 random directions)."""
    size = len(directions)
    away = np.random.default_rng((SEED, size, 1)).normal(size=(8192, size))
    away /= np.linalg.norm(away, axis=1, keepdims=True)
    hits = np.sort((np.abs(away @ directions) <= window / np.sqrt(size)).sum(1))
    return int(hits[int(missed * len(hits))])


@dataclass
class Plan:
    """What all blocks of one vector size share: the candidates' largest component and, in units of it, length."""

    unit: float
    longest: float
    directions: np.ndarray = field(init=False)
    least: int = field(init=False)
    size: int = 0

    def __post_init__(self):
        self.directions = rotations(self.size + 1)
        self.least = threshold(self.directions)

    def place(self, x: np.ndarray, is_query: bool) -> np.ndarray:
        """Projections of vectors, lengthened (candidates) or scaled (queries) to the longest."""
        if is_query:
            x = x / np.abs(x).max(1, keepdims=True)
            x = np.column_stack([x * (self.longest / np.linalg.norm(x, axis=1))[:, None], np.zeros(len(x))])
        else:
            x = x / self.unit
            x = np.column_stack([x, np.sqrt(np.maximum(0, self.longest**2 - (x * x).sum(1)))])
        return x @ self.directions

    def distance(self, score: np.ndarray, length: np.ndarray) -> np.ndarray:
        """Distance of the placed vectors from their inner product (``length``: the query's)."""
        return np.sqrt(np.maximum(0, 2 * self.longest**2 - 2 * self.longest / self.unit * score / length))


class Best:
    """The k best rows of each query so far: scores and ids, best first."""

    def __init__(self, queries: int, k: int):
        self.k = k
        self.score, self.id = np.full((queries, k), -np.inf), np.full((queries, k), np.iinfo(np.int64).max)

    def add(self, query: int, score: np.ndarray, ids: np.ndarray) -> None:
        score, ids = np.append(self.score[query], score), np.append(self.id[query], ids)
        order = np.lexsort((ids, -score))[:self.k]
        self.score[query], self.id[query] = score[order], ids[order]


def search_block(plan: Plan, queries: np.ndarray, query_ids: np.ndarray, x: np.ndarray, ids: np.ndarray, best: Best) -> int:
    """Search one block (65,535 rows at most) for all queries; gives the number of rows verified."""
    places = plan.place(x, False)
    order = np.argsort(places, axis=0, kind="stable")
    arrays = np.ascontiguousarray(np.take_along_axis(places, order, 0).T)
    position = np.empty(arrays.shape, np.uint16)  # of each row in each array
    np.put_along_axis(position, order.T, np.arange(len(x), dtype=np.uint16)[None], 1)
    block, verified = (x, ids, arrays, position), 0
    for first in range(0, len(queries), QUERY_ROWS):
        some = slice(first, first + QUERY_ROWS)
        verified += _search(plan, queries[some], query_ids[some], block, best, first)
    return verified


def _collisions(arrays: np.ndarray, position: np.ndarray, centres: np.ndarray, reach: np.ndarray) -> np.ndarray:
    """In how many arrays each row lies inside the window of each query."""
    counts = np.zeros((len(reach), arrays.shape[1]), np.uint16)
    away, inside = np.empty_like(counts), np.empty(counts.shape, bool)
    for j, array in enumerate(arrays):
        low = np.searchsorted(array, centres[:, j] - reach, side="left")
        high = np.searchsorted(array, centres[:, j] + reach, side="right")
        np.subtract(position[j][None], low.astype(np.uint16)[:, None], out=away)  # wraps round below the window
        np.less(away, (high - low).astype(np.uint16)[:, None], out=inside)
        np.add(counts, inside, out=counts)
    return counts


def _search(plan: Plan, q: np.ndarray, own_ids: np.ndarray, block: tuple, best: Best, first: int) -> int:
    x, ids, arrays, position = block
    length, centres = np.linalg.norm(q, axis=1), plan.place(q, True)
    half, mine = WINDOW / np.sqrt(plan.size + 1), slice(first, first + len(q))
    seen, verified = np.zeros((len(q), len(x)), bool), 0
    radius = plan.distance(best.score[mine, -1], length)  # of the k-th best so far
    radius = np.where(np.isfinite(radius), radius, START * plan.longest)
    active = np.arange(len(q))
    while len(active):
        found = _collisions(arrays, position, centres[active], half * radius[active]) >= plan.least
        everything = radius[active] > 2 * plan.longest  # further than any row can be
        found = (found | everything[:, None]) & ~seen[active]
        seen[active] |= found
        at, candidate = np.nonzero(found)
        query = active[at]
        other = own_ids[query] != ids[candidate]
        query, candidate = query[other], candidate[other]
        verified += len(query)
        score = _products(q, x, query, candidate)
        cut = np.searchsorted(query, np.arange(len(q) + 1))
        for i in np.unique(query).tolist():
            s = slice(cut[i], cut[i + 1])
            best.add(first + i, score[s], ids[candidate[s]])
        bound = plan.distance(best.score[mine, -1], length)
        active = active[(bound[active] > radius[active]) & ~everything]
        radius = np.minimum(radius * GROWTH, bound)
    return verified


def _products(q: np.ndarray, x: np.ndarray, query: np.ndarray, candidate: np.ndarray) -> np.ndarray:
    """Inner products of pairs, each summed by itself: equal rows have equal scores."""
    out = np.empty(len(query))
    for lo in range(0, len(query), 1 << 14):
        part = slice(lo, lo + (1 << 14))
        out[part] = np.einsum("ij,ij->i", q[query[part]], x[candidate[part]])
    return out


def nearest(queries: DataFrame, candidates: DataFrame, k: int = 20, batch_bytes: int = BATCH_BYTES) -> DataFrame:
    """``query_id, rank, vec_id, score`` of each row of ``queries`` among ``candidates``, both tables of
    ``usable_vectors``: the k largest inner products found (all, if there are fewer rows), exact scores.

    Only vectors of one length meet. Ties go to the smaller vec_id. Rows that repeat a vec_id are candidates
    each, but none for a query with that vec_id; of queries that repeat a vec_id the one with the least
    vector (by its components in order) counts. Empty tables give an empty result. Scores beyond double precision become
    infinite. One row for each vector size goes to the driver, and one batch of queries at a time."""
    spark = queries.sparkSession
    limits = candidates.groupBy("size").agg(F.max(F.array_max(F.transform("vector", F.abs))).alias("unit")).collect()
    units = {r["size"]: r["unit"] for r in limits}
    if not units:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    unit = F.element_at(F.create_map(*[F.lit(v) for pair in units.items() for v in pair]), F.col("size"))
    longest = (candidates.select("size", F.sqrt(F.aggregate(F.transform("vector", lambda v: v / unit), F.lit(0.0), lambda s, v: s + v * v)).alias("length"))
               .groupBy("size").agg(F.max("length").alias("length")).collect())
    limits = {r["size"]: (units[r["size"]], r["length"]) for r in longest}
    asked = cut_lineage(queries.groupBy("vec_id").agg(F.min(F.struct("size", "vector")).alias("q"))
                        .select("vec_id", "q.size", "q.vector"), "op11-queries")
    bytes_each = asked.agg(F.max("size"), F.count("*")).first()
    if not bytes_each[1]:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    parts = max(1, -(-bytes_each[1] * bytes_each[0] * 8 // batch_bytes))
    asked = asked.withColumn("part", F.pmod(F.xxhash64("vec_id", F.lit(SEED)), F.lit(parts)))
    found = None
    for part in range(parts):
        some = asked.where(F.col("part") == part).drop("part").toArrow()
        shared = spark.sparkContext.broadcast(_by_size(some))
        result = cut_lineage(_one_batch(shared, candidates, limits, k), "op11-found")
        shared.unpersist()
        found = result if found is None else found.union(result)
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def _by_size(some: pa.Table) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """Ids and vectors of a batch of queries for each vector size."""
    sizes, out = some.column("size").to_numpy(), {}
    for d in np.unique(sizes).tolist():
        own = some.filter(pa.array(sizes == d))
        out[d] = own.column("vec_id").to_numpy(), matrix_of(own.column("vector"))
    return out


def _one_batch(shared, candidates: DataFrame, limits: dict, k: int) -> DataFrame:
    """The best rows of each task for a broadcast batch of queries."""
    def run(batches):
        asked = shared.value
        plans = {d: Plan(*limits[d], size=d) for d in asked if d in limits}
        best = {d: Best(len(asked[d][0]), k) for d in plans}
        for rows in batches:
            size = rows.column("size").to_numpy()
            for d in np.unique(size).tolist():
                if d in plans:
                    own = pa.array(np.flatnonzero(size == d))
                    ids, x = rows.column("vec_id").take(own).to_numpy(), matrix_of(rows.column("vector").take(own))
                    for lo in range(0, len(x), BLOCK_ROWS):
                        search_block(plans[d], asked[d][1], asked[d][0], x[lo:lo + BLOCK_ROWS], ids[lo:lo + BLOCK_ROWS], best[d])
        for d, b in best.items():
            query, place = np.nonzero(b.score > -np.inf)
            yield pa.RecordBatch.from_arrays([pa.array(asked[d][0][query]), pa.array(b.id[query, place]), pa.array(b.score[query, place])],
                                             ["query_id", "vec_id", "score"])
    return candidates.mapInArrow(run, "query_id long, vec_id long, score double")


@llm_query("op11_collision_counting")
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every embedding whose vec_id is divisible by 20 against all others, the 20 nearest."""
    vectors = cut_lineage(usable_vectors(table(spark, sf_dir, "embeddings")), "op11-vectors")
    return nearest(vectors.where("vec_id % 20 = 0"), vectors, 20)
