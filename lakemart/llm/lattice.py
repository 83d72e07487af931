"""Operator 5: near-duplicate embeddings by E8 lattice hashing.

In each of ``TABLES`` tables a vector's direction is projected to ``BLOCKS`` times eight
random orthogonal directions, and each eight are decoded to the nearest point of the
lattice E8. The points together name a cell. A vector also probes the cells in which one
of its points gives way to one of the ``PROBES`` neighbouring points nearest to the
projection. Vectors that meet in a cell are compared.

Copies collapse to one class first. In each cell the members are compared with two hubs,
so a large group of near copies joins up in linear work; then the members of each cell that still
holds different components are compared in blocks, by matrix products in tasks that give no more
than one link a member (cells of the same members are compared once). A link joins its ends' components, so
links are counted within components: members are dealt to blocks, small components many to
a block, and each pair of blocks of one component is one matrix product.
"""

from __future__ import annotations

import hashlib
import itertools

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakemart.llm.common import block_pairs, connected_components, llm_query, segments, table
from lakemart.llm.textops import as_list_array, mix64
from lakemart.llm.vectors import by_length, matrix_of
from lakemart.session import cut_lineage

LEAST_COSINE = 0.9
TABLES = 10
BLOCKS = 3
PROBES = 3
SCALE = 4.0  # of unit vectors, for 64 dimensions; other lengths alike
SEED = 8
BLOCK_ROWS = 2048  # vectors of a component that are multiplied at once
CELL_ROWS = 512  # and of an open cell


def _roots() -> np.ndarray:
    """The 240 neighbours of a lattice point: two of (+-1, +-1, 0, ...), or all halves with an even number of minus signs."""
    out = []
    for i, j in itertools.combinations(range(8), 2):
        for a, b in itertools.product((1, -1), repeat=2):
            v = np.zeros(8)
            v[i], v[j] = a, b
            out.append(v)
    out += [np.array(s) for s in itertools.product((0.5, -0.5), repeat=8) if sum(x < 0 for x in s) % 2 == 0]
    return np.array(out)


ROOTS = _roots()


def _even(x: np.ndarray) -> np.ndarray:
    """Nearest integer points with an even sum."""
    near = np.rint(x)
    odd = np.flatnonzero(near.sum(1) % 2)
    off = x[odd] - near[odd]
    at = np.abs(off).argmax(1)
    near[odd, at] += np.where(off[np.arange(len(odd)), at] >= 0, 1, -1)
    return near


def decode(x: np.ndarray) -> np.ndarray:
    """Nearest points of E8: even integer points, or those moved by one half."""
    a, b = _even(x), _even(x - 0.5) + 0.5
    return np.where((((x - a) ** 2).sum(1) <= ((x - b) ** 2).sum(1))[:, None], a, b)


def cell_keys(units: np.ndarray) -> np.ndarray:
    """Keys of the cells of unit vectors: for each table the own cell and the probed ones."""
    n, d = units.shape
    rng = np.random.default_rng([SEED, d])
    out = []
    for t in range(TABLES):
        hashes = []
        for _ in range(BLOCKS):
            directions = rng.normal(size=(d, 8))
            directions = np.linalg.qr(directions)[0] if d >= 8 else directions / np.sqrt(d)
            y = units @ directions * (SCALE * np.sqrt(d / 64)) + rng.random(8) * 2
            point = decode(y)
            near = np.argpartition(-((y - point) @ ROOTS.T), PROBES, axis=1)[:, :PROBES]
            points = np.concatenate([point[:, None], point[:, None] + ROOTS[near]], axis=1)
            odd = rng.integers(1, 1 << 62, size=8) * 2 + 1
            with np.errstate(over="ignore"):
                hashes.append(mix64(((points * 2).astype(np.int64) * odd).sum(2).astype(np.uint64)))
        with np.errstate(over="ignore"):
            own = [h * np.uint64(2 * i + 3) for i, h in enumerate(hashes)]
            base = sum(o[:, 0] for o in own) + np.uint64((t << 20) + d)
            keys = [base] + [base - own[b][:, 0] + own[b][:, j] for b in range(BLOCKS) for j in range(1, PROBES + 1)]
        out += [mix64(k) for k in keys]
    return np.stack(out, axis=1).view(np.int64)


def _unit(x: np.ndarray) -> np.ndarray:
    x = x / np.abs(x).max(1, keepdims=True)
    return x / np.sqrt((x * x).sum(1, keepdims=True))


def cosines(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Row by row, in double precision."""
    a, b = (x / np.abs(x).max(1, keepdims=True) for x in (a, b))
    return (a * b).sum(1) / np.sqrt((a * a).sum(1) * (b * b).sum(1))


def _usable(vectors: DataFrame) -> DataFrame:
    """``(row_id, fp_a, fp_b, vector)``: the vectors that can link, by a fingerprint of their components."""
    def run(batches):
        for batch in batches:
            for rows, x in by_length(batch.column("embedding")):
                some = (x != 0).any(1)
                rows, x = rows[some], x[some] + 0.0  # no negative zeros
                prints = np.array([np.frombuffer(hashlib.md5(v.tobytes(), usedforsecurity=False).digest(), np.int64) for v in x])
                prints = prints.reshape(-1, 2)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("vec_id").take(pa.array(rows)), pa.array(prints[:, 0].copy()), pa.array(prints[:, 1].copy()),
                     as_list_array(x.ravel(), np.full(len(x), x.shape[1]), pa.float64())], ["vec_id", "fp_a", "fp_b", "vector"])
    return vectors.select(F.col("vec_id").cast("long"), F.col("embedding").cast("array<double>")).mapInArrow(
        run, "vec_id long, fp_a long, fp_b long, vector array<double>")


def _cells(classes: DataFrame) -> DataFrame:
    def run(batches):
        for batch in batches:
            for rows, x in by_length(batch.column("vector")):
                for lo in range(0, len(x), 2000):
                    keys = cell_keys(_unit(x[lo:lo + 2000]))
                    ids = batch.column("id").take(pa.array(np.repeat(rows[lo:lo + 2000], keys.shape[1])))
                    yield pa.RecordBatch.from_arrays([pa.array(keys.ravel()), ids], ["key", "id"])
    return classes.select("id", "vector").mapInArrow(run, "key long, id long")


def _verified(pairs: DataFrame, classes: DataFrame, least: float) -> DataFrame:
    def run(batches):
        for batch in batches:
            size_a, size_b = (np.asarray(batch.column(c).value_lengths()) for c in ("va", "vb"))
            keep = np.zeros(batch.num_rows, bool)
            for d in np.unique(size_a).tolist():
                rows = np.flatnonzero((size_a == d) & (size_b == d))
                if len(rows):
                    at = pa.array(rows)
                    keep[rows] = cosines(matrix_of(batch.column("va").take(at)), matrix_of(batch.column("vb").take(at))) >= least
            yield pa.RecordBatch.from_arrays([batch.column(c).filter(pa.array(keep)) for c in ("a", "b")], ["a", "b"])
    left = classes.select(F.col("id").alias("a"), F.col("vector").alias("va"))
    right = classes.select(F.col("id").alias("b"), F.col("vector").alias("vb"))
    return pairs.join(left, "a").join(right, "b").select("a", "b", "va", "vb").mapInArrow(run, "a long, b long")


def _link_counts(members: DataFrame, least: float) -> DataFrame:
    """``(id, links)``: how many vectors, copies counted, each class of a component links with, itself included.
    ``members``: id, component, copies, vector."""
    rows = block_pairs(members.select("component", "id", "copies", "vector"), "component", BLOCK_ROWS)

    def run(key, group):
        group = group.sort_by("component")
        ids, copies = group.column("id").to_numpy(), group.column("copies").to_numpy()
        is_row, is_col = (group.column(c).to_numpy(zero_copy_only=False).astype(bool) for c in ("is_row", "is_col"))
        out_id, out_n = [], []
        for a, b in segments(group.column("component").to_numpy()):
            own = _unit(matrix_of(group.column("vector").slice(a, b - a)))  # a component has one length
            r, c = is_row[a:b], is_col[a:b]
            out_id.append(ids[a:b][r])
            out_n.append((own[r] @ own[c].T >= least) @ copies[a:b][c])
        return pa.table({"id": np.concatenate(out_id).astype(np.int64), "links": np.concatenate(out_n).astype(np.int64)})
    counted = rows.groupBy("only", "i", "j").applyInArrow(run, "id long, links long")
    return counted.groupBy("id").agg(F.sum("links").alias("links"))


def _closing_links(open_lists: DataFrame, classes: DataFrame, least: float) -> DataFrame:
    """Links ``(a, b)`` between the components that meet in open cells (``key, id, component``: a member and its
    component), enough of them to join what they join. A task holds two blocks of a cell, or many small cells."""
    prints = open_lists.groupBy("key").agg(
        F.count("*").alias("c"), F.bit_xor(F.xxhash64("id")).alias("xa"), F.bit_xor(F.xxhash64(F.lit(1), "id")).alias("xb"))
    once = prints.groupBy("c", "xa", "xb").agg(F.min("key").alias("key")).select("key")
    members = cut_lineage(open_lists.join(once, "key", "left_semi"), "op5-open-members")
    # dealt out without vectors, which join what each task compares
    rows = block_pairs(members, "key", CELL_ROWS, both_ways=False)
    rows = rows.join(classes.select("id", "vector"), "id").select(
        "only", "i", "j", "key", "id", "component", "is_row", "is_col", "vector")

    def run(key, group):
        group = group.sort_by("key")
        ids, component = group.column("id").to_numpy(), group.column("component").to_numpy()
        is_row, is_col = (group.column(c).to_numpy(zero_copy_only=False).astype(bool) for c in ("is_row", "is_col"))
        found = [np.zeros((2, 0), np.int64)]
        for a, b in segments(group.column("key").to_numpy()):
            for at, x in by_length(group.column("vector").slice(a, b - a)):
                at = at + a
                unit, r, c = _unit(x), is_row[at], is_col[at]
                link = np.zeros((len(at), len(at)), bool)
                link[np.ix_(r, c)] = (unit[r] @ unit[c].T >= least) & (component[at[r]][:, None] != component[at[c]][None])
                link |= link.T
                low = _least_reached(link)
                joined = np.flatnonzero(low != np.arange(len(at)))
                found.append(np.stack([ids[at[joined]], ids[at[low[joined]]]]))
        found = np.concatenate(found, axis=1).astype(np.int64)
        return pa.table({"a": found[0], "b": found[1]})
    return rows.groupBy("only", "i", "j").applyInArrow(run, "a long, b long")


def _least_reached(link: np.ndarray) -> np.ndarray:
    """The least number that each of n reaches by symmetric links."""
    n = len(link)
    name = np.arange(n, dtype=np.int32)
    while True:
        low = np.minimum(name, np.where(link, name[None], np.int32(n)).min(1))
        low = np.minimum(low, low[low])
        if (low == name).all():
            return name
        name = low


def near_vectors(vectors: DataFrame, least: float = LEAST_COSINE) -> DataFrame:
    """``vec_id, n_links, component_id, kept`` for each row of ``vectors(vec_id, embedding)``.

    Vectors that are null, empty, zero or hold null or non-finite components link with nothing,
    and vectors of different lengths don't link. Rows that repeat a vec_id are rows like any other
    (copies of each other where their vectors are). Rows without vec_id link with nothing; their
    component is null and they are kept. An empty table gives an empty result; other columns are ignored."""
    rows = cut_lineage(_usable(vectors.where("vec_id IS NOT NULL")), "op5-vectors")
    # a class holds equal vectors; half of its fingerprint numbers it
    classes = cut_lineage(rows.groupBy(F.col("fp_a").alias("id"), "fp_b").agg(
        F.min("vec_id").alias("rep"), F.count("*").alias("copies"), F.first("vector").alias("vector")), "op5-classes")
    cells = cut_lineage(_cells(classes), "op5-cells")
    hubs = (cells.groupBy("key").agg(F.count("*").alias("c"), F.min("id").alias("h0"), F.max("id").alias("h1")).where("c > 1")
            .select("key", F.explode(F.array("h0", "h1")).alias("hub")))
    pair = [F.least("id", "hub").alias("a"), F.greatest("id", "hub").alias("b")]
    stars = cells.join(hubs, "key").where("id <> hub").select(*pair).distinct()
    edges = cut_lineage(_verified(stars, classes, least), "op5-links")
    labels = cut_lineage(connected_components(edges), "op5-labels")

    lists = cells.join(labels, "id", "left").withColumn("component", F.coalesce("component", "id"))
    mixed = (lists.groupBy("key").agg(F.count("*").alias("c"), F.min("component").alias("lo"), F.max("component").alias("hi"))
             .where("c > 2 AND lo <> hi").select("key"))  # a list of two has been compared
    open_lists = cut_lineage(lists.join(mixed, "key", "left_semi"), "op5-open")
    if not open_lists.isEmpty():
        more = cut_lineage(_closing_links(open_lists, classes, least).distinct(), "op5-links")
        if not more.isEmpty():
            labels = cut_lineage(connected_components(edges.union(more)), "op5-labels")

    members = cut_lineage(classes.join(labels, "id").select("id", "rep", "component", "copies", "vector"), "op5-members")
    lowest = members.groupBy("component").agg(F.min("rep").alias("lowest"))
    linked = members.select("id", "component").join(lowest, "component").join(_link_counts(members, least), "id")
    named = (classes.select("id", "fp_b", "rep", "copies").join(linked.select("id", "lowest", "links"), "id", "left")
             .select(F.col("id").alias("fp_a"), "fp_b", F.coalesce("lowest", "rep").alias("component"),
                     (F.coalesce("links", "copies") - 1).alias("links")))
    found = rows.select("vec_id", "fp_a", "fp_b").join(named, ["fp_a", "fp_b"]).select(
        "vec_id", F.col("links").alias("n_links"), F.col("component").alias("component_id"))
    alone = _unusable(vectors).select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return found.union(alone).withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))


def _unusable(vectors: DataFrame) -> DataFrame:
    """The rows that ``_usable`` leaves out."""
    vector = F.col("embedding").cast("array<double>")
    bad = F.exists(vector, lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf")))
    good = F.col("vec_id").isNotNull() & vector.isNotNull() & ~bad & F.exists(vector, lambda v: v != 0)
    return vectors.where(~F.coalesce(good, F.lit(False))).select(F.col("vec_id").cast("long"))


#: All pairs. The lattice may miss a link near the threshold, where this would differ; the given vectors have none.
ORACLE_SQL = """
WITH RECURSIVE nodes AS (
  SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v, len(embedding) > 0
         AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
         AND len(list_filter(embedding, lambda x: x <> 0)) > 0 AS usable
  FROM embeddings),
links AS (
  SELECT p.vec_id AS a, q.vec_id AS b FROM nodes p JOIN nodes q
  ON p.usable AND q.usable AND p.vec_id <> q.vec_id AND len(p.v) = len(q.v) WHERE list_cosine_similarity(p.v, q.v) >= 0.9),
reach AS (
  SELECT vec_id AS a, vec_id AS b FROM nodes
  UNION
  SELECT r.a, l.b FROM reach r JOIN links l ON l.a = r.b),
lowest AS (SELECT a AS id, min(b) AS component_id FROM reach GROUP BY a),
counts AS (SELECT a AS id, count(*) AS n FROM links GROUP BY a)
SELECT vec_id, coalesce(counts.n, 0) AS n_links, component_id, vec_id = component_id AS kept
FROM nodes JOIN lowest ON lowest.id = vec_id LEFT JOIN counts ON counts.id = vec_id"""


@llm_query("op5_lattice_near_vectors", ORACLE_SQL)
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All embeddings, cosine 0.9."""
    return near_vectors(table(spark, sf_dir, "embeddings"))
