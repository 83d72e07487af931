"""Operator 1: near-duplicate documents by bottom-k sketches.

One hash function orders all word shingles; a text keeps the ``k`` smallest of
its set. Steps, each a Spark job over the whole table:

1. Sets. Texts become sets of shingle hashes inside tasks; equal sets collapse to
   one class (its smallest doc_id), so thousands of copies cost one row.
2. Inverted lists. Retained values that two or more classes share are kept. Two
   sets of the wanted similarity share at least ``o`` retained values (see
   ``least_overlap``), so each class enters only the lists of its rarest shared
   values, all but ``o - 1`` of them: a passage common to very many texts is
   skipped unless a text holds little else, and a class that shares fewer than
   ``o`` values leaves at once. Of the classes left the full sets are made, and those
   leave of whose shingles too few are in any other of these sets.
3. Star round. In each list the members are compared with three hubs. A group of
   near copies joins up in linear work.
4. Closing round. Components that meet in a list that still holds several are
   compared, each member with each, so no link between components is lost; pairs
   within one component can't change the result. No pair becomes a row: blocks of
   sets are multiplied inside tasks (see ``_closing_links``).

The star round first estimates similarity on the union's sketch; both rounds
count the intersection of the full sets and apply ``100 * i >= percent * u``.
Sets hold 64-bit hashes of shingles.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakemart.llm.common import block_pairs, connected_components, llm_query, named, segments, table
from lakemart.llm.textops import SMALL_BYTES, as_list_array, find_words, release_memory, shingles, text_chunks
from lakemart.session import cut_lineage

SKETCH_SIZE = 64
BLOCK_ROWS = 1024  # sets of a group that are compared at once with as many others
MATRIX_COLUMNS = 2048
MISS = 1e-6  # chance at most that a link at the threshold is not seen in the sketches

FEATURES = "doc_id long, n_shingles long, fp_a long, fp_b long, sketch array<long>"


def least_overlap(k: int, percent: int, miss: float = MISS) -> int:
    """Largest ``o`` so that a union sketch of ``k`` values, each in the intersection
    with chance ``percent`` / 100, has fewer than ``o`` of them there with chance
    ``miss`` at most. Draws without replacement vary less, so the bound holds."""
    p, below = percent / 100, 0.0
    for o in range(k + 1):
        below += comb(k, o) * p**o * (1 - p) ** (k - o)
        if below > miss:
            return o
    return k


def _sets(batch: pa.RecordBatch, width: int) -> Iterator[tuple[int, np.ndarray]]:
    for chunk in text_chunks(batch.column("text"), SMALL_BYTES):
        values, first = shingles(find_words(chunk), width)
        values = values.view(np.int64)
        for i in range(chunk.n):
            yield chunk.first + i, np.unique(values[first[i]:first[i + 1]])


def _fingerprint(values: np.ndarray) -> np.ndarray:
    return np.frombuffer(hashlib.md5(values.tobytes(), usedforsecurity=False).digest(), np.int64)


def shingle_features(docs: DataFrame, width: int, k: int, carry: tuple[str, ...] = ()) -> DataFrame:
    """Per row: set size, 128-bit fingerprint of the set, bottom-k sketch, and the columns ``carry``."""
    def run(batches):
        for batch in batches:
            n = batch.num_rows
            sizes, prints = np.zeros(n, np.int64), np.zeros((n, 2), np.int64)
            kept, counts = [], np.zeros(n, np.int64)
            for i, values in _sets(batch, width):
                sizes[i] = len(values)
                if len(values):
                    prints[i] = _fingerprint(values)
                kept.append(values[:k])
                counts[i] = len(kept[-1])
            sketch = np.concatenate(kept) if kept else np.zeros(0, np.int64)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(sizes), pa.array(prints[:, 0].copy()), pa.array(prints[:, 1].copy()),
                 as_list_array(sketch, counts, pa.int64()), *[batch.column(c) for c in carry]],
                ["doc_id", "n_shingles", "fp_a", "fp_b", "sketch", *carry])
            release_memory()
    docs = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"), *carry)
    return docs.mapInArrow(run, FEATURES + "".join(f", {c} {docs.schema[c].dataType.simpleString()}" for c in carry))


def full_sets(docs: DataFrame, width: int) -> DataFrame:
    """``(id, rep, members)``: the number of each row's class, its doc_id, its whole set sorted."""
    def run(batches):
        for batch in batches:
            at, rows, size = [], [], 0
            for i, values in _sets(batch, width):
                if len(values):
                    at.append(i)
                    rows.append(values)
                    size += len(values)
                if size > 1 << 20:
                    yield pack(batch, at, rows)
                    at, rows, size = [], [], 0
            if rows:
                yield pack(batch, at, rows)
            release_memory()

    def pack(batch, at, rows):
        ids = np.array([_fingerprint(r)[0] for r in rows])
        members = as_list_array(np.concatenate(rows), np.array([len(r) for r in rows]), pa.int64())
        return pa.RecordBatch.from_arrays([pa.array(ids), batch.column("doc_id").take(pa.array(at)), members],
                                          ["id", "rep", "members"])
    return docs.select("doc_id", F.col("text").cast("string")).mapInArrow(run, "id long, rep long, members array<long>")


def _verified(pairs: DataFrame, sets: DataFrame, percent: int, need) -> DataFrame:
    """Links among ``pairs(a, b)``: union-sketch estimate, then the full sets."""
    left = sets.select(F.col("id").alias("a"), F.col("members").alias("sa"))
    right = sets.select(F.col("id").alias("b"), F.col("members").alias("sb"))
    both = F.size(F.array_intersect("sa", "sb"))
    union = F.slice(F.sort_array(F.array_union(F.slice("sa", 1, SKETCH_SIZE), F.slice("sb", 1, SKETCH_SIZE))),
                    1, SKETCH_SIZE)
    common = F.array_intersect(F.slice("sa", 1, SKETCH_SIZE), F.slice("sb", 1, SKETCH_SIZE))
    estimate = F.size(F.array_intersect(union, common))
    near = (pairs.join(left, "a").join(right, "b")
            .where(estimate >= need(F.least(F.size("sa"), F.size("sb")))))
    return (near.withColumn("i", both)
            .where(F.lit(100) * F.col("i") >= F.lit(percent) * (F.size("sa") + F.size("sb") - F.col("i")))
            .select("a", "b"))


def near_duplicates(docs: DataFrame, width: int, percent: int, k: int = SKETCH_SIZE,
                    carry: tuple[str, ...] = ()) -> DataFrame:
    """``doc_id, n_shingles, component_id, kept`` and the columns ``carry`` for each row of ``docs(doc_id, text)``.

    Links texts whose shingle sets have ``100 * intersection >= percent * union``.
    Texts that are null, empty or blank have the empty set and link with nothing.
    Rows that repeat a doc_id each get a row. Rows without doc_id can't name a
    component: they link with nothing, their component is null and they are kept.
    An empty table gives an empty result; other columns are ignored."""
    spark: SparkSession = docs.sparkSession
    ceiling = least_overlap(k, percent)

    def need(size):  # shared retained values of a link, for a set of this size
        return F.least(F.lit(ceiling), F.ceil(F.least(size, F.lit(k)) * percent / 100)).cast("int")

    features = cut_lineage(shingle_features(docs, width, k, carry), "op1-features")
    usable = features.where("n_shingles > 0 AND doc_id IS NOT NULL")
    # a class is a distinct set; half of its 128-bit fingerprint numbers it, as rows may repeat a doc_id
    classes = cut_lineage(
        usable.groupBy(F.col("fp_a").alias("id"), "fp_b").agg(
            F.min("doc_id").alias("rep"), F.first("n_shingles").alias("n"), F.first("sketch").alias("sketch")),
        "op1-classes")
    postings = cut_lineage(_postings(classes, need), "op1-postings")
    members = postings.select(F.col("rep").alias("doc_id")).distinct()
    sets = cut_lineage(full_sets(docs.select(F.col("doc_id").cast("long"), "text").join(members, "doc_id", "left_semi")
                                 .dropDuplicates(["doc_id", "text"]), width), "op1-sets")
    postings = cut_lineage(postings.join(_with_partners(sets, percent), "id", "left_semi"), "op1-lists")

    similar_size = F.least("n", "hn") * 100 >= F.greatest("n", "hn") * percent
    pair = [F.least("id", "hub").alias("a"), F.greatest("id", "hub").alias("b")]
    hubs = (postings.groupBy("value").agg(F.count("*").alias("c"), *[
                F.min(F.struct(turn.alias("turn"), "id", "n")).alias(f"h{i}")
                for i, turn in enumerate((F.col("rep"), F.col("id"), -F.col("id")))])
            .where("c > 1").select("value", F.explode(F.array("h0", "h1", "h2")).alias("h"))
            .select("value", F.col("h.id").alias("hub"), F.col("h.n").alias("hn")))
    stars = postings.join(hubs, "value").where("id <> hub").where(similar_size).select(*pair).distinct()
    edges = cut_lineage(_verified(stars, sets, percent, need), "op1-links")
    labels = cut_lineage(connected_components(edges), "op1-labels")

    lists = postings.join(labels, "id", "left").withColumn("component", F.coalesce("component", "id"))
    mixed = (lists.groupBy("value").agg(F.min("component").alias("lo"), F.max("component").alias("hi"))
             .where("lo <> hi").select("value", "lo"))
    open_lists = cut_lineage(lists.join(mixed, "value").select("id", "component", "lo").distinct(), "op1-open")
    if not open_lists.isEmpty():
        more = cut_lineage(_closing_links(open_lists, sets, percent), "op1-links")
        if not more.isEmpty():
            labels = cut_lineage(connected_components(edges.union(more)), "op1-labels")

    linked = sets.select("id", "rep").join(labels, "id")
    lowest = linked.groupBy("component").agg(F.min("rep").alias("lowest"))
    named = (classes.select("id", "fp_b", "rep").join(linked.join(lowest, "component").select("id", "lowest").distinct(), "id", "left")
             .select(F.col("id").alias("fp_a"), "fp_b", F.coalesce("lowest", "rep").alias("component")))
    out = features.drop("sketch").join(named, ["fp_a", "fp_b"], "left")
    own = F.col("doc_id").isNull() | (F.col("n_shingles") == 0)
    component = F.when(own, F.col("doc_id")).otherwise(F.col("component"))
    return out.select("doc_id", "n_shingles", component.alias("component_id"),
                      F.col("doc_id").eqNullSafe(component).alias("kept"), *carry)


def _closing_links(open_lists: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links ``(a, b)`` between components that meet in open lists (``id, component, lo``: a member, its
    component and the least component in its list), enough of them to join what they join.

    Components that meet, directly or through others, form a group. The members of a group are
    compared in blocks: a matrix product over the shingles gives all intersections of two blocks, and
    a task emits one link a member at most."""
    meet = open_lists.select(F.col("component").alias("a"), F.col("lo").alias("b")).where("a <> b").distinct()
    groups = connected_components(meet).select(F.col("id").alias("component"), F.col("component").alias("meeting"))
    members = (open_lists.select("id", "component").distinct().join(groups, "component")
               .join(sets.select("id", "members"), "id").select("meeting", "id", "component", "members"))
    rows = block_pairs(cut_lineage(members, "op1-members"), "meeting", BLOCK_ROWS, both_ways=False)

    def run(key, group):
        group = group.sort_by("meeting")
        ids, component = group.column("id").to_numpy(), group.column("component").to_numpy()
        is_row, is_col = (group.column(c).to_numpy(zero_copy_only=False).astype(bool) for c in ("is_row", "is_col"))
        found = []
        for a, b in segments(group.column("meeting").to_numpy()):
            sets = group.column("members").slice(a, b - a).combine_chunks()
            link = _linked(sets.flatten().to_numpy(), np.asarray(sets.value_lengths()), is_row[a:b], is_col[a:b], percent)
            link &= component[a:b][:, None] != component[a:b][None]
            name = np.arange(b - a)
            while True:  # the least member that each reaches by links
                low = np.minimum(name, np.where(link, name[None], b - a).min(1))
                low = np.minimum(low, low[low])
                if (low == name).all():
                    break
                name = low
            joined = np.flatnonzero(name != np.arange(b - a))
            found.append(np.stack([ids[a + joined], ids[a + name[joined]]]))
        found = np.concatenate(found, axis=1).astype(np.int64)
        return pa.table({"a": found[0], "b": found[1]})
    return rows.groupBy("only", "i", "j").applyInArrow(run, "a long, b long")


def _linked(values: np.ndarray, sizes: np.ndarray, is_row: np.ndarray, is_col: np.ndarray, percent: int) -> np.ndarray:
    """Which sets (one after the other in ``values``) are linked, those on the one side with those on the other."""
    row = np.repeat(np.arange(len(sizes)), sizes)
    _, column, times = np.unique(values, return_inverse=True, return_counts=True)
    shared = times[column] > 1
    row, column = row[shared], np.unique(column[shared], return_inverse=True)[1]
    order = np.argsort(column, kind="stable")
    row, column = row[order], column[order]
    common = np.zeros((len(sizes), len(sizes)), np.float32)
    for lo in range(0, int(column[-1]) + 1 if len(column) else 0, MATRIX_COLUMNS):
        part = slice(*np.searchsorted(column, [lo, lo + MATRIX_COLUMNS]))
        has = np.zeros((len(sizes), MATRIX_COLUMNS), np.float32)
        has[row[part], column[part] - lo] = 1
        common += has @ has.T
    common = common.astype(np.int64)
    link = 100 * common >= percent * (sizes[:, None] + sizes[None] - common)
    link &= (is_row[:, None] & is_col[None]) | (is_col[:, None] & is_row[None])
    return link


def _postings(classes: DataFrame, need) -> DataFrame:
    """``(value, id, rep, n)``: each class in the lists of its rarest shared values."""
    lists = classes.select("id", "rep", "n", F.explode("sketch").alias("value"))
    frequent = lists.groupBy("value").agg(F.count("*").alias("df")).where("df > 1")
    ranked = (lists.join(frequent, "value").groupBy("id", "rep", "n")
              .agg(F.sort_array(F.collect_list(F.struct("df", "value"))).alias("shared")))
    keep = F.size("shared") - need(F.col("n")) + 1
    return (ranked.where(keep > 0).select("id", "rep", "n", F.explode(F.slice("shared", F.lit(1), keep)).alias("s"))
            .select(F.col("s.value").alias("value"), "id", "rep", "n"))


def _with_partners(sets: DataFrame, percent: int) -> DataFrame:
    """``id`` of the sets that may have a link: ``percent`` of the members must be in other sets, too."""
    each = sets.select("id", F.size("members").alias("n"), F.explode("members").alias("member"))
    shared = each.groupBy("member").agg(F.count("*").alias("df")).where("df > 1").select("member")
    found = each.join(shared, "member").groupBy("id").agg(F.count("*").alias("c"), F.first("n").alias("n"))
    return found.where(F.col("c") * 100 >= F.col("n") * percent).select("id")


def keep_one(docs: DataFrame, width: int = 5, percent: int = 80) -> DataFrame:
    """The rows of ``docs`` that stay when each group of near duplicates leaves one: that of the
    smallest doc_id, and of several texts of this doc_id the one of the smallest hash.

    Rows are told apart by doc_id and text, so a doc_id that comes with several texts loses
    those alone that are to go, and near copies under one doc_id leave one. Rows that repeat a doc_id
    and text go but for one. Rows without doc_id link like any other, and a group leaves one of them
    beside the one with a doc_id. Blank texts are in no group."""
    doc_id, text = F.col("doc_id").cast("long"), F.col("text").cast("string")
    keys = [F.xxhash64(doc_id, text).alias("key"), F.xxhash64(F.lit(1), doc_id, text).alias("key_b")]
    rows = docs.select(keys[0].alias("doc_id"), "text", doc_id.alias("own"), keys[1])
    found = near_duplicates(rows, width, percent, carry=("own", "key_b")).withColumnRenamed("doc_id", "key")
    chosen = (found.where("n_shingles > 0").groupBy("component_id", F.isnull("own"))
              .agg(F.min(F.struct("own", "key", "key_b")).alias("first")).select("first.key", "first.key_b"))
    stay = chosen.union(found.where("n_shingles = 0").select("key", "key_b"))
    nameless_blank = doc_id.isNull() & ~F.coalesce(text, F.lit("")).rlike(r"[^ \t-\r]")
    numbered = [named(c).alias(f"c{i}") for i, c in enumerate(docs.columns)]
    one_each = docs.where(~nameless_blank).select(*numbered, *keys).dropDuplicates(["key", "key_b"])
    kept = one_each.join(stay, ["key", "key_b"], "left_semi")
    return kept.select(*[F.col(f"c{i}").alias(c) for i, c in enumerate(docs.columns)]).unionByName(docs.where(nameless_blank))


#: All pairs of documents that share a shingle.
ORACLE_SQL = r"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x20\x09-\x0D]+') AS w
  FROM documents),
nodes AS (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
                      ELSE list_distinct(list_transform(range(1, len(w) - 1), lambda i: array_to_string(w[i:i + 2], ' '))) END AS s
  FROM words),
each AS (SELECT doc_id, len(s) AS n, unnest(s) AS shingle FROM nodes),
links AS (
  SELECT p.doc_id AS a, q.doc_id AS b FROM each p JOIN each q ON p.shingle = q.shingle AND p.doc_id <> q.doc_id
  GROUP BY p.doc_id, q.doc_id, p.n, q.n HAVING 100 * count(*) >= 85 * (p.n + q.n - count(*))),
reach AS (
  SELECT doc_id AS a, doc_id AS b FROM nodes
  UNION
  SELECT r.a, l.b FROM reach r JOIN links l ON l.a = r.b),
lowest AS (SELECT a AS id, min(b) AS component_id FROM reach GROUP BY a)
SELECT doc_id, CAST(len(s) AS BIGINT) AS n_shingles, component_id, doc_id = component_id AS kept
FROM nodes JOIN lowest ON lowest.id = doc_id"""


@llm_query("op1_minhash_near_dedup", ORACLE_SQL)
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three-word shingles, similarity 0.85, all documents."""
    return near_duplicates(table(spark, sf_dir, "documents"), width=3, percent=85)
