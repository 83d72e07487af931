"""Operator 13: Merkle manifest of a dataset as a content-addressed DAG.

Rows are leaves: the digest of a row's fields. The leaves of a tree, in order, are hashed in
runs of ``fan_out`` up to one node. The store holds digest-to-children records, packed by the
subtrees of ``pack_levels`` levels (a pack is found by the digest of its top node, has
``fan_out ** pack_levels`` records at most, and equal packs are stored once). Building goes
up in rounds, a round for each ``pack_levels`` levels: nodes are grouped by their pack, and a task
hashes one pack at a time.

A request for a leaf descends from the root: at each node its rank's next digit (base
``fan_out``, highest first) selects a child, and the unselected children are collected. Requests go
down together, a pack at a time, so that each pack is read once however many leaves are asked
for below it; a round's requests join the store on the digest they have reached. The
segments collected on the way are reversed at the leaf: its siblings from the leaf up.

No group is larger than a pack, and only the height of the highest tree goes to the driver.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import ArrayType, LongType, StringType, StructField, StructType

from lakemart.llm.common import llm_query, table
from lakemart.operators.paging import number_rows
from lakemart.session import cut_lineage

FAN_OUT = 2
PACK_LEVELS = 10
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")

RECORD = "struct<digest: string, children: array<string>>"
PATH = "array<array<string>>"
NODES = "tree long, rank long, n long, digest string"
NODE_PATH = StructType([StructField("tree", LongType()), StructField("rank", LongType()), StructField("digest", StringType()),
                        StructField("path", ArrayType(ArrayType(StringType())))])
RECORDS = pa.list_(pa.struct([("digest", pa.string()), ("children", pa.list_(pa.string()))]))


def digest(parts: list[str]) -> str:
    """Lower-case hex SHA-256 of the parts one after the other."""
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def field(value: Column) -> Column:
    """``-`` for null, else the number of UTF-8 bytes, ``:`` and the value."""
    text = value.cast("string")
    return F.when(text.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def leaf(values: list[Column]) -> Column:
    return F.sha2(F.concat(*[field(v) for v in values]), 256)


def height(n: int, fan_out: int) -> int:
    """Levels above ``n`` nodes up to a single one."""
    levels = 0
    while n > 1:
        n, levels = -(-n // fan_out), levels + 1
    return levels


def pack_records(nodes: list[str], levels: int, fan_out: int) -> tuple[str, list[tuple[str, list[str]]]]:
    """The top digest of consecutive nodes after ``levels`` levels, and a record for each node made."""
    records = []
    for _ in range(levels):
        runs = [nodes[i:i + fan_out] for i in range(0, len(nodes), fan_out)]
        nodes = [digest(run) for run in runs]
        records += zip(nodes, runs, strict=True)
    return nodes[0], records


def descend(records: dict[str, list[str]], top: str, offset: int, levels: int, fan_out: int) -> tuple[str, list[list[str]]]:
    """The node below ``top`` that the digits of ``offset`` lead to, and the unselected children, from the top down."""
    at, path = top, []
    for level in range(levels - 1, -1, -1):
        children, digit = records[at], offset // fan_out**level % fan_out
        path.append(children[:digit] + children[digit + 1:])
        at = children[digit]
    return at, path


def fold(node: str, rank: int, siblings: list[list[str]], fan_out: int) -> str:
    """The top node that follows from a node, its rank and its siblings from the lowest level up."""
    for others in siblings:
        digit, rank = rank % fan_out, rank // fan_out
        node = digest([*others[:digit], node, *others[digit:]])
    return node


@dataclass
class Forest:
    """The stored packs of some trees, lowest round first, and the trees' roots ``(tree, root)``."""

    packs: list[DataFrame]
    roots: DataFrame
    fan_out: int
    pack_levels: int

    @property
    def span(self) -> int:
        return self.fan_out**self.pack_levels


def build(nodes: DataFrame, fan_out: int = FAN_OUT, pack_levels: int = PACK_LEVELS) -> Forest:
    """Trees over ``nodes(tree, rank, n, digest)``: ``rank`` counts from 0 in each tree, ``n`` is its number of leaves.

    Every tree goes through all rounds; one that has a single node left passes it on without a record."""
    highest = nodes.agg(F.max("n")).first()[0] or 1
    rounds = max(1, -(-height(highest, fan_out) // pack_levels))
    span, packs = fan_out**pack_levels, []

    def run(key, group):
        order = pc.sort_indices(group.column("rank"))
        tree, rank, n = (k.as_py() for k in key)
        levels = min(pack_levels, height(n, fan_out))
        top, records = pack_records(group.column("digest").take(order).to_pylist(), levels, fan_out)
        return pa.table({"tree": [tree], "rank": [rank], "n": [max(1, -(-n // span))], "digest": [top], "levels": pa.array([levels], pa.int32()),
                         "records": pa.array([[{"digest": d, "children": c} for d, c in records]], RECORDS)})

    for _ in range(rounds):
        packed = nodes.groupBy("tree", F.expr(f"rank div {span}").alias("pack"), "n")
        made = cut_lineage(packed.applyInArrow(run, f"{NODES}, levels int, records array<{RECORD}>"), "op13-round")
        packs.append(made.select("digest", "levels", "records"))
        nodes = made.select("tree", "rank", "n", "digest")
    return Forest(packs, nodes.select("tree", F.col("digest").alias("root")), fan_out, pack_levels)


def _one_pack(out: StructType, own: list, more: list, span: int, fan_out: int):
    """The descents through one pack: a group of requests and the pack's row."""
    def run(key, below, pack):
        if not pack.num_rows or not below.num_rows:
            return pa.table({f.name: pa.array([], to_arrow_type(f.dataType)) for f in out.fields})
        top = {c: pack.column(c)[0].as_py() for c in ("digest", "path", "levels", "records")}
        records = {r["digest"]: r["children"] for r in top["records"]}
        found = [descend(records, top["digest"], r % span, top["levels"], fan_out) for r in below.column("rank").to_pylist()]
        columns = {"tree": below.column("tree"), "rank": below.column("rank"), "digest": pa.array([f[0] for f in found], pa.string()),
                   "path": pa.array([top["path"] + f[1] for f in found], pa.list_(pa.list_(pa.string())))}
        columns |= {f.name: below.column(f.name) for f in own}
        columns |= {f.name: pa.array(pack.column(f.name).to_pylist() * len(found), pack.column(f.name).type) for f in more}
        return pa.table(columns)
    return run


def requests_down(forest: Forest, asked: DataFrame, tops: DataFrame) -> DataFrame:
    """``asked(tree, rank, ...)`` (no leaf twice) with ``digest`` (the node found) and ``path`` (the unselected
    children from the root down, after those of ``tops(tree, digest, path, ...)``, the nodes where the descents begin).
    Other columns of either are handed on."""
    span, fan_out = forest.span, forest.fan_out
    more = [f for f in tops.schema if f.name not in ("tree", "digest", "path")]
    reached = tops.withColumn("rank", F.lit(0).cast("long"))
    for k in range(len(forest.packs) - 1, -1, -1):
        wanted = asked if k == 0 else asked.select("tree", F.expr(f"rank div {span**k}").alias("rank")).distinct()
        own = [f for f in wanted.schema if f.name not in ("tree", "rank")]
        store = forest.packs[k].dropDuplicates(["digest", "levels"])
        packs = reached.withColumnRenamed("rank", "pack").join(store, "digest")

        out = StructType([*NODE_PATH.fields, *own, *more])
        grouped = wanted.groupBy("tree", F.expr(f"rank div {span}").alias("pack")).cogroup(packs.groupBy("tree", "pack"))
        reached = grouped.applyInArrow(_one_pack(out, own, more, span, fan_out), out)
        if k:
            reached = cut_lineage(reached, "op13-descent")
    return reached


def ranked(rows: DataFrame) -> DataFrame:
    """``rows(tree_key, doc_id, leaf, ...)`` with ``tree`` (the number of its key, null first, by bytes), ``rank``
    in its tree (by doc_id, null first, then by leaf and the other columns) and ``n``, the tree's leaves."""
    numbered = number_rows(rows.select("tree_key", "doc_id", "leaf", *[c for c in rows.columns if c not in ("tree_key", "doc_id", "leaf")]),
                           ["tree_key", "doc_id", "leaf"])
    trees = numbered.groupBy("tree_key").agg(F.min("row_no").alias("first"), F.count("*").alias("n"))
    trees = number_rows(trees, "tree_key", "tree_no").select(
        F.col("tree_key").alias("own_key"), "first", "n", (F.col("tree_no") - 1).alias("tree"))
    return (numbered.join(trees, F.expr("tree_key <=> own_key")).withColumn("rank", F.col("row_no") - F.col("first"))
            .drop("own_key", "tree_key", "first", "row_no"))


def manifest(docs: DataFrame, changed: Column | None = None, fan_out: int = FAN_OUT, pack_levels: int = PACK_LEVELS) -> DataFrame:
    """``doc_id, leaf, subroot, root, rank, siblings, folded_root`` for each row of ``docs``.

    A tree for each ``lang`` (null is one), and one over their roots in the order of the languages. ``siblings`` are the
    unselected children from the leaf's level to the root, a list for each level. ``folded_root`` follows from them
    and the row's leaf; where ``changed`` (a condition on ``docs``) holds, from the leaf with ``n_chars`` one
    more (a null stays null). Null fields and texts have their own mark, an empty text another one. Rows that
    repeat a doc_id, or have none, are leaves each; equal rows have equal leaves next to each other. The order
    is total, so reruns agree. A lone row is its own root. An empty table gives an empty result; other columns
    are ignored."""
    integer = {"doc_id": "decimal(20,0)", "n_chars": "decimal(20,0)"}
    own = docs.select(*[F.col(f).cast(integer.get(f, "string")).alias(f) for f in FIELDS],
                      (changed if changed is not None else F.lit(False)).alias("changed"))
    more = [F.col(f) + F.lit(1) if f == "n_chars" else F.col(f) for f in FIELDS]
    rows = own.select(F.col("lang").alias("tree_key"), "doc_id", leaf([F.col(f) for f in FIELDS]).alias("leaf"),
                      F.when(F.col("changed"), leaf(more)).alias("other"))
    leaves = cut_lineage(ranked(rows), "op13-leaves")
    trees = build(leaves.select("tree", "rank", "n", F.col("leaf").alias("digest")), fan_out, pack_levels)
    count = trees.roots.count()
    over = height(count, fan_out)
    top = build(trees.roots.select(F.lit(0).cast("long").alias("tree"), F.col("tree").alias("rank"),
                                   F.lit(count).cast("long").alias("n"), F.col("root").alias("digest")), fan_out, pack_levels)
    langs = requests_down(top, trees.roots.select(F.lit(0).cast("long").alias("tree"), F.col("tree").alias("rank")),
                          top.roots.select("tree", F.col("root").alias("digest"), F.array().cast(PATH).alias("path"), "root"))
    langs = langs.select(F.col("rank").alias("tree"), "digest", "path", F.col("digest").alias("subroot"), "root")
    found = requests_down(trees, leaves.select("tree", "rank", "doc_id", "other"), cut_lineage(langs, "op13-subroots"))

    def run(batches):
        for batch in batches:
            names = ("tree", "rank", "digest", "other", "path")
            folded, siblings = [], []
            for t, r, d, o, path in zip(*(batch.column(c).to_pylist() for c in names), strict=True):
                up, h = path[::-1], len(path) - over
                siblings.append(up)
                folded.append(fold(fold(o or d, r, up[:h], fan_out), t, up[h:], fan_out))
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in ("doc_id", "digest", "subroot", "root", "rank")),
                 pa.array(siblings, pa.list_(pa.list_(pa.string()))), pa.array(folded, pa.string())],
                ["doc_id", "leaf", "subroot", "root", "rank", "siblings", "folded_root"])
    return found.withColumn("doc_id", F.col("doc_id").cast("long")).mapInArrow(
        run, f"doc_id long, leaf string, subroot string, root string, rank long, siblings {PATH}, folded_root string")


def checked(docs: DataFrame) -> DataFrame:
    """The digest of each row's proof, and whether its folded root is the root."""
    crc = F.crc32(F.col("doc_id").cast("long").cast("string").cast("binary"))
    found = manifest(docs, F.coalesce(crc % 7 == 0, F.lit(False)))
    proof = F.sha2(F.array_join(F.flatten("siblings"), ""), 256).alias("proof_sha256")
    return found.select("doc_id", "leaf", "subroot", "root", proof, "folded_root",
                        (F.col("folded_root") == F.col("root")).alias("verified"))


ORACLE_SQL = """
WITH RECURSIVE crc AS (
  SELECT *, xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda ch: CAST(ascii(ch) AS BIGINT))),
           lambda c, b: list_reduce(list_prepend(xor(c, b), [0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[]),
                                    lambda v, z: CASE WHEN v % 2 = 1 THEN xor(v // 2, 3988292384) ELSE v // 2 END)), 4294967295) AS h
  FROM documents),
fields AS (
  SELECT doc_id, lang, coalesce(h % 7 = 0, false) AS changed, n_chars,
         coalesce(strlen(CAST(doc_id AS VARCHAR)) || ':' || doc_id, '-') || coalesce(strlen(source) || ':' || source, '-')
           || coalesce(strlen(lang) || ':' || lang, '-') AS a,
         coalesce(strlen(CAST(n_chars AS VARCHAR)) || ':' || n_chars, '-') AS own,
         coalesce(strlen(CAST(n_chars + 1 AS VARCHAR)) || ':' || (n_chars + 1), '-') AS more,
         coalesce(strlen(text) || ':' || text, '-') AS b
  FROM crc),
leaves AS (
  SELECT doc_id, lang, sha256(a || own || b) AS leaf, CASE WHEN changed THEN sha256(a || more || b) END AS other FROM fields),
placed AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf, other NULLS FIRST) - 1 AS BIGINT) AS rank,
         count(*) OVER (PARTITION BY lang) AS n, CAST(dense_rank() OVER (ORDER BY lang NULLS FIRST) - 1 AS BIGINT) AS tree
  FROM leaves),
nodes AS (
  SELECT tree, 0 AS level, rank, n, leaf AS digest FROM placed
  UNION ALL
  SELECT tree, level + 1, rank // 2, (n + 1) // 2, sha256(string_agg(digest, '' ORDER BY rank))
  FROM nodes WHERE n > 1 GROUP BY tree, level, rank // 2, n),
subroots AS (SELECT tree, level, digest, count(*) OVER () AS trees FROM nodes WHERE n = 1),
tops AS (
  SELECT 0 AS level, tree AS rank, trees AS n, digest FROM subroots
  UNION ALL
  SELECT level + 1, rank // 2, (n + 1) // 2, sha256(string_agg(digest, '' ORDER BY rank))
  FROM tops WHERE n > 1 GROUP BY level, rank // 2, n),
steps AS (
  SELECT p.tree, p.rank, 0 AS above, n.level, CASE WHEN (p.rank >> n.level) % 2 = 0 THEN 0 ELSE 1 END AS digit, s.digest AS sibling
  FROM placed p JOIN nodes n ON n.tree = p.tree AND n.n > 1 AND n.rank = p.rank >> n.level
  LEFT JOIN nodes s ON s.tree = n.tree AND s.level = n.level AND s.rank = xor(n.rank, 1)
  UNION ALL
  SELECT p.tree, p.rank, 1, t.level, CASE WHEN (p.tree >> t.level) % 2 = 0 THEN 0 ELSE 1 END, s.digest
  FROM placed p JOIN tops t ON t.n > 1 AND t.rank = p.tree >> t.level
  LEFT JOIN tops s ON s.level = t.level AND s.rank = xor(t.rank, 1)),
numbered AS (SELECT *, row_number() OVER (PARTITION BY tree, rank ORDER BY above, level) AS step FROM steps),
proofs AS (SELECT tree, rank, sha256(coalesce(string_agg(sibling, '' ORDER BY step), '')) AS proof FROM numbered GROUP BY tree, rank),
folded AS (
  SELECT tree, rank, CAST(0 AS BIGINT) AS step, coalesce(other, leaf) AS digest FROM placed
  UNION ALL
  SELECT f.tree, f.rank, f.step + 1,
         sha256(CASE WHEN digit = 1 THEN coalesce(sibling, '') || digest ELSE digest || coalesce(sibling, '') END)
  FROM folded f JOIN numbered m ON m.tree = f.tree AND m.rank = f.rank AND m.step = f.step + 1)
SELECT p.doc_id, p.leaf, s.digest AS subroot, t.digest AS root, coalesce(r.proof, sha256('')) AS proof_sha256,
       f.digest AS folded_root, f.digest = t.digest AS verified
FROM placed p JOIN subroots s ON s.tree = p.tree JOIN tops t ON t.n = 1
LEFT JOIN proofs r ON r.tree = p.tree AND r.rank = p.rank
JOIN (SELECT tree, rank, arg_max(digest, step) AS digest FROM folded GROUP BY tree, rank) f ON f.tree = p.tree AND f.rank = p.rank"""


@llm_query("op13_merkle_manifest", ORACLE_SQL)
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents, a tree for each language."""
    return checked(table(spark, sf_dir, "documents"))
