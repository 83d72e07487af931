"""Operator 2: sizes, numbers, balance and the map's versions."""

import random
import zlib
from collections import Counter, defaultdict

import pytest
from conftest import SF_SMALL

from lakemart.llm.sharding import VIRTUAL_SLOTS, assign_shards, first_map, grow, op2, rebalance


def test_all_documents_lie_in_even_shards(shipped):
    texts = {r["doc_id"]: r["text"] or "" for r in shipped.read.parquet(f"{SF_SMALL}/documents.parquet").collect()}
    rows = op2(shipped, SF_SMALL).collect()
    assert {r["doc_id"]: (r["size"], r["text_crc32"]) for r in rows} == {
        i: (len(t.encode()) + 1, zlib.crc32(t.encode())) for i, t in texts.items()}
    slots, load = defaultdict(list), Counter()
    for r in rows:
        slots[r["shard"]].append(r["slot"])
        load[r["shard"]] += r["size"]
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert max(load.values()) - min(load.values()) < 0.02 * sum(load.values()) / 16
    assert {(r["law"], r["grown_shard"]) for r in rows} == {("bytes", None)}


def test_no_python_in_the_plan(shipped):
    plan = op2(shipped, SF_SMALL)._jdf.queryExecution().toString()
    assert not any(w in plan for w in ("Python", "Pandas", "Arrow"))


def test_odd_rows_and_stored_map(odd_documents):
    out, path = assign_shards(odd_documents, 4)
    rows = out.collect()
    assert len(rows) == odd_documents.count()
    assert {r["size"] for r in rows if r["text_crc32"] == 0} == {1}
    for shard in range(4):
        own = sorted(r["slot"] for r in rows if r["shard"] == shard)
        assert own == list(range(len(own)))
    stored = odd_documents.sparkSession.read.parquet(path)
    assert {tuple(r) for r in stored.groupBy("version").count().collect()} == {(1, VIRTUAL_SLOTS), (2, VIRTUAL_SLOTS)}
    assert {r["map_version"] for r in rows} == {2}
    assert stored.where("version = 1").select("shard").distinct().count() == 4


def test_empty_table(no_documents):
    assert assign_shards(no_documents, 16)[0].count() == 0


def rows_by_shard(spark, docs, shards, path):
    rows = assign_shards(docs, shards, path)[0].collect()
    for shard in range(shards):
        own = sorted(r["slot"] for r in rows if r["shard"] == shard)
        assert own == list(range(len(own)))
    return rows


def test_a_kept_map_is_edited_by_later_runs(shipped, tmp_path):
    path = str(tmp_path / "map")
    first, second = (shipped.range(lo, lo + 3000).selectExpr("id AS doc_id", "repeat('word ', int(id % 97)) AS text")
                     for lo in (0, 10_000))
    one = rows_by_shard(shipped, first, 4, path)
    assert {r["map_version"] for r in one} == {2}
    assert {r["map_version"] for r in rows_by_shard(shipped, first, 4, path)} == {2}  # nothing to edit
    two = rows_by_shard(shipped, second, 4, path)
    assert {r["map_version"] for r in two} == {3}
    three = rows_by_shard(shipped, second, 5, path)
    assert {r["map_version"] for r in three} <= {4, 5} and {r["shard"] for r in three} == set(range(5))
    grown = dict(shipped.read.parquet(path).where("version = 4").select("virtual_slot", "shard").collect())
    kept = dict(shipped.read.parquet(path).where("version = 3").select("virtual_slot", "shard").collect())
    assert {grown[s] for s in grown if grown[s] != kept[s]} == {4}
    again = shipped.read.parquet(path)
    assert again.count() == VIRTUAL_SLOTS * again.agg({"version": "max"}).first()[0]
    with pytest.raises(ValueError, match="has 5 shards"):
        assign_shards(first, 4, path)
    rows = assign_shards(first.limit(0), 5, path)[0]
    assert rows.count() == 0 and shipped.read.parquet(path).count() == again.count()


def test_equal_rows_without_doc_id_are_numbered_in_pieces(shipped, monkeypatch):
    from lakemart.llm import sharding
    monkeypatch.setattr(sharding, "PIECE", 10)
    docs = shipped.range(3000).selectExpr("if(id % 3 = 0, NULL, id) AS doc_id", "if(id % 3 = 0, 'same', string(id)) AS text")
    rows = rows_by_shard(shipped, docs, 4, None)
    assert len(rows) == 3000
    equal = [r for r in rows if r["doc_id"] is None]
    assert len(equal) == 1000 and len({(r["shard"], r["slot"]) for r in equal}) == 1000
    assert Counter(r["doc_id"] for r in rows if r["doc_id"] is not None).most_common(1)[0][1] == 1


def test_rebalance_moves_only_what_helps():
    rng = random.Random(1)
    sizes = [int(rng.paretovariate(1.5) * 100) for _ in range(VIRTUAL_SLOTS)]
    before = first_map(16)
    after = rebalance(before, sizes, 16)
    load = [sum(s for s, o in zip(sizes, after) if o == k) for k in range(16)]
    assert max(load) - min(load) < 0.001 * sum(sizes) / 16
    assert rebalance(after, sizes, 16) == after
    assert sum(a != b for a, b in zip(before, after)) < VIRTUAL_SLOTS / 4


def test_a_new_shard_takes_slots_only_into_itself():
    rng = random.Random(2)
    sizes = [rng.randint(0, 1000) for _ in range(VIRTUAL_SLOTS)]
    before = rebalance(first_map(16), sizes, 16)
    after = grow(before, sizes, 16)
    assert {b for a, b in zip(before, after) if a != b} == {16}
    load = [sum(s for s, o in zip(sizes, after) if o == k) for k in range(17)]
    assert max(load) - min(load) < 0.02 * sum(sizes) / 17
