"""Operator 11 against all pairs."""

import numpy as np
import pytest
from conftest import SF_CHECK
from test_vectors import frame, odd_rows

from lakemart.llm import collide
from lakemart.llm.collide import Best, Plan, nearest, op11, search_block, threshold, usable_vectors


def exact(queries, rows, k):
    out = {}
    for q, v in queries:
        found = sorted((-float(np.dot(v, w)), i) for i, w in rows if i != q and len(w) == len(v))
        out[q] = [(i, -s) for s, i in found[:k]]
    return out


def recall(found, want):
    hits = total = 0
    for q, best in want.items():
        least = best[-1][1]
        hits += sum(score >= least - 1e-12 for _, score in found.get(q, []))
        total += len(best)
    return hits / total


def listed(result):
    out = {}
    for r in sorted(result.collect(), key=lambda r: (r["query_id"], r["rank"])):
        assert r["rank"] == len(out.setdefault(r["query_id"], [])) + 1
        out[r["query_id"]].append((r["vec_id"], r["score"]))
    return out


def test_recall_on_the_given_vectors(shipped):
    rows = [(r["vec_id"], np.array(r["embedding"], float)) for r in shipped.read.parquet(f"{SF_CHECK}/embeddings.parquet").collect()]
    vectors = dict(rows)
    found = listed(op11(shipped, SF_CHECK))
    want = exact([r for r in rows if r[0] % 20 == 0], rows, 20)
    assert found.keys() == want.keys() and all(len(f) == 20 for f in found.values())
    for q, best in found.items():
        assert best == sorted(best, key=lambda b: (-b[1], b[0])) and q not in dict(best)
        assert all(abs(s - float(np.dot(vectors[q], vectors[i]))) < 1e-12 for i, s in best)
    assert recall(found, want) >= 0.95


@pytest.mark.parametrize("lengths", ["equal", "uneven"])
def test_recall_over_blocks_and_batches(shipped, monkeypatch, lengths):
    monkeypatch.setattr(collide, "BLOCK_ROWS", 256)
    rng = np.random.default_rng(5)
    x = rng.normal(size=(1500, 24)) * (rng.lognormal(0, 0.5, size=(1500, 1)) if lengths == "uneven" else 1)
    x[700:760] = x[3]  # equal rows: ties by vec_id
    rows = [(i, x[i]) for i in range(len(x))]
    vectors = usable_vectors(frame(shipped, [(i, v.tolist()) for i, v in rows])).cache()
    single = [(r["vec_id"], np.array(r["vector"])) for r in vectors.collect()]
    found = listed(nearest(vectors.where("vec_id % 50 = 0"), vectors, 10, batch_bytes=24 * 8 * 7))
    want = exact([r for r in single if r[0] % 50 == 0], single, 10)
    assert recall(found, want) >= 0.95
    ties = [i for i, s in found[700] if s == found[700][0][1]]
    assert ties == sorted(ties)


def test_odd_vectors_and_few_candidates(shipped):
    vectors = usable_vectors(frame(shipped, odd_rows()))
    found = listed(nearest(vectors.where("vec_id IN (1, 3, 4, 7, 10, 11)"), vectors, 20))
    assert found == {7: [(9, 28.0), (8, 14.0), (11, -14.0)], 10: [], 11: [(7, -14.0), (7, -14.0), (8, -14.0), (9, -28.0)]} or \
        found == {7: [(9, 28.0), (8, 14.0), (11, -14.0)], 11: [(7, -14.0), (7, -14.0), (8, -14.0), (9, -28.0)]}
    none = usable_vectors(frame(shipped, []))
    assert nearest(none, vectors).count() == 0 and nearest(vectors, none).count() == 0


def test_a_row_at_the_radius_has_the_collisions():
    plan = Plan(1.0, 1.0, size=63)
    away = np.random.default_rng(2).normal(size=(4000, 64))
    away /= np.linalg.norm(away, axis=1, keepdims=True)
    hits = (np.abs(away @ plan.directions) <= collide.WINDOW / 8).sum(1)
    assert threshold(plan.directions) == plan.least
    assert (hits >= plan.least).mean() >= 1 - collide.MISSED - 0.02


def test_far_rows_are_not_verified():
    """In clusters, windows stay narrow: few rows are verified."""
    rng = np.random.default_rng(8)
    centres = rng.normal(size=(50, 64))
    x = centres[np.arange(4000) % 50] + rng.normal(size=(4000, 64)) * 0.05
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    plan = Plan(float(np.abs(x).max()), float(np.linalg.norm(x / np.abs(x).max(), axis=1).max()), size=64)
    best, ids = Best(40, 20), np.arange(4000)
    verified = search_block(plan, x[:40], ids[:40], x, ids, best)
    assert verified < 40 * 4000 * 0.1
    want = np.sort(x[:40] @ x.T - 2 * (np.arange(40)[:, None] == ids[None]), axis=1)[:, -20]
    assert (best.score >= want[:, None] - 1e-12).mean() >= 0.95
