"""Operators 5 and 7 against all pairs."""

import math

import numpy as np
import pytest
from conftest import SF_CHECK, SF_SMALL

from lakemart.llm.lattice import ROOTS, decode, near_vectors
from lakemart.llm.topk import integer_vectors, op7, top_k, top_of_block

VECTORS = "vec_id long, embedding array<float>, label int, rank string"


def frame(spark, rows):
    return spark.createDataFrame([(i, v, 0, "own") for i, v in rows], VECTORS).repartition(3)


def odd_rows():
    nan, inf = float("nan"), float("inf")
    return [(1, None), (2, []), (3, [0.0, 0.0, -0.0]), (4, [1.0, None, 2.0]), (5, [nan, 1.0, 1.0]), (6, [inf, 1.0, 1.0]),
            (7, [1.0, 2.0, 3.0]), (8, [1.0, 2.0, 3.0]), (9, [2.0, 4.0, 6.0]), (10, [1.0, 2.0]), (11, [-1.0, -2.0, -3.0]),
            (None, [1.0, 2.0, 3.0]), (7, [1.0, 2.0, 3.0])]


def clustered(n=400, d=64, seed=4):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, d))
    for i in range(40, 160):  # groups of copies of growing looseness
        x[i] = x[i % 10] + rng.normal(size=d) * (0.02 + 0.002 * (i - 40))
    x[160:200] = x[11]  # equal vectors
    return [(int(i), [float(np.float32(v)) for v in row]) for i, row in enumerate(x)]


def test_links_of_clusters_are_found(shipped):
    rows = clustered()
    x = np.array([v for _, v in rows])
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    links = (unit @ unit.T >= 0.9) & ~np.eye(len(x), dtype=bool)
    found = {r["vec_id"]: r for r in near_vectors(frame(shipped, rows)).collect()}
    assert len(found) == len(rows)
    got = np.array([found[i]["n_links"] for i in range(len(rows))])
    assert (got <= links.sum(1)).all() and got.sum() >= 0.98 * links.sum()
    assert [found[i]["n_links"] for i in range(160, 200)] == [40] * 40
    assert {found[i]["component_id"] for i in range(160, 200)} == {11}
    assert all(r["kept"] == (r["vec_id"] == r["component_id"]) for r in found.values())


def test_large_components_are_counted_in_blocks(shipped, monkeypatch):
    from lakemart.llm import lattice
    monkeypatch.setattr(lattice, "BLOCK_ROWS", 16)
    rng = np.random.default_rng(6)
    base = rng.normal(size=64)
    rows = [(i, [float(v) for v in base + rng.normal(size=64) * 0.1]) for i in range(100)]
    found = near_vectors(frame(shipped, rows)).collect()
    assert {(r["n_links"], r["component_id"]) for r in found} == {(99, 0)}


def cloud(n, d=64, cosine=0.8, seed=7):
    """Vectors about one direction, with about this cosine between any two: none linked but a few planted ones."""
    rng = np.random.default_rng(seed)
    noise = rng.normal(size=(n, d)) * math.sqrt((1 / cosine - 1) / d)
    x = rng.normal(size=d)
    x = x / np.linalg.norm(x) + noise
    for i in range(0, n // 10, 2):
        x[i + 1] = x[i] + rng.normal(size=d) * 0.01
    return x


@pytest.mark.parametrize("rows", [512, 16])
def test_a_dense_cloud_is_closed_in_blocks(shipped, monkeypatch, rows):
    from lakemart.llm import lattice
    monkeypatch.setattr(lattice, "CELL_ROWS", rows)
    x = cloud(600)
    x[100:200] = x[100] + 0.02 * (x[100:200] - x.mean(0))  # a group that joins up at once
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    cos = unit @ unit.T
    links = (cos >= 0.9) & ~np.eye(len(x), dtype=bool)
    assert not ((cos > 0.899999) & (cos < 0.900001)).any()
    found = {r["vec_id"]: r for r in near_vectors(frame(shipped, [(i, [float(v) for v in r]) for i, r in enumerate(x)])).collect()}
    got = np.array([found[i]["n_links"] for i in range(len(x))])
    assert (got <= links.sum(1)).all() and got.sum() >= 0.98 * links.sum()
    assert {found[i]["component_id"] for i in range(101, 200)} == {found[100]["component_id"]}


def test_links_of_open_cells_join_what_all_pairs_join(shipped):
    from lakemart.llm.common import connected_components
    from lakemart.llm.lattice import _closing_links
    x = np.concatenate([cloud(40, seed=1), cloud(40, seed=2)])
    classes = shipped.createDataFrame([(i, [float(v) for v in r]) for i, r in enumerate(x)], "id long, vector array<double>")
    cells = [(k, i, i) for k, ids in enumerate([range(0, 40), range(0, 40), range(20, 60), range(78, 80)]) for i in ids]
    lists = shipped.createDataFrame(cells, "key long, id long, component long")
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    shared = np.zeros((80, 80), bool)
    for ids in (range(0, 40), range(20, 60), range(78, 80)):
        shared[np.ix_(ids, ids)] = True
    a, b = np.nonzero(shared & (unit @ unit.T >= 0.9) & ~np.eye(80, dtype=bool))
    want = shipped.createDataFrame([(int(p), int(q)) for p, q in zip(a, b)], "a long, b long")
    assert len(a) >= 2
    found = _closing_links(lists, classes, 0.9)
    assert sorted(connected_components(found).collect()) == sorted(connected_components(want).collect())


def test_odd_vectors(shipped):
    found = near_vectors(frame(shipped, odd_rows())).collect()
    assert len(found) == 13
    by_id = {(r["vec_id"], r["n_links"], r["component_id"], r["kept"]) for r in found}
    assert {(i, 0, i, True) for i in (1, 2, 3, 4, 5, 6, 10, 11)} <= by_id
    assert {(7, 3, 7, True), (8, 3, 7, False), (9, 3, 7, False), (None, 0, None, True)} <= by_id
    assert near_vectors(frame(shipped, [])).count() == 0


def test_decoding_gives_the_nearest_point():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(500, 8)) * 3
    point = decode(x)
    whole, half = np.abs(point - np.rint(point)).max(1) < 1e-9, np.abs(point - 0.5 - np.rint(point - 0.5)).max(1) < 1e-9
    assert (whole | half).all() and (np.rint(point.sum(1)) % 2 == 0).all()
    here = ((x - point) ** 2).sum(1)
    around = ((x[:, None] - point[:, None] - ROOTS[None]) ** 2).sum(2).min(1)
    assert (here <= around + 1e-9).all() and here.max() <= 1 + 1e-9


def brute_top(queries, rows, k):
    out = []
    for q, v in queries:
        found = sorted((-sum(a * b for a, b in zip(v, w)), i) for i, w in rows if i != q and len(w) == len(v))
        out += [(q, n + 1, i, -s) for n, (s, i) in enumerate(found[:k])]
    return out


def test_top_k_of_all_embeddings(shipped):
    rows = [(r["vec_id"], [math.floor(256 * float(x)) for x in r["embedding"]])
            for r in shipped.read.parquet(f"{SF_SMALL}/embeddings.parquet").collect()]
    want = brute_top([r for r in rows if r[0] % 50 == 0], rows, 5)
    assert sorted(tuple(r) for r in op7(shipped, SF_SMALL).collect()) == sorted(want)


def test_ties_go_to_the_smaller_id(shipped, monkeypatch):
    from lakemart.llm import topk
    monkeypatch.setattr(topk, "CANDIDATE_ROWS", 20)
    rng = np.random.default_rng(3)
    rows = [(int(i), [float(v) / 256 for v in rng.integers(-2, 3, size=4)]) for i in range(200)]
    whole = [(i, [round(256 * x) for x in v]) for i, v in rows]
    vectors = integer_vectors(frame(shipped, rows))
    found = top_k(vectors.where("vec_id % 10 = 0"), vectors, 5).collect()
    assert sorted(tuple(r) for r in found) == sorted(brute_top([r for r in whole if r[0] % 10 == 0], whole, 5))


def test_odd_vectors_and_few_candidates(shipped):
    vectors = integer_vectors(frame(shipped, odd_rows()))
    found = [tuple(r) for r in top_k(vectors.where("vec_id IN (1, 4, 7, 10, 11)"), vectors, 5).orderBy("query_id", "rank").collect()]
    v = 256 * 256
    assert found == [(7, 1, 9, 28 * v), (7, 2, 8, 14 * v), (7, 3, 3, 0), (7, 4, 11, -14 * v),
                     (11, 1, 3, 0), (11, 2, 7, -14 * v), (11, 3, 7, -14 * v), (11, 4, 8, -14 * v), (11, 5, 9, -28 * v)]
    assert top_k(integer_vectors(frame(shipped, [])), vectors).count() == 0


@pytest.mark.parametrize("size", [1.0, 2.0**40])
def test_large_integers_stay_exact(size):
    rng = np.random.default_rng(9)
    x = (rng.integers(-1000, 1000, size=(50, 6)) * int(size)).astype(np.int64)
    ids = np.arange(50)
    found = set(zip(*(a.tolist() for a in top_of_block(x[:3], ids[:3], x, ids, 4)[:3])))
    want = {(q, i, max(-(2**63), min(2**63 - 1, s))) for q, _, i, s in brute_top([(i, x[i].tolist()) for i in range(3)],
                                                                                [(i, x[i].tolist()) for i in range(50)], 4)}
    assert found == want


@pytest.mark.parametrize("name", ["random", "copies", "uneven", "small", "zeros", "few"])
def test_bounds_leave_out_no_row_of_the_best(name):
    rng = np.random.default_rng(11)
    n, d = (4, 6) if name == "few" else (700, 24)
    x = rng.normal(size=(n, d)) * 256
    if name == "copies":
        x = x[rng.integers(0, 5, n)]
    elif name == "uneven":
        x *= np.exp(rng.normal(size=d) * 2)
    elif name == "small":
        x /= 128
    elif name == "zeros":
        x *= rng.random((n, d)) < 0.05
    x, ids = np.floor(x).astype(np.int64), rng.permutation(n) * 3
    places = np.arange(0, n, max(1, n // 30))
    q, found, score, _ = top_of_block(x[places], ids[places], x, ids, 5)
    scores = x[places] @ x.T
    for j, p in enumerate(places):
        rest = [i for i in range(n) if i != p]
        want = sorted((-int(scores[j, i]), int(ids[i])) for i in rest)[:5]
        assert [(-int(s), int(i)) for s, i in zip(score[q == j], found[q == j])] == want


def test_queries_stop_early_on_the_given_vectors(shipped):
    vectors = integer_vectors(shipped.read.parquet(f"{SF_CHECK}/embeddings.parquet"))
    rows = top_k(vectors.where("vec_id % 50 = 0"), vectors, 5, reads=True).where("rank = 1").collect()
    shares = [r["entries_read"] / r["entries"] for r in rows]
    assert len(shares) == 10 and max(shares) < 1 and sum(shares) < 0.9 * len(shares)
