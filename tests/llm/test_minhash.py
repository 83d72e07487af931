"""Operator 1 against pairwise comparison of all sets."""

import random
import re

import pytest

from lakemart.llm.minhash import keep_one, least_overlap, near_duplicates

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def shingle_set(text, width):
    words = WORD.findall((text or "").translate(LOWER))
    if len(words) < width:
        return {tuple(words)} if words else set()
    return {tuple(words[i:i + width]) for i in range(len(words) - width + 1)}


def brute(rows, width, percent):
    sets = {i: shingle_set(t, width) for i, t in rows}
    parent = {i: i for i in sets}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i
    ids = sorted(sets)
    for n, a in enumerate(ids):
        for b in ids[n + 1:]:
            if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
                x, y = sorted((root(a), root(b)))
                parent[y] = x
    return {i: (len(sets[i]), root(i), root(i) == i) for i in ids}


def corpus(seed=3):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(400)]
    text = lambda n: [rng.choice(vocabulary) for _ in range(n)]
    passage, docs = text(60), []
    for _ in range(20):  # originals with copies changed in a few words
        base = text(rng.randint(5, 150))
        docs.append(base)
        for _ in range(rng.randint(0, 5)):
            copy = list(base)
            for _ in range(rng.randint(0, 4)):
                copy[rng.randrange(len(copy))] = rng.choice(vocabulary)
            docs.append(copy)
    base = text(120)  # a large group of near copies, and texts that are mostly one passage
    for _ in range(60):
        copy = list(base)
        for _ in range(rng.randint(1, 3)):
            copy[rng.randrange(120)] = rng.choice(vocabulary)
        docs.append(copy)
    docs += [text(rng.randint(3, 25)) + passage + text(rng.randint(3, 25)) for _ in range(60)]
    docs += [text(rng.randint(1, 6)) for _ in range(30)]
    rng.shuffle(docs)
    return [(i, (" " if i % 3 else "\n\t").join(w.upper() if i % 5 == 0 else w for w in d)) for i, d in enumerate(docs)]


@pytest.mark.parametrize(("width", "percent"), [(3, 85), (5, 80)])
def test_components_match_all_pairs(shipped, width, percent):
    rows = corpus()
    found = near_duplicates(shipped.createDataFrame(rows, "doc_id long, text string").repartition(4), width, percent).collect()
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"], r["kept"]) for r in found} == brute(rows, width, percent)


def test_odd_rows(odd_documents):
    found = near_duplicates(odd_documents, 3, 85).collect()
    assert len(found) == odd_documents.count()
    by_id = {r["doc_id"]: (r["n_shingles"], r["component_id"], r["kept"]) for r in found if r["doc_id"]}
    assert [by_id[i] for i in (1, 2, 3)] == [(0, i, True) for i in (1, 2, 3)]
    assert by_id[4] == (1, 4, True) and by_id[5] == (1, 5, True) and by_id[6] == (1, 5, False)
    assert by_id[9] == (2, 9, True) and by_id[10] == (2, 9, False) and by_id[8] == (1, 8, True)
    assert all(r["component_id"] is None and r["kept"] for r in found if r["doc_id"] is None)


def test_one_of_each_group_stays(odd_documents):
    kept = keep_one(odd_documents.withColumnRenamed("size", "kept"), 3, 85)
    assert kept.columns == [*odd_documents.columns[:-1], "kept"]
    ids = [r["doc_id"] for r in kept.collect()]
    assert sorted(i for i in ids if i) == [1, 2, 3, 4, 5, 7, 8, 9, 11] and ids.count(None) == 2


def test_a_group_leaves_one_row_where_doc_ids_repeat(shipped):
    rng = random.Random(11)
    text = lambda: [f"w{rng.randrange(10**6)}" for _ in range(60)]
    near = lambda t: [*t[:-1], "changed"]
    x, y, z, own, nameless = text(), text(), text(), [text() for _ in range(6)], text()
    rows = [(5, x), (9, x), (5, y), (2, y),  # 9 goes to 5, (5, y) to 2
            (20, z), (20, near(z)), (20, z),  # near and exact copies under one doc_id
            *[(30, t) for t in own], (31, near(own[0])), (29, near(own[1])),  # one doc_id, many texts
            (None, nameless), (None, nameless), (None, near(nameless)), (None, []), (None, [])]
    docs = shipped.createDataFrame([(i, " ".join(t)) for i, t in rows], "doc_id long, text string").repartition(5)
    kept = [(r["doc_id"], r["text"]) for r in keep_one(docs).collect()]
    named = {(i, " ".join(t)) for i, t in [(5, x), (2, y), *[(30, t) for t in (own[0], *own[2:])], (29, near(own[1]))]}
    assert {r for r in kept if r[0] not in (None, 20)} == named
    assert [i for i, _ in kept].count(20) == 1 and len(kept) == len(named) + 1 + 3
    assert sorted(t for i, t in kept if i is None)[:2] == ["", ""]


def test_empty_table(no_documents):
    assert near_duplicates(no_documents, 3, 85).count() == 0
    assert keep_one(no_documents).count() == 0


def test_least_overlap_misses_few():
    from math import comb
    for k, percent in ((64, 85), (64, 80), (10, 90)):
        o, p = least_overlap(k, percent), percent / 100
        miss = sum(comb(k, i) * p**i * (1 - p) ** (k - i) for i in range(o))
        assert miss <= 1e-6 < miss + comb(k, o) * p**o * (1 - p) ** (k - o)
