"""Operator 12 against a scan of all lags, word by word."""

import hashlib
import random

import numpy as np
import pyarrow as pa
import pytest
from conftest import SF_CHECK

from lakemart.llm import periodic
from lakemart.llm.periodic import chunk_runs, digests, op12, periodic_runs, planted, surviving_segments
from lakemart.llm.textops import text_chunks

SPACE = b" \t\n\x0b\x0c\r"


def words_of(text):
    out = (text or "").encode()
    for c in SPACE[1:]:
        out = out.replace(bytes([c]), b" ")
    return [w for w in out.split(b" ") if w]


def brute(w):
    found = {}
    for q in range(1, len(w) // 4 + 1):
        i = 0
        while i + q < len(w):
            j = i
            while j + q < len(w) and w[j] == w[j + q]:
                j += 1
            if j > i and j - i + q >= max(6, 4 * q):
                found.setdefault((i, j - i + q), q)
            i = max(j, i + 1)
    runs = sorted(((s, n, q) for (s, n), q in found.items()), key=lambda r: (r[0], r[2]))
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    return runs, b" ".join(x for i, x in enumerate(w) if i not in gone)


def row_of(doc_id, text):
    w = words_of(text)
    turn = planted(doc_id, len(w)) if w else None
    if turn:
        a, p = turn
        w = [w[i] if i < a else w[a + (i - a) % p] for i in range(len(w))]
    runs, text = brute(w)
    best = min(runs, key=lambda r: (-r[1] / r[2], r[0], r[2]), default=(None,) * 3)
    lines = "".join(f"{s},{n},{q}\n" for s, n, q in runs)
    return (doc_id, len(runs), *best, best[1] and 1000 * best[1] // best[2],
            hashlib.sha256(lines.encode()).hexdigest(), hashlib.sha256(text).hexdigest())


@pytest.mark.parametrize("seed", range(6))
def test_random_texts(seed, monkeypatch):
    rng = random.Random(seed)
    monkeypatch.setattr(periodic, "SCAN_ROWS", rng.choice([7, 50, 1 << 20]))
    for _ in range(60):
        texts = []
        for _ in range(rng.randint(1, 8)):
            kinds, n = rng.choice([1, 2, 2, 3, 5, 20]), rng.choice([0, 1, 5, 6, 7, 20, 60, 150])
            w = [rng.choice("abcdefghijklmnopqrstuvwx"[:kinds]) for _ in range(n)]
            for _ in range(rng.randint(0, 3) if w else 0):
                a, p = rng.randrange(n), rng.randint(1, 8)
                for i in range(a + p, min(n, a + rng.randint(1, 60))):
                    w[i] = w[i - p]
            texts.append(rng.choice([" ", "  ", "\n"]).join(w))
        for chunk in text_chunks(pa.array(texts), rng.choice([30, 1 << 20])):
            runs, text, bounds = chunk_runs(chunk)
            for i in range(chunk.n):
                want = brute(words_of(texts[chunk.first + i]))
                assert ([tuple(r) for r in runs[i].tolist()], text[bounds[i]:bounds[i + 1]].tobytes()) == want


def test_all_documents(shipped):
    docs = shipped.read.parquet(f"{SF_CHECK}/documents.parquet").select("doc_id", "text").collect()
    found = {tuple(r) for r in op12(shipped, SF_CHECK).collect()}
    assert found == {row_of(r["doc_id"], r["text"]) for r in docs}


def test_rare_words_split_again_and_again():
    # x splits; within the parts y is rare, then z
    w = "a y a y a z a x y z y z b b b b b b x a".split()
    code = np.unique(w, return_inverse=True)[1].astype(np.uint64)
    begin, end = surviving_segments(code, np.zeros(len(w), np.int64))
    assert [" ".join(w[a:b]) for a, b in zip(begin, end, strict=True)] == ["b b b b b b"]


def test_odd_documents(shipped, odd_documents, no_documents):
    rows = odd_documents.select("doc_id", "text").collect()
    found = [tuple(r) for r in digests(periodic_runs(odd_documents, planted)).collect()]
    assert sorted(found, key=str) == sorted((row_of(r["doc_id"], r["text"]) for r in rows), key=str)
    assert digests(periodic_runs(no_documents)).count() == 0
    texts = {r["doc_id"]: r for r in periodic_runs(shipped.createDataFrame([(1, "go " + "ha " * 8 + "Ha stop")], "doc_id long, text string")).collect()}
    assert texts[1]["collapsed"] == "go ha Ha stop" and texts[1]["strongest"].asDict() == {"start": 1, "length": 8, "period": 1}


def test_a_long_text_in_parts(monkeypatch):
    rng = random.Random(3)
    text = " ".join(rng.choice(["ab", "cd", "efg", "h" * 50]) for _ in range(4000)) + " tail" * 9
    monkeypatch.setattr("lakemart.llm.textops.text_parts.__defaults__", (97,))
    chunk = next(text_chunks(pa.array([text])))
    runs, left, _ = chunk_runs(chunk)
    assert ([tuple(r) for r in runs[0].tolist()], left.tobytes()) == brute(words_of(text))


def test_hashes_that_agree_by_chance(monkeypatch):
    """Stretches that are equal by hash alone are compared word by word."""
    monkeypatch.setattr(periodic.Blocks, "equal", lambda self, at, lag, size: np.ones(len(at), bool))
    text = "a b a b a b a b c d a b a b a b a b a e"
    runs, _, _ = chunk_runs(next(text_chunks(pa.array([text]))))
    assert [tuple(r) for r in runs[0].tolist()] == brute(words_of(text))[0]
