"""Operator 3: counts and base scores by brute force, the recursions by enumeration, the model as a distribution."""

import itertools
import math
import re
import zlib
from collections import Counter

import numpy as np
from conftest import SF_SMALL

from lakemart.llm.hmm import Lanes, op3, score_documents

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def model(seed=0, k=3, classes=4):
    rng = np.random.default_rng(seed)
    rows = lambda n, m: (lambda x: x / x.sum(1, keepdims=True))(rng.random((n, m)) + 0.1)
    return rows(1, k)[0], rows(k, k), rows(k, classes)


def paths(sequence, start, move, emit):
    """Each path of states and its probability."""
    for states in itertools.product(range(len(start)), repeat=len(sequence)):
        p = start[states[0]] * emit[states[0], sequence[0]]
        for a, b, c in zip(states, states[1:], sequence[1:]):
            p *= move[a, b] * emit[b, c]
        yield states, p


def test_forward_sums_all_paths_and_counts_are_expected():
    start, move, emit = model()
    sequences = [np.array(s) for s in ([0], [1, 2, 3], [3, 3, 0, 1, 2], [2, 1], [0, 1, 2])]
    lanes = Lanes(sequences)
    logs = lanes.forward(start, move, np.ascontiguousarray(emit.T))
    first, pairs, shown = lanes.expected(move, 4)
    want = np.zeros(3), np.zeros((3, 3)), np.zeros((3, 4))
    for s, log in zip(sequences, logs):
        total = sum(p for _, p in paths(s, start, move, emit))
        assert abs(log - math.log(total)) < 1e-9
        for states, p in paths(s, start, move, emit):
            want[0][states[0]] += p / total
            for a, b in zip(states, states[1:]):
                want[1][a, b] += p / total
            for a, c in zip(states, s):
                want[2][a, c] += p / total
    for found, w in zip((first, pairs, shown), want):
        assert np.allclose(found, w)


def test_counts_and_base_scores(shipped):
    texts = {r["doc_id"]: r["text"] or "" for r in shipped.read.parquet(f"{SF_SMALL}/documents.parquet").collect()}
    tokens = {i: [*WORD.findall(t.translate(LOWER)), "\0"] for i, t in texts.items()}
    out = {i: zlib.crc32(str(i).encode()) % 7 == 2 for i in texts}
    c = Counter(w for i, ws in tokens.items() if not out[i] for w in ws)
    n = sum(c.values())
    rows = op3(shipped, SF_SMALL).collect()
    assert len(rows) == len(texts)
    for r in rows:
        ws = tokens[r["doc_id"]]
        base = sum(math.log10((c[w] + 1) / (n + len(c) + 1)) for w in ws)
        assert (r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"]) == (
            out[r["doc_id"]], len(ws), sum(c[w] > 0 for w in ws), n)
        assert math.isclose(r["base_score"], base, rel_tol=1e-9)
    unseen = [r for r in rows if r["held_out"]]
    assert sum(r["score"] for r in unseen) > sum(r["base_score"] for r in unseen)


def test_one_word_texts_share_out_probability(shipped):
    """The end alone and one-word texts: their probabilities can't sum to more than 1."""
    words = [f"{a}{b}" for a in "abc" for b in "xyz"]
    rows = [(i, " ".join(words[(i + j) % 9] for j in range(i % 4))) for i in range(200)]
    rows += [(1000 + i, w) for i, w in enumerate([*words, "", "unheard", "of"])]
    found = {r["doc_id"]: r["score"] for r in score_documents(shipped.createDataFrame(rows, "doc_id long, text string")).collect()}
    total = sum(10 ** found[1000 + i] for i in range(11))
    assert 0.3 < total <= 1 + 1e-9 and all(s < 0 for s in found.values())


def test_odd_rows(odd_documents, no_documents):
    rows = score_documents(odd_documents).collect()
    assert len(rows) == odd_documents.count()
    assert {r["n_tokens"] for r in rows if r["doc_id"] in (1, 2, 3)} == {1}
    assert all(math.isfinite(r["score"]) for r in rows)
    assert score_documents(no_documents).count() == 0
    only = odd_documents.where("doc_id = 4")  # without training rows, or with one
    assert only.count() == 1 and math.isfinite(score_documents(only).first()["score"])
