"""Operators 4 and 9: the fits by brute force, held-out accuracy, odd rows."""

import random

import numpy as np
import pytest

from lakemart.llm.labelled import Columns, events
from lakemart.llm.quality import OrdinalModel, good_documents, quality
from lakemart.llm.textops import text_chunks
from lakemart.llm.toxicity import logistic, toxicity, without_toxic

LABELS = "doc_id long, quality int, toxic int"


def corpus(n=900, seed=2):
    rng = random.Random(seed)
    words = [f"{a}{b}{c}" for a in ("ba", "do", "ki") for b in ("ra", "lu", "me", "to") for c in ("n", "s", "va", "pil", "quo")]
    bad = ["vile", "rotten", "nasty"]
    docs = []
    for i in range(n):
        text = [rng.choice(words) for _ in range(rng.randint(8, 60))]
        toxic, good = i % 6 == 0, i % 4 != 0
        if toxic:
            for _ in range(2):
                text[rng.randrange(len(text))] = rng.choice(bad) + rng.choice(["", ".", ","])
        if not good:
            text = [w.upper() + "!!" for w in text] if i % 8 else [text[0]] * 10 + text
        docs.append((i, " ".join(text), int(good), int(toxic)))
    return docs


@pytest.fixture(scope="module")
def tables(shipped):
    docs = corpus()
    texts = shipped.createDataFrame([d[:2] for d in docs], "doc_id long, text string").repartition(3).checkpoint()
    labels = shipped.createDataFrame([(d[0], d[2], d[3]) for d in docs if d[0] % 5], LABELS)
    return docs, texts, labels


def test_toxic_documents_are_caught(tables):
    docs, texts, labels = tables
    rows = {r["doc_id"]: r for r in toxicity(texts, texts, labels).collect()}
    unseen = [d for d in docs if d[0] % 5 == 0]
    assert len(rows) == len(docs)
    assert sum(rows[d[0]]["toxic"] == bool(d[3]) for d in unseen) >= 0.98 * len(unseen)
    assert all(0 < rows[d[0]][c] < 1 for d in docs[:50] for c in ("p_low_quality", "p_toxic", "p_toxic_low_quality"))
    kept = {r["doc_id"] for r in without_toxic(texts, texts, labels).collect()}
    assert kept == {i for i, r in rows.items() if not r["toxic"]}


def test_low_quality_is_caught(tables):
    docs, texts, labels = tables
    rows = {r["doc_id"]: r for r in quality(texts, texts, labels).collect()}
    unseen = [d for d in docs if d[0] % 5 == 0]
    assert sum(rows[d[0]]["kept"] == bool(d[2]) for d in unseen) >= 0.98 * len(unseen)
    grade = [rows[d[0]]["expected_grade"] for d in unseen if d[2] and not d[3]], [rows[d[0]]["expected_grade"] for d in unseen if d[2] and d[3]]
    assert np.mean(grade[0]) > np.mean(grade[1]) + 0.3
    assert {r["doc_id"] for r in good_documents(texts, texts, labels).collect()} == {i for i, r in rows.items() if r["kept"]}


def test_odd_rows_and_no_labels(odd_documents, no_documents, tables):
    _, texts, labels = tables
    nulls = labels.unionByName(labels.sparkSession.createDataFrame([(None, 1, 0), (2, None, 0), (4, 1, None)], LABELS))
    for frame in (odd_documents, no_documents):
        assert toxicity(frame, texts, nulls).count() == quality(frame, texts, nulls).count() == frame.count()
        out = without_toxic(frame.withColumnRenamed("size", "p_toxic"), texts, nulls)
        assert out.columns == [*frame.columns[:-1], "p_toxic"] and out.count() == frame.count()
        assert good_documents(frame, texts, nulls).columns == frame.columns
    none = labels.where("false")
    assert without_toxic(texts, texts, none).count() == good_documents(texts, texts, none).count() == texts.count()


def test_logistic_is_at_its_optimum():
    rng = np.random.default_rng(1)
    x = np.column_stack([np.ones(300), rng.integers(0, 2, size=(300, 4))])
    y = (rng.random(300) < 1 / (1 + np.exp(-(x @ [-1, 2, -1, 0, 1])))).astype(float)
    w = logistic(x, y)

    def value(w):
        s = x @ w
        return (y * s - np.logaddexp(0, s)).sum() - 0.25 * (w[1:] ** 2).sum() - 5e-4 * w[0] ** 2
    for j in range(5):
        for step in (1e-3, -1e-3):
            other = w.copy()
            other[j] += step
            assert value(other) <= value(w) + 1e-9


def test_ordinal_model_is_at_its_optimum_with_ordered_thresholds():
    rng = np.random.default_rng(5)
    x = rng.integers(0, 2, size=(600, 3)).astype(float)
    y = np.digitize(x @ [2.0, -2.0, 1.0] + rng.logistic(size=600), [-1.0, 0.5, 2.0])
    model = OrdinalModel(4)
    model.fit(x, y)
    assert (np.diff(model.thresholds) > 0).all()
    best = model._value(x, y)
    for part in ("weights", "thresholds"):
        for j in range(3):
            for step in (0.02, -0.02):
                old = getattr(model, part).copy()
                getattr(model, part)[j] += step
                assert model._value(x, y) <= best + 1e-2
                setattr(model, part, old)
    tails = model.tails(x @ model.weights)
    assert (np.diff(tails, axis=1) <= 0).all()


def test_events_of_a_text():
    import pyarrow as pa
    texts = ["Moron, moron! idiot.", "a a a b", "b a a a", "x!! y!! z!!", "", None, "été ÉTÉ"]
    (chunk,) = text_chunks(pa.array(texts))
    doc, event = events(chunk)
    has = [set(event[doc == i].tolist()) for i in range(len(texts))]
    assert len(has[0]) == 2 and len(has[1]) == 3 and has[1] == has[2] and not has[4] and not has[5]
    assert len(has[3]) == 3 + 2


def test_more_words_than_128_are_learnt(shipped):
    rng = random.Random(4)
    word = lambda n: "".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(n))
    plain, bad = [word(4) for _ in range(300)], [word(4) for _ in range(200)]
    docs = []
    for i in range(9000):
        text, toxic = [rng.choice(plain) for _ in range(8)], i % 2
        if toxic:
            text[rng.randrange(8)] = bad[i // 2 % 200]
        docs.append((i, " ".join(text), 1, toxic))
    texts = shipped.createDataFrame([d[:2] for d in docs], "doc_id long, text string").repartition(3).checkpoint()
    labels = shipped.createDataFrame([(d[0], d[2], d[3]) for d in docs if d[0] < 8000], LABELS)
    scored = {r["doc_id"]: r["toxic"] for r in toxicity(texts, texts, labels).collect()}
    assert sum(scored[d[0]] == bool(d[3]) for d in docs[8000:]) >= 990


def test_stems_are_learnt(shipped):
    """A stem whose every form is new is known by its part."""
    rng = random.Random(6)
    word = lambda n: "".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(n))
    plain = [word(6) for _ in range(200)]
    docs = [(i, " ".join([rng.choice(plain) for _ in range(12)] + (["bomente" + word(4)] if i % 3 == 0 else []))) for i in range(900)]
    texts = shipped.createDataFrame(docs, "doc_id long, text string").repartition(3).checkpoint()
    labels = shipped.createDataFrame([(i, 1, int(i % 3 == 0)) for i in range(600)], LABELS)
    scored = {r["doc_id"]: r["toxic"] for r in toxicity(texts, texts, labels).collect()}
    assert all(scored[i] == (i % 3 == 0) for i in range(600, 900))


def test_sparse_fits_are_those_of_the_dense_matrix():
    rng = np.random.default_rng(8)
    x = np.column_stack([np.ones(400), rng.normal(size=400), rng.integers(0, 2, size=(400, 6))])
    y = (rng.random(400) < 1 / (1 + np.exp(-(x @ [-1, 1, 2, -1, 0, 1, 3, -2])))).astype(float)
    row, column = np.nonzero(x[:, 2:])
    sparse = Columns(x[:, :2], row, column, 6)
    assert np.allclose(logistic(sparse, y), logistic(x, y), atol=1e-5)
    out = y > 0
    assert np.allclose(sparse.where(out) @ np.arange(8.0), x[out] @ np.arange(8.0))


def test_held_out_toxic_documents_are_caught(shipped):
    """Fitted on one half of the labels of sf0.1, measured on the other: in all 0.9 of the toxic documents, 2 % false rejections at most."""
    from pyspark.sql import functions as F

    from lakemart.llm.toxicity import toxicity
    sf = "/root/testdata/sf0.1"
    docs, labels = shipped.read.parquet(f"{sf}/documents.parquet"), shipped.read.parquet(f"{sf}/labels.parquet")
    first = F.pmod(F.xxhash64("doc_id", F.lit(99)), F.lit(2)) == 0
    found = toxicity(docs, docs, labels.where(first)).withColumnRenamed("toxic", "rejected")
    n = {(r["lang"], r["toxic"]): (r["n"], r["rejected"]) for r in found.join(labels.where(~first), "doc_id").join(docs.select("doc_id", "lang"), "doc_id")
         .groupBy("lang", "toxic").agg(F.count("*").alias("n"), F.count_if("rejected").alias("rejected")).collect()}
    total = {t: [sum(v[i] for k, v in n.items() if k[1] == t) for i in (0, 1)] for t in (0, 1)}
    assert total[1][1] >= 0.9 * total[1][0] and total[0][1] <= 0.02 * total[0][0], n
    # Spanish has 18 toxic documents in the first half, too few for the same recall
    assert all(v[1] >= (0.6 if k[0] == "es" else 0.8) * v[0] for k, v in n.items() if k[1] == 1), n
