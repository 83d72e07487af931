"""Operator 6: apportionment by plain quotients, targets, whole mixes."""

import random
import re

from conftest import SF_SMALL

from lakemart.llm.mixing import mixed_documents, mixture, op6, sainte_lague, targets

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def by_quotients(votes, seats, caps):
    got = [0] * len(votes)
    for _ in range(seats):
        free = [i for i in range(len(votes)) if got[i] < caps[i] and votes[i] > 0]
        if not free:
            break
        got[max(free, key=lambda i: (votes[i] / (2 * got[i] + 1), -i))] += 1
    return got


def test_seats_go_to_the_highest_quotients():
    rng = random.Random(5)
    for _ in range(200):
        n = rng.randint(1, 8)
        votes = [rng.choice([0, rng.randint(1, 50), rng.random() * 100]) for _ in range(n)]
        caps = [rng.randint(0, 30) for _ in range(n)]
        seats = rng.randint(0, 80)
        assert sainte_lague(votes, seats, caps) == by_quotients(votes, seats, caps)


def test_targets_stop_at_twice_the_size():
    assert targets([10, 10, 10], [3, 1, 2], 45, 2) == [20.0, 25 / 3, 50 / 3]
    assert targets([100, 0, 1], [3, 1, 2], 151.5, 2) == [149.5, 0.0, 2.0]
    assert targets([0, 0], [3, 1], 0, 2) == [0.0, 0.0]


def test_mix_comes_near_its_targets(shipped):
    docs = {r["doc_id"]: r for r in shipped.read.parquet(f"{SF_SMALL}/documents.parquet").collect()}
    rows = op6(shipped, SF_SMALL).collect()
    sizes = {i: len(WORD.findall(d["text"] or "")) for i, d in docs.items()}
    assert {r["doc_id"]: r["size"] for r in rows} == sizes
    sources = sorted({d["source"] for d in docs.values()}, key=lambda s: s.encode())
    size = [sum(n for i, n in sizes.items() if docs[i]["source"] == s) for s in sources]
    want = targets(size, [(3, 1, 2)[i % 3] for i in range(len(sources))], 1.5 * sum(size), 2)
    for s, n, t in zip(sources, size, want):
        own = [r for r in rows if docs[r["doc_id"]]["source"] == s]
        assert {(r["source_size"], round(r["target"], 6)) for r in own} == {(n, round(t, 6))}
        assert abs(sum(r["taken"] for r in own) - t) <= 32
    assert all(r["taken"] <= 2 * r["size"] for r in rows)
    assert sorted(map(tuple, rows)) == sorted(map(tuple, op6(shipped, SF_SMALL).collect()))


def test_mixed_texts_are_what_is_taken(shipped):
    docs = shipped.read.parquet(f"{SF_SMALL}/documents.parquet")
    taken = {r["doc_id"]: r["taken"] for r in mixture(docs).collect() if r["taken"]}
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    mixed = mixed_documents(docs)
    assert mixed.columns == docs.columns
    rows, words, whole = mixed.collect(), {}, 0
    for r in rows:
        words[r["doc_id"]] = words.get(r["doc_id"], 0) + len(WORD.findall(r["text"]))
        whole += r["text"] == texts[r["doc_id"]]
        assert r["n_chars"] == len(r["text"])
    assert words == taken and whole >= len(rows) - 2 * 20


def test_odd_rows(odd_documents):
    rows = mixture(odd_documents).collect()
    assert len(rows) == odd_documents.count()
    assert all(r["taken"] <= 2 * r["size"] for r in rows)
    assert {r["size"] for r in rows if r["doc_id"] in (1, 2, 3)} == {0}
    assert mixed_documents(odd_documents).columns == odd_documents.columns
    assert mixed_documents(odd_documents).where("text IS NULL OR trim(text) = ''").count() == 0


def test_empty_table(no_documents):
    assert mixture(no_documents).count() == 0 and mixed_documents(no_documents).count() == 0


def test_the_mix_does_not_depend_on_the_order_of_rows(shipped):
    """Rows that share doc_id, source and size, with different texts."""
    from lakemart.llm.mixing import mixed_documents
    rows = [(5, f"one two t{i}", "en", "a", 10) for i in range(400)] + [(i, "x y z", "en", "b", 5) for i in range(900)]
    docs = shipped.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    mixes = [sorted(tuple(r) for r in mixed_documents(d).collect()) for d in (
        docs, docs.orderBy("text"), docs.repartition(5).orderBy("n_chars", "text", ascending=False))]
    assert mixes[0] == mixes[1] == mixes[2] and mixes[0]


def test_a_run_round_the_end_of_one_document(shipped):
    """Its tail and its head are two rows, no words are glued."""
    from lakemart.llm.mixing import mixed_documents
    rows = [(1, " ".join(f"a{i}" for i in range(1000)), "en", "a", 0), (2, " ".join(f"b{i}" for i in range(400)), "en", "b", 0)]
    docs = shipped.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    for r in mixed_documents(docs).collect():
        numbers = [int(w[1:]) for w in r["text"].split()]
        assert numbers == list(range(numbers[0], numbers[0] + len(numbers)))
        assert r["n_chars"] in (0, len(r["text"]))
