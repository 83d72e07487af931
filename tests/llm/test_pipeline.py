"""The pipeline's stages hand on the columns of documents, and its decisions take effect."""

import random

import corpus_pipeline
from lakemart.session import cut_lineage

from conftest import SF_CHECK


def test_stages_in_order_on_documents(shipped):
    docs = shipped.read.parquet(f"{SF_CHECK}/documents.parquet")
    columns, counts = docs.columns, [docs.count()]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = cut_lineage(stage(shipped, docs, SF_CHECK), f"test-{name}")
        assert docs.columns == columns, name
        counts.append(docs.count())
    assert counts[0] > counts[1] > counts[2] > counts[3]
    packed = corpus_pipeline.STAGES[-1][1](shipped, docs, SF_CHECK)
    ids = {r["doc_id"] for r in docs.select("doc_id").collect()}
    assert {r["doc_id"] for r in packed.select("doc_id").collect()} == ids


def test_planted_cases(shipped, tmp_path):
    """Toxic and junk texts go, one of each group of copies stays, clean texts stay."""
    rng = random.Random(7)
    words = [f"{a}{b}" for a in ("lo", "ra", "mi", "ke", "tu") for b in ("rem", "dol", "sit", "amet", "qui", "nos", "tra")]
    text = lambda n: [rng.choice(words) for _ in range(n)]
    rows, labels, clean, last = [], [], set(), text(50)
    for i in range(600):
        kind = {0: "toxic", 1: "junk", 5: "copy"}.get(i % 10, "clean")
        t = text(rng.randint(30, 80))
        if kind == "toxic":
            t[3], t[9] = "awful", rng.choice(["horrid", "beastly"])
        elif kind == "junk":
            t = [w + "###" for w in t]
        elif kind == "copy":
            t = list(last) if i % 20 == 5 else [*last[:-1], "changed"]
        else:
            clean.add(i)
            last = t
        rows.append((i, " ".join(t), "en", f"s{i % 3}", 0))
        if i % 2 == 0 or i % 3 == 0:
            labels.append((i, int(kind != "junk"), int(kind == "toxic")))
    docs = shipped.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    shipped.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    docs = shipped.read.parquet(str(tmp_path / "documents.parquet"))
    for _, stage in corpus_pipeline.STAGES[:3]:
        docs = cut_lineage(stage(shipped, docs, str(tmp_path)), "test-planted")
    kept = {r["doc_id"] for r in docs.collect()}
    assert kept == clean


def test_empty_table(shipped, no_documents, tmp_path):
    no_documents.drop("size").write.parquet(str(tmp_path / "documents.parquet"))
    shipped.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    assert corpus_pipeline.run(shipped, str(tmp_path)).count() == 0


def test_odd_column_names(shipped, tmp_path):
    """Columns with a space, a dot, a colon, a backtick, and names that the stages use themselves, pass through."""
    names = ["my col", "a.b", "x:y", "q`r", "p_toxic", "c0", "as_text", "key", "tie", "taken", "words"]
    rows = [(i, f"word{i} " * 12 + f"other{i} text", "en", f"s{i % 2}", 20, *[i * 10 + j for j in range(len(names))]) for i in range(40)]
    schema = "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(
        "`{}` int".format(n.replace("`", "``")) for n in names)
    docs = shipped.createDataFrame(rows, schema)
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    labels = [(i, 1, int(i % 8 == 0)) for i in range(0, 40, 2)]
    shipped.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    columns = docs.columns
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = cut_lineage(stage(shipped, docs, str(tmp_path)), "test-names")
        assert docs.columns == columns, name
        own = {r["doc_id"]: r for r in docs.collect()}
        assert own and all([r[n] for n in names] == [i * 10 + j for j in range(len(names))] for i, r in own.items())
    assert corpus_pipeline.STAGES[-1][1](shipped, docs, str(tmp_path)).count() >= len(own)


def test_brute_force_on_a_small_table(shipped, tmp_path):
    """The last three stages on clean texts: who stays, what is taken, how much is packed."""
    rng = random.Random(5)
    texts = [" ".join(f"w{rng.randrange(10**6)}" for _ in range(rng.randint(20, 60))) for _ in range(60)]
    texts += [texts[3], texts[4] + " more", texts[5]]
    rows = [(i, t, "en", f"s{i % 2}", len(t)) for i, t in enumerate(texts)]
    docs = shipped.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    sets = [{tuple(t.split()[i:i + 5]) for i in range(len(t.split()) - 4)} for t in texts]
    stay = [i for i in range(len(texts)) if not any(100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j]) for j in range(i))]
    kept = cut_lineage(corpus_pipeline.near_dedup_stage(shipped, docs, ""), "test-brute")
    assert sorted(r["doc_id"] for r in kept.collect()) == stay
    mixed = cut_lineage(corpus_pipeline.mixing_stage(shipped, kept, ""), "test-brute")
    words = {s: sum(len(texts[i].split()) for i in stay if i % 2 == s) for s in (0, 1)}
    total = 1.5 * sum(words.values())
    goal = {0: min(0.75 * total, 2 * words[0])}
    goal[1] = min(total - goal[0], 2 * words[1])
    taken = {s: sum(len(r["text"].split()) for r in mixed.collect() if r["source"] == f"s{s}") for s in (0, 1)}
    assert all(abs(taken[s] - goal[s]) <= 64 for s in (0, 1))
    packed = corpus_pipeline.packing_stage(shipped, mixed, "").collect()
    fill = {}
    for r in packed:
        fill.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for own in fill.values():
        own.sort()
        assert [o for o, _ in own] == [sum(n for _, n in own[:i]) for i in range(len(own))] and sum(n for _, n in own) <= 2048
    assert len(fill) == -(-sum(r["length"] for r in packed) // 2048)
