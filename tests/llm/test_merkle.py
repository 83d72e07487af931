"""Operator 13 against a tree built in Python."""

import hashlib
import zlib

import pytest
from pyspark.sql import functions as F

from lakemart.llm.merkle import checked, manifest


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def leaf_of(r, more=0):
    n_chars = None if r["n_chars"] is None else r["n_chars"] + more
    values = [r["doc_id"], r["source"], r["lang"], n_chars, r["text"]]
    return sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def levels_of(nodes, fan_out):
    levels = [nodes]
    while len(nodes) > 1:
        nodes = [sha("".join(nodes[i:i + fan_out])) for i in range(0, len(nodes), fan_out)]
        levels.append(nodes)
    return levels


def siblings_of(levels, rank, fan_out):
    out = []
    for nodes in levels[:-1]:
        first = rank // fan_out * fan_out
        out.append([n for i, n in enumerate(nodes[first:first + fan_out], first) if i != rank])
        rank //= fan_out
    return out


def fold(node, rank, siblings, fan_out):
    for others in siblings:
        digit, rank = rank % fan_out, rank // fan_out
        node = sha("".join([*others[:digit], node, *others[digit:]]))
    return node


def brute(rows, changed, fan_out=2):
    langs = sorted({r["lang"] for r in rows}, key=lambda v: (v is not None, (v or "").encode()))
    trees = []
    for lang in langs:
        own = sorted((r for r in rows if r["lang"] == lang), key=lambda r: (r["doc_id"] is not None, r["doc_id"] or 0, leaf_of(r)))
        trees.append((own, levels_of([leaf_of(r) for r in own], fan_out)))
    top = levels_of([t[1][-1][0] for t in trees], fan_out) if trees else []
    out = []
    for number, (own, levels) in enumerate(trees):
        for rank, r in enumerate(own):
            low, high = siblings_of(levels, rank, fan_out), siblings_of(top, number, fan_out)
            node = fold(leaf_of(r, int(changed(r["doc_id"]))), rank, low, fan_out)
            folded = fold(node, number, high, fan_out)
            proof = "".join(d for others in low + high for d in others)
            out.append((r["doc_id"], leaf_of(r), levels[-1][0], top[-1][0], sha(proof), folded, folded == top[-1][0]))
    return out


def by_crc(doc_id):
    return doc_id is not None and zlib.crc32(str(doc_id).encode()) % 7 == 0


def rows_of(frame):
    return [r.asDict() for r in frame.collect()]


def ordered(rows):
    return sorted((tuple(r) for r in rows), key=str)


def test_odd_documents(odd_documents, no_documents):
    assert ordered(checked(odd_documents).collect()) == ordered(brute(rows_of(odd_documents), by_crc))
    assert checked(no_documents).count() == 0


def test_one_row_is_its_own_root(odd_documents):
    one = odd_documents.where("doc_id = 7").coalesce(1)
    r = checked(one).first()
    assert r["leaf"] == r["subroot"] == r["root"] and r["proof_sha256"] == sha("")
    assert r["verified"] == (not by_crc(7))


@pytest.mark.parametrize("fan_out,pack_levels", [(2, 2), (3, 1), (5, 2)])
def test_several_rounds_and_fan_outs(shipped, fan_out, pack_levels):
    rows = [(i % 90, f"text {i % 70}", ["en", "de", "fr", None, "é"][i * i % 5], None, i % 70) for i in range(150)]
    docs = shipped.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").repartition(4)
    found = manifest(docs, F.col("doc_id") % 4 == 0, fan_out, pack_levels)
    want = brute(rows_of(docs), lambda i: i % 4 == 0, fan_out)
    got = [(r["doc_id"], r["leaf"], r["subroot"], r["root"], sha("".join(d for s in r["siblings"] for d in s)), r["folded_root"],
            r["folded_root"] == r["root"]) for r in found.collect()]
    assert ordered(got) == ordered(want)
    assert any(w[-1] for w in want) and not all(w[-1] for w in want)


def test_equal_packs_are_stored_once(shipped):
    """Repeated rows make equal packs: every row still has its own proof."""
    docs = shipped.range(64).selectExpr("CAST(NULL AS LONG) AS doc_id", "'same' AS text", "'en' AS lang", "'s' AS source", "4L AS n_chars")
    found = manifest(docs, pack_levels=2).collect()
    assert sorted(r["rank"] for r in found) == list(range(64))
    assert len({r["leaf"] for r in found}) == 1 and all(r["folded_root"] == r["root"] for r in found)
