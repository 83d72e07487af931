"""Operators 8 and 10 against the tokenizer library, and packing against its bounds."""

import json
import random
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from conftest import SF_SMALL
from tokenizers import Tokenizer

from lakemart.llm.packing import best_fit, op10, pack, packed_documents, piece_starts
from lakemart.llm.pretokens import PieceIds
from lakemart.llm.textops import text_chunks
from lakemart.llm.transducer import Transducer, op8, token_counts

WORDS, BYTES = (public_tokenizers.path(n) for n in ("word_bpe_49k.json", "byte_bpe_50k.json"))
EDGES = ["", "  ", "'", "''", "'s", "x's", "don't we've I'll he'd 're 'r 'v 'l 'x a'", "'''s \"'s", " 's '  's\n's", "a'sb c'rea d're",
         "a'S 'S 'll've", "1234 ½² ⅷ ١٢", "İSTANBUL ΑΣ ΣΑΣ.", "é café Å", "<|endoftext|>a<|startoftext|> <|endoftext",
         "日本語テスト 中文", "🙂🙂 a🙂b", " x y\u0085z w", "  a   b\n\n c\n\nd \n e\t\tf  ", "Ünïcode ẞ ß", "x" * 3000,
         "ab" * 2000 + "'s", "!" * 2000, "the" * 1000 + " " + "é" * 1500, "\x00a\x01", "ǅ ﬁ Ⅷ", "end  "]


def random_texts(n=600):
    rng = random.Random(1)
    signs = "abcdehilnorst'  .,!rvlemtds12éß日\n\t<|>-_"
    return ["".join(rng.choice(signs) for _ in range(rng.randint(0, 200))) for _ in range(n)]


def test_transducer_counts_as_the_library():
    made, library = Transducer(WORDS), Tokenizer.from_file(WORDS)
    texts = EDGES + random_texts()
    found = made.count([made.normalised(t) for t in texts])
    assert found.tolist() == [len(library.encode(t, add_special_tokens=False).ids) for t in texts]


def test_transducer_starts_anew_when_full(monkeypatch):
    from lakemart.llm import transducer
    monkeypatch.setattr(transducer, "MOST_STATES", 50)
    made, library = Transducer(WORDS), Tokenizer.from_file(WORDS)
    texts = random_texts(100)
    found = [int(made.count([made.normalised(t)])[0]) for t in texts]
    assert found == [len(library.encode(t, add_special_tokens=False).ids) for t in texts]


def unbroken(n=60_000):
    rng = random.Random(5)
    return ["x" * n, "é" * n, "日本語" * n, "'" * n, "a's" * n, "🙂" * (n + 1), "ab" * n + " " + "ab" * n,
            "".join(rng.choice("abAB09+/=é'") for _ in range(n)), "<|endoftext|>" + "y" * n + "<|endoftext|>" + "don" * n]


@pytest.mark.parametrize("rounds", [16, 1])
def test_chunk_maps_of_texts_without_white_space(monkeypatch, rounds):
    from lakemart.llm import transducer
    monkeypatch.setattr(transducer, "SPECULATIVE", rounds)
    made, library = Transducer(WORDS), Tokenizer.from_file(WORDS)
    texts = unbroken() if rounds == 16 else unbroken(3000) + EDGES + random_texts(100)
    found = made.count([made.normalised(t) for t in texts])
    assert found.tolist() == [len(library.encode(t, add_special_tokens=False).ids) for t in texts]


def test_paths_through_composed_maps():
    rng = np.random.default_rng(2)
    for n in (1, 2, 7, 100):
        to = np.minimum(np.arange(n) + rng.integers(1, 4, size=n), n)  # n: ends
        begins = rng.choice(n, size=max(1, n // 20), replace=False)
        want = np.zeros(n, bool)
        for at in begins.tolist():
            while at < n:
                want[at], at = True, int(to[at])
        assert (Transducer._on_paths(to, begins) == want).all()


def test_other_tokenizer_files_are_refused(tmp_path):
    spec = json.load(open(WORDS, encoding="utf-8"))
    changes = {"normalizer": None, "pre_tokenizer": {"type": "Whitespace"}, "model": {**spec["model"], "unk_token": "<unk>"},
               "added_tokens": [{**spec["added_tokens"][0], "lstrip": True}]}
    for key, value in changes.items():
        path = tmp_path / f"{key}.json"
        path.write_text(json.dumps({**spec, key: value}), encoding="utf-8")
        with pytest.raises(ValueError, match=key):
            Transducer(str(path))
    with pytest.raises(ValueError):
        Transducer(BYTES)


def test_token_counts_of_all_documents(shipped):
    library = Tokenizer.from_file(WORDS)
    texts = {r["doc_id"]: r["text"] or "" for r in shipped.read.parquet(f"{SF_SMALL}/documents.parquet").collect()}
    for r in op8(shipped, SF_SMALL).collect():
        text = texts.pop(r["doc_id"])
        n = len(library.encode(text, add_special_tokens=False).ids)
        assert (r["n_bytes"], r["n_tokens"], r["over_limit"]) == (len(text.encode()), n, n > 2048)
    assert not texts


def test_odd_counts(odd_documents, no_documents):
    rows = token_counts(odd_documents).collect()
    assert len(rows) == odd_documents.count()
    assert {(r["n_bytes"], r["n_tokens"]) for r in rows if r["doc_id"] in (1, 2)} == {(0, 0)}
    assert token_counts(no_documents).count() == 0


def test_pieces_encode_as_the_library(monkeypatch):
    from lakemart.llm import pretokens
    library = Tokenizer.from_file(BYTES)
    for most in (pretokens.MOST_PIECES, 10):
        monkeypatch.setattr(pretokens, "MOST_PIECES", most)
        coder, texts = PieceIds(BYTES), [t for t in EDGES if "<|endoftext|>" not in t] + random_texts()
        found = []
        for chunk in text_chunks(pa.array(texts), 5000):
            ids, bounds = coder.encode(chunk)
            found += [ids[bounds[i]:bounds[i + 1]].tolist() for i in range(chunk.n)]
        assert found == [library.encode(t, add_special_tokens=False).ids for t in texts]


def check_packing(rows, texts):
    """Every piece in its place; gives the number of sequences and the least there could be."""
    library = Tokenizer.from_file(BYTES)
    ids = [np.array([*library.encode(t or "", add_special_tokens=False).ids, 0], "<u4") for t in texts]
    want = []
    for x in ids:
        cuts = [*piece_starts(len(x), 2048), len(x)]
        want += [(k, a, b - a, zlib.crc32(x[a:b].tobytes())) for k, (a, b) in enumerate(zip(cuts, cuts[1:]))]
    assert sorted((r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in rows) == sorted(want)
    held = defaultdict(list)
    for r in rows:
        held[r["sequence_id"]].append((r["offset"], r["length"]))
    for places in held.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= 2048
    return len(held), -(-sum(map(len, ids)) // 2048)


def test_all_documents_are_packed_tightly(shipped):
    texts = [r["text"] for r in shipped.read.parquet(f"{SF_SMALL}/documents.parquet").collect()]
    found, least = check_packing(op10(shipped, SF_SMALL).collect(), texts)
    assert found <= 1.01 * least + 1


def test_odd_documents_are_packed(odd_documents, no_documents):
    texts = [r["text"] for r in odd_documents.collect()]
    found, least = check_packing(packed_documents(odd_documents).collect(), texts)
    assert found <= least + 1
    assert packed_documents(no_documents).count() == 0


def test_only_the_first_piece_is_shorter():
    assert piece_starts(1, 4) == [0] and piece_starts(4, 4) == [0] and piece_starts(5, 4) == [0, 1] and piece_starts(8, 4) == [0, 4]


def test_best_fit_takes_the_fullest_bin():
    bins, offsets, fill = best_fit(np.array([6, 5, 4, 3, 2]), 10)
    assert fill == [10, 10] and bins.tolist() == [0, 1, 0, 1, 1] and offsets.tolist() == [0, 0, 6, 5, 8]


@pytest.mark.parametrize("most, first", [(500_000, 1 << 16), (500_000, 20), (7, 1 << 16)])
def test_rounds_merge_what_partitions_leave(shipped, most, first):
    rng = random.Random(3)
    items = [(i, rng.randint(1, 99)) for i in range(400)]
    pieces = shipped.createDataFrame(items, "item_no int, length long").repartition(40)
    rows = pack(pieces, capacity=100, fan_in=4, most_items=most, first_items=first).collect()
    held = defaultdict(int)
    for r in sorted(rows, key=lambda r: r["offset"]):
        assert held[r["sequence_id"]] == r["offset"]
        held[r["sequence_id"]] += r["length"]
    assert sorted((r["item_no"], r["length"]) for r in rows) == items and max(held.values()) <= 100
    if most > 400:
        assert len(held) <= 1.1 * len(best_fit(np.array([n for _, n in items]), 100)[2])


def test_partitions_of_one_length_are_packed_together(shipped):
    rng = random.Random(5)
    items = [(i, rng.randint(1050, 1250) if i < 800 else rng.randint(750, 950)) for i in range(1600)]
    pieces = shipped.createDataFrame(items, "item_no int, length long").repartitionByRange(8, "item_no")
    rows = pack(pieces, capacity=2048).collect()
    assert sorted((r["item_no"], r["length"]) for r in rows) == items
    held = defaultdict(int)
    for r in rows:
        held[r["sequence_id"]] += r["length"]
    assert max(held.values()) <= 2048 and len(held) <= 1.05 * len(best_fit(np.array([n for _, n in items]), 2048)[2])


LONG_TEXTS = ["plain words and don't we'll they're I'd " * 9, "a" * 700, "été ß 日本語 x  y \n\n z 12 34,56 ' s 's a 's b" * 11,
              " " * 300 + "end", "no.blank.at.all" * 30, "a b" * 90, "'ll 're we 'll be", "lone tail a ", "word " * 60]


@pytest.mark.parametrize("part_bytes", [2, 7, 64, 200])
@pytest.mark.parametrize("text", LONG_TEXTS)
def test_a_long_text_in_parts_has_the_same_ids_and_words(text, part_bytes):
    from lakemart.llm.textops import NOT_LETTER, find_words
    chunk = next(text_chunks(pa.array([text])))
    ids, bounds = PieceIds(BYTES).encode(chunk, part_bytes)
    assert ids.tolist() == Tokenizer.from_file(BYTES).encode(text, add_special_tokens=False).ids and bounds.tolist() == [0, len(ids)]
    for options in ({}, {"between": NOT_LETTER}, {"lower": False}):
        whole, parts = find_words(chunk, **options), find_words(chunk, part_bytes=part_bytes, **options)
        for name in ("start", "end", "doc", "hash", "per_doc", "first"):
            assert getattr(whole, name).tolist() == getattr(parts, name).tolist()
