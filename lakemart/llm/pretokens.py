"""Splitting texts into the pre-tokens of a byte-level BPE, and their ids.

A byte-level BPE cuts a text into contractions, runs of letters, of numbers or of
other signs (each with one blank before it), and white space, and encodes each piece by
itself. The cuts follow from the class of each character and its neighbours, so they
are found for a whole chunk with array operations; a piece's ids come from the
tokenizer's own model the first time the piece is met in a worker and from a table
after that.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator

import numpy as np
from tokenizers import Tokenizer

from lakemart.llm.textops import CHUNK_BYTES, Chunk, KeyTable, _power_tables, mix64

LETTER, NUMBER, OTHER, SPACE = 0, 1, 2, 3
#: Unicode White_Space (fixed values).
WHITE = [9, 10, 11, 12, 13, 32, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]
MOST_PIECES = 1 << 19  # pieces kept in a worker's table, which starts anew beyond them
MOST_IDS = 1 << 23  # or beyond so many ids

_classes: list[np.ndarray] = []


def char_classes() -> np.ndarray:
    """The class of every code point."""
    if not _classes:
        kinds = {"L": LETTER, "N": NUMBER}
        own = np.fromiter((kinds.get(unicodedata.category(chr(c))[0], OTHER) for c in range(0x110000)), np.uint8, 0x110000)
        own[WHITE] = SPACE
        _classes.append(own)
    return _classes[0]


def code_points(chunk: Chunk) -> tuple[np.ndarray, np.ndarray]:
    """Code points of a chunk and the bounds of its texts in them."""
    points = np.frombuffer(chunk.data.tobytes().decode("utf-8").encode("utf-32-le"), np.uint32)
    begins = np.concatenate([[0], np.cumsum((chunk.data & 0xC0) != 0x80)])
    return points, begins[chunk.bounds]


def cuts(points: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Where pieces begin, for texts of code points one after the other; texts don't share pieces."""
    n = len(points)
    if not n:
        return np.zeros(0, np.int64)
    kind = char_classes()[points]
    edge = np.zeros(n + 1, bool)  # a text begins here
    edge[bounds] = True
    edge, ends = edge[:n], edge[1:]
    before = np.concatenate([[SPACE], kind[:-1]])
    new_run = edge | (kind != before)
    after_space = np.zeros(n, bool)
    after_space[1:] = (kind[:-1] == SPACE)
    after_space &= ~edge
    space = kind == SPACE
    next_word = np.zeros(n, bool)
    next_word[:-1] = ~space[1:]
    next_word &= ~ends
    begin = np.where(space, new_run | next_word, new_run)  # the last of a run of white space before a word stands alone
    blank_before = np.zeros(n, bool)
    blank_before[1:] = points[:-1] == 32
    blank_before &= ~edge
    begin &= space | ~blank_before  # unless it is a blank: then it joins the word
    quote = np.flatnonzero((points == 39) & begin)
    if len(quote):  # contractions: only where a piece begins with the quote
        pad = np.concatenate([points, np.zeros(2, np.uint32)])
        whole = np.concatenate([edge, [True, True]])
        a, b = pad[quote + 1], pad[quote + 2]
        one = np.isin(a, [ord(c) for c in "stmd"]) & ~whole[quote + 1]
        two = ((a == ord("r")) | (a == ord("v"))) & (b == ord("e")) | (a == ord("l")) & (b == ord("l"))
        two &= ~whole[quote + 1] & ~whole[quote + 2]
        size = np.where(one, 2, np.where(two, 3, 0))
        hit = size > 0
        q, size = quote[hit], size[hit]
        begin[q + 1] = False
        stop = q + size
        stop = stop[stop < n]
        begin[stop] |= kind[stop] == LETTER  # the letters after it are a piece of their own
    return np.flatnonzero(begin)


_VISIBLE = np.zeros(256, bool)
_VISIBLE[33:127] = True


def whole_piece_parts(chunk: Chunk, part_bytes: int = CHUNK_BYTES) -> Iterator[Chunk]:
    """A chunk as it is, or one long text in parts that share no piece: a part ends before a blank with a
    visible ASCII sign on either side, where a piece begins whatever else the text holds. A part is longer than
    ``part_bytes`` only as far as there is no such blank."""
    data, size, lo = chunk.data, len(chunk.data), 0
    if chunk.n > 1 or size <= part_bytes:
        yield chunk
        return
    while lo < size:
        hi, found = lo + part_bytes, False
        while hi + 1 < size and not found:
            window = data[hi - 1:hi + part_bytes + 1]
            at = np.flatnonzero((window[1:-1] == 32) & _VISIBLE[window[:-2]] & _VISIBLE[window[2:]])
            found = len(at) > 0
            hi += int(at[0]) if found else part_bytes
        if not found:
            hi = size
        yield Chunk(chunk.first, data[lo:hi], np.array([0, hi - lo]))
        lo = hi


class PieceIds:
    """Ids of pieces by a tokenizer's model, kept by the piece's 64-bit hash."""

    def __init__(self, path: str):
        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        kept = [*range(33, 127), *range(161, 173), *range(174, 256)]  # bytes that stand for themselves (fixed values)
        moved = (b for b in range(256) if b not in set(kept))
        self.sign = str.maketrans({b: chr(256 + i) for i, b in enumerate(moved)})
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.clear()

    def clear(self) -> None:
        self.table, self.n = KeyTable(kind=np.int32), 0
        self.count = np.zeros(1 << 16, np.int32)
        self.at = np.zeros(1 << 16, np.int32)
        self.ids = np.zeros(1 << 16, np.uint32)
        self.used = 0

    def _encode(self, piece: str) -> list[int]:
        return [t.id for t in self.model.tokenize(piece.encode().decode("latin-1").translate(self.sign))]

    def _add(self, keys: np.ndarray, pieces: list[str]) -> None:
        found = [self._encode(p) for p in pieces]
        count = np.fromiter(map(len, found), np.int32, len(found))
        total = int(count.sum())
        while self.used + total > len(self.ids):
            self.ids = np.concatenate([self.ids, np.zeros_like(self.ids)])
        while self.n + len(keys) > len(self.count):
            self.count, self.at = (np.concatenate([v, np.zeros_like(v)]) for v in (self.count, self.at))
        own = slice(self.n, self.n + len(keys))
        self.ids[self.used:self.used + total] = np.fromiter((x for f in found for x in f), np.uint32, total)
        self.count[own], self.at[own] = count, self.used + np.cumsum(count) - count
        self.table.add(keys, np.arange(self.n, self.n + len(keys)))
        self.n += len(keys)
        self.used += total

    def encode(self, chunk: Chunk, part_bytes: int = CHUNK_BYTES) -> tuple[np.ndarray, np.ndarray]:
        """Ids of a chunk's texts one after the other, and each text's bounds in them. One text of more than
        ``part_bytes`` is encoded in parts that share no piece."""
        if chunk.n > 1 or len(chunk.data) <= part_bytes:
            return self._encode_part(chunk)
        ids = np.concatenate([self._encode_part(part)[0] for part in whole_piece_parts(chunk, part_bytes)])
        return ids, np.array([0, len(ids)])

    def _encode_part(self, chunk: Chunk) -> tuple[np.ndarray, np.ndarray]:
        points, bounds = code_points(chunk)
        begin = cuts(points, bounds)
        if not len(begin):
            return np.zeros(0, np.uint32), np.zeros(chunk.n + 1, np.int64)
        end = np.append(begin[1:], len(points))
        up, down = _power_tables(len(points) + 1)
        with np.errstate(over="ignore"):
            sums = np.empty(len(points) + 1, np.uint64)
            sums[0] = 0
            value = (points.astype(np.uint64) + np.uint64(0x2545F491)) * np.uint64(0xD1342543DE82EF95)
            np.cumsum((value ^ (value >> np.uint64(29))) * up[:len(points)], out=sums[1:])
            key = mix64((sums[end] - sums[begin]) * down[begin] + (end - begin).astype(np.uint64))
        if self.n > MOST_PIECES or self.used > MOST_IDS:
            self.clear()
        slot = self.table.find(key)
        missing = np.flatnonzero(slot < 0)
        if len(missing):
            new, first = np.unique(key[missing], return_index=True)
            m = missing[first]
            self._add(new, [points[a:b].tobytes().decode("utf-32-le") for a, b in zip(begin[m], end[m], strict=True)])
            slot[missing] = self.table.find(key[missing])
        count = self.count[slot]
        stop = np.cumsum(count)
        total = int(stop[-1])
        ids = self.ids[np.repeat(self.at[slot] - (stop - count), count) + np.arange(total)]
        per_text = np.concatenate([[0], stop])[np.searchsorted(begin, bounds)]
        return ids, per_text
