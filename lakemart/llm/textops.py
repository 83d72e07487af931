"""Vectorised text helpers that run inside Spark tasks on Arrow batches.

Words are runs of bytes other than space and ``\\t \\n \\v \\f \\r``, with A-Z lowered.
A word's 64-bit hash is a polynomial over its bytes, scrambled; a shingle's hash
combines the hashes of its words. Work goes in chunks of whole texts, of about
``CHUNK_BYTES`` bytes, so memory per task stays small whatever the batch holds. A longer
text is one chunk, but its words are found part by part.
"""

from __future__ import annotations

import ctypes
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

CHUNK_BYTES = 1 << 20
SMALL_BYTES = 1 << 18  # chunks of operators that hold tables or many arrays besides

_trim = getattr(ctypes.CDLL(None), "malloc_trim", None)

_rng = np.random.default_rng(20240607)
_BYTE_VALUE = _rng.integers(1, 1 << 63, size=256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = 0x9E3779B97F4A7C15 | 1
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_powers: dict[str, np.ndarray] = {}


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the hash base and of its inverse modulo 2**64, at least ``n`` of each."""
    have = _powers.get("up")
    if have is None or len(have) < n:
        size = max(n, CHUNK_BYTES + 1)
        with np.errstate(over="ignore"):
            for name, base in (("up", _BASE), ("down", pow(_BASE, -1, 1 << 64))):
                table = np.full(size, np.uint64(base))
                table[0] = 1
                _powers[name] = np.multiply.accumulate(table)
    return _powers["up"], _powers["down"]


def release_memory() -> None:
    """Give memory that is free again back to the system: workers live on from stage to stage."""
    pa.default_memory_pool().release_unused()
    if _trim is not None:
        _trim(0)


def mix64(x: np.ndarray) -> np.ndarray:
    """Scramble 64-bit values (a bijection, so it adds no collisions)."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


@dataclass
class Chunk:
    """Whole texts ``first .. first + n - 1`` of a batch: their bytes and bounds."""

    first: int
    data: np.ndarray  # uint8
    bounds: np.ndarray  # n + 1 offsets into data

    @property
    def n(self) -> int:
        return len(self.bounds) - 1


@dataclass
class Words:
    """Words of a chunk in order: byte ranges, text number in the chunk, hash."""

    start: np.ndarray
    end: np.ndarray
    doc: np.ndarray
    hash: np.ndarray
    per_doc: np.ndarray  # words of each text
    first: np.ndarray  # position of each text's first word, and the total


def text_chunks(column: pa.Array, chunk_bytes: int = CHUNK_BYTES) -> Iterator[Chunk]:
    """Chunks of a string column (null counts as empty) read from its Arrow buffers."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_binary())
    _, off, data = column.buffers()
    n = len(column)
    if not n:
        return
    bounds = np.frombuffer(off, dtype=np.int64)[column.offset:column.offset + n + 1]
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
    lengths = np.diff(bounds)
    if column.null_count:
        lengths = np.where(np.asarray(column.is_valid()), lengths, 0)
    lo = 0
    while lo < n:
        hi = max(lo + 1, int(np.searchsorted(bounds, bounds[lo] + chunk_bytes, side="right")) - 1)
        hi = min(hi, n, lo + 65536)
        part = raw[bounds[lo]:bounds[hi]]
        own = bounds[lo:hi + 1] - bounds[lo]
        if (lengths[lo:hi] != np.diff(own)).any():  # a null over a non-empty slot
            keep = [part[own[i]:own[i] + lengths[lo + i]] for i in range(hi - lo)]
            part = np.concatenate(keep)
            own = np.concatenate([[0], np.cumsum(lengths[lo:hi])])
        yield Chunk(lo, part, own)
        lo = hi


def text_parts(chunk: Chunk, part_bytes: int = CHUNK_BYTES) -> Iterator[tuple[Chunk, int]]:
    """A chunk as it is, or one long text in parts that end at white space, each with its place in the chunk's
    bytes: no word is cut, and a part is longer than ``part_bytes`` only by the rest of a word."""
    size, lo = len(chunk.data), 0
    if chunk.n > 1 or size <= part_bytes:
        yield chunk, 0
        return
    while lo < size:
        hi = min(size, lo + part_bytes)
        while hi < size and not _SPACE[chunk.data[hi]]:
            step = np.flatnonzero(_SPACE[chunk.data[hi:hi + part_bytes]])
            hi = hi + int(step[0]) if len(step) else min(size, hi + part_bytes)
        yield Chunk(chunk.first, chunk.data[lo:hi], np.array([0, hi - lo])), lo
        lo = hi


#: What parts runs of letters (of any script; bytes over 127 count as letters).
NOT_LETTER = np.ones(256, dtype=bool)
NOT_LETTER[[*range(65, 91), *range(97, 123), *range(128, 256)]] = False


def find_words(chunk: Chunk, between: np.ndarray = _SPACE, lower: bool = True, part_bytes: int = CHUNK_BYTES) -> Words:
    """The words of each text of a chunk, runs of bytes not in ``between`` (which has all white space), with the
    hashes of their lower case (of their own bytes without ``lower``). One text of more than ``part_bytes`` is
    read in parts that end at white space, so what is held for each byte of it is held for a part alone."""
    if chunk.n > 1 or len(chunk.data) <= part_bytes:
        return _words_of(chunk, between, lower)
    start, end, hashes = [], [], []
    for part, at in text_parts(chunk, part_bytes):
        words = _words_of(part, between, lower)
        start.append(words.start + at)
        end.append(words.end + at)
        hashes.append(words.hash)
    total = sum(map(len, hashes))
    return Words(np.concatenate(start), np.concatenate(end), np.zeros(total, np.int64), np.concatenate(hashes),
                 np.array([total]), np.array([0, total]))


def _words_of(chunk: Chunk, between: np.ndarray, lower: bool) -> Words:
    data = _LOWER[chunk.data] if lower else chunk.data
    size, n = len(data), chunk.n
    if not size:
        none = np.zeros(0, np.int64)
        return Words(none, none, none, np.zeros(0, np.uint64), np.zeros(n, np.int64), np.zeros(n + 1, np.int64))
    inside = ~between[data]
    begins = inside.copy()
    begins[1:] &= ~inside[:-1]
    cuts = chunk.bounds[1:-1]
    cuts = cuts[(cuts > 0) & (cuts < size)]
    begins[cuts] |= inside[cuts]
    finishes = inside.copy()
    finishes[:-1] &= ~inside[1:]
    finishes[cuts - 1] |= inside[cuts - 1]
    start = np.flatnonzero(begins)
    end = np.flatnonzero(finishes) + 1
    up, down = _power_tables(size + 1)
    with np.errstate(over="ignore"):
        sums = np.empty(size + 1, np.uint64)
        sums[0] = 0
        np.cumsum(_BYTE_VALUE[data] * up[:size], out=sums[1:])
        hashes = mix64((sums[end] - sums[start]) * down[start] + (end - start).astype(np.uint64))
    first = np.searchsorted(start, chunk.bounds).astype(np.int64)
    per_doc = np.diff(first)
    return Words(start, end, np.repeat(np.arange(n), per_doc), hashes, per_doc, first)


_STEP = [np.uint64(int(v)) for v in _rng.integers(1, 1 << 63, size=64, dtype=np.uint64) * np.uint64(2) + np.uint64(1)]


def shingles(words: Words, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of ``width`` words of each text, and where each text's
    begin. A text with fewer words has one: its whole sequence; none without words."""
    counts = np.where(words.per_doc >= width, words.per_doc - width + 1, np.minimum(words.per_doc, 1))
    first = np.concatenate([[0], np.cumsum(counts)])
    total = int(first[-1])
    if not total:
        return np.zeros(0, np.uint64), first
    at = np.repeat(words.first[:-1] - first[:-1], counts) + np.arange(total)
    length = np.repeat(np.minimum(words.per_doc, width), counts)
    short = bool((length < width).any())
    with np.errstate(over="ignore"):
        out = length.astype(np.uint64)
        last = len(words.hash) - 1
        for j in range(width):
            term = words.hash[np.minimum(at + j, last)] * _STEP[j]
            out += np.where(j < length, term, np.uint64(0)) if short and j else term
    return mix64(out), first


def as_list_array(values: np.ndarray, counts: np.ndarray, kind: pa.DataType) -> pa.Array:
    """A list column from concatenated values and the length of each row's list."""
    offsets = np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values, type=kind))


class KeyTable:
    """Numbers by 64-bit key (scrambled, none twice), found for whole arrays at once: open addressing."""

    def __init__(self, bits: int = 16, kind: type = np.int64):
        self.bits, self.size, self.kind = bits, 0, kind
        self.keys, self.numbers = np.zeros(1 << bits, np.uint64), np.full(1 << bits, -1, kind)

    def _place(self, keys: np.ndarray) -> np.ndarray:
        return (keys >> np.uint64(64 - self.bits)).astype(np.int64)

    def find(self, keys: np.ndarray) -> np.ndarray:
        """The number of each key, -1 where it has none."""
        keys = np.maximum(keys, np.uint64(1))  # 0 marks a free place
        at = self._place(keys)
        held = self.keys[at]
        out = np.where(held == keys, self.numbers[at], -1)
        open_ = np.flatnonzero((held != keys) & (held != 0))
        at = at[open_]
        while len(open_):
            at = (at + 1) & (len(self.keys) - 1)
            held, own = self.keys[at], keys[open_]
            hit = held == own
            out[open_[hit]] = self.numbers[at[hit]]
            go = ~hit & (held != 0)
            open_, at = open_[go], at[go]
        return out

    def add(self, keys: np.ndarray, numbers: np.ndarray) -> None:
        """Keys that are not in the table, none twice."""
        keys = np.maximum(keys, np.uint64(1))
        if 2 * (self.size + len(keys)) > len(self.keys):
            old = self.keys[self.keys != 0], self.numbers[self.keys != 0]
            self.__init__(max(self.bits + 1, int(2 * (len(old[0]) + len(keys))).bit_length()), self.kind)
            self.add(*old)
        self.size += len(keys)
        at = self._place(keys)
        while len(keys):
            free = np.flatnonzero(self.keys[at] == 0)
            place, first = np.unique(at[free], return_index=True)
            self.keys[place], self.numbers[place] = keys[free[first]], numbers[free[first]]
            rest = np.ones(len(keys), bool)
            rest[free[first]] = False
            keys, numbers, at = keys[rest], numbers[rest], (at[rest] + 1) & (len(self.keys) - 1)
