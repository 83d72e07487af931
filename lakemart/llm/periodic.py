"""Operator 12: periodic runs of words by recursive frequency splitting.

A run is a stretch of consecutive words with smallest period q and at least ``max(LEAST_LENGTH,
REPEATS * q)`` words that can't be made longer. Each of its words occurs in it ``REPEATS`` times at
least. So a word that occurs more rarely than that within a segment is in no run of the segment, and splits
it. All texts of a chunk are split together, and the parts again with their own counts, until nothing
changes; parts under ``LEAST_LENGTH`` words go. No run crosses a split, and none can be made longer
across one, as it would then hold the rare word often enough.

The surviving segments are scanned lag by lag. For lag q the segment is cut into blocks of q
words. A run of period q covers so many blocks that two neighbours, at least, equal the block after them. Blocks
are compared by their first words, then by rolling hashes, and what remains is extended to both sides by
bisection. All lags of a segment together compare ``n log n`` first words. A stretch found by
several lags keeps the smallest, its period; its words are then compared themselves.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakemart.llm.common import llm_query, table
from lakemart.llm.textops import _power_tables, Chunk, find_words, text_chunks, text_parts

LEAST_LENGTH = 6
REPEATS = 4
SCAN_ROWS = 1 << 20  # blocks that are compared at once

RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])
RESULT = ("runs array<struct<start: long, length: long, period: long>>, strongest struct<start: long, length: long, period: long>, "
          "collapsed string")


def surviving_segments(word: np.ndarray, doc: np.ndarray, least: int = LEAST_LENGTH, repeats: int = REPEATS) -> tuple[np.ndarray, np.ndarray]:
    """Bounds ``(begin, end)`` of the segments left of texts (``word``: hashes, ``doc``: text numbers, ascending)."""
    at = np.arange(len(word))
    segment = doc
    while len(at):
        # equal words of a segment next to each other
        order = np.lexsort((word[at], segment))
        w, s = word[at[order]], segment[order]
        new = np.ones(len(at), bool)
        new[1:] = (w[1:] != w[:-1]) | (s[1:] != s[:-1])
        begin = np.flatnonzero(new)
        often = np.repeat(np.diff(np.append(begin, len(at))) >= repeats, np.diff(np.append(begin, len(at))))
        stays = np.empty(len(at), bool)
        stays[order] = often
        kept, own = at[stays], segment[stays]
        cut = np.ones(len(kept), bool)
        cut[1:] = (kept[1:] != kept[:-1] + 1) | (own[1:] != own[:-1])
        begin = np.flatnonzero(cut)
        sizes = np.diff(np.append(begin, len(kept)))
        long = np.repeat(sizes >= least, sizes)
        if stays.all() and long.all():
            return kept[begin], kept[begin] + sizes
        at, segment = kept[long], np.repeat(np.arange(len(sizes)), sizes)[long]
    return np.zeros(0, np.int64), np.zeros(0, np.int64)


class Blocks:
    """Equality of stretches of words by rolling hash."""

    def __init__(self, word: np.ndarray):
        self.word = word
        self.up, _ = _power_tables(len(word) + 1)
        with np.errstate(over="ignore"):
            self.sums = np.zeros(len(word) + 1, np.uint64)
            # sums[i] = word[0] * B**0 + ... + word[i - 1] * B**(i - 1)
            np.cumsum(word * self.up[:len(word)], out=self.sums[1:])

    def equal(self, at: np.ndarray, lag: np.ndarray, size: np.ndarray) -> np.ndarray:
        """Whether the ``size`` words from ``at`` equal those ``lag`` words later."""
        with np.errstate(over="ignore"):
            return (self.sums[at + size] - self.sums[at]) * self.up[lag] == self.sums[at + lag + size] - self.sums[at + lag]

    def reach(self, at: np.ndarray, lag: np.ndarray, most: np.ndarray, back: bool) -> np.ndarray:
        """How many words from ``at`` on (before ``at`` if ``back``) equal those ``lag`` words later, ``most`` at most."""
        low, high = np.zeros(len(at), np.int64), most.copy()
        while (low < high).any():
            middle = (low + high + 1) // 2
            same = self.equal(at - middle if back else at, lag, middle)
            low, high = np.where(same, middle, low), np.where(same, high, middle - 1)
        return low


def _lag_rows(begin: np.ndarray, end: np.ndarray, repeats: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """``(segment begin, segment end, lag)`` for all lags of all segments, in batches of about ``SCAN_ROWS`` blocks."""
    size = end - begin
    lags = size // repeats
    last = np.cumsum(lags)
    total, lo = int(last[-1]) if len(last) else 0, 0
    while lo < total:
        hi = min(total, lo + SCAN_ROWS)
        row = np.arange(lo, hi)
        own = np.searchsorted(last, row, side="right")
        lag = row - (last[own] - lags[own]) + 1
        blocks = np.cumsum(size[own] // lag)
        some = max(1, int(np.searchsorted(blocks, SCAN_ROWS, side="right")))
        yield begin[own[:some]], end[own[:some]], lag[:some]
        lo += some


def scan(word: np.ndarray, begin: np.ndarray, end: np.ndarray, least: int = LEAST_LENGTH, repeats: int = REPEATS) -> np.ndarray:
    """Rows ``(start, length, period)`` of the runs inside the segments, by start, then period."""
    found = [np.zeros((0, 3), np.int64)]
    blocks = Blocks(word) if len(begin) else None
    for first, stop, lag in _lag_rows(begin, end, repeats):
        count = (stop - first) // lag - 1  # blocks with a whole block after them
        row = np.repeat(np.arange(len(lag)), count)
        number = np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count)
        q = lag[row]
        at = first[row] + number * q
        same = word[at] == word[at + q]
        some = np.flatnonzero(same)
        same[some] = blocks.equal(at[some], q[some], q[some])
        # the first of two or more equal blocks in a row
        pair = np.zeros(len(same), bool)
        pair[:-1] = same[:-1] & same[1:] & (row[:-1] == row[1:])
        head = pair.copy()
        head[1:] &= ~(pair[:-1] & (row[:-1] == row[1:]))
        head = np.flatnonzero(head)
        if not len(head):
            continue
        tail = _ends(same, row, head)
        row, q, x = row[head], q[head], at[head]
        after = x + (tail - head) * q  # the words from here on are compared singly
        left = blocks.reach(x, q, np.minimum(q - 1, x - first[row]), back=True)
        right = blocks.reach(after, q, np.minimum(q - 1, stop[row] - q - after), back=False)
        start, length = x - left, after + right + q - (x - left)
        good = length >= np.maximum(least, repeats * q)
        found.append(np.stack([start[good], length[good], q[good]], axis=1))
    runs = np.concatenate(found)
    runs = runs[np.lexsort((runs[:, 2], runs[:, 1], runs[:, 0]))]
    new = np.ones(len(runs), bool)
    new[1:] = (runs[1:, :2] != runs[:-1, :2]).any(1)  # the smallest lag of a stretch is its period
    runs = runs[new]
    true = [np.array_equal(word[s:s + n - q], word[s + q:s + n]) for s, n, q in runs.tolist()]
    if not all(true):  # hashes that agree by chance: compare the words of those stretches
        more = [_plain(word, s, s + n, least, repeats) for (s, n, _), t in zip(runs.tolist(), true, strict=True) if not t]
        runs = np.unique(np.concatenate([runs[true], *more]), axis=0)
    return runs[np.lexsort((runs[:, 2], runs[:, 0]))]


def _ends(same: np.ndarray, row: np.ndarray, head: np.ndarray) -> np.ndarray:
    """The place after the last of the equal blocks of a lag that begin at each ``head``."""
    other = np.flatnonzero(np.append(~same, True))
    return np.minimum(other[np.searchsorted(other, head)], np.searchsorted(row, row[head], side="right"))


def _plain(word: np.ndarray, begin: int, end: int, least: int, repeats: int) -> np.ndarray:
    """The runs of one stretch by comparing all words at each lag."""
    runs = {}
    for q in range(1, (end - begin) // repeats + 1):
        same = np.concatenate([[False], word[begin:end - q] == word[begin + q:end], [False]]).astype(np.int8)
        edge = np.flatnonzero(np.diff(same))
        for a, b in zip(edge[::2].tolist(), edge[1::2].tolist(), strict=True):
            if b - a + q >= max(least, repeats * q):
                runs.setdefault((begin + a, b - a + q), q)
    return np.array([(s, n, q) for (s, n), q in runs.items()], np.int64).reshape(-1, 3)


def strongest(runs: np.ndarray) -> tuple[int, int, int] | None:
    """The run with the greatest length / period; ties: smallest start, then period."""
    best = None
    for s, n, q in runs.tolist():
        if best is None or n * best[2] > best[1] * q or (n * best[2] == best[1] * q and (s, q) < (best[0], best[2])):
            best = (s, n, q)
    return best


def _words(chunk: Chunk) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Begin, end, hash of the words of a chunk (long texts in parts), and the first word of each text."""
    parts = [(find_words(part, lower=False), at) for part, at in text_parts(chunk)]
    if len(parts) == 1:
        w = parts[0][0]
        return w.start, w.end, w.hash, w.first
    start, end = (np.concatenate([getattr(w, name) + at for w, at in parts]) for name in ("start", "end"))
    return start, end, np.concatenate([w.hash for w, _ in parts]), np.array([0, len(start)])


def _joined(chunk: Chunk, start: np.ndarray, end: np.ndarray, doc: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The given words of each text, joined by one space: bytes, and the bounds of the texts in them."""
    if not len(start):
        return np.zeros(0, np.uint8), np.zeros(chunk.n + 1, np.int64)
    first = np.ones(len(doc), bool)
    first[1:] = doc[1:] != doc[:-1]
    size = end - start + ~first
    stop = np.cumsum(size)
    bounds = np.append(0, stop)[np.searchsorted(doc, np.arange(chunk.n + 1))]
    out = np.empty(int(stop[-1]), np.uint8)
    step = 1 << 16  # words at a time
    for lo in range(0, len(start), step):
        part = slice(lo, lo + step)
        own = size[part]
        begin = stop[part] - own
        at = np.repeat(start[part] - ~first[part] - begin, own) + np.arange(begin[0], stop[part][-1])
        out[begin[0]:stop[part][-1]] = chunk.data[np.maximum(at, 0)]
        out[begin[~first[part]]] = 0x20
    return out, bounds


def chunk_runs(chunk: Chunk, wrap: Callable | None = None, doc_ids: list | None = None) -> tuple[list[np.ndarray], np.ndarray, np.ndarray]:
    """Each text's runs, and what is left of the texts without the repeats (bytes, bounds)."""
    start, end, word, first = _words(chunk)
    doc = np.repeat(np.arange(chunk.n), np.diff(first))
    if wrap is not None:
        take = np.arange(len(word))
        for i in range(chunk.n):
            n = int(first[i + 1] - first[i])
            turn = wrap(doc_ids[i], n) if n else None
            if turn:
                a, p = turn
                take[first[i] + a:first[i + 1]] = first[i] + a + np.arange(n - a) % p
        start, end, word = start[take], end[take], word[take]
    begin, stop = surviving_segments(word, doc)
    runs = scan(word, begin, stop)
    change = np.zeros(len(word) + 1, np.int64)
    np.add.at(change, runs[:, 0] + runs[:, 2], 1)
    np.add.at(change, runs[:, 0] + runs[:, 1], -1)
    kept = np.cumsum(change[:-1]) == 0
    text, bounds = _joined(chunk, start[kept], end[kept], doc[kept])
    own = np.searchsorted(runs[:, 0], first)
    per_text = [runs[own[i]:own[i + 1]] - [first[i], 0, 0] for i in range(chunk.n)]
    return per_text, text, bounds


def periodic_runs(docs: DataFrame, wrap: Callable | None = None) -> DataFrame:
    """``doc_id`` and, for each row of ``docs(doc_id, text)``, ``runs`` (number of the first word, length,
    period; by start, then period), ``strongest`` (greatest length / period; null without runs) and ``collapsed``, the words
    joined by one space without those that a run repeats.

    Null, empty and blank texts have no words: no runs, an empty ``collapsed``. Whole texts are read, very long ones in parts;
    their words' hashes and places (40 bytes a word) are in memory together. Rows that repeat a doc_id, or have none, are rows like any
    other. An empty table gives an empty result; other columns are ignored. ``wrap(doc_id, n)`` may give ``(a, p)``
    for a text of ``n`` words: its words from ``a`` on then are the ``p`` words from ``a``, again and again."""
    def run(batches):
        for batch in batches:
            ids = batch.column("doc_id")
            for chunk in text_chunks(batch.column("text")):
                own = ids.slice(chunk.first, chunk.n)
                runs, text, bounds = chunk_runs(chunk, wrap, own.to_pylist())
                flat = np.concatenate(runs) if runs else np.zeros((0, 3), np.int64)
                structs = pa.StructArray.from_arrays([pa.array(flat[:, j].copy()) for j in range(3)], fields=list(RUN))
                offsets = np.concatenate([[0], np.cumsum([len(r) for r in runs])]).astype(np.int32)
                best = [strongest(r) for r in runs]
                best = pa.array([b and dict(zip(("start", "length", "period"), b, strict=True)) for b in best], RUN)
                yield pa.RecordBatch.from_arrays(
                    [own, pa.ListArray.from_arrays(pa.array(offsets), structs), best,
                     pa.StringArray.from_buffers(chunk.n, pa.py_buffer(bounds.astype(np.int32)), pa.py_buffer(text))],
                    ["doc_id", "runs", "strongest", "collapsed"])
    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, "doc_id long, " + RESULT)


def planted(doc_id: int | None, n: int) -> tuple[int, int] | None:
    """The repeats that the query puts into every tenth text: from which word on, and their period."""
    if doc_id is None:
        return None
    h = zlib.crc32(str(doc_id).encode())
    if h % 10:
        return None
    g = h // 10
    return g % n, 1 + (n - g % n) // (3 + g % 8)


def digests(found: DataFrame) -> DataFrame:
    """The query's columns from those of ``periodic_runs``."""
    lines = F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"]))
    text = F.concat(F.array_join(lines, "\n"), F.when(F.size("runs") > 0, F.lit("\n")).otherwise(F.lit("")))
    best = F.col("strongest")
    return found.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), best["start"].alias("start"), best["length"].alias("length"),
        best["period"].alias("period"), F.expr("1000 * strongest.length div strongest.period").alias("exponent_milli"),
        F.sha2(text, 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"))


@llm_query("op12_periodic_runs")
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents, every tenth with planted repeats."""
    return digests(periodic_runs(table(spark, sf_dir, "documents"), planted))
