"""What the classifiers share: events of a text, a bounded labelled sample, choice of events, sparse fits.

An event is a 64-bit hash: a run of letters in lower case that occurs in the text, two
signs that end at least two of its words, signs that end three of them, or a word that
comes three or six times in a row. A word part, the first 5 or 8 or the last 5 bytes of a longer
run of letters, is an event, too, and so are the first 4 to 7 bytes that two or three of a text's longer words share (``SHARED``).
Texts are read whole. Models are linear in the presence of events. Every event of the sample is scored by itself
in Spark; those that reach ``SCREEN`` for some target are candidates, and as many of them get weights as reach ``LEAST_SCORE``
beside the events chosen before: columns are kept as pairs (row, event), so their number is not bounded.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType, StructField, StructType

from lakemart.llm.common import named
from lakemart.llm.textops import (
    NOT_LETTER, SMALL_BYTES, Chunk, as_list_array, find_words, mix64, release_memory, text_chunks,
)
from lakemart.session import cut_lineage

SAMPLE_ROWS = 20_000  # labelled rows that models are fitted on, at most
LEAST_SCORE = 12.0  # score statistic that an event must reach to be chosen
SCREEN = 6.0  # and by itself to be a candidate
LEAST_ROWS = 4  # with slopes of 1 at most, an event of fewer rows can't reach it
SHARED = [(4, 3), (5, 3), (6, 3), (7, 3), (5, 2), (6, 2), (7, 2)]  # first bytes that so many words of a text must share
PARTS = [(0, 5), (0, 8), (-5, 5)]  # where a word part begins, from the end if negative, and its bytes
FOLDS = 5

_SIGN = NOT_LETTER.copy()
_SIGN[[*range(48, 58), 0x20, *range(9, 14)]] = False
SIGNS = np.uint64(1)
REPEATS = [(3, np.uint64(2)), (6, np.uint64(3))]


def events(chunk: Chunk) -> tuple[np.ndarray, np.ndarray]:
    """``(text number, event)`` pairs of a chunk, each event of a text at least once."""
    letters = find_words(chunk, NOT_LETTER)
    words = find_words(chunk)
    doc, event = [letters.doc], [letters.hash]
    if len(words.hash):
        last, before = chunk.data[words.end - 1], chunk.data[np.maximum(words.end - 2, words.start)]
        signs = np.flatnonzero(_SIGN[last] & _SIGN[before])
        if len(signs):
            pair = (words.doc[signs].astype(np.uint64) << np.uint64(16)) | (
                last[signs].astype(np.uint64) << np.uint64(8)) | before[signs].astype(np.uint64)
            pair, n = np.unique(pair, return_counts=True)
            pair = pair[n >= 2]
            doc.append((pair >> np.uint64(16)).astype(np.int64))
            event.append(mix64((pair & np.uint64(0xFFFF)) + np.uint64(1 << 20)))
            many = np.flatnonzero(np.bincount(words.doc[signs]) >= 3)
            doc.append(many)
            event.append(np.full(len(many), SIGNS))
        new = np.ones(len(words.hash), bool)
        new[1:] = (words.hash[1:] != words.hash[:-1]) | (words.doc[1:] != words.doc[:-1])
        begin = np.flatnonzero(new)
        times = np.diff(np.append(begin, len(new)))
        for least, name in REPEATS:
            again = np.unique(words.doc[begin[times >= least]])
            doc.append(again)
            event.append(np.full(len(again), name))
    return np.concatenate(doc), np.concatenate(event)


def word_parts(chunk: Chunk) -> tuple[np.ndarray, np.ndarray]:
    """``(text number, event)`` pairs for the parts of a chunk's words."""
    letters = find_words(chunk, NOT_LETTER)
    doc, event = [np.zeros(0, np.int64)], [np.zeros(0, np.uint64)]
    for number, (begin, size) in enumerate(PARTS):
        long = np.flatnonzero(letters.end - letters.start > size)
        at = (letters.start if begin >= 0 else letters.end)[long] + begin
        part = np.zeros((len(long), 8), np.uint8)
        part[:, :size] = chunk.data[at[:, None] + np.arange(size)]
        part[(part >= 65) & (part <= 90)] += 32
        doc.append(letters.doc[long])
        event.append(mix64(mix64(part.view(np.uint64)[:, 0]) + np.uint64((number + 1) << 40)))
    for number, (size, least) in enumerate(SHARED):
        long = np.flatnonzero(letters.end - letters.start > size)
        part = np.zeros((len(long), 8), np.uint8)
        part[:, :size] = chunk.data[letters.start[long][:, None] + np.arange(size)]
        part[(part >= 65) & (part <= 90)] += 32
        own, many = letters.doc[long], np.zeros(len(long), bool)
        value = part.view(np.uint64)[:, 0]
        order = np.lexsort((value, own))
        value, own = value[order], own[order]
        many[least - 1:] = (value[least - 1:] == value[:len(value) - least + 1]) & (own[least - 1:] == own[:len(own) - least + 1])
        doc.append(own[many])
        event.append(mix64(mix64(value[many]) + np.uint64((number + 1 + len(PARTS)) << 40)))
    return np.concatenate(doc), np.concatenate(event)


def all_events(chunk: Chunk) -> tuple[np.ndarray, np.ndarray]:
    """The events and word parts of a chunk."""
    both = events(chunk), word_parts(chunk)
    return np.concatenate([b[0] for b in both]), np.concatenate([b[1] for b in both])


def labelled_events(docs: DataFrame, labels: DataFrame, targets: list, rows: int = SAMPLE_ROWS) -> DataFrame:
    """``(fold, y array<double>, events array<long>)`` of at most ``rows`` labelled documents,
    chosen by the hash of their number. Labels or documents that are null take no part."""
    grades = labels.where("doc_id IS NOT NULL").select("doc_id", F.array(*targets).cast("array<double>").alias("y"))
    grades = grades.where(~F.exists("y", lambda v: v.isNull())).groupBy("doc_id").agg(F.min("y").alias("y"))
    chosen = grades.orderBy(F.xxhash64("doc_id", F.lit(4)), "doc_id").limit(rows)
    found = docs.select("doc_id", F.col("text").cast("string")).where("text IS NOT NULL").join(F.broadcast(chosen), "doc_id")

    def run(batches):
        for batch in batches:
            for chunk in text_chunks(batch.column("text"), SMALL_BYTES):
                doc, event = all_events(chunk)
                order = np.lexsort((event, doc))
                doc, event = doc[order], event[order]
                new = np.ones(len(doc), bool)
                new[1:] = (doc[1:] != doc[:-1]) | (event[1:] != event[:-1])
                counts = np.bincount(doc[new], minlength=chunk.n)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("fold").slice(chunk.first, chunk.n), batch.column("y").slice(chunk.first, chunk.n),
                     as_list_array(event[new].view(np.int64), counts, pa.int64())], ["fold", "y", "events"])
    fold = F.pmod(F.xxhash64("doc_id"), F.lit(FOLDS)).cast("int").alias("fold")
    return cut_lineage(found.select(fold, "y", "text").mapInArrow(run, "fold int, y array<double>, events array<long>"),
                       "labelled-events")


class Sample:
    """Labelled rows on the driver: folds, targets, and which rows have each event. It takes
    four bytes for each event of each sampled row."""

    def __init__(self, rows: DataFrame, targets: int):
        self.n, self.events = rows.count(), np.zeros(0, np.int64)
        if not self.n:
            return
        own = [F.col("y")[j] for j in range(targets)]
        shares = rows.agg(*[F.avg(y).alias(f"p{j}") for j, y in enumerate(own)]).first()
        each = rows.select(F.explode("events").alias("event"), *[y.alias(f"y{j}") for j, y in enumerate(own)]).groupBy("event").agg(
            F.count("*").alias("n"), *[F.sum(f"y{j}").alias(f"s{j}") for j in range(targets)])
        best = [(F.col(f"s{j}") - F.col("n") * p) ** 2 / (F.col("n") * (p * (1 - p)) + 1) for j, p in enumerate(shares)]
        some = each.where(F.col("n") >= LEAST_ROWS).where(reduce(lambda a, b: a | b, [b >= SCREEN for b in best]))
        self.events = np.sort(some.select("event").toArrow().column(0).to_numpy())
        candidates = rows.sparkSession.sparkContext.broadcast(self.events)

        def run(batches):
            wanted = candidates.value
            for batch in batches:
                lists = batch.column("events")
                row = np.repeat(np.arange(batch.num_rows), np.asarray(lists.value_lengths()))
                at, hit = _places(wanted, lists.flatten().to_numpy())
                yield pa.RecordBatch.from_arrays(
                    [batch.column("fold"), batch.column("y"),
                     as_list_array(at[hit].astype(np.int32), np.bincount(row[hit], minlength=batch.num_rows), pa.int32())],
                    ["fold", "y", "has"])
        found = rows.mapInArrow(run, "fold int, y array<double>, has array<int>").toArrow().combine_chunks()
        self.fold, self.y = found.column("fold").to_numpy(), np.array(found.column("y").to_pylist(), np.float64)
        has = found.column("has").combine_chunks()
        event, row = has.flatten().to_numpy(), np.repeat(np.arange(self.n, dtype=np.int32), np.asarray(has.value_lengths()))
        # an order that does not depend on the tasks: by fold, targets and events
        name = np.zeros(self.n, np.uint64)
        np.add.at(name, row, mix64(event.astype(np.uint64) + np.uint64(1)))
        order = np.lexsort((name, *self.y.T, self.fold))
        place = np.zeros(self.n, np.int32)
        place[order] = np.arange(self.n, dtype=np.int32)
        self.fold, self.y, row = self.fold[order], self.y[order], place[row]
        by_event = np.argsort(event.astype(np.int64) * self.n + row)
        self.row = row[by_event]
        self.first = np.concatenate([[0], np.cumsum(np.bincount(event, minlength=len(self.events)))])

    def where(self, rows: np.ndarray) -> Sample:
        """The rows of a mask, with all events."""
        part = object.__new__(Sample)
        part.n, part.events, part.fold, part.y = int(rows.sum()), self.events, self.fold[rows], self.y[rows]
        inside = rows[self.row]
        part.row = (np.cumsum(rows) - 1).astype(np.int32)[self.row[inside]]
        part.first = np.concatenate([[0], np.cumsum(inside)])[self.first]
        return part

    def rows_of(self, event: int) -> np.ndarray:
        return self.row[self.first[event]:self.first[event + 1]]

    def sums(self, values: np.ndarray) -> np.ndarray:
        """For each event the sum of its rows' values."""
        return np.diff(np.concatenate([[0.0], np.cumsum(values[self.row])])[self.first])

    def columns(self, start: np.ndarray, chosen: list[int]) -> Columns:
        """The columns ``start`` and those of the chosen events."""
        rows = [np.zeros(0, np.int64), *[self.rows_of(e) for e in chosen]]
        return Columns(start, np.concatenate(rows), np.repeat(np.arange(len(chosen)), [len(r) for r in rows[1:]]), len(chosen))


class Columns:
    """A matrix of dense columns, then sparse ones of 0 and 1 as pairs of row and column."""

    def __init__(self, dense: np.ndarray, row: np.ndarray, column: np.ndarray, sparse: int):
        self.dense, self.row, self.column, self.sparse = dense, row, column, sparse
        self.shape = (len(dense), dense.shape[1] + sparse)

    def __matmul__(self, weights: np.ndarray) -> np.ndarray:
        d = self.dense.shape[1]
        return self.dense @ weights[:d] + np.bincount(self.row, weights[d:][self.column], self.shape[0])

    def transposed(self, values: np.ndarray, dense: np.ndarray | None = None) -> np.ndarray:
        dense = self.dense if dense is None else dense
        return np.concatenate([dense.T @ values, np.bincount(self.column, values[self.row], self.sparse)])

    def where(self, rows: np.ndarray) -> Columns:
        number, inside = np.cumsum(rows) - 1, rows[self.row]
        return Columns(self.dense[rows], number[self.row[inside]], self.column[inside], self.sparse)


def transposed(x: np.ndarray | Columns, values: np.ndarray) -> np.ndarray:
    return x.transposed(values) if isinstance(x, Columns) else x.T @ values


def newton_change(x: np.ndarray | Columns, curve: np.ndarray, ridge: np.ndarray, gradient: np.ndarray) -> np.ndarray:
    """Solves ``(X' diag(curve) X + diag(ridge)) change = gradient``, for sparse columns by conjugate gradients."""
    if not isinstance(x, Columns):
        return np.linalg.solve((x.T * curve) @ x + np.diag(ridge), gradient)
    scale = x.transposed(curve, x.dense**2) + ridge
    change, left = np.zeros(len(gradient)), gradient.copy()
    step = scaled = left / scale
    size = start = left @ scaled
    for _ in range(10 * len(gradient)):
        if size <= 1e-16 * start or size <= 1e-24:
            break
        image = x.transposed(curve * (x @ step)) + ridge * step
        length = size / (step @ image)
        change, left = change + length * step, left - length * image
        scaled = left / scale
        size, before = left @ scaled, size
        step = scaled + size / before * step
    return change


def choose_events(sample: Sample, fit: Callable, start: np.ndarray) -> tuple[list[int], Columns]:
    """Add the events with the largest score statistics (down to half of the largest) and fit anew, until none is large.

    ``fit(X)`` returns the model and, for each row, the slope and the curvature of its log
    likelihood in the linear predictor. ``start`` holds columns that are always in."""
    chosen: list[int] = []
    x = sample.columns(start, chosen)
    model, slope, curve = fit(x)
    while len(sample.events):
        score = sample.sums(slope) ** 2 / (sample.sums(curve) + 1)
        score[chosen] = 0
        if score.max() < LEAST_SCORE:
            break
        chosen += np.flatnonzero(score >= max(LEAST_SCORE, score.max() / 2)).tolist()
        x = sample.columns(start, chosen)
        model, slope, curve = fit(x)
    return chosen, x


def _places(wanted: np.ndarray, event: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where each event is in ``wanted`` (sorted), and whether it is there."""
    if not len(wanted):
        return np.zeros(len(event), np.int64), np.zeros(len(event), bool)
    at = np.minimum(np.searchsorted(wanted, event), len(wanted) - 1)
    return at, wanted[at] == event


class Presence:
    """Which of the ``wanted`` events (sorted) each text of a chunk has."""

    def __init__(self, chunk: Chunk, wanted: np.ndarray):
        self.n = chunk.n
        doc, event = all_events(chunk)
        at, hit = _places(wanted, event.view(np.int64))
        pair = np.unique(doc[hit] * max(1, len(wanted)) + at[hit])
        self.doc, self.event = pair // max(1, len(wanted)), pair % max(1, len(wanted))

    def __matmul__(self, weights: np.ndarray) -> np.ndarray:
        return np.bincount(self.doc, weights[self.event], self.n)


def score_rows(docs: DataFrame, wanted: np.ndarray, columns: list[str], predict: Callable, text: str = "text",
               keep: Callable | None = None) -> DataFrame:
    """All columns of ``docs`` and ``predict(Presence)``'s columns of doubles; with ``keep``, a condition on their
    values, the columns of ``docs`` alone for the rows that it holds for."""
    def run(batches):
        for batch in batches:
            found = [predict(Presence(chunk, wanted)) for chunk in text_chunks(batch.column(text), SMALL_BYTES)]
            values = np.concatenate(found) if found else np.zeros((0, len(columns)))
            if keep is not None:
                yield batch.filter(pa.array(keep(values)))
            else:
                yield pa.RecordBatch.from_arrays([*batch.columns, *[pa.array(values[:, j].copy()) for j in range(len(columns))]],
                                                 [*batch.schema.names, *columns])
            release_memory()
    more = [] if keep is not None else [StructField(c, DoubleType()) for c in columns]
    return docs.mapInArrow(run, StructType([*docs.schema.fields, *more]))


def kept_rows(docs: DataFrame, filtered: Callable) -> DataFrame:
    """``filtered(rows, text)``, where ``rows`` are those of ``docs`` with their columns numbered (any names will do)
    and ``text`` is the column of texts, under the names of ``docs`` again. Each text is sent to Python once."""
    numbered = [named(c).alias(f"c{i}") for i, c in enumerate(docs.columns)]
    own = docs.columns.index("text")
    plain = isinstance(docs.schema.fields[own].dataType, StringType)
    rows = docs.select(*numbered, *([] if plain else [F.col("text").cast("string").alias("as_text")]))
    kept = filtered(rows, f"c{own}" if plain else "as_text")
    return kept.select(*[F.col(f"c{i}").alias(c) for i, c in enumerate(docs.columns)])


def training_tables(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    return spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/labels.parquet")
