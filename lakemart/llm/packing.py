"""Operator 10: best-fit packing of documents into sequences by hierarchical residuals.

Texts become token ids (a closing id after each) inside tasks, and longer ones are cut
into pieces of ``capacity``. The pieces are dealt evenly over partitions, so that files or sources
of one length meet the others. Then bins are built in rounds. In the first, each partition
packs its own pieces, longest first, each into the bin it fills best. Nearly full bins are
done; the others are items of the next round, in which groups of ``FAN_IN`` former
partitions are packed together in the same way, up to a single group or ``MOST_ITEMS``
items a group, whatever comes first. A round's table has one row per bin left over; a
piece's sequence and place follow from the chain of its bins.
"""

from __future__ import annotations

import os
import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakemart.llm.common import llm_query, table
from lakemart.llm.textops import SMALL_BYTES, release_memory, text_chunks
from lakemart.session import cut_lineage, scoped_conf

CAPACITY = 2048
CLOSING_ID = 0
SLACK = 4  # a bin with less room than this is nearly full
FAN_IN = 8
MOST_ITEMS = 500_000
BATCH_ROWS = 2000  # texts sent to a worker at once, beside its table of pieces
FIRST_ITEMS = 1 << 16  # pieces of a group of the first round

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"

_coders: dict[str, object] = {}


def _coder(path: str):
    """One table of pieces per worker process and vocabulary."""
    if path not in _coders:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from lakemart.llm.pretokens import PieceIds
        _coders[path] = PieceIds(path)
    return _coders[path]


def piece_starts(n: int, capacity: int) -> list[int]:
    """Where the pieces of a document of ``n`` ids begin; only the first may be shorter."""
    first = n - capacity * ((n - 1) // capacity)
    return [0, *range(first, n, capacity)]


def token_pieces(docs: DataFrame, vocabulary: str, capacity: int = CAPACITY) -> DataFrame:
    """The pieces of each row of ``docs(doc_id, text)`` (null text: empty), see ``PIECES``."""
    def run(batches):
        coder = _coder(vocabulary)
        for batch in batches:
            texts, doc_ids = batch.column("text"), batch.column("doc_id")
            for chunk in text_chunks(texts, SMALL_BYTES):
                ids, bounds = coder.encode(chunk)
                rows: list[tuple] = []
                raw = chunk.data.tobytes()
                for i in range(chunk.n):
                    own = ids[bounds[i]:bounds[i + 1]]
                    text = raw[chunk.bounds[i]:chunk.bounds[i + 1]]
                    if any(s.encode() in text for s in coder.special):  # the tokenizer's own handling of special strings
                        own = np.array(coder.tokenizer.encode(text.decode(), add_special_tokens=False).ids, np.uint32)
                    own = np.append(own, np.uint32(CLOSING_ID)).astype("<u4")
                    starts = piece_starts(len(own), capacity)
                    for k, (a, b) in enumerate(zip(starts, [*starts[1:], len(own)], strict=True)):
                        rows.append((chunk.first + i, k, a, b - a, zlib.crc32(own[a:b].tobytes())))
                at, piece, start, length, crc = zip(*rows, strict=True)
                yield pa.RecordBatch.from_arrays(
                    [doc_ids.take(pa.array(at)), pa.array(piece, pa.int32()), pa.array(start, pa.int64()),
                     pa.array(length, pa.int64()), pa.array(crc, pa.int64())],
                    ["doc_id", "piece", "start", "length", "ids_crc32"])
            release_memory()
    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, PIECES)


def best_fit(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray, list[int]]:
    """Longest first, each into the open bin with the least room that holds it.
    Gives every item's bin and offset, and every bin's fill."""
    bins, offsets = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
    fill: list[int] = []
    by_room: list[list[int]] = [[] for _ in range(capacity + 1)]
    rooms = 0  # bit r is set when a bin has room r
    for i in np.argsort(-lengths, kind="stable").tolist():
        size = int(lengths[i])
        fits = rooms >> size
        if fits:
            room = size + (fits & -fits).bit_length() - 1
            b = by_room[room].pop()
            if not by_room[room]:
                rooms ^= 1 << room
        else:
            room, b = capacity, len(fill)
            fill.append(0)
        bins[i], offsets[i] = b, fill[b]
        fill[b] += size
        left = room - size
        if left:
            by_room[left].append(b)
            rooms |= 1 << left
    return bins, offsets, fill


def _packed(table: pa.Table, number: int, capacity: int) -> pa.Table:
    """A group's items (under 2**20) with their bin, offset and the bin's fill; ``number`` is the group's own."""
    bins, offsets, fill = best_fit(table.column("length").to_numpy(), capacity)
    full = np.array(fill, np.int64)[bins] if len(bins) else np.zeros(0, np.int64)
    for name, values in (("bin", bins + (number << 20)), ("offset", offsets), ("fill", full)):
        table = table.append_column(name, pa.array(values, pa.int64()))
    return table


def pack(pieces: DataFrame, capacity: int = CAPACITY, fan_in: int = FAN_IN, most_items: int = MOST_ITEMS,
         first_items: int = FIRST_ITEMS) -> DataFrame:
    """``pieces`` (a table with ``length``, 1 to ``capacity``) with ``sequence_id`` and ``offset``. The number of
    groups follows from the number of pieces alone."""
    def first_round(batches):
        number, held, n, sub = TaskContext.get().partitionId(), [], 0, 0
        for batch in batches:
            held.append(batch)
            n += batch.num_rows
            if n >= most_items:
                yield from _packed(pa.Table.from_batches(held), number + (sub << 20), capacity).to_batches()
                held, n, sub = [], 0, sub + 1
        if n:
            yield from _packed(pa.Table.from_batches(held), number + (sub << 20), capacity).to_batches()

    def next_round(key, group):
        return _packed(group, key[0].as_py(), capacity).select(["item", "bin", "offset", "fill"])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in pieces.schema)
    parts = max(1, -(-pieces.count() // min(first_items, most_items)))
    dealt = pieces.repartition(parts)  # evenly, in the order of a hash of the rows
    placed = cut_lineage(dealt.mapInArrow(first_round, f"{schema}, bin long, offset long, fill long"), "op10-bins")

    def underfull(frame):
        return frame.where((F.col("offset") == 0) & (F.col("fill") <= capacity - SLACK)).select(
            F.col("bin").alias("item"), F.col("fill").alias("length"))

    left, chain = underfull(placed), None
    n, last = left.agg(F.count("*"), F.max(F.expr("(item >> 20) & 1048575"))).first()
    groups, step = 1 + (last or 0), 0
    while n > 1:
        step += 1
        least = -(-n // most_items)
        groups = max(-(-groups // fan_in), least)
        number = F.pmod(F.xxhash64("item", F.lit(step)), F.lit(groups)) + F.lit(step << 32)
        merged = cut_lineage(left.groupBy(number.alias("g")).applyInArrow(
            next_round, "item long, bin long, offset long, fill long"), "op10-merge")
        link = merged.select("item", F.col("bin").alias("new"), F.col("offset").alias("shift"))
        if chain is None:
            chain = link
        else:
            up = link.select(F.col("item").alias("new"), F.col("new").alias("top"), F.col("shift").alias("more"))
            chain = chain.join(up, "new", "left").select(
                "item", F.coalesce("top", "new").alias("new"), (F.col("shift") + F.coalesce("more", F.lit(0))).alias("shift"))
        left = underfull(merged)
        n = left.count()
        if groups == least:
            break
    named = [F.col(f"`{f.name}`") for f in pieces.schema]
    if chain is None:
        return placed.select(*named, F.col("bin").alias("sequence_id"), "offset")
    return (placed.join(chain, F.col("bin") == F.col("item"), "left")
            .select(*named, F.coalesce("new", "bin").alias("sequence_id"),
                    (F.col("offset") + F.coalesce("shift", F.lit(0))).alias("offset")))


def packed_documents(docs: DataFrame, vocabulary: str | None = None, capacity: int = CAPACITY) -> DataFrame:
    """``doc_id, piece, start, length, ids_crc32, sequence_id, offset`` for each piece.

    A null or empty text is a document of the closing id alone. Rows that repeat a
    doc_id, or have none, are packed like any other. An empty table gives an empty
    result; other columns are ignored. Sequence numbers are unique but not gapless."""
    if vocabulary is None:
        import public_tokenizers
        vocabulary = public_tokenizers.path("byte_bpe_50k.json")
    spark = docs.sparkSession
    with scoped_conf(spark, {"spark.sql.execution.arrow.maxRecordsPerBatch": str(BATCH_ROWS)}):
        pieces = cut_lineage(token_pieces(docs, vocabulary, capacity), "op10-pieces")
    return pack(pieces, capacity)


@llm_query("op10_best_fit_packing")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents into sequences of 2048 tokens."""
    return packed_documents(table(spark, sf_dir, "documents"))
