"""Operator 3: scoring texts with a hidden Markov language model.

A text is its words and one end token. Token counts over all training texts form a
table. The most frequent tokens are classes of their own; the others fall into classes by
spelling (their last three bytes), so the model's alphabet stays bounded
whatever the vocabulary. A hidden state emits a class, and the class a token:

    P(token | state) = emit[state, class] * (count + 1) / (size of class)

where the size of a class sums ``count + 1`` over its training tokens, and 1 more for
all its unknown tokens together. So it is a distribution over known tokens and one
unknown token a class, and ``score`` is the exact log10 probability by the scaled
forward recursion.

Baum-Welch runs over all training texts: tasks do forward-backward on their texts and
emit expected counts, which Spark sums by cell (``states * classes`` of them). The states
start from groups of frequent tokens that occur in the same texts, counted over all
training texts. Counts of the most frequent tokens (at most ``HEAD_TOKENS``) go to the
tasks; all other tokens of a text are joined with the count table.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakemart.llm.common import llm_query, table
from lakemart.llm.textops import as_list_array, find_words, mix64, text_chunks
from lakemart.session import cut_lineage

STATES = 8
OWN_CLASSES = 1024
SPELLING_CLASSES = 1024
HEAD_TOKENS = 1 << 17
ANCHORS = 256
ROUNDS = 3
PRIOR = 50.0  # pseudo-tokens of the class frequencies in each state
FOLD, FOLDS = 2, 7
END_HASH = np.int64(-1)
HELD_TOKENS = 1 << 21  # token counts a task holds before it emits them
LANE_TOKENS = 400_000  # tokens that run through the recursions together


def held_out(doc_id) -> F.Column:
    """Rows that the model doesn't learn from (null doc_id counts as an empty text)."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % FOLDS == FOLD


def _spelling(words, data: np.ndarray) -> np.ndarray:
    size = words.end - words.start
    code = data[words.end - 1].astype(np.uint64)
    for back in (2, 3):
        byte = data[np.maximum(words.end - back, 0)].astype(np.uint64)
        code = code * np.uint64(257) + np.where(size >= back, byte + np.uint64(1), np.uint64(0))
    return (mix64(code) % np.uint64(SPELLING_CLASSES)).astype(np.int32)


def _lowered(data: np.ndarray) -> np.ndarray:
    return np.where((data >= 65) & (data <= 90), data + 32, data)


def token_counts(texts: DataFrame) -> DataFrame:
    """``(token, spelling, n)`` over all rows: token hash, class by spelling, occurrences."""
    def run(batches):
        held, size = [], 0

        def flush():
            token = np.concatenate([h[0] for h in held])
            unique, first, inverse = np.unique(token, return_index=True, return_inverse=True)
            n = np.bincount(inverse, np.concatenate([h[2] for h in held]), len(unique)).astype(np.int64)
            return unique, np.concatenate([h[1] for h in held])[first], n

        def rows(part):
            return pa.RecordBatch.from_arrays([pa.array(part[0]), pa.array(part[1], pa.int32()), pa.array(part[2])],
                                              ["token", "spelling", "n"])
        for batch in batches:
            for chunk in text_chunks(batch.column("text")):
                words = find_words(chunk)
                unique, first, n = np.unique(words.hash.view(np.int64), return_index=True, return_counts=True)
                held.append((unique, _spelling(words, _lowered(chunk.data))[first] if len(unique) else np.zeros(0, np.int32), n))
                held.append((np.array([END_HASH]), np.array([-1], np.int32), np.array([chunk.n])))
                size += len(unique)
                if size > HELD_TOKENS:
                    held = [flush()]
                    size = len(held[0][0])
                    if size > HELD_TOKENS // 2:
                        yield rows(held[0])
                        held, size = [], 0
        if held:
            yield rows(flush())
    parts = texts.select(F.col("text").cast("string")).mapInArrow(run, "token long, spelling int, n long")
    return parts.groupBy("token").agg(F.first("spelling").alias("spelling"), F.sum("n").alias("n"))


def head_tokens(counts: DataFrame, most: int) -> list:
    """The most frequent tokens, by a level of count that at most ``most`` reach."""
    step = F.floor(F.log2("n") * 8).cast("int")
    level, total = None, 0
    for r in counts.groupBy(step.alias("b")).count().orderBy(F.desc("b")).collect():  # 8 rows a doubling
        total += r["count"]
        if total > most:
            break
        level = r["b"]
    if level is None:
        return []
    return counts.where(step >= level).orderBy(F.desc("n"), "token").collect()


def encode(docs: DataFrame, head) -> DataFrame:
    """Per row: its number, tokens, what is known from the head, classes, other tokens."""
    def run(batches):
        tokens, counts, classes = head.value
        number, part = 0, TaskContext.get().partitionId() << 36
        for batch in batches:
            for chunk in text_chunks(batch.column("text")):
                words = find_words(chunk)
                token = words.hash.view(np.int64)
                kind = OWN_CLASSES + 1 + _spelling(words, _lowered(chunk.data)) if len(token) else np.zeros(0, np.int32)
                at = np.minimum(np.searchsorted(tokens, token), max(0, len(tokens) - 1))
                known = tokens[at] == token if len(tokens) else np.zeros(len(token), bool)
                own = known.copy()
                own[known] = classes[at[known]] >= 0
                kind[own] = classes[at[own]]
                logs = np.where(known, np.log10(counts[at] + 1.0) if len(tokens) else 0.0, 0.0)
                n = chunk.n
                rest_doc, rest = words.doc[~known], token[~known]
                order = np.lexsort((rest, rest_doc))
                rest_doc, rest = rest_doc[order], rest[order]
                new = np.ones(len(rest), bool)
                new[1:] = (rest[1:] != rest[:-1]) | (rest_doc[1:] != rest_doc[:-1])
                begin = np.flatnonzero(new)
                times = np.diff(np.append(begin, len(rest)))
                per_doc = np.bincount(rest_doc[begin], minlength=n)
                stops = words.first[1:]
                ends = np.insert(kind, stops, OWN_CLASSES).astype("<u2")
                at_end = words.first + np.arange(n + 1)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(part + number + np.arange(n)), batch.column("doc_id").slice(chunk.first, n),
                     batch.column("held_out").slice(chunk.first, n), pa.array(words.per_doc + 1),
                     pa.array(np.bincount(words.doc[known], minlength=n)), pa.array(np.bincount(words.doc, logs, n)),
                     pa.array([ends[a:b].tobytes() for a, b in zip(at_end[:-1], at_end[1:], strict=True)], pa.binary()),
                     as_list_array(rest[begin], per_doc, pa.int64()), as_list_array(times, per_doc, pa.int32())],
                    ["row", "doc_id", "held_out", "n_tokens", "known_head", "logs_head", "classes", "rest", "times"])
                number += n
    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", F.col("text").cast("string"), held_out(F.col("doc_id")).alias("held_out")).mapInArrow(
        run, f"row long, doc_id {kind}, held_out boolean, n_tokens long, known_head long, logs_head double, "
             "classes binary, rest array<long>, times array<int>")


# ---- the recursions


class Lanes:
    """Sequences side by side, longest first, their tokens ordered by time."""

    def __init__(self, sequences: list[np.ndarray]):
        size = np.fromiter(map(len, sequences), np.int64, len(sequences))
        self.order = np.argsort(-size, kind="stable")
        size = size[self.order]
        self.live = np.searchsorted(-size, -np.arange(1, int(size[0]) + 1), side="right")  # lanes with a token at each time
        self.at = np.concatenate([[0], np.cumsum(self.live)])
        tokens = np.concatenate([sequences[i] for i in self.order]).astype(np.int64)
        time = np.arange(len(tokens)) - np.repeat(np.cumsum(size) - size, size)
        self.place = self.at[time] + np.repeat(np.arange(len(size)), size)
        self.tokens = np.empty_like(tokens)
        self.tokens[self.place] = tokens
        self.starts = np.cumsum(size) - size

    def forward(self, start: np.ndarray, move: np.ndarray, emit: np.ndarray) -> np.ndarray:
        """Scaled forward recursion; natural log likelihood of each sequence."""
        self.out = emit[self.tokens]
        self.alpha, self.scale = np.empty_like(self.out), np.empty(len(self.tokens))
        for t, n in enumerate(self.live.tolist()):
            here = slice(self.at[t], self.at[t] + n)
            a = self.alpha[here]
            if t:
                np.matmul(before[:n], move, out=a)
                a *= self.out[here]
            else:
                np.multiply(start, self.out[here], out=a)
            s = self.scale[here] = a.sum(1)
            a /= s[:, None]
            before = a
        logs = np.add.reduceat(np.log(self.scale)[self.place], self.starts)
        found = np.empty_like(logs)
        found[self.order] = logs
        return found

    def expected(self, move: np.ndarray, classes: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """After ``forward``: expected first states, moves and emissions of each state."""
        k = move.shape[0]
        pairs = np.zeros((k, k))
        back = np.ones((int(self.live[-1]), k))
        for t in range(len(self.live) - 1, 0, -1):
            n = int(self.live[t])
            here, prior = slice(self.at[t], self.at[t] + n), slice(self.at[t - 1], self.at[t - 1] + n)
            step = self.out[here] * back
            step /= self.scale[here, None]
            pairs += self.alpha[prior].T @ step
            self.alpha[here] *= back
            back = np.ones((int(self.live[t - 1]), k))
            np.matmul(step, move.T, out=back[:n])
        self.alpha[:self.live[0]] *= back
        first = self.alpha[:self.live[0]].sum(0)
        shown = np.stack([np.bincount(self.tokens, self.alpha[:, j], classes) for j in range(k)])
        return first, pairs * move, shown


def _lanes(batches):
    """Sequences of a batch in groups of about ``LANE_TOKENS`` tokens and of like length."""
    for batch in batches:
        found = [np.frombuffer(c, "<u2") for c in batch.column("classes").to_pylist()]
        order = sorted(range(len(found)), key=lambda i: len(found[i]))
        group, size = [], 0
        for i in order:
            group.append(i)
            size += len(found[i])
            if size > LANE_TOKENS:
                yield batch, group, Lanes([found[i] for i in group])
                group, size = [], 0
        if group:
            yield batch, group, Lanes([found[i] for i in group])


def _shared_texts(texts: DataFrame) -> np.ndarray:
    """For the most frequent classes: in how many training texts two occur together."""
    def run(batches):
        total = np.zeros((ANCHORS, ANCHORS))
        for batch in batches:
            found = batch.column("classes").to_pylist()
            for lo in range(0, len(found), 2000):
                part = [np.frombuffer(c, "<u2") for c in found[lo:lo + 2000]]
                row = np.repeat(np.arange(len(part)), [len(p) for p in part])
                token = np.concatenate(part)
                there = np.zeros((len(part), ANCHORS), np.float32)
                few = token < ANCHORS
                there[row[few], token[few]] = 1
                total += there.T @ there
        cell = np.flatnonzero(total.ravel())
        yield pa.RecordBatch.from_arrays([pa.array(cell, pa.int32()), pa.array(total.ravel()[cell])], ["cell", "v"])
    return _summed(texts.select("classes").mapInArrow(run, "cell int, v double"), ANCHORS * ANCHORS).reshape(ANCHORS, ANCHORS)


def _summed(cells: DataFrame, size: int) -> np.ndarray:
    out = np.zeros(size)
    for r in cells.groupBy("cell").agg(F.sum("v").alias("v")).collect():  # ``size`` rows at most
        out[r["cell"]] = r["v"]
    return out


def first_states(together: np.ndarray, share: np.ndarray, states: int) -> np.ndarray:
    """Emissions to begin with: frequent classes that occur in the same texts lean to one state."""
    emit = np.tile(share, (states, 1))
    there = np.flatnonzero(np.diag(together) > 0)
    if len(there):
        rows = together[np.ix_(there, there)]
        expected = np.outer(np.diag(rows), np.diag(rows)) / max(1.0, np.diag(rows).max())
        rows = np.log1p(rows / expected)
        rows -= rows.mean(0)
        rows /= np.linalg.norm(rows, axis=1, keepdims=True) + 1e-12
        chosen = [0]
        while len(chosen) < min(states, len(there)):  # the class least like those chosen
            chosen.append(int(np.argmin((rows @ rows[chosen].T).max(1))))
        centre = rows[chosen]
        for _ in range(20):
            group = np.argmax(rows @ centre.T, axis=1)
            centre = np.stack([rows[group == j].sum(0) if (group == j).any() else centre[j] for j in range(len(centre))])
            centre /= np.linalg.norm(centre, axis=1, keepdims=True) + 1e-12
        for j in range(len(centre)):
            emit[j, there[group != j]] *= 0.2
    return emit / emit.sum(1, keepdims=True)


def train(texts: DataFrame, share: np.ndarray, states: int = STATES, rounds: int = ROUNDS):
    """Start, move and emission probabilities by Baum-Welch over all ``texts`` (with ``classes``)."""
    spark, classes = texts.sparkSession, len(share)
    start = np.full(states, 1 / states)
    move = np.full((states, states), 0.1 / max(1, states - 1))
    np.fill_diagonal(move, 0.9 if states > 1 else 1.0)
    emit = first_states(_shared_texts(texts), share, states)
    for _ in range(rounds):
        model = spark.sparkContext.broadcast((start, move, np.ascontiguousarray(emit.T)))  # states * classes numbers

        def run(batches, model=model):
            start, move, emit = model.value
            total = np.zeros(states + states * states + states * classes)
            for _, _, lanes in _lanes(batches):
                lanes.forward(start, move, emit)
                first, pairs, shown = lanes.expected(move, classes)
                total += np.concatenate([first, pairs.ravel(), shown.ravel()])
            cell = np.flatnonzero(total)
            yield pa.RecordBatch.from_arrays([pa.array(cell, pa.int32()), pa.array(total[cell])], ["cell", "v"])
        total = _summed(texts.select("classes").mapInArrow(run, "cell int, v double"),
                        states + states * states + states * classes)
        start = total[:states] + 1
        move = total[states:states + states * states].reshape(states, states) + np.eye(states) + 0.1
        emit = total[states + states * states:].reshape(states, classes) + PRIOR * share
        start, move, emit = start / start.sum(), move / move.sum(1, keepdims=True), emit / emit.sum(1, keepdims=True)
    return start, move, emit


def score_documents(docs: DataFrame, states: int = STATES, rounds: int = ROUNDS) -> DataFrame:
    """``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score`` for each row
    of ``docs(doc_id, text)``.

    A null or empty text is its end token alone. Rows that repeat a doc_id are rows like
    any other; those without doc_id train the model. An empty table, or one without training
    rows, still gives its rows (all counts are 0 then). Other columns are ignored."""
    spark = docs.sparkSession
    training = docs.where(~held_out(F.col("doc_id")))
    counts = cut_lineage(token_counts(training), "op3-counts")
    head = head_tokens(counts, HEAD_TOKENS)
    own = [r for r in head if r["token"] != END_HASH][:OWN_CLASSES]
    class_of = {r["token"]: i for i, r in enumerate(own)}
    head = sorted((r for r in head if r["token"] != END_HASH), key=lambda r: r["token"])
    tables = spark.sparkContext.broadcast((  # HEAD_TOKENS rows at most
        np.array([r["token"] for r in head], np.int64), np.array([r["n"] for r in head], np.float64),
        np.array([class_of.get(r["token"], -1) for r in head], np.int32)))

    # size of each class: tokens' counts, distinct tokens, one unknown token of a spelling class
    classes = OWN_CLASSES + 1 + SPELLING_CLASSES
    many, distinct = np.zeros(classes), np.zeros(classes)
    for r in counts.groupBy("spelling").agg(F.sum("n").alias("n"), F.count("*").alias("v")).collect():
        c = OWN_CLASSES if r["spelling"] < 0 else OWN_CLASSES + 1 + r["spelling"]
        many[c], distinct[c] = r["n"], r["v"]
    for i, r in enumerate(own):
        many[i], distinct[i] = r["n"], 1
        many[OWN_CLASSES + 1 + r["spelling"]] -= r["n"]
        distinct[OWN_CLASSES + 1 + r["spelling"]] -= 1
    n_all, v_all, n_end = int(many.sum()), int(distinct.sum()), int(many[OWN_CLASSES])
    size = many + distinct
    size[OWN_CLASSES + 1:] += 1
    size[OWN_CLASSES] = n_end + 1
    share = (many + 1) * (size > 0)
    share /= share.sum()
    log_size = np.log10(np.maximum(size, 1))

    rows = cut_lineage(encode(docs, tables), "op3-rows")
    model = spark.sparkContext.broadcast(train(rows.where("NOT held_out"), share, states, rounds))

    def run(batches):
        start, move, emit = model.value
        emit = np.ascontiguousarray(emit.T)
        for batch, group, lanes in _lanes(batches):
            logs = lanes.forward(start, move, emit) / math.log(10)
            size = np.add.reduceat(log_size[lanes.tokens][lanes.place], lanes.starts)
            logs[lanes.order] -= size
            yield pa.RecordBatch.from_arrays([batch.column("row").take(pa.array(group)), pa.array(logs)], ["row", "model"])
    scored = rows.select("row", "classes").mapInArrow(run, "row long, model double")

    rest = rows.select("row", F.inline(F.arrays_zip("rest", "times"))).withColumnRenamed("rest", "token")
    found = rest.join(counts.select("token", "n"), "token")
    sums = found.groupBy("row").agg(F.sum("times").alias("known_rest"), F.sum(F.col("times") * F.log10(F.col("n") + 1.0)).alias("logs_rest"))
    out = (rows.select("row", "doc_id", "held_out", "n_tokens", "known_head", "logs_head")
           .join(scored, "row").join(sums, "row", "left"))
    logs = F.col("logs_head") + F.coalesce("logs_rest", F.lit(0.0)) + F.lit(math.log10(n_end + 1))
    return out.select(
        "doc_id", "held_out", "n_tokens",
        (F.col("known_head") + F.coalesce("known_rest", F.lit(0)) + int(n_end > 0)).alias("n_known"),
        F.lit(n_all).cast("long").alias("train_tokens"),
        (logs - F.col("n_tokens") * math.log10(n_all + v_all + 1)).alias("base_score"),
        (logs + F.col("model")).alias("score"))


@llm_query("op3_hidden_markov_scoring")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents, learning from all but one fold of seven."""
    return score_documents(table(spark, sf_dir, "documents"))
