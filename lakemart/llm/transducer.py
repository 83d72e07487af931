"""Operator 8: token counts by a compiled finite-state tokenizer.

The tokenizer (pre-token pattern and byte pairs with word ends) is compiled into a
deterministic transducer over the bytes of the normalised text; a transition carries the
number of tokens it adds to the count of the prefix read so far (it may be negative, when a
merge joins what were separate tokens). States and transitions are made when first met.

Why this is finite: the tokens of a prefix end in the one vocabulary entry ``t`` that
can follow the last token before it (``encode(last + t) == [last, t]``), so
they follow from the last token at each place where an entry that is still
incomplete may have begun. A state holds these places (as the characters read since), the
last token at each and its count relative to the current one, and what the word would count if
it ended here, since the last byte of a word is a symbol of its own.

A text is cut between characters in chunks of about ``LANE`` bytes that are read side by side,
one byte of each at a time. A chunk maps the state it is entered in to the state it is left in
and a count. White space resets the transducer, so a chunk with white space is left in a state
that does not depend on its entry: all tails run first, and heads last. A chunk without white space has
a map of a few states: those its predecessor may be left in, begun with the start state and
completed by reading on until no state is new. The maps are composed with one another in
a prefix scan of logarithmic depth, which gives every chunk's true entry. A state holds what follows
from a bounded suffix, so the maps stay small; where they do not after ``SPECULATIVE`` rounds,
only the states on true paths are read on, one chunk of each path a round. Counts add up by text.
"""

from __future__ import annotations

import json
import re
import unicodedata

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakemart.llm.common import llm_query, table
from lakemart.llm.pretokens import LETTER, NUMBER, OTHER, SPACE, char_classes

LANE = 512
SPECULATIVE = 16
BATCH_BYTES = 1 << 20
MOST_STATES = 250_000  # the tables start anew beyond them
END, SPECIAL = 0xFF, 0xFE  # bytes that UTF-8 has not: end of a text, a special token

#: What a file must say of normalising and splitting, as ``Transducer`` does just this (fixed values).
NORMALIZER = {"type": "Sequence", "normalizers": [
    {"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "}, {"type": "Lowercase"}]}
PRE_TOKENIZER = {"type": "Sequence", "pretokenizers": [
    {"type": "Split", "pattern": {"Regex": r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"},
     "behavior": "Removed", "invert": True},
    {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False}]}
OFF = ("dropout", "unk_token", "continuing_subword_prefix", "fuse_unk", "byte_fallback", "ignore_merges")


def check_rules(spec: dict) -> None:
    """Refuse a tokenizer file whose rules are not the compiled ones: its counts would be wrong."""
    model = spec["model"]
    other = [n for n, want in (("normalizer", NORMALIZER), ("pre_tokenizer", PRE_TOKENIZER)) if spec.get(n) != want]
    other += [f"model.{n}" for n in OFF if model.get(n)]
    if model.get("type") != "BPE" or not model.get("end_of_word_suffix"):
        other.append("model.type or model.end_of_word_suffix")
    if any(t.get(n) for t in spec["added_tokens"] for n in ("single_word", "lstrip", "rstrip", "normalized")):
        other.append("added_tokens")
    if other:
        raise ValueError("not a tokenizer that the transducer is compiled for: " + ", ".join(other))


class PairRules:
    """Byte pairs with word ends. A token is a string: chr(b) for a byte, chr(256 + b) for a byte that ends a word."""

    def __init__(self, path: str):
        spec = json.load(open(path, encoding="utf-8"))
        check_rules(spec)
        model = spec["model"]
        kept = [*range(33, 127), *range(161, 173), *range(174, 256)]  # bytes that stand for themselves (fixed values)
        byte_of = {chr(b): b for b in kept}
        byte_of |= {chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in set(kept))}
        suffix = model["end_of_word_suffix"]

        def own(token: str) -> str:
            ends = len(token) > len(suffix) and token.endswith(suffix)
            values = [byte_of[c] for c in (token[:-len(suffix)] if ends else token)]
            return "".join(map(chr, values[:-1])) + chr(values[-1] + 256 * ends)

        self.rank = {}
        for i, pair in enumerate(model["merges"]):
            a, b = pair.split(" ") if isinstance(pair, str) else pair
            self.rank[own(a), own(b)] = i
        self.special = [t["content"] for t in spec["added_tokens"]]
        added = set(self.special)
        self.vocabulary = {own(t) for t in model["vocab"] if t not in added}
        self.begun = {t[:n] for t in self.vocabulary for n in range(1, len(t))}
        self._follows: dict[tuple[str, str], bool] = {}

    def encode(self, symbols: str) -> list[str]:
        parts = list(symbols)
        while len(parts) > 1:
            rank, i = min((self.rank.get(p, 1 << 30), i) for i, p in enumerate(zip(parts, parts[1:], strict=False)))
            if rank == 1 << 30:
                break
            parts[i:i + 2] = [parts[i] + parts[i + 1]]
        return parts

    def follows(self, last: str, token: str) -> bool:
        """Whether ``token`` can come right after ``last`` ("": at a word's begin)."""
        found = self._follows.get((last, token))
        if found is None:
            if len(self._follows) > 1_000_000:
                self._follows.clear()
            found = self._follows[last, token] = self.encode(last + token) == ([last, token] if last else [token])
        return found


#: A word's state: places (characters since, last token there, count there less count here), and the count less the one here if the word ended now.
WORD_START = ((("", "", 0),), 0)


class Transducer:
    """States and transitions of a tokenizer, made when met."""

    def __init__(self, path: str):
        self.rules = PairRules(path)
        self.kinds = char_classes()
        self.columns = np.full(256, -1, np.int16)
        self.width = 0
        self.special = re.compile("|".join(map(re.escape, self.rules.special))) if self.rules.special else None
        self.special_begins = {t[0] for t in self.rules.special}
        self._steps: dict = {}
        self.clear()

    def clear(self) -> None:
        self._steps.clear()
        self.keys: list[tuple] = []
        self.number: dict[tuple, int] = {}
        self.next = np.full((1024, max(64, self.width)), -1, np.int32)
        self.adds = np.zeros(self.next.shape, np.int8)
        self.start = self.intern(("start",))

    def intern(self, key: tuple) -> int:
        n = self.number.get(key)
        if n is None:
            n = self.number[key] = len(self.keys)
            self.keys.append(key)
            if n == len(self.next):
                more = ((0, n // 2), (0, 0))
                self.next = np.pad(self.next, more, constant_values=-1)
                self.adds = np.pad(self.adds, more)
        return n

    def column(self, data: np.ndarray) -> np.ndarray:
        """Table columns of bytes; a byte gets one when first met."""
        for b in np.flatnonzero(np.bincount(data, minlength=256)):
            if self.columns[b] < 0:
                self.columns[b] = self.width
                self.width += 1
                if self.width > self.next.shape[1]:
                    more = ((0, 0), (0, self.next.shape[1]))
                    self.next = np.pad(self.next, more, constant_values=-1)
                    self.adds = np.pad(self.adds, more)
        return self.columns[data].astype(np.int32)

    # ---- one word

    def _last(self, places: tuple, symbol: str) -> tuple[str, int]:
        for since, last, count in places:
            token = since + symbol
            if token in self.rules.vocabulary and self.rules.follows(last, token):
                return token, count + 1
        raise ValueError(f"no token ends in {symbol!r}")

    def word_byte(self, state: tuple, byte: int) -> tuple[tuple, int]:
        """State and count added when the word goes on by a byte."""
        found = self._steps.get((state, byte))
        if found is None:
            places = state[0]
            token, add = self._last(places, chr(byte))
            _, ended = self._last(places, chr(byte + 256))
            after = [(since + chr(byte), last, count - add) for since, last, count in places
                     if since + chr(byte) in self.rules.begun]
            if len(self._steps) > 50_000:
                self._steps.clear()
            found = self._steps[state, byte] = ((*after, ("", token, 0)), ended - add), add
        return found

    def word_char(self, state: tuple, char: str) -> tuple[tuple, int]:
        total = 0
        for b in char.encode():
            state, add = self.word_byte(state, b)
            total += add
        return state, total

    def word(self, text: str) -> int:
        state, total = WORD_START, 0
        for c in text:
            state, add = self.word_char(state, c)
            total += add
        return total + state[1]

    # ---- the pattern around words

    def char(self, key: tuple, char: str) -> tuple[tuple, int]:
        """Next state and count added on a character: the pattern's words are contractions at a
        word's begin, runs of letters, single numbers and runs of other signs."""
        mode = key[0]
        if mode == "quote":  # a quote that began a word: perhaps a contraction
            if len(key) == 1:
                if char in "stmd":
                    return ("start",), self.word("'" + char) - self.word_char(WORD_START, "'")[1]
                if char in "rvl":
                    return ("quote", char), 0
            elif char == ("l" if key[1] == "l" else "e"):
                return ("start",), self.word("'" + key[1] + char) - self.word_char(WORD_START, "'")[1]
            key, add = self.settle(key)
            after, more = self.char(key, char)
            return after, add + more
        kind = int(self.kinds[ord(char)])
        if mode == "letters" and kind == LETTER or mode == "signs" and kind == OTHER:
            state, add = self.word_char(key[1], char)
            return (mode, state), add
        before = 0 if mode == "start" else key[1][1]
        if kind == SPACE:
            return ("start",), before
        if kind == NUMBER:
            return ("start",), before + self.word(char)
        state, add = self.word_char(WORD_START, char)
        if char == "'":
            return ("quote",), before + add
        return ("letters" if kind == LETTER else "signs", state), before + add

    def settle(self, key: tuple) -> tuple[tuple, int]:
        """The same place when the quote is known not to begin a contraction."""
        quote = self.word_char(WORD_START, "'")[0]
        if len(key) == 1:
            return ("signs", quote), 0
        state, add = self.word_char(WORD_START, key[1])
        return ("letters", state), quote[1] + add

    def step(self, key: tuple, byte: int) -> tuple[tuple, int]:
        """On a byte: a character counts when its last byte is read."""
        if byte in (END, SPECIAL):
            add = 0
            if key[0] == "quote":
                key, add = self.settle(key)
            return ("start",), add + (0 if key[0] == "start" else key[1][1]) + (byte == SPECIAL)
        if key[0] == "bytes":
            key, read = key[1], key[2] + bytes([byte])
        else:
            read = bytes([byte])
        need = 1 if read[0] < 0x80 else 2 if read[0] < 0xE0 else 3 if read[0] < 0xF0 else 4
        return (("bytes", key, read), 0) if len(read) < need else self.char(key, read.decode())

    def run(self, states: np.ndarray, begin: np.ndarray, length: np.ndarray, data: np.ndarray,
            columns: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Read ``length`` bytes from ``begin`` in each lane; states after, counts added."""
        order = np.argsort(-length, kind="stable")
        at, left, now = begin[order], length[order], states[order].copy()
        counts = np.zeros(len(now), np.int32)
        live = np.searchsorted(-left, -np.arange(1, (int(left[0]) if len(left) else 0) + 1), side="right")
        for k, n in enumerate(live.tolist()):
            place = at[:n] + k
            column, own = columns[place], now[:n]
            after = self.next[own, column]
            if after.min() < 0:
                for i in np.flatnonzero(after < 0).tolist():
                    s, c = int(own[i]), int(column[i])
                    if self.next[s, c] < 0:
                        key, add = self.step(self.keys[s], int(data[place[i]]))
                        to = self.intern(key)
                        self.next[s, c], self.adds[s, c] = to, add
                after = self.next[own, column]
            counts[:n] += self.adds[own, column]
            now[:n] = after
        out, total = np.empty_like(now), np.empty_like(counts)
        out[order], total[order] = now, counts
        return out, total

    def scan(self, entry: np.ndarray, begin: np.ndarray, length: np.ndarray, data: np.ndarray,
             columns: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Exit states and counts of chunks without white space. ``entry`` is the state before each, -1 where
        the chunk before is of this kind, too, and the one before in these arrays."""
        first = entry >= 0
        follows = np.append(~first[1:], False)
        # the maps: chunk and entry state as one key, ascending, exit state, count
        key, out, add = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)
        new = (np.arange(len(entry), dtype=np.int64) << 32) + np.where(first, entry, self.start)
        rounds = 0
        while True:
            chunk = new >> 32
            left, more = self.run((new & 0xFFFFFFFF).astype(np.int32), begin[chunk], length[chunk], data, columns)
            key, out, add = np.append(key, new), np.append(out, left), np.append(add, more)
            order = np.argsort(key)
            key, out, add = key[order], out[order], add[order]
            chunk = key >> 32
            goes_on = follows[chunk]
            wanted = ((chunk + 1) << 32) + out
            end = len(key)
            to = np.minimum(np.searchsorted(key, wanted), end - 1)
            there = goes_on & (key[to] == wanted)
            true = self._on_paths(np.where(there, to, end), np.searchsorted(key, (np.flatnonzero(first) << 32) + entry[first]))
            unknown = goes_on & ~there
            if not (unknown & true).any():
                return out[true].astype(np.int32), add[true]
            rounds += 1
            new = np.unique(wanted[unknown if rounds < SPECULATIVE else unknown & true])

    @staticmethod
    def _on_paths(to: np.ndarray, begins: np.ndarray) -> np.ndarray:
        """Which entries are met from ``begins`` on, each followed by that at ``to`` (their number: by none). ``to`` is
        composed with itself, so it leads one, two, four ... chunks on, and each time as many more are met."""
        end = len(to)
        to, met = np.append(to, end), np.zeros(end + 1, bool)
        met[begins] = True
        while (to < end).any():
            met[to[met]] = True
            to = to[to]
        return met[:end]

    def count(self, texts: list[bytes]) -> np.ndarray:
        """Tokens of each normalised text (which ends in END)."""
        if len(self.keys) > MOST_STATES:
            self.clear()
        data = np.frombuffer(b"".join(texts), np.uint8)
        sizes = np.fromiter(map(len, texts), np.int64, len(texts))
        columns = self.column(data)
        lanes = -(-sizes // LANE)
        text = np.repeat(np.arange(len(texts)), lanes)
        first = np.cumsum(lanes) - lanes
        nth = np.arange(len(text)) - np.repeat(first, lanes)
        begin = np.repeat(np.cumsum(sizes) - sizes, lanes) + nth * LANE
        for _ in range(3):  # to the next character
            begin += (data[begin] & 0xC0) == 0x80
        length = np.diff(begin, append=len(data))
        # the head of a chunk ends with its first ASCII white space; the tail is read from the start state
        spaces = np.flatnonzero(np.isin(data, [9, 10, 11, 12, 13, 32]))
        found = np.searchsorted(spaces, begin)
        reset = np.append(spaces, 1 << 62)[found] + 1
        known = reset < begin + length  # a tail is there
        head = np.where(known, reset - begin, length)
        head[nth == 0] = 0  # a text begins in the start state
        body = np.where(nth == 0, begin, begin + head)
        ready = known | (nth == 0)
        states = np.full(len(text), -1, np.int32)
        counts = np.zeros(len(text), np.int64)
        tails = np.flatnonzero(ready)
        states[tails], counts[tails] = self.run(np.full(len(tails), self.start, np.int32), body[tails],
                                                (begin + length - body)[tails], data, columns)
        open_chunks = np.flatnonzero(~ready)
        if len(open_chunks):
            states[open_chunks], counts[open_chunks] = self.scan(
                states[open_chunks - 1], begin[open_chunks], length[open_chunks], data, columns)
        heads = np.flatnonzero(known & (nth > 0))
        counts[heads] += self.run(states[heads - 1], begin[heads], head[heads], data, columns)[1]
        return np.bincount(text, counts, len(texts)).astype(np.int64)

    def normalised(self, text: str) -> bytes:
        """Special strings apart, then composed and lower-cased character by character."""
        if any(c in text for c in self.special_begins):
            parts = self.special.split(text)
            if len(parts) > 1:
                return bytes([SPECIAL]).join(map(_lowered, parts)) + bytes([END])
        return _lowered(text) + bytes([END])


def _lowered(text: str) -> bytes:
    if not text.isascii():
        text = unicodedata.normalize("NFC", text)
        if "Σ" in text:  # lower() takes a sigma's neighbours into account, the tokenizer does not
            text = text.replace("Σ", "σ")
    return text.lower().encode()


_made: dict[str, Transducer] = {}


def token_counts(docs: DataFrame, vocabulary: str | None = None, limit: int = 2048) -> DataFrame:
    """``doc_id, n_bytes, n_tokens, over_limit`` for each row of ``docs(doc_id, text)``.

    ``vocabulary`` is the tokenizer's JSON file, at the same path on every machine. A null
    text counts as empty: no bytes, no tokens. Rows that repeat a doc_id, or have none,
    are counted like any other. An empty table gives an empty result; other columns are
    ignored."""
    if vocabulary is None:
        import public_tokenizers
        vocabulary = public_tokenizers.path("word_bpe_49k.json")

    def run(batches):
        if vocabulary not in _made:
            _made[vocabulary] = Transducer(vocabulary)
        made = _made[vocabulary]
        for batch in batches:
            column, counts, held, size = batch.column("text"), [], [], 0
            for text in column:
                held.append(made.normalised(text.as_py() or ""))
                size += len(held[-1])
                if size > BATCH_BYTES:
                    counts.append(made.count(held))
                    held, size = [], 0
            if held:
                counts.append(made.count(held))
            n = np.concatenate(counts) if counts else np.zeros(0, np.int64)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("n_bytes"), pa.array(n), pa.array(n > limit)],
                ["doc_id", "n_bytes", "n_tokens", "over_limit"])
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.select("doc_id", F.octet_length(text).cast("long").alias("n_bytes"), text.alias("text"))
    kind = docs.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"doc_id {kind}, n_bytes long, n_tokens long, over_limit boolean")


@llm_query("op8_transducer_token_counts")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents, word_bpe_49k.json, limit 2048."""
    return token_counts(table(spark, sf_dir, "documents"))
