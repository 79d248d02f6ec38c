"""Token counts of every prefix of a text, by dynamic programming over the prefixes.

For a byte-level merge tokenizer the tokens of a prefix end in one token whose
removal leaves the tokens of a shorter prefix: the token that ends there in the
vocabulary and stands unmerged beside the last token of that shorter prefix. So
count(p) = count(p - length) + 1, the last token of every prefix is kept, and no
prefix is encoded anew. The counts of all character prefixes of a document are
stored as differences, a byte a character; the whole text's count, the count at
any place and the longest prefix within a budget are then read from the store.

A text falls into segments, white space and the run or word after it. Segments do not
influence each other's tokens, so a worker keeps the differences of those it has
met (two generations, bounded), and the words that are new in a batch are worked
side by side, one place after the other. Inside a segment the library's own splitting
rules and special strings are followed for every prefix: white space that ends
a prefix is one piece, an unfinished contraction two, and the last character of
a special string turns it into one token.

Defined cases: null and empty texts have no prefix and count 0; null ids, ties
and repeated rows stay rows of their own in input order; a text of any length is
one row, worked in windows; an empty table gives no rows. Other columns are not read.
"""

from __future__ import annotations

import functools
import itertools
import json
import math
import os
import re
import struct
import unicodedata
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loadsplit.session import scratch_path

from .common import Recent, arrow_rows, by_bytes

LIMIT = 512
BATCH_BYTES = 2 << 20
WINDOW_CHARS = 1 << 20      # a long text is worked in windows of about so many characters
KEPT_SEGMENTS = 400_000     # of one generation; half, and a batch's new ones, are filled
KEPT_CHARS = 64             # longer segments are not kept
KEPT_PAIRS = 500_000
WORDS_AT_ONCE = 8192
ARROW_ROWS = 1_000
FAR = -128                  # a difference that needs more than a byte: this, then four bytes

#: fixed rule: how byte-level vocabularies write bytes; printable ones are themselves, the others follow at 256
_PRINTABLE = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
_BYTE_OF = {chr(b): b for b in _PRINTABLE} | {chr(256 + k): b for k, b in enumerate(b for b in range(256) if b not in set(_PRINTABLE))}


_LETTER = "[A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff]"
_WORD = re.compile(f" ?{_LETTER}+")


class PrefixCounter:
    """Counts of all prefixes by a byte-level merge tokenizer's file."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        pre, model, added = spec["pre_tokenizer"] or {}, spec["model"], spec["added_tokens"]
        raw = lambda token: bytes(_BYTE_OF[c] for c in token)
        merges = [tuple(map(raw, m.split(" ") if isinstance(m, str) else m)) for m in model["merges"]]
        self.ranks = {m: k for k, m in enumerate(merges)}
        self.made = {a + b: (a, b, k) for k, (a, b) in enumerate(merges)}  # the merge that makes a token
        rank = lambda t: self.made[t][2] if t in self.made else -1
        if model["type"] != "BPE" or pre.get("type") != "ByteLevel" or pre["add_prefix_space"] or not pre["use_regex"] or spec["normalizer"] \
                or any(model.get(k) for k in ("dropout", "continuing_subword_prefix", "end_of_word_suffix", "byte_fallback", "ignore_merges")) \
                or any(a[k] for a in added for k in ("single_word", "lstrip", "rstrip", "normalized")) \
                or len(self.made) < len(merges) or any(max(rank(a), rank(b)) >= k for k, (a, b) in enumerate(merges)):
            raise ValueError(f"not a plain byte-level merge tokenizer: {path}")
        self.vocabulary = {*self.made, *(bytes([b]) for b in range(256))}
        self.starts = {t[:i] for t in self.vocabulary for i in range(len(t) + 1)}
        self.split = Tokenizer.from_file(path).pre_tokenizer.pre_tokenize_str
        self.special = re.compile("|".join(sorted(map(re.escape, (a["content"] for a in added)), key=len, reverse=True)) or r"(?!)")
        space = "".join(re.escape(c) for c in map(chr, range(0x3001)) if self._is_space(c))
        self.segments = re.compile(f"[{space}]*[^{space}]+|[{space}]+")
        # without special strings a segment can also end where a run of letters surely does
        self.words = re.compile(f"[{space}]*{_LETTER}+(?=[\0-@\\[-`{{-\x7f]|\\Z)|{self.segments.pattern}")
        self.space = re.compile(f"[{space}]*")
        self.cut = re.compile(f"(?<=[^{space}])(?=[{space}])")
        self.root = _State(self, b"")
        self.states = {b"": self.root}
        self.apart = Recent(self._apart, KEPT_PAIRS)
        self.side = _SideBySide(self)
        self.known = Recent(self._segment, KEPT_SEGMENTS, lambda s: len(s) <= KEPT_CHARS)

    def _is_space(self, c: str) -> bool:
        """White space to the library's splitting: in no run with a letter, a digit or a mark after it."""
        return unicodedata.category(c)[0] in "ZC" and (c == " " or all(len(self.split(c + x)) == 2 for x in "a1!"))

    # --- the merge rule ---------------------------------------------------------------

    def _edge(self, token: bytes, side: int) -> list[tuple[bytes, float]]:
        """The symbols that stand at the right (1) or left (0) end of a token while it is
        merged, each with the rank of the merge that takes it up."""
        found, until = [], math.inf
        while True:
            found.append((token, until))
            if token not in self.made:
                return found
            until, token = self.made[token][2], self.made[token][side]

    def _apart(self, pair: tuple[bytes, bytes]) -> bool:
        """Whether two tokens that meet stay as they are: no two symbols stand at the
        seam at a time when they would merge. With an empty first token: whether
        the second is what the merges make of its own bytes."""
        left, right = pair
        if left:
            return not any(q < a_until and q <= b_until for a, a_until in self._edge(left, 1) for b, b_until in self._edge(right, 0)
                           if (q := self.ranks.get((a, b))) is not None)
        if right not in self.made:
            return True
        a, b, rank = self.made[right]
        return self.apart[b"", a] and self.apart[b"", b] and not any(
            q < min(x_until, rank) and q <= y_until for x, x_until in self._edge(a, 1) for y, y_until in self._edge(b, 0)
            if (q := self.ranks.get((x, y))) is not None)

    def _next(self, state: bytes, byte: int) -> tuple[_State, list[tuple[bytes, int]]]:
        """From the longest start of a token that ends at a place, and the next byte: the
        same for the next place, and the tokens that end there with their lengths,
        longest first."""
        name = state + bytes([byte])
        while name not in self.starts:
            name = name[1:]
        found = self.states.setdefault(name, _State(self, name))
        return found, [(t, len(t)) for i in range(len(name)) if (t := name[i:]) in self.vocabulary and self.apart[b"", t]]

    def _extend(self, piece: bytes, counts: list[int], last: list[bytes], states: list[_State]) -> None:
        """Go on from the prefix of the piece that the lists hold: tokens, last token and
        state of every prefix, by length."""
        apart, state, p = self.apart, states[-1], len(counts)
        for byte in piece[p - 1:]:
            state, ends = state[byte]
            states.append(state)
            for t, n in ends:
                if n == p or apart[last[p - n], t]:
                    counts.append(counts[p - n] + 1)
                    last.append(t)
                    break
            p += 1

    def _piece(self, piece: bytes) -> list[int]:
        """Token counts of the prefixes of a piece, by length in bytes."""
        counts = [0]
        self._extend(piece, counts, [b""], [self.root])
        return counts

    def learn(self, segments: set[str]) -> None:
        """Work the words that are not remembered; other segments are worked when they are met."""
        known, old, whole, new = self.known, self.known.old, _WORD.fullmatch, []
        if len(known) >= KEPT_SEGMENTS // 2:  # not while the batch is put together
            known.turn()
            old = known.old
        for s in segments:
            if s not in known:
                steps = old.get(s)
                if steps is not None:
                    known[s] = steps
                elif len(s) <= KEPT_CHARS and whole(s):
                    new.append((s, s.encode()))
        new.sort(key=lambda x: -len(x[1]))
        for at in range(0, len(new), WORDS_AT_ONCE):
            part = new[at:at + WORDS_AT_ONCE]
            known.update(zip([s for s, _ in part], self.side.steps([piece for _, piece in part])))

    def _chars(self, piece: str) -> list[int]:
        """Token counts of the character prefixes of a piece, the empty one left out."""
        counts = self._piece(piece.encode())
        return counts[1:] if piece.isascii() else _at_chars(piece, counts)

    # --- segments ---------------------------------------------------------------------

    def _plain(self, s: str) -> list[int]:
        """Counts of the character prefixes of a segment in which no special string is complete."""
        if _WORD.fullmatch(s):  # one piece
            return self._chars(s)
        blank = self.space.match(s).end()
        counts = self._chars(s[:blank])
        base = 0
        for _, (a, b) in self.split(s):
            piece = s[a:b]
            got = self._chars(piece)
            if piece[0] == "'" and b - a == 3 and piece[1:].isalpha():  # a contraction
                got[1] = sum(self._chars(piece[x:y])[-1] for _, (x, y) in self.split(piece[:2]))
            counts += [base + n for n in got[max(len(counts) - a, 0):]]
            base += got[-1]
        return counts

    def _counts(self, s: str) -> list[int]:
        found = self.special.search(s)
        if not found:
            return self._plain(s)
        a, b = found.span()
        head = self._plain(s[:b])[:b - 1]
        here = (head[a - 1] if a else 0) + 1
        return [*head, here, *(here + n for n in self._counts(s[b:]) if b < len(s))]

    def _segment(self, s: str) -> bytes:
        """Differences between the counts of neighbouring character prefixes."""
        counts = self._counts(s)
        return _pack([b - a for a, b in itertools.pairwise([0, *counts])])

    def segment(self, text: str) -> list[str]:
        return (self.segments if self.special.search(text) else self.words).findall(text)

    def steps(self, texts: list[str]) -> list[bytes]:
        """Of each text: count(k characters) - count(k - 1 characters) for every k, packed."""
        found = [b""] * len(texts)
        for piece in by_bytes([range(len(t)) for t in texts], WINDOW_CHARS):
            texts_ = texts[piece]
            if len(texts_[-1]) > 2 * WINDOW_CHARS:
                found[piece.stop - 1], texts_ = self._long(texts_[-1]), texts_[:-1]
            parts = [self.segment(t) for t in texts_]
            self.learn(set().union(*parts))
            for k, p in enumerate(parts):
                found[piece.start + k] = b"".join(map(self.known.__getitem__, p))
        return found

    def _long(self, text: str) -> bytes:
        """A long text in windows that end where a segment does."""
        cutter = self.segments if self.special.search(text) else self.words
        parts, at = [], 0
        while at < len(text):
            cut = self.cut.search(text, at + WINDOW_CHARS) if at + WINDOW_CHARS < len(text) else None
            end = cut.start() if cut else len(text)
            found = cutter.findall(text, at, end)
            self.learn(set(found))
            parts.append(b"".join(map(self.known.__getitem__, found)))
            at = end
        return b"".join(parts)

    def differences(self, text: str) -> np.ndarray:
        return unpack(self.steps([text])[0])


class _State(dict):
    """By next byte what ``_next`` says, made when first needed; there are as many as starts of tokens at most."""
    __slots__ = ("counter", "name")

    def __init__(self, counter: PrefixCounter, name: bytes):
        self.counter, self.name = counter, name

    def __missing__(self, byte: int) -> tuple[_State, list[bytes]]:
        value = self[byte] = self.counter._next(self.name, byte)
        return value


class _SideBySide:
    """The same recurrence for many pieces at once: arrays over pieces, place by place.
    Tokens are numbers, 0 is none; automaton states, and which pairs of tokens stay
    apart, are looked up in arrays that grow with what is met."""

    def __init__(self, counter: PrefixCounter):
        self.counter = counter
        self.token = {b"": 0} | {t: k for k, t in enumerate(sorted(counter.vocabulary), 1)}
        self.bytes = [*self.token]
        self.size = np.array([len(t) for t in self.bytes], np.int64)
        self.state, self.states = {b"": 0}, [counter.root]
        self.next = np.full((1024, 256), -1, np.int32)
        self.ends = np.zeros((1024, 4), np.int32)
        self._forget()

    def _forget(self) -> None:
        self.pairs, self.apart = np.empty(0, np.int64), np.empty(0, bool)

    def _go(self, state: np.ndarray, byte: np.ndarray) -> np.ndarray:
        found = self.next[state, byte]
        for key in np.unique(state[found < 0] * 256 + byte[found < 0]).tolist():
            after, ends = self.states[key >> 8][key & 255]
            number = self.state.setdefault(after.name, len(self.states))
            if number == len(self.states):
                self.states.append(after)
                if number >= len(self.next):
                    self.next = np.vstack([self.next, np.full_like(self.next, -1)])
                    self.ends = np.vstack([self.ends, np.zeros_like(self.ends)])
                if len(ends) >= self.ends.shape[1]:
                    self.ends = np.pad(self.ends, ((0, 0), (0, len(ends) + 1 - self.ends.shape[1])))
                self.ends[number, :len(ends)] = [self.token[t] for t, _ in ends]
            self.next[key >> 8, key & 255] = number
        return self.next[state, byte]

    def _stay(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Whether the tokens stay as they are where they meet."""
        keys = left * len(self.bytes) + right
        at = np.searchsorted(self.pairs, keys)
        missing = np.unique(keys[(at == self.pairs.size) | (self.pairs[np.minimum(at, self.pairs.size - 1)] != keys)] if self.pairs.size else keys)
        if missing.size:
            if self.pairs.size > KEPT_PAIRS:
                self._forget()
                return self._stay(left, right)
            own = [self.counter._apart((self.bytes[k // len(self.bytes)], self.bytes[k % len(self.bytes)])) for k in missing.tolist()]
            place = np.searchsorted(self.pairs, missing)
            self.pairs, self.apart = np.insert(self.pairs, place, missing), np.insert(self.apart, place, own)
            at = np.searchsorted(self.pairs, keys)
        return self.apart[at]

    def steps(self, pieces: list[bytes]) -> list[bytes]:
        """Packed differences of pieces in order of falling length."""
        most, size = len(pieces[0]), np.array([len(p) for p in pieces])
        text = np.frombuffer(b"".join(p.ljust(most, b"\0") for p in pieces), np.uint8).reshape(len(pieces), most).astype(np.int64)
        count, last = np.zeros((2, len(pieces), most + 1), np.int64)
        state = np.zeros(len(pieces), np.int64)
        for p in range(1, most + 1):
            todo = np.arange(np.searchsorted(-size, -p, "right"))
            state[todo] = self._go(state[todo], text[todo, p - 1])
            for k in itertools.count():
                token = self.ends[state[todo], k].astype(np.int64)
                before = p - self.size[token]
                left = last[todo, before]
                fits = before == 0
                fits[~fits] = self._stay(left[~fits], token[~fits])
                done = todo[fits]
                last[done, p], count[done, p] = token[fits], count[done, before[fits]] + 1
                todo = todo[~fits]
                if not todo.size:
                    break
        # places where a character ends, piece by piece
        inside = np.arange(1, most + 1) <= size[:, None]
        ends = inside & (np.pad(text[:, 1:], ((0, 0), (0, 1))) & 0xC0 != 0x80)
        ends |= np.arange(1, most + 1) == size[:, None]
        n = ends.sum(axis=1)
        values, cut = count[:, 1:][ends], np.cumsum(np.r_[0, n])
        step = np.diff(values, prepend=0)
        step[cut[:-1]] = values[cut[:-1]]
        raw = step.astype(np.int8).tobytes()
        if (np.abs(step) < -FAR).all():
            return [raw[a:b] for a, b in itertools.pairwise(cut.tolist())]
        return [_pack(step[a:b].tolist()) for a, b in itertools.pairwise(cut.tolist())]


def _at_chars(s: str, counts: list[int]) -> list[int]:
    """Of counts by length in bytes those at the ends of characters."""
    return [counts[n] for n in itertools.accumulate(len(c.encode()) for c in s)]


def _pack(values: list[int]) -> bytes:
    """A byte for each, or FAR and four bytes for one that does not fit."""
    if not values or FAR < min(values) and max(values) < 128:
        return bytes([v & 255 for v in values])
    return b"".join(struct.pack("b", v) if FAR < v < 128 else struct.pack("<bi", FAR, v) for v in values)


def unpack(packed: bytes) -> np.ndarray:
    """The differences as whole numbers."""
    values = np.frombuffer(packed, np.int8)
    if not (values == FAR).any():
        return values.astype(np.int64)
    out, at = [], 0
    while at < len(packed):
        far = values[at] == FAR
        out.append(struct.unpack_from("<i", packed, at + 1)[0] if far else int(values[at]))
        at += 5 if far else 1
    return np.array(out, np.int64)


_counters: dict[str, PrefixCounter] = {}


def _count_rows(batches: Iterator[pa.RecordBatch], path: str) -> Iterator[pa.RecordBatch]:
    if path not in _counters:
        _counters[path] = PrefixCounter(path)
    counter = _counters[path]
    for b in batches:
        n_bytes = pc.fill_null(pc.binary_length(b.column(1).cast(pa.binary())), 0).cast(pa.int64()).to_pylist()
        for piece in by_bytes([range(n) for n in n_bytes], BATCH_BYTES):
            texts = [t or "" for t in b.column(1)[piece.start:piece.stop].to_pylist()]
            packed = counter.steps(texts)
            totals = [int(np.frombuffer(p, np.int8).sum(dtype=np.int64)) if len(p) == len(t) else int(unpack(p).sum()) for p, t in zip(packed, texts)]
            yield pa.RecordBatch.from_arrays(
                [b.column(0)[piece.start:piece.stop], pa.array(n_bytes[piece], pa.int64()), pa.array([len(t) for t in texts], pa.int64()),
                 pa.array(totals, pa.int64()), pa.array(packed, pa.binary())],
                ["_id", "n_bytes", "n_chars", "n_tokens", "steps"])


# --- the store and its questions ------------------------------------------------------------

def prefix_counts(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document: id, n_bytes, n_chars, n_tokens (of the whole text) and ``steps``, the
    difference that each character makes to the count of the prefix it ends, packed."""
    rows = docs.select(F.col(f"`{id_col}`").alias("_id"), F.col(f"`{text_col}`").alias("_text"))
    schema = rows.select("_id").schema.add("n_bytes", "long").add("n_chars", "long").add("n_tokens", "long").add("steps", "binary")
    return rows.mapInArrow(functools.partial(_count_rows, path=tokenizer_path), schema).withColumnRenamed("_id", id_col)


def write_counts(docs: DataFrame, path: str, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text") -> None:
    """Store ``prefix_counts``; compressed, the steps take two or three bits a character."""
    with arrow_rows(docs.sparkSession, ARROW_ROWS):
        prefix_counts(docs, tokenizer_path, id_col, text_col).write.option("compression", "zstd").parquet(path)


def read_counts(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def _answers(batches: Iterator[pa.RecordBatch], name: str, answer: Callable[[np.ndarray, int], int]) -> Iterator[pa.RecordBatch]:
    """Rows with the answer to their ``_asked`` for ``steps``."""
    for b in batches:
        column = dict(zip(b.schema.names, b.columns))
        steps, asked = column.pop("steps").to_pylist(), column.pop("_asked").to_pylist()
        column[name] = pa.array([answer(unpack(s), n) for s, n in zip(steps, asked)], pa.int64())
        yield pa.RecordBatch.from_arrays([*column.values()], [*column])


def _answered(counts: DataFrame, asked: Column, name: str, answer: Callable[[np.ndarray, int], int]) -> DataFrame:
    schema = T.StructType([f for f in counts.schema if f.name != "steps"]).add(name, "long")
    return counts.withColumn("_asked", asked.cast("long")).mapInArrow(functools.partial(_answers, name=name, answer=answer), schema)


def _prefix(steps: np.ndarray, n_chars: int) -> int:
    return int(steps[:max(n_chars, 0)].sum())


def _longest(steps: np.ndarray, limit: int) -> int:
    within = np.flatnonzero(np.cumsum(steps) <= limit)
    return int(within[-1]) + 1 if within.size else 0


def tokens_at(counts: DataFrame, n_chars: Column) -> DataFrame:
    """``counts`` with ``tokens_at``, the tokens of the first ``n_chars`` characters, for ``steps``."""
    return _answered(counts, n_chars, "tokens_at", _prefix)


def fit_budget(counts: DataFrame, limit: Column | int = LIMIT) -> DataFrame:
    """``counts`` with ``fit_chars``, the characters of the longest prefix of at most
    ``limit`` tokens, for ``steps``. A longer prefix can have fewer tokens than a
    shorter one, so all prefixes are looked at."""
    return _answered(counts, F.lit(limit), "fit_chars", _longest)


def count_tokens(docs: DataFrame, tokenizer_path: str, limit: int = LIMIT, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Store the prefix counts of all documents, then answer from the store:
    id, n_bytes, n_chars, n_tokens, fit_chars and whether the text is over the limit."""
    spark, path = docs.sparkSession, scratch_path(docs.sparkSession, "prefix-counts")
    write_counts(docs, path, tokenizer_path, id_col, text_col)
    return fit_budget(read_counts(spark, path), limit).withColumn("over_limit", F.col("n_tokens") > limit)
