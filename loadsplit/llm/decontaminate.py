"""Benchmark decontamination by Wu-Manber multi-pattern search over words:
block shift tables skip impossible positions, suffix-hash buckets select the
test strings, and direct comparison confirms occurrences.

The alphabet is the word. Patterns are all 13-word windows of the benchmark
items (an item of fewer words is one window); those of one length share a
shift table, which is an array indexed by the hash of three words. A block is the
last three words of a window: if a document's block stands nowhere in a pattern,
the search moves on by eleven words at once. Documents are not shuffled to be
searched: the patterns go to them.

Benchmark items are broadcast in blocks of about ``block_words`` words; longer
items are cut into pieces that overlap by a window. A pattern is a place in the
block's text, so the tables of a full block take some 60 bytes a word. One pass
over the documents searches ``PASS_BLOCKS`` blocks, one after the other; the hits
of a pass are staged and its broadcast destroyed before the next is made, so what
the driver, a task and a worker hold does not grow with the benchmark. The
staged hits are merged by row at the end. A benchmark of one pass needs no
staging of documents.

Defined cases: null or empty texts and items have no words; a document without
words is not contaminated; items with the same id count once; a null item id
counts as the string ``null``; repeated rows and null ids keep their rows;
empty tables are allowed on either side. Other input columns are carried by
``drop_contaminated`` and otherwise not read.
"""

from __future__ import annotations

import hashlib
import uuid
from collections import defaultdict
from collections.abc import Iterable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stage, utf8

WINDOW = 13
BLOCK = 3
BLOCK_WORDS = 500_000
PASS_BLOCKS = 4
_MIX = np.uint64(0x9E3779B97F4A7C15)

#: word bytes keep their (lower-cased) value, all others become a space
_WORDS = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256))


def split_words(text: bytes) -> list[bytes]:
    """Words ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` of the lower-cased text; on UTF-8
    bytes this is the same class, as every other code point has high bytes only."""
    return text.translate(_WORDS).split()


def _hashes(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(hash, words), np.int64, len(words)).view(np.uint64)


def _stretches(hashes: np.ndarray, size: int) -> np.ndarray:
    """Hash of the ``size`` words from every word on."""
    n = max(hashes.size - size + 1, 0)
    mixed = np.zeros(n, np.uint64)
    for k in range(size):
        mixed = (mixed ^ hashes[k:k + n]) * _MIX
        mixed ^= mixed >> np.uint64(29)
    return mixed


class WuManber:
    """The windows of one length over the words of a benchmark block. A pattern is
    the number of its first word; ``owner`` has the item of every word."""

    def __init__(self, length: int, starts: np.ndarray, hashes: np.ndarray, text: bytes, offsets: np.ndarray, owner: np.ndarray):
        self.m, self.b = length, min(BLOCK, length)
        self.text, self.offsets = text, offsets
        blocks = _stretches(hashes, self.b)
        default = length - self.b + 1
        size = max(10, int(8 * starts.size).bit_length())
        self.bits = np.uint64(64 - size)
        self.shift = np.full(1 << size, default, np.uint8 if default < 256 else np.int64)
        for end in range(self.b, length + 1):  # from the largest shift down to 0
            self.shift[blocks[starts + end - self.b] >> self.bits] = length - end
        # the patterns by suffix hash, equal ones together, each with its items
        suffix, whole = blocks[starts + length - self.b], _stretches(hashes, length)[starts]
        while True:
            order = np.lexsort((owner[starts], whole, suffix))
            again = np.r_[False, (suffix[order[1:]] == suffix[order[:-1]]) & (whole[order[1:]] == whole[order[:-1]])]
            other = [k for k in np.flatnonzero(again).tolist() if self._pattern(starts[order[k]]) != self._pattern(starts[order[k - 1]])]
            if not other:
                break
            whole[order[other]] += np.uint64(1)  # different windows of one hash
        head = np.flatnonzero(~again)
        self.keys, self.place = suffix[order[head]], starts[order[head]].astype(np.int32)
        owners, group = owner[starts[order]], np.cumsum(~again)
        new = np.r_[True, (owners[1:] != owners[:-1]) | (group[1:] != group[:-1])]
        self.items = owners[new]
        self.first = np.searchsorted(group[new], np.arange(1, head.size + 2))

    def _pattern(self, start: int) -> bytes:
        return self.text[self.offsets[start]:self.offsets[start + self.m] - 1]

    def find(self, words: list[bytes], hashes: np.ndarray, known: dict[int, np.ndarray]) -> Iterator[tuple[int, np.ndarray]]:
        """(start, items) of every occurrence. ``known`` keeps the text's block hashes by block size."""
        m, b, n = self.m, self.b, len(words)
        if n < m:
            return
        if b not in known:
            known[b] = _stretches(hashes, b)
        blocks = known[b]
        skip = self.shift[blocks >> self.bits]
        skip = skip.tobytes() if skip.dtype == np.uint8 else skip.tolist()
        end = m - b
        last = n - b
        while end <= last:
            s = skip[end]
            if s:
                end += s
                continue
            key = blocks[end]
            k = int(np.searchsorted(self.keys, key))
            if k < self.keys.size and self.keys[k] == key:
                start = end + b - m
                window = b" ".join(words[start:start + m])
                while k < self.keys.size and self.keys[k] == key:
                    if self._pattern(self.place[k]) == window:
                        yield start, self.items[self.first[k]:self.first[k + 1]]
                    k += 1
            end += 1


class Block:
    """Tables of a benchmark block: one for each window length."""

    def __init__(self, items: Iterable[tuple[str, bytes]], window: int = WINDOW):
        words, self.names, starts, owner = [], [], defaultdict(list), []
        for item, text in items:
            w = split_words(text)
            m = min(window, len(w))
            if m:
                starts[m].append(np.arange(len(words), len(words) + len(w) - m + 1))
                words += w
                owner += [len(self.names)] * len(w)
                self.names.append(item)
        hashes, offsets = _hashes(words), np.cumsum([0, *(len(w) + 1 for w in words)], dtype=np.int64)
        text, owner = b" ".join(words) + b" ", np.array(owner, np.int32)
        self.tables = [WuManber(m, np.concatenate(s), hashes, text, offsets, owner) for m, s in sorted(starts.items())]

    def find(self, words: list[bytes], hashes: np.ndarray, known: dict[int, np.ndarray] | None = None) -> tuple[list[int], set[str]]:
        """(start, end, ...) of what is found, and the items."""
        spans, found, known = [], set(), {} if known is None else known
        for t in self.tables:
            for start, items in t.find(words, hashes, known):
                spans += [start, start + t.m]
                found.update(items.tolist())
        return spans, {self.names[i] for i in found}


def _pieces(text: bytes, block_words: int, window: int) -> Iterator[tuple[int, bytes]]:
    """(words, text) of an item, cut where it is longer than a block; pieces overlap so
    that every window is whole in one."""
    words = split_words(text)
    for at in range(0, max(len(words) - window + 1, 1), block_words):
        piece = words[at:at + block_words + window - 1]
        yield len(piece), b" ".join(piece)


def _blocks(benchmark: DataFrame, id_col: str, text_col: str, block_words: int, window: int) -> tuple[DataFrame, list[tuple[int, int]]]:
    """The items (_item, _text, _part) staged, and the ranges of _part that make
    up the blocks. Tasks number their items into parts of about block_words
    words; the driver sees part totals only and puts neighbouring parts together."""
    rows = benchmark.select(F.coalesce(F.col(f"`{id_col}`").cast("string"), F.lit("null")).alias("_item"),
                            F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("_text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, held = TaskContext.get().partitionId() << 32, 0
        for batch in batches:
            names, texts, parts, sizes = [], [], [], []
            for item, text in zip(batch.column(0).to_pylist(), utf8(batch.column(1))):
                for size, piece in _pieces(text, block_words, window):
                    if held and held + size > block_words:
                        part, held = part + 1, 0
                    held += size
                    for column, value in ((names, item), (texts, piece), (parts, part), (sizes, size)):
                        column.append(value)
            yield pa.RecordBatch.from_arrays([pa.array(names, pa.string()), pa.array(texts, pa.binary()).cast(pa.string()), pa.array(parts, pa.int64()),
                                              pa.array(sizes, pa.int64())], ["_item", "_text", "_part", "_size"])

    items = stage(rows.mapInArrow(run, rows.select("*").schema.add("_part", "long").add("_size", "long")), "decontaminate-items")
    blocks, held = [], 0
    for part, size in items.groupBy("_part").agg(F.sum("_size")).orderBy("_part").toLocalIterator():
        if blocks and held + size <= block_words:
            blocks[-1], held = (blocks[-1][0], part), held + size
        else:
            blocks.append((part, part))
            held = size
    return items, blocks


def _send(items: DataFrame, blocks: list[tuple[int, int]]):
    """The (id, text) of each of some blocks, broadcast."""
    found = [items.where(F.col("_part").between(*k)).select("_item", "_text").collect() for k in blocks]
    return items.sparkSession.sparkContext.broadcast([[(i, t.encode()) for i, t in rows] for rows in found])


_built: dict[str, list[Block]] = {}


def _tables(sent, name: str, window: int) -> list[Block]:
    """The tables of broadcast blocks of that unique name, made once per worker."""
    if name not in _built:
        _built.clear()
        _built[name] = [Block(items, window) for items in sent.value]
    return _built[name]


def _digest(hits: list[list[int]], items: list[Iterable[str]]) -> list[pa.Array]:
    """Hit words (union of occurrences), items and their checksum per row."""
    n_hit = []
    for h in hits:
        covered, last = 0, 0
        for s, e in sorted(zip(h[::2], h[1::2])):
            covered += max(0, e - max(s, last))
            last = max(last, e)
        n_hit.append(covered)
    shas = [hashlib.sha256(",".join(sorted(i)).encode()).hexdigest() for i in items]
    return [pa.array(n_hit, pa.int64()), pa.array([len(i) for i in items], pa.int64()), pa.array(shas, pa.string())]


_DIGEST = ["_n_hit", "_n_items", "_sha"]


def _occurrences(batch: pa.Array, blocks: list[Block]) -> tuple[list[int], list[list[int]], list[set[str]]]:
    """Words, (start, end, ...) of what is found, and the items of each text."""
    n_words, hits, found = [], [], []
    for text in utf8(batch):
        words, spans, ids = split_words(text), [], set()
        hashes, known = _hashes(words), {}
        for block in blocks:
            own, items = block.find(words, hashes, known)
            spans += own
            ids |= items
        n_words.append(len(words))
        hits.append(spans)
        found.append(ids)
    return n_words, hits, found


def _whole_pass(sent, window: int, place: int | None):
    """mapInArrow function from (_row, _text), or _row with the text in that
    place, to (_row, _n, digest columns)."""
    name = uuid.uuid4().hex

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables = _tables(sent, name, window)
        for batch in batches:
            text = batch.column(1) if place is None else pc.struct_field(batch.column(0), [place])
            n_words, hits, found = _occurrences(text, tables)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n_words, pa.int64()), *_digest(hits, found)], ["_row", "_n", *_DIGEST])

    return run


def _hit_pass(sent, window: int):
    """mapInArrow function from (_key, _text) to (_key, _hits, _items) of the rows
    with an occurrence."""
    name = uuid.uuid4().hex

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables = _tables(sent, name, window)
        for batch in batches:
            _, hits, found = _occurrences(batch.column(1), tables)
            at = [k for k, h in enumerate(hits) if h]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(at, pa.int64())), pa.array([hits[k] for k in at], pa.list_(pa.int64())),
                 pa.array([list(found[k]) for k in at], pa.list_(pa.string()))], ["_key", "_hits", "_items"])

    return run


def _count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(_key, _row, _text) to (_key, _row, _n)."""
    for batch in batches:
        n = pa.array([len(split_words(t)) for t in utf8(batch.column(2))], pa.int64())
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), n], ["_key", "_row", "_n"])


def _digest_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        yield pa.RecordBatch.from_arrays([batch.column(0), *_digest(batch.column(1).to_pylist(), batch.column(2).to_pylist())], ["_key", *_DIGEST])


def search(docs: DataFrame, benchmark: DataFrame, keep: tuple[str, ...], text_col: str = "text", item_id: str = "item_id",
           item_text: str = "text", window: int = WINDOW, block_words: int = BLOCK_WORDS) -> DataFrame:
    """_row (struct of the ``keep`` columns), _n (words), _n_hit, _n_items and
    _sha (checksum of the item ids)."""
    items, blocks = _blocks(benchmark, item_id, item_text, block_words, window)
    passes = [blocks[k:k + PASS_BLOCKS] for k in range(0, len(blocks), PASS_BLOCKS)]
    row, text = F.struct(*[F.col(f"`{c}`") for c in keep]).alias("_row"), F.col(f"`{text_col}`").alias("_text")
    carried = text_col in keep  # then the text goes with its row only
    sums = docs.select(row, F.lit(0).cast("long").alias("_n")).schema.add("_n_hit", "long").add("_n_items", "long").add("_sha", "string")
    if len(passes) <= 1:
        d = docs.select(row, *([] if carried else [text]))
        place = keep.index(text_col) if carried else None
        return d.mapInArrow(_whole_pass(_send(items, passes[0] if passes else [(0, -1)]), window, place), sums)
    rows = stage(docs.select(F.monotonically_increasing_id().alias("_key"), row, *([] if carried else [text])), "decontaminate-rows")
    rows = rows.select("_key", "_row", F.col("_row")[text_col].alias("_text")) if carried else rows
    found_in = []
    for blocks_of_pass in passes:
        sent = _send(items, blocks_of_pass)
        found = rows.select("_key", "_text").mapInArrow(_hit_pass(sent, window), "_key long, _hits array<bigint>, _items array<string>")
        found_in.append(stage(found, "decontaminate-hits"))
        sent.destroy()
    merged = reduce(DataFrame.unionByName, found_in).groupBy("_key").agg(
        F.flatten(F.collect_list("_hits")).alias("_hits"), F.array_distinct(F.flatten(F.collect_list("_items"))).alias("_items"))
    digests = merged.mapInArrow(_digest_rows, "_key long, _n_hit long, _n_items long, _sha string")
    counted = rows.select("_key", "_row", "_text")
    counted = counted.mapInArrow(_count_words, counted.drop("_text").schema.add("_n", "long"))
    none = hashlib.sha256(b"").hexdigest()
    return counted.join(digests, "_key", "left").select(
        "_row", "_n", F.coalesce("_n_hit", F.lit(0).cast("long")).alias("_n_hit"),
        F.coalesce("_n_items", F.lit(0).cast("long")).alias("_n_items"), F.coalesce("_sha", F.lit(none)).alias("_sha"))


#: share of hit words, in twentieths, from which a text with a hit is contaminated
_CONTAMINATED = "_n_hit > 0 and 20 * _n_hit >= _n"


def measure(docs: DataFrame, benchmark: DataFrame, keep: tuple[str, ...] = ("doc_id",), **options) -> DataFrame:
    """``keep`` columns, n_words, n_hit, n_items, items_sha256 and contaminated."""
    return search(docs, benchmark, keep, **options).select(
        "_row.*", F.col("_n").alias("n_words"), F.col("_n_hit").alias("n_hit"), F.col("_n_items").alias("n_items"),
        F.col("_sha").alias("items_sha256"), F.expr(_CONTAMINATED).alias("contaminated"))


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """The rows of ``docs`` that are not contaminated, all columns unchanged."""
    return search(docs, benchmark, tuple(docs.columns), **options).where(f"not ({_CONTAMINATED})").select("_row.*")
