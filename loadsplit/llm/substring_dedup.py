"""Substring dedup: Rabin-Karp hashes of every fixed-length window of words,
counted in Spark; windows whose words also start somewhere else are merged into
maximal removal intervals.

Texts are packed once, in input order, into compressed blocks of some megabytes
that are written as a table bucketed by the input part; neither texts nor
positions are shuffled after that. A round of counting is a request and a
reply: each pack sends the sorted distinct hashes of its windows to hash ranges
(differences of sorted hashes, zero bytes left out, and a window that fills a
corpus is sent once a pack), each range counts them and answers with one bit per
hash. The first round counts 48 bits of
the hash; a second one counts 64 bits of an independent hash, for the windows
that passed the first only, so chance matches need both. The answers go
back to the packs' parts, by a join on the bucket column that leaves the packs
where they are.

There are ``RANGES_PER_TASK`` hash ranges a shuffle partition, so requests grow with
the packs alone: a row of some 70 bytes and four to five bytes a window. A range
that holds more than ``RANGE_WINDOWS`` windows is counted in slices of its hashes:
its requests are cut where they have arrived and sorted by slice, which spills, so
a task counts one slice at a time. Packs hold ``pack_bytes`` of text.

Defined cases: a null or empty text has no words and loses none; a text of
fewer words than a window loses none; one text longer than a pack is a pack of
its own; repeated rows are repeats of each other and lose all windows; ids and
other columns are carried as they are; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import re
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loadsplit.session import scratch_path

from .common import grouped, ranges, shuffle_partitions, stage, utf8

WINDOW = 35
PACK_BYTES = 4 << 20
BLOCK_BYTES = 1 << 18
RANGE_WINDOWS = 1 << 20
RANGES_PER_TASK = 4
LONG_WORD = 64
#: per round: seed of the byte values, base of the polynomials (odd), bits left out
ROUNDS = ((1, 0x9E3779B97F4A7C15, 16), (2, 0xC2B2AE3D27D4EB4F, 0))
_WORD = re.compile(rb"[^\x20\x09-\x0D]+")
_SPACE = np.isin(np.arange(256), [0x20, *range(0x09, 0x0E)])


# --- hashing ------------------------------------------------------------------------

_powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def _power(base: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """base^k and base^-k modulo 2^64 for k < n."""
    if base not in _powers or _powers[base][0].size < n:
        size = 1 << max(16, (n - 1).bit_length())
        up = np.full(size, base, np.uint64)
        down = np.full(size, pow(base, -1, 1 << 64), np.uint64)
        up[0] = down[0] = 1
        _powers[base] = np.cumprod(up, dtype=np.uint64), np.cumprod(down, dtype=np.uint64)
    return _powers[base]


def _rolling(values: np.ndarray, starts: np.ndarray, ends: np.ndarray, base: int) -> np.ndarray:
    """Rabin-Karp hashes of value stretches: prefix sums of value * base^k, taken
    back to the stretch's start, then mixed."""
    up, down = _power(base, values.size + 1)
    prefix = np.zeros(values.size + 1, np.uint64)
    np.cumsum(values * up[:values.size], out=prefix[1:])
    h = (prefix[ends] - prefix[starts]) * down[starts]
    h ^= h >> np.uint64(32)
    h *= np.uint64(base)
    return h ^ (h >> np.uint64(29))


class Texts:
    """The texts of a pack as one stretch of bytes: their words, and the hashes
    of the windows that start at each word."""

    def __init__(self, column: pa.Array, window: int):
        column = column.cast(pa.large_binary())
        self.offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset:column.offset + len(column) + 1]
        data = column.buffers()[2]
        self.data = np.frombuffer(data, np.uint8) if data else np.empty(0, np.uint8)
        word = np.zeros(self.data.size + 2, bool)  # one place before and one after
        word[1:-1] = ~_SPACE[self.data]
        edge = np.zeros(self.data.size + 1, bool)
        edge[self.offsets] = True
        self.starts = np.flatnonzero(word[1:] & (~word[:-1] | edge))
        self.ends = np.flatnonzero(word[:-1] & (~word[1:] | edge))
        #: number of the first word of each text, and of all words
        self.first = np.searchsorted(self.starts, self.offsets)
        last = np.repeat(self.first[1:], np.diff(self.first))
        self.windows = np.flatnonzero(np.arange(last.size) + window <= last)
        self.window = window

    def blocks(self) -> Iterator[tuple[int, int]]:
        """Stretches of texts of about BLOCK_BYTES."""
        n = len(self.offsets) - 1
        at = 0
        while at < n:
            to = max(at + 1, int(np.searchsorted(self.offsets, self.offsets[at] + BLOCK_BYTES)))
            yield at, min(to, n)
            at = min(to, n)

    def hashes(self, seed: int, base: int) -> np.ndarray:
        """Hash of the window at every word (of what is there, where it is cut short)."""
        values = np.random.default_rng(seed).integers(1 << 63, size=256, dtype=np.uint64)
        out = np.empty(self.starts.size, np.uint64)
        for at, to in self.blocks():
            lo, hi, byte = self.first[at], self.first[to], self.offsets[at]
            if lo == hi:
                continue
            starts, ends = self.starts[lo:hi], self.ends[lo:hi]
            words = _rolling(values[self.data[byte:self.offsets[to]]], starts - byte, ends - byte, base)
            for k in np.flatnonzero(ends - starts > LONG_WORD):  # long repetitive words would defeat a power of two as modulus
                words[k] = xxhash.xxh64_intdigest(self.data[starts[k]:ends[k]].tobytes(), seed)
            place = np.arange(hi - lo)
            out[lo:hi] = _rolling(words, place, np.minimum(place + self.window, hi - lo), base)
        return out


# --- packs --------------------------------------------------------------------------

def _write_pack(batch: pa.Table) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, batch.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
        out.write_table(batch)
    return sink.getvalue().to_pybytes()


def _read_pack(raw: bytes) -> pa.Table:
    return pa.ipc.open_stream(raw).read_all()


def _packer(window: int, pack_bytes: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, pack, held, size, windows = TaskContext.get().partitionId(), 0, [], 0, 0

        def flush() -> pa.RecordBatch:
            row = [[part], [pack], [windows], [_write_pack(pa.Table.from_batches(held))]]
            return pa.RecordBatch.from_arrays(
                [pa.array(v, t) for v, t in zip(row, (pa.int32(), pa.int32(), pa.int64(), pa.binary()))],
                ["part", "pack", "windows", "payload"])

        for b in batches:
            at = 0
            for k, text in enumerate(utf8(b.column(b.schema.get_field_index("_text")))):
                size += len(text) + 1
                windows += max(0, len(text.split()) - window + 1)
                if size >= pack_bytes:
                    held.append(b.slice(at, k + 1 - at))
                    yield flush()
                    at, pack, held, size, windows = k + 1, pack + 1, [], 0, 0
            if at < b.num_rows:
                held.append(b.slice(at))
        if held:
            yield flush()

    return run


def pack_texts(docs: DataFrame, text_col: str = "text", window: int = WINDOW, pack_bytes: int = PACK_BYTES,
               keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """Table (part, pack, windows, payload) of the rows' ``keep`` columns and
    texts, bucketed by part and kept under the checkpoint folder."""
    spark = docs.sparkSession
    rows = docs.select(*[F.col(f"`{c}`").alias(f"_c{k}") for k, c in enumerate(keep)], F.col(f"`{text_col}`").alias("_text"))
    packs = rows.mapInArrow(_packer(window, pack_bytes), "part int, pack int, windows long, payload binary")
    name = f"packs_{uuid.uuid4().hex}"
    packs.write.bucketBy(shuffle_partitions(spark), "part").option("path", scratch_path(spark, name)).saveAsTable(name)
    table = spark.table(name)
    spark.sql(f"DROP TABLE {name}")  # of the catalog's entry; the files are the table's own
    return table


# --- counting -------------------------------------------------------------------------

def _dense(h: np.ndarray) -> bytes:
    """Sorted hashes as differences, byte by byte, without planes of zeros."""
    planes = np.diff(h, prepend=np.uint64(0)).view(np.uint8).reshape(-1, 8).T
    used = planes.any(axis=1)
    return bytes([int(np.packbits(used, bitorder="little")[0])]) + planes[used].tobytes()


def _sparse(raw: bytes, n: int) -> np.ndarray:
    used = np.unpackbits(np.frombuffer(raw, np.uint8, 1), bitorder="little").astype(bool)
    planes = np.zeros((8, n), np.uint8)
    planes[used] = np.frombuffer(raw, np.uint8, offset=1).reshape(-1, n)
    return np.cumsum(np.ascontiguousarray(planes.T).view(np.uint64).ravel(), dtype=np.uint64)


def _edges(n_ranges: int, bits: int) -> np.ndarray:
    """First hash of each range of hashes of so many bits."""
    return np.array([-(-(k << bits) // n_ranges) for k in range(n_ranges)], np.uint64)


class _Asked:
    """The windows of a pack that passed the rounds so far, and the sorted
    distinct hashes to ask about in a round."""

    def __init__(self, pack: pa.Table, window: int, answers: list[tuple[int, list | None]]):
        """answers: (ranges, replies) of the rounds before."""
        self.texts = Texts(pack.column("_text").combine_chunks(), window)
        self.at = self.texts.windows
        for k, (n_ranges, replies) in enumerate(answers):
            self.ask(k)
            self.hear(n_ranges, ROUNDS[k][2], replies or [])

    def ask(self, k: int) -> None:
        seed, base, off = ROUNDS[k]
        found = self.texts.hashes(seed, base)[self.at] >> np.uint64(off) if self.at.size else np.empty(0, np.uint64)
        self.order = np.argsort(found)
        found = found[self.order]
        new = np.r_[True, found[1:] != found[:-1]][:found.size]
        first = np.flatnonzero(new)
        self.distinct, self.place = found[first], np.cumsum(new) - 1
        self.twice = np.diff(np.r_[first, found.size]) > 1

    def hear(self, n_ranges: int, off: int, replies: list) -> None:
        """Keep the windows whose hash was found elsewhere."""
        cut = np.r_[np.searchsorted(self.distinct, _edges(n_ranges, 64 - off)), self.distinct.size]
        again = self.twice.copy()
        for r in replies:
            lo = cut[r["range"]] + r["at"]
            hi = lo + r["n"]
            again[lo:hi] |= np.unpackbits(np.frombuffer(r["bits"], np.uint8), count=hi - lo).astype(bool)
        self.at = np.sort(self.at[self.order[again[self.place]]])


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    """Rows of packs, one at a time."""
    for b in batches:
        for k in range(b.num_rows):
            yield b.slice(k, 1).to_pylist()[0]


def _requests(k: int, window: int, n_ranges: list[int]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        edges = _edges(n_ranges[k], 64 - ROUNDS[k][2])
        for row in _rows(batches):
            asked = _Asked(_read_pack(row["payload"]), window, [(n_ranges[j], row[f"r{j}"]) for j in range(k)])
            asked.ask(k)
            cut = np.r_[np.searchsorted(asked.distinct, edges), asked.distinct.size]
            full = np.flatnonzero(np.diff(cut))
            n = np.diff(cut)[full]
            blobs = [_dense(asked.distinct[cut[r]:cut[r + 1]]) for r in full]
            fixed = lambda value: pa.array([value] * full.size, pa.int32())
            yield pa.RecordBatch.from_arrays(
                [pa.array(full, pa.int64()), pa.array(full, pa.int32()), fixed(row["part"]), fixed(row["pack"]), fixed(0),
                 pa.array(n, pa.int32()), pa.array(blobs, pa.binary())], _REQUEST_NAMES)

    return run


#: a request: what is counted together, range, sender, place of its first hash among the sender's of the range, hashes
_REQUEST = "key long, range int, part int, pack int, at int, n int, hashes binary"
_REQUEST_NAMES = [f.split()[0] for f in _REQUEST.split(", ")]


def _slices(n_ranges: int, n_slices: int, bits: int):
    """mapInArrow function that cuts requests at the slices of their range."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        edges = _edges(n_ranges * n_slices, bits)
        for b in batches:
            rows = []
            for r in b.to_pylist():
                h, first = _sparse(r["hashes"], r["n"]), r["range"] * n_slices
                cut = np.r_[np.searchsorted(h, edges[first:first + n_slices]), h.size]
                for k in np.flatnonzero(np.diff(cut)).tolist():
                    lo, hi = int(cut[k]), int(cut[k + 1])
                    rows.append(r | {"key": first + k, "at": lo, "n": hi - lo, "hashes": _dense(h[lo:hi])})
            yield pa.RecordBatch.from_pylist(rows, b.schema)

    return run


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by key: for each request one bit per hash that another
    request of the key has too."""
    for t in grouped(batches, "key"):
        numbers = t.column("key").to_numpy()
        first = np.flatnonzero(np.r_[True, numbers[1:] != numbers[:-1]])
        for at, to in zip(first, np.r_[first[1:], numbers.size]):
            g = t.slice(at, to - at)
            n = g.column("n").to_numpy()
            h = np.concatenate([_sparse(raw.as_py(), k) for raw, k in zip(g.column("hashes"), n)])
            order = np.argsort(h, kind="stable")
            s = h[order]
            same = s[1:] == s[:-1]
            again = np.zeros(h.size, bool)
            again[order[1:][same]] = True
            again[order[:-1][same]] = True
            parts = np.split(again, np.cumsum(n)[:-1])
            told = [k for k, p in enumerate(parts) if p.any()]
            if told:
                yield pa.RecordBatch.from_arrays(
                    [g.column(c).combine_chunks().take(pa.array(told)) for c in ("part", "pack", "range", "at", "n")]
                    + [pa.array([np.packbits(parts[k]).tobytes() for k in told], pa.binary())],
                    ["part", "pack", "range", "at", "n", "bits"])


def _own(replies: str) -> Column:
    """The replies to a pack, from those to its part."""
    return F.transform(F.filter(F.col(replies), lambda r: r["pack"] == F.col("pack")),
                       lambda r: F.struct(*[r[c].alias(c) for c in ("range", "at", "n", "bits")]))


def _answered(packs: DataFrame, answers: list[DataFrame]) -> DataFrame:
    """Packs with the replies of each round as r0, r1 ..."""
    d = packs
    for k, a in enumerate(answers):
        d = d.join(a.hint("shuffle_hash"), "part", "left").withColumn(f"r{k}", _own(f"_a{k}")).drop(f"_a{k}")
    return d


def repeated(packs: DataFrame, window: int = WINDOW) -> tuple[list[int], list[DataFrame]]:
    """Number of hash ranges and replies (part, list of pack, range, place, number and bits) of each round."""
    spark = packs.sparkSession
    total = packs.agg(F.sum("windows")).first()[0] or 0
    n_ranges = [RANGES_PER_TASK * shuffle_partitions(spark)] * len(ROUNDS)
    n_slices = max(1, -(-total // (n_ranges[0] * RANGE_WINDOWS)))
    answers: list[DataFrame] = []
    for k in range(len(ROUNDS)):
        asked = _answered(packs.drop("windows"), answers).mapInArrow(_requests(k, window, n_ranges), _REQUEST).repartition("range")
        if n_slices > 1:
            asked = asked.mapInArrow(_slices(n_ranges[k], n_slices, 64 - ROUNDS[k][2]), _REQUEST)
        told = asked.sortWithinPartitions("key").mapInArrow(_count, "part int, pack int, range int, at int, n int, bits binary")
        lists = told.groupBy("part").agg(F.collect_list(F.struct("pack", "range", "at", "n", "bits")).alias(f"_a{k}"))
        answers.append(stage(lists, f"substring-replies-{k}"))
    return n_ranges, answers


# --- removal --------------------------------------------------------------------------

def _cut(text: bytes, mask: np.ndarray) -> bytes:
    """The kept stretches as they stand in the text, joined by a space."""
    spans = np.array([m.span() for m in _WORD.finditer(text)])
    edge = np.flatnonzero(np.diff(np.r_[True, mask, True].astype(np.int8)))
    return b" ".join(text[spans[a][0]:spans[b - 1][1]] for a, b in zip(edge[::2], edge[1::2]))


def _remover(window: int, n_ranges: list[int], texts: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in _rows(batches):
            pack = _read_pack(row["payload"])
            asked = _Asked(pack, window, [(n, row[f"r{k}"]) for k, n in enumerate(n_ranges)])
            first = asked.texts.first
            mask = ranges(asked.at, asked.at + window, int(first[-1]))
            removed = np.diff(np.r_[0, np.cumsum(mask)][first])
            raw, spans, shas, kept = pack.column("_text").combine_chunks(), [], [], []
            for k, n in enumerate(removed.tolist()):
                text = raw[k].as_py()
                code = (text or "").encode()
                words = code.split()
                if n:
                    own = mask[first[k]:first[k + 1]]
                    spans.append(np.flatnonzero(np.diff(np.r_[False, own, False].astype(np.int8))).tolist())
                    words = [w for w, m in zip(words, own.tolist()) if not m]
                    text = _cut(code, own).decode() if texts else None
                else:
                    spans.append([])
                shas.append(hashlib.sha256(b" ".join(words)).hexdigest())
                if texts:
                    kept.append(text)
            made = {"_n": pa.array(np.diff(first), pa.int64()), "_removed": pa.array(removed, pa.int64()),
                    "_spans": pa.array(spans, pa.list_(pa.int64())), "_sha": pa.array(shas, pa.string())}
            made |= {"_kept": pa.array(kept, pa.string())} if texts else {}
            carried = {c: pack.column(c) for c in pack.column_names if c != "_text"}
            yield from pa.table(carried | made).to_batches(max_chunksize=2000)

    return run


def _found(docs: DataFrame, text_col: str, keep: tuple[str, ...], window: int, pack_bytes: int, texts: bool) -> DataFrame:
    """_c0.. (the ``keep`` columns), _n, _removed, _spans, _sha and _kept."""
    packs = pack_texts(docs, text_col, window, pack_bytes, keep)
    n_ranges, answers = repeated(packs, window)
    schema = docs.select(*[F.col(f"`{c}`").alias(f"_c{k}") for k, c in enumerate(keep)]).schema
    schema = schema.add("_n", "long").add("_removed", "long").add("_spans", T.ArrayType(T.LongType())).add("_sha", "string")
    if texts:
        schema = schema.add("_kept", "string")
    return _answered(packs.drop("windows"), answers).mapInArrow(_remover(window, n_ranges, texts), schema)


def remove_repeats(docs: DataFrame, text_col: str = "text", keep: tuple[str, ...] = ("doc_id",), window: int = WINDOW,
                   pack_bytes: int = PACK_BYTES, texts: bool = True) -> DataFrame:
    """The ``keep`` columns, then n_words, n_removed, removed (flat list of first
    word and word after the last of each maximal interval), kept_sha256 (of the
    kept words, joined by one space) and, with ``texts``, kept_text."""
    names = {"_n": "n_words", "_removed": "n_removed", "_spans": "removed", "_sha": "kept_sha256"}
    names |= {"_kept": "kept_text"} if texts else {}
    return _found(docs, text_col, keep, window, pack_bytes, texts).select(
        *[F.col(f"_c{k}").alias(c) for k, c in enumerate(keep)], *[F.col(a).alias(b) for a, b in names.items()])


def drop_repeats(docs: DataFrame, text_col: str = "text", window: int = WINDOW, pack_bytes: int = PACK_BYTES) -> DataFrame:
    """``docs`` with repeated passages cut out of the texts. Texts without any
    are unchanged; all rows and other columns stay."""
    others = tuple(c for c in docs.columns if c != text_col)
    cut = _found(docs, text_col, others, window, pack_bytes, True)
    place = {c: f"_c{k}" for k, c in enumerate(others)} | {text_col: "_kept"}
    return cut.select(*[F.col(place[c]).alias(c) for c in docs.columns])
