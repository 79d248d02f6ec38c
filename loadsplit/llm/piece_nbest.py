"""SentencePiece encoding and decoding by N-best segmentation: forward Viterbi
scores over the lattice of pieces are exact heuristics for a backward A* search.

The lattice of a text falls apart at places that no piece spans (before a word
mark that follows another character, around line breaks), so a text's
segmentations are combinations of those of its chunks. Chunks are solved once
per task and remembered: ids and score of the best path, and how much the
second best loses; where more come together than may be remembered, those
that the texts at hand use again stay. A text's N best can only change the N - 1 chunks that lose
least; those are searched by A* and combined best first.

A path's score is the sum of the model's piece scores. A character that no
piece covers is spelled in byte pieces, at ten less than the lowest score.
Ties between segmentations are broken alike every time, by the search order;
a search leaves each place at most N times, however many paths tie.

Defined cases: null and empty texts have no ids and one segmentation of score
zero; very long texts are read whole (a chunk is bounded by the distance of
spaces); a literal word mark (U+2581) in a text decodes as a space, as the
model has one form for both; repeated rows and null ids keep their rows; an
empty table gives an empty result. Other columns are only carried by ``keep``.
"""

from __future__ import annotations

import gc
import heapq
import re
import sys
import zlib
from collections.abc import Iterable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import text_slices, utf8

N_BEST = 4
CACHED_CHUNKS = 700_000
#: where a worker has served other operators before and the executor's heap is full, as in a pipeline
FEW_CHUNKS = 200_000
CACHED_SEARCHES = 20_000
GROUP_BYTES = 2 << 20
MARK = "▁"
#: (score, ids of the segmentation as little-endian 32-bit integers)
Path = tuple[float, bytes]
#: ids of the best segmentation, its score, and per segmentation (score, [(start, number of ids, ids in their place)])
Segments = tuple[bytes, float, list[tuple[float, list[tuple[int, int, bytes]]]]]
NEVER = float("-inf")
LARGEST = sys.float_info.max


class Pieces:
    """The model's vocabulary as a lattice over text."""

    def __init__(self, scores: dict[str, tuple[int, float]], byte_ids: Sequence[int], cached: int = CACHED_CHUNKS):
        self.scores, self.byte_ids, self.cached = scores, byte_ids, cached
        self.unknown = min((s for _, s in scores.values()), default=0.0) - 10
        self.spelled = [np.uint32(i).astype("<u4").tobytes() for i in byte_ids]
        #: every end of a piece; (score, ids) if it is a piece itself
        self.missing, self.suffixes = (), {}
        for p in scores:
            self.suffixes.update({p[k:]: None for k in range(1, len(p))})
        self.suffixes |= {p: (s, np.uint32(i).astype("<u4").tobytes()) for p, (i, s) in scores.items()}
        joined = any(a != MARK and b == MARK for p in scores for a, b in zip(p, p[1:]))
        broken = any("\n" in p and len(p) > 1 for p in scores)
        words = rf"{MARK}*[^{MARK}\n]+|{MARK}+|\n" if not broken else rf"{MARK}*[^{MARK}]+|{MARK}+"
        self.chunk = re.compile(words if not joined else r"(?s).+")
        self.simple = not joined and not broken
        self.form = {i: p.replace(MARK, " ").encode() for p, (i, _) in scores.items()} | {i: bytes([b]) for b, i in enumerate(byte_ids)}
        self.best: dict[str, tuple[bytes, float, float]] = {}
        self.searched: dict[tuple[str, int], list[Path]] = {}

    @classmethod
    def load(cls, model_path: str) -> Pieces:
        import sentencepiece
        sp = sentencepiece.SentencePieceProcessor(model_file=model_path)
        normal = [i for i in range(sp.get_piece_size())
                  if not (sp.is_byte(i) or sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i))]
        return cls({sp.id_to_piece(i): (i, sp.get_score(i)) for i in normal},
                   [sp.piece_to_id(f"<0x{b:02X}>") for b in range(256)])

    def _bytes(self, char: str) -> bytes:
        return b"".join([self.spelled[x] for x in char.encode()])

    def forward(self, chunk: str) -> tuple[list[float], list[list[tuple[int, float, bytes]]]]:
        """Viterbi: best score from the start to every place, and per place the
        (start, score, ids) of the pieces that end there."""
        n = len(chunk)
        score, edges = [0.0], [[]]
        for j in range(1, n + 1):
            own = [] if chunk[j - 1] in self.scores else [(j - 1, self.unknown, self._bytes(chunk[j - 1]))]
            for i in range(j - 1, -1, -1):
                hit = self.suffixes.get(chunk[i:j], self.missing)
                if hit is self.missing:
                    break
                if hit:
                    own.append((i, *hit))
            edges.append(own)
            score.append(max((score[i] + s for i, s, _ in own), default=NEVER))
        return score, edges

    def solve(self, chunks: Iterable[str]) -> None:
        """Remember for each chunk (ids of the best path as little-endian
        integers, its score, what the second best path scores less): Viterbi with
        the two best scores of a place. In sorted order a chunk starts from the
        places it has in common with the one before."""
        get, missing, known, best = self.suffixes.get, self.missing, self.scores, self.best
        first, second, back = [0.0], [NEVER], [(0, b"")]
        last = ""
        for chunk in sorted(chunks):
            n, at = len(chunk), 0
            for x, y in zip(chunk, last):
                if x != y:
                    break
                at += 1
            del first[at + 1:], second[at + 1:], back[at + 1:]
            last = chunk
            for j in range(at + 1, n + 1):
                top = low = NEVER
                way = 0, b""
                for i in range(j - 1, -1, -1):
                    hit = get(chunk[i:j], missing)
                    if hit is None:
                        continue
                    if hit is missing:
                        break
                    v = first[i] + hit[0]
                    if v > top:
                        after = second[i] + hit[0]
                        top, low, way = v, top if top > after else after, (i, hit[1])
                    elif v > low:
                        low = v
                if chunk[j - 1] not in known:
                    v = first[j - 1] + self.unknown
                    if v > top:
                        top, low, way = v, max(top, second[j - 1] + self.unknown), (j - 1, self._bytes(chunk[j - 1]))
                    elif v > low:
                        low = v
                first.append(top)
                second.append(low)
                back.append(way)
            ids, at = [], n
            while at:
                at, own = back[at]
                ids.append(own)
            best[chunk] = b"".join(ids[::-1]), first[n], first[n] - second[n]

    def learn(self, chunks: set[str]) -> None:
        """Solve the chunks that are not remembered."""
        new = chunks.difference(self.best)
        if len(self.best) + len(new) > self.cached:
            self.best = {c: self.best[c] for c in chunks - new}
        self.solve(new)

    def search(self, chunk: str, n: int) -> list[Path]:
        """The n best segmentations: A* from the end, where the forward score of
        a place is just what the best start up to it adds. Of equal states the
        one nearest to the start goes on, and a place is left in the n best ways
        only, so ties and rounding cannot multiply what is open."""
        score, edges = self.forward(chunk)
        heap, tick, out, left = [(-score[-1], len(chunk), 0, 0.0, None)], 0, [], [0] * (len(chunk) + 1)
        while heap and len(out) < n:
            _, at, _, behind, tail = heapq.heappop(heap)
            if at == 0:
                ids, forward = [], 0.0  # added up from the start, as the Viterbi scores are
                while tail:
                    own, s, tail = tail
                    ids.append(own)
                    forward += s
                out.append((forward, b"".join(ids)))
                continue
            if left[at] == n:
                continue
            left[at] += 1
            for i, s, own in edges[at]:
                if left[i] < n:
                    tick += 1
                    heapq.heappush(heap, (-(score[i] + s + behind), i, tick, s + behind, (own, s, tail)))
        return sorted(out, key=lambda w: -w[0])

    def segment(self, text: str, n: int) -> Segments:
        """(ids of the best segmentation, its score, the n best as (score,
        changes)); a change replaces so many ids from a place of the best."""
        chunks = self.chunks(text)
        self.learn(set(chunks))
        return self.combine(chunks, n)

    def chunks(self, text: str) -> list[str]:
        if not text:
            return []
        if not self.simple or "  " in text or MARK in text or " \n" in text or "\n " in text or text[0] == " " or text[-1] == " ":
            return self.chunk.findall(MARK + text.replace(" ", MARK))
        out: list[str] = []
        for line in text.split("\n"):  # the same cuts, where single spaces make them plain
            head, *rest = line.split(" ")
            if out:
                out.append("\n")
                if head:
                    out.append(head)
            else:
                out.append(MARK + head)
            out += [MARK + w for w in rest]
        return out

    def segments(self, texts: Iterable[str], n: int) -> Iterator[Segments]:
        """``segment`` of each text, in groups whose new chunks are solved together."""
        group, size = [], 0
        for text in texts:
            group.append(self.chunks(text))
            size += len(text)
            if size >= GROUP_BYTES:
                yield from self._together(group, n)
                group, size = [], 0
        yield from self._together(group, n)

    def _together(self, group: list[list[str]], n: int) -> Iterator[Segments]:
        self.learn(set().union(*group))
        for chunks in group:
            yield self.combine(chunks, n)

    def forget(self) -> None:
        """Drop what is remembered: a worker lives on after its task. The free
        tuples that Python keeps for itself would hold on to the memory around them."""
        self.best, self.searched = {}, {}
        gc.collect()

    def ways(self, chunk: str, n: int) -> list[Path]:
        """The n best segmentations, the remembered best one first of its equals."""
        found = self.searched.get((chunk, n))
        if found is None:
            if len(self.searched) >= CACHED_SEARCHES:
                self.searched.clear()
            ids, score, _ = self.best[chunk]
            found = self.searched[chunk, n] = [(score, ids), *[w for w in self.search(chunk, n) if w[1] != ids]][:n]
        return found

    def combine(self, chunks: list[str], n: int) -> Segments:
        """The n best combinations of solved chunks."""
        if not chunks:
            return b"", 0.0, [(0.0, [])]
        ids, scores, loses = zip(*map(self.best.__getitem__, chunks))
        total, most = sum(scores), sorted(loses)[:n - 1]
        limit = min(most[-1], LARGEST) if most else NEVER
        turn = [k for k, x in enumerate(loses) if x <= limit]
        turn = sorted(sorted(turn, key=loses.__getitem__)[:n - 1])
        ways = [self.ways(chunks[k], n) for k in turn]
        start = [sum(map(len, ids[:k])) // 4 for k in turn]
        none = (0,) * len(turn)
        heap, seen, found = [(-total, none)], {none}, []
        while heap and len(found) < n:
            low, pick = heapq.heappop(heap)
            found.append((-low, [(at, len(ids[k]) // 4, w[p][1]) for k, at, w, p in zip(turn, start, ways, pick) if p]))
            for k, w in enumerate(ways):
                more = (*pick[:k], pick[k] + 1, *pick[k + 1:])
                if more[k] < len(w) and more not in seen:
                    seen.add(more)
                    heapq.heappush(heap, (low + w[pick[k]][0] - w[more[k]][0], more))
        return b"".join(ids), total, found

    def decode(self, ids: Sequence[int]) -> str:
        """Text of the ids; the space put before the first word is taken off."""
        return b"".join(map(self.form.__getitem__, ids))[1:].decode("utf-8", "replace")


def replace(ids: bytes, changes: Sequence[tuple[int, int, bytes]]) -> bytes:
    """A segmentation's ids from those of the best one (changes in order of place)."""
    out, at = [], 0
    for start, n, new in changes:
        out += [ids[4 * at:4 * start], new]
        at = start + n
    return b"".join([*out, ids[4 * at:]])


_loaded: dict[str, Pieces] = {}


def pieces(model_path: str) -> Pieces:
    if model_path not in _loaded:
        _loaded[model_path] = Pieces.load(model_path)
    return _loaded[model_path]


_CHANGE = T.StructType().add("start", "integer").add("n", "integer").add("ids", T.ArrayType(T.IntegerType()))
_PATH = T.StructType().add("score", "double").add("changes", T.ArrayType(_CHANGE))


def _lists(ids: list[bytes]) -> pa.ListArray:
    at = np.cumsum([0, *[len(i) // 4 for i in ids]])
    return pa.ListArray.from_arrays(pa.array(at, pa.int32()), pa.array(np.frombuffer(b"".join(ids), "<i4")))


_KIND = pa.list_(pa.struct([("score", pa.float64()), ("changes", pa.list_(pa.struct(
    [("start", pa.int32()), ("n", pa.int32()), ("ids", pa.list_(pa.int32()))])))]))


def _encoded(model: Pieces, part: pa.RecordBatch, n_best: int) -> pa.RecordBatch:
    """(_row, ids, score, nbest) of (_row, _text)."""
    found = list(model.segments((t.decode() for t in utf8(part.column(1))), n_best))
    paths = [[{"score": s, "changes": [{"start": x, "n": y, "ids": np.frombuffer(z, "<i4")} for x, y, z in c]} for s, c in f[2]] for f in found]
    return pa.RecordBatch.from_arrays([part.column(0), _lists([f[0] for f in found]), pa.array([f[1] for f in found], pa.float64()),
                                       pa.array(paths, _KIND)], ["_row", "ids", "score", "nbest"])


def encode(docs: DataFrame, model_path: str, n_best: int = N_BEST, text_col: str = "text",
           keep: tuple[str, ...] = ("doc_id",), cached: int = FEW_CHUNKS) -> DataFrame:
    """The ``keep`` columns, ids, score and nbest (array of score and changes to
    ids). A task holds the results of GROUP_BYTES of text at a time, and the
    chunks of one such group or ``cached`` ones, whichever are more."""
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in keep]).alias("_row"), F.col(f"`{text_col}`").alias("_text"))
    schema = rows.select("_row").schema.add("ids", T.ArrayType(T.IntegerType())).add("score", "double").add("nbest", T.ArrayType(_PATH))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = pieces(model_path)
        model.cached = cached
        for b in batches:
            for part in text_slices(b, 1, GROUP_BYTES):
                yield _encoded(model, part, n_best)
        model.forget()

    return rows.mapInArrow(run, schema).select("_row.*", "ids", "score", "nbest")


def decode(coded: DataFrame, model_path: str, ids_col: str = "ids", out: str = "decoded") -> DataFrame:
    """``coded`` with the text of the ids as column ``out``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = pieces(model_path)
        for b in batches:
            ids = b.column(b.schema.get_field_index(ids_col))
            at, values = ids.offsets.to_numpy(), ids.values.to_numpy()
            texts = [model.decode(values[s:e].tolist()) for s, e in zip(at[:-1], at[1:])]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(texts, pa.string())], [*b.schema.names, out])

    return coded.mapInArrow(run, T.StructType([*coded.schema.fields, T.StructField(out, T.StringType())]))


def digest(docs: DataFrame, model_path: str, n_best: int = N_BEST, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, n_tokens, score, ids_crc32 (over little-endian 32-bit ids), round_trip
    (the decoded ids give the text) and, for each of the n best, its score and
    the checksum of its ids; ``encode`` and ``decode`` in one pass."""
    rows = docs.select(F.col(f"`{id_col}`").alias("_id"), F.col(f"`{text_col}`").alias("_text"))
    schema = rows.select("_id").schema.add("n_tokens", "long").add("score", "double").add("ids_crc32", "long") \
        .add("round_trip", "boolean").add("nbest_scores", T.ArrayType(T.DoubleType())).add("nbest_crc32", T.ArrayType(T.LongType()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = pieces(model_path)
        model.cached = CACHED_CHUNKS
        for b in batches:
            out = []
            texts = [t.decode() for t in utf8(b.column(1))]
            for text, (ids, score, paths) in zip(texts, model.segments(texts, n_best)):
                same = model.decode(np.frombuffer(ids, "<u4").tolist()) == text
                out.append((len(ids) // 4, score, zlib.crc32(ids), same, [p[0] for p in paths], [zlib.crc32(replace(ids, p[1])) for p in paths]))
            kinds = (pa.int64(), pa.float64(), pa.int64(), pa.bool_(), pa.list_(pa.float64()), pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays([b.column(0), *[pa.array(list(v), k) for v, k in zip(zip(*out), kinds)]], schema.names)
        model.forget()

    return rows.mapInArrow(run, schema).withColumnRenamed("_id", id_col)
