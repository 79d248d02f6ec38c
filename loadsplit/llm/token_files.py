"""Token-id files: Parquet with one row per document and the ids as a list
column, dictionary-encoded (16 bits or less an id before compression); ids of
rows, offsets and counts are delta-encoded. Row groups and pages are small
enough, and page indexes written, so that a read of some documents or of the
metadata columns alone touches only their pages.

Rows are dealt into ranges of the document id, encoded where they land and
written in order, one file a range. A file knows the offset of each row inside
it; offsets between files come from one total per file.

Words between ASCII white space are encoded once per worker and remembered;
the tokenizer's own splitting never joins across white space, so this gives the
ids of the whole text. Arrow lower-cases and splits some megabytes of texts at a
time, finds their different words and deals out the ids of these. For a
tokenizer that lower-cases and splits letters from marks, words of plain letters
go straight to its merge model, without the marks that follow them.

Defined cases: null and empty texts have only the end id; null document ids
come first; rows with one id stand in input order and a hot id is spread over
files; very long texts are one row; repeated rows are written as often as they
come; an empty table gives no rows. Other columns are not read.
"""

from __future__ import annotations

import os
import re
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import arrow_rows, by_bytes, shuffle_partitions

CACHED_WORDS = 600_000     # some 150 MB a worker
ARROW_ROWS = 2_000
PIECE_BYTES = 3 << 20
ROW_GROUP_BYTES = 32 << 20
PAGE_BYTES = 256 << 10
PAGE_ROWS = 1000


#: fixed values: how the byte-level pre-tokenizer writes the bytes that are not printable
_BYTE_CHARS = {b: 256 + k for k, b in enumerate(x for x in range(256) if not (33 <= x <= 126 or 161 <= x <= 172 or x >= 174))}
#: letters that the normalizer only lower-cases (a-z are, all others of Latin-1) and the pre-tokenizer leaves as one word; ASCII marks
_MARKED = re.compile("([a-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff]+)([!-/:-@\\[-`{-~]*)")


class WordEncoder(dict):
    """Word (bytes without ASCII white space) to its ids as little-endian
    unsigned 32-bit integers; of the words remembered those not met again go when
    there are too many. A word with marks after it is not one of them."""

    def __init__(self, tokenizer_path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        self.old: dict[bytes, bytes] = {}
        self.tokenizer = Tokenizer.from_file(tokenizer_path)
        self.model = self.tokenizer.model
        # the short cuts are for a lower-casing tokenizer that splits letters from marks
        probe = lambda x: self.tokenizer.encode(x, add_special_tokens=False).ids
        self.plain = probe("AbÉé.,") == probe("abéé") + probe(".,") and probe("é") == self._letters("é")

    def _letters(self, word: str) -> list[int]:
        written = word if word.isascii() else word.encode().decode("latin-1").translate(_BYTE_CHARS)
        return [t.id for t in self.model.tokenize(written)]

    def __missing__(self, word: bytes) -> bytes:
        if self.plain and word[-1:] in (b".", b",") and word[-2:-1].islower():
            return self[word[:-1]] + self[word[-1:]]
        if len(self) >= CACHED_WORDS // 2:
            self.old = dict(self)
            self.clear()
        if (ids := self.old.pop(word, None)) is not None:
            self[word] = ids
            return ids
        text = word.decode()
        if self.plain and (parts := _MARKED.fullmatch(text)):
            letters, marks = parts[1].lower(), parts[2]
            if marks or letters != text:
                return self[letters.encode()] + (self[marks.encode()] if marks else b"")
            found = self._letters(letters)
        else:
            found = self.tokenizer.encode(text, add_special_tokens=False).ids
        ids = self[word] = struct.pack(f"<{len(found)}I", *found)
        return ids

    def encode(self, text: bytes) -> bytes:
        if self.plain and b"<|" not in text:  # special tokens keep their case
            text = text.lower()
        return b"".join(map(self.__getitem__, text.split()))

    def encode_all(self, texts: pa.Array, end: bytes) -> pa.ListArray:
        """Lists of the ids of texts (strings, no nulls), with ``end`` after each."""
        if self.plain:
            texts = pc.if_else(pc.match_substring(texts, "<|"), texts, pc.ascii_lower(texts))
        split = pc.ascii_split_whitespace(texts)
        words = split.flatten().dictionary_encode()
        ids = [*map(self.__getitem__, words.dictionary.cast(pa.binary()).to_numpy(zero_copy_only=False)), end]
        counts = np.fromiter(map(len, ids), np.int64, len(ids)) // 4
        known = pa.ListArray.from_arrays(pa.array(np.r_[0, np.cumsum(counts)], pa.int32()), pa.array(np.frombuffer(b"".join(ids), "<i4")))
        ends = np.cumsum(pc.list_value_length(split).to_numpy())
        dealt = np.insert(words.indices.to_numpy(), ends, len(ids) - 1)
        last = np.r_[0, np.cumsum(counts[dealt])][np.r_[0, ends + np.arange(1, ends.size + 1)]]
        return pa.ListArray.from_arrays(pa.array(last, pa.int32()), known.take(pa.array(dealt)).flatten())


_encoders: dict[str, WordEncoder] = {}


def _encoder(path: str) -> WordEncoder:
    if path not in _encoders:
        _encoders[path] = WordEncoder(path)
    return _encoders[path]


def _encode(tokenizer_path: str, end_id: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, end = _encoder(tokenizer_path), np.uint32(end_id).astype("<u4").tobytes()
        part, row, start = TaskContext.get().partitionId(), 0, 0
        for b in batches:
            texts = pc.fill_null(b.column(1), "")
            for piece in by_bytes([range(n) for n in pc.binary_length(texts).to_pylist()], PIECE_BYTES):
                lists = encoder.encode_all(texts[piece.start:piece.stop], end)
                n = pc.list_value_length(lists).to_numpy().astype(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([part] * n.size, pa.int32()), pa.array(np.arange(row, row + n.size)), b.column(0)[piece.start:piece.stop],
                     pa.array(start + np.cumsum(n) - n), pa.array(n), lists],
                    ["part", "row", "_id", "part_start", "n_tokens", "ids"])
                row, start = row + n.size, start + int(n.sum())
                pa.default_memory_pool().release_unused()

    return run


def write_tokens(docs: DataFrame, path: str, tokenizer_path: str, end_id: int, id_col: str = "doc_id",
                 text_col: str = "text") -> None:
    """Encode and write (part, row, id, part_start, n_tokens, ids)."""
    rows = docs.select(F.col(f"`{id_col}`").alias("_id"), F.col(f"`{text_col}`").alias("_text"), F.monotonically_increasing_id().alias("_tie"))
    ranged = rows.repartitionByRange(shuffle_partitions(docs.sparkSession), "_id", "_tie").sortWithinPartitions("_id", "_tie")
    schema = T.StructType().add("part", "integer").add("row", "long").add("_id", rows.schema["_id"].dataType) \
        .add("part_start", "long").add("n_tokens", "long").add("ids", T.ArrayType(T.IntegerType()))
    coded = ranged.select("_id", "_text").mapInArrow(_encode(tokenizer_path, end_id), schema)
    with arrow_rows(docs.sparkSession, ARROW_ROWS):
        coded.withColumnRenamed("_id", id_col).write.options(**{
            "compression": "zstd",
            "parquet.writer.version": "v2",              # delta encodings where there is no dictionary
            "parquet.enable.dictionary": "true",
            "parquet.dictionary.page.size": str(1 << 20),  # holds every id of a vocabulary of 250,000
            "parquet.block.size": str(ROW_GROUP_BYTES),
            "parquet.page.size": str(PAGE_BYTES),
            "parquet.page.row.count.limit": str(PAGE_ROWS),
        }).parquet(path)


def read_tokens(spark: SparkSession, path: str, id_col: str = "doc_id") -> DataFrame:
    """(id, start, n_tokens, ids): filters on the id reach row groups and pages,
    and without ``ids`` only metadata pages are read."""
    files = spark.read.parquet(path)
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    totals = files.groupBy("part").agg(F.sum("n_tokens").alias("_n")) \
        .select("part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start0"))  # one row a file
    return files.join(F.broadcast(totals), "part") \
        .select(id_col, (F.col("_start0") + F.col("part_start")).alias("start"), "n_tokens", "ids")


def _checksums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        names = b.schema.names
        ids = b.column(names.index("ids"))
        at, values = ids.offsets.to_numpy(), ids.values.to_numpy().astype("<u4", copy=False)
        crc = [zlib.crc32(values[s:e]) for s, e in zip(at[:-1], at[1:])]
        yield pa.RecordBatch.from_arrays([*[b.column(k) for k, c in enumerate(names) if c != "ids"], pa.array(crc, pa.int64())],
                                         [*[c for c in names if c != "ids"], "ids_crc32"])


def checksums(tokens: DataFrame) -> DataFrame:
    """``tokens`` with ``ids_crc32`` (over little-endian 32-bit ids) for ``ids``."""
    return tokens.mapInArrow(_checksums, tokens.drop("ids").schema.add("ids_crc32", "long"))
