"""Importance resampling towards a target distribution, over hashed word n-grams.

Every run of one to ``ngram`` consecutive words is a feature; its bucket is the
CRC-32 of its bytes modulo the number of buckets. The gain of a bucket says how
much likelier it is in the target than in the documents; a document's weight is
the mean gain of its features, its score the weight plus Gumbel noise fixed by
its id, and the highest scores are drawn, which samples without replacement in
proportion to the weights.

Texts are taken in batches of some megabytes: the batch is joined with a
separator that no word can hold, one regular-expression pass finds the words of
all its documents, ``searchsorted`` on the documents' offsets gives each word its
document, and n-grams whose first and last word are of different documents are
masked before ``bincount``. A text longer than a batch is a batch of its own
whose words are taken in blocks, the last words of a block carried into the
next. The checksum of an n-gram comes from those of its words. Buckets are counted per task and added up in Spark; the gains (one number
a bucket) are all that reaches the driver or is sent to the tasks.

Defined cases: a text that is null, empty or without words has no feature, the
weight 0 and, below ``min_words``, no rank; a null id counts as an empty one for
the noise and is the last of its ties; rows that tie in score and id are ranked
by features and then by input position; repeated rows are counted and ranked as
often as they come; an empty target or an empty table gives gains of their add-one
smoothing and an empty table no rows. Other columns are not read unless kept.
"""

from __future__ import annotations

import functools
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import by_bytes, stage, utf8
from .positions import number_rows

N_BUCKETS = 10_000
NGRAM = 2
SHARE = 25       # per cent of the documents that can be drawn
MIN_WORDS = 20   # fewer words: never drawn
SEED = 7

BATCH_BYTES = 4 << 20    # of joined texts, and of what one pass of the pattern takes
SEPARATOR = b"\x00"
#: fixed value: words after lower-casing A-Z, on UTF-8 bytes
_WORD = rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_TOKEN = re.compile(_WORD + rb"|\x00")
_GAP = re.compile(rb"[\x00-\x2F\x3A-\x60\x7B-\x7F]")
_SEPARATOR_CRC = zlib.crc32(SEPARATOR)
#: lower case; a separator inside a text becomes a blank, which is no word either
_FOLD = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ" + SEPARATOR, b"abcdefghijklmnopqrstuvwxyz ")


def _zero_bytes(most: int) -> np.ndarray:
    """[n, k, b]: what n zero bytes make of a checksum whose k-th byte is b and whose others are 0."""
    step = np.array([zlib.crc32(bytes([b])) for b in range(256)], np.uint32) ^ np.uint32(zlib.crc32(b"\x00"))
    shifts = [np.arange(256, dtype=np.uint32)[None, :] << np.array([[0], [8], [16], [24]], np.uint32)]
    for _ in range(most):
        shifts.append((shifts[-1] >> 8) ^ step[shifts[-1] & 255])
    return np.array(shifts)


_ZEROS = _zero_bytes(64)


def _after(crc: np.ndarray, next_crc: np.ndarray, size: np.ndarray) -> np.ndarray:
    """CRC-32 of two byte strings in a row, from their checksums and the second's length."""
    crc, size = crc.copy(), size.copy()
    while (far := np.flatnonzero(size >= len(_ZEROS))).size:
        crc[far] = _shifted(crc[far], np.full(far.size, len(_ZEROS) - 1))
        size[far] -= len(_ZEROS) - 1
    return _shifted(crc, size) ^ next_crc


def _shifted(crc: np.ndarray, size: np.ndarray) -> np.ndarray:
    return _ZEROS[size, 0, crc & 255] ^ _ZEROS[size, 1, crc >> 8 & 255] ^ _ZEROS[size, 2, crc >> 16 & 255] ^ _ZEROS[size, 3, crc >> 24]


def features(texts: list[bytes], ngram: int, n_buckets: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(n-gram length, documents, buckets) of all n-grams of a batch, in blocks."""
    joined = SEPARATOR.join([t.translate(_FOLD) for t in texts])
    at = first_doc = 0
    crc, size, doc = np.empty(0, np.uint32), np.empty(0, np.int64), np.empty(0, np.int64)
    while at < len(joined):
        gap = _GAP.search(joined, at + BATCH_BYTES) if at + BATCH_BYTES < len(joined) else None
        end = gap.start() if gap else len(joined)
        found = _TOKEN.findall(joined, at, end)
        at, old = end, crc.size  # the words kept from the last block come first; their own n-grams are counted
        sums = np.fromiter(map(zlib.crc32, found), np.uint32, len(found))
        sizes = np.fromiter(map(len, found), np.int64, len(found))
        offsets = np.flatnonzero((sizes == 1) & (sums == _SEPARATOR_CRC))  # where documents end among the tokens
        docs = first_doc + np.searchsorted(offsets, np.arange(len(found)), "right")
        first_doc += offsets.size
        crc, size, doc = (np.r_[kept, np.delete(new, offsets)] for kept, new in ((crc, sums), (size, sizes), (doc, docs)))
        gram = crc
        for n in range(1, min(ngram, crc.size) + 1):
            if n > 1:
                blank = _after(gram[:-1], np.uint32(zlib.crc32(b" ")), np.ones(gram.size - 1, np.int64))
                gram = _after(blank, crc[n - 1:], size[n - 1:])
            new = slice(max(old - n + 1, 0), None)
            head, tail = doc[:gram.size][new], doc[n - 1:][new]
            inside = head == tail
            yield n, head[inside], gram[new][inside] % n_buckets
        keep = slice(max(crc.size - ngram + 1, 0), None)
        crc, size, doc = crc[keep], size[keep], doc[keep]


def _bucket_counts(batches: Iterator[pa.RecordBatch], ngram: int, n_buckets: int) -> Iterator[pa.RecordBatch]:
    n = np.zeros(n_buckets, np.int64)
    for b in batches:
        texts = utf8(b.column(0))
        for piece in by_bytes(texts, BATCH_BYTES):
            for _, _, buckets in features(texts[piece], ngram, n_buckets):
                n += np.bincount(buckets, minlength=n_buckets)
    used = np.flatnonzero(n)
    yield pa.RecordBatch.from_arrays([pa.array(used, pa.int32()), pa.array(n[used])], ["bucket", "n"])


def bucket_counts(docs: DataFrame, ngram: int = NGRAM, n_buckets: int = N_BUCKETS, text_col: str = "text") -> np.ndarray:
    """Features of the whole table in each bucket."""
    run = functools.partial(_bucket_counts, ngram=ngram, n_buckets=n_buckets)
    found = docs.select(F.col(f"`{text_col}`").alias("text")).mapInArrow(run, "bucket int, n long")
    n = np.zeros(n_buckets, np.int64)
    for bucket, count in found.groupBy("bucket").agg(F.sum("n")).collect():  # one row a bucket
        n[bucket] = count
    return n


def bucket_gains(raw: np.ndarray, target: np.ndarray) -> np.ndarray:
    """floor(1000 ln) of each bucket's share of the target over its share of the raw documents, add-one smoothed."""
    s, t, k = raw.astype(float), target.astype(float), float(raw.size)
    return np.floor(1000 * np.log((t + 1) * (s.sum() + k) / ((s + 1) * (t.sum() + k)))).astype(np.int64)


def _weights(batches: Iterator[pa.RecordBatch], gains: np.ndarray, ngram: int) -> Iterator[pa.RecordBatch]:
    for b in batches:
        texts = utf8(b.column(0))
        for piece in by_bytes(texts, BATCH_BYTES):
            m = piece.stop - piece.start
            n_words, n_features, total = (np.zeros(m, np.int64) for _ in range(3))
            for n, doc, bucket in features(texts[piece], ngram, gains.size):
                seen = np.bincount(doc, minlength=m)
                n_features += seen
                n_words += seen if n == 1 else 0
                total += np.bincount(doc, gains[bucket], m).astype(np.int64)  # whole numbers below 2**53
            rows = b.slice(piece.start, m)
            yield pa.RecordBatch.from_arrays(
                [*rows.columns[1:], pa.array(n_words), pa.array(n_features), pa.array(total // np.maximum(n_features, 1))],
                [*rows.schema.names[1:], "n_words", "n_features", "weight"])


def gumbel(id_text: Column, seed: int) -> Column:
    """Gumbel noise in thousandths, fixed by the seed and the id."""
    h = F.conv(F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(id_text, F.lit(""))), 256), 1, 8), 16, 10).cast("double")
    return F.floor(F.lit(-1000.0) * F.log(-F.log((h + 0.5) / F.lit(4294967296.0))))


def scores(docs: DataFrame, target: DataFrame, ngram: int = NGRAM, n_buckets: int = N_BUCKETS, seed: int = SEED, id_col: str = "doc_id",
           text_col: str = "text", target_col: str = "text", keep: tuple[str, ...] = ()) -> DataFrame:
    """Per document: id, kept columns, n_words, n_features, weight and score."""
    gains = bucket_gains(bucket_counts(docs, ngram, n_buckets, text_col), bucket_counts(target, ngram, n_buckets, target_col))
    rows = docs.select(F.col(f"`{text_col}`").alias("_text"), F.col(f"`{id_col}`").alias("_id"),
                       *[F.col(f"`{c}`").alias(f"_kept_{k}") for k, c in enumerate(keep)])
    schema = rows.drop("_text").schema.add("n_words", "long").add("n_features", "long").add("weight", "long")
    found = rows.mapInArrow(functools.partial(_weights, gains=gains, ngram=ngram), schema)
    return found.withColumn("score", (F.col("weight") + gumbel(F.col("_id").cast("string"), seed)).cast("long"))


def resample(docs: DataFrame, target: DataFrame, share: int = SHARE, min_words: int = MIN_WORDS, ngram: int = NGRAM,
             n_buckets: int = N_BUCKETS, seed: int = SEED, id_col: str = "doc_id", text_col: str = "text",
             target_col: str = "text", keep: tuple[str, ...] = ()) -> DataFrame:
    """``scores`` with ``rank``: 1, 2, 3... for the drawn documents, null for the rest."""
    found = stage(scores(docs, target, ngram, n_buckets, seed, id_col, text_col, target_col, keep), "importance-scores")
    able = F.col("n_words") >= min_words
    in_line = number_rows(found.where(able), [F.col("score").desc(), F.col("_id").asc_nulls_last(), F.col("n_features")], "rank")
    n_drawn = found.where(able).count() * share // 100
    ranked = in_line.withColumn("rank", F.when(F.col("rank") < n_drawn, F.col("rank") + 1)) \
        .unionByName(found.where(~able).withColumn("rank", F.lit(None).cast("long")))
    return ranked.select(F.col("_id").alias(id_col), *[F.col(f"_kept_{k}").alias(c) for k, c in enumerate(keep)],
                         "n_words", "n_features", "weight", "score", "rank")


def draw(docs: DataFrame, target: DataFrame, **options) -> DataFrame:
    """The drawn documents with all their columns and their ``rank``."""
    rest = tuple(c for c in docs.columns if c != options.get("id_col", "doc_id"))
    drawn = resample(docs, target, keep=rest, **options)
    # by position: a column of the documents may have the name of a measure
    names = [f"_c{k}" for k in range(len(drawn.columns))]
    named = dict(zip([options.get("id_col", "doc_id"), *rest], names))
    return drawn.toDF(*names).where(F.col(names[-1]).isNotNull()) \
        .select(*[F.col(named[c]).alias(c) for c in docs.columns if c != "rank"], F.col(names[-1]).alias("rank"))
