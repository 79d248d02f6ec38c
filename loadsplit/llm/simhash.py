"""SimHash near-dedup by segment-popcount embedding: a 64-bit fingerprint is
mapped to the bit counts of its 32 two-bit segments. Fingerprints that differ
in k bits are at most k apart in Manhattan distance there, so a grid range join
under that distance finds all links, which are then verified on the bits.

The grid: segments are dealt into k + 3 groups. Points at distance k or less
agree wholly on at least three groups, so each point is put into one cell for
every choice of three groups. Cells are joined inside tasks: rows are ordered
by total bit count, only rows within k of each other in it are compared, the
Manhattan distance is checked and then the bits. A task returns a spanning
forest of its cell, never all pairs. Cells of more than ``cell_rows``
fingerprints are split into blocks, and every pair of blocks is a task group of
its own, so no cell is dropped or held whole.

Equal fingerprints are one node; links between nodes become components by
staged star steps, nothing is collected.

Defined cases: null, empty and blank texts have fingerprint zero and are linked
like any other; texts of fewer words than a shingle are one shingle; texts are
read whole, in pieces; null ids are ignored as smallest id (a component of null
ids only has a null id); repeated rows keep their rows in ``components``, and
``drop_near_duplicates`` keeps one row of a component, also if ids repeat or
are null; empty tables give empty results.
Columns other than id and text are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations, islice

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import grouped, stage, utf8
from .components import connected_components

SHINGLE = 3
MAX_BITS = 3
SEED = 42
CELL_ROWS = 20_000
HOT = 10_000
PIECE = 1 << 18
SEGMENTS = 32
#: low bit of every two-bit segment
LOW = 0x5555555555555555


# --- fingerprints -----------------------------------------------------------------

def fingerprint(text: bytes, shingle: int = SHINGLE) -> int:
    """Majority bits of the shingle hashes of the lower-cased (A-Z) words."""
    words = text.lower().split()
    if not words:
        return 0
    n = max(1, len(words) - shingle + 1)
    grams = map(b" ".join, zip(*(words[k:] for k in range(shingle)))) if len(words) >= shingle else iter([b" ".join(words)])
    digest, ones = xxhash.xxh64_intdigest, np.zeros(64, np.int64)
    for at in range(0, n, PIECE):
        h = np.fromiter([digest(g, SEED) for g in islice(grams, PIECE)], np.uint64, min(PIECE, n - at))
        ones += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(2 * ones > n, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE) -> DataFrame:
    """(_id, _fp): the fingerprint as a signed long."""
    rows = docs.select(F.col(f"`{id_col}`").alias("_id"), F.col(f"`{text_col}`").alias("_text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fp = np.array([fingerprint(t, shingle) for t in utf8(b.column(1))], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(fp)], ["_id", "_fp"])

    return rows.mapInArrow(run, rows.select("_id", F.lit(0).cast("long").alias("_fp")).schema)


# --- grid range join ----------------------------------------------------------------

def segment_counts(fp: Column) -> Column:
    """The embedding, packed: each two-bit field holds the bit count of that segment."""
    high = F.shiftrightunsigned(fp, 1)
    both, one = high.bitwiseAND(fp).bitwiseAND(F.lit(LOW)), high.bitwiseXOR(fp).bitwiseAND(F.lit(LOW))
    return F.shiftleft(both, 1).bitwiseOR(one)


def _cells(counts: Column, max_bits: int) -> Column:
    """One cell per choice of three of the max_bits + 3 segment groups."""
    n = max_bits + 3
    group = [sum(3 << (2 * s) for s in range(SEGMENTS) if s * n // SEGMENTS == g) for g in range(n)]
    cells = []
    for k, chosen in enumerate(combinations(group, 3)):
        mask = sum(chosen)
        signed = mask - (1 << 64) if mask >> 63 else mask
        cells.append(F.xxhash64(F.lit(k), counts.bitwiseAND(F.lit(signed).cast("long"))))
    return F.array(*cells)


def near(a: np.ndarray, b: np.ndarray, max_bits: int) -> np.ndarray:
    """True where a and b (uint64) differ in at most max_bits bits: first the
    Manhattan distance of the segment counts, then the bits."""
    low = np.uint64(LOW)
    one = np.uint64(1)
    count = lambda v: ((((v >> one) & v & low) << one) | (((v >> one) ^ v) & low))
    x = count(a) ^ count(b)
    # counts are 0, 1 or 2: equal counts give 0, a difference of two gives binary 10
    manhattan = np.bitwise_count((x | (x >> one)) & low) + np.bitwise_count((x >> one) & ~x & low)
    return (manhattan <= max_bits) & (np.bitwise_count(a ^ b) <= max_bits)


def _merge(label: np.ndarray, i: np.ndarray, j: np.ndarray) -> None:
    """Give the ends of all pairs, and what hangs on them, their smallest label."""
    while i.size:
        low = np.minimum(label[i], label[j])
        np.minimum.at(label, label[i], low)
        np.minimum.at(label, label[j], low)
        while (label[label] != label).any():
            label[:] = label[label]
        open_ = label[i] != label[j]
        i, j = i[open_], j[open_]


def _forest(fp: np.ndarray, count: np.ndarray, max_bits: int, rows: int = 128) -> np.ndarray:
    """Labels (row numbers) of the linked rows of one large cell, rows ordered
    by total bit count; stretches that are linked already are not compared."""
    label = np.arange(fp.size)
    end = np.searchsorted(count, count + max_bits, "right")
    for at in range(0, fp.size, rows):
        to, stop = min(at + rows, fp.size), int(end[min(at + rows, fp.size) - 1])
        if (label[at:stop] == label[at]).all():
            continue
        i, j = np.nonzero(near(fp[at:to, None], fp[None, at:stop], max_bits))
        i, j = i + at, j + at
        ahead = (i < j) & (label[i] != label[j])
        _merge(label, i[ahead], j[ahead])
    return label


def _link(max_bits: int, small: int = 64):
    """mapInArrow function over rows sorted by (_g, _n): edges (a, b) that span
    the linked fingerprints of each cell."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in grouped(batches, "_g"):
            g = t.column("_g").to_numpy()
            fp = t.column("_fp").to_numpy().view(np.uint64)
            count = t.column("_n").to_numpy()
            first = np.flatnonzero(np.r_[True, g[1:] != g[:-1]])
            size = np.diff(np.r_[first, g.size])
            label = np.arange(g.size)
            # small cells: all at once, row against the row d places on
            left = np.repeat(first + size, size) - np.arange(g.size) - 1
            left[np.repeat(size > small, size)] = 0
            i, d = np.flatnonzero(left), 1
            pairs: list[tuple[np.ndarray, np.ndarray]] = []
            while i.size:
                close = i[count[i + d] - count[i] <= max_bits]
                hit = close[near(fp[close], fp[close + d], max_bits)]
                pairs.append((hit, hit + d))
                d += 1
                i = i[left[i] >= d]
            if pairs:
                _merge(label, np.concatenate([p[0] for p in pairs]), np.concatenate([p[1] for p in pairs]))
            for k in np.flatnonzero(size > small):
                at, to = first[k], first[k] + size[k]
                label[at:to] = at + _forest(fp[at:to], count[at:to], max_bits)
            own = label != np.arange(g.size)
            yield pa.RecordBatch.from_arrays(
                [pa.array(fp[own].view(np.int64)), pa.array(fp[label[own]].view(np.int64))], ["a", "b"])

    return run


def links(fps: DataFrame, max_bits: int = MAX_BITS, cell_rows: int = CELL_ROWS) -> DataFrame:
    """Edges (a, b) between the distinct fingerprints ``_fp`` that connect just
    what lies within max_bits bits of each other."""
    points = fps.select("_fp", F.bit_count("_fp").cast("int").alias("_n"),
                        F.explode(_cells(segment_counts(F.col("_fp")), max_bits)).alias("_cell"))
    large = points.groupBy("_cell").count().where(F.col("count") > cell_rows) \
        .select("_cell", F.ceil(F.col("count") / cell_rows).cast("int").alias("_blocks"))
    dealt = points.join(stage(large, "simhash-large-cells"), "_cell", "left") \
        .withColumn("_blocks", F.coalesce("_blocks", F.lit(1))) \
        .withColumn("_own", F.pmod(F.xxhash64("_fp"), F.col("_blocks")).cast("int")) \
        .withColumn("_other", F.explode(F.sequence(F.lit(0), F.col("_blocks") - 1)))
    cell = F.when(F.col("_blocks") == 1, F.col("_cell")).otherwise(
        F.xxhash64("_cell", F.least("_own", "_other"), F.greatest("_own", "_other")))
    rows = dealt.select(cell.alias("_g"), "_n", "_fp").repartition("_g").sortWithinPartitions("_g", "_n", "_fp")
    return rows.mapInArrow(_link(max_bits), "a long, b long")


# --- components and dedup -------------------------------------------------------------

def components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE,
               max_bits: int = MAX_BITS, cell_rows: int = CELL_ROWS) -> DataFrame:
    """One row per document: id, fingerprint (16 hex digits), component_id (the
    smallest id that links reach)."""
    marks = stage(fingerprints(docs, id_col, text_col, shingle), "simhash-fingerprints")
    nodes = stage(marks.groupBy("_fp").agg(F.min("_id").alias("_low"), F.count(F.lit(1)).alias("_n")), "simhash-nodes")
    roots = connected_components(stage(links(nodes, max_bits, cell_rows), "simhash-links"))
    linked = nodes.join(roots, nodes["_fp"] == roots["node"]).select("_fp", "_low", "root")
    low = linked.groupBy("root").agg(F.min("_low").alias("_component"))
    named = linked.join(low, "root").select("_fp", "_component")
    classes = stage(nodes.join(named, "_fp", "left").select("_fp", "_n", F.coalesce("_component", "_low").alias("component_id")), "simhash-classes")
    # fewer than HOT fingerprints can each have more than one row in HOT, so
    # these are broadcast whatever the input; all others have few rows a key
    hot = F.broadcast(classes.where(F.col("_n") * HOT > marks.count()).drop("_n"))
    rest = marks.join(hot.select("_fp"), "_fp", "left_anti").join(classes.drop("_n"), "_fp")
    return marks.join(hot, "_fp").unionByName(rest).select(
        F.col("_id").alias(id_col), F.lpad(F.lower(F.hex("_fp")), 16, "0").alias("fingerprint"), "component_id")


def drop_near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """One row of every component, all columns unchanged: the one with the
    smallest id (nulls last), of rows with one id the first by row key. The keys
    are staged with the rows, so every pass sees the same."""
    rows = stage(docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"),
                             F.monotonically_increasing_id().alias("_key")), "simhash-rows")
    own = F.col("_row")[id_col]
    ranked = rows.select(F.struct(own.isNull().alias("none"), own.alias("id"), F.col("_key").alias("key")).alias("_rank"),
                         F.col("_row")[text_col].alias("_text"))
    found = components(ranked, "_rank", "_text", **options)
    stay = found.where(F.col("_rank.key") == F.col("component_id.key")).select(F.col("_rank.key").alias("_key"))
    return rows.join(stay, "_key", "left_semi").select("_row.*")
