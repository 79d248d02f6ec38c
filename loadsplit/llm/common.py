"""Helpers shared by the training-data operators."""

from __future__ import annotations

import contextlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from loadsplit.session import scratch_path, ship  # noqa: F401 - ship is used by the queries and tests

#: fixed values: the ASCII letters whose case the contracts fold
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write once to the shared checkpoint folder and read back: the committed
    files outlive a lost executor, and later passes start from them."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.parquet(path)


@contextlib.contextmanager
def arrow_rows(spark: SparkSession, rows: int) -> Iterator[None]:
    """Batches of at most so many rows to the Python workers, for what runs inside."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    old = spark.conf.get(key)
    spark.conf.set(key, str(rows))
    try:
        yield
    finally:
        spark.conf.set(key, old)


def ascii_lower(c: Column) -> Column:
    """Lower-case A-Z only; every other character keeps its form."""
    return F.translate(c, UPPER, LOWER)


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def utf8(col: pa.Array) -> list[bytes]:
    """UTF-8 bytes of a string column, null as empty."""
    return [b"" if x is None else x for x in col.cast(pa.binary()).to_pylist()]


class Recent(dict):
    """Values by key, made when missing; the older half is forgotten when ``most`` new ones are there."""

    def __init__(self, make, most: int, keep=lambda key: True):
        self.make, self.most, self.keep, self.old = make, most, keep, {}

    def __missing__(self, key):
        value = self.old.get(key)
        if value is None:
            value = self.make(key)
        if self.keep(key):
            self.put(key, value)
        return value

    def put(self, key, value) -> None:
        if len(self) >= self.most:
            self.turn()
        self[key] = value

    def turn(self) -> None:
        self.old = dict(self)
        self.clear()


def by_bytes(texts: list[bytes], most: int) -> Iterator[slice]:
    """Slices of about ``most`` bytes that cover the list; a longer text is alone or ends its slice."""
    at = size = 0
    for k, t in enumerate(texts):
        size += len(t)
        if size >= most:
            yield slice(at, k + 1)
            at, size = k + 1, 0
    if at < len(texts):
        yield slice(at, len(texts))


def text_slices(batch: pa.RecordBatch, column: int, most: int) -> Iterator[pa.RecordBatch]:
    """``batch`` in parts of about ``most`` bytes of a string column; a longer text is alone or ends its part."""
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy()
    ends, at = np.cumsum(sizes, dtype=np.int64), 0
    while at < batch.num_rows:
        to = min(int(np.searchsorted(ends, (ends[at - 1] if at else 0) + most)) + 1, batch.num_rows)
        yield batch.slice(at, to - at)
        at = to


def ranges(starts: np.ndarray, ends: np.ndarray, n: int) -> np.ndarray:
    """Boolean mask of length n that is true inside the half-open intervals."""
    d = np.zeros(n + 1, np.int64)
    np.add.at(d, starts, 1)
    np.add.at(d, ends, -1)
    return np.cumsum(d[:-1]) > 0


def grouped(batches: Iterator[pa.RecordBatch], key: str) -> Iterator[pa.Table]:
    """Tables of whole key groups from batches sorted by ``key``; a group that
    spans batches is held back until its last row has come."""
    held: list[pa.RecordBatch] = []
    for b in batches:
        if not b.num_rows:
            continue
        k = b.column(b.schema.get_field_index(key))
        last = k[b.num_rows - 1]
        if k[0].equals(last) and (not held or _last(held[-1], key).equals(last)):
            held.append(b)
            continue
        eq = k.to_numpy(zero_copy_only=False) == last.as_py()
        cut = int(b.num_rows - eq[::-1].argmin()) if not eq.all() else 0
        yield pa.Table.from_batches([*held, b.slice(0, cut)])
        held = [b.slice(cut)]
    if held:
        yield pa.Table.from_batches(held)


def _last(b: pa.RecordBatch, key: str) -> pa.Scalar:
    return b.column(b.schema.get_field_index(key))[b.num_rows - 1]
