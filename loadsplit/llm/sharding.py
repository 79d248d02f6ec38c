"""Sharding by global byte-size prefix sums: rows are put in id order over range
parts, per-part totals give each part its offset, and the global offset of a
row is cut at equal targets into contiguous, balanced shards.

Only (id, size, checksum) rows are moved, never the texts. The range parts are
written once, so totals and offsets see the same parts. What is broadcast has
one row per range part or per shard.

Defined cases: a null or empty text has size 1 (and the checksum of no bytes);
null ids come first; equal ids are told apart by input position, so a hot id is
spread over parts; repeated rows each get their own slot; an empty table gives
an empty result. Input columns other than id and text are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import shuffle_partitions, stage

N_SHARDS = 16
PARTS_PER_TASK = 4


def row_size(text: Column) -> Column:
    """UTF-8 bytes of the text plus one separator byte."""
    return F.coalesce(F.octet_length(text), F.lit(0)).cast("long") + 1


def range_parts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Staged rows (id, size, text_crc32, _tie, _part) in range parts of the id."""
    rows = docs.select(F.col(id_col).alias("_id"), row_size(F.col(text_col)).alias("size"),
                       F.crc32(F.coalesce(F.col(text_col), F.lit("")).cast("binary")).alias("text_crc32"),
                       F.monotonically_increasing_id().alias("_tie"))
    n = PARTS_PER_TASK * shuffle_partitions(docs.sparkSession)
    ranged = rows.repartitionByRange(n, "_id", "_tie")
    return stage(ranged.withColumn("_part", F.spark_partition_id()), "shard-sizes")


def global_offsets(parts: DataFrame) -> DataFrame:
    """``parts`` with _start (bytes before the row) and _row (rows before it)."""
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    totals = parts.groupBy("_part").agg(F.sum("size").alias("_bytes"), F.count(F.lit(1)).alias("_rows"))
    totals = totals.select("_part", F.coalesce(F.sum("_bytes").over(before), F.lit(0)).alias("_bytes0"),
                           F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_rows0"))
    within = Window.partitionBy("_part").orderBy("_id", "_tie")
    return parts.select("*", F.coalesce(F.sum("size").over(within.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_s"),
                        (F.row_number().over(within) - 1).cast("long").alias("_r")) \
        .join(F.broadcast(totals), "_part") \
        .select("_id", "size", "text_crc32", (F.col("_bytes0") + F.col("_s")).alias("_start"),
                (F.col("_rows0") + F.col("_r")).alias("_row"))


def assign_shards(docs: DataFrame, n_shards: int = N_SHARDS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: id, size, text_crc32, law, shard, slot, grown_shard.
    A row goes to the shard whose target range holds its first byte, so shard
    sizes differ from the target by less than one row."""
    parts = range_parts(docs, id_col, text_col)
    total = parts.agg(F.sum("size")).first()[0] or 1
    rows = global_offsets(parts).withColumn("shard", F.expr(f"cast(cast(_start as decimal(38,0)) * {n_shards} div {total} as int)"))
    first = rows.groupBy("shard").agg(F.min("_row").alias("_first"))
    return rows.join(F.broadcast(first), "shard").select(
        F.col("_id").alias(id_col), "size", "text_crc32", F.lit("bytes").alias("law"), "shard",
        (F.col("_row") - F.col("_first")).alias("slot"), F.lit(None).cast("int").alias("grown_shard"))


def write_shards(docs: DataFrame, assignment: DataFrame, path: str, id_col: str = "doc_id") -> None:
    """Write the documents as ``path/shard=K``, rows of a shard in slot order.
    Ids must be unique here. Ranges of (shard, slot) keep one shard's files in
    several tasks."""
    spark = docs.sparkSession
    rows = docs.join(assignment.select(id_col, "shard", "slot"), id_col)
    rows.repartitionByRange(shuffle_partitions(spark), "shard", "slot").sortWithinPartitions("shard", "slot") \
        .write.partitionBy("shard").parquet(path)
