"""Corpus pipeline: quality rules, SimHash near-dedup, substring dedup, benchmark
decontamination, tokens. Each stage is written as Parquet and read again by
the next one.

A document that fails a quality rule goes; of each group of near duplicates the
row with the smallest id stays (one row, also if its id repeats); passages that repeat are cut out of the
texts (a text that has no word left stays as an empty text); contaminated
documents go. All stages but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loadsplit.llm import decontaminate, piece_nbest, quality_rules, simhash, substring_dedup
from loadsplit.llm.common import ship, stage, table
from loadsplit.llm.queries import vocabulary


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality_rules.keep_passing(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.drop_near_duplicates(docs)


def passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    cut = substring_dedup.drop_repeats(docs)
    return cut.withColumn("n_chars", F.char_length("text").cast("long")).select(*docs.columns)


def benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Best segmentation of every text with its score and the scores of the n best."""
    coded = piece_nbest.encode(docs, vocabulary("piece_bpe_32k.model"), keep=("doc_id", "lang", "source"))
    return coded.select("doc_id", "lang", "source", F.size("ids").cast("long").alias("n_tokens"), "ids", "score",
                        F.col("nbest.score").alias("nbest_scores"))


STAGES = [
    ("quality rules", quality),
    ("simhash near-dedup", near_dedup),
    ("substring dedup", passages),
    ("benchmark decontamination", benchmark),
    ("piece tokens", tokens),
]

#: hashing, the near-duplicate groups and the segmentations have no SQL form
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship(spark)
    docs = table(spark, sf_dir, "documents")
    for name, step in STAGES:
        docs = stage(step(spark, docs, sf_dir), f"pipeline-{name.replace(' ', '-')}")
    return docs
