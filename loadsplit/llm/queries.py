"""Registered queries of the training-data operators: each applies one operator
with its production parameters to its whole table."""

from __future__ import annotations

import functools

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loadsplit.session import scratch_path

from . import decontaminate, html_text, importance, merkle, piece_nbest, prefix_counts, quality_rules, sharding, simhash, substring_dedup, \
    token_files, toxicity, url_filter
from .common import ship, table

#: fixed values: rules of the url query (verdict, host, path)
URL_RULES = (
    ("allow", "org", "/"),
    ("block", "example.org", "/es/"),
    ("block", "example.org", "/en/1"),
    ("allow", "com", "/fr/"),
    ("block", "com", "/de/"),
)
#: names of the sites whose pages make up the list
LISTED_SITES = ("ads-track", "adult-x", "casino-win", "cheap-pills", "free-bets", "spam-farm")


#: id that ends a document in the token files
END_ID = 2


def vocabulary(name: str) -> str:
    """Place of a public vocabulary file, the same on every machine of a cluster."""
    import public_tokenizers
    return public_tokenizers.path(name)


def op1_toxicity(spark: SparkSession, d: str) -> DataFrame:
    return toxicity.judge(table(spark, d, "documents"), table(spark, d, "labels"))


def op2_token_files(spark: SparkSession, d: str) -> DataFrame:
    path = scratch_path(spark, "token-files")
    token_files.write_tokens(table(spark, d, "documents"), path, vocabulary("word_bpe_49k.json"), END_ID)
    return token_files.checksums(token_files.read_tokens(spark, path))


def op3_quality_rules(spark: SparkSession, d: str) -> DataFrame:
    return quality_rules.judge(table(spark, d, "documents")) \
        .select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "fail_bits",
                "sole_rule", "ablation_gain")


def op4_decontaminate(spark: SparkSession, d: str) -> DataFrame:
    return decontaminate.measure(table(spark, d, "documents"), table(spark, d, "benchmark"))


def op5_piece_nbest(spark: SparkSession, d: str) -> DataFrame:
    return piece_nbest.digest(table(spark, d, "documents"), vocabulary("piece_bpe_32k.model"))


def op6_substring_dedup(spark: SparkSession, d: str) -> DataFrame:
    return substring_dedup.remove_repeats(table(spark, d, "documents"), texts=False).drop("removed")


def op7_shards(spark: SparkSession, d: str) -> DataFrame:
    return sharding.assign_shards(table(spark, d, "documents"))


def op8_html_text(spark: SparkSession, d: str) -> DataFrame:
    return html_text.extract(table(spark, d, "pages"))


def op9_simhash(spark: SparkSession, d: str) -> DataFrame:
    return simhash.components(table(spark, d, "documents"))


def op10_url_filter(spark: SparkSession, d: str) -> DataFrame:
    """The list holds the urls of the pages on LISTED_SITES, whatever their subdomain."""
    pages = table(spark, d, "pages")
    site = F.regexp_extract(url_filter.url_host(F.col("url")), r"([^.]+)\.example\.[a-z]+$", 1)
    return url_filter.filter_urls(pages, pages.where(site.isin(*LISTED_SITES)), URL_RULES)


def op11_importance(spark: SparkSession, d: str) -> DataFrame:
    """Towards the words of the benchmark; a quarter of the documents with 20 words or more is drawn."""
    return importance.resample(table(spark, d, "documents"), table(spark, d, "benchmark")) \
        .select("doc_id", "n_features", "weight", "score", "rank", "n_words")


def op12_merkle(spark: SparkSession, d: str) -> DataFrame:
    """Rows whose id's checksum is divisible by 7 are presented with one character more than they have."""
    n, tampered = F.col("n_chars"), F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 0
    return merkle.manifest(table(spark, d, "documents"), {"n_chars": F.when(tampered, n + 1).otherwise(n)}) \
        .select("doc_id", "leaf", "subroot", "root", F.sha2(F.lower(F.hex("proof")), 256).alias("proof_sha256"), "folded_root", "verified")


def op13_prefix_counts(spark: SparkSession, d: str) -> DataFrame:
    return prefix_counts.count_tokens(table(spark, d, "documents"), vocabulary("byte_bpe_50k.json")) \
        .select("doc_id", "n_bytes", "n_tokens", "over_limit", "fit_chars")


def _shipped(query):
    @functools.wraps(query)
    def run(spark: SparkSession, d: str) -> DataFrame:
        ship(spark)
        return query(spark, d)

    return run


QUERIES = {q.__name__: _shipped(q) for q in (
    op1_toxicity, op2_token_files, op3_quality_rules, op4_decontaminate, op5_piece_nbest, op6_substring_dedup, op7_shards,
    op8_html_text, op9_simhash, op10_url_filter, op11_importance, op12_merkle, op13_prefix_counts)}
