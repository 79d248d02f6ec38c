"""URL filters: a blocked Bloom filter of listed canonical URLs passes possible
hits to an exact hash join that removes false positives; host/path rules that
fit an url come before the list.

The Bloom filter is a table of 256-bit blocks (four longs). A key's hash picks
one block and eight bits in it, so a probe touches one row. It has a block for some
twenty keys, however long the list: up to ``max_blocks`` blocks are broadcast, more
are met by block number in a shuffle join. Pages are read once: what is judged
of them is staged with the filter's answer.

Defined cases: a null url, or one without ``://``, has empty host and path, no
canonical form and no list hit (verdict ``allow`` unless a rule with an empty
host fits, which rules cannot have). Null and repeated keys keep their rows.
An empty list blocks nothing; an empty table gives an empty result. Input
columns other than the key and the url are not read.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import ascii_lower, stage

#: (verdict, host, path) rules
Rule = tuple[str, str, str]

# query keys that do not name content
TRACKING = r"(?:utm_[a-z]+|ref|gclid|fbclid)"
BITS_PER_KEY = 12
PROBES = 8
MAX_BLOCKS = 1 << 15


def url_host(url: Column) -> Column:
    return F.coalesce(ascii_lower(F.regexp_extract(url, r"://([^/?#]*)([^?#]*)", 1)), F.lit(""))


def url_path(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"://([^/?#]*)([^?#]*)", 2), F.lit(""))


def canonical_url(url: Column) -> Column:
    """Host without ``www.``, path without trailing slash, query without
    tracking keys; no scheme, no fragment. Null if the url has no host."""
    host = F.regexp_replace(url_host(url), r"^www\.", "")
    path = F.regexp_replace(url_path(url), r"/+$", "")
    query = F.coalesce(F.regexp_extract(url, r"://[^?#]*\?([^#]*)", 1), F.lit(""))
    query = F.regexp_replace(F.concat(F.lit("&"), query), rf"&{TRACKING}=[^&]*", "")
    query = F.regexp_replace(F.regexp_replace(query, r"&+", "&"), r"^&|&$", "")
    return F.when(host != "", F.concat(host, path, F.when(query != "", F.concat(F.lit("?"), query)).otherwise("")))


def match_rule(host: Column, path: Column, rules: Sequence[Rule]) -> tuple[Column, Column]:
    """(rule, verdict) of the longest fitting rule, nulls if none fits."""
    ordered = sorted(rules, key=lambda r: -len(r[1] + r[2]))
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for v, h, p in reversed(ordered):
        fits = ((host == h) | host.endswith(f".{h}")) & path.startswith(p)
        rule = F.when(fits, F.lit(h + p)).otherwise(rule)
        verdict = F.when(fits, F.lit(v)).otherwise(verdict)
    return rule, verdict


def _address(key: Column, n_blocks: int) -> list[Column]:
    """Block number and the four 64-bit masks of a key."""
    h, g = F.xxhash64(key), F.xxhash64(key, F.lit("bits"))
    masks = []
    for word in range(4):
        places = [F.shiftrightunsigned(g, 6 * (PROBES // 4 * word + i)).bitwiseAND(F.lit(63)) for i in range(PROBES // 4)]
        bits = [F.call_function("shiftleft", F.lit(1).cast("long"), p.cast("int")) for p in places]
        masks.append(reduce(lambda a, b: a.bitwiseOR(b), bits).alias(f"_m{word}"))
    return [F.pmod(h, F.lit(n_blocks)).cast("int").alias("_block"), *masks]


def blocked_bloom(keys: DataFrame, key: str) -> tuple[DataFrame, int]:
    """(block table, number of blocks) of the distinct non-null keys; a row has 36 bytes."""
    n = keys.select(F.approx_count_distinct(key)).first()[0]
    n_blocks = max(1, -(-n * BITS_PER_KEY // 256))
    words = keys.where(F.col(key).isNotNull()).select(*_address(F.col(key), n_blocks))
    return words.groupBy("_block").agg(*[F.bit_or(f"_m{i}").alias(f"_w{i}") for i in range(4)]), n_blocks


def possible_hits(df: DataFrame, key: str, blocks: DataFrame, n_blocks: int, max_blocks: int = MAX_BLOCKS) -> DataFrame:
    """``df`` with boolean ``_possible``: false means the key is not listed. At most
    ``max_blocks`` blocks (1.2 MB) are broadcast; rows without a key need no block."""
    address = df.select("*", *_address(F.col(key), n_blocks))
    if n_blocks > max_blocks:  # keyless rows would all meet in one block
        spread = F.when(F.col(key).isNull(), -1 - F.pmod(F.monotonically_increasing_id(), F.lit(n_blocks))).otherwise(F.col("_block"))
        address = address.withColumn("_block", spread.cast("int"))
    probe = address.join(F.broadcast(blocks) if n_blocks <= max_blocks else blocks, "_block", "left")
    inside = reduce(lambda a, b: a & b, [F.col(f"_w{i}").bitwiseAND(F.col(f"_m{i}")) == F.col(f"_m{i}") for i in range(4)])
    drop = ["_block", *[f"_{x}{i}" for x in "wm" for i in range(4)]]
    return probe.withColumn("_possible", F.coalesce(inside & F.col(key).isNotNull(), F.lit(False))).drop(*drop)


def filter_urls(pages: DataFrame, listed: DataFrame, rules: Sequence[Rule], id_col: str = "page_id",
                url_col: str = "url", list_col: str = "url", max_blocks: int = MAX_BLOCKS) -> DataFrame:
    """One row per page: id, host, path, rule, listed, verdict."""
    names = stage(listed.select(canonical_url(F.col(f"`{list_col}`")).alias("_canon")).where("_canon is not null").distinct(), "url-list")
    blocks, n_blocks = blocked_bloom(names, "_canon")
    url = F.col(f"`{url_col}`")
    urls = pages.select(F.col(f"`{id_col}`").alias("_id"), url_host(url).alias("host"), url_path(url).alias("path"), canonical_url(url).alias("_canon"))
    seen = stage(possible_hits(urls, "_canon", blocks, n_blocks, max_blocks), "url-probes")
    exact = seen.where("_possible").join(names.withColumn("listed", F.lit(True)), "_canon", "left")
    cols = ["_id", "host", "path", "listed"]
    judged = seen.where("not _possible").withColumn("listed", F.lit(False)).select(*cols) \
        .unionByName(exact.withColumn("listed", F.coalesce("listed", F.lit(False))).select(*cols))
    rule, verdict = match_rule(F.col("host"), F.col("path"), rules)
    own = F.when(F.col("listed"), F.lit("block")).otherwise("allow")
    return judged.select(F.col("_id").alias(id_col), "host", "path", rule.alias("rule"), "listed",
                         F.coalesce(verdict, own).alias("verdict"))
