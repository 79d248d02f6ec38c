"""Quality rules as a bitmask ledger: every measurement and rule is evaluated
once per document, failures are stored as bits beside the measurements, and
versioned policies and ablations are bitwise operations on the stored ledger.

Column expressions only; nothing is shuffled to build or judge the ledger, and
what judges or ablates reads the stored ledger, never a text.
Three-word windows are compared by a 64-bit hash of their words within one
document.

Defined cases: a null or empty text has no words, all measurements are 0, and
it fails ``few_words``; texts are read whole, whatever their length; repeated
rows and null ids keep their rows; an empty table gives an empty ledger. Input
columns other than id and text are not read.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from loadsplit.session import scratch_path

WINDOW = 3
#: fixed values
SYMBOLS = "#*$%&|<>"
SPACES = " \t\n\x0b\x0c\r"
WORD_BREAK = r"[\x20\x09-\x0D]+"

#: name -> failing condition; the position is the rule's bit. Append only.
RULES: dict[str, str] = {
    "few_words": "n_words < 50",
    "repeated_windows": "100 * n_repeat_words > 50 * n_words",
    "symbols": "10 * n_symbols > 3 * n_words",
    "duplicate_lines": "2 * n_dup_lines > n_lines",
    "exclamations": "10 * n_exclaims > 3 * n_words",
    "short_words": "word_chars < 2 * n_words",
    "long_words": "word_chars > 15 * n_words",
}
#: version -> rules it enforces
POLICIES: dict[str, tuple[str, ...]] = {
    "base-1": ("few_words", "repeated_windows"),
    "strict-1": tuple(RULES),
}
MEASURES = ("n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_exclaims", "n_repeat_words")


def mask(names: tuple[str, ...]) -> int:
    return sum(1 << list(RULES).index(n) for n in names)


def _count_of(text: Column, chars: str) -> Column:
    return (F.char_length(text) - F.char_length(F.translate(text, chars, ""))).cast("long")


def _repeat_words(w: Column, n: Column) -> Column:
    """Words inside three-word windows that occur twice or more: hash the
    windows, sort (hash, position), keep positions whose neighbour has the same
    hash, and add up the union of [p, p + 3)."""
    windows = F.when(n >= WINDOW, F.transform(
        F.sequence(F.lit(0), n - WINDOW),
        lambda i: F.struct(F.xxhash64(F.get(w, i), F.get(w, i + 1), F.get(w, i + 2)).alias("h"), i.alias("p"))))
    return F.array_sort(windows)


def _covered(s: Column) -> Column:
    same = F.filter(s, lambda x, i: F.coalesce(F.get(s, i - 1)["h"] == x["h"], F.lit(False))
                    | F.coalesce(F.get(s, i + 1)["h"] == x["h"], F.lit(False)))
    at = F.array_sort(F.transform(same, lambda x: x["p"]))
    start = F.struct(F.lit(-WINDOW).alias("l"), F.lit(0).cast("long").alias("t"))
    return F.coalesce(F.aggregate(at, start, lambda a, x: F.struct(
        x.alias("l"), (a["t"] + F.least(F.lit(WINDOW), x - a["l"])).alias("t")), lambda a: a["t"]), F.lit(0).cast("long"))


def measure(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` with the measurements as long columns (they replace columns of
    the same name)."""
    text = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    d = docs.withColumn("_w", F.array_remove(F.split(text, WORD_BREAK), "")).withColumn("_l", lines)
    d = d.withColumn("n_words", F.size("_w").cast("long")) \
        .withColumn("_s", _repeat_words(F.col("_w"), F.size("_w")))
    return d.withColumns({
        "word_chars": F.char_length(F.translate(text, SPACES, "")).cast("long"),
        "n_symbols": _count_of(text, SYMBOLS),
        "n_lines": F.size("_l").cast("long"),
        "n_dup_lines": (F.size("_l") - F.size(F.array_distinct("_l"))).cast("long"),
        "n_exclaims": _count_of(text, "!"),
        "n_repeat_words": _covered(F.col("_s")),
    }).drop("_w", "_l", "_s")


def ledger(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: tuple[str, ...] = ()) -> DataFrame:
    """id, the measurements and ``fail_bits`` (bit k: rule k failed); ``keep``
    names further input columns to carry along."""
    bits = F.lit(0).cast("long")
    for k, rule in enumerate(RULES.values()):
        bits = bits.bitwiseOR(F.when(F.expr(rule), F.lit(1 << k)).otherwise(0).cast("long"))
    quoted = lambda names: [F.col(f"`{c}`") for c in names]
    picked = docs.select(*quoted([id_col, text_col]), *quoted(c for c in keep if c not in (id_col, text_col)))
    out = measure(picked, text_col).withColumn("fail_bits", bits)
    return out.select(*quoted([id_col, *[c for c in keep if c != id_col]]), *[m for m in MEASURES if m not in keep], "fail_bits")


def write_ledger(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> None:
    """Store the ledger: every rule is evaluated here, once."""
    ledger(docs, id_col, text_col).write.parquet(path)


def read_ledger(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def passes(version: str, bits: str = "fail_bits", policies: Mapping[str, tuple[str, ...]] = POLICIES) -> Column:
    """True if no rule of the policy version failed."""
    return F.col(bits).bitwiseAND(F.lit(mask(policies[version]))) == 0


def ablations(led: DataFrame, version: str) -> DataFrame:
    """Per enforced rule: documents failing it, documents failing only it (what
    dropping the rule would bring back) and the policy's kept count. One
    aggregate per distinct bit pattern, at most 2^rules rows."""
    m = mask(POLICIES[version])
    patterns = led.groupBy(F.col("fail_bits").bitwiseAND(F.lit(m)).alias("b")).agg(F.count(F.lit(1)).alias("n"))
    rules = F.array(*[F.struct(F.lit(r).alias("rule"), F.lit(mask((r,))).cast("long").alias("bit")) for r in POLICIES[version]])
    p = patterns.select("b", "n", F.explode(rules).alias("r"))
    n = F.col("n")
    return p.groupBy(F.col("r.rule").alias("rule")).agg(
        F.sum(F.when(F.col("b").bitwiseAND(F.col("r.bit")) != 0, n).otherwise(0)).alias("n_failed"),
        F.sum(F.when(F.col("b") == F.col("r.bit"), n).otherwise(0)).alias("n_only_this"),
        F.sum(F.when(F.col("b") == 0, n).otherwise(0)).alias("n_kept"))


def sole_rule(version: str, bits: str = "fail_bits") -> Column:
    """Name of the rule without which a failing row would pass the policy; null if
    the row passes or fails several."""
    failed = F.col(bits).bitwiseAND(F.lit(mask(POLICIES[version])))
    name = F.lit(None).cast("string")
    for rule in POLICIES[version]:
        name = F.when(failed == mask((rule,)), F.lit(rule)).otherwise(name)
    return name


def judge_ledger(led: DataFrame, version: str = "strict-1") -> DataFrame:
    """A ledger with ``base_failed`` and ``kept`` under a policy version, and its
    ablations: ``sole_rule`` and ``ablation_gain``, how many rows the policy would
    take in without that rule."""
    gains = ablations(led, version).select(F.col("rule").alias("sole_rule"), F.col("n_only_this").alias("ablation_gain"))  # one row a rule
    return led.withColumn("base_failed", ~passes("base-1")).withColumn("kept", ~F.col("base_failed") & passes(version)) \
        .withColumn("sole_rule", sole_rule(version)).join(F.broadcast(gains), "sole_rule", "left").select(*led.columns, "base_failed", "kept", "sole_rule", "ablation_gain")


def judge(docs: DataFrame, version: str = "strict-1", id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Store the documents' ledger in the scratch folder and judge from it."""
    path = scratch_path(docs.sparkSession, "quality-ledger")
    write_ledger(docs, path, id_col, text_col)
    return judge_ledger(read_ledger(docs.sparkSession, path), version)


def keep_passing(docs: DataFrame, version: str = "strict-1", text_col: str = "text") -> DataFrame:
    """The input rows that pass the policy, with their own columns unchanged."""
    whole = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"), F.col(f"`{text_col}`").alias("_text"))
    # a filter on a non-deterministic column stays above the measurements; pushed
    # down, each rule would evaluate them again
    judged = ledger(whole, "_row", "_text").withColumn("_place", F.monotonically_increasing_id())
    return judged.where(passes("base-1") & passes(version) & (F.col("_place") >= 0)).select("_row.*")
