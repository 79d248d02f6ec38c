"""Importance resampling, the Merkle manifest and prefix token counts."""

import collections
import hashlib
import math
import os
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from loadsplit.llm import importance, merkle, positions, prefix_counts
from loadsplit.llm.common import table
from loadsplit.llm.queries import QUERIES, vocabulary

from ..conftest import SF_SMALL
from .conftest import odd_texts

BYTES = "byte_bpe_50k.json"


# --- row numbers --------------------------------------------------------------------------

def test_rows_are_numbered_in_order_also_within_ties(spark):
    rows = [(k % 5 if k % 3 else None, k) for k in range(400)]
    found = positions.number_rows(spark.createDataFrame(rows, "a long, b long"), [F.col("a").desc_nulls_last()], "at").collect()
    assert sorted(r["at"] for r in found) == list(range(400))
    in_line = [r["a"] for r in sorted(found, key=lambda r: r["at"])]
    assert in_line == sorted(in_line, key=lambda a: (a is None, -(a or 0)))


# --- importance resampling ------------------------------------------------------------------

def plain_features(text, ngram=2):
    low = "".join(c.lower() if c.isascii() else c for c in text or "")
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)
    grams = [" ".join(words[i:i + n]) for n in range(1, ngram + 1) for i in range(len(words) - n + 1)]
    return len(words), [zlib.crc32(g.encode()) for g in grams]


def plain_resample(rows, target, share, min_words, ngram=2, k=10_000):
    feats = [plain_features(t, ngram) for _, t in rows]
    s, t = (collections.Counter(h % k for f in x for h in f) for x in ([f for _, f in feats], [plain_features(x, ngram)[1] for x in target]))
    n_s, n_t = sum(s.values()), sum(t.values())
    gain = lambda b: math.floor(1000 * math.log((t[b] + 1.0) * (n_s + k) / ((s[b] + 1.0) * (n_t + k))))
    out = []
    for (i, _), (n_words, f) in zip(rows, feats):
        weight = sum(gain(h % k) for h in f) // len(f) if f else 0
        h = int(hashlib.sha256(f"7:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        out.append((i, n_words, len(f), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))))
    line = sorted((o for o in out if o[1] >= min_words), key=lambda o: (-o[4], o[0] is None, o[0] or 0, o[2]))
    drawn = collections.Counter(o + (r,) for r, o in enumerate(line[:len(line) * share // 100], 1))
    rest = [o for o in out if o[1] < min_words] + line[len(line) * share // 100:]
    return drawn + collections.Counter(o + (None,) for o in rest)


def measured(df):
    return collections.Counter(tuple(r) for r in df.select("doc_id", "n_words", "n_features", "weight", "score", "rank").collect())


@pytest.mark.parametrize("ngram", [1, 2, 3])
def test_resampling_equals_brute_force(spark, docs, ngram, monkeypatch):
    monkeypatch.setattr(importance, "BATCH_BYTES", 40)
    rng = random.Random(3)
    rows = odd_texts(300) + [(100 + k, " ".join(rng.choice(["the", "It's", "x-ray", "é", "日本", "9a"]) for _ in range(rng.randint(0, 40))))
                             for k in range(60)]
    target = ["the x ray", None, "", "It s the 9a"]
    found = importance.resample(docs(rows), spark.createDataFrame([(t,) for t in target], "text string"), ngram=ngram, min_words=5, share=40)
    assert measured(found) == plain_resample(rows, target, 40, 5, ngram)


def test_buckets_of_words_of_any_length():
    texts = ["a" * 63, "b" * 64 + " " + "c" * 65, "d " * 5 + "e" * 1000 + " f", "\x00 g \x00h", "", " ", "É é"]
    for ngram in (1, 2, 4):
        found = collections.Counter((int(d), int(b)) for _, ds, bs in importance.features([t.encode() for t in texts], ngram, 10_007) for d, b in zip(ds, bs))
        assert found == collections.Counter((d, h % 10_007) for d, t in enumerate(texts) for h in plain_features(t, ngram)[1])


def test_resampling_of_empty_tables_and_clashing_columns(spark, docs):
    none = spark.createDataFrame([], "text string")
    assert importance.resample(docs([]), none).count() == 0
    drawn = importance.draw(docs([(k, f"a{k} b c d") for k in range(8)]).withColumn("weight", F.lit("own")), none, min_words=1, share=50)
    assert drawn.columns == [*docs([]).columns, "weight", "rank"]
    assert sorted(r["rank"] for r in drawn.collect()) == [1, 2, 3, 4] and {r["weight"] for r in drawn.collect()} == {"own"}


def test_drawn_documents_are_nearer_to_the_target(spark):
    docs, target = table(spark, SF_SMALL, "documents"), table(spark, SF_SMALL, "benchmark")
    got = importance.resample(docs, target).toPandas()
    able = got[got["n_words"] >= 20]
    assert able["rank"].notna().sum() == len(able) * 25 // 100
    assert able[able["rank"].notna()]["weight"].mean() > able[able["rank"].isna()]["weight"].mean()


# --- Merkle manifest ------------------------------------------------------------------------

def sha(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def plain_leaf(row):
    return sha(*("-" if v is None else f"{len(str(v).encode())}:{v}" for v in row))


def plain_climb(hashes):
    ways, at = [[] for _ in hashes], list(range(len(hashes)))
    while len(hashes) > 1:
        for k, i in enumerate(at):
            ways[k] += hashes[i ^ 1:(i ^ 1) + 1]
            at[k] = i >> 1
        hashes = [sha(*hashes[i:i + 2]) for i in range(0, len(hashes), 2)]
    return hashes[0], ways


def plain_manifest(rows):
    """(id, leaf, subroot, root, proof) of rows (doc_id, source, lang, n_chars, text)."""
    langs = sorted({r[2] for r in rows}, key=lambda g: (g is not None, (g or "").encode()))
    groups = [sorted(((r[0], plain_leaf(r)) for r in rows if r[2] == g), key=lambda x: (x[0] is not None, x[0] or 0, x[1])) for g in langs]
    climbed = [plain_climb([h for _, h in g]) for g in groups]
    root, tops = plain_climb([c[0] for c in climbed])
    return collections.Counter((i, h, c[0], root, "".join(way + top)) for g, c, top in zip(groups, climbed, tops) for (i, h), way in zip(g, c[1]))


MERKLE = "doc_id long, source string, lang string, n_chars long, text string, tree string, pos string, up_hash string"


def merkle_rows(n, langs=3):
    return [(k if k % 10 else None, "s" if k % 4 else None, None if k % langs == 0 else f"l{'é' * (k % langs)}", None if k % 6 == 0 else k,
             None if k % 5 == 0 else "x" * (k % 40)) for k in range(n)] + [(7, "s", "one", 1, "only"), (9, "", "two", 2, ""), (9, "", "two", 2, "")]


@pytest.mark.parametrize("n, langs, rise, lane", [(0, 1, 3, 4), (40, 3, 1, 1024), (90, 3, 2, 4), (60, 30, 2, 2), (33, 1, 12, 4)])
def test_manifest_equals_brute_force(spark, n, langs, rise, lane, monkeypatch):
    monkeypatch.setattr(merkle, "LANE", lane)
    monkeypatch.setattr(merkle, "_CLIMB", re.sub(r"c\.pos div \d+", f"c.pos div {lane}", merkle._CLIMB))
    rows = merkle_rows(n, langs)
    docs = spark.createDataFrame([r + ("t", "p", "u") for r in rows], MERKLE)
    bad = F.col("doc_id") % 4 == 1
    found = merkle.manifest(docs, {"text": F.when(bad, F.concat("text", F.lit("!"))).otherwise(F.col("text"))}, rise=rise).collect()
    assert collections.Counter((r["doc_id"], r["leaf"], r["subroot"], r["root"], bytes(r["proof"]).hex()) for r in found) == plain_manifest(rows)
    by_leaf = {plain_leaf(r): r for r in rows}
    for r in found:
        row = by_leaf[r["leaf"]]
        assert r["verified"] == (r["folded_root"] == r["root"]) == (row[4] is None or row[0] is None or row[0] % 4 != 1)


def test_manifest_of_an_empty_table_and_of_one_row(spark):
    assert merkle.manifest(spark.createDataFrame([], MERKLE)).count() == 0
    row = (1, None, None, None, "a" * 1_000_000)
    found = merkle.manifest(spark.createDataFrame([row + ("", "", "")], MERKLE)).collect()
    assert [(r["leaf"], r["subroot"], r["root"], bytes(r["proof"]), r["verified"]) for r in found] == [(plain_leaf(row),) * 3 + (b"", True)]


def test_stored_manifest_has_the_same_root_however_it_is_dealt(spark, scratch):
    docs = spark.createDataFrame([r + ("", "", "") for r in merkle_rows(120)], MERKLE)
    roots = set()
    for k, (dealt, rise) in enumerate([(docs, 2), (docs.repartition(7), 5), (docs.orderBy(F.rand(1)), 12)]):
        path = scratch(f"manifest-{k}")
        merkle.write_manifest(dealt, path, rise=rise)
        roots.add(merkle.root_hash(spark, path))
    assert len(roots) == 1


def test_climb_carries_a_row_for_a_block_of_leaves(spark, scratch):
    rows, path = merkle_rows(90), scratch("blocks")
    merkle.write_manifest(spark.createDataFrame([r + ("", "", "") for r in rows], MERKLE), path, rise=2)
    folder = os.path.dirname(path)
    before = set(os.listdir(folder))
    found = merkle.prove(spark, path)
    stored = sum(spark.read.parquet(f"{folder}/{f}").count() for f in set(os.listdir(folder)) - before)
    of_lang = collections.Counter(r[2] for r in rows)
    assert stored == sum(-(-n // 4) for n in of_lang.values())
    assert [found.count(), found.where("verified").count()] == [len(rows)] * 2


# --- prefix token counts ----------------------------------------------------------------------

@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer
    tokenizer = Tokenizer.from_file(vocabulary(BYTES))
    return lambda text: len(tokenizer.encode(text, add_special_tokens=False).ids)


ATOMS = ["a", "b", "e", "r", "s", "t", "'", "'re", "'ll", "'ve", "'S", " ", "  ", "\n", "\t", "\xa0", "　", "\x1c", "\x85", "1", "23", "é", "ü",
         "日本", "ß", "\U0001f600", ".", "--", "----", "=====", "́", "<|endoftext|>", "<|endof", "the", "ing", " and", "\x00", "​",
         "ſ", "Ⅷ", "٣", "\r\n", "﻿", "ation", "X", "ÿ"]


def test_counts_of_all_prefixes_equal_the_library(library):
    counter, rng = prefix_counts.PrefixCounter(vocabulary(BYTES)), random.Random(11)
    texts = ["".join(rng.choices(ATOMS, k=rng.randint(1, 14))) for _ in range(1500)]
    texts += ["-" * 200, " " * 150 + "x", "a" * 99, "\n" * 20 + " y", "don't we'll I've they'r they're''ll", "<|endoftext|><|endoftext|> a"]
    for text in texts:
        assert np.cumsum(counter.differences(text)).tolist() == [library(text[:k]) for k in range(1, len(text) + 1)], text


def test_counts_do_not_depend_on_what_is_remembered(library, monkeypatch):
    monkeypatch.setattr(prefix_counts, "KEPT_SEGMENTS", 3)
    monkeypatch.setattr(prefix_counts, "KEPT_PAIRS", 4)
    monkeypatch.setattr(prefix_counts, "WINDOW_CHARS", 50)
    counter, rng = prefix_counts.PrefixCounter(vocabulary(BYTES)), random.Random(2)
    for _ in range(20):
        text = " ".join("".join(rng.choices("abcdefghiting'é1", k=rng.randint(1, 9))) for _ in range(60))
        assert int(counter.differences(text).sum()) == library(text)


def test_differences_of_any_size_are_packed():
    rng = random.Random(3)
    for values in ([], [0], [127, -127], [128], [-128, 5], [10**6, -10**6, 1], [rng.randint(-300, 300) for _ in range(50)]):
        assert prefix_counts.unpack(prefix_counts._pack(values)).tolist() == values


def test_stored_counts_answer_without_the_texts(spark, docs, library, scratch):
    rows = odd_texts(3000)
    path = scratch("counts")
    prefix_counts.write_counts(docs(rows), path, vocabulary(BYTES))
    counts = prefix_counts.read_counts(spark, path)
    want = sorted(((i, len((t or "").encode()), len(t or ""), library(t or "")) for i, t in rows), key=str)
    assert sorted((tuple(r) for r in counts.drop("steps").collect()), key=str) == want
    text = dict(rows)[7]
    asked = counts.where("doc_id = 7").select("doc_id", "steps", F.explode(F.sequence(F.lit(-1), F.lit(len(text) + 1))).alias("k"))
    at = {r.k: r.tokens_at for r in prefix_counts.tokens_at(asked, F.col("k")).collect()}
    assert at == {k: library(text[:max(k, 0)]) for k in range(-1, len(text) + 2)}
    for limit in (0, 1, 5, 10**6):
        got = {r["doc_id"]: r["fit_chars"] for r in prefix_counts.fit_budget(counts, limit).where("doc_id in (3, 7, 8)").collect()}
        for i in (3, 7, 8):
            t = dict(rows)[i]
            assert got[i] == max([k for k in range(1, len(t) + 1) if library(t[:k]) <= limit], default=0)


def test_counts_of_an_empty_table_and_an_unfit_tokenizer(docs):
    assert prefix_counts.count_tokens(docs([]), vocabulary(BYTES)).count() == 0
    with pytest.raises(ValueError, match="not a plain byte-level"):
        prefix_counts.PrefixCounter(vocabulary("word_bpe_49k.json"))


def test_registered_counts_equal_the_library(spark, library):
    texts = {r["doc_id"]: r["text"] or "" for r in table(spark, SF_SMALL, "documents").collect()}
    found = {r["doc_id"]: r for r in QUERIES["op13_prefix_counts"](spark, SF_SMALL).collect()}
    assert found.keys() == texts.keys()
    for i, t in texts.items():
        r = found[i]
        assert (r["n_bytes"], r["n_tokens"], r["over_limit"]) == (len(t.encode()), n := library(t), n > 512)
        assert library(t[:r["fit_chars"]]) <= 512 and (r["over_limit"] or r["fit_chars"] == len(t))
