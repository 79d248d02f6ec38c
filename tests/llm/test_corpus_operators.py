"""Operators that compare documents, and the pipeline, against brute force."""

import collections
import hashlib
import random

import numpy as np
import pytest
import xxhash

from loadsplit.llm import components, simhash, substring_dedup
from loadsplit.llm.common import grouped

from .conftest import odd_texts


def near_copies(n_groups=12, seed=7):
    """Groups of near copies: one word in a long text replaced, chains included."""
    rng = random.Random(seed)
    rows, k = [], 100
    for _ in range(n_groups):
        words = [f"v{rng.randint(0, 500)}" for _ in range(150)]
        for _ in range(rng.choice([1, 2, 5, 30])):
            rows.append((k, " ".join(words)))
            k += 1
            words[rng.randrange(150)] = f"n{rng.randint(0, 10**6)}"
    return rows


# --- simhash ------------------------------------------------------------------------------

def plain_fingerprint(text):
    w = "".join(c.lower() if c.isascii() else c for c in (text or "")).encode().split()
    if not w:
        return 0
    grams = [b" ".join(w[i:i + 3]) for i in range(len(w) - 2)] or [b" ".join(w)]
    ones = [0] * 64
    for g in grams:
        h = xxhash.xxh64_intdigest(g, 42)
        for b in range(64):
            ones[b] += h >> b & 1
    return sum(1 << b for b in range(64) if 2 * ones[b] > len(grams))


def plain_components(rows, most=3):
    fp = [plain_fingerprint(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in range(len(rows)):
        for b in range(a):
            if (fp[a] ^ fp[b]).bit_count() <= most:
                root[find(a)] = find(b)
    low = collections.defaultdict(list)
    for k, (i, _) in enumerate(rows):
        low[find(k)] += [] if i is None else [i]
    return sorted((str(i), f"{fp[k]:016x}", str(min(low[find(k)], default=None))) for k, (i, _) in enumerate(rows))


@pytest.mark.parametrize("cell_rows", [simhash.CELL_ROWS, 8])
def test_simhash_components_match_brute_force(docs, cell_rows):
    rows = odd_texts(2000) + near_copies() + [(3000, "a b c"), (2, "A B\tC")]
    got = simhash.components(docs(rows), cell_rows=cell_rows).collect()
    assert sorted((str(r.doc_id), r.fingerprint, str(r.component_id)) for r in got) == plain_components(rows)


def test_simhash_keeps_one_of_a_group(docs):
    rows = [(1, "a b c d"), (2, "a b c d"), (None, "only this text"), (4, None), (5, ""), (6, "some other words stand here")]
    kept = simhash.drop_near_duplicates(docs(rows))
    assert sorted(str(r.doc_id) for r in kept.collect()) == ["1", "4", "6", "None"] and kept.columns == docs(rows).columns
    assert simhash.components(docs(rows).limit(0)).count() == 0


def test_repeated_rows_and_null_ids_pass_the_dedup_stages(spark, docs):
    """One row of a group stays, so the substring stage finds no second copy to cut."""
    import corpus_pipeline
    a, b, c = (" ".join(f"{x}{k}" for k in range(60)) for x in "abc")
    rows = [(1, a), (1, a), (2, a), (None, b), (None, b), (None, b.upper()), (None, c), (3, c), (4, None), (None, ""), (5, "short x"), (5, "other y words")]
    near = corpus_pipeline.near_dedup(spark, docs(rows), "")
    assert near.columns == docs(rows).columns
    kept = sorted((str(r.doc_id), r.text or "") for r in near.collect())
    assert [k for k in kept if k[0] != "None"] == [("1", a), ("3", c), ("4", ""), ("5", "other y words"), ("5", "short x")]
    assert [k for k in kept if k[0] == "None"] in ([("None", b)], [("None", b.upper())])
    cut = substring_dedup.drop_repeats(near).collect()
    assert sorted((str(r.doc_id), r.text or "") for r in cut) == kept
    assert simhash.drop_near_duplicates(docs(rows).limit(0)).count() == 0


def test_grid_bound_and_forest():
    rng = np.random.default_rng(0)
    a = rng.integers(0, 1 << 63, 4000, dtype=np.uint64)
    flips = np.array([sum(1 << int(x) for x in rng.choice(64, rng.integers(0, 6), replace=False)) for _ in a], np.uint64)
    assert (simhash.near(a, a ^ flips, 3) == (np.bitwise_count(flips) <= 3)).all()
    fp = np.unique(np.concatenate([a[:30] ^ np.uint64(1 << k) for k in range(0, 64, 3)] + [a[:200]]))
    fp = fp[np.argsort(np.bitwise_count(fp), kind="stable")]
    label = simhash._forest(fp, np.bitwise_count(fp).astype(np.int32), 3, rows=16)
    want = np.arange(fp.size)
    while True:  # smallest label over all near pairs
        new = np.array([want[np.bitwise_count(fp ^ x) <= 3].min() for x in fp])
        if (new == want).all():
            break
        want = new
    assert len(set(zip(label, want))) == len(set(label)) == len(set(want))


def test_components_of_long_chains(spark):
    chain = [(k, k + 1) for k in range(0, 60)] + [(100, 200), (200, 100), (7, 7), (-5, 300), (300, 4000)]
    random.Random(1).shuffle(chain)
    got = {(r.node, r.root) for r in components.connected_components(spark.createDataFrame(chain, "a long, b long")).collect()}
    assert got == {(k, 0) for k in range(61)} | {(100, 100), (200, 100)} | {(k, -5) for k in (-5, 300, 4000)}
    assert components.connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_groups_span_batches():
    import pyarrow as pa
    keys = [1, 1, 2, 2, 2, 2, 2, 3, 4, 4]
    for size in (1, 2, 3, 10):
        b = [pa.RecordBatch.from_pydict({"k": keys[i:i + size], "v": list(range(i, min(i + size, 10)))}) for i in range(0, 10, size)]
        seen = [t.column("k").to_pylist() for t in grouped(iter(b), "k")]
        assert sum(seen, []) == keys
        assert all(not set(x) & set(y) for i, x in enumerate(seen) for y in seen[:i])


# --- substring dedup -------------------------------------------------------------------------

def plain_removal(rows, window):
    words = [(t or "").encode().split() for _, t in rows]
    count = collections.Counter(tuple(w[k:k + window]) for w in words for k in range(len(w) - window + 1))
    out = []
    for (i, t), w in zip(rows, words):
        gone = {p for k in range(len(w) - window + 1) if count[tuple(w[k:k + window])] > 1 for p in range(k, k + window)}
        kept = [x for p, x in enumerate(w) if p not in gone]
        spans, p = [], 0
        while p < len(w):
            if p in gone:
                q = p
                while q in gone:
                    q += 1
                spans += [p, q]
                p = q
            p += 1
        out.append((str(i), len(w), len(gone), spans, hashlib.sha256(b" ".join(kept)).hexdigest(), b" ".join(kept).decode()))
    return sorted(out)


@pytest.mark.parametrize("window, pack_bytes", [(35, substring_dedup.PACK_BYTES), (3, 400), (1, 10_000)])
def test_substring_removal_matches_brute_force(docs, window, pack_bytes):
    rng = random.Random(window)
    shared = [" ".join(f"p{rng.randint(0, 10**6)}" for _ in range(60)) for _ in range(4)]
    rows = odd_texts(3000) + near_copies(5) + [
        (500 + k, " \n".join(f"u{rng.randint(0, 10**6)}" for _ in range(40)) + "\n" + rng.choice(shared) + "  tail") for k in range(12)]
    rows += [(600, shared[0] + " " + shared[0]), (601, " ".join(["same"] * 50)), (602, "x" * 200 + " " + "x" * 200)]
    got = substring_dedup.remove_repeats(docs(rows), window=window, pack_bytes=pack_bytes).collect()
    plain = sorted((str(r.doc_id), r.n_words, r.n_removed, r.removed, r.kept_sha256, " ".join((r.kept_text or "").encode().decode().split(" "))) for r in got)
    want = plain_removal(rows, window)
    assert [p[:5] for p in plain] == [w[:5] for w in want]
    assert [p[5].encode().split() for p in plain] == [w[5].encode().split() for w in want]


def test_substring_ranges_are_counted_in_slices(docs, monkeypatch):
    monkeypatch.setattr(substring_dedup, "RANGE_WINDOWS", 40)
    monkeypatch.setattr(substring_dedup, "RANGES_PER_TASK", 1)
    rows = near_copies(6) + odd_texts(400)
    cut = []
    slices = substring_dedup._slices
    monkeypatch.setattr(substring_dedup, "_slices", lambda *a: cut.append(a[1]) or slices(*a))
    got = substring_dedup.remove_repeats(docs(rows), window=7, pack_bytes=3000).collect()
    assert min(cut) > 10
    assert sorted((str(r.doc_id), r.n_words, r.n_removed, r.removed, r.kept_sha256) for r in got) == [w[:5] for w in plain_removal(rows, 7)]


def test_substring_requests_grow_with_the_input(docs, monkeypatch):
    monkeypatch.setattr(substring_dedup, "RANGE_WINDOWS", 40)
    n = []
    for size in (50, 100, 200):
        rng = random.Random(size)
        rows = [(k, " ".join(f"v{rng.randint(0, 10**6)}" for _ in range(300))) for k in range(size)]
        packs = substring_dedup.pack_texts(docs(rows), pack_bytes=20_000)
        n_ranges, _ = substring_dedup.repeated(packs)
        asked = packs.drop("windows").mapInArrow(substring_dedup._requests(0, 35, n_ranges), substring_dedup._REQUEST)
        n.append((asked.count(), packs.count()))
    assert all(a == packs * n_ranges[0] for a, packs in n) and 2 < n[2][0] / n[0][0] < 5


def test_substring_frame_keeps_columns(docs):
    rows = [(1, "a  b\nc d"), (2, "x a  b\nc d y"), (None, None), (3, "")]
    out = substring_dedup.drop_repeats(docs(rows), window=3)
    assert out.columns == docs(rows).columns
    assert sorted((str(r.doc_id), r.text, r.kept_text, r.n_words) for r in out.collect()) == [
        ("1", "", "k", "z"), ("2", "x y", "k", "z"), ("3", "", "k", "z"), ("None", None, "k", "z")]
    assert substring_dedup.drop_repeats(docs(rows).limit(0)).count() == 0
    assert substring_dedup.remove_repeats(docs(rows), texts=False).columns == ["doc_id", "n_words", "n_removed", "removed", "kept_sha256"]


def test_dense_hashes_round_trip():
    rng = np.random.default_rng(1)
    for top in (1, 300, 1 << 40, (1 << 64) - 1):
        h = np.unique(rng.integers(0, top, 500, dtype=np.uint64))
        assert (substring_dedup._sparse(substring_dedup._dense(h), h.size) == h).all()


# --- pipeline ----------------------------------------------------------------------------------

def test_pipeline_stages(spark, docs, scratch):
    import corpus_pipeline
    docs([])
    sf = "/root/testdata/sf0.001"
    d = spark.read.parquet(f"{sf}/documents.parquet")
    now, columns = [(r.doc_id, r.text) for r in d.collect()], d.columns
    for name, step in corpus_pipeline.STAGES:
        path = scratch("stage")
        step(spark, d, sf).write.parquet(path)
        d = spark.read.parquet(path)
        rows = d.collect()
        if name == "simhash near-dedup":
            assert sorted(r.doc_id for r in rows) == sorted(int(i) for i, _, c in plain_components(now) if i == c)
        elif name == "substring dedup":
            want = plain_removal(now, 35)
            assert sorted((str(r.doc_id), r.text.encode().split()) for r in rows) == sorted((w[0], w[5].encode().split()) for w in want)
            assert all(r.n_chars == len(r.text) for r in rows)
        else:
            assert {r.doc_id for r in rows} <= {i for i, _ in now}
        if name != corpus_pipeline.STAGES[-1][0]:
            assert d.columns == columns
            now = [(r.doc_id, r.text) for r in rows]
    assert all(r.n_tokens == len(r.ids) for r in rows) and rows
    assert corpus_pipeline.run(spark, sf).count() == len(rows)


def test_operators_match_oracles(spark, docs):
    import __spark_entry__ as E
    from loadsplit.llm.oracle import ORACLES
    from tools.oracle_check import compare, duck
    con = duck("/root/testdata/sf0.001")
    for name, sql in ORACLES.items():
        res = compare(spark, con, name, E.queries()[name], sql, "/root/testdata/sf0.001")
        assert res["status"] == "ok", res


def test_every_operator_is_registered():
    import __spark_entry__ as E
    names = set(E.queries())
    assert {f"op{n}" for n in range(1, 11)} <= {x.split("_")[0] for x in names} and "pipeline" in names
