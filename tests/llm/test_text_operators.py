"""Operators on single texts, against plain Python on small fixtures."""

import collections
import hashlib
import itertools
import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from loadsplit.llm import decontaminate, html_text, piece_nbest, quality_rules, sharding, token_files, toxicity, url_filter
from loadsplit.llm.common import text_slices
from loadsplit.llm.queries import vocabulary

from .conftest import odd_texts

SPACES = " \t\n\x0b\x0c\r"


def words_of(text):
    return [w.decode() for w in (text or "").encode().split()]


# --- quality rules ---------------------------------------------------------------------

def test_quality_measures_match_plain_python(docs):
    rows = odd_texts() + [(20 + k, t) for k, t in enumerate(["a b c a b c", "x x x x", "l1\nl1\n\n l1\nl2", "##!! * a|b <c>", "a b\na b\n"])]
    got = quality_rules.judge(docs(rows)).select("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept").collect()
    want = []
    for _, t in rows:
        w = words_of(t)
        lines = [x for x in (t or "").split("\n") if x.strip(SPACES)]
        grams = [tuple(w[i:i + 3]) for i in range(len(w) - 2)]
        covered = {p for i, g in enumerate(grams) if grams.count(g) > 1 for p in range(i, i + 3)} if len(w) < 100 else None
        if covered is None:
            count = {}
            for g in grams:
                count[g] = count.get(g, 0) + 1
            covered = {p for i, g in enumerate(grams) if count[g] > 1 for p in range(i, i + 3)}
        failed = len(w) < 50 or 100 * len(covered) > 50 * len(w)
        want.append((len(w), sum(map(len, w)), sum((t or "").count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines)), len(covered), failed))
    assert sorted(tuple(r)[:6] for r in got) == sorted(want)
    assert all(not r.kept for r in got if r.base_failed)


def test_quality_ledger_is_stored_and_ablated(spark, docs, scratch):
    rows = [(1, "word " * 20), (2, " ".join(f"w{k}" for k in range(60)) + "$" * 40), (3, " ".join(f"w{k}" for k in range(60))), (4, None),
            (5, " ".join(f"w{k}!" for k in range(60)) + "$" * 40), (None, " ".join(f"v{k}" for k in range(70)) + "#" * 50)]
    path = scratch("ledger")
    quality_rules.write_ledger(docs(rows).withColumnRenamed("text", "a.b"), path, text_col="a.b")
    got = {r.doc_id: r for r in quality_rules.judge_ledger(quality_rules.read_ledger(spark, path)).collect()}
    assert {i: (r.sole_rule, r.ablation_gain) for i, r in got.items()} == {
        1: (None, None), 2: ("symbols", 2), 3: (None, None), 4: ("few_words", 1), 5: (None, None), None: ("symbols", 2)}
    assert [i for i, r in got.items() if r.kept] == [3]
    plan = quality_rules.judge_ledger(quality_rules.read_ledger(spark, path))._jdf.queryExecution().optimizedPlan().toString()
    assert "text" not in plan


def test_quality_policies_are_bitwise(docs):
    rows = [(k, t) for k, t in enumerate(["w" * 3 + " x", " ".join(f"word{j}" for j in range(60)), " ".join(f"word{j}###" for j in range(60))])]
    led = quality_rules.ledger(docs(rows))
    bits = {r.doc_id: r.fail_bits for r in led.collect()}
    assert bits[1] == 0 and bits[0] & 1 and bits[2] == quality_rules.mask(("symbols",))
    assert [r.doc_id for r in led.where(quality_rules.passes("base-1")).orderBy("doc_id").collect()] == [1, 2]
    out = {r.rule: tuple(r)[1:] for r in quality_rules.ablations(led, "strict-1").collect()}
    assert out["symbols"] == (1, 1, 1) and out["few_words"][0] == 1
    kept = quality_rules.keep_passing(docs(rows))
    assert [r.doc_id for r in kept.collect()] == [1] and kept.columns == docs(rows).columns


# --- decontamination ----------------------------------------------------------------------

def plain_contamination(texts, items, m=13):
    out = []
    windows = [(i, tuple(w[k:k + min(m, len(w))])) for i, t in items
               for w in [decontaminate.split_words((t or "").encode())] if w for k in range(len(w) - min(m, len(w)) + 1)]
    for t in texts:
        w, hit, found = decontaminate.split_words((t or "").encode()), set(), set()
        for i, g in windows:
            for k in range(len(w) - len(g) + 1):
                if tuple(w[k:k + len(g)]) == g:
                    hit |= set(range(k, k + len(g)))
                    found.add(str(i))
        out.append((len(w), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(),
                    len(hit) > 0 and 20 * len(hit) >= len(w)))
    return out


@pytest.mark.parametrize("block_words", [10**6, 20])
def test_decontaminate_matches_brute_force(spark, docs, block_words):
    rng = random.Random(5)
    word = lambda: rng.choice("a b c Dd e1".split())
    items = [(10 + k, " ".join(word() for _ in range(n))) for k, n in enumerate([13, 14, 20, 2, 5, 1, 0])] + [(10, "a b zz"), (9, None)]
    rows = odd_texts(300) + [(100 + k, " ".join(word() for _ in range(60))) for k in range(20)] + [(200, "x " + items[2][1] + " y")]
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = decontaminate.measure(docs(rows), bench, block_words=block_words).drop("doc_id").collect()
    assert sorted(map(tuple, got)) == sorted(plain_contamination([t for _, t in rows], items))


@pytest.mark.parametrize("blocks, n_sent", [(1, 6), (4, 2)])
def test_decontaminate_holds_the_blocks_of_one_pass_at_a_time(spark, docs, monkeypatch, blocks, n_sent):
    import os
    sent, most, make = [], [20], type(spark.sparkContext).broadcast

    def broadcast(sc, value):
        assert not any(os.path.exists(b._path) for b in sent)
        assert len(value) <= blocks and all(sum(len(decontaminate.split_words(t)) for _, t in items) <= most[0] for items in value)
        sent.append(make(sc, value))
        return sent[-1]

    monkeypatch.setattr(type(spark.sparkContext), "broadcast", broadcast)
    monkeypatch.setattr(decontaminate, "PASS_BLOCKS", blocks)
    items = [(k, " ".join(f"w{k}x{j}" for j in range(15))) for k in range(6)] + [(7, ""), (8, "w1x1 w1x2")]
    rows = [(k, t + " and " + u) for k, ((_, t), (_, u)) in enumerate(zip(items, items[1:]))] + [(50, None), (51, "clean")]
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = decontaminate.measure(docs(rows), bench.coalesce(1), block_words=20, keep=("doc_id", "text")).drop("text")
    assert len(sent) == n_sent and str(got._jdf.queryExecution().executedPlan()).count("MapInArrow") <= 3
    assert sorted(map(tuple, got.drop("doc_id").collect())) == sorted(plain_contamination([t for _, t in rows], items))
    sent.clear()
    most[0] = 100
    assert decontaminate.measure(docs(rows), bench.repartition(5)).count() == len(rows) and len(sent) == 1


def test_decontaminate_cuts_items_longer_than_a_block(spark, docs):
    words = [f"w{k % 37}x{k % 11}" for k in range(200)]
    items = [(1, " ".join(words)), (2, " ".join(words[5:40])), (3, "w1x1 w2x2")]
    rows = [(k, "a " + " ".join(words[k:k + n]) + " b") for k in range(0, 180, 7) for n in (2, 12, 13, 14, 40)]
    got = decontaminate.measure(docs(rows), spark.createDataFrame(items, "item_id long, text string"), block_words=16).drop("doc_id")
    assert sorted(map(tuple, got.collect())) == sorted(plain_contamination([t for _, t in rows], items))


def test_decontaminate_tables_of_a_full_block_are_small():
    import tracemalloc
    rng = random.Random(1)
    items = [(str(k), " ".join(f"w{rng.randrange(60_000)}" for _ in range(500)).encode()) for k in range(decontaminate.BLOCK_WORDS // 500)]
    tracemalloc.start()
    block = decontaminate.Block(items)
    held = tracemalloc.get_traced_memory()[0]
    tracemalloc.stop()
    assert held < 60e6
    words = items[7][1].split()[100:130]
    spans, found = block.find(words, decontaminate._hashes(words))
    assert len(spans) == 36 and found == {"7"}


def test_decontaminate_empty_tables(spark, docs):
    none = spark.createDataFrame([], "item_id long, text string")
    d = docs([(1, "a b"), (2, None)])
    assert decontaminate.drop_contaminated(d, none).count() == 2 and decontaminate.drop_contaminated(d, none).columns == d.columns
    assert decontaminate.measure(docs([(1, "a")]).limit(0), none).count() == 0
    kept = decontaminate.drop_contaminated(d, spark.createDataFrame([(1, "A b")], "item_id long, text string"))
    assert [r.doc_id for r in kept.collect()] == [2]


def test_decontaminate_sends_a_text_once(spark, docs, capsys):
    """A text that is carried is not sent to Python beside its row too, and null texts stay."""
    d = docs([(1, "a b"), (2, "c d"), (3, None), (None, "")]).select("doc_id", "text")
    kept = decontaminate.drop_contaminated(d, spark.createDataFrame([(1, "A b")], "item_id long, text string"))
    kept.explain()
    sent = re.findall(r"MapInArrow run\(([^)]*)\)", capsys.readouterr().out)
    assert len(sent) == 1 and "_row" in sent[0] and "_text" not in sent[0]
    assert sorted(kept.collect(), key=str) == sorted(d.where("doc_id is null or doc_id > 1").collect(), key=str)


# --- token files ----------------------------------------------------------------------------

def test_token_files_round_trip(spark, docs, scratch):
    from tokenizers import Tokenizer
    tok = Tokenizer.from_file(vocabulary("word_bpe_49k.json"))
    rows = odd_texts()
    path = scratch("tokens")
    token_files.write_tokens(docs(rows), path, vocabulary("word_bpe_49k.json"), 2)
    back = token_files.read_tokens(spark, path)
    got = [(r.doc_id, r.start, r.n_tokens, tuple(r.ids)) for r in back.orderBy("start").collect()]
    want = [tuple(tok.encode(t or "", add_special_tokens=False).ids) + (2,) for _, t in rows]
    assert sorted(g[3] for g in got) == sorted(want)
    assert [g[1] for g in got] == [0, *itertools.accumulate(g[2] for g in got)][:-1]
    ids = [g[0] for g in got]
    assert ids == sorted(ids, key=lambda i: (i is not None, i))
    sums = {(r.start, r.ids_crc32) for r in token_files.checksums(back).collect()}
    assert sums == {(g[1], zlib.crc32(np.array(g[3], "<u4").tobytes())) for g in got}
    token_files.write_tokens(docs(rows).limit(0), path + "-none", vocabulary("word_bpe_49k.json"), 2)
    assert token_files.read_tokens(spark, path + "-none").count() == 0


def test_token_files_encodings_and_pruning(spark, docs, scratch):
    import glob

    import pyarrow.parquet as pq
    path = scratch("tokens")
    token_files.write_tokens(docs([(k, f"word{k % 7} and some more text") for k in range(5000)]), path, vocabulary("word_bpe_49k.json"), 2)
    meta = pq.ParquetFile(max(glob.glob(f"{path.removeprefix('file:')}/part-*"))).metadata.row_group(0)
    column = {meta.column(k).path_in_schema: meta.column(k) for k in range(meta.num_columns)}
    assert "RLE_DICTIONARY" in column["ids.list.element"].encodings and "DELTA_BINARY_PACKED" in column["part_start"].encodings
    assert all(c.has_offset_index and c.has_column_index for c in column.values())
    plan = token_files.read_tokens(spark, path).where("doc_id = 17").select("start", "n_tokens")
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(doc_id,17)" in text and "ids:array" not in text


def test_word_encoder_equals_whole_text():
    enc = token_files.WordEncoder(vocabulary("word_bpe_49k.json"))
    rng = random.Random(2)
    chars = [chr(c) for c in [*range(1, 0x250), 0x300, 0x301, 0x327, 0x3A3, 0x3C3, 0x4E00, 0x2028, 0x200D, 0x1F600]]
    for _ in range(3000):
        t = "".join(rng.choice(chars if rng.random() < .5 else "abc .,'sé<|>AB") for _ in range(rng.randint(0, 12)))
        assert enc.encode(t.encode()) == np.array(enc.tokenizer.encode(t, add_special_tokens=False).ids, "<u4").tobytes(), t


def test_word_encoder_deals_out_the_ids_of_whole_texts():
    import pyarrow as pa
    enc = token_files.WordEncoder(vocabulary("word_bpe_49k.json"))
    rng = random.Random(3)
    chars = [chr(c) for c in [*range(1, 0x250), 0x300, 0x3A3, 0x4E00, 0x2028, 0x1F600]]
    texts = ["", " ", "a", "<|endoftext|> A", "\t\x1c x\n", "É, é!? É", "don't #'s"]
    texts += ["".join(rng.choice(chars if rng.random() < .3 else "abc .,'sé<|>ABÉ%") for _ in range(rng.randint(0, 14))) for _ in range(3000)]
    got = enc.encode_all(pa.array(texts), np.uint32(2).astype("<u4").tobytes()).to_pylist()
    assert got == [[*enc.tokenizer.encode(t, add_special_tokens=False).ids, 2] for t in texts]
    assert enc.encode_all(pa.array([], pa.string()), b"\2\0\0\0").to_pylist() == []


def test_word_encoder_encodes_a_word_once_whatever_its_case_and_marks(monkeypatch):
    import pyarrow as pa
    enc = token_files.WordEncoder(vocabulary("word_bpe_49k.json"))
    calls = []
    monkeypatch.setattr(enc, "_letters", lambda w, f=enc._letters: calls.append(w) or f(w))
    enc.encode_all(pa.array(["été Été, ÉTÉ%%% été.", "été!"]), b"\2\0\0\0")
    assert calls == ["été"]


# --- n-best segmentation ---------------------------------------------------------------------

def test_nbest_matches_all_segmentations():
    m = piece_nbest.pieces(vocabulary("piece_bpe_32k.model"))

    def every(s):
        if not s:
            return [(0.0, b"")]
        out = [] if s[0] in m.scores else [(m.unknown + x, m._bytes(s[0]) + i) for x, i in every(s[1:])]
        for j in range(1, len(s) + 1):
            hit = m.suffixes.get(s[:j])
            out += [(hit[0] + x, hit[1] + i) for x, i in every(s[j:])] if hit else []
        return out

    rng = random.Random(3)
    for _ in range(150):
        s = "".join(rng.choice("the and  é\n日ℵing.") for _ in range(rng.randint(0, 9)))
        ways = every("▁" + s.replace(" ", "▁")) if s else [(0.0, b"")]
        assert m.chunks(s) == (m.chunk.findall("▁" + s.replace(" ", "▁")) if s else [])
        ids, total, paths = m.segment(s, 4)
        full = [(p, piece_nbest.replace(ids, c)) for p, c in paths]
        assert [p for p, _ in full] == sorted((x for x, _ in ways), reverse=True)[:4]
        assert set(full) <= set(ways) and len({i for _, i in full}) == len(full) and full[0] == (total, ids)
        assert m.decode(np.frombuffer(ids, "<u4").tolist()) == s


def test_nbest_of_fractional_scores():
    """Forward and backward sums of these differ in their last bits."""
    rng = random.Random(8)
    m = piece_nbest.Pieces({p: (k, -rng.random() * 7 - .1) for k, p in enumerate(["▁", "a", "b", "ab", "ba", "aba", "▁a", "▁b"])}, range(100, 356))

    def every(s):  # scores added up from the start
        out = [((), 0.0, s)]
        while any(rest for *_, rest in out):
            out = [x for ids, v, rest in out for x in ([(ids, v, rest)] if not rest else
                   [((*ids, m.scores[rest[:j]][0]), v + m.scores[rest[:j]][1], rest[j:]) for j in range(1, 4) if j <= len(rest) and rest[:j] in m.scores])]
        return {ids: v for ids, v, _ in out}

    for _ in range(400):
        chunk = "▁" + "".join(rng.choice("ab") for _ in range(rng.randint(0, 9)))
        ways = every(chunk)
        m.learn({chunk})
        got = [(v, tuple(np.frombuffer(ids, "<u4").tolist())) for v, ids in m.ways(chunk, 4)]
        assert len({ids for _, ids in got}) == len(got) == min(4, len(ways)) and all(ways[ids] == v for v, ids in got)
        assert [v for v, _ in got] == sorted((v for v, _ in got), reverse=True)
        assert np.allclose([v for v, _ in got], sorted(ways.values(), reverse=True)[:4], rtol=1e-12)


def test_nbest_of_many_ties(docs):
    """Runs of spaces have millions of tied best paths; long texts may have no space at all."""
    m = piece_nbest.pieces(vocabulary("piece_bpe_32k.model"))
    rng = random.Random(4)

    def best_scores(s, n=4):  # n best scores up to every place, without paths
        longest, top = max(map(len, m.scores)), [[0.0]]
        for j in range(1, len(s) + 1):
            own = [x + m.unknown for x in top[j - 1]] if s[j - 1] not in m.scores else []
            for i in range(max(0, j - longest), j):
                hit = m.scores.get(s[i:j])
                own += [x + hit[1] for x in top[i]] if hit else []
            top.append(sorted(own, reverse=True)[:n])
        return top[-1]

    letters = "".join(rng.choice("etaoinshr") for _ in range(100_000))
    rows = [" " * 200, "a" + " " * 1000 + "b", "x\n" + " " * 1000 + "\n" + " " * 999 + "y", "-" * 1000, "ab" * 2000, letters, "é日ℵ" * 500]
    for text in rows:
        ids, total, paths = m.segment(text, 4)
        full = [piece_nbest.replace(ids, c) for _, c in paths]
        assert [p for p, _ in paths] == best_scores("▁" + text.replace(" ", "▁")) and len(set(full)) == len(full)
        assert full[0] == ids and paths[0][0] == total
        assert all(m.decode(np.frombuffer(i, "<u4").tolist()) == text for i in full)
    got = piece_nbest.digest(docs(list(enumerate(rows))), vocabulary("piece_bpe_32k.model")).collect()
    assert len(got) == len(rows) and all(r.round_trip for r in got)


def test_nbest_frames(docs):
    rows = odd_texts(3000)
    coded = piece_nbest.encode(docs(rows), vocabulary("piece_bpe_32k.model"), keep=("doc_id", "text", "score"))
    back = piece_nbest.decode(coded.select("text", "ids"), vocabulary("piece_bpe_32k.model")).collect()
    assert sorted(r.decoded for r in back) == sorted((t or "").replace("▁", " ") for _, t in rows)
    d = piece_nbest.digest(docs(rows), vocabulary("piece_bpe_32k.model")).collect()
    assert len(d) == len(rows) and sum(not r.round_trip for r in d) == 1
    assert all(r.nbest_crc32[0] == r.ids_crc32 and r.nbest_scores == sorted(r.nbest_scores, reverse=True) for r in d)
    assert piece_nbest.digest(docs(rows).limit(0), vocabulary("piece_bpe_32k.model")).count() == 0


def test_nbest_remembers_few_chunks(monkeypatch):
    """What a task holds is bounded, chunks that come again are not solved anew, and the results stay the same."""
    path = vocabulary("piece_bpe_32k.model")
    few, all_of_them = piece_nbest.Pieces.load(path), piece_nbest.Pieces.load(path)
    few.cached = 300
    monkeypatch.setattr(piece_nbest, "GROUP_BYTES", 1000)
    rng = random.Random(6)
    texts = ["the same words " + " ".join(f"w{rng.randrange(5000)}" for _ in range(20)) for _ in range(400)]
    solved, solve = [], few.solve

    def watched(chunks):
        solved.extend(chunks)
        solve(chunks)
        assert len(few.best) <= 300

    monkeypatch.setattr(few, "solve", watched)
    assert list(few.segments(texts, 4)) == list(all_of_them.segments(texts, 4))
    assert len(solved) > len(set(solved)) and [solved.count(w) for w in ("▁same", "▁words")] == [1, 1]
    part = pa.RecordBatch.from_arrays([pa.array(range(400)), pa.array(texts)], ["_row", "_text"])
    assert piece_nbest._encoded(few, part, 4) == piece_nbest._encoded(all_of_them, part, 4)
    few.forget()
    assert not few.best and not few.searched


def test_text_slices():
    texts = ["x" * 5, None, "", "日" * 4, "y" * 100, "z", None, "é"]
    batch = pa.RecordBatch.from_arrays([pa.array(range(8)), pa.array(texts)], ["n", "t"])
    for b in (batch, batch.slice(1, 6), batch.slice(0, 0)):
        for most in (1, 4, 17, 1000):
            parts = list(text_slices(b, 1, most))
            assert [r for p in parts for r in p.to_pylist()] == b.to_pylist() and all(p.num_rows for p in parts)
            assert all(sum(len((t or "").encode()) for t in p.column(1).to_pylist()[:-1]) < most for p in parts)
    assert [p.num_rows for p in text_slices(batch, 1, 17)] == [4, 1, 3]


# --- html -----------------------------------------------------------------------------------------

@pytest.mark.parametrize("page, text", [
    ("", ""), ("plain  text\n x", "plain text x"), ("<p>a<p>b<div>c<div>d", "a\n\nb\n\nc\nd"),
    ("a<b>b</b> c<br>d", "ab c\nd"), ("<ul><li>x<li>y<ol><li>z</ol></ul>", "- x\n- y\n\n  1. z"),
    ("<table><tr><th>a<th>bbb<tr><td>cccc<td>d</table>", "a     bbb\ncccc  d"),
    ("<table><tr><td colspan=2>wide<tr><td>a<td>b</table>", "wide\na  b"),
    ("<head><title>t</title></head><body>x<script>var a='</p>';</script><style>p{}</style><p hidden>h</p>", "x"),
    ("<p style='color:red; display : NONE'>no</p><p style='display:block'>yes", "yes"),
    ("<pre> a\n  b</pre>", " a\n  b"), ("a</b></div>b &amp; &lt;c&gt;", "ab & <c>"), ("<p>x<!-- no --> y <img alt='pic'>", "x y pic"),
    ("<div>" * 3000 + "deep", "deep"), ("<dl><dt>k<dd>v<dt>k2<dd>v2</dl>", "k\n  v\nk2\n  v2"),
    ("<table><tr><td><table><tr><td>in</table><td>out</table>", "in  out")])
def test_html_rendering(page, text):
    assert html_text.render(page) == text


@pytest.mark.parametrize("page, text", [
    ("<html><head><title>t</title><p>text", "text"), ("<html><head><title>t</title>\n text <b>x</b>", "text x"), ("<head><div>a</div><p>b", "a\n\nb"),
    ("<head><meta charset=x><link rel=y><script>s</script><noscript>n</noscript><template>u</template><base><style>z</style>\n<img alt=pic> c", "pic c"),
    ("<head><title>t <i>u</i></title><title>v</title></head>a", "a"), ("<p>a<head><title>t</title>b", "ab"), ("<head></br>a", "a"),
    ("<head><header>a</header>b", "a\nb")])
def test_html_head_without_end(page, text):
    assert html_text.render(page).strip("\n") == text


@pytest.mark.parametrize("page, text", [
    ("<table><tr>text</tr></table>", "text"), ("<table><tr>a <b>x</b> c<td>y</table>", "a x c\ny"), ("<table><tr><b>x</b></tr></table>", "x"),
    ("<table><tr><form><td>a</td><td>b</td></form></tr><tr><td>ccc<td>d</table>", "a    b\nccc  d"),
    ("<table><tr><form>f<div><td>a</div><td hidden>h<td>b</form></table>", "f\na  b"), ("<table><colgroup>g<tr><td>a</table>", "g\na"),
    ("<table><tr><p hidden>h</p><script>s</script><td>a</table>", "a"), ("<table><tr><table><tr><td>in</table><td>out</table>", "in\nout"),
    ("<table><tr><td>" * 60 + "deep", "deep"), ("<table><tr><td>" * 49 + "<table><tr><td>a<td>b<tr><td>c", "ab\nc")])
def test_html_row_text_without_cells(page, text):
    assert html_text.render(page) == text


@pytest.mark.parametrize("page, text", [
    ("<p>so <math><semantics><mrow><mi>a</mi><mo>+</mo><mi>b</mi></mrow><annotation>a+b</annotation></semantics></math> is", "so a+b is"),
    ("<p>x<svg><title>t</title><defs><text>d</text></defs><desc>e</desc>s<g><text x=1>one</text><text>two<tspan>3</tspan></text></g></svg>y", "x one two3 y"),
    ("<svg><foreignObject><div>in</div>side</foreignObject></svg>z", "in\nside\nz"), ("<svg><text visibility=hidden>h</text><g display=none><text>h</text></g></svg>z", "z"),
    ("<p>pick <select><optgroup label=g><option>a<option selected>b</optgroup><option label=l>c</select> now", "pick\ng\na\nb\nl\nnow"),
    ("<p><svg class=i /> Hello</p>", "Hello"), ("<p><math/>Hello</p>", "Hello"), ("<p><svg><path d=x /><text>t</text><g/></svg> Hello</p>", "t Hello"),
    ("<svg><path><p>text</p>", "text"), ("<svg><g><div>a</div></svg>b", "a\nb"), ("<math><mtext><b>x</b></mtext><mi>y</mi></math>", "xy"),
    ("<div/>a<span/>b", "ab"), ("<p>a<noscript>n</noscript><datalist><option>o</datalist>b", "ab"),
    ("<div>" * 148 + "<svg><text>deep</text></svg>", "deep"), ("<div>" * 3000 + "<svg><text>deep</text></svg>", "deep")])
def test_html_formulas_drawings_and_options(page, text):
    assert html_text.render(page) == text


@pytest.mark.parametrize("page, text", [
    ("a<![x]>b", "ab"), ("a<![ ]>b", "ab"), ("a<![>b", "ab"), ("a<![", "a"), ("a<![x", "a"), ("a<![if !IE]>b<![endif]>c", "abc"), ("a<![endif]-->b ]> c", "ab ]> c"),
    ("a<![CDATA[x]]>b", "ab"), ("<p><svg><text>a<![CDATA[ <b> & c]]></text></svg>", "a <b> & c"), ("<!doctype html>a<!x>b<!>c<!-- d -->", "abc")])
def test_html_marked_sections(page, text):
    assert html_text.render(page) == text


@pytest.mark.parametrize("page, text", [
    ("<table><tr><td rowspan=2>A<td>b1<tr><td>b2<tr><td>cc<td>dd</table>", "A   b1\n    b2\ncc  dd"),
    ("<table><tr><td>a<td rowspan=0>long<td>x<tr><td>b<td>y<tr><td>c<td>z</table>", "a  long  x\nb        y\nc        z"),
    ("<table><tbody><tr><td rowspan=9>a<td>b<tbody><tr><td>c<td>d</table>", "a  b\nc  d"),
    ("<table><tr><td colspan=2 rowspan=2>ab<td>c<tr><td>d<tr><td>x<td>y<td>z</table>", "ab    c\n      d\nx  y  z"),
    ("<p style='visibility:hidden'>a<b style='visibility: visible'>b</b>c</p>d", "b\n\nd"),
    ("<div style='visibility:hidden'><p>x</p></div>y", "y"),
    ("<table><tr><td style='visibility:hidden'>aaa<td>b<tr><td>c<td>d</table>", "   b\nc  d"),
    ("<ol reversed><li>a<li>b<li>c</ol>", "3. a\n2. b\n1. c"), ("<ol start=5 reversed><li>a<li>b</ol>", "5. a\n4. b"),
    ("<ol><li>a<li value=7>b<li>c<li value=x>d</ol>", "1. a\n7. b\n8. c\n9. d"),
    ("a<textarea><b>x</b> &amp; y</textarea>z", "a<b>x</b> & yz")])
def test_html_spans_visibility_numbers_and_text_areas(page, text):
    assert html_text.render(page) == text


def test_html_cells_stand_where_a_grid_puts_them():
    rng = random.Random(6)
    for _ in range(300):
        n_rows, name, page = rng.randint(1, 5), iter(range(999)), "<table>"
        grid, place = {}, {}
        for r in range(n_rows):
            page, at = page + "<tr>", 0
            for _ in range(rng.randint(0, 4)):
                while (r, at) in grid:
                    at += 1
                text = f"c{next(name)}" + "x" * rng.randint(0, 3)
                across, down = rng.choice([1, 1, 1, 2, 3]), rng.choice([1, 1, 1, 2, 3])
                for y in range(r, r + down):
                    for x in range(at, at + across):
                        grid.setdefault((y, x), text)
                place[text] = (r, at, across)
                page += f"<td colspan={across} rowspan={down}>{text}"
                at += across
        lines = html_text.render(page).split("\n")
        rows = sorted({r for r, _, _ in place.values()})
        single = {at for _, at, across in place.values() if across == 1}
        seen = {}
        for text, (r, at, _) in place.items():
            line = lines[rows.index(r)]
            assert text in line.split(), (page, lines)
            if at in single:
                seen.setdefault(at, set()).add(line.index(text))
        wide = any(across > 1 for _, _, across in place.values())
        assert wide or all(len(v) == 1 for v in seen.values()), (page, lines)
        for r in rows:  # cells of a row stand in the order of their columns
            own = [t for t, (y, at, _) in sorted(place.items(), key=lambda x: x[1][1]) if y == r]
            assert lines[rows.index(r)].split() == own


@pytest.mark.parametrize("page", [
    "<table>" + "<tr><td>a<td>b" * 20_000 + "<tr><td>" + "w " * 30_000 + "<td>z</table>",
    "<table>" + "<tr><td colspan=1000>a<td>b" * 20_000 + "</table>",
    "<table><tr>" + "<td>x" * 1000 + "<tr><td>" + "y" * 70 + "<td>z" * 999 + "<tr><td colspan=999>a<td>b" * 3000 + "</table>",
    "<table><tr><td>" * 40 + "<table>" + "<tr><td>a<td>b" * 5000 + f"<tr><td>{'k' * 79}<td>z</table>" + "<td>q</table>" * 40])
def test_html_tables_are_padded_within_bounds(page):
    text = html_text.render(page)
    assert len(text) < 4 * len(page) and "a" in text and text.rstrip()[-1] in "bzq"


def test_html_frame(spark, docs):
    docs([])
    rows = [(1, "<p>a"), (None, None), (2, ""), (2, "<p>a"), (3, "<p>" + "x " * 50_000)]
    d = spark.createDataFrame([(*r, "t") for r in rows], "page_id long, html string, text string")
    got = html_text.extract(d).collect()
    assert len(got) == 5 and sorted(r.n_lines for r in got) == [0, 0, 1, 1, 1] and max(len(r.text) for r in got) == 99_999
    assert html_text.extract(d.limit(0)).count() == 0


# --- url filter --------------------------------------------------------------------------------------

def test_url_filter(spark):
    rules = (("allow", "org", "/"), ("block", "example.org", "/es/"), ("block", "example.org", "/en/1"))
    pages = spark.createDataFrame([(1, "https://A.Example.org/es/1?x#y", "a"), (2, "http://notexample.org/es/", "a"), (3, None, "a"),
                                   (4, "no scheme", "a"), (5, "http://www.bad.net/p/?utm_source=q&k=1#f", "a"), (6, "https://bad.net/p?k=1&ref=z", "a"),
                                   (7, "http://bad.net/q", "a"), (7, "http://bad.net/q", "a"), (None, "http://example.org/en/12", "a"), (8, "x://h.org", "b")],
                                  "page_id long, url string, host string")
    listed = spark.createDataFrame([("http://bad.net/p/?k=1",), (None,), ("nothing",)], "url string")
    for most in (1 << 15, 1, 0):  # 0: blocks are met in a shuffle join
        got = {(r.page_id, r.host, r.path, r.rule, r.listed, r.verdict) for r in url_filter.filter_urls(pages, listed, rules, max_blocks=most).collect()}
        assert got == {(1, "a.example.org", "/es/1", "example.org/es/", False, "block"), (2, "notexample.org", "/es/", "org/", False, "allow"),
                       (3, "", "", None, False, "allow"), (4, "", "", None, False, "allow"), (5, "www.bad.net", "/p/", None, True, "block"),
                       (6, "bad.net", "/p", None, True, "block"), (7, "bad.net", "/q", None, False, "allow"),
                       (None, "example.org", "/en/12", "example.org/en/1", False, "block"), (8, "h.org", "", None, False, "allow")}
    assert url_filter.filter_urls(pages, listed, rules).count() == 10
    assert url_filter.filter_urls(pages, listed.limit(0), rules).where("listed").count() == 0
    assert url_filter.filter_urls(pages.limit(0), listed, rules).count() == 0


def test_bloom_has_no_false_negatives(spark):
    keys = spark.range(3000).select(F.concat(F.lit("k"), "id").alias("k"))
    blocks, n = url_filter.blocked_bloom(keys, "k")
    assert url_filter.possible_hits(keys, "k", blocks, n).where("not _possible").count() == 0
    others = spark.range(3000).select(F.concat(F.lit("o"), "id").alias("k"))
    assert url_filter.possible_hits(others, "k", blocks, n).where("_possible").count() < 150


def test_bloom_of_a_long_list_still_rejects(spark):
    keys = spark.range(800_000).select(F.concat(F.lit("k"), "id").alias("k"))
    blocks, n = url_filter.blocked_bloom(keys, "k")
    assert n > url_filter.MAX_BLOCKS
    others = spark.range(20_000).select(F.when(F.col("id") % 4 > 0, F.concat(F.lit("o"), "id")).alias("k")).unionByName(keys.limit(500))
    probed = url_filter.possible_hits(others, "k", blocks, n)
    assert probed.where("_possible and k like 'k%'").count() == 500 and probed.where("_possible and k not like 'k%'").count() < 750
    assert probed.count() == 20_500 and "BroadcastHashJoin" not in probed._jdf.queryExecution().sparkPlan().toString()


# --- shards ---------------------------------------------------------------------------------------------

def test_shards_are_contiguous_and_balanced(docs):
    rng = random.Random(1)
    rows = [(k, "x" * rng.randint(0, 200)) for k in range(1000)] + odd_texts(50) + [(5, "hot")] * 300
    got = sharding.assign_shards(docs(rows)).collect()
    assert sorted((r.size, r.text_crc32) for r in got) == sorted((len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for _, t in rows)
    by = {s: [r for r in got if r.shard == s] for s in range(16)}
    assert all(sorted(r.slot for r in x) == list(range(len(x))) for x in by.values())
    sizes, most = [sum(r.size for r in x) for x in by.values()], max(r.size for r in got)
    assert max(sizes) - min(sizes) <= 2 * most
    order = [r.doc_id for s in range(16) for r in sorted(by[s], key=lambda r: r.slot)]
    assert order == sorted(order, key=lambda i: (i is not None, i))
    assert sharding.assign_shards(docs(rows).limit(0)).count() == 0


# --- toxicity -------------------------------------------------------------------------------------------

def test_transducers_mark_clauses():
    g = toxicity.Grammar({"idiot\0": 1.0, "scum": 1.0})
    t = lambda x: {k % toxicity.MARKS: v for k, v in g.features(x.encode()).items() if k < toxicity.MARKS}
    assert t("an idiot. scummy") == {0: 2.0} and t("idiots") == {}
    assert t("you idiot") == {toxicity.TARGETED: 1.0} and t("idiot, you") == {toxicity.TARGETED: 1.0}
    assert t("you. idiot") == {0: 1.0}
    assert t("not an idiot") == {toxicity.NEGATED: 1.0} and t("not one of those real idiot") == {0: 1.0}
    assert t("the man said idiot") == {toxicity.REPORTED: 1.0} and t('"idiot"') == {toxicity.REPORTED: 1.0}
    threat = {k: v for k, v in g.features(b"we will kill them").items()}
    assert threat == {toxicity.MARKS + (toxicity.TARGETED | toxicity.INTENDED): 1.0}


@pytest.mark.parametrize("text, marks", [
    ("he said: you are an idiot", "TARGETED REPORTED"), ("you aren't an idiot", "TARGETED NEGATED"), ("they don’t call him idiot", "TARGETED NEGATED"),
    ("he never said to them idiot", "TARGETED"), ('he wrote "good. you idiot." and idiot', "TARGETED REPORTED|"), ('"a" idiot "b"', ""),
    ("„idiot“", "REPORTED"), ("you: idiot", ""), ("ce n'est pas un idiot", "NEGATED"), ("he said nothing. idiot", "")])
def test_clauses_are_linked(text, marks):
    g = toxicity.Grammar({"idiot\0": 1.0})
    want = collections.Counter(sum(getattr(toxicity, m) for m in path.split()) for path in marks.split("|"))
    assert g.features(text.encode()) == want


@pytest.mark.parametrize("text, marks", [
    ("a punch card", None), ("burn the toast", None), ("I'll burn it", "INTENDED"), ("we will kill them", "TARGETED INTENDED"),
    ("not going to hurt anyone", "NEGATED"), ("they punch you", "TARGETED")])
def test_threats_need_a_target_or_intent(text, marks):
    got = toxicity.Grammar({}).features(text.encode())
    if marks == "NEGATED":  # a negated intent is none
        assert got == {}
    else:
        assert got == ({} if marks is None else {toxicity.MARKS + sum(getattr(toxicity, m) for m in marks.split()): 1.0})


def test_composed_machine_equals_the_rules():
    """Every symbol's marks from the rules, read off the whole tape."""
    T = toxicity
    rng = random.Random(9)
    for _ in range(2000):
        tape = [rng.randrange(9) for _ in range(rng.randint(0, 12))]
        negated = [any(tape[j] == T.NEGATOR and T.COLON not in tape[j:k] for j in range(max(0, k - 3), k)) for k in range(len(tape))]
        quotes = [sum(x == T.QUOTE for x in tape[:k]) % 2 for k in range(len(tape))]
        want = []
        for k, x in enumerate(tape):
            last = max((j for j in range(k) if tape[j] == T.QUOTE and not quotes[k]), default=-1)
            clause = max((j for j in range(k) if tape[j] == T.COLON), default=-1)
            spoken = quotes[k] or any(tape[j] == T.REPORT and not negated[j] for j in range(last + 1, k))
            meant = any(tape[j] == T.INTENT and not negated[j] for j in range(clause + 1, k))
            aimed = T.TARGET in tape[clause + 1:k]
            m = (T.NEGATED if negated[k] and x in (T.INSULT, T.THREAT, T.REPORT, T.INTENT) else 0) + (T.REPORTED if spoken and x in T.BOTH else 0)
            want.append(m + (T.INTENDED if meant and x == T.THREAT else 0) + (T.TARGETED if aimed and x in T.BOTH else 0))
        assert T.Composition(T.FORWARD).run(tape)[0] == want, tape


def test_toxicity_takes_all_candidates_and_labels_of_any_kind(spark, docs):
    words = [f"q{k:04d}z" for k in range(6000)]
    rows = [(k, " ".join(words[k % 10::10])) for k in range(300)] + [(1000 + k, "calm day") for k in range(300)]
    rows += [(2000, words[17]), (2001, "calm")]
    labels = [(k, 1) for k in range(300)] + [(1000 + k, 0) for k in range(300)] + [(2000, 2), (2001, -1)]
    lab = spark.createDataFrame(labels, "doc_id long, toxic int")
    sample = toxicity.training_rows(docs(rows), lab)
    assert {r._toxic for r in sample.collect()} == {0, 1}
    units = toxicity.learn_insults(sample)
    assert len(units) >= 1 and all(any(w.encode().startswith(u.rstrip(chr(0)).encode()) for w in words) for u in units)
    got = {r.doc_id: r.predicted for r in toxicity.judge(docs(rows), lab).collect()}
    assert all(got[k] == 1 for k in range(300)) and not any(got[1000 + k] for k in range(300))


def test_toxicity_learns_from_its_part_of_the_labels(spark, docs):
    rng = random.Random(4)
    calm = lambda: " ".join(rng.choice(["tree", "river", "stone", "cloud", "bird"]) + rng.choice("abcdef") for _ in range(30))
    rows, labels = [], []
    for k in range(600):
        bad = k % 4 == 0
        rows.append((k, calm() + (f" you {rng.choice(['blargh', 'zork'])}{rng.choice('xyz')}. " if bad else " ") + calm()))
        labels.append((k, int(bad)))
    lab = spark.createDataFrame(labels, "doc_id long, toxic int")
    d = docs(rows + [(None, None), (9000, ""), (9001, None), (9001, "you zorky")])
    got = toxicity.judge(d, lab).collect()
    assert len(got) == 604 and all(0 <= r.score <= 1 and (r.score >= 0.7) == r.predicted for r in got)
    truth = dict(labels)
    assert all(r.predicted == truth[r.doc_id] for r in got if r.doc_id in truth)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in got if r.doc_id is not None)
    # held-out labels change nothing
    flipped = spark.createDataFrame([(k, 1 - t if zlib.crc32(str(k).encode()) % 3 == 1 else t) for k, t in labels], "doc_id long, toxic int")
    again = toxicity.judge(d, flipped).collect()
    assert sorted((str(r.doc_id), r.score) for r in got) == sorted((str(r.doc_id), r.score) for r in again)
    none = toxicity.judge(d, lab.limit(0)).collect()
    assert len(none) == 604 and toxicity.judge(d.limit(0), lab).count() == 0


def test_toxicity_held_out_on_tables(spark, docs):
    docs([])
    sf = "/root/testdata/sf0.01"
    d, lab = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    r = toxicity.judge(d, lab).join(lab, "doc_id").where("held_out").groupBy("toxic", "predicted").count().collect()
    n = {(x.toxic, x.predicted): x["count"] for x in r}
    assert n.get((0, 1), 0) <= 2 and n[(1, 1)] >= 0.7 * (n[(1, 1)] + n.get((1, 0), 0))
