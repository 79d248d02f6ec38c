"""Toxicity by a weighted finite-state pattern grammar: small transducers for
insults, threats, targets, negation and reported speech are composed and run
over clauses; a text is scored by its matched clauses, not by isolated words.

A sentence becomes a tape of symbols: insult, threat, target, negator, report,
intent, colon, quotation mark, other. Contractions are written out first
("aren't" is "are not", "I'll" is "I will"). The transducers are a cascade: each
reads the symbols with the marks that those before it have put on them, and adds
its own. Negation marks what follows a negator within three words, verbs of
speech and intent among it; speech marks what follows a verb of speech that is not
negated to the end of the sentence, over a colon too, and what stands between
quotation marks, over sentences of a line; intent marks threats after a word of
intent that is not negated; the target, before or after, does not reach over a
colon. The composition is one machine over tuples of states, built as far as
texts need it. An insult counts on every path, a threat only with a target or
intent; a matched word's weight goes to the feature of its kind and marks, and
each path has a weight of its own. The score is a logistic function of the features.

Learned from labelled rows only: which words or word beginnings are insults
(they cover most of the toxic texts that no better one covers, and hardly occur
elsewhere), and the feature weights, drawn towards the prior in ``prior``. The
fit reads at most about ``clean_rows`` and ``toxic_rows`` labelled rows (picked
by a hash of the id); scoring reads every text whole.

Defined cases: null and empty texts match nothing and get the score of such
texts; without any toxic or clean label the prior alone scores; labels other than
0 and 1 teach nothing; null ids never learn and count as not held out; repeated
rows keep their rows; an empty table gives an empty result. Other columns are
not read.
"""

from __future__ import annotations

import math
import re
from collections import Counter, defaultdict
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import stage, utf8
from .decontaminate import split_words

CLEAN_ROWS = 20_000
TOXIC_ROWS = 3_000
THRESHOLD = 0.7
#: a unit is a word beginning, or a whole word (with END after it)
END = "\0"
SHORTEST, LONGEST = 3, 8
MIN_TEXTS = 3
PURITY = 0.9

# word classes of the grammar, in the corpus' languages
TARGETS = "you your he she they him her them we us du dich dir er sie ihr tu te toi il elle ils usted ustedes ellos ellas".split()
NEGATORS = "not no never none nor nicht kein keine nie ne pas jamais non nunca jamás".split()
REPORTS = "said says say called calls wrote claimed told quote quoted sagte sagt nannte dit disait appelle dijo dice llama".split()
INTENTS = "will shall going gonna must werde wird vais va voy vas".split()
THREATS = "kill hurt destroy beat punch stab shoot burn crush töten schlagen umbringen tuer frapper matar golpear".split()
_SENTENCE = re.compile(r"[.!?;]+")
_TOKEN = re.compile(r'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+|[":]')
#: typographic quotation marks and apostrophes are read as the plain ones
_PLAIN = str.maketrans("“”„«»’", '"""""\'')
_CONTRACTIONS = ((re.compile(r"n't\b"), " not"), (re.compile(r"'ll\b"), " will"), (re.compile(r"\bn'(?=\w)"), "ne "))

INSULT, THREAT, TARGET, NEGATOR, REPORT, INTENT, COLON, QUOTE, OTHER = range(9)
TARGETED, NEGATED, REPORTED, INTENDED = 1, 2, 4, 8
KINDS, MARKS = 2, 16


# --- transducers ------------------------------------------------------------------------

@dataclass
class Transducer:
    """Arcs (state, symbol) -> next state; a missing arc goes to ``rest`` of the state
    or stays. In a state of ``active`` the symbols ``marked`` are marked. A symbol of
    ``opens`` that has the mark ``unless`` is read as any other."""
    arcs: dict[tuple[int, int], int]
    mark: int
    marked: tuple[int, ...]
    active: tuple[int, ...]
    rest: dict[int, int]
    opens: int
    unless: int = 0

    def step(self, state: int, symbol: int, marks: int) -> tuple[int, int]:
        """(next state, marks) after a symbol with the marks put on it so far."""
        out = marks | self.mark if state in self.active and symbol in self.marked else marks
        read = OTHER if symbol == self.opens and marks & self.unless else symbol
        return self.arcs.get((state, read), self.rest.get(state, state)), out


def _after(symbol: int, mark: int, marked: tuple[int, ...], reach: int = 0, unless: int = 0) -> Transducer:
    """Marks symbols that come after ``symbol``, within ``reach`` symbols (0: up to a colon or the end)."""
    states = tuple(range(1, reach + 1)) if reach else (1,)
    arcs = {(s, symbol): 1 for s in (0, *states)} | {(s, COLON): 0 for s in states}
    return Transducer(arcs, mark, marked, states, {s: s + 1 if s < reach else 0 for s in states} if reach else {}, symbol, unless)


def _speech(marked: tuple[int, ...]) -> Transducer:
    """State 1 after a verb of speech, 2 between quotation marks."""
    return Transducer({(0, REPORT): 1, (0, QUOTE): QUOTED, (1, QUOTE): QUOTED, (QUOTED, QUOTE): 0}, REPORTED, marked, (1, QUOTED), {}, REPORT, NEGATED)


QUOTED = 2
BOTH = (INSULT, THREAT)
FORWARD = (_after(NEGATOR, NEGATED, (*BOTH, REPORT, INTENT), reach=3), _speech(BOTH), _after(INTENT, INTENDED, (THREAT,), unless=NEGATED),
           _after(TARGET, TARGETED, BOTH))
SPEECH = 1   # its place in FORWARD
BACKWARD = (_after(TARGET, TARGETED, BOTH),)


class Composition:
    """The cascade of transducers over one tape as one machine; arcs are kept once made."""

    def __init__(self, parts: tuple[Transducer, ...]):
        self.parts, self.start, self.arcs = parts, (0,) * len(parts), {}

    def run(self, symbols: Iterable[int], start: tuple[int, ...] | None = None) -> tuple[list[int], tuple[int, ...]]:
        """(marks of each symbol, last state)."""
        state, found = start or self.start, []
        for x in symbols:
            key = (state, x)
            if key not in self.arcs:
                marks, after = 0, []
                for part, s in zip(self.parts, state):
                    s, marks = part.step(s, x, marks)
                    after.append(s)
                self.arcs[key] = tuple(after), marks
            state, marks = self.arcs[key]
            found.append(marks)
        return found, state


class Grammar:
    """Features of a text's matched clauses, given the insult units and their weights."""

    def __init__(self, insults: dict[str, float]):
        self.classes = {w.encode(): (k, 1.0) for k, words in
                        ((TARGET, TARGETS), (NEGATOR, NEGATORS), (REPORT, REPORTS), (INTENT, INTENTS), (THREAT, THREATS)) for w in words}
        self.whole = {u[:-1].encode(): w for u, w in insults.items() if u[-1] == END}
        self.begin = {u.encode(): w for u, w in insults.items() if u[-1] != END}
        self.sizes = sorted({len(u) for u in self.begin}, reverse=True)
        self.heads = {u[:SHORTEST] for u in (*self.whole, *self.begin, *(w.encode() for w in THREATS))}
        self.forward, self.backward = Composition(FORWARD), Composition(BACKWARD)

    def symbol(self, word: bytes) -> tuple[int, float]:
        if word in self.whole:
            return INSULT, self.whole[word]
        for n in self.sizes:
            if word[:n] in self.begin:
                return INSULT, self.begin[word[:n]]
        return self.classes.get(word, (OTHER, 0.0))

    def features(self, text: bytes) -> dict[int, float]:
        """Sum of weights per feature (kind * MARKS + marks); empty if nothing matches."""
        heads = self.heads
        if not text.isascii():
            text = text.decode().translate(_PLAIN).encode()
        if not any(w[:SHORTEST] in heads for w in split_words(text)):
            return {}
        out: dict[int, float] = defaultdict(float)
        for line in text.lower().decode().split("\n"):
            for pattern, words in _CONTRACTIONS:
                line = pattern.sub(words, line)
            quoted = False
            for sentence in _SENTENCE.split(line):
                read = [self.token(t) for t in _TOKEN.findall(sentence)]
                symbols = [s for s, _ in read]
                start = tuple(QUOTED if quoted and k == SPEECH else 0 for k in range(len(FORWARD)))
                ahead, state = self.forward.run(symbols, start)
                quoted = state[SPEECH] == QUOTED
                if INSULT not in symbols and THREAT not in symbols:
                    continue
                behind = self.backward.run(reversed(symbols))[0][::-1]
                for (s, weight), a, b in zip(read, ahead, behind):
                    if s == INSULT or s == THREAT and (a | b) & (TARGETED | INTENDED):
                        out[s * MARKS + ((a | b) & (MARKS - 1))] += weight
        return out

    def token(self, token: str) -> tuple[int, float]:
        return (QUOTE, 0.0) if token == '"' else (COLON, 0.0) if token == ":" else self.symbol(token.encode())


def prior() -> np.ndarray:
    """Bias, then one weight per feature: what a match means before any label."""
    w = [-3.0]
    for kind in range(KINDS):
        for m in range(MARKS):
            w.append(3.0 + (0.5 if m & TARGETED else 0) - (1.5 if m & NEGATED else 0) - (1.0 if m & REPORTED else 0)
                     + (1.0 if m & INTENDED else -1.0 if kind == THREAT else 0))
    return np.array(w)


def _row(features: dict[int, float]) -> np.ndarray:
    x = np.zeros(1 + KINDS * MARKS)
    x[0] = 1
    for k, v in features.items():
        x[1 + k] = math.log1p(v)
    return x


def fit_weights(x: np.ndarray, y: np.ndarray, ridge: float = 0.1, rounds: int = 30) -> np.ndarray:
    """Logistic regression by Newton steps, drawn towards the prior."""
    start = w = prior()
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + ridge * np.eye(w.size), x.T @ (y - p) - ridge * (w - start))
        w = w + step
        if np.abs(step).max() < 1e-8:
            break
    return w


# --- learning -----------------------------------------------------------------------------

def held_out(id_: Column) -> Column:
    return F.coalesce(F.crc32(id_.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def training_rows(docs: DataFrame, labels: DataFrame, clean_rows: int = CLEAN_ROWS, toxic_rows: int = TOXIC_ROWS,
                  id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic") -> DataFrame:
    """(_text, _toxic) of a bounded sample of the labelled rows that may teach;
    equal texts once."""
    label_id, label = F.col(f"`{id_col}`"), F.col(f"`{label_col}`")
    own = labels.where(label_id.isNotNull() & label.isin(0, 1) & ~held_out(label_id)).groupBy(label_id.alias("_id")).agg(F.max(label).alias("_toxic"))
    n = {r["_toxic"]: r["count"] for r in own.groupBy("_toxic").count().collect()}
    share = F.when(F.col("_toxic") == 1, F.lit(min(1.0, toxic_rows / max(1, n.get(1, 0))))) \
        .otherwise(F.lit(min(1.0, clean_rows / max(1, n.get(0, 0)))))
    picked = own.where(F.pmod(F.xxhash64("_id", F.lit("fit")), F.lit(1_000_000)) < share * 1_000_000)
    texts = docs.select(F.col(f"`{id_col}`").alias("_id"), F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("_text"))
    rows = texts.join(F.broadcast(picked), "_id")  # bounded by clean_rows + toxic_rows
    return rows.groupBy(F.xxhash64("_text").alias("_k")).agg(F.first("_text").alias("_text"), F.max("_toxic").alias("_toxic")).drop("_k")


def _distinct_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        count: dict[int, Counter] = {0: Counter(), 1: Counter()}
        for text, toxic in zip(utf8(b.column(0)), b.column(1).to_pylist()):
            count[toxic].update(set(split_words(text)))
        words = [*{*count[0], *count[1]}]
        yield pa.RecordBatch.from_arrays(
            [pa.array([w.decode() for w in words], pa.string()), pa.array([count[1][w] for w in words], pa.int64()),
             pa.array([count[0][w] for w in words], pa.int64())], ["word", "toxic", "clean"])


def _units(word: str) -> Iterator[str]:
    yield from (word[:n] for n in range(SHORTEST, LONGEST + 1) if n <= len(word))
    yield word + END


def _units_of(known: set[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = [sorted({u for w in set(split_words(t)) for u in _units(w.decode())} & known) for t in utf8(b.column(0))]
            yield pa.RecordBatch.from_arrays([pa.array(found, pa.list_(pa.string()))], ["units"])
    return run


def learn_insults(rows: DataFrame) -> dict[str, float]:
    """Units and weights (0 to 1). Candidates are counted in Spark, all that are pure
    enough are candidates; of the toxic sample only which of them a text holds
    comes to the driver, which picks units by coverage."""
    words = rows.select("_text", F.col("_toxic").cast("int")).mapInArrow(_distinct_words, "word string, toxic long, clean long") \
        .groupBy("word").agg(F.sum("toxic").alias("t"), F.sum("clean").alias("c")).where(F.length("word") >= SHORTEST)
    sizes = F.sequence(F.lit(SHORTEST), F.least(F.lit(LONGEST), F.length("word")))
    units = F.concat(F.transform(sizes, lambda n: F.substring(F.col("word"), F.lit(1), n)), F.array(F.concat("word", F.lit(END))))
    counts = words.select(F.explode(units).alias("unit"), "t", "c").groupBy("unit").agg(F.sum("t").alias("t"), F.sum("c").alias("c"))
    pure = counts.where((F.col("t") >= MIN_TEXTS) & (F.col("t") >= PURITY * (F.col("t") + F.col("c") + 0.2)))
    rate = {r["unit"]: r["t"] / (r["t"] + r["c"] + 0.2) for r in pure.collect()}  # of at most toxic_rows texts
    texts = [r["units"] for r in rows.where("_toxic = 1").select("_text").mapInArrow(_units_of(set(rate)), "units array<string>").toLocalIterator()]
    has: dict[str, set[int]] = defaultdict(set)
    for k, units_ in enumerate(texts):
        for u in units_:
            has[u].add(k)
    found, open_ = {}, set(range(len(texts)))
    while has:
        gain, _, unit = max((len(v & open_), len(u), u) for u, v in has.items())
        if gain < max(MIN_TEXTS, len(texts) // 300):
            break
        found[unit] = rate[unit]
        open_ -= has.pop(unit)
    return found | _more(has, found, rate, len(texts))


def _more(has: dict[str, set[int]], found: dict[str, float], rate: dict[str, float], n: int) -> dict[str, float]:
    """Units that add no text to the cover but occur in one toxic text of fifty
    or more, unless a unit found covers the same words."""
    more: dict[str, float] = {}
    for u in sorted(has, key=lambda u: (-len(has[u]), -len(u), u)):
        if len(has[u]) < max(MIN_TEXTS, n / 50):
            break
        if not any(u.startswith(f) or f.startswith(u) for f in (*found, *more)):
            more[u] = rate[u]
    return more


def _features(insults: dict[str, float]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grammar = Grammar(insults)
        for b in batches:
            found = [_row(grammar.features(t)).tolist() for t in utf8(b.column(0))]
            yield pa.RecordBatch.from_arrays([pa.array(found, pa.list_(pa.float64())), b.column(1)], ["x", "y"])
    return run


def fit(docs: DataFrame, labels: DataFrame, **options) -> tuple[dict[str, float], np.ndarray]:
    """(insult units, weights) from the labelled rows that may teach."""
    rows = stage(training_rows(docs, labels, **options), "toxicity-sample")
    insults = learn_insults(rows)
    read = rows.select("_text", F.col("_toxic").cast("int").alias("y")).mapInArrow(_features(insults), "x array<double>, y int") \
        .groupBy("x").agg(F.sum("y").alias("t"), F.count(F.lit(1)).alias("n")).collect()  # at most the sample
    x, y = [], []
    for r in read:
        x += [r["x"]] * r["n"]
        y += [1.0] * r["t"] + [0.0] * (r["n"] - r["t"])
    return insults, fit_weights(np.array(x), np.array(y)) if x else prior()


# --- scoring --------------------------------------------------------------------------------

def score(docs: DataFrame, insults: dict[str, float], weights: np.ndarray, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, score, n_matches) of every text; n_matches is the number of
    features that matched."""
    rows = docs.select(F.col(f"`{id_col}`").alias("_id"), F.col(f"`{text_col}`").alias("_text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grammar = Grammar(insults)
        for b in batches:
            found = [grammar.features(t) for t in utf8(b.column(1))]
            z = [float(weights @ _row(f)) for f in found]
            p = [1 / (1 + math.exp(-min(30.0, max(-30.0, v)))) for v in z]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(p, pa.float64()), pa.array([len(f) for f in found], pa.int64())],
                                             ["_id", "score", "n_matches"])

    schema = rows.select("_id").schema.add("score", "double").add("n_matches", "long")
    return rows.mapInArrow(run, schema).withColumnRenamed("_id", id_col)


def judge(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """One row per document: id, held_out, score, predicted (score >= THRESHOLD)."""
    insults, weights = fit(docs, labels, id_col=id_col, text_col=text_col, **options)
    return score(docs, insults, weights, id_col, text_col).select(
        id_col, held_out(F.col(id_col)).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
