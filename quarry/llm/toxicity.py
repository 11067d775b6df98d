"""Toxicity by a weighted finite-state pattern grammar.

A text is read as symbols, clause by clause: insults, threats, targets,
negations, reporting verbs, quotation marks and other words.  Four small
transducers are composed into one automaton (``compose``), which scores every
clause:

- negation: after a negation, insults and threats of the next three words
  count less;
- reported speech: after a reporting verb, or inside quotation marks, they
  count less;
- target: an insult or threat in a clause that names a target counts more, and
  a threat without a target counts little;
- threat chain: insult and threat in one clause strengthen each other.

What counts is clauses that match, so a text's features are the sum, the
largest and the number of its clause scores, by themselves and by length.

Trained here, from labelled rows only: the lexicon's insult stems (word
beginnings and whole words that stand out in toxic texts by a likelihood ratio
test) with their weights, and a logistic calibration.  Both use a bounded
sample of labelled rows (``SAMPLE_ROWS`` per class, taken by a hash of the id);
scoring reads every whole text.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import lru_cache
from itertools import product

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from quarry.llm.common import discard, id_bucket, ship
from quarry.llm.logistic import fit_logistic
from quarry.session import materialize

SAMPLE_ROWS = 6_000  # labelled rows per class for lexicon and calibration (expected number)
MIN_DF = 3  # a stem must be in so many toxic texts of the sample
MIN_RATIO = 8.0  # a stem must be so much commoner in toxic texts
LEXICON_BYTES = 64 << 20  # of the lexicon that is shipped to the workers, at 64 bytes and its letters a stem
STEM_CHARS = range(4, 9)
NEGATION_REACH = 3

#: Starting lexicon; learned stems join the insults.
BASE = {
    "I": "idiot moron stupid loser scum trash worthless pathetic disgusting clown dumb fool imbecile filth vermin".split(),
    "T": "kill hurt destroy attack beat punish crush strangle".split(),
    "G": "you your yours yourself u they them he she him her".split(),
    "N": "not no never neither nor without hardly isn aren wasn don doesn didn".split(),
    "R": "said says say told tells claimed claims called wrote writes quoted reported according allegedly".split(),
}
BASE_WEIGHT = {"I": 2.0, "T": 1.5}

_TOKEN = re.compile(r"\w+|[.!?;\n]|[\"“”«»]", re.UNICODE)
_CLAUSE = frozenset(".!?;\n")
_QUOTE = frozenset("\"“”«»")


# --- transducers ---------------------------------------------------------------

@dataclass(frozen=True)
class Transducer:
    """``step[(state, symbol)] = (next state, factor on hits, addend)``; what is
    missing keeps the state and changes nothing."""

    start: int
    states: int
    step: dict = field(hash=False)

    def at(self, state: int, symbol: str) -> tuple[int, float, float]:
        return self.step.get((state, symbol), (state, 1.0, 0.0))


def negation() -> Transducer:
    # state n: so many words are still in reach of a negation
    step = {}
    for n in range(NEGATION_REACH + 1):
        step[n, "N"] = (NEGATION_REACH, 1.0, 0.0)
        step[n, "Q"] = (n, 1.0, 0.0)
        for s in "oGR":
            step[n, s] = (max(0, n - 1), 1.0, 0.0)
        for s in "IT":
            step[n, s] = (max(0, n - 1), 0.4 if n else 1.0, 0.0)
    return Transducer(0, NEGATION_REACH + 1, step)


def reported() -> Transducer:
    # 0 own words, 1 after a reporting verb, 2 inside quotation marks
    step = {(s, x): (s, 1.0 if s == 0 else 0.6, 0.0) for s in range(3) for x in "IT"}
    step |= {(0, "R"): (1, 1.0, 0.0), (0, "Q"): (2, 1.0, 0.0), (1, "Q"): (2, 1.0, 0.0), (2, "Q"): (0, 1.0, 0.0)}
    return Transducer(0, 3, step)


def target() -> Transducer:
    # 0 nobody named, 1 target named, 2 insulted before a target was named
    step = {(0, "G"): (1, 1.0, 0.0), (2, "G"): (1, 1.0, 0.3), (0, "I"): (2, 1.0, 0.0), (1, "I"): (1, 1.2, 0.0),
            (0, "T"): (2, 0.4, 0.0), (2, "T"): (2, 0.4, 0.0), (1, "T"): (1, 1.2, 0.0)}
    return Transducer(0, 3, step)


def chain() -> Transducer:
    # bits: 1 an insult was seen, 2 a threat was seen
    step = {}
    for s in range(4):
        step[s, "I"] = (s | 1, 1.3 if s & 2 else 1.0, 0.0)
        step[s, "T"] = (s | 2, 1.3 if s & 1 else 1.0, 0.0)
    return Transducer(0, 4, step)


def compose(parts: list[Transducer], symbols: str = "oITGNRQ") -> dict[str, list[tuple[int, float, float]]]:
    """The product automaton as one table: ``table[symbol][state]``; factors
    multiply, addends add up."""
    states = list(product(*[range(p.states) for p in parts]))
    number = {s: i for i, s in enumerate(states)}
    table = {}
    for x in symbols:
        row = []
        for s in states:
            steps = [p.at(q, x) for p, q in zip(parts, s)]
            row.append((number[tuple(t[0] for t in steps)], math.prod(t[1] for t in steps), sum(t[2] for t in steps)))
        table[x] = row
    return table


# --- lexicon -------------------------------------------------------------------

def stems(word: str) -> list[str]:
    """Beginnings of a word, and the whole word marked with ``=``."""
    return [word[:n] for n in STEM_CHARS if n <= len(word)] + ["=" + word]


def base_lexicon() -> dict[str, tuple[str, float]]:
    return {"=" + w: (c, BASE_WEIGHT.get(c, 0.0)) for c, ws in BASE.items() for w in ws}


class WordClasses(dict):
    """word -> (class, weight) or None for other words; the strongest stem counts."""

    LIMIT = 150_000

    def __init__(self, lexicon: dict[str, tuple[str, float]]):
        super().__init__()
        self.lexicon = lexicon

    def __missing__(self, word):
        if len(word) == 1 and word in _CLAUSE:
            value = ("B", 0.0)
        elif len(word) == 1 and word in _QUOTE:
            value = ("Q", 0.0)
        else:
            found = [self.lexicon[s] for s in stems(word) if s in self.lexicon]
            value = max(found, key=lambda x: x[1]) if found else None
        if len(self) >= self.LIMIT:
            self.clear()
        self[word] = value
        return value


class Grammar:
    """The composed automaton over a lexicon; ``features`` scores a text."""

    def __init__(self, lexicon: dict[str, tuple[str, float]]):
        parts = [negation(), reported(), target(), chain()]
        self.table = compose(parts)
        self.classes = WordClasses(lexicon)

    def clauses(self, text: str) -> tuple[list[float], int]:
        """Scores of the clauses that match, and the number of tokens."""
        tokens = _TOKEN.findall(text.lower())
        marks = list(map(self.classes.__getitem__, tokens))
        table, other = self.table, self.table["o"]
        scores, state, score, hits, last = [], 0, 0.0, False, -1
        for i, m in enumerate(marks):
            if m is None:
                continue
            for _ in range(min(i - last - 1, NEGATION_REACH)):  # more other words change nothing
                state = other[state][0]
            last = i
            kind, weight = m
            if kind == "B":
                if hits:
                    scores.append(score)
                state, score, hits = 0, 0.0, False
                continue
            state, factor, addend = table[kind][state]
            if kind in "IT":
                score += weight * factor
                hits = True
            elif hits:
                score += addend
        if hits:
            scores.append(score)
        return scores, len(tokens)

    def features(self, text: str | None) -> list[float]:
        scores, n = self.clauses(text or "")
        total = sum(scores)
        return [math.log1p(total), max(scores, default=0.0), math.log1p(len(scores)),
                math.log1p(1000.0 * total / n) if n else 0.0, math.log1p(n)]


N_FEATURES = 5


@lru_cache(maxsize=2)
def _grammar(lexicon: tuple) -> Grammar:
    return Grammar(dict(lexicon))


# --- training ------------------------------------------------------------------

@dataclass
class ToxicityModel:
    lexicon: dict[str, tuple[str, float]]
    center: np.ndarray
    scale: np.ndarray
    weights: np.ndarray  # intercept last

    def probability(self, x: np.ndarray) -> np.ndarray:
        z = (x - self.center) / self.scale @ self.weights[:-1] + self.weights[-1]
        return 1.0 / (1.0 + np.exp(-np.clip(z, -500, 500)))


def _stem_counts(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """(y, stem, n): in how many texts of a class a stem is, added up by batch."""
    for pdf in batches:
        df: Counter = Counter()
        for y, text in zip(pdf["y"], pdf["text"]):
            df.update((y, s) for s in {s for w in set(_TOKEN.findall(text.lower())) for s in stems(w)})
        if df:
            yield pd.DataFrame({"y": [y for y, _ in df], "stem": [s for _, s in df], "n": list(df.values())})


def learned_stems(sample: DataFrame, n1: int, n0: int, max_bytes: int = LEXICON_BYTES) -> dict[str, float]:
    """Stems that stand out in the toxic texts of a sample (y, text), and their
    weights: tested by Spark, so that the driver gets only those that pass, in
    the order of the test as many as ``max_bytes`` hold."""
    a, b = (F.sum(F.when(F.col("y") == y, F.col("n")).otherwise(0)).cast("double") for y in (1, 0))
    counts = materialize(sample.select("y", "text").mapInPandas(_stem_counts, "y int, stem string, n long").groupBy("stem")
                         .agg(a.alias("a"), b.alias("b")).where(F.col("a") >= MIN_DF), "toxicity-stems")
    least = 2 * math.log(max(2, counts.count())) + 2  # chi-square level for one chance finding among all candidates

    def part(k, n, p):  # of a log likelihood; 0 log 0 is 0
        return F.when(k > 0, k * F.log(p)).otherwise(0.0) + F.when(n > k, (n - k) * F.log(1 - p)).otherwise(0.0)

    a, b, p = F.col("a"), F.col("b"), (F.col("a") + F.col("b")) / (n1 + n0)
    llr = 2 * (part(a, F.lit(n1), a / n1) + part(b, F.lit(n0), b / n0) - part(a, F.lit(n1), p) - part(b, F.lit(n0), p))
    weight = F.log((a + 0.5) / (n1 + 1)) - F.log((b + 0.5) / (n0 + 1))
    found = (counts.where(a / n1 > MIN_RATIO * b / n0).select("stem", llr.alias("llr"), weight.alias("weight")).where(F.col("llr") >= least)
             .orderBy(F.desc("llr"), F.desc("stem")).limit(max(1, max_bytes // 64)).collect())
    discard(counts)
    out, left = {}, max_bytes
    for r in found:
        left -= 64 + len(r["stem"].encode())
        if left < 0:
            break
        out[r["stem"]] = r["weight"]
    return out


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, rows: int, training) -> tuple[DataFrame, dict]:
    """Texts of about ``rows`` labelled training rows of each class, chosen by a
    hash of the id, and the classes' full numbers.  An id that is labelled more
    than once counts as 1 if any of its labels is.  Equal texts of one id count
    once, and of an id with many texts a hash of the text chooses, so the sample
    is bounded whatever ids repeat.  It is written once, for several readers."""
    known = (labels.where(training & F.col(label).isNotNull() & F.col("doc_id").isNotNull())
             .groupBy("doc_id").agg(F.max(F.col(label)).cast("int").alias("y")))
    totals = {r["y"]: r["count"] for r in known.groupBy("y").count().collect()}
    u = F.pmod(F.xxhash64("doc_id", F.lit(11)), F.lit(1 << 30)) / float(1 << 30)
    part = F.lit(0.0)
    for y, n in totals.items():
        part = F.when(F.col("y") == y, min(1.0, rows / n)).otherwise(part)
    chosen = materialize(known.where(u < part), "labelled-ids")  # about 2 * rows ids at any size
    texts = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).join(F.broadcast(chosen), "doc_id")
    most = max((r["count"] for r in texts.select("doc_id", "y").groupBy("y").count().collect()), default=0)
    if most > 2 * rows:
        texts = texts.where(F.pmod(F.xxhash64("doc_id", "text", F.lit(13)), F.lit(1 << 30)) < int(rows / most * (1 << 30)))
    sample = materialize(texts.dropDuplicates(["doc_id", "text"]), "labelled")
    discard(chosen)
    return sample, totals


def train(docs: DataFrame, labels: DataFrame, training=None, rows: int = SAMPLE_ROWS) -> ToxicityModel:
    """Lexicon and calibration from labelled rows.  Without rows of both
    classes the starting lexicon is used with fixed weights."""
    ship(docs.sparkSession)
    training = id_bucket("doc_id", 4) != 2 if training is None else training
    sample, totals = labelled_sample(docs, labels, "toxic", rows, training)
    lexicon = base_lexicon()
    default = ToxicityModel(lexicon, np.zeros(N_FEATURES), np.ones(N_FEATURES), np.array([2.0, 0.5, 0.5, 0.0, -0.2, -2.5]))
    if not totals.get(0) or not totals.get(1):
        return default
    sizes = {r["y"]: r["count"] for r in sample.groupBy("y").count().collect()}
    if not sizes.get(1) or not sizes.get(0):
        return default
    for s, w in learned_stems(sample, sizes[1], sizes[0]).items():
        if lexicon.get(s, ("I",))[0] in "IT":
            lexicon[s] = (lexicon.get(s, ("I",))[0], w)
    key = tuple(sorted(lexicon.items()))

    def features(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        g = _grammar(key)
        for pdf in batches:
            yield pd.DataFrame({"y": pdf["y"], "x": [g.features(t) for t in pdf["text"]]})

    rows_x = sample.select("y", "text").mapInPandas(features, "y int, x array<double>").toPandas()
    discard(sample)
    x, y = np.stack(rows_x["x"].to_numpy()), rows_x["y"].to_numpy(float)
    # each class weighs as much as in all labelled training rows
    weight = np.where(y == 1, totals[1] / max(1, (y == 1).sum()), totals[0] / max(1, (y == 0).sum()))
    center, scale = x.mean(axis=0), x.std(axis=0) + 1e-9
    w = fit_logistic((x - center) / scale, y, weight / weight.mean(), l2=1e-3)
    return ToxicityModel(lexicon, center, scale, w)


# --- scoring -------------------------------------------------------------------

def score_column(model: ToxicityModel, text):
    """Score of a text column, 0 to 1; null and empty texts get the score of a
    text without any clause."""
    key = tuple(sorted(model.lexicon.items()))

    @F.pandas_udf("double")
    def toxicity(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        g = _grammar(key)
        for texts in batches:
            x = np.array([g.features(t) for t in texts], float).reshape(-1, N_FEATURES)
            yield pd.Series(model.probability(x))
        g.classes.clear()  # workers live on, with other work to do

    return toxicity(F.coalesce(text, F.lit("")))


def report(docs: DataFrame, labels: DataFrame, threshold: float = 0.3) -> DataFrame:
    """One row per document: ``held_out``, ``score`` and ``predicted``.
    Repeated rows and ids are scored as they are; a null id is never held out
    and never trained on; other columns are ignored; empty tables give an empty
    result."""
    model = train(docs, labels)
    return (docs.select("doc_id", F.coalesce(id_bucket("doc_id", 4) == 2, F.lit(False)).alias("held_out"),
                        score_column(model, F.col("text")).alias("score"))
            .withColumn("predicted", (F.col("score") >= threshold).cast("int")))


def clean(docs: DataFrame, labels: DataFrame, threshold: float = 0.3) -> DataFrame:
    """The documents (all their columns) that are not rejected."""
    model = train(docs, labels)
    return docs.where(score_column(model, F.col("text")) < threshold)
