"""Quality by Bradley-Terry pairwise ranking.

Every whole text becomes a short vector of surface features.  Preference pairs
(a text labelled 1 over a text labelled 0) are drawn from a bounded sample of
labelled training rows (``SAMPLE_ROWS`` per class, taken by a hash of the id;
``PAIRS_PER_ROW`` partners for each), and a linear score is learned by the
logistic loss on feature differences, so that P(a over b) = sigmoid(s(a) -
s(b)).  The decision threshold is a quantile of the training scores: the share
of label 0 among all labelled training rows.  The reported score is
sigmoid(s - threshold).
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from quarry.llm.common import discard, id_bucket, ship
from quarry.llm.logistic import fit_logistic
from quarry.llm.toxicity import labelled_sample

SAMPLE_ROWS = 4_000  # labelled rows per class (expected number)
PAIRS_PER_ROW = 8

_SYMBOLS = re.compile(r"[#$%&*+<=>@\\^_`{|}~\[\]]")
FEATURES = ("log_words", "mean_word", "upper", "digit", "symbol", "punct", "blank", "doubled", "bars", "distinct",
            "top_word", "repeated_5", "line_words", "repeated_lines", "no_stop", "entropy", "shouted", "long_words", "sentence_words")


def features(text: str | None) -> list[float]:
    """Surface features; an empty text has all zeros."""
    t = text or ""
    words = t.split()
    n, chars = len(words), len(t)
    if not n:
        return [0.0] * len(FEATURES)
    counts = Counter(words)
    letters = Counter(t)
    upper = sum(c for ch, c in letters.items() if ch.isupper())
    alpha = sum(c for ch, c in letters.items() if ch.isalpha())
    digit = sum(c for ch, c in letters.items() if ch.isdigit())
    blank = sum(c for ch, c in letters.items() if ch.isspace())
    symbol = len(_SYMBOLS.findall(t))
    lines = [x for x in t.split("\n") if x.strip()]
    top = counts.most_common(1)[0][1]
    five = len(set(zip(words, words[1:], words[2:], words[3:], words[4:]))) / (n - 4) if n > 4 else 1.0
    ends = Counter(w[-1] for w in words)
    doubled = sum(c for w, c in counts.items() if len(w) > 1 and not w[-1].isalnum() and w[-1] == w[-2])
    shouted = sum(c for w, c in counts.items() if len(w) > 1 and w.isupper())
    long_words = sum(c for w, c in counts.items() if len(w) > 25)
    short = sum(c for w, c in counts.items() if len(w) <= 3)
    entropy = -sum(c / chars * math.log2(c / chars) for c in letters.values())
    stops = sum(ends[e] for e in ".!?")
    return [math.log1p(n), (chars - blank) / n, upper / max(1, alpha), digit / chars, symbol / chars,
            (chars - alpha - digit - blank) / chars, blank / chars, doubled / n, (counts["|"] + t.count("\t")) / n,
            len(counts) / n, top / n, 1.0 - five, math.log1p(n / max(1, len(lines))),
            1.0 - len(set(lines)) / max(1, len(lines)), 1.0 - short / n, entropy, shouted / n, long_words / n,
            math.log1p(n / (stops + 1))]


def expand(x: np.ndarray) -> np.ndarray:
    """The features, their squares and square roots: both ends may be bad."""
    return np.hstack([x, x * x, np.sqrt(np.abs(x))])


@dataclass
class QualityModel:
    center: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    threshold: float

    def raw(self, x: np.ndarray) -> np.ndarray:
        return np.clip((expand(x) - self.center) / self.scale, -8, 8) @ self.weights

    def probability(self, x: np.ndarray) -> np.ndarray:
        return 1.0 / (1.0 + np.exp(-np.clip(self.raw(x) - self.threshold, -500, 500)))


def weighted_quantile(values: np.ndarray, weight: np.ndarray, q: float) -> float:
    order = np.argsort(values, kind="stable")
    cum = np.cumsum(weight[order])
    at = int(np.searchsorted(cum, q * cum[-1]))
    below, above = values[order[max(0, at - 1)]], values[order[min(at, len(values) - 1)]]
    return float((below + above) / 2)


def bradley_terry(x: np.ndarray, y: np.ndarray, pairs_per_row: int = PAIRS_PER_ROW, seed: int = 5, l2: float = 1e-3) -> np.ndarray:
    """Weights of the linear score from random (label 1, label 0) pairs."""
    rng = np.random.default_rng(seed)
    good, bad = np.flatnonzero(y == 1), np.flatnonzero(y == 0)
    n = pairs_per_row * max(len(good), len(bad))
    first, second = good[np.arange(n) % len(good)], bad[rng.permutation(n) % len(bad)]
    diff = x[first] - x[second]
    return fit_logistic(diff, np.ones(n), l2=l2, intercept=False)


def _features(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for pdf in batches:
        yield pd.DataFrame({"doc_id": pdf["doc_id"], "y": pdf["y"], "x": [features(t) for t in pdf["text"]]})


def train(docs: DataFrame, labels: DataFrame, training=None, rows: int = SAMPLE_ROWS) -> QualityModel | None:
    """None when the training rows do not have both labels."""
    ship(docs.sparkSession)
    training = id_bucket("doc_id", 3) != 1 if training is None else training
    sample, totals = labelled_sample(docs, labels, "quality", rows, training)
    got = sample.select("doc_id", "y", "text").mapInPandas(_features, "doc_id long, y int, x array<double>").toPandas()
    discard(sample)
    if not {0, 1} <= set(got["y"]):
        return None
    got = got.assign(k=[tuple(v) for v in got["x"]]).sort_values(["doc_id", "k"], kind="stable")  # any partitioning, same model
    x, y = expand(np.stack(got["x"].to_numpy())), got["y"].to_numpy()
    center, scale = x.mean(axis=0), x.std(axis=0)
    scale = np.where(scale > 1e-9, scale, 1.0)
    z = np.clip((x - center) / scale, -8, 8)
    w = bradley_terry(z, y)
    share = {c: totals[c] / (y == c).sum() for c in (0, 1)}
    weight = np.where(y == 1, share[1], share[0])
    return QualityModel(center, scale, w, weighted_quantile(z @ w, weight, totals[0] / (totals[0] + totals[1])))


def score_column(model: QualityModel | None, text):
    @F.pandas_udf("double")
    def quality(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            x = np.array([features(t) for t in texts], float).reshape(-1, len(FEATURES))
            yield pd.Series(model.probability(x) if model else np.full(len(x), 0.5))

    return quality(F.coalesce(text, F.lit("")))


def report(docs: DataFrame, labels: DataFrame, threshold: float = 0.5) -> DataFrame:
    """One row per document: ``held_out``, ``score`` and ``predicted``.  Null
    texts score as empty ones.  Without both labels in the training rows every
    score is 0.5.  Repeated rows are scored as they are, a null id is not held
    out, other columns are ignored, empty tables give an empty result."""
    model = train(docs, labels)
    return (docs.select("doc_id", F.coalesce(id_bucket("doc_id", 3) == 1, F.lit(False)).alias("held_out"),
                        score_column(model, F.col("text")).alias("score"))
            .withColumn("predicted", (F.col("score") >= threshold).cast("int")))
