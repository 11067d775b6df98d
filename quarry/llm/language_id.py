"""Language identification by nearest centroids.

A text's letters, lower-cased and with every other character as a word break,
give counts of hashed character n-grams (1 to 4 characters).  Counts become
TF-IDF vectors (1 + log tf, smoothed idf) of length 1.  Each language has a few
clustered centroids (spherical k-means); the language of the nearest centroid
by cosine is predicted, and a text that is farther from it than the language's
own training texts are (all but ``REJECTED`` of them) is marked as rejected.

Learned from training rows only.  Document frequencies for the idf are added up
over all training texts (one fixed-size array per task, merged in a tree); the
clustering uses a bounded sample (``SAMPLE_ROWS`` texts per language, and
``SAMPLE_TOTAL`` of all, taken by a hash of id and text).
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from quarry.llm.common import id_bucket, mix64, ship

BINS = 1 << 13
GRAMS = (1, 2, 3, 4)
CENTROIDS = 3
SAMPLE_ROWS = 400  # texts per language for the clustering (expected number)
SAMPLE_TOTAL = 100_000  # texts of all languages together (expected number, but 8 of each at least)
MODEL_BYTES = 1 << 30  # of the centroids that are broadcast
REJECTED = 0.005  # share of a language's sampled texts that lie beyond its distance
SLACK = 1.1  # and so much farther is allowed
FAN_IN = 64
UNDETERMINED = "und"
PIECE = 1 << 16  # characters hashed at a time


def letter_codes(text: str) -> np.ndarray:
    """Code points of the lower-cased text with runs of non-letters as one 0."""
    codes = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), "<u4")
    distinct, inverse = np.unique(codes, return_inverse=True)
    letter = np.array([chr(c).isalpha() for c in distinct], bool)
    codes = np.where(letter[inverse], codes, 0)
    return codes[(codes != 0) | np.append(True, codes[:-1] != 0)] if len(codes) else codes


def gram_bins(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """Bins and counts of the hashed n-grams of the whole text; none without letters."""
    codes = letter_codes(text or "")
    if not codes.any():
        return np.empty(0, np.int64), np.empty(0, np.int64)
    codes = np.concatenate([[0], codes, [0]]).astype(np.uint64)
    total = np.zeros(BINS, np.int64)
    for at in range(0, len(codes), PIECE):
        part = codes[at:at + PIECE + max(GRAMS) - 1]
        keys = np.zeros(len(part), np.uint64)
        for n in range(1, max(GRAMS) + 1):
            if len(part) < n:
                break
            keys = keys[:len(part) - n + 1] * np.uint64(0x100000001B3) + part[n - 1:] + np.uint64(1)
            own = keys[:PIECE]  # a gram belongs to the piece in which it begins
            if n in GRAMS:
                total += np.bincount((mix64(own, n) >> np.uint64(40)).astype(np.int64) % BINS, minlength=BINS)
    bins = np.flatnonzero(total)
    return bins, total[bins]


@dataclass
class LanguageModel:
    languages: list[str]
    idf: np.ndarray
    centroids: np.ndarray  # (n, BINS), length 1
    owner: np.ndarray  # language of each centroid
    reach: np.ndarray  # per language: the least cosine that is not rejected

    def vector(self, text: str | None) -> tuple[np.ndarray, np.ndarray]:
        bins, counts = gram_bins(text)
        v = (1.0 + np.log(counts)) * self.idf[bins] if len(bins) else np.empty(0)
        norm = np.sqrt((v * v).sum())
        return (bins, v / norm) if norm > 0 else (bins[:0], v[:0])

    def predict(self, text: str | None, min_cosine: float = 0.0) -> tuple[str, float, float, bool]:
        """Language, score, distance (1 - cosine) of the nearest centroid, and
        whether that is too far.  ``und`` and 0 where no cosine is above
        ``min_cosine``.  The score is the best cosine's share among each
        language's best, sharpened by a softmax."""
        bins, v = self.vector(text)
        if not len(bins) or not len(self.owner):
            return UNDETERMINED, 0.0, 1.0, True
        cosines = self.centroids[:, bins] @ v
        best = np.full(len(self.languages), -1.0)
        np.maximum.at(best, self.owner, cosines)
        i = int(best.argmax())
        far = float(1.0 - best[i])
        if best[i] <= min_cosine:
            return UNDETERMINED, 0.0, far, True
        return self.languages[i], float(1.0 / np.exp(20.0 * (best - best[i])).sum()), far, bool(best[i] < self.reach[i])


def least_cosine(cosines: np.ndarray) -> float:
    """The cosine below which a text is rejected: ``SLACK`` times the distance
    beyond which the ``REJECTED`` share of the texts lie."""
    return float(1.0 - SLACK * np.quantile(1.0 - cosines, 1.0 - REJECTED)) - 1e-9 if len(cosines) else 0.0


def _document_frequencies(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    df, n = np.zeros(BINS, np.int64), 0
    for pdf in batches:
        for text in pdf["text"]:
            bins, _ = gram_bins(text)
            df[bins] += 1
            n += len(bins) > 0
    yield pd.DataFrame({"df": [df.tobytes()], "n": [n]})


def _add_frequencies(pdf: pd.DataFrame) -> pd.DataFrame:
    df = sum((np.frombuffer(b, np.int64) for b in pdf["df"]), np.zeros(BINS, np.int64))
    return pd.DataFrame({"df": [df.tobytes()], "n": [int(pdf["n"].sum())]})


def document_frequencies(texts: DataFrame) -> tuple[np.ndarray, int]:
    level, left = texts.select("text").mapInPandas(_document_frequencies, "df binary, n long"), texts.rdd.getNumPartitions()
    while left > FAN_IN:
        left = -(-left // FAN_IN)
        level = (level.withColumn("_g", F.pmod(F.xxhash64("df", "n"), F.lit(left)))
                 .groupBy("_g").applyInPandas(_add_frequencies, "df binary, n long"))
    got = level.toPandas()
    return (np.frombuffer(_add_frequencies(got)["df"][0], np.int64), int(got["n"].sum())) if len(got) else (np.zeros(BINS, np.int64), 0)


def cluster(x: np.ndarray, k: int, seed: int, steps: int = 15) -> np.ndarray:
    """Spherical k-means with far-apart starting points; unit centroids."""
    rng = np.random.default_rng(seed)
    centers = [x[rng.integers(len(x))]]
    while len(centers) < min(k, len(x)):
        centers.append(x[int(np.max(x @ np.stack(centers).T, axis=1).argmin())])
    c = np.stack(centers)
    for _ in range(steps):
        own = (x @ c.T).argmax(axis=1)
        new = np.stack([x[own == j].sum(axis=0) if (own == j).any() else c[j] for j in range(len(c))])
        new /= np.linalg.norm(new, axis=1, keepdims=True) + 1e-12
        if np.allclose(new, c, atol=1e-7):
            break
        c = new
    return c


def train(docs: DataFrame, training=None, rows: int = SAMPLE_ROWS, centroids: int = CENTROIDS) -> LanguageModel:
    """Model from the training rows that have a text and a language."""
    ship(docs.sparkSession)
    training = F.coalesce(id_bucket("doc_id", 3) != 1, F.lit(False)) if training is None else training
    known = docs.where(training & F.col("text").isNotNull() & F.col("lang").isNotNull()).select("doc_id", "text", "lang")
    totals = {r["lang"]: r["count"] for r in known.groupBy("lang").count().collect()}
    # as many centroids a language as the model may hold, but for the first choice at most
    centroids = min(centroids, MODEL_BYTES // (8 * BINS) // max(1, len(totals)))
    if totals and not centroids:
        raise ValueError(f"centroids of {len(totals)} languages are more than {MODEL_BYTES} bytes")
    rows = min(rows, max(8, SAMPLE_TOTAL // max(1, len(totals))))
    df, n = document_frequencies(known)
    idf = np.log((1.0 + n) / (1.0 + df)) + 1.0
    u = F.pmod(F.xxhash64("doc_id", "text", F.lit(3)), F.lit(1 << 30)) / float(1 << 30)
    parts = docs.sparkSession.createDataFrame([(lang, min(1.0, rows / count)) for lang, count in totals.items()], "_lang string, _part double")
    chosen = (known.join(F.broadcast(parts), F.col("lang") == F.col("_lang")).where(u < F.col("_part")).select("doc_id", "text", "lang"))

    def vectors(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            got = [gram_bins(t) for t in pdf["text"]]
            yield pd.DataFrame({"doc_id": pdf["doc_id"], "lang": pdf["lang"], "bins": [b.astype("<i4").tobytes() for b, _ in got],
                                "counts": [c.astype("<i4").tobytes() for _, c in got]})

    sample = (chosen.mapInPandas(vectors, "doc_id long, lang string, bins binary, counts binary")
              .dropDuplicates().toPandas().sort_values(["lang", "doc_id", "bins", "counts"]))
    languages = sorted(totals)
    model = LanguageModel(languages, idf, np.empty((0, BINS)), np.empty(0, int), np.zeros(len(languages)))
    found, owner = [], []
    for i, lang in enumerate(languages):
        x = []
        for r in sample[sample["lang"] == lang].itertuples():
            bins = np.frombuffer(r.bins, "<i4")
            if len(bins):
                v = np.zeros(BINS)
                v[bins] = (1.0 + np.log(np.frombuffer(r.counts, "<i4"))) * idf[bins]
                x.append(v / np.linalg.norm(v))
        if x:
            c = cluster(np.stack(x), centroids, seed=i)
            model.reach[i] = least_cosine((np.stack(x) @ c.T).max(axis=1))
            found.append(c)
            owner += [i] * len(c)
    if found:
        model.centroids, model.owner = np.vstack(found), np.array(owner)
    return model


def report(docs: DataFrame, min_cosine: float = 0.0) -> DataFrame:
    """One row per document: ``held_out``, ``lang_pred``, ``score``, ``distance``
    (1 - cosine of the nearest centroid) and ``rejected`` (too far from it, for
    what its language's training texts are).

    A null text or one without letters is ``und`` with score 0, distance 1 and
    rejected, as is one that no centroid reaches (cosine at most
    ``min_cosine``).  Repeated rows are predicted as they are, a null id is not
    held out and not learned from, empty tables give an empty result."""
    spark = docs.sparkSession
    model = spark.sparkContext.broadcast(train(docs))  # MODEL_BYTES at most

    @F.pandas_udf("lang_pred string, score double, distance double, rejected boolean")
    def predict(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        m = model.value
        for texts in batches:
            yield pd.DataFrame([m.predict(t, min_cosine) for t in texts], columns=["lang_pred", "score", "distance", "rejected"])

    got = docs.select("doc_id", F.coalesce(id_bucket("doc_id", 3) == 1, F.lit(False)).alias("held_out"), predict("text").alias("_p"))
    return got.select("doc_id", "held_out", "_p.lang_pred", "_p.score", "_p.distance", "_p.rejected")
