"""Exact percentiles (linear interpolation) that stay memory-bounded.

``percentile`` in Spark is exact but its final merge keeps one entry per
distinct value in a single task.  That is fine up to a few million values;
beyond ``small_n`` every needed rank is found in three passes at any size:

1. A KLL sketch per column (Spark's ``kll_sketch_agg_double``) brackets each
   rank by two values; it also counts infinities and NaNs, which are set aside.
2. A histogram of each bracket, and the exact number of values below it, narrow
   it to one of ``buckets`` parts; at most ``HISTOGRAM_ROWS`` rows for all ranks
   together reach the driver.  Should a sketch have missed its rank (it is a
   probabilistic bound), the bracket is widened and this pass repeated.
3. Spark's ``percentile`` over the values of each part gives the rank exactly.

A sketch of ``SKETCH_K`` is off by some 0.02 % of the ranks, so the last pass
merges about one distinct value in two million rows for each rank.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SMALL_N = 2_000_000
SKETCH_K = 8192
MARGIN = 0.001  # of the ranks, on both sides of a bracket: several times the sketch's error
HISTOGRAM_ROWS = 40_000


def _spark_percentiles(df: DataFrame, cols, probs) -> dict:
    arr = F.array(*[F.lit(float(p)) for p in probs])
    row = df.agg(*[F.percentile(F.col(c).cast("double"), arr).alias(f"q{i}")
                   for i, c in enumerate(cols)]).first()
    return {c: (list(row[f"q{i}"]) if row[f"q{i}"] is not None else [None] * len(probs))
            for i, c in enumerate(cols)}


def _ranks(n: int, p: float) -> tuple[int, int, float]:
    """(lower rank, upper rank, position) of percentile p among n values."""
    pos = (n - 1) * p
    return math.floor(pos), math.ceil(pos), pos


def _finite(c: str) -> Column:
    """The column's finite values; null for others."""
    x = F.col(c).cast("double")
    return F.when((x < float("inf")) & (x > float("-inf")), x)


def _brackets(df: DataFrame, cols, probs, margin: float):
    """Pass 1: values per column (count, -inf, +inf, NaN) and, per (column
    index, rank among the finite values), the bracket's two ends."""
    aggs = []
    for i, c in enumerate(cols):
        x = F.col(c).cast("double")
        aggs += [F.count(x).alias(f"n{i}"), F.count_if(x == float("-inf")).alias(f"low{i}"),
                 F.count_if(x == float("inf")).alias(f"high{i}"), F.count_if(F.isnan(x)).alias(f"nan{i}"),
                 F.min(_finite(c)).alias(f"a{i}"), F.max(_finite(c)).alias(f"b{i}"),
                 F.kll_sketch_agg_double(_finite(c), F.lit(SKETCH_K)).alias(f"k{i}")]
    stats = df.agg(*aggs).first()
    targets, asked = {}, {}
    for i in range(len(cols)):
        n, low = stats[f"n{i}"], stats[f"low{i}"]
        finite = n - low - stats[f"high{i}"] - stats[f"nan{i}"]
        for p in probs if n else ():
            for k in _ranks(n, p)[:2]:
                if low <= k < low + finite:
                    targets[(i, k - low)] = (stats[f"a{i}"], stats[f"b{i}"])
                    at = (k - low) / max(1, finite - 1)
                    asked.setdefault(i, []).extend([((i, k - low), max(0.0, at - margin)), ((i, k - low), min(1.0, at + margin))])
    if asked:
        sketches = df.sparkSession.createDataFrame([[bytearray(stats[f"k{i}"]) for i in asked]], ", ".join(f"k{i} binary" for i in asked))
        got = sketches.select(*[F.kll_sketch_get_quantile_double(f"k{i}", F.array(*[F.lit(float(q)) for _, q in asked[i]])).alias(f"q{i}")
                                for i in asked]).first()
        for i in asked:
            ends = got[f"q{i}"]
            for j in range(0, len(ends), 2):
                t, (a, b) = asked[i][j][0], targets[asked[i][j][0]]
                targets[t] = (a if asked[i][j][1] <= 0.0 else ends[j], b if asked[i][j + 1][1] >= 1.0 else ends[j + 1])
    return stats, targets


def _narrowed(df: DataFrame, cols, targets: dict, buckets: int):
    """Pass 2: per target (low, high, rank within, values): the part of its
    bracket that holds it; or a bracket end to look beyond where it is missed."""
    order = list(targets)
    cases = [F.struct(F.lit(j).alias("t"), _finite(cols[i]).alias("x"), F.lit(float(a)).alias("a"), F.lit(float(b)).alias("b"))
             for j, ((i, _), (a, b)) in enumerate(targets.items())]
    rows = df.select(F.inline(F.filter(F.array(*cases), lambda s: s["x"] <= s["b"])))
    half = F.col("b") / 2 - F.col("a") / 2  # never overflows
    bucket = (F.when(F.col("x") < F.col("a"), -1).when(half == 0, 0)
              .otherwise(F.least(F.floor((F.col("x") / 2 - F.col("a") / 2) / half * buckets), F.lit(buckets - 1))).cast("long"))
    hist: dict[int, list] = {}
    for h in rows.groupBy("t", bucket.alias("bk")).agg(F.count(F.lit(1)).alias("n"), F.min("x").alias("lo"), F.max("x").alias("hi")).collect():
        hist.setdefault(h["t"], []).append(h)
    parts, missed = {}, {}
    for j, t in enumerate(order):
        seen = 0
        for h in sorted(hist.get(j, []), key=lambda h: h["bk"]):
            if seen + h["n"] > t[1]:
                if h["bk"] < 0:
                    missed[t] = "below"
                else:
                    parts[t] = (h["lo"], h["hi"], t[1] - seen, h["n"])
                break
            seen += h["n"]
        else:
            missed[t] = "above"
    return parts, missed


def _values_at(df: DataFrame, cols, parts: dict) -> dict:
    """Pass 3: the values at the targets' ranks."""
    found = {t: lo for t, (lo, hi, _, _) in parts.items() if lo == hi}
    rest = [t for t in parts if t not in found]
    if rest:
        aggs = []
        for t in rest:
            lo, hi, rank, n = parts[t]
            x = _finite(cols[t[0]])
            aggs.append(F.percentile(F.when(x.between(lo, hi), x), F.array(F.lit(rank / (n - 1)))))
        for t, v in zip(rest, df.agg(*[a.alias(f"v{j}") for j, a in enumerate(aggs)]).first(), strict=True):
            found[t] = v[0]
    return found


def exact_percentiles(df: DataFrame, cols, probs, small_n: int = SMALL_N, histogram_rows: int = HISTOGRAM_ROWS,
                      margin: float = MARGIN, max_rows: int | None = None) -> dict:
    """``{col: [value per prob]}``; nulls ignored, NaN above all numbers; None
    for an all-null column.  ``max_rows`` (an upper bound on the row count,
    when the caller knows it) lets a small input go straight to Spark's exact
    ``percentile``."""
    cols = list(cols)
    probs = list(probs)
    if max_rows is not None and max_rows <= small_n:
        return _spark_percentiles(df, cols, probs)
    if max_rows is None:
        sizes = df.agg(*[F.count(F.col(c)).alias(f"n{i}") for i, c in enumerate(cols)]).first() if small_n else None
        if sizes is not None and max(sizes, default=0) <= small_n:
            return _spark_percentiles(df, cols, probs)
    stats, targets = _brackets(df, cols, probs, margin)
    found, wide = {}, dict(targets)
    while wide:
        parts, missed = _narrowed(df, cols, wide, max(2, histogram_rows // len(wide)))
        found |= _values_at(df, cols, parts)
        wide = {t: (stats[f"a{t[0]}"], wide[t][1]) if side == "below" else (wide[t][0], stats[f"b{t[0]}"])
                for t, side in missed.items()}
    out = {}
    for i, c in enumerate(cols):
        n, low = stats[f"n{i}"], stats[f"low{i}"]
        if n == 0:
            out[c] = [None] * len(probs)
            continue

        def at(k, i=i, n=n, low=low):
            if k < low:
                return float("-inf")
            if k >= n - stats[f"nan{i}"]:
                return float("nan")
            return float("inf") if k >= n - stats[f"nan{i}"] - stats[f"high{i}"] else found[(i, k - low)]

        res = []
        for p in probs:
            lo, hi, pos = _ranks(n, p)
            vlo, vhi = at(lo), at(hi)
            # same arithmetic as Spark's percentile, so both paths agree bit for bit
            res.append(vlo if hi == lo or vlo == vhi else (hi - pos) * vlo + (pos - lo) * vhi)
        out[c] = res
    return out


def exact_percentile(df: DataFrame, col: str, p: float, **kw) -> float | None:
    return exact_percentiles(df, [col], [p], **kw)[col][0]
