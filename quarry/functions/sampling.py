"""Deterministic samples: the ``n`` rows with the smallest ``xxhash64(id, seed)``,
of all rows or of each stratum.

A bare ``orderBy(h).limit(n)`` makes every input partition send its own top-n to
a single merging task, i.e. (#partitions x n) rows, which is unbounded in the
input size.  Since the hash is uniform, the n smallest values lie below a
threshold that keeps only about ``oversample * n`` rows in expectation;
filtering by it first bounds what follows.  If the filter kept fewer than n rows
(vanishingly unlikely) it is raised and the pass repeated, so the result is
always exactly the n smallest.

What the filter leaves is merged by one task for n up to ``MERGED_ROWS``.  A
larger sample is cut where its n-th smallest hash lies: that is found by counting
the rows by the leading bits of the hash, then within the group of leading bits
that holds the n-th, and so on; counts of at most ``2 ** BITS`` groups a stratum
reach the driver, and no task merges rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.session import drop_scratch, materialize

_SPAN = 2.0 ** 64
_MIN = -(2 ** 63)
MERGED_ROWS = 100_000
BITS = 12


def hash_key(id_col: str, seed: int) -> Column:
    return F.xxhash64(F.col(id_col), F.lit(seed))


def _threshold(q: float) -> int:
    """Hash value below which a fraction ``q`` of uniform hashes fall."""
    return int(_MIN + q * _SPAN) if q < 1.0 else 2 ** 63 - 1


def _by_stratum(stratum: Column, values: dict, kind: str) -> Column:
    """A literal per stratum; null for others."""
    out = F.lit(None).cast(kind)
    for s, v in values.items():
        out = F.when(stratum.eqNullSafe(F.lit(s)), F.lit(v).cast(kind)).otherwise(out)
    return out


def _cuts(rows: DataFrame, stratum: Column, want: dict) -> dict:
    """Per stratum (hash, rest): the n-th smallest hash ``_h`` of its rows, and
    how many of the rows with just that hash belong to the n smallest."""
    prefix, left, width = {s: 0 for s in want}, dict(want), 64
    signed = F.col("_h").bitwiseXOR(F.lit(_MIN))  # as unsigned: the order of leading bits
    while width > 0:
        step = min(BITS, width)
        known = F.lit(True) if width == 64 else F.shiftrightunsigned(signed, width) == _by_stratum(stratum, prefix, "long")
        group = F.shiftrightunsigned(signed, width - step).bitwiseAND(F.lit((1 << step) - 1))
        counts: dict = {}
        for r in rows.where(known).groupBy(stratum.alias("s"), group.alias("g")).count().collect():
            counts.setdefault(r["s"], []).append((r["g"], r["count"]))
        for s in want:
            for g, n in sorted(counts.get(s, [])):
                if n >= left[s]:
                    prefix[s] = prefix[s] << step | g
                    break
                left[s] -= n
        width -= step
    return {s: ((prefix[s] ^ (1 << 63)) - ((prefix[s] ^ (1 << 63)) >> 63 << 64), left[s]) for s in want}


def smallest_by_stratum(df: DataFrame, stratum: Column, sizes: dict, n: int, seed: int, id_col: str = "id",
                        oversample: float = 4.0, merged_rows: int = MERGED_ROWS, keep_hash: str | None = None) -> DataFrame:
    """Exactly the ``min(n, N)`` rows with the smallest (hash, id) of each
    stratum of ``sizes`` ({value: N}), in one scan of the input for all strata;
    rows of other strata are left out."""
    want = {s: min(n, size) for s, size in sizes.items() if size}
    if not want:
        return df.limit(0)
    q, columns = {s: oversample * want[s] / sizes[s] for s in want}, df.columns
    src = df.withColumn("_h", hash_key(id_col, seed)).withColumn("_s", stratum)
    while True:
        limit = _by_stratum(F.col("_s"), {s: _threshold(q[s]) for s in want}, "long")
        pool = materialize(src.where(F.col("_h") <= limit), "sample")  # about oversample * n rows a stratum
        kept = {r["_s"]: r["count"] for r in pool.groupBy("_s").count().collect()}
        short = [s for s in want if kept.get(s, 0) < want[s]]
        if not short:
            break
        drop_scratch(df.sparkSession, pool._quarry_scratch)
        q = {s: q[s] * 4 if s in short else q[s] for s in want}
    out = None
    if max(want.values()) <= merged_rows:
        for s in want:
            part = pool.where(F.col("_s").eqNullSafe(F.lit(s))).orderBy("_h", id_col).limit(want[s])
            out = part if out is None else out.unionByName(part)
    else:
        cuts = _cuts(pool, F.col("_s"), want)
        out = pool.where(F.col("_h") < _by_stratum(F.col("_s"), {s: c for s, (c, _) in cuts.items()}, "long"))
        for s, (cut, rest) in cuts.items():  # rows with one hash: one id, as often as it repeats
            out = out.unionByName(pool.where(F.col("_s").eqNullSafe(F.lit(s)) & (F.col("_h") == F.lit(cut))).orderBy(id_col).limit(rest))
    out = out.select(*columns, "_h")
    return out.withColumnRenamed("_h", keep_hash) if keep_hash else out.drop("_h")


def smallest_by_hash(df: DataFrame, n: int, seed: int, id_col: str = "id", n_rows: int | None = None,
                     oversample: float = 4.0, keep_hash: str | None = None, verify: bool = True,
                     merged_rows: int = MERGED_ROWS) -> DataFrame:
    """Exactly the ``min(n, N)`` rows with the smallest (hash, id).  ``n_rows``
    (N) avoids a counting pass when known.  ``verify=False`` returns a sample
    of up to ``merged_rows`` rows unwritten and uncounted, with one task merging
    what the filter left; the caller must then check that it got ``min(n, N)``
    rows and call again with ``oversample=inf`` if not."""
    if n_rows is None:
        n_rows = df.count()
    if verify or min(n, n_rows) > merged_rows:
        return smallest_by_stratum(df, F.lit(0), {0: n_rows}, n, seed, id_col, oversample, merged_rows, keep_hash)
    q = oversample * n / n_rows if n_rows else 1.0
    src = df.withColumn("_h", hash_key(id_col, seed))
    if q < 1.0:
        src = src.where(F.col("_h") < F.lit(_threshold(q)))
    pool = src.orderBy("_h", id_col).limit(n)
    return pool.withColumnRenamed("_h", keep_hash) if keep_hash else pool.drop("_h")
