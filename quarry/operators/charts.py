"""The data behind the anomaly report's charts (no drawing).

Counts are computed over all rows, not over the reference's chart samples;
the sampling operators exist separately for callers that want a sample.
Per-label statistics are grouped (two labels) and joined back with a
broadcast whose size is bounded by the label domain; no window spans a whole
label group, since one label can hold most of the rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry import schemas as S
from quarry.functions.sampling import smallest_by_hash, smallest_by_stratum
from quarry.operators.quality import group_counts

LABELS = [S.LABEL_NORMAL, S.LABEL_ANOMALY]


def anomaly_label_counts(labelled: DataFrame) -> DataFrame:
    """Count and share (%) per label (the pie)."""
    total = labelled.select(F.count(F.lit(1))).scalar()
    return (labelled.groupBy("anomaly_label").agg(F.count(F.lit(1)).alias("count"))
            .select("anomaly_label", "count", F.round(F.col("count") * 100.0 / total, 2).alias("share_pct"))
            .orderBy(F.desc("count"), "anomaly_label"))


def anomalies_by(labelled: DataFrame, col: str) -> DataFrame:
    """Counts among anomalies per value of ``col``, most frequent first."""
    a = labelled.where((F.col("anomaly_label") == S.LABEL_ANOMALY) & F.col(col).isNotNull())
    return group_counts(a, [col])


def anomalies_by_category(labelled: DataFrame) -> DataFrame:
    return anomalies_by(labelled, "category_clean")


def anomalies_by_city(labelled: DataFrame) -> DataFrame:
    return anomalies_by(labelled, "city_clean")


def anomalies_by_event_type(labelled: DataFrame) -> DataFrame:
    return anomalies_by(labelled, "event_type_clean")


def price_histogram(labelled: DataFrame, bins: int = 50, lo: float = 0.0, hi: float = 100000.0,
                    value: str = "price_clean") -> DataFrame:
    """Per label: values clipped to [lo, hi], ``bins`` equal bins between the
    label's own min and max (last bin closed; a constant label spans
    value +- 0.5), count and density n / (N * width).  Empty bins omitted."""
    x = F.least(F.greatest(F.col(value).cast("double"), F.lit(lo)), F.lit(hi))
    clipped = labelled.select("anomaly_label", x.alias("x"))
    stats = (clipped.where(F.col("anomaly_label").isNotNull()).groupBy("anomaly_label")
             .agg(F.min("x").alias("mn"), F.max("x").alias("mx"), F.count(F.lit(1)).alias("n_label")))
    start = F.when(F.col("mx") > F.col("mn"), F.col("mn")).otherwise(F.col("mn") - 0.5)
    stop = F.when(F.col("mx") > F.col("mn"), F.col("mx")).otherwise(F.col("mx") + 0.5)
    # one entry per label value, as a one-row scalar subquery: lazy, no join
    per_label = stats.agg(F.map_from_entries(F.collect_list(F.struct(
        F.col("anomaly_label"), F.struct(start.alias("start"), ((stop - start) / bins).alias("width"), "n_label"))))).scalar()
    j = (clipped.where(F.col("anomaly_label").isNotNull()).withColumn("_s", F.element_at(per_label, F.col("anomaly_label")))
         .select("anomaly_label", "x", "_s.start", "_s.width", "_s.n_label"))
    b = F.least(F.floor((F.col("x") - F.col("start")) / F.col("width")).cast("int"), F.lit(bins - 1))
    return (j.groupBy("anomaly_label", b.alias("bin"))
            .agg(F.count(F.lit(1)).alias("count"), F.first("start").alias("start"), F.first("width").alias("width"),
                 F.first("n_label").alias("n_label"))
            .select("anomaly_label", "bin",
                    F.round(F.col("start") + F.col("bin") * F.col("width"), 6).alias("bin_start"),
                    F.round(F.col("start") + (F.col("bin") + 1) * F.col("width"), 6).alias("bin_end"),
                    "count",
                    F.round(F.col("count") / (F.col("n_label") * F.col("width")), 12).alias("density"))
            .orderBy("anomaly_label", "bin"))


def sample_rows(df: DataFrame, n: int, seed: int = S.SEED, id_col: str = "id",
                n_rows: int | None = None) -> DataFrame:
    """A fixed-seed sample of min(n, N) rows: the n smallest
    ``xxhash64(id, seed)`` (hash-threshold filter, then a bounded top-n)."""
    return smallest_by_hash(df, n, seed, id_col, n_rows=n_rows)


def stratified_sample(labelled: DataFrame, n_per_label: int = 5000, seed: int = S.SEED,
                      id_col: str = "id", labels=LABELS) -> DataFrame:
    """Up to ``n_per_label`` rows per label, the smallest by hash, from one scan
    for all labels.  Label sizes come from one small aggregate."""
    sizes = {r["anomaly_label"]: r["n"] for r in
             labelled.groupBy("anomaly_label").agg(F.count(F.lit(1)).alias("n")).collect()}
    wanted = {lab: sizes[lab] for lab in labels if lab in sizes}
    return smallest_by_stratum(labelled, F.col("anomaly_label"), wanted, n_per_label, seed, id_col)


def price_revenue_scatter(labelled: DataFrame, sample: int | None = None, seed: int = S.SEED,
                          x_range=(-10000.0, 85000.0), y_range=(-5000.0, 300000.0)) -> DataFrame:
    """Points (price, revenue, label) inside the plotted window; ``sample``
    first takes a fixed-seed sample as the chart does."""
    src = sample_rows(labelled, sample, seed) if sample else labelled
    p, r = F.col("price_clean"), F.col("revenue_clean")
    return (src.where(p.between(*x_range) & r.between(*y_range))
            .select("id", p.alias("price"), r.alias("revenue"), "anomaly_label"))
