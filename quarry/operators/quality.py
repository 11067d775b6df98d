"""Data-quality checks on ``raw_data``, the cleaned-table profile, and the
raw profile of the exploration notebook.

All are single-scan aggregates: several conditional counts share one pass
(``count_if``), group-bys combine map-side before their (small) shuffle, and
top-k reports compile to ``TakeOrderedAndProject`` (per-partition top-k, no
global sort).  Every top-k orders by count and then by the full group key so
ties are deterministic.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry import schemas as S
from quarry.functions.grouping import set_key, set_name
from quarry.functions.repeats import maybe_repeated


def _cnt() -> Column:
    return F.count(F.lit(1))


def _key_order(keys) -> list[Column]:
    return [F.col(k).asc_nulls_last() for k in keys]


def group_counts(df: DataFrame, keys, name: str = "count", min_count: int | None = None,
                 limit: int | None = None, descending: bool = True) -> DataFrame:
    """GROUP BY keys [HAVING count > min_count] ORDER BY count, keys [LIMIT].
    With ``min_count`` rows whose key no other row has are filtered out before
    the shuffle (functions.repeats), which reads the input once more."""
    keys = [keys] if isinstance(keys, str) else list(keys)
    if min_count:
        df = maybe_repeated(df.select(*keys), keys)
    g = df.groupBy(*keys).agg(_cnt().alias(name))
    if min_count is not None:
        g = g.where(F.col(name) > min_count)
    first = F.desc(name) if descending else F.asc(name)
    g = g.orderBy(first, *_key_order(keys))
    return g.limit(limit) if limit is not None else g


# ------------------------------------------------------------ raw checks
def qc_invalid_rows(raw: DataFrame) -> DataFrame:
    bad = (F.col("order_id").isNull() | (F.col("price") <= 0) | (F.col("quantity") <= 0)
           | F.col("event_type").isNull() | F.col("product_name").isNull() | F.col("city").isNull())
    return raw.agg(F.count_if(bad).alias("invalid_rows"))


def qc_null_counts(raw: DataFrame) -> DataFrame:
    return raw.agg(*[F.count_if(F.col(c).isNull()).alias(f"null_{c}")
                     for c in ["user_id", "product_id", "category", "payment_method", "timestamp"]])


def qc_duplicate_orders(raw: DataFrame, limit: int = 10) -> DataFrame:
    return group_counts(raw, ["order_id"], min_count=1, limit=limit)


def qc_order_lookup(raw: DataFrame, order_id: int = 2363, limit: int = 10) -> DataFrame:
    return (raw.where(F.col("order_id") == order_id).orderBy("id").limit(limit)
            .select("order_id", "product_id", "product_name", "price", "quantity"))


TRUE_DUP_KEYS = ["order_id", "product_id", "price", "quantity"]


def qc_true_duplicates(raw: DataFrame, limit: int = 10) -> DataFrame:
    return group_counts(raw, TRUE_DUP_KEYS, min_count=1, limit=limit)


def qc_true_duplicates_ts(raw: DataFrame, limit: int = 10) -> DataFrame:
    return group_counts(raw, TRUE_DUP_KEYS + ["timestamp"], min_count=1, limit=limit)


def qc_event_type_dist(raw: DataFrame) -> DataFrame:
    return group_counts(raw, ["event_type"])


def qc_ranges(raw: DataFrame) -> DataFrame:
    return raw.agg(F.min("price").alias("min_price"), F.max("price").alias("max_price"),
                   F.min("quantity").alias("min_quantity"), F.max("quantity").alias("max_quantity"))


def qc_category_dist(raw: DataFrame) -> DataFrame:
    return group_counts(raw, ["category"])


def qc_timestamp_length(raw: DataFrame, limit: int = 10) -> DataFrame:
    return (raw.orderBy("id").limit(limit)
            .select("timestamp", F.length("timestamp").alias("length")))


def qc_invalid_timestamps(raw: DataFrame) -> DataFrame:
    ts = F.col("timestamp")
    return raw.agg(F.count_if(ts.isNull() | (F.length(ts) < 10) | (ts == "")).alias("invalid_timestamps"))


def qc_timestamp_text_range(raw: DataFrame) -> DataFrame:
    """Text min/max (binary order), exactly what a string column gives."""
    return raw.agg(F.min("timestamp").alias("oldest"), F.max("timestamp").alias("newest"))


def qc_timestamp_out_of_year(raw: DataFrame, lo: str = "2026-01-01", hi: str = "2026-12-31") -> DataFrame:
    ts = F.col("timestamp")
    return raw.agg(F.count_if((ts < lo) | (ts > hi)).alias("out_of_range"))


def qc_timestamp_formats(raw: DataFrame) -> DataFrame:
    ts = F.col("timestamp")
    return raw.agg(F.count_if(ts.like("%T%")).alias("iso_format"),
                   F.count_if(ts.like("% %")).alias("normal_format"),
                   F.count_if(~ts.like("%T%") & ~ts.like("% %")).alias("unknown_format"))


def qc_city_dist(raw: DataFrame) -> DataFrame:
    return group_counts(raw, ["city"])


def qc_payment_dist(raw: DataFrame) -> DataFrame:
    return group_counts(raw, ["payment_method"])


def qc_table_counts(raw: DataFrame, cleaned: DataFrame) -> DataFrame:
    """Raw vs cleaned row counts and retention %.  The cleaned count is a
    scalar subquery, so both counts are one-row aggregates and nothing is
    joined."""
    n_clean = cleaned.select(_cnt()).scalar()
    counts = raw.agg(_cnt().alias("raw_rows")).select("raw_rows", n_clean.alias("cleaned_rows"))
    return counts.select(
        "raw_rows", "cleaned_rows",
        F.when(F.col("raw_rows") > 0, F.round(F.col("cleaned_rows") * 100.0 / F.col("raw_rows"), 2))
        .alias("retention_pct"))


# ------------------------------------------------------- cleaned profile
def clean_city_dist(cleaned: DataFrame) -> DataFrame:
    return group_counts(cleaned, ["city"], name="total_orders")


def clean_payment_dist(cleaned: DataFrame) -> DataFrame:
    return group_counts(cleaned, ["payment_method"], name="total_orders")


def clean_true_duplicates(cleaned: DataFrame, limit: int = 10) -> DataFrame:
    return group_counts(cleaned, TRUE_DUP_KEYS + ["event_timestamp"], min_count=1, limit=limit)


def clean_event_type_dist(cleaned: DataFrame) -> DataFrame:
    return group_counts(cleaned, ["event_type"], name="total_events")


def clean_revenue_stats(cleaned: DataFrame) -> DataFrame:
    return cleaned.agg(F.min("revenue").alias("min_revenue"), F.max("revenue").alias("max_revenue"),
                       F.round(F.avg("revenue"), 4).alias("avg_revenue"))


def clean_timestamp_range(cleaned: DataFrame) -> DataFrame:
    return cleaned.agg(F.min("event_timestamp").alias("oldest_timestamp"),
                       F.max("event_timestamp").alias("latest_timestamp"))


# ------------------------------------------------------- generic helpers
def preview(df: DataFrame, n: int = 20, order_by=None) -> DataFrame:
    """First ``n`` rows in a stated order (the reference's LIMIT had none)."""
    keys = order_by or df.columns
    keys = [keys] if isinstance(keys, str) else keys
    return df.orderBy(*_key_order(keys)).limit(n)


def row_count(df: DataFrame, name: str = "row_count") -> DataFrame:
    return df.agg(_cnt().alias(name))


# ------------------------------------------------- notebook raw profile
def profile_schema(df: DataFrame) -> DataFrame:
    """Columns, their types and non-null counts (pandas ``info()``), from one
    aggregate scan: ``position, column_name, data_type, non_null``."""
    counts = df.agg(*[F.count(F.col(c)).alias(f"_n{i}") for i, c in enumerate(df.columns)])
    rows = F.array(*[F.struct(F.lit(i).alias("position"), F.lit(c).alias("column_name"),
                              F.lit(t).alias("data_type"), F.col(f"_n{i}").alias("non_null"))
                     for i, (c, t) in enumerate(df.dtypes)])
    return counts.select(F.inline(rows))


def profile_raw(raw: DataFrame) -> DataFrame:
    p = F.col("price").try_cast("double")
    q = F.col("quantity").try_cast("double")
    return raw.agg(
        _cnt().alias("total_rows"),
        F.count_if(F.col("order_id").isNull()).alias("null_order_id"),
        F.count_if(F.col("price").isNull()).alias("null_price"),
        F.count_if(F.col("quantity").isNull()).alias("null_quantity"),
        F.count_if(F.col("city").isNull()).alias("null_city"),
        F.count_if(F.col("payment_method").isNull()).alias("null_payment"),
        F.count_if(p < 0).alias("price_negative"),
        F.count_if(p == 0).alias("price_zero"),
        F.count_if(p > S.MAX_PRICE).alias("price_over_max"),
        F.count_if(q == 0).alias("quantity_zero"),
        F.count_if(q > S.RAW_MAX_QUANTITY).alias("quantity_over_3"),
    )


def value_counts(df: DataFrame, col: str) -> DataFrame:
    """pandas ``value_counts``: null keys dropped, most frequent first."""
    return group_counts(df.where(F.col(col).isNotNull()), [col])


def qc_summary(raw: DataFrame, lo: str = "2026-01-01", hi: str = "2026-12-31") -> DataFrame:
    """Every scalar raw check in one aggregate (one scan instead of eight):
    invalid rows, null counts, price/quantity ranges, invalid timestamps, text
    timestamp range, out-of-year count and format counts."""
    ts = F.col("timestamp")
    bad = (F.col("order_id").isNull() | (F.col("price") <= 0) | (F.col("quantity") <= 0)
           | F.col("event_type").isNull() | F.col("product_name").isNull() | F.col("city").isNull())
    return raw.agg(
        _cnt().alias("total_rows"),
        F.count_if(bad).alias("invalid_rows"),
        *[F.count_if(F.col(c).isNull()).alias(f"null_{c}")
          for c in ["user_id", "product_id", "category", "payment_method", "timestamp"]],
        F.min("price").alias("min_price"), F.max("price").alias("max_price"),
        F.min("quantity").alias("min_quantity"), F.max("quantity").alias("max_quantity"),
        F.count_if(ts.isNull() | (F.length(ts) < 10) | (ts == "")).alias("invalid_timestamps"),
        F.min("timestamp").alias("oldest"), F.max("timestamp").alias("newest"),
        F.count_if((ts < lo) | (ts > hi)).alias("out_of_range"),
        F.count_if(ts.like("%T%")).alias("iso_format"),
        F.count_if(ts.like("% %")).alias("normal_format"),
        F.count_if(~ts.like("%T%") & ~ts.like("% %")).alias("unknown_format"),
    )


DIST_FIELDS = ["event_type", "category", "city", "payment_method"]


def qc_distributions(raw: DataFrame) -> DataFrame:
    """Counts per value of event type, category, city and payment method
    (nulls kept, as SQL GROUP BY does) from one GROUPING SETS scan:
    ``field, value, count``."""
    g = (raw.groupingSets([[c] for c in DIST_FIELDS], *DIST_FIELDS)
         .agg(_cnt().alias("count"), F.grouping_id().alias("_gid")))
    return (g.select(set_name(DIST_FIELDS).alias("field"), set_key(DIST_FIELDS).alias("value"), "count")
            .orderBy("field", F.desc("count"), F.col("value").asc_nulls_last()))
