"""Feature preparation for anomaly detection on raw rows.

``prepare_features`` adds the cleaned numeric columns and the ``Unknown``
filled categorical columns (narrow projection).  ``label_encode`` replaces
each categorical text by its rank among the sorted distinct values.

The code dictionary for all encoded columns is built in ONE pass over the
input: (column, value) pairs are exploded from each row, de-duplicated with a
map-side partial aggregate, and ranked per column.  Its size is checked
before use: a small dictionary (the normal case for categorical columns) is
inlined as a literal map evaluated inside the scan stage, a larger one is
broadcast, and past ``broadcast_limit`` entries it is joined with a shuffle
join.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry import schemas as S
from quarry.functions import columns as C
from quarry.functions.ids import position, with_starts
from quarry.session import materialize

ENCODED = [("category_clean", "category_encoded"), ("city_clean", "city_encoded"),
           ("event_type_clean", "event_type_encoded"), ("payment_clean", "payment_encoded")]
BROADCAST_LIMIT = 1_000_000
INLINE_LIMIT = 100


def prepare_features(raw: DataFrame, price_dtype: str | None = None) -> DataFrame:
    """Add price/quantity/revenue features and ``Unknown``-filled texts."""
    if price_dtype is None:
        price_dtype = "string" if dict(raw.dtypes).get("price") == "string" else "double"
    return raw.select(
        "*",
        C.coerce_price("price", price_dtype).alias("price_clean"),
        C.coerce_quantity("quantity").alias("quantity_clean"),
    ).select(
        "*",
        (F.col("price_clean") * F.col("quantity_clean")).alias("revenue_clean"),
        C.fill_unknown("category").alias("category_clean"),
        C.fill_unknown("city").alias("city_clean"),
        C.fill_unknown("event_type").alias("event_type_clean"),
        C.fill_unknown("payment_method").alias("payment_clean"),
    )


def value_dictionary(df: DataFrame, columns: list[str]) -> DataFrame:
    """``(column, value, n)``: distinct values per column with their row
    counts, from one pass (map-side partial aggregation)."""
    pairs = F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value"))
                      for c in columns])
    return df.select(F.inline(pairs)).groupBy("column", "value").agg(F.count(F.lit(1)).alias("n"))


def assign_codes(dictionary: DataFrame) -> DataFrame:
    """Add ``code``: each value's 0-based rank within its column, computed
    distributed (no task holds a whole column's values).

    A range-partitioned sort puts every partition's rows in global order;
    prefix sums of the partition sizes (one row per partition), joined, give
    each partition's starting rank; subtracting each column's first rank restarts
    the count per column.
    """
    ordered = dictionary.orderBy("column", "value")
    ranked = materialize(ordered.select("*", F.spark_partition_id().alias("_pid"), position().alias("_pos")), "dictionary")
    placed = with_starts(ranked, ranked.groupBy("_pid").count())
    glob = placed.select(*dictionary.columns, (F.col("_start") + F.col("_pos")).alias("_g"))
    first = glob.groupBy("column").agg(F.min("_g").alias("_first"))   # one row per encoded column
    return (glob.join(F.broadcast(first), "column")
            .select(*[c for c in dictionary.columns], (F.col("_g") - F.col("_first")).cast("int").alias("code")))


def _local_codes(rows) -> list[dict]:
    """Codes for a small collected dictionary: sorted per column (Python's
    code-point order equals Spark's binary UTF-8 string order)."""
    by_col: dict[str, list] = {}
    for r in rows:
        by_col.setdefault(r["column"], []).append(r)
    out = []
    for col, rs in by_col.items():
        for code, r in enumerate(sorted(rs, key=lambda r: (r["value"] is not None, r["value"] or ""))):
            out.append({"column": col, "value": r["value"], "n": r["n"], "code": code})
    return out


def encoding_map(df: DataFrame, columns: list[str], with_counts: bool = False) -> DataFrame:
    """``(column, value, code[, n])``: per column, sorted distinct values ->
    0..n-1 (and each value's row count)."""
    codes = assign_codes(value_dictionary(df, columns))
    return codes if with_counts else codes.drop("n")


def _lookup_encode(df: DataFrame, pairs, rows) -> DataFrame:
    """Dictionary small enough to inline: a literal map lookup per column,
    evaluated inside the scan stage (no join, no exchange)."""
    by_col: dict[str, list] = {}
    for r in rows:
        by_col.setdefault(r["column"], []).append(r)
    exprs = []
    for in_col, out_col in pairs:
        kv = []
        for r in sorted(by_col.get(in_col, []), key=lambda r: r["code"]):
            if r["value"] is not None:
                kv += [F.lit(r["value"]), F.lit(r["code"])]
        lookup = F.create_map(*kv) if kv else F.create_map().cast("map<string,int>")
        exprs.append(F.element_at(lookup, F.col(in_col).cast("string")).cast("int").alias(out_col))
    return df.select("*", *exprs)


def _join_encode(df: DataFrame, pairs, codes: DataFrame, broadcast: bool) -> DataFrame:
    out = df
    for in_col, out_col in pairs:
        m = codes.where(F.col("column") == in_col).select(
            F.col("value").alias(in_col), F.col("code").alias(out_col))
        out = out.join(F.broadcast(m) if broadcast else m, on=in_col, how="left")
    return out


def _encode_with(prepared: DataFrame, pairs, dictionary: DataFrame, inline_limit: int,
                 broadcast_limit: int) -> tuple[DataFrame, int]:
    """Encode using a value dictionary whose size is checked first; returns the
    encoded frame and the dictionary's row count for column 1.  Nothing is
    cached: a dictionary too large to inline is written once as a table."""
    first_col = pairs[0][0]
    rows = dictionary.limit(inline_limit + 1).collect()
    if len(rows) <= inline_limit:
        n = sum(r["n"] for r in rows if r["column"] == first_col)
        return _lookup_encode(prepared, pairs, _local_codes(rows)), n
    dictionary = materialize(dictionary, "dictionary")
    n = dictionary.where(F.col("column") == first_col).agg(F.sum("n")).first()[0] or 0
    size = dictionary.count()
    return _join_encode(prepared, pairs, assign_codes(dictionary), size <= broadcast_limit), n


def label_encode(df: DataFrame, pairs=ENCODED, broadcast_limit: int = BROADCAST_LIMIT,
                 inline_limit: int = INLINE_LIMIT) -> DataFrame:
    """Replace each ``in_col`` by its code as ``out_col``.

    The dictionary's size is checked first: up to ``inline_limit`` entries it
    is inlined as a literal map; up to ``broadcast_limit`` it is broadcast;
    beyond that it is joined with a shuffle join.
    """
    d = value_dictionary(df, [a for a, _ in pairs])
    return _encode_with(df, pairs, d, inline_limit, broadcast_limit)[0]


def build_features(raw: DataFrame, broadcast_limit: int = BROADCAST_LIMIT,
                   inline_limit: int = INLINE_LIMIT) -> DataFrame:
    """Raw rows + the 7 model features (other raw columns are kept)."""
    return label_encode(prepare_features(raw), broadcast_limit=broadcast_limit, inline_limit=inline_limit)


def build_features_counted(raw: DataFrame, inline_limit: int = INLINE_LIMIT,
                           broadcast_limit: int = BROADCAST_LIMIT) -> tuple[DataFrame, int]:
    """``build_features`` plus the row count, both from one dictionary pass
    (the counts of one encoded column's values add up to the row count).
    At most ``inline_limit + 1`` dictionary rows are ever collected.

    Rows are not cached: every later pass reads the columnar source, so a run
    never sees rows that an earlier run of the session left in memory."""
    prepared = prepare_features(raw)
    return _encode_with(prepared, ENCODED, value_dictionary(prepared, [a for a, _ in ENCODED]),
                        inline_limit, broadcast_limit)


# mean and std are sums of doubles whose last bits depend on addition order
# (partitioning, engine); 4 decimals keeps the profile stable across both
STAT_DECIMALS = 4


def describe_features(features: DataFrame, cols=S.FEATURE_COLS) -> DataFrame:
    """count, mean, std (n-1), min, 25/50/75 % (linear interpolation), max per
    feature, one row per feature, computed in one aggregate.  Percentiles are
    exact order statistics; mean and std are rounded to ``STAT_DECIMALS``."""
    from quarry.functions.quantile import exact_percentiles

    aggs = []
    for c in cols:
        x = F.col(c).cast("double")
        aggs += [F.count(x).alias(f"{c}__count"), F.avg(x).alias(f"{c}__mean"),
                 F.stddev_samp(x).alias(f"{c}__std"), F.min(x).alias(f"{c}__min"),
                 F.max(x).alias(f"{c}__max")]
    wide = features.agg(*aggs)
    q = exact_percentiles(features, cols, [0.25, 0.5, 0.75])
    rows = F.array(*[F.struct(
        F.lit(c).alias("feature"), F.col(f"{c}__count").alias("count"),
        F.round(F.col(f"{c}__mean"), STAT_DECIMALS).alias("mean"),
        F.round(F.col(f"{c}__std"), STAT_DECIMALS).alias("std"),
        F.col(f"{c}__min").alias("min"), F.lit(q[c][0]).alias("p25"), F.lit(q[c][1]).alias("p50"),
        F.lit(q[c][2]).alias("p75"), F.col(f"{c}__max").alias("max")) for c in cols])
    return wide.select(F.inline(rows))
