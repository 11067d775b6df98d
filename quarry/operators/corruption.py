"""Per-row defect flags for the kinds of corruption the event generator
injects, their profile, and how many flagged rows a label catches.

``corruption_flags`` is one narrow projection; the profile and report are
single-scan aggregates unpivoted into long form (one row per flag).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry import schemas as S
from quarry.functions import columns as C

UUID_TEXT = r"^[0-9a-f-]{36}$"


def flag_exprs(as_of: str | Column | None = None) -> dict[str, Column]:
    price, qty, ts = F.col("price"), F.col("quantity"), F.col("timestamp")
    uid = F.col("user_id").try_cast("long")
    if as_of is None:
        as_of_c = F.current_timestamp().cast("timestamp_ntz")
    elif isinstance(as_of, str):
        as_of_c = F.lit(as_of).cast("timestamp_ntz")
    else:
        as_of_c = as_of
    return {
        "negative_price": price < 0,
        "zero_price": price == 0,
        "price_outlier": price > S.MAX_PRICE,
        "missing_price": price.isNull(),
        "bot_traffic": uid.between(9000, 9020) & (qty == 0),
        "retried_order": F.col("order_id") == 1111,
        "quantity_outlier": qty >= 500,
        "uuid_user": F.col("user_id").rlike(UUID_TEXT),
        "missing_payment": F.col("payment_method").isNull(),
        "missing_order_id": F.col("order_id").isNull(),
        "missing_product_id": F.col("product_id").isNull(),
        "missing_product_name": F.col("product_name").isNull(),
        "missing_category": F.col("category").isNull(),
        "missing_quantity": qty.isNull(),
        "noncanonical_event_type": F.col("event_type").isNull() | ~F.col("event_type").isin(S.VALID_EVENT_TYPES),
        "noncanonical_city": F.col("city").isNull() | ~F.col("city").isin(S.RAW_VALID_CITIES),
        "timestamp_missing": ts.isNull() | (F.trim(ts) == "") | (ts == "NaT"),
        "timestamp_epoch": ts.startswith("1970-01-01"),
        "timestamp_day_first": ts.like("__-__-____ __:__%"),
        "timestamp_future": C.parse_event_timestamp(ts) > as_of_c,
    }


# flag names in report order (kept as plain text so importing needs no session)
FLAGS = ["negative_price", "zero_price", "price_outlier", "missing_price", "bot_traffic", "retried_order",
         "quantity_outlier", "uuid_user", "missing_payment", "missing_order_id", "missing_product_id",
         "missing_product_name", "missing_category", "missing_quantity", "noncanonical_event_type",
         "noncanonical_city", "timestamp_missing", "timestamp_epoch", "timestamp_day_first", "timestamp_future"]


def corruption_flags(raw: DataFrame, as_of: str | Column | None = None) -> DataFrame:
    """Raw rows plus one boolean per defect (null-safe: never null)."""
    exprs = flag_exprs(as_of)
    assert list(exprs) == FLAGS
    return raw.select("*", *[F.coalesce(exprs[k], F.lit(False)).alias(f"f_{k}") for k in FLAGS])


def _long(one_row: DataFrame, per_flag: dict[str, list[str]]) -> DataFrame:
    structs = [F.struct(F.lit(i).alias("pos"), F.lit(k).alias("flag"),
                        *[F.col(c).alias(alias) for alias, c in cols])
               for i, (k, cols) in enumerate(per_flag.items())]
    return one_row.select(F.inline(F.array(*structs)))


def corruption_profile(flags: DataFrame) -> DataFrame:
    """``flag, n, rate_pct`` over all rows."""
    aggs = [F.count(F.lit(1)).alias("_total")] + [F.count_if(F.col(f"f_{k}")).alias(f"n_{k}") for k in FLAGS]
    one = flags.agg(*aggs)
    long = _long(one, {k: [("n", f"n_{k}"), ("total", "_total")] for k in FLAGS})
    return long.select("flag", "n", F.when(F.col("total") > 0, F.round(F.col("n") * 100.0 / F.col("total"), 2))
                       .alias("rate_pct"), "pos").orderBy("pos").drop("pos")


def detection_report(flags_with_label: DataFrame) -> DataFrame:
    """Per flag: flagged rows, how many are labelled Anomaly, recall %."""
    lab = F.col("anomaly_label") == S.LABEL_ANOMALY
    aggs = []
    for k in FLAGS:
        aggs += [F.count_if(F.col(f"f_{k}")).alias(f"n_{k}"), F.count_if(F.col(f"f_{k}") & lab).alias(f"d_{k}")]
    one = flags_with_label.agg(*aggs)
    long = _long(one, {k: [("n", f"n_{k}"), ("detected", f"d_{k}")] for k in FLAGS})
    return long.select("flag", "n", "detected",
                       F.when(F.col("n") > 0, F.round(F.col("detected") * 100.0 / F.col("n"), 2)).alias("recall_pct"),
                       "pos").orderBy("pos").drop("pos")
