"""``raw_data -> cleaned_data``: filter, project, de-duplicate.

Plan shape: Scan -> Filter (pushed into the scan where the predicate is on a
bare column) -> Project -> partial HashAggregate (map-side de-duplication, so
a hot duplicate group collapses before the shuffle) -> hash exchange on the
12 output columns -> final HashAggregate.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry import schemas as S
from quarry.functions import columns as C


def valid_row() -> Column:
    """The 12 conjuncts; bounds use the unrounded price; null user id, city
    and timestamp are allowed."""
    return (F.col("order_id").isNotNull()
            & F.col("product_id").isNotNull()
            & F.col("product_name").isNotNull()
            & F.col("category").isNotNull()
            & F.col("price").isNotNull()
            & F.col("quantity").isNotNull()
            & F.col("payment_method").isNotNull()
            & (F.col("price") > 0)
            & (F.col("quantity") > 0)
            & (F.col("price") <= S.MAX_PRICE)
            & (F.col("quantity") <= S.MAX_QUANTITY)
            & C.normalize_event_type("event_type").isin(S.VALID_EVENT_TYPES))


def filter_valid(raw: DataFrame) -> DataFrame:
    return raw.where(valid_row())


def clean_projection(raw: DataFrame) -> DataFrame:
    return raw.select(
        F.col("order_id"),
        C.default_user_id("user_id").alias("user_id"),
        F.col("product_id"),
        C.trim_product_name("product_name").alias("product_name"),
        C.normalize_category("category").alias("category"),
        C.clean_price("price").alias("price"),
        C.clean_quantity("quantity").alias("quantity"),
        C.normalize_event_type("event_type").alias("event_type"),
        C.parse_event_timestamp("timestamp").alias("event_timestamp"),
        C.normalize_payment("payment_method").alias("payment_method"),
        C.standardize_city("city").alias("city"),
        C.compute_revenue("price", "quantity").alias("revenue"),
    )


def dedupe_rows(df: DataFrame) -> DataFrame:
    return df.distinct()


def clean_events(raw: DataFrame) -> DataFrame:
    """The whole cleaning step; rows differing only in raw spelling or in
    sub-second time merge, because DISTINCT runs over the output columns."""
    return dedupe_rows(clean_projection(filter_valid(raw)))
