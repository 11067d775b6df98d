"""Batch queries over raw and cleaned event tables."""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from quarry.operators import clean as CL
from quarry.operators import kpi as K
from quarry.operators import quality as Q
from quarry.plans.oracle import CLEAN_SELECT, with_clean, with_raw
from quarry.plans.registry import register
from quarry.sources.fixture import raw_data


def _raw(spark: SparkSession, sf: str):
    return raw_data(spark, sf)


def _cleaned(spark: SparkSession, sf: str):
    return CL.clean_events(raw_data(spark, sf))


# ------------------------------------------------------------------ cleaning
@register("clean_events", with_raw(CLEAN_SELECT))
def q_clean_events(spark, sf):
    return _cleaned(spark, sf)


# ---------------------------------------------------------------------- KPIs
@register("revenue_by_category", with_clean(
    "SELECT category, CAST(sum(revenue) AS BIGINT) AS revenue FROM cleaned_data GROUP BY category"))
def q_revenue_by_category(spark, sf):
    return K.revenue_by_category(_cleaned(spark, sf))


@register("top_category", with_clean(
    "SELECT category AS top_category, CAST(sum(revenue) AS BIGINT) AS revenue FROM cleaned_data "
    "GROUP BY category ORDER BY revenue DESC, category LIMIT 1"))
def q_top_category(spark, sf):
    return K.top_category(_cleaned(spark, sf))


@register("revenue_by_hour", with_clean(
    "SELECT CAST(hour(event_timestamp) AS INT) AS hour, CAST(sum(revenue) AS BIGINT) AS revenue "
    "FROM cleaned_data WHERE event_timestamp IS NOT NULL GROUP BY 1"))
def q_revenue_by_hour(spark, sf):
    return K.revenue_by_hour(_cleaned(spark, sf))


@register("peak_hour", with_clean(
    "SELECT CAST(hour(event_timestamp) AS INT) AS peak_hour, CAST(sum(revenue) AS BIGINT) AS revenue "
    "FROM cleaned_data WHERE event_timestamp IS NOT NULL GROUP BY 1 ORDER BY revenue DESC, peak_hour LIMIT 1"))
def q_peak_hour(spark, sf):
    return K.peak_hour(_cleaned(spark, sf))


_FUNNEL = ("count(*) FILTER (WHERE event_type = 'view') AS views, "
           "count(*) FILTER (WHERE event_type = 'add_to_cart') AS add_to_cart, "
           "count(*) FILTER (WHERE event_type = 'purchase') AS purchases")


@register("conversion_funnel", with_clean(f"SELECT {_FUNNEL} FROM cleaned_data"))
def q_conversion_funnel(spark, sf):
    return K.conversion_funnel(_cleaned(spark, sf))


@register("conversion_rate", with_clean(
    f"SELECT views, purchases, CASE WHEN views > 0 THEN round(purchases * 100.0 / views, 2) ELSE 0.0 END "
    f"AS conversion_rate FROM (SELECT {_FUNNEL} FROM cleaned_data)"))
def q_conversion_rate(spark, sf):
    return K.conversion_rate(_cleaned(spark, sf))


@register("revenue_by_city", with_clean(
    "SELECT city, CAST(sum(revenue) AS BIGINT) AS revenue FROM cleaned_data GROUP BY city"))
def q_revenue_by_city(spark, sf):
    return K.revenue_by_city(_cleaned(spark, sf))


@register("top_city", with_clean(
    "SELECT city AS top_city, CAST(sum(revenue) AS BIGINT) AS revenue FROM cleaned_data "
    "GROUP BY city ORDER BY revenue DESC, city LIMIT 1"))
def q_top_city(spark, sf):
    return K.top_city(_cleaned(spark, sf))


@register("payment_distribution", with_clean(
    "SELECT payment_method, count(*) AS n, round(count(*) * 100.0 / (SELECT count(*) FROM cleaned_data), 2) "
    "AS share_pct FROM cleaned_data GROUP BY payment_method"))
def q_payment_distribution(spark, sf):
    return K.payment_distribution(_cleaned(spark, sf))


@register("total_orders", with_clean(
    "SELECT count(*) FILTER (WHERE event_type = 'purchase') AS total_orders FROM cleaned_data"))
def q_total_orders(spark, sf):
    return K.total_orders(_cleaned(spark, sf), "purchase")


@register("total_orders_all_rows", with_clean("SELECT count(*) AS total_orders FROM cleaned_data"))
def q_total_orders_all(spark, sf):
    return K.total_orders(_cleaned(spark, sf), "all")


@register("total_revenue", with_clean(
    "SELECT CAST(coalesce(sum(revenue), 0) AS BIGINT) AS total_revenue FROM cleaned_data"))
def q_total_revenue(spark, sf):
    return K.total_revenue(_cleaned(spark, sf))


_INSIGHTS = """SELECT metric, value FROM (
  SELECT 0 AS pos, 'Top Category' AS metric,
         (SELECT category FROM cleaned_data GROUP BY category ORDER BY sum(revenue) DESC, category LIMIT 1) AS value
  UNION ALL SELECT 1, 'Peak Hour',
         (SELECT CAST(hour(event_timestamp) AS VARCHAR) || ':00' FROM cleaned_data WHERE event_timestamp IS NOT NULL
          GROUP BY hour(event_timestamp) ORDER BY sum(revenue) DESC, hour(event_timestamp) LIMIT 1)
  UNION ALL SELECT 2, 'Conversion Rate',
         (SELECT CASE WHEN count(*) FILTER (WHERE event_type = 'view') > 0
                 THEN CAST(round(count(*) FILTER (WHERE event_type = 'purchase') * 100.0
                                 / count(*) FILTER (WHERE event_type = 'view'), 2) AS VARCHAR)
                 ELSE '0' END || '%' FROM cleaned_data)
  UNION ALL SELECT 3, 'Top City',
         (SELECT city FROM cleaned_data GROUP BY city ORDER BY sum(revenue) DESC, city LIMIT 1)
  UNION ALL SELECT 4, 'Total Orders',
         (SELECT CAST(count(*) FILTER (WHERE event_type = 'purchase') AS VARCHAR) FROM cleaned_data)
  UNION ALL SELECT 5, 'Total Revenue',
         (SELECT CAST(CAST(coalesce(sum(revenue), 0) AS BIGINT) AS VARCHAR) FROM cleaned_data)
) ORDER BY pos"""


@register("business_insights", with_clean(_INSIGHTS))
def q_business_insights(spark, sf):
    return K.business_insights(_cleaned(spark, sf))


# ------------------------------------------------------ raw quality checks


def _top_sql(keys, name="count", table="raw_data", limit=10, having=True):
    k = ", ".join(keys)
    order = ", ".join(f"{x} ASC NULLS LAST" for x in keys)
    hv = f" HAVING count(*) > 1" if having else ""
    lim = f" LIMIT {limit}" if limit else ""
    return f"SELECT {k}, count(*) AS {name} FROM {table} GROUP BY {k}{hv} ORDER BY {name} DESC, {order}{lim}"


@register("qc_invalid_rows", with_raw(
    "SELECT count(*) FILTER (WHERE order_id IS NULL OR price <= 0 OR quantity <= 0 OR event_type IS NULL "
    "OR product_name IS NULL OR city IS NULL) AS invalid_rows FROM raw_data"))
def q_qc_invalid_rows(spark, sf):
    return Q.qc_invalid_rows(_raw(spark, sf))


@register("qc_null_counts", with_raw(
    "SELECT " + ", ".join(f"count(*) FILTER (WHERE {c} IS NULL) AS null_{c}"
                          for c in ["user_id", "product_id", "category", "payment_method", "timestamp"])
    + " FROM raw_data"))
def q_qc_null_counts(spark, sf):
    return Q.qc_null_counts(_raw(spark, sf))


@register("qc_duplicate_orders", with_raw(_top_sql(["order_id"])))
def q_qc_duplicate_orders(spark, sf):
    return Q.qc_duplicate_orders(_raw(spark, sf))


@register("qc_order_lookup", with_raw(
    "SELECT order_id, product_id, product_name, price, quantity FROM raw_data WHERE order_id = 2363 "
    "ORDER BY id LIMIT 10"))
def q_qc_order_lookup(spark, sf):
    return Q.qc_order_lookup(_raw(spark, sf), 2363)


@register("qc_true_duplicates", with_raw(_top_sql(["order_id", "product_id", "price", "quantity"])))
def q_qc_true_duplicates(spark, sf):
    return Q.qc_true_duplicates(_raw(spark, sf))


@register("qc_true_duplicates_ts", with_raw(
    _top_sql(["order_id", "product_id", "price", "quantity", "timestamp"])))
def q_qc_true_duplicates_ts(spark, sf):
    return Q.qc_true_duplicates_ts(_raw(spark, sf))


@register("qc_event_type_dist", with_raw(_top_sql(["event_type"], limit=None, having=False)))
def q_qc_event_type_dist(spark, sf):
    return Q.qc_event_type_dist(_raw(spark, sf))


@register("qc_ranges", with_raw(
    "SELECT min(price) AS min_price, max(price) AS max_price, min(quantity) AS min_quantity, "
    "max(quantity) AS max_quantity FROM raw_data"))
def q_qc_ranges(spark, sf):
    return Q.qc_ranges(_raw(spark, sf))


@register("qc_category_dist", with_raw(_top_sql(["category"], limit=None, having=False)))
def q_qc_category_dist(spark, sf):
    return Q.qc_category_dist(_raw(spark, sf))


@register("qc_timestamp_length", with_raw(
    "SELECT timestamp, CAST(length(timestamp) AS INT) AS length FROM raw_data ORDER BY id LIMIT 10"))
def q_qc_timestamp_length(spark, sf):
    return Q.qc_timestamp_length(_raw(spark, sf))


@register("qc_invalid_timestamps", with_raw(
    "SELECT count(*) FILTER (WHERE timestamp IS NULL OR length(timestamp) < 10 OR timestamp = '') "
    "AS invalid_timestamps FROM raw_data"))
def q_qc_invalid_timestamps(spark, sf):
    return Q.qc_invalid_timestamps(_raw(spark, sf))


@register("qc_timestamp_text_range", with_raw(
    "SELECT min(timestamp) AS oldest, max(timestamp) AS newest FROM raw_data"))
def q_qc_timestamp_text_range(spark, sf):
    return Q.qc_timestamp_text_range(_raw(spark, sf))


@register("qc_timestamp_out_of_year", with_raw(
    "SELECT count(*) FILTER (WHERE timestamp < '2026-01-01' OR timestamp > '2026-12-31') AS out_of_range "
    "FROM raw_data"))
def q_qc_timestamp_out_of_year(spark, sf):
    return Q.qc_timestamp_out_of_year(_raw(spark, sf))


@register("qc_timestamp_formats", with_raw(
    "SELECT count(*) FILTER (WHERE timestamp LIKE '%T%') AS iso_format, "
    "count(*) FILTER (WHERE timestamp LIKE '% %') AS normal_format, "
    "count(*) FILTER (WHERE timestamp NOT LIKE '%T%' AND timestamp NOT LIKE '% %') AS unknown_format "
    "FROM raw_data"))
def q_qc_timestamp_formats(spark, sf):
    return Q.qc_timestamp_formats(_raw(spark, sf))


@register("qc_city_dist", with_raw(_top_sql(["city"], limit=None, having=False)))
def q_qc_city_dist(spark, sf):
    return Q.qc_city_dist(_raw(spark, sf))


@register("qc_payment_dist", with_raw(_top_sql(["payment_method"], limit=None, having=False)))
def q_qc_payment_dist(spark, sf):
    return Q.qc_payment_dist(_raw(spark, sf))


@register("qc_table_counts", with_clean(
    "SELECT r.raw_rows, c.cleaned_rows, CASE WHEN r.raw_rows > 0 THEN round(c.cleaned_rows * 100.0 / r.raw_rows, 2) "
    "END AS retention_pct FROM (SELECT count(*) AS raw_rows FROM raw_data) r, "
    "(SELECT count(*) AS cleaned_rows FROM cleaned_data) c"))
def q_qc_table_counts(spark, sf):
    raw = _raw(spark, sf)
    return Q.qc_table_counts(raw, CL.clean_events(raw))


# --------------------------------------------------- cleaned-table profile
@register("clean_city_dist", with_clean(_top_sql(["city"], "total_orders", "cleaned_data", None, False)))
def q_clean_city_dist(spark, sf):
    return Q.clean_city_dist(_cleaned(spark, sf))


@register("clean_payment_dist", with_clean(
    _top_sql(["payment_method"], "total_orders", "cleaned_data", None, False)))
def q_clean_payment_dist(spark, sf):
    return Q.clean_payment_dist(_cleaned(spark, sf))


#: Events that came again with another city: cleaning keeps both rows, since they differ.
_REDELIVERED = ("twice AS (SELECT * FROM raw_data UNION ALL SELECT id + 5000000000, order_id, user_id, product_id, product_name, category, "
                "price, quantity, event_type, timestamp, payment_method, CASE WHEN city = 'Kolkata' THEN 'Delhi' ELSE 'Kolkata' END "
                "FROM raw_data WHERE id % 10 < 3)")


@register("clean_true_duplicates", with_raw(
    _top_sql(["order_id", "product_id", "price", "quantity", "event_timestamp"], "count", "cleaned_data"),
    _REDELIVERED + f", cleaned_data AS ({CLEAN_SELECT.replace('FROM raw_data', 'FROM twice')})"))
def q_clean_true_duplicates(spark, sf):
    raw = raw_data(spark, sf)
    other = F.when(F.col("city") == "Kolkata", "Delhi").otherwise("Kolkata")
    again = raw.where("id % 10 < 3").withColumn("id", F.col("id") + 5000000000).withColumn("city", other)
    return Q.clean_true_duplicates(CL.clean_events(raw.unionByName(again)))


@register("clean_event_type_dist", with_clean(
    _top_sql(["event_type"], "total_events", "cleaned_data", None, False)))
def q_clean_event_type_dist(spark, sf):
    return Q.clean_event_type_dist(_cleaned(spark, sf))


@register("clean_revenue_stats", with_clean(
    "SELECT min(revenue) AS min_revenue, max(revenue) AS max_revenue, round(avg(revenue), 4) AS avg_revenue "
    "FROM cleaned_data"))
def q_clean_revenue_stats(spark, sf):
    return Q.clean_revenue_stats(_cleaned(spark, sf))


@register("clean_timestamp_range", with_clean(
    "SELECT min(event_timestamp) AS oldest_timestamp, max(event_timestamp) AS latest_timestamp FROM cleaned_data"))
def q_clean_timestamp_range(spark, sf):
    return Q.clean_timestamp_range(_cleaned(spark, sf))


_CLEAN_ORDER = ", ".join(f"{c} ASC NULLS LAST" for c in
                         ["order_id", "user_id", "product_id", "product_name", "category", "price", "quantity",
                          "event_type", "event_timestamp", "payment_method", "city", "revenue"])


@register("preview_cleaned", with_clean(f"SELECT * FROM cleaned_data ORDER BY {_CLEAN_ORDER} LIMIT 20"))
def q_preview_cleaned(spark, sf):
    return Q.preview(_cleaned(spark, sf), 20)


@register("preview_raw", with_raw("SELECT * FROM raw_data ORDER BY id LIMIT 5"))
def q_preview_raw(spark, sf):
    return Q.preview(_raw(spark, sf), 5, order_by="id")


@register("row_count_raw", with_raw("SELECT count(*) AS row_count FROM raw_data"))
def q_row_count_raw(spark, sf):
    return Q.row_count(_raw(spark, sf))


@register("row_count_cleaned", with_clean("SELECT count(*) AS row_count FROM cleaned_data"))
def q_row_count_cleaned(spark, sf):
    return Q.row_count(_cleaned(spark, sf))


@register("scan_raw", with_raw("SELECT * FROM raw_data"))
def q_scan_raw(spark, sf):
    return _raw(spark, sf)


# ------------------------------------------------------- notebook profile
_RAW_TYPES = [("id", "bigint"), ("order_id", "int"), ("user_id", "string"), ("product_id", "int"),
              ("product_name", "string"), ("category", "string"), ("price", "double"), ("quantity", "int"),
              ("event_type", "string"), ("timestamp", "string"), ("payment_method", "string"), ("city", "string")]


@register("profile_schema", with_raw(" UNION ALL ".join(
    f"SELECT {i} AS position, '{c}' AS column_name, '{t}' AS data_type, count({c}) AS non_null FROM raw_data"
    for i, (c, t) in enumerate(_RAW_TYPES))))
def q_profile_schema(spark, sf):
    return Q.profile_schema(_raw(spark, sf))


@register("profile_raw", with_raw(
    "SELECT count(*) AS total_rows, count(*) FILTER (WHERE order_id IS NULL) AS null_order_id, "
    "count(*) FILTER (WHERE price IS NULL) AS null_price, count(*) FILTER (WHERE quantity IS NULL) AS null_quantity, "
    "count(*) FILTER (WHERE city IS NULL) AS null_city, count(*) FILTER (WHERE payment_method IS NULL) AS null_payment, "
    "count(*) FILTER (WHERE price < 0) AS price_negative, count(*) FILTER (WHERE price = 0) AS price_zero, "
    "count(*) FILTER (WHERE price > 80000) AS price_over_max, count(*) FILTER (WHERE quantity = 0) AS quantity_zero, "
    "count(*) FILTER (WHERE quantity > 3) AS quantity_over_3 FROM raw_data"))
def q_profile_raw(spark, sf):
    return Q.profile_raw(_raw(spark, sf))


@register("profile_event_type_counts", with_raw(
    "SELECT event_type, count(*) AS count FROM raw_data WHERE event_type IS NOT NULL GROUP BY event_type"))
def q_profile_event_type_counts(spark, sf):
    return Q.value_counts(_raw(spark, sf), "event_type")


@register("profile_city_counts", with_raw(
    "SELECT city, count(*) AS count FROM raw_data WHERE city IS NOT NULL GROUP BY city"))
def q_profile_city_counts(spark, sf):
    return Q.value_counts(_raw(spark, sf), "city")


@register("business_insights_all_rows", with_clean(_INSIGHTS.replace(
    "(SELECT CAST(count(*) FILTER (WHERE event_type = 'purchase') AS VARCHAR) FROM cleaned_data)",
    "(SELECT CAST(count(*) AS VARCHAR) FROM cleaned_data)")))
def q_business_insights_all_rows(spark, sf):
    """The notebook's table: Total Orders counts every cleaned row."""
    return K.business_insights(_cleaned(spark, sf), "all")


@register("preview", with_clean(f"SELECT * FROM cleaned_data ORDER BY {_CLEAN_ORDER} LIMIT 20"))
def q_preview(spark, sf):
    """``SELECT * ... LIMIT 20`` of the cleaned table, in a stated order."""
    return Q.preview(_cleaned(spark, sf), 20)


@register("row_count", with_clean(
    "SELECT 'raw_data' AS table_name, count(*) AS row_count FROM raw_data "
    "UNION ALL SELECT 'cleaned_data', count(*) FROM cleaned_data"))
def q_row_count(spark, sf):
    """Row count of each table, one row per table."""
    raw = _raw(spark, sf)
    return (Q.row_count(raw).select(F.lit("raw_data").alias("table_name"), "row_count")
            .unionByName(Q.row_count(CL.clean_events(raw)).select(F.lit("cleaned_data").alias("table_name"),
                                                                  "row_count")))


@register("profile_value_counts", with_raw(
    "SELECT 'event_type' AS field, event_type AS value, count(*) AS count FROM raw_data "
    "WHERE event_type IS NOT NULL GROUP BY event_type "
    "UNION ALL SELECT 'city', city, count(*) FROM raw_data WHERE city IS NOT NULL GROUP BY city"))
def q_profile_value_counts(spark, sf):
    """pandas ``value_counts`` of event type and city (nulls dropped), long form."""
    raw = _raw(spark, sf)
    return (Q.value_counts(raw, "event_type").select(F.lit("event_type").alias("field"),
                                                     F.col("event_type").alias("value"), "count")
            .unionByName(Q.value_counts(raw, "city").select(F.lit("city").alias("field"),
                                                            F.col("city").alias("value"), "count")))


@register("qc_summary", with_raw(
    "SELECT count(*) AS total_rows, count(*) FILTER (WHERE order_id IS NULL OR price <= 0 OR quantity <= 0 "
    "OR event_type IS NULL OR product_name IS NULL OR city IS NULL) AS invalid_rows, "
    + ", ".join(f"count(*) FILTER (WHERE {c} IS NULL) AS null_{c}"
                for c in ["user_id", "product_id", "category", "payment_method", "timestamp"])
    + ", min(price) AS min_price, max(price) AS max_price, min(quantity) AS min_quantity, "
    "max(quantity) AS max_quantity, "
    "count(*) FILTER (WHERE timestamp IS NULL OR length(timestamp) < 10 OR timestamp = '') AS invalid_timestamps, "
    "min(timestamp) AS oldest, max(timestamp) AS newest, "
    "count(*) FILTER (WHERE timestamp < '2026-01-01' OR timestamp > '2026-12-31') AS out_of_range, "
    "count(*) FILTER (WHERE timestamp LIKE '%T%') AS iso_format, "
    "count(*) FILTER (WHERE timestamp LIKE '% %') AS normal_format, "
    "count(*) FILTER (WHERE timestamp NOT LIKE '%T%' AND timestamp NOT LIKE '% %') AS unknown_format "
    "FROM raw_data"))
def q_qc_summary(spark, sf):
    """All scalar raw checks from one scan."""
    return Q.qc_summary(_raw(spark, sf))


@register("qc_distributions", with_raw(" UNION ALL ".join(
    f"SELECT '{c}' AS field, {c} AS value, count(*) AS count FROM raw_data GROUP BY {c}"
    for c in ["event_type", "category", "city", "payment_method"])))
def q_qc_distributions(spark, sf):
    """All four raw value distributions from one scan."""
    return Q.qc_distributions(_raw(spark, sf))
