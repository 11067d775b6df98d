"""Business KPIs over ``cleaned_data``.

Each KPI is a small aggregate whose output is bounded by the number of
categories / hours / cities, so every shuffle here is tiny after map-side
partial aggregation.  ``business_insights`` computes all six metrics in a
single scan with GROUPING SETS instead of six passes.

Ties: highest revenue first, then the smallest key (hour and city match the
reference's first-in-index-order pick; its category order was unstable).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry import schemas as S


def revenue_by_category(cleaned: DataFrame) -> DataFrame:
    return (cleaned.groupBy("category").agg(F.sum("revenue").alias("revenue"))
            .orderBy(F.desc("revenue"), "category"))


def top_category(cleaned: DataFrame) -> DataFrame:
    return revenue_by_category(cleaned).limit(1).withColumnRenamed("category", "top_category")


def revenue_by_hour(cleaned: DataFrame) -> DataFrame:
    """Revenue per hour of day; rows without a timestamp are dropped."""
    return (cleaned.where(F.col("event_timestamp").isNotNull())
            .groupBy(F.hour("event_timestamp").alias("hour"))
            .agg(F.sum("revenue").alias("revenue"))
            .orderBy("hour"))


def peak_hour(cleaned: DataFrame) -> DataFrame:
    return (revenue_by_hour(cleaned).orderBy(F.desc("revenue"), "hour").limit(1)
            .withColumnRenamed("hour", "peak_hour"))


def _funnel_aggs() -> list[Column]:
    et = F.col("event_type")
    return [F.count_if(et == "view").alias("views"),
            F.count_if(et == "add_to_cart").alias("add_to_cart"),
            F.count_if(et == "purchase").alias("purchases")]


def conversion_funnel(cleaned: DataFrame) -> DataFrame:
    return cleaned.agg(*_funnel_aggs())


def _rate(purchases: Column, views: Column) -> Column:
    return F.when(views > 0, F.round(purchases * 100.0 / views, 2)).otherwise(F.lit(0.0))


def conversion_rate(cleaned: DataFrame) -> DataFrame:
    f = conversion_funnel(cleaned)
    return f.select("views", "purchases",
                    _rate(F.col("purchases"), F.col("views")).alias("conversion_rate"))


def revenue_by_city(cleaned: DataFrame) -> DataFrame:
    """Ascending revenue, the order the bar chart uses."""
    return (cleaned.groupBy("city").agg(F.sum("revenue").alias("revenue"))
            .orderBy("revenue", "city"))


def top_city(cleaned: DataFrame) -> DataFrame:
    return (cleaned.groupBy("city").agg(F.sum("revenue").alias("revenue"))
            .orderBy(F.desc("revenue"), "city").limit(1)
            .withColumnRenamed("city", "top_city"))


def payment_distribution(cleaned: DataFrame) -> DataFrame:
    """Count and share (%) per payment method; the total is a scalar
    subquery, so no single-partition window is needed."""
    total = cleaned.select(F.count(F.lit(1))).scalar()
    return (cleaned.groupBy("payment_method").agg(F.count(F.lit(1)).alias("n"))
            .select("payment_method", "n", F.round(F.col("n") * 100.0 / total, 2).alias("share_pct"))
            .orderBy(F.desc("n"), "payment_method"))


def total_orders(cleaned: DataFrame, mode: str = "purchase") -> DataFrame:
    """``purchase``: purchase rows (batch job); ``all``: every row (notebook)."""
    if mode == "purchase":
        return cleaned.agg(F.count_if(F.col("event_type") == "purchase").alias("total_orders"))
    if mode == "all":
        return cleaned.agg(F.count(F.lit(1)).alias("total_orders"))
    raise ValueError(f"unknown total_orders mode {mode!r}")


def total_revenue(cleaned: DataFrame) -> DataFrame:
    return cleaned.agg(F.coalesce(F.sum("revenue"), F.lit(0)).cast("bigint").alias("total_revenue"))


def kpi_row(cleaned: DataFrame, total_orders_mode: str = "purchase") -> DataFrame:
    """All scalar KPIs in one row, from one scan.

    GROUPING SETS ((category), (hour), (city), ()) expands each row four
    times inside the scan stage and combines map-side; the exchange carries at
    most a few dozen groups per task.
    """
    base = cleaned.select("category", "city", "event_type", "revenue",
                          F.hour("event_timestamp").alias("hour"))
    g = (base.groupingSets([["category"], ["hour"], ["city"], []], "category", "hour", "city")
         .agg(F.sum("revenue").alias("revenue"), F.count(F.lit(1)).alias("rows"),
              *_funnel_aggs(), F.grouping_id().alias("gid")))
    # grouping_id bits (category, hour, city): 3 -> by category, 5 -> by hour,
    # 6 -> by city, 7 -> grand total.  The grouped frame is tiny; one more
    # global aggregate picks the arg-maxes and the totals (no join).
    gid = F.col("gid")

    def arg_top(key: str, set_id: int) -> Column:
        ok = (gid == set_id) & F.col(key).isNotNull()
        return F.min_by(key, F.when(ok, F.struct(-F.col("revenue"), F.col(key)))).alias(
            {"category": "top_category", "hour": "peak_hour", "city": "top_city"}[key])

    def total(c: str) -> Column:
        # an empty input has no grand-total row: a count of nothing is 0
        return F.coalesce(F.max(F.when(gid == 7, F.col(c))), F.lit(0).cast("bigint"))

    one = g.agg(arg_top("category", 3), arg_top("hour", 5), arg_top("city", 6),
                total("views").alias("views"), total("add_to_cart").alias("add_to_cart"),
                total("purchases").alias("purchases"), total("rows").alias("rows"),
                total("revenue").alias("revenue"))
    orders = F.col("purchases") if total_orders_mode == "purchase" else F.col("rows")
    return one.select("top_category", "peak_hour", "top_city",
                      _rate(F.col("purchases"), F.col("views")).alias("conversion_rate"),
                      orders.alias("total_orders"),
                      F.coalesce(F.col("revenue"), F.lit(0)).cast("bigint").alias("total_revenue"),
                      "views", "add_to_cart", "purchases")


def business_insights(cleaned: DataFrame, total_orders_mode: str = "purchase") -> DataFrame:
    """The six-row ``metric, value`` table (all values text)."""
    k = kpi_row(cleaned, total_orders_mode)
    m = S.INSIGHT_METRICS
    rate_txt = F.when(F.col("views") > 0, F.col("conversion_rate").cast("string")).otherwise(F.lit("0"))
    def row(pos: int, value) -> Column:
        return F.struct(F.lit(pos).alias("pos"), F.lit(m[pos]).alias("metric"), value.alias("value"))

    rows = F.array(
        row(0, F.col("top_category")),
        row(1, F.concat(F.col("peak_hour").cast("string"), F.lit(":00"))),
        row(2, F.concat(rate_txt, F.lit("%"))),
        row(3, F.col("top_city")),
        row(4, F.col("total_orders").cast("string")),
        row(5, F.col("total_revenue").cast("string")),
    )
    return (k.select(F.inline(rows)).orderBy("pos").select("metric", "value"))
