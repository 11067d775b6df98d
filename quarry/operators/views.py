"""Dashboard views: slicers over the KPIs, the anomaly overview, alert
history and the KPI summary.  Each view is one scan: GROUPING SETS produce
every breakdown in a single aggregate, emitted as a long table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry import schemas as S
from quarry.functions.grouping import set_key, set_name

SALES_DIMS = ["category", "hour", "city", "payment_method", "event_type"]


def sliced_sales(cleaned: DataFrame, city: str | None = None, category: str | None = None,
                 payment: str | None = None) -> DataFrame:
    """``dimension, key, revenue, n`` for category, hour, city, payment and
    event type, after the optional slicers.  Rows without a timestamp are
    not in the hour breakdown."""
    df = cleaned
    if city is not None:
        df = df.where(F.col("city") == city)
    if category is not None:
        df = df.where(F.col("category") == category)
    if payment is not None:
        df = df.where(F.col("payment_method") == payment)
    base = df.select("category", F.hour("event_timestamp").alias("hour"), "city", "payment_method",
                     "event_type", "revenue")
    g = (base.groupingSets([[d] for d in SALES_DIMS], *SALES_DIMS)
         .agg(F.sum("revenue").alias("revenue"), F.count(F.lit(1)).alias("n"), F.grouping_id().alias("_gid")))
    dim = set_name(SALES_DIMS)
    key = set_key(SALES_DIMS, "string")
    return (g.select(dim.alias("dimension"), key.alias("key"), F.col("revenue").cast("bigint").alias("revenue"), "n")
            .where(~((F.col("dimension") == "hour") & F.col("key").isNull()))
            .orderBy("dimension", F.desc("revenue"), "key"))


OVERVIEW_DIMS = ["anomaly_label", "anomaly_reason", "category_clean", "city_clean", "event_type_clean"]


def anomaly_overview(reasoned: DataFrame) -> DataFrame:
    """``section, key, n``: label counts over all rows, and reason, category,
    city and event-type counts among anomalies, from one aggregate."""
    a = F.col("anomaly_label") == S.LABEL_ANOMALY
    base = reasoned.select("anomaly_label", F.when(a, F.col("anomaly_reason")).alias("anomaly_reason"),
                           F.when(a, F.col("category_clean")).alias("category_clean"),
                           F.when(a, F.col("city_clean")).alias("city_clean"),
                           F.when(a, F.col("event_type_clean")).alias("event_type_clean"))
    g = (base.groupingSets([[d] for d in OVERVIEW_DIMS], *OVERVIEW_DIMS)
         .agg(F.count(F.lit(1)).alias("n"), F.grouping_id().alias("_gid")))
    sec = set_name(OVERVIEW_DIMS)
    key = set_key(OVERVIEW_DIMS)
    return (g.select(sec.alias("section"), key.alias("key"), "n").where(F.col("key").isNotNull())
            .orderBy("section", F.desc("n"), "key"))


def alert_history(alerts: DataFrame) -> DataFrame:
    """Alerts, newest first."""
    return alerts.orderBy(F.desc("alert_time"), F.desc("anomaly_rate"))


def kpi_summary(insights: DataFrame) -> DataFrame:
    """The KPI cards from the stored ``business_insights`` table: one row per
    metric, in the order of the report; a metric that is not there has no value."""
    order = F.array(*[F.struct(F.lit(i).alias("card"), F.lit(m).alias("metric")) for i, m in enumerate(S.INSIGHT_METRICS)])
    cards = insights.sparkSession.range(1).select(F.inline(order))
    return cards.join(insights.select("metric", "value"), "metric", "left").orderBy("card").select("card", "metric", "value")
