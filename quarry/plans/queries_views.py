"""Chart-data and dashboard-view queries.

Oracle-checked variants use the deterministic rule label; the forest-label
and sampled variants are rows-only."""

from __future__ import annotations

from pyspark.sql import functions as F

from quarry import schemas as S
from quarry.operators import anomaly as A
from quarry.operators import charts as CH
from quarry.operators import clean as CL
from quarry.operators import features as FE
from quarry.operators import iforest as IF
from quarry.operators import views as V
from quarry.plans.oracle import with_clean, with_raw
from quarry.plans import jobs as J
from quarry.plans.queries_anomaly import FEATURE_CTES, REASON_CTE, RULE_LABEL_CTE, SUMMARY_SQL
from quarry.plans.queries_batch import _INSIGHTS
from quarry.plans.registry import register
from quarry.session import scratch_path
from quarry.sources import tables as TB
from quarry.sources.fixture import raw_data


def _rule(spark, sf):
    return A.with_rule_label(FE.build_features(raw_data(spark, sf)))


def _forest(spark, sf):
    feats, n = FE.build_features_counted(raw_data(spark, sf))
    lab, _, _ = IF.fit_predict(feats, n_rows=n)
    return lab


def _lab_sql(body: str, *extra: str) -> str:
    return with_raw(body, ", ".join((FEATURE_CTES, RULE_LABEL_CTE) + extra))


@register("anomaly_label_counts_rule", _lab_sql(
    "SELECT anomaly_label, count(*) AS count, round(CAST(count(*) AS DOUBLE) * 100.0 / "
    "(SELECT count(*) FROM labelled), 2) AS share_pct FROM labelled GROUP BY anomaly_label"))
def q_anomaly_label_counts_rule(spark, sf):
    return CH.anomaly_label_counts(_rule(spark, sf))


def _by_sql(col: str) -> str:
    return _lab_sql(f"SELECT {col}, count(*) AS count FROM labelled WHERE anomaly_label = 'Anomaly' "
                    f"AND {col} IS NOT NULL GROUP BY {col}")


@register("anomalies_by_category_rule", _by_sql("category_clean"))
def q_anomalies_by_category_rule(spark, sf):
    return CH.anomalies_by_category(_rule(spark, sf))


@register("anomalies_by_city_rule", _by_sql("city_clean"))
def q_anomalies_by_city_rule(spark, sf):
    return CH.anomalies_by_city(_rule(spark, sf))


@register("anomalies_by_event_type_rule", _by_sql("event_type_clean"))
def q_anomalies_by_event_type_rule(spark, sf):
    return CH.anomalies_by_event_type(_rule(spark, sf))


_HIST = """clipped AS (SELECT anomaly_label, least(greatest(price_clean, 0.0), 100000.0) AS x FROM labelled),
st0 AS (SELECT anomaly_label, count(*) AS n_label, min(x) AS mn, max(x) AS mx FROM clipped GROUP BY anomaly_label),
st AS (SELECT anomaly_label, n_label,
          CASE WHEN mx > mn THEN mn ELSE mn - 0.5 END AS start,
          ((CASE WHEN mx > mn THEN mx ELSE mx + 0.5 END) - (CASE WHEN mx > mn THEN mn ELSE mn - 0.5 END)) / 50 AS width
       FROM st0),
binned AS (SELECT c.anomaly_label, CAST(least(floor((x - start) / width), 49) AS INT) AS bin, start, width, n_label
           FROM clipped c JOIN st USING (anomaly_label))"""


@register("price_histogram_rule", _lab_sql(
    "SELECT anomaly_label, bin, round(any_value(start) + bin * any_value(width), 6) AS bin_start, "
    "round(any_value(start) + (bin + 1) * any_value(width), 6) AS bin_end, count(*) AS count, "
    "round(count(*) / (any_value(n_label) * any_value(width)), 12) AS density FROM binned GROUP BY anomaly_label, bin",
    _HIST))
def q_price_histogram_rule(spark, sf):
    return CH.price_histogram(_rule(spark, sf))


@register("price_revenue_scatter_rule", _lab_sql(
    "SELECT id, price_clean AS price, revenue_clean AS revenue, anomaly_label FROM labelled "
    "WHERE price_clean BETWEEN -10000.0 AND 85000.0 AND revenue_clean BETWEEN -5000.0 AND 300000.0"))
def q_price_revenue_scatter_rule(spark, sf):
    return CH.price_revenue_scatter(_rule(spark, sf))


@register("sample_rows")
def q_sample_rows(spark, sf):
    return CH.sample_rows(_rule(spark, sf), 1000)


@register("stratified_sample")
def q_stratified_sample(spark, sf):
    return CH.stratified_sample(_rule(spark, sf), 500)


@register("sample_rows_invariants", with_raw(
    "SELECT least(1000, count(*)) AS rows, least(1000, count(*)) AS ids, least(1000, count(*)) AS known FROM raw_data"))
def q_sample_rows_invariants(spark, sf):
    """So many rows, none twice, all from the table."""
    rows = _rule(spark, sf)
    sample = CH.sample_rows(rows, 1000).select("id")
    known = sample.join(rows.select("id"), "id", "left_semi").agg(F.count(F.lit(1))).scalar()
    return sample.agg(F.count(F.lit(1)).alias("rows"), F.count_distinct("id").alias("ids")).select("rows", "ids", known.alias("known"))


@register("stratified_sample_sizes", _lab_sql(
    "SELECT anomaly_label, least(500, count(*)) AS rows, least(500, count(*)) AS ids FROM labelled GROUP BY anomaly_label"))
def q_stratified_sample_sizes(spark, sf):
    return (CH.stratified_sample(_rule(spark, sf), 500).groupBy("anomaly_label")
            .agg(F.count(F.lit(1)).alias("rows"), F.count_distinct("id").alias("ids")))


@register("price_revenue_scatter_sample")
def q_price_revenue_scatter_sample(spark, sf):
    return CH.price_revenue_scatter(_rule(spark, sf), sample=5000)


@register("anomaly_label_counts")
def q_anomaly_label_counts(spark, sf):
    return CH.anomaly_label_counts(_forest(spark, sf))


@register("price_histogram")
def q_price_histogram(spark, sf):
    return CH.price_histogram(_forest(spark, sf))


# ---------------------------------------------------------------- views
_SALES = " UNION ALL ".join([
    "SELECT 'category' AS dimension, category AS key, CAST(sum(revenue) AS BIGINT) AS revenue, count(*) AS n "
    "FROM sliced GROUP BY category",
    "SELECT 'hour', CAST(hour(event_timestamp) AS VARCHAR), CAST(sum(revenue) AS BIGINT), count(*) FROM sliced "
    "WHERE event_timestamp IS NOT NULL GROUP BY hour(event_timestamp)",
    "SELECT 'city', city, CAST(sum(revenue) AS BIGINT), count(*) FROM sliced GROUP BY city",
    "SELECT 'payment_method', payment_method, CAST(sum(revenue) AS BIGINT), count(*) FROM sliced "
    "GROUP BY payment_method",
    "SELECT 'event_type', event_type, CAST(sum(revenue) AS BIGINT), count(*) FROM sliced GROUP BY event_type",
])


@register("sliced_sales", with_clean(_SALES, "sliced AS (SELECT * FROM cleaned_data)"))
def q_sliced_sales(spark, sf):
    return V.sliced_sales(CL.clean_events(raw_data(spark, sf)))


@register("sliced_sales_mumbai_upi", with_clean(
    _SALES, "sliced AS (SELECT * FROM cleaned_data WHERE city = 'Mumbai' AND payment_method = 'UPI')"))
def q_sliced_sales_mumbai_upi(spark, sf):
    return V.sliced_sales(CL.clean_events(raw_data(spark, sf)), city="Mumbai", payment="UPI")


_OVERVIEW = " UNION ALL ".join(
    ["SELECT 'anomaly_label' AS section, anomaly_label AS key, count(*) AS n FROM reasoned GROUP BY anomaly_label"]
    + [f"SELECT '{c}', {c}, count(*) FROM reasoned WHERE anomaly_label = 'Anomaly' AND {c} IS NOT NULL GROUP BY {c}"
       for c in ["anomaly_reason", "category_clean", "city_clean", "event_type_clean"]])


@register("anomaly_overview_rule", _lab_sql(_OVERVIEW, REASON_CTE))
def q_anomaly_overview_rule(spark, sf):
    return V.anomaly_overview(A.assign_reason(_rule(spark, sf)))


@register("anomaly_overview")
def q_anomaly_overview(spark, sf):
    return V.anomaly_overview(A.assign_reason(_forest(spark, sf)))


_ALERTS = " UNION ALL ".join(
    f"SELECT round(anomaly_rate, 2) AS anomaly_rate, CAST({t} AS DOUBLE) AS threshold, total_rows, anomaly_rows AS anomaly_count, "
    f"'High anomaly rate: ' || printf('%.1f', anomaly_rate) || '%' AS message FROM ({SUMMARY_SQL}) WHERE anomaly_rate > {t}"
    for t in ("15.0", "20.0", "99.0"))


@register("alert_history", _lab_sql(_ALERTS))
def q_alert_history(spark, sf):
    """All stored alerts but for the time that they were raised."""
    target = scratch_path(spark, "anomaly_alerts")
    summary = A.anomaly_summary(_rule(spark, sf))
    for thr in (S.ALERT_THRESHOLD, 20.0, 99.0):
        TB.append_table(A.anomaly_rate_alert(summary, thr), target)
    return V.alert_history(TB.scan(spark, target)).drop("alert_time")


@register("kpi_summary", with_clean(
    "SELECT CASE metric " + " ".join(f"WHEN '{m}' THEN {i}" for i, m in enumerate(
        ["Top Category", "Peak Hour", "Conversion Rate", "Top City", "Total Orders", "Total Revenue"]))
    + f" END AS card, metric, value FROM ({_INSIGHTS})"))
def q_kpi_summary(spark, sf):
    """The cards read the table that the analysis job stored."""
    out = scratch_path(spark, "job")
    J.run_analysis(spark, CL.clean_events(raw_data(spark, sf)), out)
    return V.kpi_summary(TB.scan(spark, J.table_path(out, "business_insights")))
