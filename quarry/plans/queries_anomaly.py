"""Queries for features, labels, reasons, alerts and defect flags
(SURVEY §2.6 describe, §2.7, §2.11).  Oracle-checked variants use the
deterministic rule label; the isolation-forest ones are in queries_forest."""

from __future__ import annotations

from pyspark.sql import functions as F

from quarry import schemas as S
from quarry.operators import anomaly as A
from quarry.operators import corruption as X
from quarry.operators import features as FE
from quarry.plans.oracle import EVENT_TYPES, ts_sql, with_raw
from quarry.plans.registry import register
from quarry.sources.fixture import raw_data

# ----------------------------------------------------------- oracle pieces
FEATURE_CTES = """feat0 AS (
  SELECT *, coalesce(CAST(price AS DOUBLE), 0.0) AS price_clean,
         coalesce(TRY_CAST(quantity AS DOUBLE), 0.0) AS quantity_clean,
         coalesce(category, 'Unknown') AS category_clean, coalesce(city, 'Unknown') AS city_clean,
         coalesce(event_type, 'Unknown') AS event_type_clean, coalesce(payment_method, 'Unknown') AS payment_clean
  FROM raw_data
), features AS (
  SELECT *, price_clean * quantity_clean AS revenue_clean,
         CAST(dense_rank() OVER (ORDER BY category_clean) - 1 AS INT) AS category_encoded,
         CAST(dense_rank() OVER (ORDER BY city_clean) - 1 AS INT) AS city_encoded,
         CAST(dense_rank() OVER (ORDER BY event_type_clean) - 1 AS INT) AS event_type_encoded,
         CAST(dense_rank() OVER (ORDER BY payment_clean) - 1 AS INT) AS payment_encoded
  FROM feat0
)"""

RULE_LABEL_CTE = """labelled AS (
  SELECT *, CASE WHEN price_clean <= 0 OR price_clean > 80000 OR quantity_clean = 0 OR quantity_clean > 3
                 OR id % 7 = 0 THEN 'Anomaly' ELSE 'Normal' END AS anomaly_label
  FROM features
)"""

REASON_CTE = f"""reasoned AS (
  SELECT *, CASE WHEN anomaly_label <> 'Anomaly' THEN 'Normal'
    WHEN payment_clean = 'Unknown' THEN 'Missing Payment Method'
    WHEN event_type_clean NOT IN {EVENT_TYPES} THEN 'Invalid Event Type (Schema Drift)'
    WHEN city_clean NOT IN ('Delhi', 'Mumbai', 'Kolkata', 'Bangalore') THEN 'Unknown City (Corrupt/Missing)'
    WHEN quantity_clean > 3 THEN 'Quantity Outlier (Data Entry Error)'
    WHEN quantity_clean = 0 THEN 'Zero Quantity (Bot Traffic)'
    WHEN price_clean > 80000 THEN 'Price Outlier (Currency Mismatch)'
    WHEN price_clean = 0 THEN 'Zero Price'
    WHEN price_clean < 0 THEN 'Negative Price'
    WHEN revenue_clean > (SELECT avg(revenue_clean) + 2.0 * stddev_samp(revenue_clean) FROM labelled)
      THEN 'Unusually High Revenue'
    ELSE 'ML Pattern Anomaly' END AS anomaly_reason
  FROM labelled
)"""

SUMMARY_SQL = """SELECT count(*) AS total_rows, count(*) FILTER (WHERE anomaly_label = 'Normal') AS normal_rows,
  count(*) FILTER (WHERE anomaly_label = 'Anomaly') AS anomaly_rows,
  CASE WHEN count(*) > 0 THEN CAST(count(*) FILTER (WHERE anomaly_label = 'Anomaly') AS DOUBLE) * 100.0 / count(*) END
    AS anomaly_rate FROM labelled"""


def _feat_sql(body: str, *extra: str) -> str:
    return with_raw(body, ", ".join((FEATURE_CTES,) + extra))


def _features(spark, sf):
    return FE.build_features(raw_data(spark, sf))


def _rule_labelled(spark, sf):
    return A.with_rule_label(_features(spark, sf))


# ---------------------------------------------------------------- features
@register("prepare_features", _feat_sql(
    "SELECT id, price_clean, quantity_clean, revenue_clean, category_clean, city_clean, event_type_clean, "
    "payment_clean FROM features"))
def q_prepare_features(spark, sf):
    return FE.prepare_features(raw_data(spark, sf)).select(
        "id", "price_clean", "quantity_clean", "revenue_clean", "category_clean", "city_clean",
        "event_type_clean", "payment_clean")


@register("encoding_map", _feat_sql(
    "SELECT DISTINCT 'category_clean' AS column, category_clean AS value, category_encoded AS code FROM features "
    "UNION ALL SELECT DISTINCT 'city_clean', city_clean, city_encoded FROM features "
    "UNION ALL SELECT DISTINCT 'event_type_clean', event_type_clean, event_type_encoded FROM features "
    "UNION ALL SELECT DISTINCT 'payment_clean', payment_clean, payment_encoded FROM features"))
def q_encoding_map(spark, sf):
    return FE.encoding_map(FE.prepare_features(raw_data(spark, sf)), [a for a, _ in FE.ENCODED])


@register("build_features", _feat_sql("SELECT id, " + ", ".join(S.FEATURE_COLS) + " FROM features"))
def q_build_features(spark, sf):
    return _features(spark, sf).select("id", *S.FEATURE_COLS)


_DESCRIBE = " UNION ALL ".join(
    f"SELECT '{c}' AS feature, count({c}) AS count, round(avg({c}), 4) AS mean, "
    f"round(stddev_samp({c}), 4) AS std, CAST(min({c}) AS DOUBLE) AS min, "
    f"round(quantile_cont({c}, 0.25), 6) AS p25, round(quantile_cont({c}, 0.5), 6) AS p50, "
    f"round(quantile_cont({c}, 0.75), 6) AS p75, CAST(max({c}) AS DOUBLE) AS max FROM features"
    for c in S.FEATURE_COLS)


@register("describe_features", _feat_sql(_DESCRIBE))
def q_describe_features(spark, sf):
    d = FE.describe_features(_features(spark, sf))
    return d.select("feature", "count", "mean", "std", "min", *[F.round(c, 6).alias(c) for c in ("p25", "p50", "p75")],
                    "max")


# ----------------------------------------------------- rule-label anomalies
@register("assign_reason_rule", _feat_sql(
    "SELECT id, anomaly_label, anomaly_reason FROM reasoned", RULE_LABEL_CTE, REASON_CTE))
def q_assign_reason_rule(spark, sf):
    return A.assign_reason(_rule_labelled(spark, sf)).select("id", "anomaly_label", "anomaly_reason")


@register("reason_breakdown_rule", _feat_sql(
    "SELECT anomaly_reason, count(*) AS count FROM reasoned WHERE anomaly_label = 'Anomaly' GROUP BY anomaly_reason",
    RULE_LABEL_CTE, REASON_CTE))
def q_reason_breakdown_rule(spark, sf):
    return A.reason_breakdown(A.assign_reason(_rule_labelled(spark, sf)))


@register("reason_breakdown_top5_rule", _feat_sql(
    "SELECT anomaly_reason, count(*) AS count FROM reasoned WHERE anomaly_label = 'Anomaly' GROUP BY anomaly_reason "
    "ORDER BY count DESC, anomaly_reason LIMIT 5", RULE_LABEL_CTE, REASON_CTE))
def q_reason_breakdown_top5_rule(spark, sf):
    return A.reason_breakdown(A.assign_reason(_rule_labelled(spark, sf)), top=5)


@register("anomaly_summary_rule", _feat_sql(SUMMARY_SQL, RULE_LABEL_CTE))
def q_anomaly_summary_rule(spark, sf):
    return A.anomaly_summary(_rule_labelled(spark, sf))


@register("rate_drift_note_rule", _feat_sql(
    "SELECT round(anomaly_rate, 2) AS anomaly_rate, (anomaly_rate < 5.0 OR anomaly_rate > 20.0) AS rate_far_from_target, "
    "round(anomaly_rate / 100.0, 2) AS suggested_contamination FROM (" + SUMMARY_SQL + ")", RULE_LABEL_CTE))
def q_rate_drift_note_rule(spark, sf):
    return A.rate_drift_note(A.anomaly_summary(_rule_labelled(spark, sf)))


@register("anomaly_rate_alert_rule", _feat_sql(
    "SELECT round(anomaly_rate, 2) AS anomaly_rate, 15.0::DOUBLE AS threshold, total_rows, anomaly_rows AS anomaly_count, "
    "'High anomaly rate: ' || printf('%.1f', anomaly_rate) || '%' AS message FROM (" + SUMMARY_SQL + ") "
    "WHERE anomaly_rate > 15.0", RULE_LABEL_CTE))
def q_anomaly_rate_alert_rule(spark, sf):
    # alert_time is the wall clock; every other column is checked
    return A.anomaly_rate_alert(_rule_labelled(spark, sf), S.ALERT_THRESHOLD).drop("alert_time")


@register("anomaly_output_rule", _feat_sql(
    "SELECT order_id, user_id, product_id, product_name, category_clean AS category, price AS price_raw, price_clean, "
    "quantity AS quantity_raw, quantity_clean, revenue_clean AS revenue, event_type_clean AS event_type, timestamp, "
    "payment_clean AS payment_method, city_clean AS city, anomaly_label, anomaly_reason, "
    "CAST(CASE WHEN anomaly_label = 'Anomaly' THEN -1 ELSE 1 END AS INT) AS anomaly_score, "
    "CAST(NULL AS DOUBLE) AS isolation_score FROM reasoned", RULE_LABEL_CTE, REASON_CTE))
def q_anomaly_output_rule(spark, sf):
    return A.select_anomaly_output(A.assign_reason(_rule_labelled(spark, sf)))


# ------------------------------------------------------------ defect flags
AS_OF = "2027-01-01 00:00:00"


def _flag_sql(k: str) -> str:
    m = {
        "negative_price": "price < 0", "zero_price": "price = 0", "price_outlier": "price > 80000",
        "missing_price": "price IS NULL",
        "bot_traffic": "TRY_CAST(user_id AS BIGINT) BETWEEN 9000 AND 9020 AND quantity = 0",
        "retried_order": "order_id = 1111", "quantity_outlier": "quantity >= 500",
        "uuid_user": "regexp_matches(user_id, '^[0-9a-f-]{36}$')",
        "missing_payment": "payment_method IS NULL", "missing_order_id": "order_id IS NULL",
        "missing_product_id": "product_id IS NULL", "missing_product_name": "product_name IS NULL",
        "missing_category": "category IS NULL", "missing_quantity": "quantity IS NULL",
        "noncanonical_event_type": f"event_type IS NULL OR event_type NOT IN {EVENT_TYPES}",
        "noncanonical_city": f"city IS NULL OR city NOT IN ('Delhi', 'Mumbai', 'Kolkata', 'Bangalore')",
        "timestamp_missing": "timestamp IS NULL OR trim(timestamp) = '' OR timestamp = 'NaT'",
        "timestamp_epoch": "starts_with(timestamp, '1970-01-01')",
        "timestamp_day_first": "timestamp LIKE '__-__-____ __:__%'",
        "timestamp_future": f"({ts_sql('timestamp')}) > TIMESTAMP '{AS_OF}'",
    }
    return f"coalesce({m[k]}, false)"


FLAGS_CTE = "flags AS (SELECT *, " + ", ".join(f"{_flag_sql(k)} AS f_{k}" for k in X.FLAGS) + " FROM features)"


@register("corruption_flags", _feat_sql("SELECT id, " + ", ".join(f"f_{k}" for k in X.FLAGS) + " FROM flags",
                                        FLAGS_CTE))
def q_corruption_flags(spark, sf):
    return X.corruption_flags(raw_data(spark, sf), AS_OF).select("id", *[f"f_{k}" for k in X.FLAGS])


@register("corruption_profile", _feat_sql(" UNION ALL ".join(
    f"SELECT '{k}' AS flag, count(*) FILTER (WHERE f_{k}) AS n, "
    f"CASE WHEN count(*) > 0 THEN round(CAST(count(*) FILTER (WHERE f_{k}) AS DOUBLE) * 100.0 / count(*), 2) END "
    f"AS rate_pct FROM flags" for k in X.FLAGS), FLAGS_CTE))
def q_corruption_profile(spark, sf):
    return X.corruption_profile(X.corruption_flags(raw_data(spark, sf), AS_OF))


@register("detection_report_rule", _feat_sql(" UNION ALL ".join(
    f"SELECT '{k}' AS flag, count(*) FILTER (WHERE f_{k}) AS n, "
    f"count(*) FILTER (WHERE f_{k} AND anomaly_label = 'Anomaly') AS detected, "
    f"CASE WHEN count(*) FILTER (WHERE f_{k}) > 0 THEN round(CAST(count(*) FILTER (WHERE f_{k} AND "
    f"anomaly_label = 'Anomaly') AS DOUBLE) * 100.0 / count(*) FILTER (WHERE f_{k}), 2) END AS recall_pct "
    f"FROM flagged" for k in X.FLAGS), RULE_LABEL_CTE, FLAGS_CTE.replace("FROM features", "FROM labelled")
    .replace("flags AS", "flagged AS")))
def q_detection_report_rule(spark, sf):
    lab = _rule_labelled(spark, sf)
    return X.detection_report(X.corruption_flags(lab, AS_OF))
