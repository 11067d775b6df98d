"""One query per column rule of the cleaning step and the feature step
(SURVEY §2.3, §2.7), each applied to every raw row, plus the forest-label
variants of the chart breakdowns and the detection report."""

from __future__ import annotations

from quarry.functions import columns as C
from quarry.operators import anomaly as A
from quarry.operators import charts as CH
from quarry.operators import clean as CL
from quarry.operators import corruption as X
from quarry.operators import features as FE
from quarry.operators import iforest as IF
from quarry.plans.oracle import CLEAN_SELECT, city_sql, initcap_sql, ts_sql, with_raw
from quarry.plans.queries_anomaly import AS_OF
from quarry.plans.registry import register
from quarry.sources.fixture import raw_data


def _rule_query(name: str, out: str, spark_expr, sql_expr: str):
    @register(name, with_raw(f"SELECT id, {sql_expr} AS {out} FROM raw_data"))
    def q(spark, sf):
        return raw_data(spark, sf).select("id", spark_expr().alias(out))
    q.__name__ = f"q_{name}"
    return q


_rule_query("default_user_id", "user_id", lambda: C.default_user_id("user_id"), "coalesce(user_id, '-1')")
_rule_query("trim_product_name", "product_name", lambda: C.trim_product_name("product_name"), "trim(product_name)")
_rule_query("normalize_category", "category", lambda: C.normalize_category("category"),
            initcap_sql("trim(category)"))
_rule_query("clean_price", "price", lambda: C.clean_price("price"), "CAST(abs(price) AS BIGINT)")
_rule_query("clean_quantity", "quantity", lambda: C.clean_quantity("quantity"), "CAST(abs(quantity) AS BIGINT)")
_rule_query("normalize_event_type", "event_type", lambda: C.normalize_event_type("event_type"),
            "lower(trim(event_type))")
_rule_query("parse_event_timestamp", "event_timestamp", lambda: C.parse_event_timestamp("timestamp"),
            ts_sql("timestamp"))
_rule_query("normalize_payment", "payment_method", lambda: C.normalize_payment("payment_method"),
            "upper(trim(payment_method))")
_rule_query("standardize_city", "city", lambda: C.standardize_city("city"), city_sql("city"))
_rule_query("compute_revenue", "revenue", lambda: C.compute_revenue("price", "quantity"),
            "CAST(abs(price) AS BIGINT) * CAST(abs(quantity) AS BIGINT)")
_rule_query("coerce_price", "price_clean", lambda: C.coerce_price("price"), "coalesce(CAST(price AS DOUBLE), 0.0)")
_rule_query("coerce_quantity", "quantity_clean", lambda: C.coerce_quantity("quantity"),
            "coalesce(TRY_CAST(quantity AS DOUBLE), 0.0)")
_rule_query("raw_revenue", "revenue_clean",
            lambda: C.coerce_price("price") * C.coerce_quantity("quantity"),
            "coalesce(CAST(price AS DOUBLE), 0.0) * coalesce(TRY_CAST(quantity AS DOUBLE), 0.0)")
_rule_query("fill_unknown", "city_clean", lambda: C.fill_unknown("city"), "coalesce(city, 'Unknown')")

_FILTER = CLEAN_SELECT[CLEAN_SELECT.index("WHERE"):]
_PROJECTION = CLEAN_SELECT[:CLEAN_SELECT.index("WHERE")].replace("SELECT DISTINCT", "SELECT")


@register("filter_valid", with_raw(f"SELECT id FROM raw_data {_FILTER}"))
def q_filter_valid(spark, sf):
    return CL.filter_valid(raw_data(spark, sf)).select("id")


@register("clean_projection", with_raw(_PROJECTION))
def q_clean_projection(spark, sf):
    return CL.clean_projection(raw_data(spark, sf))


@register("dedupe_rows", with_raw(_PROJECTION.replace("SELECT", "SELECT DISTINCT", 1)))
def q_dedupe_rows(spark, sf):
    return CL.dedupe_rows(CL.clean_projection(raw_data(spark, sf)))


@register("label_encode", with_raw(
    "SELECT id, CAST(dense_rank() OVER (ORDER BY coalesce(category, 'Unknown')) - 1 AS INT) AS category_encoded, "
    "CAST(dense_rank() OVER (ORDER BY coalesce(city, 'Unknown')) - 1 AS INT) AS city_encoded, "
    "CAST(dense_rank() OVER (ORDER BY coalesce(event_type, 'Unknown')) - 1 AS INT) AS event_type_encoded, "
    "CAST(dense_rank() OVER (ORDER BY coalesce(payment_method, 'Unknown')) - 1 AS INT) AS payment_encoded "
    "FROM raw_data"))
def q_label_encode(spark, sf):
    return FE.label_encode(FE.prepare_features(raw_data(spark, sf))).select(
        "id", *[b for _, b in FE.ENCODED])


# ------------------------------------------------- forest-label variants
def _forest(spark, sf):
    feats, n = FE.build_features_counted(raw_data(spark, sf))
    lab, _, _ = IF.fit_predict(feats, n_rows=n)
    return lab


@register("anomalies_by_category")
def q_anomalies_by_category(spark, sf):
    return CH.anomalies_by_category(_forest(spark, sf))


@register("anomalies_by_city")
def q_anomalies_by_city(spark, sf):
    return CH.anomalies_by_city(_forest(spark, sf))


@register("anomalies_by_event_type")
def q_anomalies_by_event_type(spark, sf):
    return CH.anomalies_by_event_type(_forest(spark, sf))


@register("price_revenue_scatter")
def q_price_revenue_scatter(spark, sf):
    return CH.price_revenue_scatter(_forest(spark, sf))


@register("detection_report")
def q_detection_report(spark, sf):
    return X.detection_report(X.corruption_flags(_forest(spark, sf), AS_OF))


@register("reason_breakdown_top5")
def q_reason_breakdown_top5(spark, sf):
    return A.reason_breakdown(A.assign_reason(_forest(spark, sf)), top=5)

