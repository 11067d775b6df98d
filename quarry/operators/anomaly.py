"""Labels, reasons, summary and alert over a labelled feature frame.

All operators take any DataFrame carrying ``anomaly_label`` plus the prepared
feature columns, so they run the same over the isolation-forest label and over
a deterministic rule label (which makes them checkable against SQL).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry import schemas as S


def rule_label_expr() -> Column:
    """Deterministic stand-in for the model label, used for oracle checks."""
    pc, qc = F.col("price_clean"), F.col("quantity_clean")
    bad = (pc <= 0) | (pc > S.MAX_PRICE) | (qc == 0) | (qc > S.RAW_MAX_QUANTITY) | (F.col("id") % 7 == 0)
    return F.when(bad, F.lit(S.LABEL_ANOMALY)).otherwise(F.lit(S.LABEL_NORMAL))


def with_rule_label(features: DataFrame) -> DataFrame:
    return features.withColumn("anomaly_label", rule_label_expr()).withColumn(
        "anomaly_score", F.when(F.col("anomaly_label") == S.LABEL_ANOMALY, -1).otherwise(1))


def reason_expr(revenue_cut: Column) -> Column:
    """Sequential overwrites where the last match wins, written as one CASE
    in reverse order (first true wins)."""
    a = F.col("anomaly_label") == S.LABEL_ANOMALY
    pc, qc = F.col("price_clean"), F.col("quantity_clean")
    return (F.when(~a | a.isNull(), F.lit(S.R_NORMAL))
            .when(F.col("payment_clean") == S.UNKNOWN, F.lit(S.R_MISSING_PAYMENT))
            .when(~F.col("event_type_clean").isin(S.VALID_EVENT_TYPES), F.lit(S.R_INVALID_EVENT))
            .when(~F.col("city_clean").isin(S.RAW_VALID_CITIES), F.lit(S.R_UNKNOWN_CITY))
            .when(qc > S.RAW_MAX_QUANTITY, F.lit(S.R_QTY_OUTLIER))
            .when(qc == 0, F.lit(S.R_ZERO_QTY))
            .when(pc > S.MAX_PRICE, F.lit(S.R_PRICE_OUTLIER))
            .when(pc == 0, F.lit(S.R_ZERO_PRICE))
            .when(pc < 0, F.lit(S.R_NEG_PRICE))
            .when(F.col("revenue_clean") > revenue_cut, F.lit(S.R_HIGH_REVENUE))
            .otherwise(F.lit(S.R_ML_PATTERN)))


def high_revenue_cut(sigma: float = S.REVENUE_SIGMA) -> Column:
    """Aggregate: mean + sigma * sample std of ``revenue_clean``."""
    return F.avg("revenue_clean") + F.lit(sigma) * F.stddev_samp("revenue_clean")


def assign_reason(labelled: DataFrame, sigma: float = S.REVENUE_SIGMA,
                  population: DataFrame | None = None, cut: float | None = None) -> DataFrame:
    """Add ``anomaly_reason``.  The high-revenue cut is mean + sigma * sample
    std of ``revenue_clean`` over all rows of ``population`` (default: the
    input), evaluated once as a scalar subquery -- or passed in as ``cut``
    when the caller already computed it in another aggregate."""
    if cut is not None:
        return labelled.withColumn("anomaly_reason", reason_expr(F.lit(float(cut))))
    pop = population if population is not None else labelled
    return labelled.withColumn("anomaly_reason", reason_expr(pop.select(high_revenue_cut(sigma)).scalar()))


def summary_aggs() -> list[Column]:
    lab = F.col("anomaly_label")
    return [F.count(F.lit(1)).alias("total_rows"),
            F.count_if(lab == S.LABEL_NORMAL).alias("normal_rows"),
            F.count_if(lab == S.LABEL_ANOMALY).alias("anomaly_rows")]


def anomaly_summary(labelled: DataFrame) -> DataFrame:
    rate = F.when(F.col("total_rows") > 0, F.col("anomaly_rows") * 100.0 / F.col("total_rows"))
    return labelled.agg(*summary_aggs()).select("total_rows", "normal_rows", "anomaly_rows",
                                                rate.alias("anomaly_rate"))


def rate_drift_note(summary: DataFrame, low: float = 5.0, high: float = 20.0) -> DataFrame:
    """Flag a detected rate far from the configured contamination and the
    contamination that would match it."""
    r = F.col("anomaly_rate")
    return summary.select(
        F.round(r, 2).alias("anomaly_rate"),
        ((r < low) | (r > high)).alias("rate_far_from_target"),
        F.round(r / 100.0, 2).alias("suggested_contamination"))


def anomaly_rate_alert(labelled_or_summary: DataFrame, threshold: float = S.ALERT_THRESHOLD) -> DataFrame:
    """One alert row when the anomaly rate is strictly above ``threshold``,
    else no row."""
    s = labelled_or_summary
    if "anomaly_rate" not in s.columns:
        s = anomaly_summary(s)
    r = F.col("anomaly_rate")
    return s.where(r > threshold).select(
        F.current_timestamp().alias("alert_time"),
        F.round(r, 2).alias("anomaly_rate"),
        F.lit(float(threshold)).alias("threshold"),
        F.col("total_rows").cast("long").alias("total_rows"),
        F.col("anomaly_rows").cast("long").alias("anomaly_count"),
        F.concat(F.lit("High anomaly rate: "), F.format_string("%.1f", r), F.lit("%")).alias("message"))


def reason_breakdown(reasoned: DataFrame, top: int | None = None) -> DataFrame:
    """Count per reason among anomalies, most frequent first."""
    g = (reasoned.where(F.col("anomaly_label") == S.LABEL_ANOMALY)
         .groupBy("anomaly_reason").agg(F.count(F.lit(1)).alias("count"))
         .orderBy(F.desc("count"), "anomaly_reason"))
    return g.limit(top) if top else g


def select_anomaly_output(reasoned: DataFrame) -> DataFrame:
    """The ``anomaly_data`` columns (cleaned texts under their raw names)."""
    cols = [
        F.col("order_id"), F.col("user_id"), F.col("product_id"), F.col("product_name"),
        F.col("category_clean").alias("category"), F.col("price").alias("price_raw"),
        F.col("price_clean"), F.col("quantity").alias("quantity_raw"), F.col("quantity_clean"),
        F.col("revenue_clean").alias("revenue"), F.col("event_type_clean").alias("event_type"),
        F.col("timestamp"), F.col("payment_clean").alias("payment_method"),
        F.col("city_clean").alias("city"), F.col("anomaly_label"), F.col("anomaly_reason"),
        F.col("anomaly_score").cast("int").alias("anomaly_score"),
    ]
    if "isolation_score" in reasoned.columns:
        cols.append(F.col("isolation_score"))
    else:
        cols.append(F.lit(None).cast("double").alias("isolation_score"))
    return reasoned.select(*cols)


def from_anomaly_table(anomaly_data: DataFrame) -> DataFrame:
    """The stored ``anomaly_data`` table under the feature-frame names the
    chart and view operators use (its cleaned texts carry raw names there)."""
    names = {"category": "category_clean", "city": "city_clean", "event_type": "event_type_clean",
             "payment_method": "payment_clean", "revenue": "revenue_clean"}
    return anomaly_data.select(*[F.col(c).alias(names.get(c, c)) for c in anomaly_data.columns])
