"""Isolation-forest and job queries.

The model is not SQL-expressible, so its own rows are checked by number only.
``*_invariants`` queries run the same operators and compare with SQL what must
hold of any forest: root sizes and leaf sums, one score for equal features,
labels on the right side of the threshold, every raw row in the stored table.
More of them (determinism, planted outliers) are in tests/test_iforest.py.  Sinks write into a fresh folder under the shared
checkpoint folder and return the read-back, which for cleaning and KPIs is
compared with SQL.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from quarry import schemas as S
from quarry.operators import anomaly as A
from quarry.operators import clean as CL
from quarry.operators import features as FE
from quarry.operators import iforest as IF
from quarry.plans import jobs as J
from quarry.plans.oracle import CLEAN_SELECT, with_clean, with_raw
from quarry.plans.queries_batch import _INSIGHTS
from quarry.plans.registry import register
from quarry.session import scratch_path
from quarry.sources import tables as TB
from quarry.sources.fixture import raw_data


def _labelled(spark, sf):
    feats, n = FE.build_features_counted(raw_data(spark, sf))
    labelled, _, _ = IF.fit_predict(feats, n_rows=n)
    return labelled


@register("train_isolation_forest")
def q_train_isolation_forest(spark, sf):
    feats, n = FE.build_features_counted(raw_data(spark, sf))
    return IF.train_isolation_forest(feats, n_rows=n).nodes


@register("score_isolation_forest")
def q_score_isolation_forest(spark, sf):
    feats, n = FE.build_features_counted(raw_data(spark, sf))
    return IF.train_isolation_forest(feats, n_rows=n).score(feats).select("id", "isolation_score")


@register("train_isolation_forest_invariants", with_raw(
    "SELECT 100 AS trees, CAST(least(256, count(*)) AS INTEGER) AS least_root, CAST(least(256, count(*)) AS INTEGER) AS largest_root, "
    "CAST(0 AS BIGINT) AS wrong_leaf_sums, CAST(0 AS BIGINT) AS wrong_shapes FROM raw_data"))
def q_train_isolation_forest_invariants(spark, sf):
    """A tree's root has psi rows, its leaves together as many, and every inner
    node two children."""
    feats, n = FE.build_features_counted(raw_data(spark, sf))
    nodes = IF.train_isolation_forest(feats, n_rows=n).nodes
    leaf = F.col("left_child") < 0
    trees = nodes.groupBy("tree").agg(F.max(F.when(F.col("node") == 0, F.col("size"))).alias("root"),
                                      F.sum(F.when(leaf, F.col("size"))).alias("leaves"),
                                      F.count_if(leaf).alias("n_leaves"), F.count_if(~leaf).alias("n_inner"))
    return trees.agg(F.count(F.lit(1)).cast("int").alias("trees"), F.min("root").alias("least_root"), F.max("root").alias("largest_root"),
                     F.count_if(F.col("leaves") != F.col("root")).alias("wrong_leaf_sums"),
                     F.count_if(F.col("n_leaves") != F.col("n_inner") + 1).alias("wrong_shapes"))


@register("score_isolation_forest_invariants", with_raw(
    "SELECT count(*) AS rows, CAST(0 AS BIGINT) AS out_of_range, CAST(0 AS BIGINT) AS unequal FROM raw_data"))
def q_score_isolation_forest_invariants(spark, sf):
    """Every row has a score from -1 to 0, and rows of equal features the same."""
    feats, n = FE.build_features_counted(raw_data(spark, sf))
    scored = IF.train_isolation_forest(feats, n_rows=n).score(feats)
    score = F.col("isolation_score")
    same = scored.groupBy(*S.FEATURE_COLS).agg(F.count(F.lit(1)).alias("n"), F.min(score).alias("a"), F.max(score).alias("b"))
    return same.agg(F.sum("n").alias("rows"), F.count_if((F.col("a") < -1) | (F.col("b") >= 0) | F.col("a").isNull()).alias("out_of_range"),
                    F.count_if(F.col("a") != F.col("b")).alias("unequal"))


@register("label_anomalies_invariants", with_raw(
    "SELECT count(*) AS rows, CAST(0 AS BIGINT) AS mislabelled, false AS too_many, false AS too_few FROM raw_data"))
def q_label_anomalies_invariants(spark, sf):
    """Anomalies are the rows below the threshold: no more than the contamination,
    and with the rows just on it no fewer."""
    feats, n = FE.build_features_counted(raw_data(spark, sf))
    labelled, _, threshold = IF.fit_predict(feats, n_rows=n)
    below, rows = F.col("isolation_score") < threshold, F.count(F.lit(1))
    is_anomaly = F.col("anomaly_label") == S.LABEL_ANOMALY
    return labelled.agg(rows.alias("rows"), F.count_if((is_anomaly != below) | (is_anomaly != (F.col("anomaly_score") == -1))).alias("mislabelled"),
                        (F.count_if(is_anomaly) > S.CONTAMINATION * rows + 1).alias("too_many"),
                        (F.count_if(F.col("isolation_score") <= threshold) < S.CONTAMINATION * (rows - 1)).alias("too_few"))


@register("label_anomalies")
def q_label_anomalies(spark, sf):
    return _labelled(spark, sf).select("id", "isolation_score", "anomaly_score", "anomaly_label")


@register("anomaly_summary")
def q_anomaly_summary(spark, sf):
    return A.anomaly_summary(_labelled(spark, sf))


@register("rate_drift_note")
def q_rate_drift_note(spark, sf):
    return A.rate_drift_note(A.anomaly_summary(_labelled(spark, sf)))


@register("anomaly_rate_alert")
def q_anomaly_rate_alert(spark, sf):
    return A.anomaly_rate_alert(_labelled(spark, sf), threshold=S.CONTAMINATION * 50)  # half the expected rate: an alert


@register("assign_reason")
def q_assign_reason(spark, sf):
    return A.assign_reason(_labelled(spark, sf)).select("id", "anomaly_label", "anomaly_reason")


@register("reason_breakdown")
def q_reason_breakdown(spark, sf):
    return A.reason_breakdown(A.assign_reason(_labelled(spark, sf)))


@register("select_anomaly_output")
def q_select_anomaly_output(spark, sf):
    return A.select_anomaly_output(A.assign_reason(_labelled(spark, sf)))


# -------------------------------------------------------------------- sinks
@register("replace_table", with_raw(CLEAN_SELECT))
def q_replace_table(spark, sf):
    target = scratch_path(spark, "cleaned_data")
    TB.replace_table(CL.clean_events(raw_data(spark, sf)), target)
    TB.replace_table(CL.clean_events(raw_data(spark, sf)), target)  # second replace must not duplicate
    return TB.scan(spark, target)


@register("scan_cleaned", with_raw(CLEAN_SELECT))
def q_scan_cleaned(spark, sf):
    target = scratch_path(spark, "cleaned_data")
    TB.replace_table(CL.clean_events(raw_data(spark, sf)), target)
    return TB.scan(spark, target)


@register("append_table", with_raw("SELECT * FROM raw_data UNION ALL SELECT * FROM raw_data"))
def q_append_table(spark, sf):
    target = scratch_path(spark, "raw_data")
    TB.create_raw_table(spark, target)
    TB.append_raw(raw_data(spark, sf), target)
    TB.append_raw(raw_data(spark, sf), target)
    return TB.scan(spark, target)


@register("create_raw_table", with_raw("SELECT * FROM raw_data"))
def q_create_raw_table(spark, sf):
    """Create the landing table, fill it, create it again: all rows are there."""
    target = scratch_path(spark, "raw_data")
    TB.create_raw_table(spark, target)
    TB.append_raw(raw_data(spark, sf), target)
    TB.create_raw_table(spark, target)
    return TB.scan(spark, target)


# --------------------------------------------------------------------- jobs
@register("run_anomaly_detection")
def q_run_anomaly_detection(spark, sf):
    out = scratch_path(spark, "job")
    J.run_anomaly_detection(spark, raw_data(spark, sf), out)
    return TB.scan(spark, J.table_path(out, "anomaly_data"))


@register("run_anomaly_detection_rows", with_raw(
    "SELECT order_id, user_id, product_id, product_name, price AS price_raw, quantity AS quantity_raw, timestamp FROM raw_data"))
def q_run_anomaly_detection_rows(spark, sf):
    """Every raw row is in the stored anomaly table, once."""
    out = scratch_path(spark, "job")
    J.run_anomaly_detection(spark, raw_data(spark, sf), out)
    return (TB.scan(spark, J.table_path(out, "anomaly_data"))
            .select("order_id", "user_id", "product_id", "product_name", "price_raw", "quantity_raw", "timestamp"))


@register("run_analysis", with_clean(_INSIGHTS))
def q_run_analysis(spark, sf):
    out = scratch_path(spark, "job")
    cleaned = J.clean_to_table(spark, raw_data(spark, sf), out)
    return J.run_analysis(spark, cleaned, out)


@register("run_batch_job")
def q_run_batch_job(spark, sf):
    return J.run_batch_job(spark, raw_data(spark, sf), scratch_path(spark, "job"))


@register("run_batch_job_report", with_clean(
    "SELECT (SELECT count(*) FROM raw_data) AS total_rows, (SELECT count(*) FROM raw_data) AS labelled_rows, "
    "CAST(6 AS BIGINT) AS insights, (SELECT count(*) FROM cleaned_data) AS cleaned_rows"))
def q_run_batch_job_report(spark, sf):
    """What the run report must say of any forest."""
    report = J.run_batch_job(spark, raw_data(spark, sf), scratch_path(spark, "job"))
    return report.select("total_rows", (F.col("anomalies") + F.col("normal_rows")).alias("labelled_rows"), "insights", "cleaned_rows")
