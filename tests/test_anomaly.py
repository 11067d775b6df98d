"""Reason precedence, the high-revenue rule, summary and alert boundaries."""
from pyspark.sql import functions as F

from quarry import schemas as S
from quarry.operators import anomaly as A
from quarry.operators import features as FE


def raw_rows(spark, rows):
    return spark.createDataFrame(rows, S.RAW)


def base(i, **kw):
    d = dict(id=i, order_id=2000 + i, user_id="1", product_id=1, product_name="P", category="Home",
             price=10.0, quantity=1, event_type="view", timestamp="2026-01-01T00:00:00",
             payment_method="UPI", city="Delhi")
    d.update(kw)
    return tuple(d[c] for c in S.RAW_COLS)


def labelled(spark, rows, label="Anomaly"):
    f = FE.build_features(raw_rows(spark, rows))
    return f.withColumn("anomaly_label", F.lit(label))


def test_unusually_high_revenue(spark):
    rows = [base(i) for i in range(100)] + [base(100, price=80000.0, quantity=3)]
    out = A.assign_reason(labelled(spark, rows)).where("id = 100").first()
    assert out.anomaly_reason == S.R_HIGH_REVENUE
    assert A.assign_reason(labelled(spark, rows)).where("id = 0").first().anomaly_reason == S.R_ML_PATTERN


def test_last_rule_wins(spark):
    rows = [base(1, payment_method=None, city="???", price=-5.0),   # payment beats everything
            base(2, event_type="BUY", city="???"),                   # event type beats city
            base(3, city="Bengaluru", quantity=500),                 # raw list says Bangalore
            base(4, quantity=0, price=90000.0),                      # zero quantity beats price outlier
            base(5, price=0.0), base(6, price=-1.0)]
    got = {r.id: r.anomaly_reason for r in A.assign_reason(labelled(spark, rows)).collect()}
    assert got == {1: S.R_MISSING_PAYMENT, 2: S.R_INVALID_EVENT, 3: S.R_UNKNOWN_CITY,
                   4: S.R_ZERO_QTY, 5: S.R_ZERO_PRICE, 6: S.R_NEG_PRICE}


def test_normal_rows_keep_normal(spark):
    rows = [base(1, price=-5.0)]
    r = A.assign_reason(labelled(spark, rows, "Normal")).first()
    assert r.anomaly_reason == "Normal"


def _summary(spark, total, anomalies):
    return spark.createDataFrame([(total, total - anomalies, anomalies, anomalies * 100.0 / total)],
                                 "total_rows long, normal_rows long, anomaly_rows long, anomaly_rate double")


def test_alert_boundary(spark):
    assert A.anomaly_rate_alert(_summary(spark, 1000, 150)).count() == 0     # 15.0 -> none
    a = A.anomaly_rate_alert(_summary(spark, 1000, 151)).collect()           # 15.1 -> one
    assert len(a) == 1 and a[0].message == "High anomaly rate: 15.1%" and a[0].anomaly_count == 151
    assert a[0].threshold == 15.0 and a[0].anomaly_rate == 15.1


def test_drift_note(spark):
    r = A.rate_drift_note(_summary(spark, 1000, 30)).first()
    assert r.rate_far_from_target and r.suggested_contamination == 0.03


def test_invariants_on_forest_labels(spark):
    from quarry.operators import charts as CH
    from quarry.operators import iforest as IF
    from quarry.sources.fixture import raw_data
    from conftest import SF_SMALL
    feats = FE.build_features(raw_data(spark, SF_SMALL))
    lab, _, _ = IF.fit_predict(feats, checkpoint=False)
    reasoned = A.assign_reason(lab)
    # reason = Normal <=> label = Normal
    assert reasoned.where("(anomaly_reason = 'Normal') <> (anomaly_label = 'Normal')").count() == 0
    # histogram counts add up to the rows of each label
    hist = {r.anomaly_label: r.n for r in CH.price_histogram(lab).groupBy("anomaly_label")
            .agg(F.sum("count").alias("n")).collect()}
    sizes = {r.anomaly_label: r["count"] for r in lab.groupBy("anomaly_label").count().collect()}
    assert hist == sizes
