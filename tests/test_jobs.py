"""The batch job's shortcuts (one aggregate for threshold + revenue cut,
label counts observed during the write) give the same result as the
operator-by-operator path."""
import pytest

from quarry.operators import anomaly as A
from quarry.operators import features as FE
from quarry.operators import iforest as IF
from quarry.plans import jobs as J
from quarry.session import scratch_path
from quarry.sources import tables as TB
from quarry.sources.fixture import raw_data

from conftest import SF_SMALL


def test_job_matches_operators(spark):
    raw = raw_data(spark, SF_SMALL)
    out = scratch_path(spark, "job-test")
    det = J.run_anomaly_detection(spark, raw, out)
    written = TB.scan(spark, J.table_path(out, "anomaly_data"))
    feats, n = FE.build_features_counted(raw)
    lab, _, thr = IF.fit_predict(feats, n_rows=n)
    expect = A.select_anomaly_output(A.assign_reason(lab))
    cols = ["order_id", "price_raw", "quantity_raw", "timestamp", "anomaly_label", "anomaly_reason", "anomaly_score"]
    assert written.select(*cols).exceptAll(expect.select(*cols)).count() == 0
    assert expect.select(*cols).exceptAll(written.select(*cols)).count() == 0
    assert det["threshold"] == thr and det["total_rows"] == n
    assert det["anomalies"] == written.where("anomaly_label = 'Anomaly'").count()
    assert det["alert_raised"] is False


def test_views_on_stored_anomaly_table(spark):
    from quarry.operators import charts as CH
    from quarry.operators import views as V
    raw = raw_data(spark, SF_SMALL)
    out = scratch_path(spark, "job-views")
    J.run_anomaly_detection(spark, raw, out)
    stored = A.from_anomaly_table(TB.scan(spark, J.table_path(out, "anomaly_data")))
    overview = {(r.section, r.key): r.n for r in V.anomaly_overview(stored).collect()}
    assert overview[("anomaly_label", "Normal")] + overview[("anomaly_label", "Anomaly")] == raw.count()
    by_city = CH.anomalies_by_city(stored).collect()
    assert sum(r["count"] for r in by_city) == overview[("anomaly_label", "Anomaly")]
    assert CH.price_histogram(stored).count() > 0


def test_job_appends_alert_above_threshold(spark):
    raw = raw_data(spark, SF_SMALL)
    out = scratch_path(spark, "job-alert")
    cfg = J.JobConfig(alert_threshold=5.0)
    for _ in range(2):  # each run appends one alert row
        det = J.run_anomaly_detection(spark, raw, out, cfg)
    assert det["alert_raised"] is True
    alerts = TB.scan(spark, J.table_path(out, "anomaly_alerts")).collect()
    assert len(alerts) == 2
    a = alerts[0]
    assert a.threshold == 5.0 and a.total_rows == det["total_rows"] and a.anomaly_count == det["anomalies"]
    assert a.message == f"High anomaly rate: {det['anomaly_rate']:.1f}%"


def test_job_drops_scored_scratch(spark):
    import os

    from quarry.session import ensure_checkpoint_dir
    base = os.path.join(ensure_checkpoint_dir(spark).replace("file:", ""), "quarry-scratch")
    before = {f for f in os.listdir(base) if f.startswith("scored-")} if os.path.isdir(base) else set()
    J.run_anomaly_detection(spark, raw_data(spark, SF_SMALL), scratch_path(spark, "job-scratch"))
    after = {f for f in os.listdir(base) if f.startswith("scored-")}
    assert after - before == set()


@pytest.mark.parametrize("change", [None, "input", "table"])
def test_a_failed_job_goes_on_where_it_failed(spark, monkeypatch, change):
    """Nothing is scored again, and no alert raised twice, unless the input or
    a table that a step wrote has changed."""
    raw, out = raw_data(spark, SF_SMALL), scratch_path(spark, "job-resumed")
    cfg = J.JobConfig(alert_threshold=5.0)
    scored, train = [], IF.train_isolation_forest
    monkeypatch.setattr(IF, "train_isolation_forest", lambda *a, **k: (scored.append(1), train(*a, **k))[1])
    analysis = J.run_analysis
    monkeypatch.setattr(J, "run_analysis", lambda *a: (_ for _ in ()).throw(OSError("lost")))
    with pytest.raises(OSError):
        J.run_batch_job(spark, raw, out, cfg)
    monkeypatch.setattr(J, "run_analysis", analysis)
    assert len(scored) == 1
    if change == "input":
        raw = raw.where("id % 2 = 0")
    if change == "table":
        TB.replace_table(TB.scan(spark, out + "/anomaly_data").limit(5), out + "/anomaly_data")
    report = J.run_batch_job(spark, raw, out, cfg).first()
    assert len(scored) == (1 if change is None else 2)
    assert report.total_rows == raw.count() == TB.scan(spark, out + "/anomaly_data").count()
    assert report.cleaned_rows == TB.scan(spark, out + "/cleaned_data").count() and report.insights == 6
    alerts = TB.scan(spark, out + "/anomaly_alerts").count()
    assert alerts == (2 if change == "input" else 1)
    J.run_batch_job(spark, raw, out, cfg)  # a finished job starts anew
    assert len(scored) == (2 if change is None else 3)
    assert TB.scan(spark, out + "/anomaly_alerts").count() == alerts + 1


def test_fingerprints_do_not_depend_on_running_numbers(spark):
    cfg = J.JobConfig()
    one = J.input_fingerprint(raw_data(spark, SF_SMALL), cfg)
    assert one == J.input_fingerprint(raw_data(spark, SF_SMALL), cfg)
    assert one != J.input_fingerprint(raw_data(spark, SF_SMALL).where("price > 1"), cfg)
    assert one != J.input_fingerprint(raw_data(spark, SF_SMALL), J.JobConfig(seed=1))
