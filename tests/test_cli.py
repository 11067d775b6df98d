"""The command line runs the jobs on table paths."""
from quarry.__main__ import main
from quarry.session import scratch_path
from quarry.sources import tables as TB
from quarry.sources.fixture import raw_data

from conftest import SF_SMALL


def test_clean_then_analyze(spark, capsys):
    raw_p = scratch_path(spark, "cli-raw")
    TB.replace_table(raw_data(spark, SF_SMALL), raw_p)
    out = scratch_path(spark, "cli-out")
    assert main(["clean", "--raw", raw_p, "--out", out]) == 0
    assert main(["analyze", "--cleaned", out + "/cleaned_data", "--out", out]) == 0
    printed = capsys.readouterr().out
    assert '"cleaned_rows"' in printed and "Top Category:" in printed and "Total Revenue:" in printed


def test_detect_and_ingest(spark, capsys):
    import json

    from quarry.sources import events as EV
    raw = raw_data(spark, SF_SMALL)
    raw_p = scratch_path(spark, "cli-raw2")
    TB.replace_table(raw, raw_p)
    out = scratch_path(spark, "cli-detect")
    assert main(["detect", "--raw", raw_p, "--out", out]) == 0
    det = json.loads(capsys.readouterr().out.strip().splitlines()[-1])
    assert det["total_rows"] == raw.count() and det["anomalies"] > 0
    assert TB.scan(spark, out + "/anomaly_data").count() == det["total_rows"]
    src = scratch_path(spark, "cli-events")
    EV.write_events(raw.drop("id"), src)
    out2 = scratch_path(spark, "cli-ingest")
    assert main(["ingest", "--source", src, "--out", out2]) == 0
    assert json.loads(capsys.readouterr().out.strip().splitlines()[-1])["cleaned_rows"] > 0
