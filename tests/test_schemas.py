"""Output tables keep the declared schemas."""
from quarry import schemas as S
from quarry.operators import anomaly as A
from quarry.operators import clean as CL
from quarry.operators import features as FE
from quarry.sources.fixture import raw_data

from conftest import SF_SMALL


def test_table_schemas(spark):
    raw = raw_data(spark, SF_SMALL)
    assert raw.columns == S.RAW_COLS
    assert [(f.name, f.dataType) for f in raw.schema.fields] == [(f.name, f.dataType) for f in S.RAW.fields]
    cleaned = CL.clean_events(raw)
    assert cleaned.columns == S.CLEANED_COLS
    assert dict(cleaned.dtypes)["event_timestamp"] == "timestamp_ntz"
    assert dict(cleaned.dtypes)["price"] == "bigint" and dict(cleaned.dtypes)["revenue"] == "bigint"
    lab = A.with_rule_label(FE.build_features(raw))
    out = A.select_anomaly_output(A.assign_reason(lab))
    assert out.columns == S.ANOMALY_COLS
    summary = spark.createDataFrame([(100, 80, 20, 20.0)], "total_rows long, normal_rows long, anomaly_rows long, "
                                                          "anomaly_rate double")
    alert = A.anomaly_rate_alert(summary)
    assert [(f.name, f.dataType) for f in alert.schema.fields] == [(f.name, f.dataType) for f in S.ALERT.fields]
