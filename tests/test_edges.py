"""Edge cases: tiny and constant inputs, empty tables."""
import pytest
from pyspark.sql import functions as F

from quarry import schemas as S
from quarry.operators import anomaly as A
from quarry.operators import clean as CL
from quarry.operators import features as FE
from quarry.operators import iforest as IF
from quarry.operators import kpi as K
from quarry.sources.fixture import raw_data

from conftest import SF_SMALL


@pytest.mark.parametrize("n", [1, 5])
def test_tiny_input(spark, n):
    feats = FE.build_features(raw_data(spark, SF_SMALL).orderBy("id").limit(n))
    lab, model, _ = IF.fit_predict(feats, checkpoint=False)
    assert model.psi == n
    assert lab.count() == n
    assert lab.where("anomaly_label = 'Anomaly'").count() <= max(1, int(0.1 * n) + 1)


def test_constant_features_tie(spark):
    feats = (FE.build_features(raw_data(spark, SF_SMALL))
             .select("id", *[F.lit(1.0).alias(c) for c in S.FEATURE_COLS]))
    lab, _, _ = IF.fit_predict(feats, checkpoint=False)
    # every score ties with the threshold, none is strictly below it
    assert lab.where("anomaly_label = 'Anomaly'").count() == 0
    assert lab.select("isolation_score").distinct().count() == 1


def test_zero_rows(spark):
    empty = FE.build_features(raw_data(spark, SF_SMALL).where(F.lit(False)))
    with pytest.raises(ValueError):
        IF.train_isolation_forest(empty)


def test_empty_cleaned_kpis(spark):
    cleaned = CL.clean_events(raw_data(spark, SF_SMALL).where(F.lit(False)))
    got = {r.metric: r.value for r in K.business_insights(cleaned).collect()}
    assert got["Conversion Rate"] == "0%" and got["Total Orders"] == "0" and got["Total Revenue"] == "0"
    assert got["Top Category"] is None
    s = A.anomaly_summary(A.with_rule_label(FE.build_features(raw_data(spark, SF_SMALL).where(F.lit(False)))))
    assert s.first().total_rows == 0 and s.first().anomaly_rate is None
