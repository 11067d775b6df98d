"""Registered views answer plain SQL, and agree with the operators."""
import os

from quarry.operators import clean as CL
from quarry.operators import kpi as K
from quarry.session import scratch_path
from quarry.sources import tables as TB
from quarry.sources.fixture import raw_data

from conftest import SF_SMALL


def test_views_agree_with_operators(spark):
    raw = raw_data(spark, SF_SMALL)
    cleaned = CL.clean_events(raw)
    assert TB.register_views(spark, raw=raw, cleaned=cleaned) == ["cleaned_data", "raw_data"]
    ids = spark.sql("SELECT count(id) - count(DISTINCT id) AS repeated, max(id) AS top FROM raw_data").first()
    assert ids.repeated == 0 and ids.top == raw.selectExpr("max(id)").first()[0]
    mean = {r.category: r.mean_price for r in spark.sql(
        "SELECT category, round(avg(price), 6) AS mean_price FROM cleaned_data GROUP BY category").collect()}
    own = {r.category: r.m for r in cleaned.groupBy("category").agg({"price": "avg"}).selectExpr("category", "round(`avg(price)`, 6) AS m").collect()}
    assert mean == own and set(mean) == {r.category for r in K.revenue_by_category(cleaned).collect()}


def test_replace_table_swaps(spark):
    raw = raw_data(spark, SF_SMALL)
    target = scratch_path(spark, "swap")
    TB.replace_table(raw.limit(10), target)
    TB.replace_table(raw.limit(20), target)
    assert TB.scan(spark, target).count() == 20
    parent = os.path.dirname(target.replace("file:", ""))
    assert [f for f in os.listdir(parent) if "__staging" in f or "__replaced" in f] == []
