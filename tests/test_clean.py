"""Cleaning filter bounds and invariants."""
from pyspark.sql import functions as F

from quarry import schemas as S
from quarry.operators.clean import clean_events
from quarry.sources.fixture import raw_data

from conftest import SF_SMALL


def row(**kw):
    base = dict(id=1, order_id=2001, user_id="7", product_id=5, product_name="P", category="Home",
                price=100.0, quantity=1, event_type="view", timestamp="2026-05-13T16:54:05",
                payment_method="UPI", city="Delhi")
    base.update(kw)
    return tuple(base[c] for c in S.RAW_COLS)


def test_bounds(spark):
    rows = [row(id=1, price=80000.0), row(id=2, order_id=2, price=80000.4), row(id=3, order_id=3, quantity=10),
            row(id=4, order_id=4, quantity=11), row(id=5, order_id=5, event_type=" VIEW "),
            row(id=6, order_id=6, event_type="AddToCart"), row(id=7, order_id=7, event_type=None),
            row(id=8, order_id=8, user_id=None, city=None, timestamp=None)]
    out = clean_events(spark.createDataFrame(rows, S.RAW)).orderBy("order_id").collect()
    assert [r.order_id for r in out] == [3, 5, 8, 2001]
    r8 = [r for r in out if r.order_id == 8][0]
    assert r8.user_id == "-1" and r8.city == "Others" and r8.event_timestamp is None


def test_distinct_merges_spelling_variants(spark):
    rows = [row(id=1, category="GOLD", timestamp="2026-05-13T16:54:05.1"),
            row(id=2, category="gold", timestamp="2026-05-13T16:54:05.9")]
    assert clean_events(spark.createDataFrame(rows, S.RAW)).count() == 1


def test_invariants_on_fixture(spark):
    raw = raw_data(spark, SF_SMALL)
    c = clean_events(raw)
    bad = c.where((F.col("revenue") != F.col("price") * F.col("quantity")) | (F.col("price") < 0)
                  | (F.col("price") > 80000) | (F.col("quantity") < 1) | (F.col("quantity") > 10)).count()
    assert bad == 0
    assert c.count() == c.distinct().count()
    assert c.count() <= raw.count()
