"""A hot key holding a third of all rows: results stay whole and exact, and
the plans combine map-side before the shuffle."""
from pyspark.sql import functions as F

from quarry.operators import clean as CL
from quarry.operators import quality as Q
from quarry.sources.fixture import raw_data

from conftest import SF_SMALL


def _hot(spark):
    raw = raw_data(spark, SF_SMALL)
    n = raw.count()
    hot_row = raw.where("price > 0 AND price <= 80000 AND quantity BETWEEN 1 AND 3 AND order_id IS NOT NULL "
                        "AND product_id IS NOT NULL AND product_name IS NOT NULL AND category IS NOT NULL "
                        "AND payment_method IS NOT NULL AND event_type = 'view'").first().asDict()
    copies = spark.range(n // 2).select(
        (F.col("id") + 10**12).alias("id"),
        *[F.lit(v).cast(t).alias(c) for c, t in raw.dtypes if c != "id" for v in [hot_row[c]]])
    return raw.unionByName(copies.select(*raw.columns)), n


def test_hot_duplicate_group(spark):
    skewed, n = _hot(spark)
    total = skewed.count()
    assert total >= n + n // 2 - 1
    base = CL.clean_events(raw_data(spark, SF_SMALL)).count()
    assert CL.clean_events(skewed).count() in (base, base + 1)   # the hot group collapses to one row
    top = Q.qc_duplicate_orders(skewed).first()
    assert top["count"] >= n // 2
    plan = CL.clean_events(skewed)._jdf.queryExecution().executedPlan().toString()
    assert "HashAggregate" in plan and plan.count("HashAggregate") >= 2   # partial + final around the exchange
