"""KPI edge cases."""
import datetime as dt

from quarry.operators import kpi as K

SCHEMA = ("order_id int, user_id string, product_id int, product_name string, category string, price long, "
          "quantity long, event_type string, event_timestamp timestamp_ntz, payment_method string, city string, "
          "revenue long")


def test_zero_views_and_ties(spark):
    t = dt.datetime(2026, 1, 1, 5, 0)
    rows = [(1, "1", 1, "P", "Home", 10, 1, "purchase", t, "UPI", "Delhi", 10),
            (2, "1", 1, "P", "Gold", 10, 1, "purchase", t.replace(hour=3), "UPI", "Agra", 10),
            (3, "1", 1, "P", "Gold", 5, 1, "add_to_cart", None, "COD", "Delhi", 5)]
    df = spark.createDataFrame(rows, SCHEMA)
    got = dict((r.metric, r.value) for r in K.business_insights(df).collect())
    assert got == {"Top Category": "Gold", "Peak Hour": "3:00", "Conversion Rate": "0%", "Top City": "Delhi",
                   "Total Orders": "2", "Total Revenue": "25"}
    assert K.business_insights(df, "all").collect()[4].value == "3"
