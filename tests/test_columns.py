"""Golden rows for the cleaning column rules."""
import datetime as dt

import pytest
from pyspark.sql import functions as F

from quarry.functions import columns as C


def one(spark, expr, value, dtype="string"):
    df = spark.createDataFrame([(value,)], f"x {dtype}")
    return df.select(expr(F.col("x")).alias("y")).first()["y"]


@pytest.mark.parametrize("raw,expected", [
    (" dilli ", "Delhi"), ("BLR", "Bengaluru"), ("bangalore", "Bengaluru"), (None, "Others"),
    ("", "Others"), ("null", "Others"), ("???", "Others"), ("navi-MUMBAI", "Navi-Mumbai"),
    ("DEL", "Delhi"), ("Bombay", "Mumbai"), ("calcutta", "Kolkata"), ("pune", "Pune"),
])
def test_city(spark, raw, expected):
    assert one(spark, C.standardize_city, raw) == expected


@pytest.mark.parametrize("raw,expected", [
    (" HealthCare ", "Healthcare"), ("GOLD", "Gold"), (" home ", "Home"), ("o'neil-x1y", "O'Neil-X1y"),
])
def test_category_initcap(spark, raw, expected):
    assert one(spark, C.normalize_category, raw) == expected


@pytest.mark.parametrize("raw,expected", [(2.5, 2), (3.5, 4), (80000.0, 80000), (-2.5, 2), (0.4, 0)])
def test_price_half_even(spark, raw, expected):
    assert one(spark, C.clean_price, raw, "double") == expected


@pytest.mark.parametrize("raw,expected", [
    ("2026-05-13T16:54:05.046763", dt.datetime(2026, 5, 13, 16, 54, 5)),
    ("13-05-2026 17:14", dt.datetime(2026, 5, 13, 17, 14)),
    ("13-05-2026 17:14:59", dt.datetime(2026, 5, 13, 17, 14)),
    ("1970-01-01T00:00:00", dt.datetime(1970, 1, 1)),
    (None, None), ("", None), ("NaT", None), ("2026/05/13", None), ("45-13-2026 99:99", None),
    ("2026-13-08T02:30:00", None), ("Tuesday", None), ("2026-02-29T00:00:00", None),
    ("2024-02-29T23:59:59", dt.datetime(2024, 2, 29, 23, 59, 59)),
])
def test_timestamp(spark, raw, expected):
    assert one(spark, C.parse_event_timestamp, raw) == expected


@pytest.mark.parametrize("raw,expected", [
    ("1500", 1500.0), ("700 INR", 700.0), (" 12.5 ", 12.5), ("abc", None), ("1d", None), (None, None),
    ("8.0E7", 8.0e7),
])
def test_parse_price(spark, raw, expected):
    assert one(spark, C.parse_price, raw) == expected


def test_resolve_product_id(spark):
    df = spark.createDataFrame([(5, None), (None, 6), (0, 9), (None, None)], "product_id int, prod_id int")
    got = [r[0] for r in df.select(C.resolve_product_id()).collect()]
    assert got == [5, 6, 9, None]


def test_user_and_text_defaults(spark):
    assert one(spark, C.default_user_id, None) == "-1"
    assert one(spark, C.normalize_event_type, " VIEW ") == "view"
    assert one(spark, C.normalize_payment, " Card") == "CARD"
    assert one(spark, C.trim_product_name, " Product_5 ") == "Product_5"


def test_coerce_price_never_stringifies_doubles(spark):
    assert one(spark, lambda c: C.coerce_price(c, "double"), 8.0e7, "double") == 8.0e7
    assert one(spark, lambda c: C.coerce_price(c, "string"), "700 INR", "string") == 700.0
    assert one(spark, lambda c: C.coerce_price(c, "double"), None, "double") == 0.0


def test_timestamp_ignores_session_zone(spark):
    prev = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/Los_Angeles")
    try:  # 02:30 does not exist in that zone on this day; the text must survive unchanged
        assert one(spark, C.parse_event_timestamp, "2026-03-08T02:30:00") == dt.datetime(2026, 3, 8, 2, 30)
    finally:
        spark.conf.set("spark.sql.session.timeZone", prev)


@pytest.mark.parametrize("raw,expected", [
    ("700 INR", 700.0), ("abc", 0.0), ("-5.5", -5.5), ("1,500", 1500.0), (None, 0.0), ("", 0.0),
])
def test_coerce_price_text_column(spark, raw, expected):
    """Text prices lose every character but digits, '.' and '-', then parse;
    anything unparseable or missing is 0 (the feature step's rule)."""
    assert one(spark, lambda c: C.coerce_price(c, "string"), raw) == expected


def test_prepare_features_detects_text_price(spark):
    from quarry.operators.features import prepare_features
    df = spark.createDataFrame([("700 INR", 2, "Home", "Delhi", "view", "UPI")],
                               "price string, quantity int, category string, city string, event_type string, "
                               "payment_method string")
    r = prepare_features(df).first()
    assert r.price_clean == 700.0 and r.revenue_clean == 1400.0
