"""Deterministic dirty ``raw_data`` derived from the driver's ``events`` table.

The driver tables are clean, so the cleaning and anomaly operators need a
dirty landing table with the defects the event generator injects (negative,
zero, x1000 and missing prices, bot rows, retried orders, UUID user ids,
renamed/missing fields, odd spellings, broken timestamps).  One SQL text
builds it; it runs unchanged in Spark and DuckDB, so the oracle sees exactly
the same rows.  Every defect is a function of ``event_id`` and the event's own
columns, so the table grows with ``events`` and is partitioned like it (no
shuffle: narrow projection plus a filtered self-union).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

_EVENTS = "__EVENTS__"

RAW_FIXTURE_CTES = """b AS (
  SELECT event_id AS id, user_id AS uid, event_type AS et,
         replace(CAST(ts AS STRING), ' ', 'T') AS iso,
         CAST(round(value * 500) AS DOUBLE) AS p
  FROM __EVENTS__
), one AS (
  SELECT id,
    CAST(CASE WHEN id % 50 = 7 THEN NULL WHEN id % 33 = 5 THEN 1111 ELSE 1000 + id % 9000 END AS INT) AS order_id,
    CASE WHEN id % 25 = 6 THEN CAST(9000 + id % 21 AS STRING) WHEN id % 97 = 1 THEN NULL
         WHEN id % 12 = 3 THEN concat('00000000-0000-4000-8000-', lpad(CAST(uid AS STRING), 12, '0'))
         ELSE CAST(uid AS STRING) END AS user_id,
    CAST(CASE WHEN id % 33 = 4 THEN NULL ELSE 1 + id % 100 END AS INT) AS product_id,
    CASE WHEN id % 20 = 9 THEN NULL WHEN id % 4 = 0 THEN concat(' Product_', CAST(1 + id % 100 AS STRING), ' ')
         WHEN id % 4 = 1 THEN concat('product_', CAST(1 + id % 100 AS STRING))
         WHEN id % 4 = 2 THEN concat('PRODUCT ', CAST(1 + id % 100 AS STRING))
         ELSE concat('Prod-', CAST(1 + id % 100 AS STRING)) END AS product_name,
    CASE WHEN id % 25 = 11 THEN NULL WHEN uid % 5 = 0 THEN 'Electronics' WHEN uid % 5 = 1 THEN 'Fashion'
         WHEN uid % 5 = 2 THEN ' home ' WHEN uid % 5 = 3 THEN 'GOLD' ELSE 'HealthCare' END AS category,
    CASE WHEN id % 50 = 1 THEN -p WHEN id % 50 = 2 THEN CAST(0 AS DOUBLE) WHEN id % 50 = 3 THEN p * 1000
         WHEN id % 100 = 4 THEN NULL WHEN id % 50 = 5 THEN p + 0.5 ELSE p END AS price,
    CAST(CASE WHEN id % 33 = 8 THEN NULL WHEN id % 25 = 6 THEN 0 WHEN id % 50 = 9 THEN 500 + id % 9500 ELSE 1 + id % 3 END AS INT) AS quantity,
    CASE WHEN id % 100 = 10 THEN 'AddToCart' WHEN id % 100 = 20 THEN ' VIEW ' WHEN id % 100 = 30 THEN 'BUY'
         WHEN id % 100 = 40 THEN NULL WHEN et = 'click' THEN 'add_to_cart' WHEN et = 'purchase' OR et = 'signup' THEN 'purchase' ELSE 'view' END AS event_type,
    CASE WHEN id % 33 = 1 THEN '1970-01-01T00:00:00'
         WHEN id % 33 = 2 THEN concat(substr(iso, 9, 2), '-', substr(iso, 6, 2), '-', substr(iso, 1, 4), ' ', substr(iso, 12, 5))
         WHEN id % 33 = 3 THEN concat('2031', substr(iso, 5)) WHEN id % 50 = 13 THEN 'NaT'
         WHEN id % 200 = 17 THEN '' WHEN id % 200 = 117 THEN NULL
         WHEN id % 200 = 57 THEN substr(iso, 1, 16) ELSE iso END AS timestamp,
    CASE WHEN id % 12 = 2 THEN NULL WHEN uid % 3 = 0 THEN 'UPI' WHEN uid % 3 = 1 THEN ' Card' ELSE 'cod' END AS payment_method,
    CASE WHEN id % 100 = 60 THEN 'DELHI' WHEN id % 100 = 62 THEN 'mumbai' WHEN id % 100 = 64 THEN 'Dilli' WHEN id % 100 = 65 THEN 'Bombay'
         WHEN id % 100 = 66 THEN 'Calcutta' WHEN id % 100 = 67 THEN 'BLR' WHEN id % 100 = 68 THEN '???' WHEN id % 100 = 70 THEN NULL
         WHEN id % 100 = 71 THEN 'null' WHEN id % 100 = 72 THEN 'navi-MUMBAI' WHEN uid % 4 = 0 THEN 'Delhi' WHEN uid % 4 = 1 THEN 'Mumbai'
         WHEN uid % 4 = 2 THEN 'Kolkata' ELSE 'Bangalore' END AS city
  FROM b
), raw_data AS (
  SELECT * FROM one
  UNION ALL
  SELECT id + 1000000000 AS id, order_id, user_id, product_id, product_name, category, price, quantity,
         event_type, timestamp, payment_method, city FROM one WHERE id % 40 = 0
)"""


def raw_fixture_ctes(events_table: str = "events") -> str:
    """CTE list ``b, one, raw_data`` for an SQL engine that has ``events``."""
    return RAW_FIXTURE_CTES.replace(_EVENTS, events_table)


def read_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/events.parquet")


def raw_from_events(spark: SparkSession, events: DataFrame) -> DataFrame:
    """The dirty ``raw_data`` table over an ``events`` DataFrame."""
    sql = "WITH " + RAW_FIXTURE_CTES.replace(_EVENTS, "{events}") + " SELECT * FROM raw_data"
    return spark.sql(sql, events=events)


def raw_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return raw_from_events(spark, read_events(spark, sf_dir))
