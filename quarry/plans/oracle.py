"""Independent DuckDB SQL for every SQL-expressible query.

Each text starts from the same ``raw_data`` fixture CTEs over the driver's
``events`` view and re-states the operator in plain SQL, so the comparison
checks our DataFrame code against a second engine.
"""

from __future__ import annotations

from quarry.sources.fixture import raw_fixture_ctes


def initcap_sql(x: str) -> str:
    """Word-boundary INITCAP in DuckDB (it has no initcap); null stays null."""
    return (f"CASE WHEN ({x}) IS NULL THEN NULL ELSE coalesce(list_aggregate(list_transform("
            f"regexp_extract_all({x}, '[\\p{{L}}\\p{{N}}]+|[^\\p{{L}}\\p{{N}}]+'), "
            f"lambda w: upper(substr(w, 1, 1)) || lower(substr(w, 2))), 'string_agg', ''), '') END")


EVENT_TYPES = "('view', 'add_to_cart', 'purchase')"


def city_sql(c: str = "city") -> str:
    return (f"CASE WHEN {c} IS NULL OR trim({c}) = '' OR lower(trim({c})) = 'null' THEN 'Others' "
            f"WHEN {c} LIKE '%?%' THEN 'Others' "
            f"WHEN lower(trim({c})) IN ('del', 'delhi', 'dilli') THEN 'Delhi' "
            f"WHEN lower(trim({c})) IN ('mum', 'mumbai', 'bombay') THEN 'Mumbai' "
            f"WHEN lower(trim({c})) IN ('kol', 'kolkata', 'calcutta') THEN 'Kolkata' "
            f"WHEN lower(trim({c})) IN ('blr', 'bangalore', 'bengaluru') THEN 'Bengaluru' "
            f"ELSE {initcap_sql(f'trim({c})')} END")


def ts_sql(c: str = "timestamp") -> str:
    return (f"CASE WHEN {c} IS NULL OR trim({c}) = '' OR {c} = 'NaT' THEN NULL "
            f"WHEN {c} LIKE '%T%' THEN try_strptime(substr({c}, 1, 19), ['%Y-%m-%dT%H:%M:%S', '%Y-%m-%dT%H:%M', '%Y-%m-%dT%H']) "
            f"WHEN {c} LIKE '__-__-____ __:__%' THEN try_strptime(substr({c}, 1, 16), '%d-%m-%Y %H:%M') "
            f"ELSE NULL END")


CLEAN_SELECT = f"""SELECT DISTINCT
    order_id,
    coalesce(user_id, '-1') AS user_id,
    product_id,
    trim(product_name) AS product_name,
    {initcap_sql('trim(category)')} AS category,
    CAST(abs(price) AS BIGINT) AS price,
    CAST(abs(quantity) AS BIGINT) AS quantity,
    lower(trim(event_type)) AS event_type,
    {ts_sql('timestamp')} AS event_timestamp,
    upper(trim(payment_method)) AS payment_method,
    {city_sql('city')} AS city,
    CAST(abs(price) AS BIGINT) * CAST(abs(quantity) AS BIGINT) AS revenue
  FROM raw_data
  WHERE order_id IS NOT NULL AND product_id IS NOT NULL AND product_name IS NOT NULL
    AND category IS NOT NULL AND price IS NOT NULL AND quantity IS NOT NULL
    AND payment_method IS NOT NULL AND price > 0 AND quantity > 0
    AND price <= 80000 AND quantity <= 10
    AND lower(trim(event_type)) IN {EVENT_TYPES}"""


def with_raw(body: str, extra_ctes: str = "") -> str:
    """``WITH <fixture>, [extra] <body>``."""
    extra = (", " + extra_ctes) if extra_ctes else ""
    return f"WITH {raw_fixture_ctes('events')}{extra}\n{body}"


def with_clean(body: str, extra_ctes: str = "") -> str:
    extra = f"cleaned_data AS ({CLEAN_SELECT})" + ((", " + extra_ctes) if extra_ctes else "")
    return with_raw(body, extra)
