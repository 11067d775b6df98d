"""Column rules: ``f(Column) -> Column``, all built-in JVM expressions.

Nothing here leaves whole-stage codegen; no Python UDFs.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from quarry import schemas as S


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


# ---------------------------------------------------------------- text rules
def initcap_words(c) -> Column:
    """SQL-database INITCAP: a word is a run of letters/digits, any other
    character is a boundary (Spark's ``initcap`` splits on spaces only, so
    ``navi-MUMBAI`` would become ``Navi-mumbai``)."""
    parts = F.regexp_extract_all(_c(c), F.lit(r"([\p{L}\p{N}]+|[^\p{L}\p{N}]+)"), 1)
    return F.array_join(
        F.transform(parts, lambda w: F.concat(F.upper(F.substring(w, 1, 1)), F.lower(F.substring(w, 2, 1 << 30)))),
        "")


def default_user_id(c="user_id") -> Column:
    return F.coalesce(_c(c), F.lit(S.MISSING_USER))


def trim_product_name(c="product_name") -> Column:
    return F.trim(_c(c))


def normalize_category(c="category") -> Column:
    return initcap_words(F.trim(_c(c)))


def normalize_event_type(c="event_type") -> Column:
    return F.lower(F.trim(_c(c)))


def normalize_payment(c="payment_method") -> Column:
    return F.upper(F.trim(_c(c)))


def standardize_city(c="city") -> Column:
    """CASE chain of the cleaning step: missing/``null``/``?`` -> Others,
    alias lists -> canonical name, anything else INITCAP(TRIM())."""
    col = _c(c)
    key = F.lower(F.trim(col))
    expr = F.when(col.isNull() | (F.trim(col) == "") | (key == "null"), F.lit(S.OTHER_CITY))
    expr = expr.when(col.contains("?"), F.lit(S.OTHER_CITY))
    for canonical, aliases in S.CITY_ALIASES:
        expr = expr.when(key.isin(aliases), F.lit(canonical))
    return expr.otherwise(initcap_words(F.trim(col)))


# ------------------------------------------------------------- number rules
def round_half_even_bigint(c) -> Column:
    """``ABS(x)::BIGINT`` of a SQL database: double -> bigint rounds half to
    even (2.5 -> 2, 3.5 -> 4); Spark's cast would truncate."""
    return F.rint(F.abs(_c(c).cast("double"))).cast("bigint")


def clean_price(c="price") -> Column:
    return round_half_even_bigint(c)


def clean_quantity(c="quantity") -> Column:
    return F.abs(_c(c)).cast("bigint")


def compute_revenue(price="price", quantity="quantity") -> Column:
    return clean_price(price) * clean_quantity(quantity)


# ---------------------------------------------------------- timestamp rules
ISO_HOUR = r"^\d{4}-\d{2}-\d{2}T\d{2}$"
ISO_MINUTE = r"^\d{4}-\d{2}-\d{2}T\d{2}:\d{2}$"
ISO_SHAPE = r"^\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2}$"
DMY_SHAPE = r"^\d{2}-\d{2}-\d{4} \d{2}:\d{2}$"


def _ntz(text: Column, shape: str, y, mo, d, h, mi, sec=None) -> Column:
    """Zone-free timestamp from fixed-position digit fields; null when the
    text does not have the shape or the date/time is invalid (month 13)."""
    part = lambda pos, ln: F.substring(text, pos, ln).cast("int")
    seconds = part(*sec).cast("decimal(8,6)") if sec else F.lit(0).cast("decimal(8,6)")
    return F.when(text.rlike(shape), F.try_make_timestamp_ntz(
        part(*y), part(*mo), part(*d), part(*h), part(*mi), seconds))


def parse_event_timestamp(c="timestamp") -> Column:
    """Two accepted text formats, in order: anything containing ``T`` is read
    as ``yyyy-MM-ddTHH:mm:ss`` from its first 19 characters, missing seconds or
    minutes being 0; text shaped
    ``dd-mm-yyyy hh:mi...`` as ``dd-MM-yyyy HH:mm`` from its first 16.  Blank,
    ``NaT`` and everything else is null.  Epoch-0 and future times survive.
    The result is a TIMESTAMP_NTZ built from the digits, so the session time
    zone (and its DST gaps) never shifts a value."""
    col = _c(c)
    text = F.substring(col, 1, 19)
    text = (F.when(text.rlike(ISO_HOUR), F.concat(text, F.lit(":00:00"))).when(text.rlike(ISO_MINUTE), F.concat(text, F.lit(":00")))
            .otherwise(text))
    iso = _ntz(text, ISO_SHAPE, (1, 4), (6, 2), (9, 2), (12, 2), (15, 2), (18, 2))
    dmy = _ntz(F.substring(col, 1, 16), DMY_SHAPE, (7, 4), (4, 2), (1, 2), (12, 2), (15, 2))
    return (F.when(col.isNull() | (F.trim(col) == "") | (col == "NaT"), F.lit(None).cast("timestamp_ntz"))
            .when(col.like("%T%"), iso)
            .when(col.like("__-__-____ __:__%"), dmy)
            .otherwise(F.lit(None).cast("timestamp_ntz")))


# ----------------------------------------------------------- ingest repairs
NUMERIC_TEXT = r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$"


def parse_price(c="price") -> Column:
    """Text price -> double: remove every `` INR``, strip, parse; text that
    is not a plain number (``abc``, ``1d``) -> null."""
    s = F.trim(F.replace(_c(c).cast("string"), F.lit(" INR"), F.lit("")))
    return F.when(s.rlike(NUMERIC_TEXT), s.try_cast("double"))


def resolve_product_id(product_id="product_id", prod_id="prod_id") -> Column:
    """``a or b``: the legacy key is used when the new one is absent, null or 0."""
    return F.coalesce(F.nullif(_c(product_id), F.lit(0)), _c(prod_id))


# ----------------------------------------------------------- anomaly inputs
def coerce_price(c="price", dtype: str = "double") -> Column:
    """Feature price: numeric, invalid or missing -> 0.  A text price first
    loses every character other than digits, ``.`` and ``-``.  Never turn a
    double into text first (8.0E7 would become 8.07)."""
    col = _c(c)
    if dtype == "string":
        col = F.regexp_replace(col, r"[^0-9.\-]", "").try_cast("double")
    return F.coalesce(F.nanvl(col.cast("double"), F.lit(0.0)), F.lit(0.0))


def coerce_quantity(c="quantity") -> Column:
    return F.coalesce(_c(c).try_cast("double"), F.lit(0.0))


def fill_unknown(c) -> Column:
    return F.coalesce(_c(c), F.lit(S.UNKNOWN))
