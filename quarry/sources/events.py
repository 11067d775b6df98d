"""JSON event encoding/decoding, shared by batch and streaming ingest.

Decoding reads every key as text (missing keys -> null, extra keys ignored,
an int or a UUID ``user_id`` both read as text), repairs the two drifting
fields (legacy ``prod_id``; ``"N INR"`` prices) and marks rows the landing
table could not hold.  Those rows go to quarantine one by one; good rows of
the same batch are kept.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarry import schemas as S
from quarry.functions import columns as C

CORRUPT = "_corrupt_record"
_DECODE_SCHEMA = T.StructType(S.EVENT_JSON.fields + [T.StructField(CORRUPT, T.StringType())])
INT_TEXT = r"^\s*[+-]?\d+(\.0*)?\s*$"  # 12.0 is the integer 12 to a database
# landing-table text widths (the reference's VARCHAR sizes)
TEXT_WIDTH = {"user_id": 50, "product_name": 100, "category": 50, "event_type": 50, "timestamp": 50,
              "payment_method": 50, "city": 50}


def encode_events(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """Row -> one JSON text per row in ``value`` (null fields are omitted)."""
    cols = cols or df.columns
    return df.select(F.to_json(F.struct(*cols)).alias("value"))


def _int_field(text: Column) -> Column:
    return F.when(text.rlike(INT_TEXT), F.regexp_replace(F.trim(text), r"\.0*$", "").try_cast("int"))


def decode_events(df: DataFrame, value_col: str = "value") -> DataFrame:
    """JSON text -> the 11 landing columns + ``bad_reason`` (null = good).

    ``bad_reason`` is set for: a line that is not a JSON object; an integer
    field whose text is not an integer (``12`` or ``12.0``) in range; a text longer than its
    landing-table column.  An unparseable price is *not* bad: it becomes null.
    """
    v = F.col(value_col).cast("string")
    d = F.from_json(v, _DECODE_SCHEMA, {"columnNameOfCorruptRecord": CORRUPT, "mode": "PERMISSIVE"})
    # explode(array(x)) yields x once through a Generate: filters on the decoded
    # fields (the quarantine split) are not pushed below it, so each line is
    # parsed once instead of once per referenced field
    parsed = df.select("*", F.explode(F.array(d)).alias("_d"))
    e = {f: F.col(f"_d.{f}") for f in S.EVENT_JSON_FIELDS}
    malformed = v.isNull() | (F.trim(v) == "") | F.col(f"_d.{CORRUPT}").isNotNull()
    # an empty, false or zero product_id counts as absent
    own = F.when(~F.trim(e["product_id"]).isin("", "false", "0", "0.0"), e["product_id"])
    pid = _int_field(F.coalesce(own, e["prod_id"], F.when(F.trim(e["product_id"]).isin("0", "0.0"), F.lit("0"))))
    typed = {
        "order_id": _int_field(e["order_id"]),
        "user_id": e["user_id"],
        "product_id": pid,
        "product_name": e["product_name"],
        "category": e["category"],
        "price": C.parse_price(e["price"]),
        "quantity": _int_field(e["quantity"]),
        "event_type": e["event_type"],
        "timestamp": e["timestamp"],
        "payment_method": e["payment_method"],
        "city": e["city"],
    }
    int_texts = {"order_id": e["order_id"], "quantity": e["quantity"],
                 "product_id": F.coalesce(own, e["prod_id"])}
    reason = F.when(malformed, F.lit("malformed json"))
    for f, text in int_texts.items():
        reason = reason.when(text.isNotNull() & _int_field(text).isNull(), F.lit(f"bad {f}"))
    reason = reason.when(F.abs(typed["price"]) == float("inf"), F.lit("bad price"))
    for f, width in TEXT_WIDTH.items():
        reason = reason.when(F.length(e[f]) > width, F.lit(f"{f} too long"))
    keep = [c for c in df.columns if c != value_col]
    return parsed.select(*keep, *[typed[c].alias(c) for c in S.RAW_COLS if c != "id"],
                         reason.alias("bad_reason"), v.alias(value_col))


def quarantine_bad_rows(decoded: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(good rows without the marker, rejected rows with reason and text)."""
    good = decoded.where(F.col("bad_reason").isNull()).drop("bad_reason")
    bad = decoded.where(F.col("bad_reason").isNotNull())
    return good, bad


def project_known_fields(decoded: DataFrame) -> DataFrame:
    """Keep the 11 landing fields; drop tags such as ``_anomaly``."""
    return decoded.select(*[c for c in S.RAW_COLS if c != "id" and c in decoded.columns])


def event_feed(raw: DataFrame) -> DataFrame:
    """JSON lines carrying ``raw_data`` rows with the drift the event
    generator produces, keyed by row id (deterministic per id):

    * id % 211 = 7            -> truncated, unparseable line
    * id % 25 = 13            -> legacy key ``prod_id`` instead of ``product_id``
    * id % 50 = 21 or 89 = 5  -> price sent as text ``"<p> INR"``; for
      id % 89 = 5 the quantity is the text ``"many"`` (rejected at ingest)
    * id % 50 = 33            -> extra ``session_id`` and ``_anomaly`` keys
    """
    i = F.col("id")
    base = {c: F.col(c) for c in S.RAW_COLS if c != "id"}
    extra_sid = F.when(i % 50 == 33, F.concat(F.lit("s-"), i.cast("string")))
    extra_tag = F.when(i % 50 == 33, F.lit("schema_extra"))

    def js(fields: dict) -> Column:
        return F.to_json(F.struct(*[e.alias(k) for k, e in fields.items()]))

    normal = dict(base, session_id=extra_sid, _anomaly=extra_tag)
    legacy = {("prod_id" if k == "product_id" else k): e for k, e in base.items()}
    legacy["_anomaly"] = F.lit("schema_v1_legacy")
    text = dict(base)
    text["price"] = F.concat(F.col("price").cast("string"), F.lit(" INR"))
    text["quantity"] = F.when(i % 89 == 5, F.lit("many")).otherwise(F.col("quantity").cast("string"))
    value = (F.when(i % 211 == 7, F.concat(F.lit('{"order_id": '), i.cast("string"), F.lit(', "price": ')))
             .when(i % 25 == 13, js(legacy))
             .when((i % 50 == 21) | (i % 89 == 5), js(text))
             .otherwise(js(normal)))
    return raw.select(i.alias("id"), value.alias("value"))


def write_events(df: DataFrame, target: str, fmt: str = "text", topic: str | None = None,
                 bootstrap_servers: str | None = None, mode: str = "append") -> None:
    """Publish rows as JSON events: one line per row into text files at
    ``target``, or messages on a Kafka ``topic`` (needs the Kafka connector
    on the classpath).  Works for batch frames; use ``writeStream`` with the
    same ``encode_events`` projection for streams."""
    encoded = encode_events(df)
    if fmt == "text":
        encoded.write.mode(mode).text(target)
    elif fmt == "kafka":
        (encoded.write.format("kafka").option("kafka.bootstrap.servers", bootstrap_servers)
         .option("topic", topic or target).save())
    else:
        raise ValueError(f"unknown event sink {fmt!r}")
