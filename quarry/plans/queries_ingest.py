"""Ingest queries.

The event feed is derived from ``raw_data`` with the generator's drift
(sources.events.event_feed); decoding must give back the raw rows except the
ones it has to quarantine, which the oracle predicts from the same id rules.
"""

from __future__ import annotations

import os

from pyspark.sql import functions as F

from quarry import schemas as S
from quarry.plans.oracle import CLEAN_SELECT, with_raw
from quarry.plans.registry import register
from quarry.session import scratch_path
from quarry.sources import events as EV
from quarry.sources import tables as TB
from quarry.sources.fixture import raw_data
from quarry.sources.tablelog import TableLog
from quarry.streaming import ingest as IN

BAD_SQL = "(id % 211 = 7 OR (id % 25 <> 13 AND id % 89 = 5))"
FIELDS = [c for c in S.RAW_COLS if c != "id"]
GOOD_RAW = f"SELECT {', '.join(FIELDS)} FROM raw_data WHERE NOT {BAD_SQL}"


def _decoded(spark, sf):
    return EV.decode_events(EV.event_feed(raw_data(spark, sf)))


def _good(spark, sf):
    good, _ = EV.quarantine_bad_rows(_decoded(spark, sf))
    return good


_TYPED = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in S.RAW.fields)


@register("encode_events", with_raw(f"SELECT {', '.join(S.RAW_COLS)} FROM raw_data"))
def q_encode_events(spark, sf):
    """The events as JSON text, read with Spark's own reader."""
    encoded = EV.encode_events(raw_data(spark, sf).select(*S.RAW_COLS))
    return encoded.select(F.from_json("value", _TYPED).alias("e")).select("e.*")


@register("decode_events", with_raw(GOOD_RAW))
def q_decode_events(spark, sf):
    return _good(spark, sf).select(*FIELDS)


@register("project_known_fields", with_raw(GOOD_RAW))
def q_project_known_fields(spark, sf):
    return EV.project_known_fields(_good(spark, sf))


@register("resolve_product_id", with_raw(f"SELECT order_id, product_id FROM raw_data WHERE NOT {BAD_SQL}"))
def q_resolve_product_id(spark, sf):
    return _good(spark, sf).select("order_id", "product_id")


@register("parse_price", with_raw(f"SELECT order_id, price FROM raw_data WHERE NOT {BAD_SQL}"))
def q_parse_price(spark, sf):
    return _good(spark, sf).select("order_id", "price")


@register("unify_user_id", with_raw(f"SELECT order_id, user_id FROM raw_data WHERE NOT {BAD_SQL}"))
def q_unify_user_id(spark, sf):
    return _good(spark, sf).select("order_id", "user_id")


@register("quarantine_bad_rows", with_raw(
    "SELECT bad_reason, count(*) AS n FROM (SELECT CASE WHEN id % 211 = 7 THEN 'malformed json' "
    "ELSE 'bad quantity' END AS bad_reason FROM raw_data WHERE " + BAD_SQL + ") GROUP BY bad_reason"))
def q_quarantine_bad_rows(spark, sf):
    _, bad = EV.quarantine_bad_rows(_decoded(spark, sf))
    return bad.groupBy("bad_reason").agg(F.count(F.lit(1)).alias("n"))


def _feed_dir(spark, sf, files=None):
    path = scratch_path(spark, "feed")
    IN.write_feed_files(EV.event_feed(raw_data(spark, sf)), path, files)
    return path


@register("read_event_stream", with_raw(GOOD_RAW))
def q_read_event_stream(spark, sf):
    """The lines that the stream delivers, decoded."""
    src = _feed_dir(spark, sf, files=3)
    out, ck = scratch_path(spark, "stream-out"), scratch_path(spark, "stream-ck")
    q = (IN.read_event_stream(spark, "files", src, max_files_per_trigger=1).writeStream.format("parquet")
         .option("path", out).option("checkpointLocation", ck).trigger(availableNow=True).start())
    q.awaitTermination()
    good, _ = EV.quarantine_bad_rows(EV.decode_events(spark.read.parquet(out)))
    return good.select(*FIELDS)


def _ingest(spark, sf, files=None, max_files=None, runs=1):
    src = _feed_dir(spark, sf, files)
    base = scratch_path(spark, "ingest")
    raw_p, bad_p, ck = (os.path.join(base, x) for x in ("raw_data", "quarantine", "_ck"))
    for _ in range(runs):  # a rerun on the same checkpoint must add nothing
        IN.ingest_available(spark, src, raw_p, bad_p, ck, max_files)
    return raw_p, bad_p


@register("append_raw", with_raw(GOOD_RAW))
def q_append_raw(spark, sf):
    """Decoded rows as two batches, each tried twice."""
    target, good = scratch_path(spark, "raw_data"), _good(spark, sf)
    for batch, rows in enumerate((good.where("id % 2 = 0"), good.where("id % 2 = 1"))):
        for _ in range(2):
            TB.append_raw(rows.drop("id", "value"), target, batch_id=batch)
    return TB.scan(spark, target).select(*FIELDS)


@register("micro_batch_commit", with_raw(f"SELECT 4 AS batches, 1 AS folders, count(*) AS rows, count(*) AS ids, "
                                         f"CAST(sum(quantity) AS BIGINT) AS quantity FROM raw_data WHERE NOT {BAD_SQL}"))
def q_micro_batch_commit(spark, sf):
    """Four micro-batches, one of them replayed, compacted into one folder."""
    src, base = _feed_dir(spark, sf, files=4), scratch_path(spark, "ingest")
    files = sorted(r.f for r in spark.read.text(src).select(F.input_file_name().alias("f")).distinct().collect())
    for batch in (0, 1, 2, 2, 3):
        IN.write_batch(spark.read.text(files[batch]), batch, base + "/raw", base + "/bad")
    log = TableLog(spark, base + "/raw")
    log.compact(fan_in=2)
    folders = len(log.state()["parts"])
    return log.scan().agg(F.count_distinct("batch_id").cast("int").alias("batches"), F.lit(folders).alias("folders"),
                          F.count(F.lit(1)).alias("rows"), F.count_distinct("id").alias("ids"), F.sum("quantity").alias("quantity"))


@register("surrogate_id", with_raw("SELECT count(*) AS rows, count(*) AS ids, CAST(0 AS BIGINT) AS nulls FROM raw_data"))
def q_surrogate_id(spark, sf):
    """The ids of all ingested rows, good and rejected."""
    raw_p, bad_p = _ingest(spark, sf, files=3, max_files=1)
    ids = TB.scan(spark, raw_p).select("id").unionAll(TB.scan(spark, bad_p).select("id"))
    return ids.agg(F.count(F.lit(1)).alias("rows"), F.count_distinct("id").alias("ids"), F.count_if(F.col("id").isNull()).alias("nulls"))


@register("ingest_then_clean", with_raw(
    CLEAN_SELECT.replace("FROM raw_data", "FROM ingested"),
    f"ingested AS (SELECT * FROM raw_data WHERE NOT {BAD_SQL})"))
def q_ingest_then_clean(spark, sf):
    src = _feed_dir(spark, sf)
    return IN.ingest_then_clean(spark, src, scratch_path(spark, "ingest-clean"))


@register("write_events", with_raw(f"SELECT {', '.join(FIELDS)} FROM raw_data"))
def q_write_events(spark, sf):
    """Publish raw rows as JSON events, ingest them with the stream, read back."""
    src = scratch_path(spark, "published")
    EV.write_events(raw_data(spark, sf).select(*FIELDS), src)
    base = scratch_path(spark, "ingest-published")
    IN.ingest_available(spark, src, base + "/raw", base + "/bad", base + "/ck")
    return IN.read_raw(spark, base + "/raw").select(*FIELDS)
