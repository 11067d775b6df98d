"""Event decoding golden lines, quarantine, and streaming ingest replay."""
import json

import pytest
from pyspark.sql import functions as F

from quarry.__main__ import main
from quarry.operators import clean as CL
from quarry.session import scratch_path
from quarry.sources import events as EV
from quarry.sources import tables as TB
from quarry.sources.fixture import raw_data
from quarry.sources.tablelog import TableLog
from quarry.streaming import ingest as IN

from conftest import SF_SMALL

GOLDEN = [
    '{"order_id":2001,"user_id":7,"product_id":5,"product_name":" Product_5 ","category":"HealthCare","price":1500,'
    '"quantity":2,"event_type":"purchase","timestamp":"2026-05-13T16:54:05.046763","payment_method":"UPI","city":"DELHI"}',
    '{"order_id":2002,"user_id":"3f2b8c1e-0000-4000-8000-000000000001","prod_id":6,"product_name":"Prod-6",'
    '"category":"gold","price":"700 INR","quantity":1,"event_type":"view","timestamp":"13-05-2026 17:14",'
    '"payment_method":"Card","city":"BLR"}',
    '{"order_id":2003,"user_id":8,"product_id":0,"prod_id":9,"product_name":"Prod-9","category":"Home",'
    '"price":80000000,"quantity":1,"event_type":"BUY","timestamp":"NaT","city":"???"}',
    '{"order_id":2004,"user_id":9001,"product_id":4,"product_name":null,"category":null,"price":null,"quantity":0,'
    '"event_type":"view","timestamp":"1970-01-01T00:00:00","payment_method":null,"city":null,"_anomaly":"bot_traffic"}',
    '{"order_id":2005,"user_id":9,"product_id":4,"product_name":"Prod-4","category":"Home","price":"abc",'
    '"quantity":"many","event_type":"view","timestamp":null,"payment_method":"COD","city":"Mumbai"}',
    '{broken',
]


def test_golden_lines(spark):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(GOLDEN)], "id long, value string")
    rows = {r.id: r for r in EV.decode_events(df).collect()}
    assert rows[0].price == 1500.0 and rows[0].quantity == 2 and rows[0].user_id == "7" and rows[0].bad_reason is None
    assert rows[1].product_id == 6 and rows[1].price == 700.0 and rows[1].user_id.startswith("3f2b8c1e")
    assert rows[2].product_id == 9 and rows[2].price == 8.0e7 and rows[2].payment_method is None
    assert rows[3].bad_reason is None and rows[3].price is None and rows[3].city is None
    assert rows[4].bad_reason == "bad quantity"
    assert rows[5].bad_reason == "malformed json"
    good, bad = EV.quarantine_bad_rows(EV.decode_events(df))
    assert good.count() == 4 and bad.count() == 2
    assert "bad_reason" not in good.columns and "_anomaly" not in good.columns


def test_integral_decimals_are_integers(spark):
    lines = [f'{{"order_id":{v},"product_id":3.0,"quantity":"2.0"}}' for v in ("12.0", "1e3", "12.5", '"1e3"', "3000000000.0", "-7.00")]
    df = spark.createDataFrame(list(enumerate(lines)), "id long, value string")
    got = [(r.order_id, r.product_id, r.quantity, r.bad_reason) for r in EV.decode_events(df).orderBy("id").collect()]
    bad = (None, 3, 2, "bad order_id")
    assert got[:2] == [(12, 3, 2, None), (1000, 3, 2, None)] and got[5] == (-7, 3, 2, None) and got[2:5] == [bad, bad, bad]


def test_encode_decode_round_trip(spark):
    raw = raw_data(spark, SF_SMALL)
    enc = EV.encode_events(raw.drop("id"))
    v = json.loads(enc.first().value)
    assert "order_id" in v
    good, bad = EV.quarantine_bad_rows(EV.decode_events(enc))
    assert bad.count() == 0
    cols = [c for c in raw.columns if c != "id"]
    assert good.select(*cols).exceptAll(raw.select(*cols)).count() == 0
    assert raw.select(*cols).exceptAll(good.select(*cols)).count() == 0


def test_streaming_replay_and_batches(spark):
    src = scratch_path(spark, "feed")
    IN.write_feed_files(EV.event_feed(raw_data(spark, SF_SMALL)), src, files=3)
    base = scratch_path(spark, "ingest")
    raw_p, bad_p, ck = (base + "/" + x for x in ("raw", "bad", "ck"))
    IN.ingest_available(spark, src, raw_p, bad_p, ck, max_files_per_trigger=1)
    first = TB.scan(spark, raw_p)
    n1 = first.count()
    assert first.select("batch_id").distinct().count() == 3
    assert first.select("id").distinct().count() == n1
    # same checkpoint again: nothing new, nothing duplicated
    IN.ingest_available(spark, src, raw_p, bad_p, ck, max_files_per_trigger=1)
    assert TB.scan(spark, raw_p).count() == n1
    # a replayed micro-batch adds its rows once
    one_file = spark.read.text(src).select(F.input_file_name().alias("f")).first().f
    extra = spark.read.text(one_file)
    assert IN.write_batch(extra, 99, raw_p, bad_p) is True
    n2 = TB.scan(spark, raw_p).count()
    assert IN.write_batch(extra, 99, raw_p, bad_p) is False
    assert TB.scan(spark, raw_p).count() == n2 > n1
    assert TB.scan(spark, raw_p).where("batch_id < 99").count() == n1
    q = TB.scan(spark, bad_p)
    assert q.where(F.col("bad_reason").isNull()).count() == 0
    assert n1 + q.where("batch_id < 99").count() == raw_data(spark, SF_SMALL).count()
    every = TB.scan(spark, raw_p).select("id").unionAll(q.select("id"))
    assert every.distinct().count() == every.count()


def test_a_new_checkpoint_is_another_writer(spark):
    """Two queries count their batches from 0; neither hides the other's."""
    src, base = scratch_path(spark, "feed"), scratch_path(spark, "ingest")
    IN.write_feed_files(EV.event_feed(raw_data(spark, SF_SMALL)), src)
    n = 0
    for ck in ("/ck1", "/ck2"):
        IN.ingest_available(spark, src, base + "/raw", base + "/bad", base + ck)
        rows = TB.scan(spark, base + "/raw")
        assert rows.count() == rows.select("id").distinct().count() > n
        n = rows.count()
    assert rows.groupBy("order_id", "batch_id").count().where("count % 2 = 1").count() == 0


def test_a_batch_that_broke_off_gets_its_ids_again(spark, monkeypatch):
    base = scratch_path(spark, "broken")
    batch = EV.event_feed(raw_data(spark, SF_SMALL)).select("value")
    whole = TableLog.append

    def fails_for_raw(self, *args, **kw):
        if self.table.endswith("/raw"):
            raise OSError("lost")
        return whole(self, *args, **kw)

    monkeypatch.setattr(TableLog, "append", fails_for_raw)
    with pytest.raises(OSError):
        IN.write_batch(batch, 0, base + "/raw", base + "/bad")
    monkeypatch.setattr(TableLog, "append", whole)
    bad = sorted(r.id for r in TB.scan(spark, base + "/bad").collect())
    assert IN.write_batch(batch, 0, base + "/raw", base + "/bad")
    assert sorted(r.id for r in TB.scan(spark, base + "/bad").collect()) == bad
    good = {r.id for r in TB.scan(spark, base + "/raw").collect()}
    assert len(good) + len(bad) == batch.count() and not good & set(bad)
    assert TableLog(spark, base + "/raw").state()["pending"] == {}


def test_write_events_then_ingest(spark):
    raw = raw_data(spark, SF_SMALL)
    cols = [c for c in raw.columns if c != "id"]
    src = scratch_path(spark, "published")
    EV.write_events(raw.select(*cols), src)
    base = scratch_path(spark, "ingest-published")
    IN.ingest_available(spark, src, base + "/raw", base + "/bad", base + "/ck")
    got = IN.read_raw(spark, base + "/raw").select(*cols)
    assert got.exceptAll(raw.select(*cols)).count() == 0 and raw.select(*cols).exceptAll(got).count() == 0


def kafka_frame(spark):
    """Rows of two topics in the columns of Kafka's source, offsets beyond 2^40."""
    lines = EV.encode_events(raw_data(spark, SF_SMALL).drop("id"))
    n = F.monotonically_increasing_id()
    return lines.select(F.lit(None).cast("binary").alias("key"), F.col("value").cast("binary").alias("value"),
                        F.concat(F.lit("t"), (n % 2).cast("string")).alias("topic"), (n % 3).cast("int").alias("partition"),
                        (n + (1 << 41)).alias("offset"), F.current_timestamp().alias("timestamp"), F.lit(0).alias("timestampType"))


def test_kafka_shaped_ids(spark):
    """Ids follow the source position, whatever the partitioning; two topics
    with the same partitions and offsets do not meet; no batch id is too large."""
    frame = IN.source_columns(kafka_frame(spark))
    both = frame.unionAll(frame.withColumn("topic", F.concat("topic", F.lit("x"))))
    first = {(r.topic, r.partition, r.offset): r.id for r in IN.surrogate_id(both).collect()}
    again = {(r.topic, r.partition, r.offset): r.id for r in IN.surrogate_id(both.repartition(7)).collect()}
    assert first == again and len(set(first.values())) == both.count() == len(first)
    base = scratch_path(spark, "kafka-shaped")
    for batch_id in ((1 << 23) + 5, (1 << 23) + 6):
        part = "offset % 2 = 0" if batch_id % 2 else "offset % 2 = 1"
        assert IN.write_batch(frame.where(part), batch_id, base + "/raw", base + "/bad")
    rows = TB.scan(spark, base + "/raw")
    assert rows.count() == frame.count() == rows.select("id").distinct().count()
    assert rows.select("topic", "partition", "offset").exceptAll(frame.select("topic", "partition", "offset")).count() == 0


def test_kafka_shaped_stream_through_the_job(spark):
    """A stream with the columns of Kafka's source, landed and cleaned."""
    src, out = scratch_path(spark, "kafka-files"), scratch_path(spark, "kafka-out")
    frame = kafka_frame(spark)
    frame.repartition(3).write.parquet(src)
    stream = spark.readStream.schema(frame.schema).option("maxFilesPerTrigger", 1).parquet(src)
    cleaned = IN.ingest_then_clean(spark, stream, out)
    raw = raw_data(spark, SF_SMALL)
    expected = CL.clean_events(raw)
    assert cleaned.exceptAll(expected).count() == 0 and expected.exceptAll(cleaned).count() == 0
    landed = TB.scan(spark, out + "/raw_data")
    assert {r.topic for r in landed.select("topic").distinct().collect()} == {"t0", "t1"}
    assert landed.select("id").distinct().count() == raw.count()


def test_kafka_options_reach_the_reader(spark, monkeypatch):
    seen = {}

    def reader(spark, source, **options):
        seen.update(source=source, **options)
        raise KeyError("no broker here")

    monkeypatch.setattr(IN, "read_event_stream", reader)
    with pytest.raises(KeyError):
        main(["ingest", "--kafka", "host:1", "--source", "a,b", "--out", "/tmp/none", "--max-offsets", "7", "--option", "failOnDataLoss=false"])
    assert seen == {"source": "kafka", "topic": "a,b", "bootstrap_servers": "host:1", "max_offsets_per_trigger": 7,
                    "starting_offsets": "earliest", "failOnDataLoss": "false"}
