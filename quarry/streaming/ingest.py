"""Structured Streaming ingest: event stream -> ``raw_data`` (+ quarantine).

    readStream (Kafka topics, a folder of JSON-lines files, or any other stream
    with a text ``value``)
      -> decode_events (same projection as batch)
      -> foreachBatch: good rows -> raw table, bad rows -> quarantine table

Exactly-once: ``foreachBatch`` may replay a micro-batch after a failure.  Both
tables' logs name the batches that they cover, in the same version that adds
their rows, so a replay adds nothing; a batch that broke off before that keeps
the ids that were reserved for it.  Batches are known by the id that the
checkpoint gives its query, so several streams can feed one table.  Offsets are
committed through the checkpoint folder, so a restart resumes where it stopped
(the reference re-read the whole topic on every restart).  Small batches are
compacted as they come (``TableLog.compact``): the number of folders grows with
the logarithm of the number of batches.
"""

from __future__ import annotations

import json
import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from quarry import schemas as S
from quarry.functions.ids import assign_ids
from quarry.sources import events as EV
from quarry.sources import tables as TB
from quarry.sources.tablelog import FAN_IN, KEEP_SECONDS, Files, TableLog

#: What the landing table holds: the raw columns, and where a row came from.
LANDED = T.StructType(S.RAW.fields + TB.SOURCE.fields)
REJECTED = T.StructType([T.StructField("id", T.LongType()), T.StructField("bad_reason", T.StringType()),
                         T.StructField("value", T.StringType())] + TB.SOURCE.fields)


def read_event_stream(spark: SparkSession, source: str = "files", path: str | None = None,
                      topic: str | None = None, bootstrap_servers: str | None = None,
                      max_files_per_trigger: int | None = None, max_offsets_per_trigger: int | None = None,
                      starting_offsets: str = "earliest", **options) -> DataFrame:
    """Streaming DataFrame with a text ``value`` column, plus ``topic``,
    ``partition`` and ``offset`` for Kafka (``topic`` may name several,
    separated by commas).  Kafka needs its connector jar on the classpath; the
    file source is the offline stand-in."""
    if source == "kafka":
        if not topic:
            raise ValueError("the kafka source needs a topic")
        r = (spark.readStream.format("kafka")
             .option("kafka.bootstrap.servers", bootstrap_servers)
             .option("subscribe", topic).option("startingOffsets", starting_offsets))
        if max_offsets_per_trigger:
            r = r.option("maxOffsetsPerTrigger", max_offsets_per_trigger)
        df = r.options(**options).load()
        return source_columns(df)
    if source == "files":
        r = spark.readStream.format("text")
        if max_files_per_trigger:
            r = r.option("maxFilesPerTrigger", max_files_per_trigger)
        return r.options(**options).load(path)
    raise ValueError(f"unknown source {source!r}")


def source_columns(df: DataFrame) -> DataFrame:
    """The columns of a stream that the job uses: ``value`` as text, and those
    of topic, partition and offset that there are."""
    return df.select(F.col("value").cast("string").alias("value"), *[c for c in ("topic", "partition", "offset") if c in df.columns])


def surrogate_id(df: DataFrame, allocate: Callable[[int], int] | None = None) -> DataFrame:
    """Add a unique bigint ``id`` (see ``functions.ids``); ``allocate(n)`` gives
    the first of n fresh ids, by default 0: ids unique within the frame."""
    return assign_ids(df, allocate or (lambda n: 0))


def write_batch(batch: DataFrame, batch_id: int, raw_path: str, quarantine_path: str, writer: str = "ingest",
                fan_in: int = FAN_IN, keep_seconds: float = KEEP_SECONDS) -> bool:
    """One micro-batch: decode, split, add both sides to their tables.  False,
    and no change, if the raw table covers the batch already."""
    spark = batch.sparkSession
    raw, rejected = TableLog(spark, raw_path), TableLog(spark, quarantine_path)
    if raw.covers(writer, batch_id):
        return False
    numbered = surrogate_id(source_columns(batch), lambda n: raw.reserve(n, writer, batch_id)[0])
    decoded = EV.decode_events(numbered).withColumn("batch_id", F.lit(batch_id)).persist()
    try:
        good, bad = EV.quarantine_bad_rows(decoded)
        rejected.append(TB.typed(bad, REJECTED), writer, batch_id, keep_seconds)
        raw.append(TB.typed(good, LANDED), writer, batch_id, keep_seconds)  # last: the batch is done with this version
    finally:
        decoded.unpersist()
    for log in (raw, rejected):
        log.compact(fan_in, keep_seconds)
    return True


def _query_id(spark: SparkSession, checkpoint_path: str) -> str:
    """The id that a checkpoint gives its query, the same after every restart."""
    return json.loads(Files(spark, checkpoint_path).read(f"{checkpoint_path}/metadata"))["id"]


def start_ingest(stream: DataFrame, raw_path: str, quarantine_path: str, checkpoint_path: str,
                 available_now: bool = True, processing_time: str | None = None,
                 query_name: str | None = None) -> StreamingQuery:
    """Start the ingest query over any stream with a ``value`` column.
    ``available_now`` drains what is there and stops; otherwise it triggers
    every ``processing_time``."""
    def land(batch: DataFrame, batch_id: int) -> None:
        write_batch(batch, batch_id, raw_path, quarantine_path, _query_id(batch.sparkSession, checkpoint_path))

    w = stream.writeStream.option("checkpointLocation", checkpoint_path).foreachBatch(land)
    if query_name:
        w = w.queryName(query_name)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime=processing_time or "5 seconds")
    return w.start()


def ingest_stream(stream: DataFrame, raw_path: str, quarantine_path: str, checkpoint_path: str) -> None:
    """Drain a stream into the raw table and wait; a failed query raises."""
    q = start_ingest(stream, raw_path, quarantine_path, checkpoint_path, available_now=True)
    q.awaitTermination()
    if q.exception() is not None:
        raise RuntimeError(str(q.exception()))


def ingest_available(spark: SparkSession, source_path: str, raw_path: str, quarantine_path: str,
                     checkpoint_path: str, max_files_per_trigger: int | None = None) -> None:
    """Drain a folder of JSON-lines files into the raw table and wait."""
    stream = read_event_stream(spark, "files", source_path, max_files_per_trigger=max_files_per_trigger)
    ingest_stream(stream, raw_path, quarantine_path, checkpoint_path)


def read_raw(spark: SparkSession, raw_path: str) -> DataFrame:
    """The ingested landing table without the columns that tell its source."""
    return TB.scan(spark, raw_path).select(*S.RAW_COLS)


def write_feed_files(feed: DataFrame, path: str, files: int | None = None) -> None:
    """Write JSON lines (``value``) as text files; ``files`` ranges them by id
    into that many files (used to drive several micro-batches)."""
    df = feed.repartitionByRange(files, "id") if files else feed
    df.select("value").write.mode("overwrite").text(path)


def ingest_then_clean(spark: SparkSession, source: str | DataFrame, out_dir: str,
                      max_files_per_trigger: int | None = None, **kafka) -> DataFrame:
    """After the ingest drains, rebuild ``cleaned_data`` and return a scan of it
    (the reference reported its row count).

    ``source`` is a folder of JSON-lines files, any streaming frame with a
    ``value`` column, or, with ``bootstrap_servers`` (and other options of
    ``read_event_stream``), the Kafka topics to read."""
    from quarry.plans.jobs import clean_to_table

    if isinstance(source, DataFrame):
        stream = source
    elif kafka:
        stream = read_event_stream(spark, "kafka", topic=source, **kafka)
    else:
        stream = read_event_stream(spark, "files", source, max_files_per_trigger=max_files_per_trigger)
    raw_path = os.path.join(out_dir, "raw_data")
    ingest_stream(stream, raw_path, os.path.join(out_dir, "quarantine"), os.path.join(out_dir, "_checkpoints", "ingest"))
    return clean_to_table(spark, read_raw(spark, raw_path), out_dir)
