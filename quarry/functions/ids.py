"""Unique row ids for any source, from an allocator of id ranges.

A source with offsets gets its ids from topic, partition and offset: each
topic's partition takes a stretch as long as its offsets in the frame, and a row
stands in it where its offset does, so a frame that is read again gets the same
ids however it is partitioned.  Other frames are numbered through, partition
after partition: a row's id is the number of rows in the partitions before, plus
its position.  Ids come one after another, so their only bound is a 64-bit
number's; batch ids, partitions and offsets take no bits of it.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

OFFSET_COLUMNS = ("partition", "offset")


def assign_ids(df: DataFrame, allocate: Callable[[int], int]) -> DataFrame:
    """``df`` with a column ``id``; ``allocate(n)`` gives the first of n fresh
    ids.  The driver sees one row per topic and partition, or one per Spark
    partition."""
    return _by_offset(df, allocate) if set(OFFSET_COLUMNS) <= set(df.columns) else _by_position(df, allocate)


def _by_offset(df: DataFrame, allocate: Callable[[int], int]) -> DataFrame:
    keys = [c for c in ("topic", "partition") if c in df.columns]
    spans = (df.groupBy(*keys).agg(F.min("offset").alias("_low"), F.max("offset").alias("_high"),
                                   F.sum(F.col("offset").isNull().cast("long")).alias("_without")).collect())
    if any(r["_without"] for r in spans):  # columns of these names, but no offsets
        return _by_position(df, allocate)
    spans.sort(key=lambda r: tuple((r[k] is not None, r[k]) for k in keys))
    at = allocate(sum(r["_high"] - r["_low"] + 1 for r in spans))
    rows = []
    for r in spans:
        rows.append((*(r[k] for k in keys), at - r["_low"]))
        at += r["_high"] - r["_low"] + 1
    types = dict(df.select(*keys).dtypes)
    table = df.sparkSession.createDataFrame(rows, ", ".join(f"_{k} {types[k]}" for k in keys) + ", _shift long")
    same = F.lit(True)
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col(f"_{k}"))
    return df.join(F.broadcast(table), same).withColumn("id", F.col("_shift") + F.col("offset")).drop("_shift", *(f"_{k}" for k in keys))


def _by_position(df: DataFrame, allocate: Callable[[int], int]) -> DataFrame:
    placed = df.select("*", F.spark_partition_id().alias("_pid"), position().alias("_pos"))
    sizes = df.select(F.spark_partition_id().alias("_pid")).groupBy("_pid").count()
    return with_starts(placed, sizes, allocate).withColumn("id", F.col("_start") + F.col("_pos")).drop("_pid", "_pos", "_start")


def position() -> Column:
    """A row's position in its Spark partition."""
    return F.monotonically_increasing_id() - F.shiftleft(F.spark_partition_id().cast("long"), 33)


def with_starts(placed: DataFrame, sizes: DataFrame, allocate: Callable[[int], int] = lambda n: 0) -> DataFrame:
    """Add ``_start``: the number of the first row of a row's partition
    (``_pid``), from ``sizes`` (_pid, count).  The starts are a small table, one
    row per partition, that is joined; a plan does not grow with it."""
    rows, each = [], sorted(sizes.select("_pid", "count").collect())
    start = allocate(sum(r["count"] for r in each))
    for r in each:
        rows.append((r["_pid"], start))
        start += r["count"]
    return placed.join(F.broadcast(placed.sparkSession.createDataFrame(rows, "_pid int, _start long")), "_pid")
