"""Rows that may share their key with another row, found without shuffling the
rows: a filter for queries that only want keys seen twice or more.

A key's 64-bit hash names one of 2^32 buckets in one of ``slices`` slices.
Tasks sort the buckets of their rows, a bounded number at a time, and pass each
on once, or twice if they met it twice: four bytes a row instead of the key,
and two entries for a key that a third of all rows have.  One task per slice
then sees which buckets were met twice.  A key in a bucket that was met once is
the only one of its kind, so dropping its row is exact; rows of different keys
in one bucket are kept in vain, which is rare.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.session import drop_scratch, materialize

ROWS_AT_A_TIME = 1 << 20  # hashes a task holds
BROADCAST_BUCKETS = 500_000  # 8 bytes each


def _at_most_twice(values: np.ndarray) -> np.ndarray:
    """Sorted values, each once, or twice if it occurs more often."""
    values = np.sort(values)
    third = np.zeros(len(values), bool)
    third[2:] = (values[2:] == values[1:-1]) & (values[1:-1] == values[:-2])
    return values[~third]


def repeated_buckets(df: DataFrame, keys: list[str], slice_bits: int = 10) -> DataFrame:
    """(bucket) of the keys of at least two rows, and few others."""
    shift = np.uint64(64 - slice_bits - 32)

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0

        def emit():
            buckets = _at_most_twice(np.concatenate(held) >> shift)
            which = (buckets >> np.uint64(32)).astype(np.int32)
            starts = np.flatnonzero(np.append(True, which[1:] != which[:-1]))
            parts = np.split(buckets.astype(np.uint32), starts[1:])
            return pa.RecordBatch.from_arrays([pa.array(which[starts]), pa.array([p.tobytes() for p in parts], pa.binary())], ["slice", "low"])

        for b in batches:
            held.append(b.column(0).to_numpy(zero_copy_only=False).view(np.uint64))
            n += len(held[-1])
            if n >= ROWS_AT_A_TIME:
                yield emit()
                held, n = [], 0
        if n:
            yield emit()

    def met_twice(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def emit(which, held):
            low = np.sort(np.concatenate(held))
            twice = np.unique(low[1:][low[1:] == low[:-1]]).astype(np.int64)
            return pa.RecordBatch.from_arrays([pa.array((which << 32) + twice, pa.int64())], ["bucket"])

        which, held = None, []
        for b in batches:
            for s, low in zip(b.column("slice").to_pylist(), b.column("low").to_pylist(), strict=True):
                if s != which and held:
                    yield emit(which, held)
                    held = []
                which = s
                held.append(np.frombuffer(low, np.uint32))
        if held:
            yield emit(which, held)

    slices = df.select(F.xxhash64(*keys).alias("h")).mapInArrow(packed, "slice int, low binary")
    return slices.repartition("slice").sortWithinPartitions("slice").mapInArrow(met_twice, "bucket long")


def maybe_repeated(df: DataFrame, keys: list[str], slice_bits: int = 10, broadcast_buckets: int = BROADCAST_BUCKETS) -> DataFrame:
    """``df`` without most of the rows whose key is theirs alone; every row whose
    key another row has is there.  Reads ``df`` once to find out.  Where more
    buckets are met twice than can be broadcast, ``df`` itself: then the rows
    must be shuffled anyway."""
    found = materialize(repeated_buckets(df, keys, slice_bits), "repeated")
    if found.limit(broadcast_buckets + 1).count() > broadcast_buckets:
        drop_scratch(df.sparkSession, found._quarry_scratch)
        return df
    bucket = F.shiftrightunsigned(F.xxhash64(*keys), 64 - slice_bits - 32)
    return df.withColumn("_bucket", bucket).join(F.broadcast(found.withColumnRenamed("bucket", "_bucket")), "_bucket", "left_semi").drop("_bucket")
