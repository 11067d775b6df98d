"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile
from collections.abc import Iterator
from contextlib import contextmanager
from urllib.parse import urlparse

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from quarry.session import drop_scratch, ensure_checkpoint_dir


_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send the package's sources to the Python workers, once per application
    (the driver builds a small zip; Spark distributes it)."""
    import quarry

    app = spark.sparkContext.applicationId
    if app in _shipped:
        return
    root = os.path.dirname(os.path.abspath(quarry.__file__))
    path = os.path.join(tempfile.mkdtemp(prefix="quarry-src-"), "quarry-src.zip")
    with zipfile.ZipFile(path, "w") as z:
        for d, _, names in sorted(os.walk(root)):
            for n in sorted(names):
                if n.endswith(".py"):
                    full = os.path.join(d, n)
                    z.write(full, os.path.relpath(full, os.path.dirname(root)))
    spark.sparkContext.addPyFile(path)
    _shipped.add(app)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def id_bucket(col: str, modulus: int) -> Column:
    """crc32 of the id's decimal text modulo ``modulus`` (null id: null)."""
    return F.crc32(F.col(col).cast("string").cast("binary")) % modulus


def crc32_sql(text: str) -> str:
    """DuckDB SQL for the unsigned crc32 of an ASCII text expression, bit by bit."""
    codes = f"list_transform(range(1, length({text}) + 1), lambda i: ascii(substr({text}, i, 1))::BIGINT)"
    bits = "list_reduce([xor(c, b), 0, 0, 0, 0, 0, 0, 0, 0], lambda x, z: xor(x >> 1, 3988292384 * (x & 1)))"
    return f"xor(list_reduce(list_prepend(4294967295::BIGINT, {codes}), lambda c, b: {bits}), 4294967295)"


def posix_scratch(spark: SparkSession, name: str) -> str:
    """A fresh folder for binary archives under the shared checkpoint folder,
    as a path that every executor can open.

    Memory-mapped files need a mounted shared folder, so a checkpoint folder
    that is not mounted (``hdfs://`` and the like) is an explicit error: pass
    the operator an output folder on a shared mount instead.
    """
    base = ensure_checkpoint_dir(spark)
    url = urlparse(base)
    if url.scheme not in ("", "file"):
        raise ValueError(f"binary archives need a mounted shared folder, not {url.scheme}://; pass out_dir")
    path = os.path.join(url.path, "quarry-archives", f"{name}-{uuid.uuid4().hex[:12]}")
    os.makedirs(path, exist_ok=True)
    return path


ARROW_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"


def limit_arrow_rows(spark: SparkSession, rows: int) -> str:
    """From now on at most so many rows in an Arrow batch of this session: a
    batch of texts or sets is held by the executor and by its Python worker at
    once.  Returns the setting before."""
    before = spark.conf.get(ARROW_ROWS)
    if int(before) <= 0 or int(before) > rows:
        spark.conf.set(ARROW_ROWS, str(rows))
    return before


@contextmanager
def arrow_rows(spark: SparkSession, rows: int) -> Iterator[None]:
    """``limit_arrow_rows`` for the jobs run inside."""
    before = limit_arrow_rows(spark, rows)
    try:
        yield
    finally:
        spark.conf.set(ARROW_ROWS, before)


def discard(*tables: DataFrame) -> None:
    """Remove tables that ``materialize`` wrote, after their last reader."""
    for t in tables:
        path = getattr(t, "_quarry_scratch", None)
        if path is not None:
            drop_scratch(t.sparkSession, path)


#: Rows of a few numbers that are sent to every executor at most: some 16 MB.
SENT_ROWS = 500_000
#: Keys that are counted as hot at most; the others hold less than this share of the rows.
HOT_KEYS = 10_000


def bounded(df: DataFrame, limit: int = SENT_ROWS) -> bool:
    """Whether a frame has no more rows than ``limit``."""
    return df.limit(limit + 1).count() <= limit


def sent(df: DataFrame) -> DataFrame:
    """A frame of a few numbers a row, marked for broadcast if it is small
    enough; else the join shuffles it."""
    return F.broadcast(df) if bounded(df) else df


def join_unique(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Left join with a table that has one row per key.  A large one is shuffled,
    but for the rows of hot keys: no more than ``HOT_KEYS`` keys can hold more
    than that share of ``left`` each, and these are broadcast.  Both frames are
    read more than once: pass written tables."""
    if bounded(right):
        return left.join(F.broadcast(right), key, "left")
    often = left.groupBy(key).count().where(F.col("count") > left.count() / HOT_KEYS).select(key)
    hot = left.join(F.broadcast(often), key, "left_semi").join(F.broadcast(right.join(F.broadcast(often), key, "left_semi")), key, "left")
    return hot.unionByName(left.join(F.broadcast(often), key, "left_anti").join(right, key, "left"))


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


_GOLDEN = np.uint64(0x9E3779B97F4A7C15)
_M1 = np.uint64(0xBF58476D1CE4E5B9)
_M2 = np.uint64(0x94D049BB133111EB)


def mix64(x: np.ndarray, seed: int = 0) -> np.ndarray:
    """Bijective 64-bit finaliser (the public splitmix64 step)."""
    z = x + np.uint64((0x9E3779B97F4A7C15 * (seed + 1)) & 0xFFFFFFFFFFFFFFFF)
    z = (z ^ (z >> np.uint64(30))) * _M1
    z = (z ^ (z >> np.uint64(27))) * _M2
    return z ^ (z >> np.uint64(31))
