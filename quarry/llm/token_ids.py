"""Token-ID output: flat unsigned integer files with 64-bit document offsets.

Layout of an archive folder, one set of files per shard (shards are ranges of
ascending document id, in shard order):

- ``ids-00000.bin``: token ids of the shard's documents one after another,
  little-endian, ``uint16`` where the vocabulary fits and ``uint32`` otherwise;
- ``offsets-00000.bin``: ``int64``, where each document starts in the shard,
  and the shard's length at the end;
- ``docs-00000.bin``: ``int64``, the document ids.

The manifest (one row per shard) holds the type of the ids and each shard's
base: the number of ids in all shards before it, by prefix sum.  A document's global start is base +
local offset, so shards are written independently and in one pass.

A task writes temporary files and renames them when its shard is complete, so
a task that is lost and run again, or runs twice, leaves the same files.
"""

from __future__ import annotations

import os
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, functions as F

from quarry.llm import chunks
from quarry.llm.common import posix_scratch, ship, shuffle_partitions

NULL_ID = -(1 << 63)  # a null document id in a docs file
BLOCK_DOCS = 2048  # documents that one reading task takes at a time
_KINDS = ("ids", "offsets", "docs")


def _shard_files(folder: str, shard: int) -> dict[str, str]:
    return {k: os.path.join(folder, f"{k}-{shard:05d}.bin") for k in _KINDS}


def id_dtype(vocab_size: int) -> str:
    return "<u2" if vocab_size <= 1 << 16 else "<u4"


def write_archive(docs: DataFrame, tokenizer_path: str, out_dir: str | None = None, end_id: int = 0,
                  id_col: str = "doc_id", text_col: str = "text", shards: int | None = None,
                  cached: int | None = None) -> tuple[str, DataFrame]:
    """Encode all documents into ``out_dir`` (on a shared mount) and return the
    folder and its manifest (shard, n_docs, n_ids, base).

    Rows are ordered by id, then a hash of the text, then text, and cut into
    shards by id and hash, so rows without an id, or of one id, fill more than
    one shard.  Null ids come first; null text is empty text, which still gets
    its end id.  Repeated rows are all written; other columns are ignored.  Only
    the shard totals (one row per shard) reach the driver, and the tokenizer is
    loaded by the tasks alone.  ``cached``: parts of
    texts that a worker remembers (memory for time; the ids are the same).
    """
    spark = docs.sparkSession
    ship(spark)
    folder = out_dir or posix_scratch(spark, "ids")

    def write(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        shard = TaskContext.get().partitionId()
        vocab = chunks.load_tokenizer(tokenizer_path).get_vocab_size(with_added_tokens=True)
        dtype = id_dtype(max(vocab, end_id + 1))
        end = np.array([end_id], dtype).tobytes()
        encoder = chunks.id_encoder(tokenizer_path, dtype, cached)
        width = np.dtype(dtype).itemsize
        final = _shard_files(folder, shard)
        temporary = {k: f"{p}.{uuid.uuid4().hex}.tmp" for k, p in final.items()}
        files = {k: open(p, "wb") for k, p in temporary.items()}
        n_docs = position = 0
        try:
            for pdf in batches:
                starts = np.empty(len(pdf), "<i8")
                for i, text in enumerate(pdf["text"]):
                    blob = encoder(text) + end
                    files["ids"].write(blob)
                    starts[i] = position
                    position += len(blob) // width
                files["offsets"].write(starts.tobytes())
                files["docs"].write(pdf["doc_id"].to_numpy("<i8").tobytes())
                n_docs += len(pdf)
            files["offsets"].write(np.array([position], "<i8").tobytes())
        finally:
            for f in files.values():
                f.close()
        for k in _KINDS:
            os.replace(temporary[k], final[k])
        yield pd.DataFrame({"shard": [shard], "n_docs": [n_docs], "n_ids": [position], "dtype": [dtype]})

    src = docs.select(F.coalesce(F.col(id_col).cast("long"), F.lit(NULL_ID)).alias("doc_id"),
                      F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    totals = (src.withColumn("text_key", F.xxhash64("text"))
              .repartitionByRange(shards or shuffle_partitions(spark), "doc_id", "text_key")
              .sortWithinPartitions("doc_id", "text_key", "text").select("doc_id", "text")
              .mapInPandas(write, "shard int, n_docs long, n_ids long, dtype string").collect())
    base, rows = 0, []
    for r in sorted(totals, key=lambda r: r["shard"]):
        rows.append((r["shard"], r["n_docs"], r["n_ids"], base, r["dtype"]))
        base += r["n_ids"]
    return folder, spark.createDataFrame(rows, "shard int, n_docs long, n_ids long, base long, dtype string")


def read_archive(spark: SparkSession, folder: str, manifest: DataFrame) -> DataFrame:
    """Documents of an archive, read through memory maps in blocks of
    ``BLOCK_DOCS``: ``doc_id``, ``start`` (global), ``n_tokens`` (with the end
    id), ``ids_crc32`` (of the ids as little-endian ``uint32``)."""

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for b in pdf.itertuples():
                paths = _shard_files(folder, b.shard)
                last = min(b.first + BLOCK_DOCS, b.n_docs)
                offsets = np.memmap(paths["offsets"], "<i8", "r")[b.first:last + 1]
                ids = np.memmap(paths["ids"], b.dtype, "r")
                doc_ids = np.array(np.memmap(paths["docs"], "<i8", "r")[b.first:last])
                crc = [zlib.crc32(ids[s:e].astype("<u4").tobytes()) for s, e in zip(offsets[:-1], offsets[1:])]
                yield pd.DataFrame({"doc_id": doc_ids, "start": offsets[:-1] + b.base,
                                    "n_tokens": np.diff(offsets), "ids_crc32": np.array(crc, "int64")})

    blocks = (manifest.where("n_docs > 0")
              .select("shard", "n_docs", "base", "dtype",
                      F.explode(F.sequence(F.lit(0).cast("long"), F.col("n_docs") - 1, F.lit(BLOCK_DOCS).cast("long"))).alias("first"))
              .repartition(shuffle_partitions(spark)))
    rows = blocks.mapInPandas(read, "doc_id long, start long, n_tokens long, ids_crc32 long")
    return rows.withColumn("doc_id", F.when(F.col("doc_id") != NULL_ID, F.col("doc_id")))


def token_ids(docs: DataFrame, tokenizer_path: str, end_id: int = 0, **kw) -> DataFrame:
    """Write the archive and read it back: one row per document.  An empty
    table gives an empty archive and an empty result."""
    folder, manifest = write_archive(docs, tokenizer_path, end_id=end_id, **kw)
    return read_archive(docs.sparkSession, folder, manifest)
