"""Token counts: two-tier lookup of pre-token lengths, without any pre-token
shuffle.

1. Every partition summarises the parts (blank-separated words, the units at
   which a byte-level BPE may be cut, see ``chunks``) of all its texts in a
   bounded heavy-hitter summary and emits it as one row.  Summaries are merged
   in a tree, so neither a task nor the driver sees more than ``FAN_IN`` of
   them at a time and no pre-token is ever a shuffle key.
2. The most frequent parts and their lengths in tokens form a compact table
   (at most ``TABLE_ENTRIES`` parts of at most ``chunks.CACHED_CHARS``
   characters, about 3 MB), which is broadcast.
3. One map-side pass adds up lengths; a part that is not in the table is
   encoded once by the library and kept in the worker's bounded cache.

The table and the caches only save work: counts are those of the library.
"""

from __future__ import annotations

import pickle
from collections import Counter
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, functions as F

from quarry.llm import chunks
from quarry.llm.common import ship

TABLE_ENTRIES = 32_768
SUMMARY_ENTRIES = 16_384  # kept per partition
PRUNE_AT = 262_144  # distinct parts held while summarising
FAN_IN = 64


def _prune(counts: Counter, keep: int) -> Counter:
    return Counter(dict(counts.most_common(keep)))


def _summarise(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    counts: Counter = Counter()
    for pdf in batches:
        for text in pdf["text"]:
            if text:
                counts.update(text.split(" "))
                if len(counts) > PRUNE_AT:
                    counts = _prune(counts, SUMMARY_ENTRIES)
    if counts:
        kept = [(p, n) for p, n in counts.most_common(SUMMARY_ENTRIES)
                if 0 < len(p) <= chunks.CACHED_CHARS and not p[0].isspace()]
        yield pd.DataFrame({"summary": [pickle.dumps(kept)]})


def _merge(blobs) -> bytes:
    total: Counter = Counter()
    for b in blobs:
        for part, n in pickle.loads(b):
            total[part] += n
    return pickle.dumps(sorted(total.items(), key=lambda x: (-x[1], x[0]))[:TABLE_ENTRIES])


def _merge_group(pdf: pd.DataFrame) -> pd.DataFrame:
    return pd.DataFrame({"summary": [_merge(pdf["summary"])]})


def frequent_parts(texts: DataFrame) -> list[str]:
    """The most frequent parts of all texts (approximate ranks, whole corpus).
    Each round merges ``FAN_IN`` summaries per group until the driver can take
    the last few."""
    level = texts.select("text").mapInPandas(_summarise, "summary binary")
    left = texts.rdd.getNumPartitions()
    while left > FAN_IN:
        left = -(-left // FAN_IN)
        level = (level.withColumn("_g", F.pmod(F.xxhash64("summary"), F.lit(left)))
                 .groupBy("_g").applyInPandas(_merge_group, "summary binary"))
    blobs = [bytes(r["summary"]) for r in level.collect()]
    return [p for p, _ in pickle.loads(_merge(blobs))] if blobs else []


def length_table(parts: list[str], tokenizer_path: str) -> dict[str, int]:
    tok = chunks.load_tokenizer(tokenizer_path)
    encoded = tok.encode_batch([" " + p for p in parts], add_special_tokens=False)
    return {p: len(e.ids) for p, e in zip(parts, encoded)}


def token_counts(docs: DataFrame, tokenizer_path: str, limit: int = 1024,
                 id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: id, ``n_bytes`` (UTF-8), ``n_tokens`` and
    ``over_limit`` (more than ``limit`` tokens).

    Null and empty texts count 0 bytes and 0 tokens.  Repeated rows and ids
    are kept as they are, a null id stays null, other columns are ignored, an
    empty table gives an empty result.  Special strings inside a text are
    handled as the tokenizer's default does.
    """
    ship(docs.sparkSession)
    src = docs.select(F.col(id_col), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    table = src.sparkSession.sparkContext.broadcast(length_table(frequent_parts(src), tokenizer_path))

    @F.pandas_udf("long")
    def count(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        encoder = chunks.counting_encoder(tokenizer_path, table)
        for texts in batches:
            yield pd.Series([encoder(t) for t in texts], dtype="int64")

    return (src.select(id_col, F.octet_length("text").cast("long").alias("n_bytes"), count("text").alias("n_tokens"))
            .withColumn("over_limit", F.col("n_tokens") > limit))
