"""Document fingerprints from Lempel-Ziv phrases.

A text is parsed (LZ78) into the shortest phrases not seen before in it.  Texts
with common passages share phrases, as they would share a compressor's
dictionary, so the resemblance of phrase sets is a compression-like
similarity.  The set is hashed and reduced to a minimum-hash signature of
``SLOTS`` values of 16 bits, written in hex; likeness is the share of equal
slots.

Neighbours: documents are dealt by id range (the ranges come from one pass over
the ids alone, one row per range on the driver), and a range also gets the
first document of the range after it.  A task walks its range in order and
holds two documents at a time.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from quarry.llm.common import mix64, ship, shuffle_partitions

SLOTS = 128
_BLOCK = 4096  # phrases hashed at a time
_SEEDS = mix64(np.arange(SLOTS, dtype=np.uint64), 101) | np.uint64(1)
_BASE = 0x9E3779B97F4A7C15 | 1
NULL_ID = -(1 << 63)


class Phrases:
    """Running LZ78 parse; ``copy`` lets two texts share a common beginning."""

    def __init__(self, seen: set | None = None, open_: str = ""):
        self.seen = seen if seen is not None else set()
        self.open = open_

    def copy(self) -> Phrases:
        return Phrases(set(self.seen), self.open)

    def feed(self, text: str) -> Phrases:
        seen, add, w = self.seen, self.seen.add, self.open
        for ch in text:
            w += ch
            if w not in seen:
                add(w)
                w = ""
        self.open = w
        return self

    def finished(self) -> set:
        """All phrases; an unfinished last one repeats an earlier phrase."""
        return self.seen


def phrase_hashes(phrases: set) -> np.ndarray:
    """64-bit hashes of the phrases, by a polynomial over their characters."""
    joined = "".join(phrases)
    lengths = np.fromiter(map(len, phrases), np.int64, len(phrases))
    codes = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), "<u4").astype(np.uint64) + np.uint64(1)
    ends = np.cumsum(lengths)
    starts = ends - lengths
    # position from the phrase's end decides a character's power of the base
    power = np.cumprod(np.full(int(lengths.max()), _BASE, np.uint64))
    offset = np.repeat(ends, lengths) - 1 - np.arange(len(codes))
    return mix64(np.add.reduceat(codes * power[offset], starts) + lengths.astype(np.uint64))


def signature(phrases: set) -> str:
    """Hex of the minimum-hash signature; the empty string for no phrases."""
    if not phrases:
        return ""
    h = phrase_hashes(phrases)
    least = np.full(SLOTS, np.iinfo(np.uint64).max, np.uint64)
    for at in range(0, len(h), _BLOCK):
        x = h[at:at + _BLOCK, None] * _SEEDS[None, :]
        np.minimum(least, (x ^ (x >> np.uint64(29))).min(axis=0), out=least)
    return (mix64(least) >> np.uint64(48)).astype(">u2").tobytes().hex()


def likeness(a: str, b: str) -> float:
    """Share of equal slots; two empty texts are alike, an empty and another not."""
    if not a or not b:
        return 1.0 if a == b else 0.0
    x, y = np.frombuffer(bytes.fromhex(a), ">u2"), np.frombuffer(bytes.fromhex(b), ">u2")
    return float((x == y).mean())


def fingerprint(text: str | None) -> str:
    return signature(Phrases().feed(text or "").finished())


def with_neighbours(docs: DataFrame) -> DataFrame:
    """(doc_id, text, range_no, guest): documents sorted by descending id
    (null last, then text) within id ranges; the last row of a range with
    ``guest`` set is the next document after it."""
    spark = docs.sparkSession
    ids = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(NULL_ID)).alias("k"))
    n = shuffle_partitions(spark)
    ranges = (ids.repartitionByRange(n, F.desc("k")).groupBy(F.spark_partition_id().alias("p"))
              .agg(F.max("k").alias("first")).collect())  # one row per range
    firsts = np.array(sorted({r["first"] for r in ranges}), np.int64)  # ascending; range 0 is the last of these
    k = len(firsts)

    @F.pandas_udf("array<int>")
    def places(keys: pd.Series) -> pd.Series:
        x = keys.to_numpy(np.int64)
        at = np.searchsorted(firsts, x)
        return pd.Series([[k - 1 - a, (k - 2 - a) % k] if firsts[a] == v else [k - 1 - a] for a, v in zip(at.tolist(), x)])

    placed = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(NULL_ID)).alias("k"), F.coalesce("text", F.lit("")).alias("text"))
    placed = placed.select("k", "text", F.posexplode(places("k")).alias("guest", "range_no"))
    return placed.repartitionById(max(1, k), F.col("range_no")).sortWithinPartitions("guest", F.desc("k"), "text")


def compare_neighbours(docs: DataFrame) -> DataFrame:
    """One row per input row: ``doc_id``, ``n_chars``, ``edited_sha256``,
    ``fingerprint``, ``edited_fingerprint``, ``near_edited``, ``near_next``.

    The edited text is the text with its last floor(n/2) characters replaced by
    the first as many of the next document's (descending id, the first after
    the last; among rows of one id, by text).  Null texts are empty; a single
    document is its own next; an empty table gives an empty result."""
    ship(docs.sparkSession)
    columns = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]

    def row(k: int, text: str, half: Phrases, own: str, next_text: str, next_print: str) -> tuple:
        n = len(text)
        tail = next_text[:n // 2]
        edited = text[:n - n // 2] + tail
        changed = own if edited == text else signature(half.feed(tail).finished())
        return (None if k == NULL_ID else k, n, hashlib.sha256(edited.encode()).hexdigest(), own, changed,
                likeness(own, changed), likeness(own, next_print))

    def walk(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held, over, out = None, False, []
        for pdf in batches:
            for k, text, guest in zip(pdf["k"], pdf["text"], pdf["guest"]):
                if over:  # further rows with the first id of the next range
                    continue
                half = Phrases().feed(text[:len(text) - len(text) // 2])
                own = signature(half.copy().feed(text[len(text) - len(text) // 2:]).finished())
                if held is not None:
                    out.append(row(*held, text, own))
                held, over = (int(k), text, half, own), bool(guest)
            yield pd.DataFrame(out, columns=columns).astype({"doc_id": "Int64"})
            out = []

    schema = ("doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
              "near_edited double, near_next double")
    return with_neighbours(docs).mapInPandas(walk, schema)
