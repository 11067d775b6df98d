"""Benchmark decontamination with DataFrame functions only.

1. Words are the maximal runs of ASCII letters, digits and non-ASCII
   characters, after A-Z are lower-cased.  A window is ``width`` consecutive
   words of a benchmark item; a shorter item (but not an empty one) is one
   window of its own length.
2. The n-grams (windows) are filed by the hash of their longest word, the one
   least likely to be common, and this hash table is broadcast; beyond a
   counted ``BROADCAST_WINDOWS`` windows it is cut into slices of about that
   many, and the same scan runs once for each.
3. Training texts are scanned map-side: every word is looked up; where it is
   the longest word of n-grams, the window of the text around it is compared
   word by word with each.  Words that miss and windows that differ go no
   further, so shuffles carry hits, never the words of the corpus.
4. Hits are united per document: covered words, and the items found.

Documents are keyed by (id, hash of the whole text), so repeated rows share
one result and rows that repeat an id with another text do not mix.
"""

from __future__ import annotations

from functools import reduce
from string import ascii_lowercase, ascii_uppercase

from pyspark.sql import Column, DataFrame, functions as F

from quarry.session import materialize

#: What separates words (fixed by the contract).
SEPARATORS = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]"

BROADCAST_WINDOWS = 200_000  # windows of about 200 bytes: 40 MB at most


def words(text: Column) -> Column:
    # split, not regexp_extract_all: the latter copies the whole text for every match
    lower = F.translate(F.coalesce(text, F.lit("")), ascii_uppercase, ascii_lowercase)
    return F.array_remove(F.split(lower, SEPARATORS + "+"), "")


def benchmark_windows(items: DataFrame, width: int = 10, id_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """Distinct (width, window, item_id) of all items."""
    base = items.select(F.col(id_col).alias("item_id"), words(F.col(text_col)).alias("_words")).where(F.size("_words") > 0)
    wide = F.least(F.size("_words"), F.lit(width))
    return (base.select("item_id", wide.alias("width"), "_words",
                        F.explode(F.sequence(F.lit(1), F.size("_words") - wide + 1)).alias("_at"))
            .select("item_id", "width", F.slice("_words", F.col("_at"), F.col("width")).alias("window")).distinct())


def _keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(F.col(id_col).alias("doc_id"), F.xxhash64(F.coalesce(F.col(text_col), F.lit(""))).alias("text_key"),
                       words(F.col(text_col)).alias("_words"))


def find_hits(docs: DataFrame, items: DataFrame, width: int = 10, id_col: str = "doc_id", text_col: str = "text",
              item_id_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """One row per contaminated document: ``doc_id``, ``text_key``, ``spans``
    (word ranges [first, end) covered by windows) and ``items`` (the ids of the
    items found; an item without an id is found but not listed)."""
    windows = benchmark_windows(items, width, item_id_col, item_text_col)
    longest = F.array_max(F.transform("window", lambda w, i: F.struct(F.length(w).alias("n"), w.alias("w"), i.alias("i"))))
    keys = (windows.withColumn("_longest", longest)
            .select(F.xxhash64("_longest.w").alias("hash"), F.col("_longest.i").alias("offset"), "width", "window", "item_id"))
    n_slices = -(-windows.count() // BROADCAST_WINDOWS)
    if n_slices > 1:
        # by the whole window, since many windows may share a longest word
        keys = materialize(keys.withColumn("_slice", F.pmod(F.xxhash64("window", "item_id"), F.lit(n_slices))), "benchmark-windows")
        slices = [keys.where(F.col("_slice") == i).drop("_slice") for i in range(n_slices)]
    else:
        slices = [keys]
    first = F.col("at") - F.col("offset")
    looked_up = (_keyed(docs, id_col, text_col)
                 .select("doc_id", "text_key", "_words", F.posexplode("_words").alias("at", "_word"))
                 .withColumn("hash", F.xxhash64("_word")))
    found = [looked_up.join(F.broadcast(s), "hash")
             .where((first >= 0) & (F.slice("_words", F.greatest(first, F.lit(0)) + 1, F.col("width")) == F.col("window")))
             .select("doc_id", "text_key", F.struct(first.alias("first"), (first + F.col("width")).alias("end")).alias("span"), "item_id")
             for s in slices]
    if n_slices > 1:  # one at a time, so that one slice is held at a time
        found = [materialize(f.distinct(), "benchmark-hits") for f in found]
    hits = reduce(DataFrame.unionAll, found)
    return hits.groupBy("doc_id", "text_key").agg(F.array_sort(F.collect_set("span")).alias("spans"),
                                                  F.collect_set("item_id").alias("items"))


def covered(spans: Column) -> Column:
    """Words in the union of sorted [first, end) spans."""
    start = F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).alias("upto"))
    return F.aggregate(spans, start, lambda a, s: F.struct(
        (a["n"] + F.greatest(F.lit(0), s["end"] - F.greatest(s["first"], a["upto"]))).alias("n"),
        F.greatest(a["upto"], s["end"]).alias("upto")), lambda a: a["n"])


def report(docs: DataFrame, items: DataFrame, width: int = 10, **cols) -> DataFrame:
    """One row per input row: id, ``n_words``, ``n_hit`` (words inside any
    occurrence of a window), ``n_items``, ``items_sha256`` (of the found ids,
    sorted as strings and joined by commas; of the empty string without any)
    and ``contaminated``.  Null texts have no words.  Repeated rows are reported
    as often as they are there; other columns are ignored; without documents
    the result is empty, without items nothing is contaminated."""
    id_col, text_col = cols.get("id_col", "doc_id"), cols.get("text_col", "text")
    base = _keyed(docs, id_col, text_col).select("doc_id", "text_key", F.size("_words").cast("long").alias("n_words"))
    hits = find_hits(docs, items, width, **cols).select(
        F.col("doc_id").alias("_id"), F.col("text_key").alias("_key"), covered(F.col("spans")).alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.array_join(F.array_sort(F.transform("items", lambda x: x.cast("string"))), ",").alias("_ids"))
    return (base.join(hits, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("text_key") == F.col("_key")), "left")
            .select("doc_id", "n_words", F.coalesce("n_hit", F.lit(0).cast("long")).alias("n_hit"),
                    F.coalesce("n_items", F.lit(0).cast("long")).alias("n_items"),
                    F.sha2(F.coalesce("_ids", F.lit("")), 256).alias("items_sha256"),
                    F.col("n_hit").isNotNull().alias("contaminated")))


def decontaminate(docs: DataFrame, items: DataFrame, width: int = 10, remove: str = "documents", **cols) -> DataFrame:
    """``docs`` (all its columns) without the contamination.

    ``remove="documents"`` drops rows with any hit; ``remove="spans"`` keeps
    all rows and cuts the covered words, with the separators after them, out of
    the text.  Clean rows are kept unchanged, null texts included; repeated
    rows are treated alike; empty tables of documents or items are fine; other
    columns, whatever their names, come back as they were."""
    id_col, text_col = cols.get("id_col", "doc_id"), cols.get("text_col", "text")
    hits = find_hits(docs, items, width, **cols).select(F.col("doc_id").alias("hit_id"), F.col("text_key").alias("hit_key"), "spans")
    names = docs.columns  # kept apart in a struct: they may be called as the columns here are
    rows = docs.select(F.struct(*[docs[f"`{c}`"] for c in names]).alias("row"), F.col(id_col).alias("own_id"),
                       F.xxhash64(F.coalesce(F.col(text_col), F.lit(""))).alias("own_key"))
    on = F.col("own_id").eqNullSafe(F.col("hit_id")) & (F.col("own_key") == F.col("hit_key"))
    if remove == "documents":
        return rows.join(hits.drop("spans"), on, "left_anti").select("row.*")
    if remove != "spans":
        raise ValueError(f"remove must be documents or spans, not {remove!r}")
    # a piece is a word with the separators after it; the first also has those before it
    text = F.col("row").getField(text_col)
    pieces = F.split(text, f"(?<={SEPARATORS})(?!{SEPARATORS})")
    lead = (F.regexp_replace(F.element_at(pieces, 1), SEPARATORS, "") == "").cast("int")  # separators alone come first
    kept = F.filter(pieces, lambda p, i: ~F.exists("spans", lambda s: (i - lead >= s["first"]) & (i - lead < s["end"])))
    cut = F.when(F.col("spans").isNotNull(), F.array_join(kept, "")).otherwise(text)
    return rows.join(hits, on, "left").select(*[(cut if c == text_col else F.col("row").getField(c)).alias(c) for c in names])


ORACLE_SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS rid, doc_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM documents
), b AS (
  SELECT item_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM benchmark
), bw AS (
  SELECT DISTINCT item_id, least(len(w), 10) AS width, array_to_string(w[k : k + least(len(w), 10) - 1], ' ') AS win
  FROM (SELECT item_id, w, unnest(generate_series(1, len(w) - least(len(w), 10) + 1)) AS k FROM b WHERE len(w) > 0)
), widths AS (SELECT DISTINCT width FROM bw
), dw AS (
  SELECT rid, width, k, array_to_string(w[k : k + width - 1], ' ') AS win
  FROM (SELECT rid, w, width, unnest(generate_series(1, len(w) - width + 1)) AS k FROM d, widths WHERE len(w) >= width)
), hit AS (
  SELECT dw.rid, dw.k, dw.width, bw.item_id FROM dw JOIN bw ON dw.width = bw.width AND dw.win = bw.win
), cover AS (
  SELECT rid, count(DISTINCT p) AS n_hit
  FROM (SELECT rid, unnest(generate_series(k, k + width - 1)) AS p FROM hit) GROUP BY rid
), found AS (
  SELECT rid, count(DISTINCT item_id) AS n_items,
         string_agg(DISTINCT CAST(item_id AS VARCHAR), ',' ORDER BY CAST(item_id AS VARCHAR)) AS ids
  FROM hit GROUP BY rid
)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
       n_hit IS NOT NULL AS contaminated
FROM d LEFT JOIN cover USING (rid) LEFT JOIN found USING (rid)
"""
