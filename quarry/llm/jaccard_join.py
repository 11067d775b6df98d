"""N-gram Jaccard join by PartEnum signatures.

A document's set holds the 64-bit hashes of its distinct 5-word shingles.
Documents with the same set form one class, and only classes are joined.

Signatures (exact, no link is lost).  Sizes fall into bands whose upper end
doubles; a set also takes part in the next band when a partner may lie there.
In a band the hash domain is cut into a fixed number of partitions, and a
set's signature for a partition is a hash of all its elements in it.  Two sets
that are similar enough differ in at most k elements, so in at most k
partitions; all other partitions that are not empty have the same signature in
both.  Hence of all its signatures, put in one global order (those of most
elements, the most selective, first), a set needs only the first k + 1: two
similar sets always share one of these.  A set with no more than k signatures
in all emits a mark for its band as well, which any partner for which this
matters also emits.

Groups.  Classes that share a signature are first compared with one leader of
the group (a star, not all pairs).  Links found are united, and groups that
still hold several components are compared with another leader, from their
largest component, up to ``ROUNDS`` times while that closes groups.  Only then are the pairs between the
components of a group looked at, by sketches, inside the task that holds the
group.  Of the pairs that may be links, the nearest one of each component is
compared first, for up to ``ROUNDS`` times; then those that still lie in
different components.

Hot groups.  Signatures in more than ``HOT_GROUP`` rows are counted before any
task takes whole groups; their groups find leaders by aggregates, and no task
holds them.  The classes of those that stay open (different documents with one
template) get another, independent set of signatures over finer partitions,
in an order that puts frequent signatures last, so that a signature of the
template alone is used only by sets with little else.  This loses no link,
since any one order of all signatures will do.  What is hot again is divided
again; where that does not help, the pairs are listed by pairs of blocks of
about half ``HOT_GROUP``.

Comparison.  Sizes and parity sketches (one bit per hash range: whether the
number of elements is odd) give a lower bound on the number of elements that
differ, which removes nearly all false candidates; exact set intersection
decides the others.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from quarry.llm.common import SENT_ROWS, arrow_rows, bounded, discard, join_unique, mix64, sent, ship, shuffle_partitions
from quarry.llm.components import connected_components, merged
from quarry.session import materialize

NUM, DEN = 75, 100  # similarity threshold as a fraction
SHINGLE = 5
ROUNDS = 3
STALLED = 0.9  # no further leader round if the last one left more than this share of the open rows
HOT_GROUP = 4096
BROADCAST_CLASSES = 500_000  # pairs of longs: 8 MB
PAIR_BLOCK = 1 << 15  # pairs whose sketches are compared at a time
MAX_LEVEL = 4  # independent signature sets for one group; then its pairs are listed
FINER = 4  # times the partitions of level 0 that the other levels have
FREQUENT = 1_000_000  # signatures whose counts are shipped, at most: 16 MB
SEEN_SETS = 100_000  # set ids a task remembers, so that copies emit signatures once
FIRST_GROUPS = 8  # of a set's groups that go with its rows, so that a pair is returned by one of its groups
SLICE_CHARS = 1 << 20  # of texts whose sets and signatures a task holds at a time
TEXT_ROWS = 500  # texts or sets in one batch between an executor and its Python worker
MANY = 3  # times as many pairs as components have nearest ones: then these are compared first
COARSE = 4  # times fewer ranges that a sketch has in the first comparison within groups
_U = np.uint64


# --- sets ----------------------------------------------------------------------

_PLACES = (0x9E3779B97F4A7C15 ** np.arange(1, SHINGLE + 1, dtype=object) & 0xFFFFFFFFFFFFFFFF).astype(np.uint64)  # weights of a shingle's words


def word_hashes(text: str) -> np.ndarray:
    """64-bit hashes of the words of a text, in order."""
    words = text.encode("utf-8", "surrogatepass").lower().split()  # of bytes: A-Z and ASCII white space only
    return np.fromiter(map(xxhash.xxh3_64_intdigest, words), _U, len(words))


def shingles(text: str | None) -> np.ndarray:
    """Sorted distinct hashes of the 5-word shingles of the whole text.  Words
    are lower-cased in A-Z only and separated by ASCII white space; fewer than
    five words are one shingle; without words the set is empty."""
    h = word_hashes(text) if text else np.empty(0, _U)
    if not len(h):
        return h
    n = min(SHINGLE, len(h))
    out = np.full(len(h) - n + 1, n, _U)
    for i in range(n):
        out += h[i:len(h) - n + 1 + i] * _PLACES[i]
    out = mix64(out, 1)
    out.sort()
    return out[np.append(True, out[1:] != out[:-1])]


def set_id(s: np.ndarray) -> int:
    """64-bit identity of a set (as a signed long)."""
    total = (int(s.sum(dtype=_U)) + len(s) * 0xD6E8FEB86659FD93) & 0xFFFFFFFFFFFFFFFF
    return int(mix64(np.array([total], _U), 3).view(np.int64)[0])


def partner_max(n: int) -> int:
    return n * DEN // NUM


def differences(a: int, b: int) -> int:
    """The most elements in which similar sets of these sizes can differ."""
    return (a + b) * (DEN - NUM) // (DEN + NUM)


def similar(a: np.ndarray, b: np.ndarray) -> bool:
    both = len(np.intersect1d(a, b, assume_unique=True))
    return DEN * both >= NUM * (len(a) + len(b) - both)


def band(n: int) -> int:
    return (n - 1).bit_length()


def partitions(b: int, level: int = 0) -> int:
    """Partitions of the hash domain in a band, so that a set has clearly more
    than k partitions with elements."""
    top = 1 << b
    return (8 * top if top <= 16 else top if top <= 128 else top // 2) * (FINER if level else 1)


def banded(s: np.ndarray, level: int = 0) -> Iterator[tuple[np.ndarray, np.ndarray, int]]:
    """Per band in which a set takes part: all its signatures, its mark (none
    if it has more than k signatures), and k."""
    n = len(s)
    if not n:
        return
    if level:
        s = np.sort(mix64(s, 10 + level))
    k = differences(n, partner_max(n))
    for b in ([band(n)] if partner_max(n) <= 1 << band(n) else [band(n), band(n) + 1]):
        m = partitions(b, level)
        part = ((s >> _U(32)) * _U(m)) >> _U(32)  # ascending, since s is
        starts = np.flatnonzero(np.append(True, part[1:] != part[:-1]))
        count = np.diff(np.append(starts, n))
        content = np.add.reduceat(s, starts)
        sig = mix64(content ^ mix64(part[starts], 5) ^ _U(b + 64 * level), 6)
        sig = (_U(255) - np.minimum(count, 255).astype(_U)) << _U(56) | sig >> _U(8)  # the global order
        # the mark: similar sets may differ in every partition
        yield sig, mix64(np.array([b + 64 * level][:len(sig) <= k], _U), 7), k


def signatures(s: np.ndarray, level: int = 0, frequent: tuple[np.ndarray, np.ndarray] | None = None) -> np.ndarray:
    """PartEnum signatures of a set; sets with Jaccard similarity of NUM/DEN or
    more share at least one, at every level.  ``frequent``: signatures, sorted,
    and their counts; these come last in the global order, by count."""
    out = [np.empty(0, _U)]
    for sig, mark, k in banded(s, level):
        if len(mark):
            out += [sig, mark]
        elif frequent is None or not len(frequent[0]):
            out.append(np.partition(sig, k)[:k + 1])
        else:
            at = np.minimum(np.searchsorted(frequent[0], sig), len(frequent[0]) - 1)
            out.append(sig[np.lexsort((sig, np.where(frequent[0][at] == sig, frequent[1][at], 0)))[:k + 1]])
    return np.concatenate(out)


def parity_sketch(s: np.ndarray) -> bytes:
    """One bit per hash range, four to eight ranges per element."""
    bits = min(17, max(6, (4 * len(s) - 1).bit_length()))
    return np.packbits((np.bincount((s >> _U(64 - bits)).astype(np.int64), minlength=1 << bits) & 1).astype(np.uint8)).tobytes()


def folded(sketch: bytes, size: int) -> np.ndarray:
    """A sketch as bytes at a coarser size: adjacent ranges' parities add up."""
    x = np.frombuffer(sketch, np.uint8)
    if len(x) == size:
        return x
    return np.packbits(np.bitwise_xor.reduce(np.unpackbits(x).reshape(8 * size, -1), axis=1))


def may_be_similar(na: int, ca: bytes, nb: int, cb: bytes) -> bool:
    if DEN * min(na, nb) < NUM * max(na, nb):
        return False
    size = min(len(ca), len(cb))
    return int(np.bitwise_count(folded(ca, size) ^ folded(cb, size)).sum()) <= differences(na, nb)


def pairs_that_may_be_similar(n: np.ndarray, sketches: list[bytes], a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """``may_be_similar`` for many pairs of rows at once: the share of elements
    by which they differ at least, NaN where they cannot be similar."""
    far = np.full(len(a), np.nan)
    width = np.fromiter(map(len, sketches), np.int64, len(sketches))
    ok = DEN * np.minimum(n[a], n[b]) >= NUM * np.maximum(n[a], n[b])
    coarse = np.minimum(width[a], width[b])
    for size in np.unique(coarse[ok]):
        at = np.flatnonzero(ok & (coarse == size))
        rows, place = np.unique(np.concatenate([a[at], b[at]]), return_inverse=True)
        bits = np.stack([folded(sketches[i], size) for i in rows]).view(np.uint64)
        for c in range(0, len(at), PAIR_BLOCK):
            x, y = place[c:c + PAIR_BLOCK][:len(at) - c], place[len(at) + c:len(at) + c + PAIR_BLOCK]
            apart = np.bitwise_count(bits[x] ^ bits[y]).sum(axis=1, dtype=np.int64)
            part = at[c:c + PAIR_BLOCK]
            both = n[a[part]] + n[b[part]]
            far[part] = np.where(apart <= both * (DEN - NUM) // (DEN + NUM), apart / both, np.nan)
    return far


def pairs_between(component: np.ndarray, start: int, end: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Row pairs (i < j) of a group's rows that lie in different components, in blocks."""
    rows = max(1, PAIR_BLOCK // max(1, end - start))
    for at in range(start, end, rows):
        i, j = np.nonzero(component[at:min(end, at + rows), None] != component[None, start:end])
        i, j = i + at, j + start
        yield i[i < j], j[i < j]


# --- Spark ---------------------------------------------------------------------

def text_slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The batches cut into parts of about ``SLICE_CHARS`` of text."""
    for batch in batches:
        ends = np.cumsum(pc.fill_null(pc.utf8_length(batch.column("text")), 0).to_numpy(zero_copy_only=False).astype(np.int64) + 64)
        at = 0
        while at < batch.num_rows:
            done = ends[at - 1] if at else 0
            to = max(at + 1, int(np.searchsorted(ends, done + SLICE_CHARS, "right")))
            yield batch.slice(at, to - at)
            at = to


def _text_key() -> Column:
    return F.xxhash64(F.coalesce("text", F.lit("")))


def document_sets(docs: DataFrame) -> DataFrame:
    """(doc_id, text_key, n_shingles, sid, sigs); sid is null for an empty set.  A task gives the signatures of a set that it meets again once."""
    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()

        def signed(s: np.ndarray, sid: int | None) -> np.ndarray:
            if sid is None or sid in seen:
                return s[:0]
            if len(seen) >= SEEN_SETS:
                seen.clear()
            seen.add(sid)
            return signatures(s)

        for batch in text_slices(batches):
            size, sids, sigs = [], [], []
            for t in batch.column("text").to_pylist():
                s = shingles(t)
                size.append(len(s))
                sids.append(set_id(s) if len(s) else None)
                sigs.append(signed(s, sids[-1]))
            ends = np.cumsum([0, *map(len, sigs)], dtype=np.int32)
            values = np.concatenate([np.empty(0, _U), *sigs]).view(np.int64)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("text_key"), pa.array(size, pa.int64()), pa.array(sids, pa.int64()),
                 pa.ListArray.from_arrays(pa.array(ends), pa.array(values))],
                ["doc_id", "text_key", "n_shingles", "sid", "sigs"])

    return (docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", _text_key().alias("text_key"))
            .mapInArrow(sets, "doc_id long, text_key long, n_shingles long, sid long, sigs array<long>"))


def _whole_groups(batches: Iterator[pd.DataFrame]) -> Iterator[tuple[pd.DataFrame, np.ndarray, np.ndarray]]:
    """Parts of a partition that is sorted by sig, in whole groups: the rows,
    and where each group starts and ends."""
    carry = None
    for pdf in batches:
        pdf = pdf if carry is None else pd.concat([carry, pdf], ignore_index=True)
        sig = pdf["sig"].to_numpy()
        cuts = np.flatnonzero(sig[1:] != sig[:-1]) + 1
        if not len(cuts):
            carry = pdf
            continue
        yield pdf.iloc[:cuts[-1]], np.append(0, cuts[:-1]), cuts
        carry = pdf.iloc[cuts[-1]:].reset_index(drop=True)
    if carry is not None and len(carry):
        yield carry, np.array([0]), np.array([len(carry)])


def _grouped(groups: DataFrame) -> DataFrame:
    return groups.repartition(shuffle_partitions(groups.sparkSession), "sig").sortWithinPartitions("sig", "sid")


def _hot_signatures(rows: DataFrame) -> DataFrame | None:
    """(sig): the signatures in more than ``HOT_GROUP`` of the rows, at most
    one for so many rows, or None.  Hash buckets are counted first, so only
    the rows of full buckets are counted by signature."""
    n = max(1, 8 * rows.count() // HOT_GROUP)
    bucket = F.pmod(F.xxhash64("sig"), F.lit(n))
    full = materialize(rows.groupBy(bucket.alias("_b")).count().where(F.col("count") > HOT_GROUP).select("_b"), "jaccard-buckets")
    if not full.limit(1).count():
        return None
    hot = materialize(rows.join(sent(full), bucket == F.col("_b"), "left_semi").groupBy("sig").count()
                      .where(F.col("count") > HOT_GROUP).select("sig"), "jaccard-hot")
    discard(full)
    return hot if hot.limit(1).count() else None


def _near(n: Column, m: Column) -> Column:
    return DEN * F.least(n, m) >= NUM * F.greatest(n, m)


def _shared(rows: DataFrame) -> tuple[DataFrame, bool]:
    """(sig, leader, sid, near, more, hot) of the signatures in ``rows`` (sig,
    sid, n_shingles) that several sets have, and whether any is hot.  The
    leader is the group's smallest sid; near tells whether its size allows a
    link."""
    def groups(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf, _, _ in _whole_groups(batches):
            g, d, n = (pdf[c].to_numpy(np.int64) for c in ("sig", "sid", "n_shingles"))
            fresh = np.append(True, (g[1:] != g[:-1]) | (d[1:] != d[:-1]))  # not a repeated row
            g, d, n = g[fresh], d[fresh], n[fresh]
            new = np.append(True, g[1:] != g[:-1])
            start = np.flatnonzero(new)
            first = start[np.cumsum(new) - 1]
            near = (DEN * np.minimum(n, n[first]) >= NUM * np.maximum(n, n[first])) & ~new
            size = np.diff(np.append(start, len(g)))[np.cumsum(new) - 1]
            keep = (size > 2) | ((size == 2) & near)  # a group of two is one pair
            if keep.any():
                yield pd.DataFrame({"sig": g[keep], "leader": d[first][keep], "sid": d[keep], "near": near[keep], "more": size[keep] > 2, "hot": False})

    hot = _hot_signatures(rows)
    cold = rows if hot is None else rows.join(sent(hot), "sig", "left_anti")
    out = _grouped(cold).mapInPandas(groups, "sig long, leader long, sid long, near boolean, more boolean, hot boolean")
    if hot is not None:
        wide = materialize(rows.join(sent(hot), "sig", "left_semi").distinct(), "jaccard-wide")
        led = wide.groupBy("sig").agg(F.min(F.struct("sid", "n_shingles")).alias("_l"))
        out = out.unionAll(wide.join(sent(led), "sig").select(
            "sig", F.col("_l.sid").alias("leader"), "sid",
            (_near(F.col("n_shingles"), F.col("_l.n_shingles")) & (F.col("sid") != F.col("_l.sid"))).alias("near"),
            F.lit(True).alias("more"), F.lit(True).alias("hot")))
    groups = materialize(out, "jaccard-groups")
    if hot is not None:
        discard(hot, wide)
    return groups, hot is not None


def _classes(doc_sets: DataFrame, sids: DataFrame) -> DataFrame:
    """(sid, doc, key): the wanted classes, and id and text hash of one document of each."""
    first = F.min(F.struct("doc_id", "text_key"))
    return materialize(doc_sets.where("sid is not null").groupBy("sid").agg(first.alias("d")).join(sids, "sid", "left_semi")
                       .select("sid", F.col("d.doc_id").alias("doc"), F.col("d.text_key").alias("key")), "jaccard-classes")


def _made(docs: DataFrame, classes: DataFrame, name: str, schema: str, make: Callable[[int, np.ndarray], tuple]) -> DataFrame:
    """A table of ``make(sid, set)`` of the classes, from their documents' texts.
    Rows with one id and equal texts give a class once a row, so such repeats
    are dropped where there are any."""
    columns = [c.split()[0] for c in schema.split(", ")]

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_slices(batches):
            got = [make(sid, s) for sid, s in zip(batch.column("sid").to_pylist(), map(shingles, batch.column("text").to_pylist()))]
            yield pa.RecordBatch.from_pylist([dict(zip(columns, r)) for r in got], schema=arrow)

    arrow = to_arrow_schema(StructType.fromDDL(schema))
    few = bounded(classes, BROADCAST_CLASSES)
    texts = docs.select(F.col("doc_id").cast("long").alias("_doc"), _text_key().alias("_key"), "text")
    # the text hash first: ids may be missing or shared
    found = texts.join(F.broadcast(classes) if few else classes, (F.col("_key") == F.col("key")) & F.col("_doc").eqNullSafe(F.col("doc")))
    with arrow_rows(docs.sparkSession, TEXT_ROWS):
        made = materialize(found.select("sid", "text").mapInArrow(rows, schema), name)
    if made.count() == classes.count():
        return made
    once = materialize(made.dropDuplicates(["sid"]), name)
    discard(made)
    return once


def _sketches(docs: DataFrame, classes: DataFrame) -> DataFrame:
    """(sid, n_shingles, sketch) of the classes."""
    return _made(docs, classes, "jaccard-sketches", "sid long, n_shingles long, sketch binary", lambda sid, s: (sid, len(s), parity_sketch(s)))


def _elements(docs: DataFrame, classes: DataFrame, sids: DataFrame, name: str) -> DataFrame:
    """(sid, n_shingles, elements) of those of the classes that ``sids`` has."""
    wanted = materialize(classes.join(sids, "sid", "left_semi"), "jaccard-wanted")
    made = _made(docs, wanted, name, "sid long, n_shingles long, elements binary", lambda sid, s: (sid, len(s), s.tobytes()))
    discard(wanted)
    return made


def _ends(sets: DataFrame, pairs: DataFrame) -> DataFrame:
    """Those of the sets that the pairs (a, b), a written table, have."""
    ends = pairs.select(F.col("a").alias("sid")).unionAll(pairs.select(F.col("b").alias("sid"))).distinct()
    # two ends a pair: few pairs need not be shuffled to know that their ends are few
    return sets.join(F.broadcast(ends) if bounded(pairs, SENT_ROWS // 2) else sent(ends), "sid", "left_semi")


def _sketched(pairs: DataFrame, sets: DataFrame, coarse: DataFrame | None = None) -> DataFrame:
    """The pairs (a, b, ...) whose sizes and sketches allow a link.  With
    ``coarse`` the smaller sketches are compared first, and the full ones are
    shuffled only for the sets of the pairs that are left."""
    if coarse is not None:
        pairs = materialize(_sketched(pairs, coarse), "jaccard-candidates")
        sets = _ends(sets, pairs)
    a = sets.select(F.col("sid").alias("a"), F.col("n_shingles").alias("na"), F.col("sketch").alias("ka"))
    b = sets.select(F.col("sid").alias("b"), F.col("n_shingles").alias("nb"), F.col("sketch").alias("kb"))

    @F.pandas_udf("boolean")
    def may(na: pd.Series, ka: pd.Series, nb: pd.Series, kb: pd.Series) -> pd.Series:
        return pd.Series([may_be_similar(*r) for r in zip(na, ka, nb, kb)], dtype=bool)

    return pairs.join(a, "a").join(b, "b").where(may("na", "ka", "nb", "kb")).drop("na", "ka", "nb", "kb")


def _links(pairs: DataFrame, docs: DataFrame, classes: DataFrame) -> DataFrame:
    """(ca, cb): the components of the pairs (a, b, ca, cb) that are links, by
    exact intersection.  Only the sets of these pairs are made and shuffled."""
    pairs = materialize(pairs, "jaccard-pairs")
    sids = pairs.select(F.col("a").alias("sid")).unionAll(pairs.select(F.col("b").alias("sid"))).distinct()
    sets = _elements(docs, classes, sids, "jaccard-elements")

    @F.pandas_udf("boolean")
    def linked(x: pd.Series, y: pd.Series) -> pd.Series:
        return pd.Series([similar(np.frombuffer(p, _U), np.frombuffer(q, _U)) for p, q in zip(x, y)], dtype=bool)

    a = sets.select(F.col("sid").alias("a"), F.col("elements").alias("ea"))
    b = sets.select(F.col("sid").alias("b"), F.col("elements").alias("eb"))
    with arrow_rows(docs.sparkSession, TEXT_ROWS):
        links = materialize(pairs.join(a, "a").join(b, "b").where(linked("ea", "eb")).select("ca", "cb"), "jaccard-links")
    discard(pairs, sets)
    return links


def _open(groups: DataFrame, seed: int, any_hot: bool) -> DataFrame:
    """(sig, sid, component, leader, home, hot): the groups (sig, sid,
    component, hot) that hold several components, and a leader from the
    largest, with its component; null where it need not be compared."""
    def emit(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf, starts, ends in _whole_groups(batches):
            sid, comp = pdf["sid"].to_numpy(np.int64), pdf["component"].to_numpy(np.int64)
            several = np.minimum.reduceat(comp, starts) != np.maximum.reduceat(comp, starts)
            keep, leader, home = np.zeros(len(sid), bool), np.zeros(len(sid), np.int64), np.zeros(len(sid), np.int64)
            led = np.zeros(len(sid), bool)
            rank = mix64(sid.view(_U), 20 + seed)
            for s, e in zip(starts[several], ends[several]):
                values, inverse, counts = np.unique(comp[s:e], return_inverse=True, return_counts=True)
                inside = inverse == counts.argmax()
                keep[s:e], led[s:e] = True, ~inside
                leader[s:e] = sid[s:e][inside][rank[s:e][inside].argmin()]
                home[s:e] = values[counts.argmax()]
            if keep.any():
                yield pd.DataFrame({"sig": pdf["sig"].to_numpy()[keep], "sid": sid[keep], "component": comp[keep],
                                    "leader": pd.Series(leader[keep], dtype="Int64").mask(~led[keep]), "home": home[keep], "hot": False})

    out = (_grouped(groups.where("not hot").select("sig", "sid", "component"))
           .mapInPandas(emit, "sig long, sid long, component long, leader long, home long, hot boolean"))
    if any_hot:
        wide = groups.where("hot").select("sig", "sid", "component")
        parts = (wide.groupBy("sig", "component")
                 .agg(F.count(F.lit(1)).alias("n"), F.min(F.struct(F.xxhash64("sid", F.lit(seed)).alias("r"), "sid")).alias("_l")))
        best = (parts.groupBy("sig").agg(F.max(F.struct("n", "component", "_l")).alias("_h"), F.min("component").alias("_lo"), F.max("component").alias("_hi"))
                .where("_lo <> _hi").select("sig", F.col("_h.component").alias("home"), F.col("_h._l.sid").alias("leader")))
        out = out.unionAll(wide.join(sent(best), "sig").select(
            "sig", "sid", "component", F.when(F.col("component") != F.col("home"), F.col("leader")).alias("leader"), "home", F.lit(True).alias("hot")))
    return materialize(out, "jaccard-open")


def _blocks(hot: DataFrame) -> DataFrame:
    """Hot groups (sig, sid, component) as groups of bounded size, one for each
    two blocks, so that every two members of a group meet."""
    sizes = hot.groupBy("sig").agg(F.greatest(F.lit(2), F.ceil(F.count(F.lit(1)) / max(1, HOT_GROUP // 2))).cast("int").alias("_n"))
    own = F.pmod(F.xxhash64("sid"), F.col("_n")).cast("int")
    return (hot.join(sent(sizes), "sig").withColumn("_own", own)
            .withColumn("_other", F.explode(F.sequence(F.lit(0), F.col("_n") - 1))).where("_own <> _other")
            .select(F.xxhash64("sig", F.least("_own", "_other"), F.greatest("_own", "_other")).alias("sig"), "sid", "component"))


def met_before(group: np.ndarray, first: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Whether rows a and b, which share their group, also share a lesser one
    among the least groups (``first``, padded) of both.  A pair's least group
    returns it, so no pair is lost; pairs of many groups seldom come again."""
    out = np.zeros(len(a), bool)
    for c in range(0, len(a), PAIR_BLOCK):
        x, y = first[a[c:c + PAIR_BLOCK]], first[b[c:c + PAIR_BLOCK]]
        lesser = x < group[a[c:c + PAIR_BLOCK], None]
        out[c:c + PAIR_BLOCK] = ((x[:, :, None] == y[:, None, :]).any(axis=2) & lesser).any(axis=1)
    return out


def _rest(opened: DataFrame, coarse: DataFrame, listed: bool) -> DataFrame:
    """(a, b, ca, cb, far): the pairs of an open group's components whose
    smaller sketches allow a link, with their components and distance by these
    sketches; those of hot groups if ``listed``."""
    def emit(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf, starts, ends in _whole_groups(batches):
            sid, sig = pdf["sid"].to_numpy(np.int64), pdf["sig"].to_numpy(np.int64)
            comp, n = pdf["component"].to_numpy(np.int64), pdf["n_shingles"].to_numpy(np.int64)
            sketches = [bytes(x) for x in pdf["sketch"]]
            first = np.full((len(pdf), FIRST_GROUPS), np.iinfo(np.int64).max)
            for i, groups in enumerate(pdf["first"]):
                first[i, :len(groups)] = groups
            left, right, held = [], [], 0

            def checked() -> Iterator[pd.DataFrame]:
                a, b = np.concatenate(left), np.concatenate(right)
                far = pairs_that_may_be_similar(n, sketches, a, b)
                ok = ~np.isnan(far)
                a, b, far = a[ok], b[ok], far[ok]
                fresh = ~met_before(sig, first, a, b)
                a, b, far = a[fresh], b[fresh], far[fresh]
                a, b = np.where(sid[a] < sid[b], a, b), np.where(sid[a] < sid[b], b, a)
                if len(a):
                    yield pd.DataFrame({"a": sid[a], "b": sid[b], "ca": comp[a], "cb": comp[b], "far": far})

            for s, e in zip(starts, ends):
                for i, j in pairs_between(comp, s, e):
                    left.append(i)
                    right.append(j)
                    held += len(i)
                    if held >= 8 * PAIR_BLOCK:
                        yield from checked()
                        left, right, held = [], [], 0
            if held:
                yield from checked()

    members = opened.where("not hot").select("sig", "sid", "component")
    if listed:
        members = members.unionAll(_blocks(opened.where("hot").select("sig", "sid", "component")))
    first = members.groupBy("sid").agg(F.slice(F.sort_array(F.collect_set("sig")), 1, FIRST_GROUPS).alias("first"))
    members = members.join(coarse.join(first, "sid"), "sid")
    found = materialize(_grouped(members).mapInPandas(emit, "a long, b long, ca long, cb long, far double"), "jaccard-found")
    once = materialize(found.dropDuplicates(["a", "b"]), "jaccard-rest")
    discard(found)
    return once


def _nearest(pairs: DataFrame) -> DataFrame:
    """(a, b): for each component its nearest pair of the pairs (a, b, ca, cb, far)."""
    pair = F.struct("far", "a", "b").alias("p")
    ends = pairs.select(F.col("ca").alias("c"), pair).unionAll(pairs.select(F.col("cb").alias("c"), pair))
    return ends.groupBy("c").agg(F.min("p").alias("p")).select("p.a", "p.b").distinct()


def _still_apart(pairs: DataFrame, compared: DataFrame, newer: DataFrame) -> DataFrame:
    """The pairs that were not compared and lie in different components, once
    ``newer`` joins some of theirs."""
    for c in ("ca", "cb"):
        on = newer.select(F.col("node").alias("_n"), F.col("component").alias("_c"))
        pairs = pairs.join(sent(on), F.col(c) == F.col("_n"), "left").withColumn(c, F.coalesce("_c", c)).drop("_n", "_c")
    return materialize(pairs.where("ca <> cb").join(sent(compared), ["a", "b"], "left_anti"), "jaccard-apart")


def _coarse(sets: DataFrame) -> DataFrame:
    """The sets with smaller sketches: they go with every row of a group."""
    @F.pandas_udf("binary")
    def smaller(sketches: pd.Series) -> pd.Series:
        return pd.Series([folded(x, max(8, len(x) // COARSE)).tobytes() for x in sketches], dtype=object)

    return materialize(sets.select("sid", "n_shingles", smaller("sketch").alias("sketch")), "jaccard-coarse")


def _sub_signatures(hot: DataFrame, docs: DataFrame, classes: DataFrame, level: int) -> DataFrame:
    """(sig, sid, n_shingles): the classes of hot groups (sid) under the
    signatures of a level, frequent ones last."""
    members = _elements(docs, classes, hot, "jaccard-members")
    total = members.agg(F.sum("n_shingles")).collect()[0][0] or 0  # two bands at most, each with so many signatures
    often = max(1, HOT_GROUP // 16, 2 * total // FREQUENT)

    def every(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for e in pdf["elements"]:
                for sig, _, _ in banded(np.frombuffer(e, _U), level):
                    yield pd.DataFrame({"sig": sig.view(np.int64)})

    counts = (members.select("elements").mapInPandas(every, "sig long").groupBy("sig").count()
              .where(F.col("count") > often).toPandas())
    sig, n = counts["sig"].to_numpy(np.int64).view(_U), counts["count"].to_numpy(np.int64)
    frequent = hot.sparkSession.sparkContext.broadcast((sig[np.argsort(sig)], n[np.argsort(sig)]))

    def emit(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for sid, n, e in zip(pdf["sid"], pdf["n_shingles"], pdf["elements"]):
                g = signatures(np.frombuffer(e, _U), level, frequent.value)
                yield pd.DataFrame({"sig": g.view(np.int64), "sid": np.full(len(g), sid, np.int64), "n_shingles": np.full(len(g), n, np.int64)})

    with arrow_rows(hot.sparkSession, TEXT_ROWS):
        sub = materialize(members.mapInPandas(emit, "sig long, sid long, n_shingles long"), "jaccard-sub")
    discard(members)
    return sub


def _with_components(groups: DataFrame, found: DataFrame, by: str) -> DataFrame:
    """(sig, sid, component, hot) of a group table, its column ``by`` looked up."""
    return groups.join(found, groups[by] == found["node"], "left").select(
        "sig", "sid", F.coalesce(found["component"], groups[by]).alias("component"), "hot")


def class_components(docs: DataFrame, doc_sets: DataFrame, tagged: DataFrame) -> DataFrame:
    """(node, component) of the classes that have a link.  ``doc_sets``, that is
    ``tagged`` with signatures, is removed when the groups are known, and so are
    the tables made on the way after their last reader."""
    groups, any_hot = _shared(doc_sets.select(F.explode("sigs").alias("sig"), "sid", "n_shingles"))
    discard(doc_sets)
    classes = _classes(tagged, groups.select("sid").unionAll(groups.select("leader")).distinct())
    sets = _sketches(docs, classes)
    coarse = _coarse(sets)

    def star(groups: DataFrame) -> DataFrame:
        pairs = groups.where("near").select(F.least("leader", "sid").alias("a"), F.greatest("leader", "sid").alias("b")).distinct()
        links = _links(_sketched(pairs, sets, coarse).select("a", "b", F.col("a").alias("ca"), F.col("b").alias("cb")), docs, classes)
        return connected_components(links, "ca", "cb")

    def joined(pairs: DataFrame) -> DataFrame:
        return connected_components(_links(pairs, docs, classes), "ca", "cb")

    def nearest_first(found: DataFrame, pairs: DataFrame) -> DataFrame:
        """``found`` with the links among the pairs.  While there are many for
        each component, only its nearest one is compared: copies that are
        united by it need no other."""
        for _ in range(ROUNDS):
            nearest = materialize(_nearest(pairs), "jaccard-nearest")
            if pairs.count() <= MANY * nearest.count():
                break
            newer = materialize(joined(_sketched(pairs.join(sent(nearest), ["a", "b"], "left_semi").drop("far"), _ends(sets, nearest))), "jaccard-newer")
            found, before = merged(found, newer), pairs
            pairs = _still_apart(pairs, nearest, newer)
            discard(before, nearest, newer)
        found = merged(found, joined(_sketched(pairs.drop("far"), _ends(sets, pairs))))
        discard(pairs)
        return found

    found, level, members, shared = star(groups), 0, None, groups
    while True:
        groups, rows = _with_components(shared.where("more"), found, "sid"), None
        for r in range(ROUNDS + 1):
            earlier, groups = groups, _open(groups, r, any_hot)
            discard(shared, earlier)
            before, rows = rows, groups.count()
            if not rows:
                discard(groups, classes, sets, coarse)
                return found
            if r == ROUNDS or (before and rows > STALLED * before):
                break
            pairs = (groups.where("leader is not null").groupBy(F.least("leader", "sid").alias("a"), F.greatest("leader", "sid").alias("b"))
                     .agg(F.min(F.least("component", "home")).alias("ca"), F.max(F.greatest("component", "home")).alias("cb")))
            newer = joined(_sketched(pairs, sets, coarse))
            found = merged(found, newer)
            shared, groups = groups, _with_components(groups, newer, "component")
        hot = materialize(groups.where("hot").select("sid").distinct(), "jaccard-hot-classes")
        before, members = members, hot.count() if any_hot else 0
        listed = members and (level >= MAX_LEVEL or (before is not None and members > STALLED * before))
        found = nearest_first(found, _rest(groups, coarse, listed))
        discard(groups)
        if listed or not members:
            discard(hot, classes, sets, coarse)
            return found
        level += 1
        sub = _sub_signatures(hot, docs, classes, level)
        shared, any_hot = _shared(sub)
        discard(hot, sub)
        found = connected_components(found.select("node", "component").unionAll(star(shared)), "node", "component")


def _tagged(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(doc_id, text_key, n_shingles, sid) of every row, and (sid, c): the label
    of each class's component."""
    ship(docs.sparkSession)
    with arrow_rows(docs.sparkSession, TEXT_ROWS):
        sets = materialize(document_sets(docs), "jaccard-docs")
    tagged = materialize(sets.drop("sigs"), "jaccard-tagged")
    return tagged, class_components(docs, sets, tagged)


def _labels(tagged: DataFrame, found: DataFrame, least: Column) -> DataFrame:
    """(sid, least): ``least`` over all rows of each class's component.  Rows are
    united by class first, so neither copies nor components are a hot key."""
    own = tagged.where("sid is not null").groupBy("sid").agg(least.alias("least"))
    labelled = own.join(found, own["sid"] == found["node"], "left").select("sid", "least", F.coalesce("component", "sid").alias("c"))
    labelled = materialize(labelled, "jaccard-labels")
    smallest = labelled.groupBy(F.col("c").alias("_c")).agg(F.min("least").alias("smallest"))
    out = materialize(labelled.join(smallest, F.col("c") == F.col("_c")).select("sid", F.col("smallest").alias("least")), "jaccard-least")
    discard(labelled)
    return out


def components(docs: DataFrame) -> DataFrame:
    """One row per input row: ``doc_id``, ``n_shingles``, ``component_id``.

    The component is the smallest document id that links reach; a text without
    words (or a null text) is its own.  Repeated rows and rows with equal texts
    are in one component; null ids take part, and a component of null ids only
    has a null id.  Other columns are ignored; an empty table gives an empty
    result."""
    tagged, found = _tagged(docs)
    every = join_unique(tagged, _labels(tagged, found, F.min("doc_id")), "sid")
    return every.select("doc_id", "n_shingles", F.when(F.col("sid").isNull(), F.col("doc_id")).otherwise(F.col("least")).alias("component_id"))


def keep_one(docs: DataFrame) -> DataFrame:
    """``docs`` (all its columns) with one document of each component, that of
    the smallest id, and of several texts with that id the one of the smallest
    hash; one without an id only if no document of the component has an id.
    Of repeated rows (same id and text) one stays; texts without words all
    stay.  An empty table gives an empty one, and other columns, whatever their
    names, come back as they were."""
    tagged, found = _tagged(docs)
    name = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_key")
    every = join_unique(tagged, _labels(tagged, found, F.min(name)), "sid").where("sid is not null")
    stays = materialize(every.where(F.col("least") == name).groupBy("doc_id", "text_key").agg(F.count(F.lit(1)).alias("n")), "jaccard-stays")
    gone = every.where(F.col("least") != name).select("doc_id", "text_key").distinct()
    columns = docs.columns
    rows = docs.select(F.struct(*[docs[f"`{c}`"] for c in columns]).alias("d"), docs["doc_id"].cast("long").alias("k_id"),
                       F.xxhash64(F.coalesce(docs["text"], F.lit(""))).alias("k_text"))
    same = F.col("k_id").eqNullSafe(F.col("doc_id")) & (F.col("k_text") == F.col("text_key"))
    left = rows.join(sent(materialize(gone, "jaccard-gone")), same, "left_anti")
    repeated = materialize(stays.where("n > 1").select("doc_id", "text_key"), "jaccard-repeated")
    if not repeated.limit(1).count():
        return left.select("d.*")
    repeated = sent(repeated)
    once = left.join(repeated, same, "left_semi").dropDuplicates(["k_id", "k_text"])
    return left.join(repeated, same, "left_anti").unionAll(once).select("d.*")
