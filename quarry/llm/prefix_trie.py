"""Prefix trie of conversations by truncation peeling.

A conversation's path is the concatenation of one 20-byte element per turn:
16 bytes of the SHA-256 of its role and text, and the text's length in code
points.  Equal path prefixes are equal turn sequences, and cutting the last 20
bytes strips the last turn; texts are never shuffled.

Peeling starts at the greatest depth: conversations that end there are merged
with the nodes that survive from below, every finished node adds its counts to
the node that its path without the last turn names, and so on up to the root.
Members, children, leaves and savings are all sums that flow upwards, so one
pass finds the nodes and their figures.

It runs on sorted ranges of the paths.  In such a range every node that is no
prefix of the first or the last path lies wholly inside and is finished there;
the others (two spines, at most two nodes a turn) stay open and are peeled
again, as part of a wider range, until one range holds them all.  So a task
holds one block of paths and two spines, the number of rounds depends on the
number of ranges and not on the depth, and a first turn that a third of all
conversations share is no hot key.  Equal paths are united before the ranges
are cut.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from quarry.llm.common import crc32_sql, ship, shuffle_partitions
from quarry.session import materialize

ELEMENT = 20          # bytes of a path for each turn
ID_BLOCK = 4096       # conversation ids in one piece of a member list
BLOCK_BYTES = 24 << 20  # of path prefixes that one block of a task may make
FAN_IN = 32           # ranges whose spines one range of the next round takes
BROADCAST_PARENTS = 100_000  # spine nodes sent to every executor at most

NODE = "node"
OPEN = "open"
_SCHEMA = ("kind string, path binary, key binary, parent_key binary, conv_id long, depth long, parent_conv_id long, n_convs long, "
           "n_children long, n_leaves long, saved_tokens long, ends_sha256 string")
_ARROW = pa.schema([("kind", pa.string()), ("path", pa.binary()), ("key", pa.binary()), ("parent_key", pa.binary()), ("conv_id", pa.int64()),
                    ("depth", pa.int64()), ("parent_conv_id", pa.int64()), ("n_convs", pa.int64()), ("n_children", pa.int64()),
                    ("n_leaves", pa.int64()), ("saved_tokens", pa.int64()), ("ends_sha256", pa.string())])
COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
NO_MEMBERS = hashlib.sha256(b"").hexdigest()


def turn_element(role: Column, text: Column) -> Column:
    """A turn's path element as 40 hexadecimal digits (null role or text: empty)."""
    role, text = F.coalesce(role, F.lit("")), F.coalesce(text, F.lit(""))
    digest = F.sha2(F.concat(F.length(role).cast("string"), F.lit(":"), role, text), 256)
    return F.concat(F.substring(digest, 1, 32), F.lpad(F.hex(F.length(text).cast("long")), 8, "0"))


def elements(turns: DataFrame) -> DataFrame:
    """(conv_id, elements): one row per conversation, its turns' elements by
    ``turn``, null first; turns of one number stand in order of their element.
    Rows without a conv_id belong to no conversation and are left out; other
    columns are ignored."""
    rows = turns.where("conv_id is not null").select("conv_id", "turn", turn_element(F.col("role"), F.col("text")).alias("element"))
    return (rows.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("turn", "element"))).alias("t"))
            .select("conv_id", F.col("t.element").alias("elements")))


def paths(conversations: DataFrame) -> DataFrame:
    """(conv_id, path) of ``elements`` rows."""
    return conversations.select("conv_id", F.unhex(F.array_join("elements", "")).alias("path"))


def rebuilt(turns: DataFrame) -> DataFrame:
    """The elements of every conversation after its opening was replaced: the
    first h turns of conversation c - c % 100, then its own after its first h,
    with h = crc32(decimal c) % 6."""
    own = elements(turns)
    base = elements(turns.where("conv_id % 100 = 0")).select(F.col("conv_id").alias("base_id"),
                                                            F.slice("elements", 1, 5).alias("opening"))
    h = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % 6).cast("int")
    both = own.join(base, F.col("conv_id") - F.col("conv_id") % 100 == F.col("base_id"), "left")
    opening = F.coalesce(F.slice("opening", F.lit(1), h), F.array().cast("array<string>"))
    rest = F.slice("elements", h + 1, F.greatest(F.size("elements") - h, F.lit(0)))
    return both.select("conv_id", F.concat(opening, rest).alias("elements"))


def _member_pieces(conversations: DataFrame) -> DataFrame:
    """Conversations with one path as pieces of their ascending id list, each of
    at most ``ID_BLOCK`` ids: no task ever collects all members of a path."""
    ids = F.sort_array(F.collect_list("conv_id"))
    return (conversations.withColumn("block", F.floor(F.col("conv_id") / ID_BLOCK)).groupBy("path", "block")
            .agg(ids.alias("ids"))
            .select("path", "block", F.col("ids")[0].alias("conv_id"), F.size("ids").cast("long").alias("n"),
                    F.array_join(F.col("ids").cast("array<string>"), ",").alias("ids")))


def _key(path: bytes) -> bytes:
    return hashlib.blake2b(path, digest_size=16).digest()


class _Partial:
    """What is known of a node so far: only finished children are counted."""

    __slots__ = ("conv_id", "n", "children", "leaves", "saved", "ends", "opened", "finished")

    def __init__(self):
        self.conv_id, self.n, self.children, self.leaves, self.saved, self.ends, self.opened, self.finished = None, 0, 0, 0, 0, None, False, []

    def add(self, conv_id, n, children, leaves, saved, ends=None, opened=False):
        if conv_id is not None and (self.conv_id is None or conv_id < self.conv_id):
            self.conv_id = conv_id
        self.n += n
        self.children += children
        self.leaves += leaves
        self.saved += saved
        self.ends = ends or self.ends
        self.opened |= opened


def peel(items: list[tuple], first: bytes, last: bytes, top: bool) -> tuple[list[tuple], list[tuple]]:
    """(rows of finished nodes, items of open nodes) of one sorted range.

    ``items`` are (path, conv_id, n, children, leaves, saved, ends, opened):
    newly ended conversations, or open nodes of narrower ranges.  ``first`` and
    ``last`` are the range's outermost paths; at the ``top`` nothing is open.
    Children that finish before their parent carry its key, and a node that
    was open once carries its own."""
    levels: dict[int, list[tuple]] = {}
    for item in items:
        levels.setdefault(len(item[0]), []).append(item)
    rows, still_open, alive = [], [], {}
    size = max(levels)
    while size >= 0:
        for path, *figures in levels.pop(size, ()):
            alive.setdefault(path, _Partial()).add(*figures)
        stripped: dict[bytes, _Partial] = {}
        spines = () if top else (first[:size], last[:size])
        for path, node in alive.items():
            if path in spines:
                still_open.append((path, node.conv_id, node.n, node.children, node.leaves, node.saved, node.ends, True))
                key = _key(path) if node.finished else None
                rows.extend((NODE, None, own, key, conv_id, depth, None, *rest) for own, conv_id, depth, rest in node.finished)
                continue
            rows.extend((NODE, None, own, None, conv_id, depth, node.conv_id, *rest) for own, conv_id, depth, rest in node.finished)
            length = int.from_bytes(path[-4:], "big") if size else 0
            leaves, saved = node.leaves if node.children else 1, node.saved + (node.n - 1) * length
            row = (_key(path) if node.opened else None, node.conv_id, size // ELEMENT, (node.n, node.children, leaves, saved, node.ends or NO_MEMBERS))
            if size:
                parent = stripped.setdefault(path[:-ELEMENT], _Partial())
                parent.add(node.conv_id, node.n, 1, leaves, saved)
                parent.finished.append(row)
            else:
                rows.append((NODE, None, row[0], None, row[1], row[2], None, *row[3]))
        alive, size = stripped, size - ELEMENT
    return rows, still_open


def _batches(rows: list[tuple], per: int = 20_000) -> Iterator[pa.RecordBatch]:
    for at in range(0, len(rows), per):
        part = list(zip(*rows[at:at + per], strict=True))
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(part, _ARROW.types, strict=True)], schema=_ARROW)


def _peel_stream(items: Iterator[tuple], top: bool, block_bytes: int) -> Iterator[pa.RecordBatch]:
    """Peels a task's sorted items block by block; the open nodes of the blocks
    so far go with the next one, so at most two spines are carried on."""
    first, carried, block, made = None, [], [], 0
    item = next(items, None)
    while item is not None:
        first = item[0] if first is None else first
        block.append(item)
        made += len(item[0]) * (len(item[0]) // ELEMENT + 1) // 2 + 400
        item, last = next(items, None), item[0]
        if item is None or made > block_bytes:
            rows, carried = peel(carried + block, first, last, top and item is None)
            yield from _batches(rows)
            block, made = [], 0
    if carried:
        yield from _batches([(OPEN, path, None, None, conv_id, None, None, n, children, leaves, saved, ends)
                             for path, conv_id, n, children, leaves, saved, ends, _ in carried])


def _ended(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """One item per path from its id pieces, which come in order; the digest
    takes them one by one."""
    path = digest = conv_id = None
    n = 0
    for b in batches:
        for p, least, count, ids in zip(*(b.column(c).to_pylist() for c in ("path", "conv_id", "n", "ids")), strict=True):
            if p != path:
                if path is not None:
                    yield path, conv_id, n, 0, 0, 0, digest.hexdigest(), False
                path, conv_id, n, digest = p, least, 0, hashlib.sha256(ids.encode())
            else:
                digest.update(b"," + ids.encode())
            n += count
            conv_id = min(conv_id, least)
    if path is not None:
        yield path, conv_id, n, 0, 0, 0, digest.hexdigest(), False


def _reopened(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    names = ("path", "conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")
    for b in batches:
        for item in zip(*(b.column(c).to_pylist() for c in names), strict=True):
            yield *item, True


def trie(conversations: DataFrame, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """One row per distinct sequence of first turns, from the textless root on,
    of (conv_id, path) rows with distinct conv_ids:

    conv_id (smallest member), depth, parent_conv_id (null at the root),
    n_convs (members), n_children, n_leaves (childless nodes of the subtree),
    saved_tokens (over the subtree: members but one times the code points of
    the node's last text), ends_sha256 (SHA-256 of the ascending,
    comma-joined ids of the members that end here).

    A conversation without turns (empty path) ends at the root.  An empty table
    has no nodes, not even a root.  Each round is a written table, so a lost
    executor costs one round at most."""
    spark = conversations.sparkSession
    ship(spark)
    ranges = shuffle_partitions(spark)
    pieces = _member_pieces(conversations).repartitionByRange(ranges, "path").sortWithinPartitions("path", "block")
    top = ranges == 1
    rounds = [materialize(pieces.mapInArrow(lambda b, top=top: _peel_stream(_ended(b), top, block_bytes), _SCHEMA), "trie")]
    while not top:
        ranges = -(-ranges // FAN_IN)
        top = ranges == 1
        spines = rounds[-1].where(F.col("kind") == OPEN)
        spines = spines.coalesce(1) if top else spines.repartitionByRange(ranges, "path")
        peeled = spines.sortWithinPartitions("path").mapInArrow(lambda b, top=top: _peel_stream(_reopened(b), top, block_bytes), _SCHEMA)
        rounds.append(materialize(peeled, "trie-spines"))
    nodes = rounds[0]
    for r in rounds[1:]:
        nodes = nodes.unionByName(r)
    nodes = nodes.where(F.col("kind") == NODE)
    parents = nodes.where("key is not null").select(F.col("key").alias("parent_key"), F.col("conv_id").alias("found"))
    if parents.limit(BROADCAST_PARENTS + 1).count() <= BROADCAST_PARENTS:
        parents = F.broadcast(parents)
    return (nodes.join(parents, "parent_key", "left").withColumn("parent_conv_id", F.coalesce("parent_conv_id", "found"))
            .select(*COLUMNS))


def prefix_trie(turns: DataFrame) -> DataFrame:
    """The trie of (conv_id, turn, role, text) rows as they are."""
    return trie(paths(elements(turns)))


def report(turns: DataFrame) -> DataFrame:
    """The trie of the conversations with rebuilt openings (see ``rebuilt``).

    Null role or text counts as empty; rows without a conv_id are left out;
    repeated rows are turns of their own; an empty table gives no rows; other
    columns are ignored."""
    return trie(paths(rebuilt(turns)))


def oracle_sql() -> str:
    """DuckDB SQL of ``report``: nodes from all prefixes of all rebuilt
    conversations, subtree sums by joining every node with its own prefixes."""
    crc = crc32_sql("conv_id::VARCHAR")
    return f"""
WITH turns AS (
  SELECT conv_id, turn, length(coalesce(text, '')) AS chars,
         sha256(length(coalesce(role, ''))::VARCHAR || ':' || coalesce(role, '') || coalesce(text, ''))[1:32]
         || lpad(upper(hex(length(coalesce(text, '')))), 8, '0') AS element
  FROM conversations WHERE conv_id IS NOT NULL),
own AS (
  SELECT conv_id, list(element ORDER BY turn NULLS FIRST, element) AS e, {crc} % 6 AS h FROM turns GROUP BY conv_id),
rebuilt AS (
  SELECT o.conv_id, list_concat(coalesce(b.e[1:o.h], []), o.e[o.h + 1:]) AS e
  FROM own o LEFT JOIN own b ON b.conv_id = o.conv_id - o.conv_id % 100),
prefixes AS (
  SELECT conv_id, len(e) AS n, d, array_to_string(e[1:d], '') AS path, array_to_string(e[1:d - 1], '') AS above
  FROM rebuilt, unnest(range(0, len(e) + 1)) AS u(d)),
nodes AS (
  SELECT path, d, any_value(CASE WHEN d > 0 THEN above END) AS above, min(conv_id) AS conv_id, count(*) AS n_convs,
         (count(*) - 1) * CASE WHEN d = 0 THEN 0 ELSE ('0x' || right(path, 8))::BIGINT END AS saved,
         sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (WHERE n = d), '')) AS ends_sha256
  FROM prefixes GROUP BY path, d),
children AS (SELECT above, count(*) AS n FROM nodes WHERE above IS NOT NULL GROUP BY above),
subtrees AS (
  SELECT left(x.path, 40 * k) AS path, sum(x.saved) AS saved, sum(CASE WHEN c.n IS NULL THEN 1 ELSE 0 END) AS leaves
  FROM nodes x LEFT JOIN children c ON c.above = x.path, unnest(range(0, x.d + 1)) AS u(k) GROUP BY 1)
SELECT x.conv_id, x.d::BIGINT AS depth, p.conv_id AS parent_conv_id, x.n_convs, coalesce(c.n, 0)::BIGINT AS n_children,
       s.leaves::BIGINT AS n_leaves, s.saved::BIGINT AS saved_tokens, x.ends_sha256
FROM nodes x JOIN subtrees s USING (path) LEFT JOIN children c ON c.above = x.path LEFT JOIN nodes p ON p.path = x.above
"""
