"""Conversation structure repair by Knuth's lightest-derivation agenda.

A conversation's rows, in order, are edited at the least cost until their role
initials read ``(s?(ua)+)?``: keep a row (0), give it the role user or
assistant (1), delete it (2; blank and duplicate rows must go), insert an empty
user or assistant turn (5); a truncated row that stays costs 5 more.  Among the
cheapest edits the ASCII-least string of their initials (D, I, K, R) wins.

Repair is deduction over a weighted hypergraph.  Items are ``(i, state)``: the
first i rows are dealt with and the output so far is empty, ``s``, or ends in
``u`` or ``a``.  A deduction joins such an item with an axiom, one edit of row
i or one insertion, to the next item.  Weights are (cost, audit), and a
deduction adds the costs and appends the initial.  That is superior (a
conclusion is never lighter than a premise: the cost does not fall and the audit
grows) and monotone (two audits of one item with equal cost are never prefixes
of one another, as insertions are not free), so the agenda's lightest item is
final when it is popped, and the search ends when a goal item, all rows dealt
with and the output empty or ending in ``a``, is popped.

Rows of a conversation meet in one task, sorted, each twice: first all of them
without text (a code and a digest), for which the edits are found, then with
text, which is written out row by row.  No task holds a conversation's texts,
and audits are shared as a tree.
"""

from __future__ import annotations

import functools
import hashlib
import heapq
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from quarry.llm.common import crc32_sql, ship, shuffle_partitions

DELETE, INSERT, KEEP, REROLE = "D", "I", "K", "R"
ROLES = {"u": "user", "a": "assistant"}
#: Which initial may follow which end of the output; "" is the empty output.
FOLLOWS = {"": "su", "s": "u", "u": "a", "a": "u"}
GOALS = ("", "a")
REROLE_COST, DELETE_COST, INSERT_COST, TRUNCATED_COST = 1, 2, 5, 5

BLANK, DUPLICATE, TRUNCATED = "blank", "duplicate", "truncated"

_REPAIRED = ("conv_id long, position long, edit string, role string, text string, gaps long, blank long, duplicate long, truncated long, "
             "illegal long, cost long, audit string")
_REPAIRED_ARROW = pa.schema([("conv_id", pa.int64()), ("position", pa.int64()), ("edit", pa.string()), ("role", pa.string()),
                             ("text", pa.string()), ("gaps", pa.int64()), ("blank", pa.int64()), ("duplicate", pa.int64()),
                             ("truncated", pa.int64()), ("illegal", pa.int64()), ("cost", pa.int64()), ("audit", pa.string())])
FIGURES = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit"]
OUT_CHARS = 4 << 20  # of text in one batch


class Audit:
    """An edit string as a node of a tree: its last letter and what stands before.

    ``jump`` is a far ancestor (skew-binary steps), so two audits find where
    they part in logarithmic time and share all that stands before it."""

    __slots__ = ("before", "letter", "length", "jump")

    def __init__(self, before: Audit | None = None, letter: str = ""):
        self.before, self.letter = before, letter
        if before is None:
            self.length, self.jump = 0, self
            return
        self.length, far = before.length + 1, before.jump
        self.jump = far.jump if before.length - far.length == far.length - far.jump.length else before

    def cut(self, length: int) -> Audit:
        node = self
        while node.length > length:
            node = node.jump if node.jump.length >= length else node.before
        return node

    def __lt__(self, other: Audit) -> bool:
        a, b = self.cut(other.length), other.cut(self.length)
        if a is b:
            return self.length < other.length
        while a.before is not b.before:
            if a.jump is not b.jump:
                a, b = a.jump, b.jump
            else:
                a, b = a.before, b.before
        return a.letter < b.letter

    def __str__(self) -> str:
        letters, node = [], self
        while node.length:
            letters.append(node.letter)
            node = node.before
        return "".join(reversed(letters))


def _edits(initial: str, fault: str) -> list[tuple[str, int, str]]:
    """Axioms of one row: (initial of the output or "", cost, edit)."""
    edits = [("", DELETE_COST, DELETE)]
    if fault not in (BLANK, DUPLICATE):
        more = TRUNCATED_COST if fault == TRUNCATED else 0
        edits += [(initial, more, KEEP)] if initial else []
        edits += [(r, more + REROLE_COST, REROLE) for r in ROLES]
    return edits


def lightest(rows: tuple[tuple[str, str], ...]) -> tuple[int, str]:
    """(cost, audit) of the lightest repair of rows (role initial, fault)."""
    n = len(rows)
    axioms = [_edits(*row) for row in rows]
    insertions = [(r, INSERT_COST, INSERT) for r in ROLES]
    final, made = set(), 0
    agenda = [(0, Audit(), made, 0, "")]
    while agenda:  # an audit names its item, so each node of the tree gets its children once
        cost, audit, _, i, state = heapq.heappop(agenda)
        if (i, state) in final:
            continue
        final.add((i, state))
        if i == n and state in GOALS:
            return cost, str(audit)
        for step, edits in ((1, axioms[i] if i < n else ()), (0, insertions)):
            for initial, price, edit in edits:
                if initial and initial not in FOLLOWS[state]:
                    continue
                item = (i + step, initial or state)
                if item not in final:
                    made += 1
                    heapq.heappush(agenda, (cost + price, Audit(audit, edit), made, *item))
    raise AssertionError("deleting all rows is always a repair")


#: Short conversations repeat the same initials and faults over and over.
_known = functools.lru_cache(maxsize=20_000)(lightest)


def _solve(rows: list[tuple[str, str]]) -> tuple[int, str]:
    return _known(tuple(rows)) if len(rows) <= 16 else lightest(tuple(rows))


def first_fault(text: Column) -> Column:
    """``blank`` or ``truncated``, whichever a text alone shows, else null."""
    return (F.when(~text.rlike(r"[^\x20\x09-\x0D]"), BLANK)
            .when(~text.rlike(r"[.!?][\x20\x09-\x0D]*\z"), TRUNCATED))


def _lines(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    for b in batches:
        yield from zip(*(b.column(c).to_pylist() for c in ("conv_id", "with_text", "turn", "role", "fault", "digest", "absent", "text")), strict=True)


class _Conversation:
    """What the rows without text tell of one conversation."""

    def __init__(self, conv_id):
        self.conv_id, self.rows, self.seen, self.turns = conv_id, [], set(), set()
        self.counts, self.illegal, self.before = {BLANK: 0, DUPLICATE: 0, TRUNCATED: 0}, 0, None

    def add(self, turn, role, fault, digest):
        if fault != BLANK and digest in self.seen:
            fault = DUPLICATE
        self.seen.add(digest)
        if turn is not None:
            self.turns.add(turn)
        if fault:
            self.counts[fault] += 1
        initial = role[:1]
        if self.before is not None and self.before + initial not in ("su", "ua", "au"):
            self.illegal += 1
        self.before = initial
        self.rows.append((initial, fault))

    def header(self) -> tuple:
        gaps = max(self.turns) - min(self.turns) + 1 - len(self.turns) if self.turns else 0
        cost, audit = _solve(self.rows)
        return (self.conv_id, 0, None, None, None, gaps, *self.counts.values(), self.illegal, cost, audit)


def _apply(conv_id, audit: str, texts: Iterator[tuple[str, str]]) -> Iterator[tuple]:
    """The repaired turns: the rows' (role, text), in order, edited."""
    position, end = 0, ""
    for edit in audit:
        role, text = next(texts) if edit != INSERT else (None, "")
        if edit == DELETE:
            continue
        if edit != KEEP:
            role = ROLES["a" if end == "u" else "u"]
        position, end = position + 1, role[:1]
        yield (conv_id, position, edit, role, text, *[None] * len(FIGURES))


def _repaired(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    lines = _lines(batches)
    line = next(lines, None)

    def rows_of(conv_id) -> Iterator[tuple]:
        nonlocal line
        known = _Conversation(conv_id)
        while line is not None and line[0] == conv_id and not line[1]:
            if not line[6]:
                known.add(*line[2:6])
            line = next(lines, None)
        known.seen.clear()
        header = known.header()
        yield header

        def texts():
            nonlocal line
            while line is not None and line[0] == conv_id and line[1]:
                row = (line[3], line[7])
                line = next(lines, None)
                yield row

        rest = texts()
        yield from _apply(conv_id, header[-1], rest)
        assert next(rest, None) is None

    out, chars = [], 0
    while line is not None:
        for row in rows_of(line[0]):
            out.append(row)
            chars += 100 + len(row[4] or "")
            if chars > OUT_CHARS:
                yield _batch(out)
                out, chars = [], 0
    if out:
        yield _batch(out)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), _REPAIRED_ARROW.types, strict=True)],
                                      schema=_REPAIRED_ARROW)


def repair(turns: DataFrame, order: str | None = None, absent: str | None = None) -> DataFrame:
    """Every conversation of (conv_id, turn, role, text) rows, repaired.

    Position 0 is a conversation's header, with gaps, the counts of rows whose
    first fault is blank, duplicate or truncated, illegal (neighbouring role
    initials other than su, ua, au), cost and audit.  Positions 1 and on are
    the repaired turns with their edit, role and text; deleted rows have none.

    Rows stand by ``turn``, null first, then by the column named by ``order``
    if given, then by the SHA-256 of role and text.  Null role or text counts
    as one space.  Rows whose column named by ``absent`` is true only make sure
    that their conversation is returned.  Rows without a conv_id form one
    conversation.  A row with an empty role has no initial and is never kept as
    it is.  An empty table gives no rows; other columns are ignored."""
    ship(turns.sparkSession)
    role, text = F.coalesce("role", F.lit(" ")), F.coalesce("text", F.lit(" "))
    place = F.col(order) if order else F.lit("")
    gone = F.coalesce(F.col(absent), F.lit(False)) if absent else F.lit(False)
    rows = turns.select("conv_id", "turn", role.alias("role"), text.alias("text"), place.alias("place"), gone.alias("absent"),
                        first_fault(text).alias("fault"),
                        F.unhex(F.sha2(F.concat(F.length(role).cast("string"), F.lit(":"), role, text), 256)).alias("digest"))
    twice = rows.select("conv_id", F.explode(F.when(F.col("absent"), F.array(F.lit(False))).otherwise(F.array(F.lit(False), F.lit(True))))
                        .alias("with_text"), "turn", "role", "place", "fault", "digest", "absent", "text")
    told = twice.withColumn("text", F.when(F.col("with_text"), F.col("text"))).withColumn("fault", F.when(~F.col("with_text"), F.col("fault")))
    placed = (told.repartition(shuffle_partitions(turns.sparkSession), "conv_id")
              .sortWithinPartitions("conv_id", "with_text", F.asc_nulls_first("turn"), F.asc_nulls_first("place"), "digest"))
    return placed.mapInArrow(_repaired, _REPAIRED)


def damaged(turns: DataFrame) -> DataFrame:
    """The rows with a fault each by crc32("conv_id:turn") % 20: 0 drops the row
    (it stays, marked ``dropped``), 1 empties its text, 2 takes its ``.!?``, 3 repeats
    it next to itself, 4 makes its role user.  Nulls become one space."""
    space = F.lit(" ")
    role, text = F.coalesce("role", space), F.coalesce("text", space)
    name = F.concat(F.coalesce(F.col("conv_id").cast("string"), space), F.lit(":"), F.coalesce(F.col("turn").cast("string"), space))
    kind = F.crc32(name.cast("binary")) % 20
    rows = turns.select("conv_id", "turn", kind.alias("kind"), role.alias("role"), text.alias("text"),
                        F.sha2(F.concat(F.length(role).cast("string"), F.lit(":"), role, text), 256).alias("place"))
    copies = F.when(F.col("kind") == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
    return rows.select("conv_id", "turn", F.when(F.col("kind") == 4, "user").otherwise(F.col("role")).alias("role"),
                       F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.regexp_replace("text", "[.!?]", ""))
                       .otherwise(F.col("text")).alias("text"),
                       (F.col("kind") == 0).alias("dropped"), "place", F.explode(copies).alias("copy")).drop("copy")


_REPORT = ("conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, "
           "repaired_sha256 string")
_REPORT_ARROW = pa.schema([(c, pa.string() if c in ("audit", "repaired_sha256") else pa.int64())
                           for c in ("conv_id", *FIGURES, "repaired_sha256")])


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per conversation from its header and its repaired turns, in order."""
    header = digest = None

    def batch(rows):
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), _REPORT_ARROW.types, strict=True)],
                                          schema=_REPORT_ARROW)

    for b in batches:
        done, columns = [], [b.column(c).to_pylist() for c in ("conv_id", "position", "role", "text", *FIGURES)]
        for conv_id, position, role, text, *figures in zip(*columns, strict=True):
            if not position:
                if header:
                    done.append((*header, digest.hexdigest()))
                header, digest = (conv_id, *figures), hashlib.sha256()
            else:
                digest.update(("\n" if position > 1 else "").encode() + f"{role}:{text}".encode())
        if done:
            yield batch(done)
    if header:
        yield batch([(*header, digest.hexdigest())])


def report(turns: DataFrame) -> DataFrame:
    """Per conversation the figures of its ``damaged`` rows, its audit, and the
    SHA-256 of its repaired ``role:text`` lines.  A conversation that lost all
    its rows has zeros, an empty audit and the empty string's hash.  For nulls,
    repeated rows, empty tables and other columns see ``repair``."""
    return repair(damaged(turns), order="place", absent="dropped").mapInArrow(_digests, _REPORT)


def oracle_sql() -> str:
    """DuckDB SQL of ``report``: a recursion over the rows keeps the least
    weight (cost, then audit, as one text) of each end of the output."""
    name = "(coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' '))"

    def add(weight: str, price: str, edit: str) -> str:
        return f"(lpad((left({weight}, 9)::BIGINT + {price})::VARCHAR, 9, '0') || substr({weight}, 10) || '{edit}')"

    def inserted(e: str, s: str, u: str, a: str) -> str:
        return f"least({u}, {add(f'least({e}, {s}, {a})', '5', INSERT)})"

    return f"""
WITH RECURSIVE source AS (
  SELECT conv_id, turn, {crc32_sql(name)} % 20 AS kind, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
         sha256(length(coalesce(role, ' '))::VARCHAR || ':' || coalesce(role, ' ') || coalesce(text, ' ')) AS place
  FROM conversations),
hurt AS (
  SELECT conv_id, turn, place, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
         CASE kind WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text
  FROM source, unnest(CASE WHEN kind = 3 THEN [1, 2] ELSE [1] END) WHERE kind <> 0),
numbered AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) AS seen FROM (
    SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, place) AS i FROM hurt) AS ordered),
told AS (
  SELECT *, left(role, 1) AS initial, coalesce(lag(left(role, 1)) OVER (PARTITION BY conv_id ORDER BY i), '-') || left(role, 1) AS pair,
         CASE WHEN NOT regexp_matches(text, '[^\\x20\\x09-\\x0D]') THEN 'blank' WHEN seen > 1 THEN 'duplicate'
              WHEN NOT regexp_matches(text, '[.!?][\\x20\\x09-\\x0D]*\\z') THEN 'truncated' ELSE '' END AS fault FROM numbered),
figures AS (
  SELECT conv_id, count(*) AS n, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
         count(*) FILTER (WHERE fault = 'blank') AS blank, count(*) FILTER (WHERE fault = 'duplicate') AS duplicate,
         count(*) FILTER (WHERE fault = 'truncated') AS truncated,
         count(*) FILTER (WHERE i > 1 AND pair NOT IN ('su', 'ua', 'au')) AS illegal FROM told GROUP BY conv_id),
ends AS (
  SELECT conv_id, 0::BIGINT AS i, '000000000' AS e, NULL::VARCHAR AS s, '000000005I' AS u, '000000010II' AS a FROM figures
  UNION ALL
  SELECT conv_id, i, e, s, u, least(a, {add('u', '5', INSERT)}) AS a FROM (
    SELECT conv_id, i, e, s, {inserted('e', 's', 'u', 'a')} AS u, a FROM (
      SELECT x.conv_id, t.i, {add('e', '2', DELETE)} AS e,
             least({add('s', '2', DELETE)}, CASE WHEN kept AND initial = 's' THEN {add('e', 'more', KEEP)} END) AS s,
             least({add('u', '2', DELETE)}, CASE WHEN kept AND initial = 'u' THEN {add('least(e, s, a)', 'more', KEEP)} END,
                   CASE WHEN kept THEN {add('least(e, s, a)', '(more + 1)', REROLE)} END) AS u,
             least({add('a', '2', DELETE)}, CASE WHEN kept AND initial = 'a' THEN {add('u', 'more', KEEP)} END,
                   CASE WHEN kept THEN {add('u', '(more + 1)', REROLE)} END) AS a
      FROM ends x JOIN (SELECT *, fault NOT IN ('blank', 'duplicate') AS kept, CASE fault WHEN 'truncated' THEN 5 ELSE 0 END AS more
                        FROM told) t ON t.conv_id IS NOT DISTINCT FROM x.conv_id AND t.i = x.i + 1) AS without_insertion) AS without_a),
best AS (
  SELECT f.conv_id, left(least(e, a), 9)::BIGINT AS cost, substr(least(e, a), 10) AS audit
  FROM figures f JOIN ends x ON x.conv_id IS NOT DISTINCT FROM f.conv_id AND x.i = f.n),
letters AS (
  SELECT conv_id, k, substr(audit, k, 1) AS edit, length(replace(left(audit, k), 'I', '')) AS i,
         length(replace(left(audit, k), 'D', '')) AS position
  FROM best, unnest(range(1, length(audit) + 1)) AS u(k)),
lines AS (
  SELECT l.*, t.role, t.text, max(CASE WHEN edit = 'K' AND initial = 's' THEN 1 ELSE 0 END) OVER (PARTITION BY l.conv_id) AS shift
  FROM letters l LEFT JOIN told t ON t.conv_id IS NOT DISTINCT FROM l.conv_id AND t.i = l.i AND edit <> 'I' WHERE edit <> 'D'),
written AS (
  SELECT conv_id, string_agg(CASE WHEN edit = 'K' THEN role WHEN (position - shift) % 2 = 1 THEN 'user' ELSE 'assistant' END
                             || ':' || coalesce(text, ''), chr(10) ORDER BY position) AS repaired FROM lines GROUP BY conv_id)
SELECT o.conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
       coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, coalesce(cost, 0) AS cost, coalesce(audit, '') AS audit,
       sha256(coalesce(repaired, '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) o LEFT JOIN figures f ON f.conv_id IS NOT DISTINCT FROM o.conv_id
     LEFT JOIN best b ON b.conv_id IS NOT DISTINCT FROM o.conv_id LEFT JOIN written w ON w.conv_id IS NOT DISTINCT FROM o.conv_id
"""
