"""Operators on conversations: brute force, round trips, odd rows."""

import hashlib
import itertools
import random
import zlib
from collections import defaultdict

import pytest
from hypothesis import given, settings, strategies as st

from quarry.llm import chat_format as C, prefix_trie as P, turn_repair as R

TURNS = "conv_id long, turn long, role string, text string, element string, path binary, depth int, fault string, place int, absent string, order long"


def table(spark, rows):
    """Turn rows with extra columns whose names the operators use."""
    return spark.createDataFrame([(*r, "e", b"p", 1, "f", 2, "a", 3) for r in rows], TURNS)


@pytest.fixture(scope="module")
def odd_rows():
    """Nulls everywhere, empty and very long texts, ties, repeated rows, a
    conversation of many turns, and one that loses all its rows to the damage."""
    long_text = "word, " * 100_000 + "end."
    rows = [(1, 0, "user", "Hi."), (1, 1, "assistant", "Yes."), (1, 1, "assistant", "Yes."), (1, None, "system", "Be good."),
            (2, 0, None, None), (2, 1, "assistant", ""), (3, 0, "user", long_text), (3, 1, "assistant", long_text), (3, 1, "assistant", "x"),
            (None, 0, "user", "Lost?"), (None, 1, "assistant", "No."), (4, 0, "", "no role."), (4, 1, "tool", "[ROLE]x[TEXT]<s>"),
            (100, 0, "user", "Hi."), (100, 1, "assistant", "Yes."), (101, 0, "user", "<|image|> </s> \\[INST]"), (199, 5, "user", " \n ")]
    rows += [(7, t, "user" if t % 2 == 0 else "assistant", f"turn {t % 37}.") for t in range(700)]
    rows += [(c, t, "user" if t % 2 == 0 else "assistant", f"{'same' if c % 3 else c} {t}.") for c in range(200, 330) for t in range(c % 7)]
    return rows


# --- op11


def naive_trie(rebuilt):
    """Nodes of {conv_id: [(role, text), ...]} from all prefixes."""
    members = defaultdict(list)
    for c, turns in rebuilt.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
    children = defaultdict(list)
    for p in members:
        if p:
            children[p[:-1]].append(p)
    leaves, saved = {}, {}
    for p in sorted(members, key=len, reverse=True):
        below = children[p]
        leaves[p] = sum(leaves[x] for x in below) or 1
        saved[p] = sum(saved[x] for x in below) + (len(members[p]) - 1) * (len(p[-1][1]) if p else 0)
    ends = {p: ",".join(str(c) for c in sorted(m) if len(rebuilt[c]) == len(p)) for p, m in members.items()}
    return sorted(str((min(m), len(p), min(members[p[:-1]]) if p else None, len(m), len(children[p]), leaves[p], saved[p],
                       hashlib.sha256(ends[p].encode()).hexdigest())) for p, m in members.items())


def ordered(rows):
    """{conv_id: [(role, text), ...]}, ties by the operator's stated order."""
    def element(role, text):
        return hashlib.sha256(f"{len(role)}:{role}{text}".encode()).hexdigest()[:32] + f"{len(text):08X}"

    found = defaultdict(list)
    for c, t, role, text in rows:
        if c is not None:
            role, text = role or "", text or ""
            found[c].append(((t is not None, t or 0, element(role, text)), (role, text)))
    return {c: [x for _, x in sorted(v)] for c, v in found.items()}


def naive_rebuilt(rows):
    own = ordered(rows)
    out = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 6
        out[c] = own.get(c - c % 100, [])[:h] + turns[h:]
    return out


def test_trie_of_rebuilt_conversations(spark, odd_rows):
    got = P.report(table(spark, odd_rows).repartition(7))
    assert got.columns == P.COLUMNS
    assert sorted(str(tuple(r)) for r in got.collect()) == naive_trie(naive_rebuilt(odd_rows))


@pytest.mark.parametrize("ranges,block", [(1, 2_000), (4, 2_000), (70, 3_000), (5, P.BLOCK_BYTES)])
def test_trie_in_many_ranges_and_blocks(spark, ranges, block):
    rng = random.Random(ranges)
    rows = [(c, t, "user", f"{rng.randrange(2) if t else 0}.") for c in range(400) for t in range(rng.choice([0, 1, 3, 6, 9]))]
    rows += [(c, t, "user", "0." if t < 30 else f"{c}") for c in (500, 501) for t in range(60)]
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", ranges)
    try:
        turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
        got = P.trie(P.paths(P.elements(turns)), block_bytes=block).collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert sorted(str(tuple(r)) for r in got) == naive_trie(ordered(rows))


def test_members_are_listed_in_pieces(spark):
    """A path with more members than one piece holds, ids of several lengths."""
    n = 3 * P.ID_BLOCK + 5
    got = P.trie(spark.range(n).selectExpr("id as conv_id", "cast('' as binary) as path")).collect()
    assert len(got) == 1 and got[0].n_convs == n
    assert got[0].ends_sha256 == hashlib.sha256(",".join(map(str, range(n))).encode()).hexdigest()


def test_trie_of_nothing(spark):
    assert P.report(table(spark, [])).count() == 0
    assert P.report(table(spark, [(None, 0, "user", "x")])).count() == 0


# --- op12


def plain_repair(rows):
    """(cost, audit) by a dynamic program over whole strings, rows being
    (initial, fault); independent of the agenda."""
    def best(*options):
        return min((o for o in options if o is not None), default=None)

    def add(w, cost, letter):
        return None if w is None else (w[0] + cost, w[1] + letter)

    def close(w):
        w = dict(w)
        for _ in range(2):
            w["u"] = best(w["u"], *(add(w[q], 5, "I") for q in ("", "s", "a")))
            w["a"] = best(w["a"], add(w["u"], 5, "I"))
        return w

    w = close({"": (0, ""), "s": None, "u": None, "a": None})
    for initial, fault in rows:
        new = {q: add(w[q], 2, "D") for q in w}
        if fault not in ("blank", "duplicate"):
            more = 5 if fault == "truncated" else 0
            for q, after in (("", "s"), ("", "u"), ("s", "u"), ("a", "u"), ("u", "a")):
                if initial == after:
                    new[after] = best(new[after], add(w[q], more, "K"))
                if after != "s":
                    new[after] = best(new[after], add(w[q], more + 1, "R"))
        w = close(new)
    return best(w[""], w["a"])


FAULTS = st.sampled_from([None, None, "blank", "duplicate", "truncated"])


@settings(max_examples=300, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(["s", "u", "a", "t", ""]), FAULTS), max_size=12))
def test_agenda_against_dynamic_program(rows):
    assert R.lightest(tuple(rows)) == plain_repair(rows)


def test_agenda_against_all_edit_strings():
    """Every string of edits up to a length, tried one by one."""
    for n in range(4):
        for rows in itertools.product([("s", None), ("u", None), ("a", "truncated"), ("u", "blank")], repeat=n):
            found = []
            for m in range(n, n + 3):
                for audit in itertools.product("DIKR", repeat=m):
                    if len(audit) - audit.count("I") != n:
                        continue
                    left, end, cost = list(rows), "", 0
                    for e in audit:
                        if e == "I":
                            end, cost = ("a" if end == "u" else "u"), cost + 5
                            continue
                        initial, fault = left.pop(0)
                        if e == "D":
                            cost += 2
                            continue
                        becomes = initial if e == "K" else "a" if end == "u" else "u"
                        if fault == "blank" or becomes not in {"": "su", "s": "u", "u": "a", "a": "u"}[end]:
                            break
                        end, cost = becomes, cost + (e == "R") + 5 * (fault == "truncated")
                    else:
                        if end in ("", "a"):
                            found.append((cost, "".join(audit)))
            assert R.lightest(rows) == min(found)


def test_long_audits_are_compared_as_texts():
    rng = random.Random(1)
    nodes = [R.Audit()]
    for _ in range(400):
        before = rng.choice(nodes[-40:])
        taken = {n.letter for n in nodes if n.before is before}
        nodes += [R.Audit(before, x) for x in "DIKR" if x not in taken][:rng.randrange(1, 3)]
    for _ in range(3000):
        a, b = rng.choice(nodes), rng.choice(nodes)
        assert (a < b) == (str(a) < str(b))


def naive_repair(rows):
    """{conv_id: row of the report} by plain Python over whole conversations."""
    own = defaultdict(list)
    for c, t, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        kind = zlib.crc32(f"{' ' if c is None else c}:{' ' if t is None else t}".encode()) % 20
        place = hashlib.sha256(f"{len(role)}:{role}{text}".encode()).hexdigest()
        own[c]
        if kind == 1:
            text = ""
        if kind == 2:
            text = "".join(x for x in text if x not in ".!?")
        if kind == 4:
            role = "user"
        own[c] += [((t is not None, t or 0, place), t, role, text)] * (0 if kind == 0 else 2 if kind == 3 else 1)
    out = {}
    for c, v in own.items():
        v.sort(key=lambda r: r[0])
        seen, coded, count = set(), [], {"blank": 0, "duplicate": 0, "truncated": 0}
        for _, _, role, text in v:
            bare = text.strip(" \t\n\v\f\r")
            fault = "blank" if not bare else "duplicate" if (role, text) in seen else "truncated" if bare[-1] not in ".!?" else None
            seen.add((role, text))
            if fault:
                count[fault] += 1
            coded.append((role[:1], fault))
        turns = {r[1] for r in v} - {None}
        illegal = sum(a[0] + b[0] not in ("su", "ua", "au") for a, b in zip(coded, coded[1:]))
        cost, audit = plain_repair(coded)
        lines, left, end = [], [r[2:] for r in v], ""
        for e in audit:
            role, text = ("", "") if e == "I" else left.pop(0)
            if e == "D":
                continue
            if e != "K":
                role = "assistant" if end == "u" else "user"
            end = role[:1]
            lines.append(f"{role}:{text}")
        out[c] = (c, max(turns) - min(turns) + 1 - len(turns) if turns else 0, *count.values(), illegal, cost, audit,
                  hashlib.sha256("\n".join(lines).encode()).hexdigest())
    return sorted(map(str, out.values()))


def test_repair_of_damaged_rows(spark, odd_rows):
    got = R.report(table(spark, odd_rows).repartition(5)).collect()
    assert sorted(str(tuple(r)) for r in got) == naive_repair(odd_rows)
    assert R.report(table(spark, [])).count() == 0


def test_repaired_turns_are_legal_rows(spark, odd_rows):
    repaired = R.repair(table(spark, odd_rows)).collect()
    turns = defaultdict(str)
    for r in repaired:
        if r.position:
            turns[r.conv_id] += r.role[:1]
            assert r.edit != "I" or r.text == ""
    heads = {r.conv_id: r for r in repaired if not r.position}
    assert set(heads) == {r[0] for r in odd_rows}
    for c, r in heads.items():
        body = turns[c].removeprefix("s")
        assert body == "ua" * (len(body) // 2) and (body or not turns[c])
        assert len(turns[c]) == len(r.audit) - r.audit.count("D")


def test_a_dropped_conversation_stays_listed(spark):
    c = next(c for c in range(10_000) if zlib.crc32(f"{c}:0".encode()) % 20 == 0)
    got = R.report(spark.createDataFrame([(c, 0, "user", "Gone.")], "conv_id long, turn long, role string, text string")).first()
    assert tuple(got) == (c, 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())


# --- op13

MARKUP = st.lists(st.sampled_from([*C.CONTROLS, "<", "[", "\\", "s>", "/s>", "INST]", "|image|>", "x", "\n", "é"]), max_size=12).map("".join)


@settings(max_examples=400, deadline=None)
@given(MARKUP)
def test_escapes_are_reversible_and_leave_no_control_string(text):
    escaped = C.escape(text)
    assert C.unescape(escaped) == text
    assert not any(c in escaped for c in C.CONTROLS)


@settings(max_examples=150, deadline=None)
@given(st.lists(st.tuples(st.one_of(st.sampled_from(["user", "assistant", "system", "", "User"]), MARKUP), MARKUP), max_size=5))
def test_turns_come_back_from_the_text(turns):
    piece = C._Piece(1, 0)
    for role, text in turns:
        piece.add(role, C.flatten([{"kind": "text", "text": text}]))
    _, _, text, loss, _, n = piece.row()
    assert list(C.read_piece(text, True)) == turns and n == len(turns)
    assert "".join(C.unescape(text[s["start"]:s["stop"]]) for s in loss) == "".join(t for r, t in turns if r == "assistant")


def part(kind, text=None, ref=None, width=None, height=None, seconds=None, pages=None):
    return (kind, text, ref, width, height, seconds, pages)


def test_parts_become_placeholders_in_order(spark):
    parts = [part("text", "Look <"), part("text", "/s> at "), part("image", ref="a.png", width=57, height=28), part(None, "and"),
             part("audio", ref="b.wav", seconds=2.01), part("audio", ref="c.wav", seconds=float("nan")), part("document", ref="d.pdf", pages=3),
             part("video", ref="e.mp4"), part("image"), None, part("text")]
    turns = spark.createDataFrame([(1, 0, "assistant", parts), (1, 1, "user", None), (1, 2, "user", [])],
                                  f"conv_id long, turn long, role string, parts array<{C.PART}>")
    (row,) = C.format_chats(turns).collect()
    assert row.text == ("<s>[OUT]Look <\\/s> at <|image|>and<|audio|><|audio|><|document|><|file|><|image|></s>[INST][/INST][INST][/INST]")
    assert [(row.text[a.offset:].split(">")[0] + ">", a.kind, a.ref, a.tokens) for a in row.attachments] == [
        ("<|image|>", "image", "a.png", 3), ("<|audio|>", "audio", "b.wav", 26), ("<|audio|>", "audio", "c.wav", 0),
        ("<|document|>", "document", "d.pdf", 2304), ("<|file|>", "video", "e.mp4", 0), ("<|image|>", "image", None, 0)]
    assert [row.text[s.start:s.stop] for s in row.loss] == ["Look <\\/s> at ", "and"]
    read = C.read_back(C.format_chats(turns)).first()
    assert (read.n_turns, read.loss_chars) == (3, len("Look </s> at and"))


def test_formatted_conversations_read_back(spark, odd_rows):
    found = defaultdict(list)
    for c, t, role, text in [*odd_rows, (-7, 0, "user", C.TRICKY), (-7, 1, "assistant", C.TRICKY)]:
        role, text = role or "", text or ""
        found[c].append(((t is not None, t or 0, role, hashlib.sha256(text.encode()).hexdigest()), role, text))
    expected = []
    for c, v in found.items():
        v.sort(key=lambda r: r[0])
        trained = "".join(t for _, r, t in v if r == "assistant")
        expected.append((c, len(v), hashlib.sha256("".join(f"{r}\n{t}\n" for _, r, t in v).encode()).hexdigest(), len(trained),
                         hashlib.sha256(trained.encode()).hexdigest()))
    got = C.report(table(spark, odd_rows).repartition(6)).collect()
    assert sorted(str(tuple(r)[:5]) for r in got) == sorted(map(str, expected))
    assert [r.conv_id for r in C.report(table(spark, [])).collect()] == [-7]


def test_long_conversations_go_on_in_pieces(spark):
    text = "many words " * 60_000
    turns = spark.createDataFrame([(c, t, "user" if t % 2 else "assistant", f"{t} {text}") for c in (1, 2) for t in range(10)],
                                  "conv_id long, turn long, role string, text string")
    formatted = C.format_chats(C.text_parts(turns))
    assert formatted.groupBy("conv_id").count().where("count > 1").count() == 2
    for r in C.read_back(formatted).collect():
        assert r.n_turns == 10
        assert r.turns_sha256 == hashlib.sha256("".join(f"{'user' if t % 2 else 'assistant'}\n{t} {text}\n" for t in range(10)).encode()).hexdigest()
