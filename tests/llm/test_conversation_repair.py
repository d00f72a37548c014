"""Repairs against a search over all edits, damage against the rules, and conversations in several segments."""

import hashlib
import itertools
import random
import re
import zlib

import pytest

from parkwright.llm import conversation_repair as C
from parkwright.llm import queries as q

FORM = re.compile(r"(s?(ua)+)?")


def plain_damage(rows):
    out = []
    for conv, turn, role, text in rows:
        said = lambda v: " " if v is None else str(v)
        k = zlib.crc32(f"{said(conv)}:{said(turn)}".encode()) % 20
        role, text = "user" if k == 4 else said(role), "" if k == 1 else re.sub("[.!?]", "", said(text)) if k == 2 else said(text)
        out += [(conv, turn, role, text)] * (0 if k == 0 else 2 if k == 3 else 1)
    return out


def faults_of(rows):
    seen, out = set(), []
    for _, _, role, text in rows:
        solid = re.findall(r"[^\x20\x09-\x0D]", text)
        out.append("b" if not solid else "d" if (role, text) in seen else "t" if solid[-1] not in ".!?" else "-")
        seen.add((role, text))
    return out


def plain_repair(rows):
    """(cost, audit, lines) by a walk that keeps, for every string of initials' state, the least (cost, audit)."""
    faults = faults_of(rows)
    # the state is how far (s?(ua)+)? is matched: nothing, s, an open u, or whole pairs; it takes one edit at a time
    after = {("", "s"): "s", ("", "u"): "u", ("s", "u"): "u", ("u", "a"): "a", ("a", "u"): "u"}

    def inserted(ways):
        for _ in range(4):
            for (state, (cost, audit, lines)), name in itertools.product(list(ways.items()), ("user", "assistant")):
                if (to := after.get((state, name[0]))) is not None:
                    new = (cost + 5, audit + "I", (*lines, f"{name}:"))
                    ways[to] = min(ways.get(to, new), new)
        return ways

    ways = {"": (0, "", ())}
    for (_, _, role, text), fault in zip(rows, faults, strict=True):
        ways, out = inserted(ways), {}
        for state, (cost, audit, lines) in ways.items():
            steps = [(state, (cost + 2, audit + "D", lines))]
            if fault not in "bd":
                for letter, name, price in (("K", role, 0), ("R", "user", 1), ("R", "assistant", 1)):
                    if name and (to := after.get((state, name[0]))) is not None:
                        steps.append((to, (cost + price + 5 * (fault == "t"), audit + letter, (*lines, f"{name}:{text}"))))
            for to, new in steps:
                out[to] = min(out.get(to, new), new)
        ways = out
    ways = inserted(ways)
    return min(ways[s] for s in ("", "a") if s in ways)


def plain_row(conv, rows):
    rows = sorted(rows, key=lambda r: (r[1] is not None, r[1] or 0, r[2], hashlib.sha256(f"{len(r[2])}:{r[2]}{r[3]}".encode()).digest()))
    faults, turns = faults_of(rows), {r[1] for r in rows if r[1] is not None}
    initials = [r[2][:1] for r in rows]
    cost, audit, lines = plain_repair(rows)
    gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
    illegal = sum(a + b not in ("su", "ua", "au") for a, b in itertools.pairwise(initials))
    return (conv, gaps, faults.count("b"), faults.count("d"), faults.count("t"), illegal, cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest())


def plain(rows, convs):
    return {c: plain_row(c, [r for r in rows if r[0] == c]) for c in convs}


def test_op13_over_the_table(spark, sf):
    table = [tuple(r) for r in spark.read.parquet(f"{sf}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    got = {r["conv_id"]: tuple(r) for r in q.op13_conversation_repair(spark, sf).collect()}
    assert got == plain(plain_damage(table), {r[0] for r in table})
    assert {w for r in got.values() for w in r[7]} >= set("DKR")


def every_edit(rows):
    """The least (cost, audit) over all strings of edits, by trying them."""
    faults, best = faults_of(rows), None
    choices = [["D"] if f in "bd" else ["D", "K", "Ru", "Ra"] for f in faults]
    for picked in itertools.product(*choices):
        for gaps in itertools.product(("", "u", "a", "ua", "au"), repeat=len(rows) + 1):
            initials, audit, cost = gaps[0], "I" * len(gaps[0]), 5 * len(gaps[0])
            for (_, _, role, _), fault, edit, gap in zip(rows, faults, picked, gaps[1:], strict=True):
                cost += {"D": 2, "K": 0, "R": 1}[edit[0]] + 5 * (edit != "D" and fault == "t") + 5 * len(gap)
                audit += edit[0] + "I" * len(gap)
                initials += {"D": "", "K": role[:1] or "?", "R": edit[1:]}[edit[0]] + gap
            if FORM.fullmatch(initials):
                best = min(best or (cost, audit), (cost, audit))
    return best


def test_least_by_trying_all_edits():
    r = random.Random(8)
    for n in range(4):
        for _ in range(12):
            rows = [(1, i, r.choice(["user", "assistant", "system", "tool"]), r.choice(["Yes.", "no", "", "So?", f"w{i}."])) for i in range(n)]
            assert plain_repair(rows)[:2] == every_edit(rows)
            found = C.ways("".join(x[2][0] if x[2][0] in "sua" else "-" for x in rows), "".join(faults_of(rows)), "-")
            assert min((c + 5 * C.FINISH[s], a + "I" * C.FINISH[s]) for s, (c, a) in found.items()) == every_edit(rows)


@pytest.mark.parametrize("size", [1, 3, 1024])
def test_segments_change_nothing(spark, size):
    """Long conversations of few different texts and roles, so that many ways cost the same, in segments of any size."""
    r = random.Random(size)
    rows = []
    for conv, n in ((1, 400), (2, 37), (3, 1), (4, 90), (5, 6), (None, 25)):
        for i in range(n):
            rows.append((conv, i * 2 if i % 9 else None, r.choice(["user", "user", "assistant", "assistant", "system", "tool", "", None]), r.choice([f"text {i}.", f"text {i}!", f"cut {i}", " \t", None, "Same."])))
    table = spark.createDataFrame([(*x, "c", 1, 0) for x in rows], "conv_id long, turn long, role string, text string, audit string, cost int, place int").repartition(4)
    given = [(c, t, " " if a is None else a, " " if b is None else b) for c, t, a, b in rows]
    got = {r["conv_id"]: tuple(r) for r in C.repair(table, table, size).collect()}
    assert got == plain(given, {x[0] for x in rows})


def test_odd_conversations(spark):
    rows = [(7, None, "user", "A."), (7, None, "user", "A."), (8, 3, "assistant", "word " * 300_000 + "."), (9, 1, "system", "Be kind."), (10, 5, "u", "Hm?"), (10, 5, "a\nb", "x\n\ny!"), (10, 2**40, "user", "\x85")]
    table = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    every = spark.createDataFrame([(x,) for x in (7, 8, 9, 10, 11, None, 7)], "conv_id long")
    got = {r["conv_id"]: tuple(r) for r in C.repair(table, every).collect()}
    want = plain(rows, {7, 8, 9, 10})
    empty = (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())
    assert got == want | {11: (11, *empty), None: (None, *empty)}
    assert C.repair(table.limit(0), every.limit(0)).collect() == []
    assert {tuple(r)[1:] for r in C.repair(table.limit(0), every).collect()} == {empty}


def test_damage(spark):
    rows = [(c, t, "assistant", f"Is it {t}? Yes. {c}!") for c in range(40) for t in range(5)] + [(None, 1, None, None), (3, None, "user", "."), (4, 9, "system", "")]
    got = [tuple(r) for r in C.damage(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")).collect()]
    assert sorted(got, key=repr) == sorted(plain_damage(rows), key=repr) and len(got) != len(rows)
