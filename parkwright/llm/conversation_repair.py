"""Faults of conversations, and the cheapest edits that make them well-formed.

A conversation is well-formed if its roles' initials are ``(s?(ua)+)?``. A turn is kept
as it is, kept under another role, or deleted; turns without text may be inserted. The
cheapest way is a choice of retained turns and their roles: the turns between two
retained ones are all deleted, at the difference of two prefix sums, and their roles
alone say what is inserted between them. So for each role the least of (cost of an
earlier retained turn less the prefix sum at it) is kept while turns pass, and a turn
looks at these few minima instead of at all earlier turns. Ways of equal cost go by
their audit, the initials of their edits: two audits of the same turns differ before
either ends, so the lesser stays the lesser whatever follows.

Scale: a conversation may hold any share of the rows. Its turns are ranked over ranges
without their texts and cut into segments of SEGMENT; each segment is solved in a task
of its own for every role that may stand before it. A conversation then folds its
segments in order, one small row each, in which a way is known by its place among the
ways of other roles and not by its audit; what it chose goes back to the segments, which
say what becomes of each turn. Earlier copies of a turn are found by (conversation, digest),
pre-aggregated, and looked up by (conversation, digest, place). Only the last step has a conversation in
one task: a SHA-256 is made from its first byte to its last, so the task hashes the
conversation's texts as they stream by in order and holds none of them.

Defined cases: null roles and texts are one space; a null conversation is one of its own, and null
turns come first. Rows of one turn go by role and digest of role and text. A role with another
initial than s, u or a, or an empty one, can be kept under another role only. Blank texts and
repeats must be deleted. Very long texts are hashed in the task that reads them. Repeated rows
are turns each. Columns beyond the four are not looked at, whatever their names. A conversation
without rows has zeros, an empty audit and the hash of nothing. No conversations in, no rows out.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import sha256

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parkwright.llm.shared import cut, grouped_rank

SEGMENT = 1024
REROLE, DELETE, INSERT, TRUNCATED = 1, 2, 5, 5
SPACE, ENDS = " \t\n\x0b\x0c\r", ".!?"
#: What may be the last retained turn: none yet, or one of an initial. Then which may follow after how many insertions, and how many end the conversation.
STATES = "-sua"
FOLLOWS = {"-": {"s": 0, "u": 0, "a": 1}, "s": {"u": 0, "a": 1}, "u": {"a": 0, "u": 1}, "a": {"u": 0, "a": 1}}
FINISH = {"-": 0, "s": 2, "u": 1, "a": 0}
NAMES = {"u": "user", "a": "assistant"}


def damage(messages: DataFrame) -> DataFrame:
    """``messages`` (conv_id, turn, role, text) with damage by the CRC-32 of 'conv_id:turn' modulo 20: 0 dropped, 1 emptied, 2 without end marks, 3 twice, 4 said by the user."""
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    kind = F.crc32(F.concat(text("conv_id"), F.lit(":"), text("turn")).cast("binary")) % 20
    own = messages.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), text("role").alias("role"), text("text").alias("text"), kind.alias("_kind"))
    said = F.when(F.col("_kind") == 1, "").when(F.col("_kind") == 2, F.translate("text", ENDS, "")).otherwise(F.col("text"))
    by = F.when(F.col("_kind") == 4, "user").otherwise(F.col("role"))
    times = F.explode(F.when(F.col("_kind") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0))))
    return own.where("_kind <> 0").select("conv_id", "turn", by.alias("role"), said.alias("text"), times.alias("_copy")).drop("_copy")


def _same(a: str, b: str, columns: list[str]) -> Column:
    out = F.col(f"{a}.conv_id").eqNullSafe(F.col(f"{b}.conv_id"))
    for c in columns:
        out = out & (F.col(f"{a}.{c}") == F.col(f"{b}.{c}"))
    return out


def turns(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(uid, role, text) of ``rows``, and (uid, conv_id, turn, place, initial, fault): places from 0 without gaps, the first fault of each."""
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    own = rows.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), text("role").alias("role"), text("text").alias("text"))
    own = cut(own.withColumn("uid", F.monotonically_increasing_id()), "messages")
    digest = F.unhex(F.sha2(F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text"), 256))
    last = F.right(F.rtrim("text", F.lit(SPACE)), F.lit(1))
    initial = F.when(F.left("role", F.lit(1)).isin(*"sua"), F.left("role", F.lit(1))).otherwise("-")
    narrow = own.select("uid", "conv_id", "turn", "role", digest.alias("digest"), initial.alias("initial"), last.alias("last"))
    placed = cut(grouped_rank(narrow, ["conv_id"], ["turn", "role", "digest"], "place").drop("role"), "placed")
    firsts = placed.groupBy("conv_id", "digest").agg(F.min("place").alias("place")).alias("f")
    seen = placed.alias("p").join(firsts, _same("p", "f", ["digest", "place"]), "left")
    fault = F.when(F.col("p.last") == "", "b").when(F.col("f.place").isNull(), "d").when(~F.col("p.last").isin(*ENDS), "t").otherwise("-")
    return own.select("uid", "role", "text"), seen.select("p.uid", "p.conv_id", "p.turn", "p.place", "p.initial", fault.alias("fault"))


def segments(placed: DataFrame, size: int) -> DataFrame:
    """One row for each (conv_id, segment) of at most ``size`` turns: their uids, initials and faults in order, and the turns' range."""
    rows = F.sort_array(F.collect_list(F.struct("place", "uid", "turn", "initial", "fault")))
    by = placed.groupBy("conv_id", F.floor(F.col("place") / size).alias("segment")).agg(rows.alias("rows"))
    known = F.filter("rows.turn", lambda t: t.isNotNull())
    text = lambda c: F.array_join(f"rows.{c}", "")
    return by.select("conv_id", "segment", F.col("rows.uid").alias("uids"), text("initial").alias("initials"), text("fault").alias("faults"), F.array_min(known).alias("low"), F.array_max(known).alias("high"), F.size(F.array_distinct(known)).cast("long").alias("numbers"))


def ways(initials: str, faults: str, before: str) -> dict[str, tuple[int, str]]:
    """The cheapest (cost, audit) over these turns for each state they may end in, when the last retained turn before them is ``before``."""
    # of each state: least cost less the deletions up to it, its audit, and how many turns that covers; deletions since then follow
    least, deleted = {before: (0, "", 0)}, 0
    for i, (initial, fault) in enumerate(zip(initials, faults, strict=True)):
        found: dict[str, tuple[int, str]] = {}
        if fault not in "bd":
            extra = TRUNCATED if fault == "t" else 0
            options = [(c, "R", REROLE) for c in "ua" if c != initial] + ([(initial, "K", 0)] if initial != "-" else [])
            for state, (value, audit, covered) in least.items():
                for role, letter, price in options:
                    inserts = FOLLOWS[state].get(role)
                    if inserts is None:
                        continue
                    cost = value + deleted + INSERT * inserts + price + extra
                    if role in found and found[role][0] < cost:
                        continue
                    way = (cost, audit + "D" * (i - covered) + "I" * inserts + letter)
                    found[role] = min(found.get(role, way), way)
        deleted += DELETE
        for role, (cost, audit) in found.items():
            value = cost - deleted
            if role not in least or (value, audit) < (least[role][0], least[role][1] + "D" * (i + 1 - least[role][2])):
                least[role] = (value, audit, i + 1)
    return {state: (value + deleted, audit + "D" * (len(initials) - covered)) for state, (value, audit, covered) in least.items()}


_WAYS = "ways array<struct<before:string,after:string,cost:long,audit:string>>"
_PARTS = "conv_id long, segment long, initials string, faults string, low long, high long, numbers long"


def solved(parts: DataFrame) -> DataFrame:
    """The rows of ``parts`` with their ways from each state that may stand before them."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = []
            for segment, initials, faults in zip(*(b.column(k).to_pylist() for k in (1, 2, 3)), strict=True):
                states = STATES if segment else STATES[0]
                out.append([{"before": s, "after": t, "cost": c, "audit": a} for s in states for t, (c, a) in ways(initials, faults, s).items()])
            kind = pa.list_(pa.struct([("before", pa.string()), ("after", pa.string()), ("cost", pa.int64()), ("audit", pa.string())]))
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(out, kind)], names=[*b.schema.names, "ways"])

    return parts.select("conv_id", "segment", "initials", "faults", "low", "high", "numbers").mapInArrow(work, f"{_PARTS}, {_WAYS}")


class Fold:
    """A conversation's segments, folded in order."""

    def __init__(self, conv_id: int | None):
        self.conv_id = conv_id
        # of each state: least cost so far, and the place of its audit among those of the others
        self.now = {STATES[0]: (0, 0)}
        self.steps: list[tuple[int, dict[str, tuple[str, str]]]] = []
        self.counts = {"b": 0, "d": 0, "t": 0}
        self.illegal, self.last, self.low, self.high, self.numbers = 0, "", None, None, 0

    def add(self, row: dict) -> None:
        joined = self.last + row["initials"]
        self.illegal += sum(joined[i : i + 2] not in ("su", "ua", "au") for i in range(len(joined) - 1))
        self.last = joined[-1]
        for fault in self.counts:
            self.counts[fault] += row["faults"].count(fault)
        if row["low"] is not None:
            self.numbers += row["numbers"] - (self.high == row["low"])
            self.low, self.high = row["low"] if self.low is None else self.low, row["high"]
        found: dict[str, tuple[int, int, str, str]] = {}
        for way in row["ways"]:
            if (start := self.now.get(way["before"])) is not None:
                new = (start[0] + way["cost"], start[1], way["audit"], way["before"])
                found[way["after"]] = min(found.get(way["after"], new), new)
        order = {key: k for k, key in enumerate(sorted({(place, audit) for _, place, audit, _ in found.values()}))}
        self.now = {state: (cost, order[place, audit]) for state, (cost, place, audit, _) in found.items()}
        self.steps.append((row["segment"], {state: (before, audit) for state, (_, _, audit, before) in found.items()}))

    def rows(self) -> Iterator[dict]:
        """What was chosen for each segment, from the last to the first; the whole in the first of them."""
        cost, _, inserts, state = min((cost + INSERT * FINISH[s], place, FINISH[s], s) for s, (cost, place) in self.now.items())
        chosen, tail = [], "I" * inserts
        for segment, by_state in reversed(self.steps):
            before, audit = by_state[state]
            chosen.append((segment, before, audit + tail))
            state, tail = before, ""
        gaps = 0 if self.low is None else self.high - self.low + 1 - self.numbers
        whole = {"gaps": gaps, "blank": self.counts["b"], "duplicate": self.counts["d"], "truncated": self.counts["t"], "illegal": self.illegal, "cost": cost, "audit": "".join(a for _, _, a in reversed(chosen))}
        for k, (segment, before, actions) in enumerate(chosen):
            yield {"conv_id": self.conv_id, "segment": segment, "before": before, "actions": actions, "whole": None if k else whole}


_WHOLE = "struct<gaps:long,blank:long,duplicate:long,truncated:long,illegal:long,cost:long,audit:string>"


def folded(ways: DataFrame) -> DataFrame:
    """(conv_id, segment, before, actions, whole): what each conversation chose for its segments."""
    whole = pa.struct([*[(c, pa.int64()) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")], ("audit", pa.string())])
    schema = pa.schema([("conv_id", pa.int64()), ("segment", pa.int64()), ("before", pa.string()), ("actions", pa.string()), ("whole", whole)])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fold = None
        for b in batches:
            out = []
            for row in b.to_pylist():
                if fold is None or row["conv_id"] != fold.conv_id:
                    out += fold.rows() if fold else ()
                    fold = Fold(row["conv_id"])
                fold.add(row)
            yield pa.RecordBatch.from_pylist(out, schema)
        if fold is not None:
            yield pa.RecordBatch.from_pylist(list(fold.rows()), schema)

    return ways.repartition("conv_id").sortWithinPartitions("conv_id", "segment").mapInArrow(work, f"conv_id long, segment long, before string, actions string, whole {_WHOLE}")


def pieces(initials: str, before: str, actions: str) -> Iterator[tuple[int, str, str | None]]:
    """(index of a turn, lines inserted before it, its new role or None) for retained turns; the number of turns and lines for what ends the conversation."""
    state, lines, at = before, "", 0
    for action in actions:
        if action == "D":
            at += 1
            continue
        # what is inserted or gets another role is what its place asks for
        state = initials[at] if action == "K" else "a" if state == "u" else "u"
        if action == "I":
            lines += f"{NAMES[state]}:\n"
        else:
            yield at, lines, NAMES[state] if action == "R" else None
            lines, at = "", at + 1
    if lines:
        yield len(initials), lines, None


def repaired(parts: DataFrame, chosen: DataFrame, size: int) -> DataFrame:
    """(uid, conv_id, place, lines, role) of retained turns, and of lines that end a conversation, without a uid."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = []
            for conv_id, segment, uids, initials, before, actions in zip(*(c.to_pylist() for c in b.columns), strict=True):
                out += [(uids[i] if i < len(uids) else None, conv_id, segment * size + i, lines, role) for i, lines, role in pieces(initials, before, actions)]
            columns = list(zip(*out, strict=True)) or [()] * 5
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, (pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string()), strict=True)], names=["uid", "conv_id", "place", "lines", "role"])

    both = parts.alias("p").join(chosen.alias("c"), _same("p", "c", ["segment"])).select("p.conv_id", "p.segment", "p.uids", "p.initials", "c.before", "c.actions")
    return both.mapInArrow(work, "uid long, conv_id long, place long, lines string, role string")


def hashed(lines: DataFrame) -> DataFrame:
    """(conv_id, repaired_sha256) of ``lines`` (conv_id, place, line as binary): each conversation's lines, hashed as they stream by in order."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state, owner = None, None
        for b in batches:
            done = []
            for conv_id, line in zip(b.column(0).to_pylist(), b.column(1), strict=True):
                if state is None or conv_id != owner:
                    done += [(owner, state.hexdigest())] if state else []
                    owner, state = conv_id, sha256()
                else:
                    state.update(b"\n")
                state.update(line.as_buffer())
            yield _hashes(done)
        if state is not None:
            yield _hashes([(owner, state.hexdigest())])

    return lines.repartition("conv_id").sortWithinPartitions("conv_id", "place").select("conv_id", "line").mapInArrow(work, "conv_id long, repaired_sha256 string")


def _hashes(done: list[tuple[int | None, str]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([c for c, _ in done], pa.int64()), pa.array([h for _, h in done], pa.string())], names=["conv_id", "repaired_sha256"])


def repaired_turns(rows: DataFrame, size: int = SEGMENT) -> tuple[DataFrame, DataFrame]:
    """The repaired conversations of ``rows`` (conv_id, turn, role, text) as (conv_id, place, line), and one row of counts, cost and audit for each.

    A line is a retained turn as 'role:text', after the turns inserted before it; lines
    in the order of their places make the conversation.
    """
    texts, placed = turns(rows)
    parts = cut(segments(placed, size), "segments")
    chosen = cut(folded(cut(solved(parts), "ways")), "chosen")
    kept = cut(repaired(parts, chosen, size), "retained").alias("k")
    joined = kept.join(texts.alias("t"), F.col("k.uid") == F.col("t.uid"), "left")
    line = F.when(F.col("t.uid").isNull(), F.regexp_replace("lines", "\n$", "")).otherwise(F.concat("lines", F.coalesce("k.role", "t.role"), F.lit(":"), "t.text"))
    return joined.select("k.conv_id", "k.place", line.alias("line")), chosen.where("whole is not null").select("conv_id", "whole.*")


def repair(rows: DataFrame, conversations: DataFrame, size: int = SEGMENT) -> DataFrame:
    """One row for each distinct conv_id of ``conversations``: counts of faults in its ``rows``, the cost and audit of its repair, and the hash of what that gives."""
    lines, wholes = repaired_turns(rows, size)
    hashes = hashed(lines.withColumn("line", F.col("line").cast("binary")))
    every = conversations.select(F.col("conv_id").cast("long").alias("conv_id")).distinct().alias("c")
    out = every.join(wholes.alias("w"), _same("c", "w", []), "left").join(hashes.alias("h"), _same("c", "h", []), "left")
    counts = [F.coalesce(f"w.{c}", F.lit(0).cast("long")).alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    return out.select("c.conv_id", *counts, F.coalesce("w.audit", F.lit("")).alias("audit"), F.coalesce("h.repaired_sha256", F.lit(sha256().hexdigest())).alias("repaired_sha256"))
