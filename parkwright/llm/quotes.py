"""Conversations in reply order, from quoted passages instead of quotes.

Lines that start with '>' marks are quotes; the number of marks is their level.
Runs of lines of one level form passages. A message's own passages (its whole
unquoted text, its paragraphs and its lines) and the passages it quotes are
normalised (case, white space) and hashed. The original of a quoted passage is
the earliest earlier message of the conversation that holds it as its own. A
message replies to the original of its lowest quote level, then of its longest
passage, then to the latest. Its thread is the message that the chain of replies ends at; a reply
always stands after its original, so (thread_turn, turn) is an order in which every
reply follows what it answers.

Scale: native expressions parse each message once, in its own task, and the result is
written. Own passages are hashed only in conversations that have a quote, if their
number lets them be broadcast. Passages meet their originals by (conversation, hash):
originals collapse to their earliest turn before the shuffle, and both sides of that
join come straight from an exchange, so one conversation or one passage can hold any
share of the rows. Places are ranks over ranges of rows without texts, which are joined
back at the end by a number given when parsing. Chains of replies are shortened by
pointer jumping, in about log(depth) rounds, over the messages that reply.

Defined cases: null and empty texts have no passages, and blank ones count for
nothing. Null conversations form one conversation; a message with
a null turn neither replies nor is an original. Rows that repeat a (conversation,
turn) stay rows of their own; the first by role and hash of their content stands first,
and what any of them quotes counts for the turn. Very long texts are parsed whole, in
the memory of their task. Columns beyond the four are not looked at, whatever their
names. No rows in, no rows out.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parkwright.llm.shared import BROADCAST_ROWS, cut, grouped_rank, let

MARK = r"^(?:[ \t]*>)+[ \t]?"
#: The line that announces a quote.
ANNOUNCED = r"(?md)^On [^\n]* wrote:[ \t]*$"


def normalise(c: Column) -> Column:
    return F.trim(F.regexp_replace(F.lower(c), r"\s+", " "))


def passages(text: Column) -> Column:
    """Runs of lines of one quote level, as (level, body); a text without a mark is one run."""

    def runs(rows: Column) -> Column:
        starts = F.filter(F.sequence(F.lit(0), F.size(rows) - 1), lambda i: (i == 0) | (F.get(rows, i)["level"] != F.get(rows, i - 1)["level"]))
        body = lambda at, k, s: F.array_join(F.transform(F.slice(rows, s + 1, F.coalesce(F.get(at, k + 1), F.size(rows)) - s), lambda x: x["body"]), "\n")
        return let(starts, lambda at: F.transform(at, lambda s, k: F.struct(F.get(rows, s)["level"].alias("level"), body(at, k, s).alias("body"))))

    def of(t: Column) -> Column:
        lines = F.transform(F.split(t, "\n"), lambda x: F.struct(F.length(F.regexp_replace(F.regexp_extract(x, MARK, 0), "[^>]", "")).alias("level"), F.regexp_replace(x, MARK, "").alias("body")))
        one = F.array(F.struct(F.lit(0).alias("level"), t.alias("body")))
        return F.when(t.rlike(r"(?m)^[ \t]*>"), let(lines, runs)).otherwise(one)

    given = F.coalesce(text, F.lit(""))
    return let(F.when(F.contains(given, F.lit("\r")), F.regexp_replace(given, "\r\n?", "\n")).otherwise(given), of)


def _units(body: Column) -> Column:
    """A body, its paragraphs and its lines, each once."""
    return F.array_distinct(F.concat(F.array(body), F.split(body, r"\n[ \t]*\n"), F.split(body, "\n")))


def _key(body: Column) -> Column:
    return let(normalise(body), lambda n: F.struct(F.unhex(F.md5(n.cast("binary"))).alias("hash"), F.length(n).alias("chars")))


def _filled(keys: Column) -> Column:
    return F.array_distinct(F.filter(keys, lambda k: k["chars"] > 0))


def parse(messages: DataFrame) -> DataFrame:
    """(uid, conv_id, turn, role, content, quoted, max_level) of each message."""
    m = messages.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), F.col("role").cast("string").alias("role"), passages(F.col("text").cast("string")).alias("_runs"))
    joined = F.array_join(F.transform(F.filter("_runs", lambda r: r["level"] == 0), lambda r: r["body"]), "\n")
    # the line that announces a quote goes with it
    content = F.trim(F.regexp_replace(F.when(F.size("_runs") > 1, F.regexp_replace(joined, ANNOUNCED, "")).otherwise(joined), r"^\s+|\s+$", ""))
    of_run = lambda r: F.transform(_units(r["body"]), lambda b: let(_key(b), lambda k: F.struct(r["level"].alias("level"), k["hash"].alias("hash"), k["chars"].alias("chars"))))
    quoted = F.flatten(F.transform(F.filter("_runs", lambda r: r["level"] > 0), of_run))
    top = F.coalesce(F.array_max(F.transform("_runs", lambda r: r["level"])), F.lit(0))
    return m.select(F.monotonically_increasing_id().alias("uid"), "conv_id", "turn", "role", content.alias("content"), _filled(quoted).alias("quoted"), top.alias("max_level"))


def replies(parsed: DataFrame) -> DataFrame:
    """(conv_id, turn, reply_to, n_linked): one row for each (conversation, turn) with a linked quote."""
    told = parsed.where("turn is not null")
    asked = cut(told.where(F.size("quoted") > 0).select("conv_id", "turn", F.explode("quoted").alias("q")).select("conv_id", "turn", "q.*"), "quoted")
    quoting = cut(asked.select("conv_id").distinct(), "quoting")
    if (n := quoting.count()) == 0:
        return asked.select("conv_id", "turn", F.col("turn").alias("reply_to"), F.col("turn").alias("n_linked"))
    if n <= BROADCAST_ROWS:
        told = told.alias("m").join(F.broadcast(quoting).alias("k"), F.col("m.conv_id").eqNullSafe(F.col("k.conv_id")), "left_semi")
    own = _filled(F.transform(_units(F.col("content")), _key))
    held = told.select("conv_id", "turn", F.explode(own).alias("o")).select("conv_id", "turn", "o.hash")
    first = cut(held.groupBy("conv_id", "hash").agg(F.min("turn").alias("original")), "originals")
    on = F.col("a.conv_id").eqNullSafe(F.col("f.conv_id")) & (F.col("a.hash") == F.col("f.hash"))
    found = asked.alias("a").join(first.alias("f"), on & (F.col("f.original") < F.col("a.turn"))).select("a.conv_id", "a.turn", "a.level", "a.chars", "a.hash", "f.original")
    best = F.max(F.struct((-F.col("level")).alias("l"), "chars", "original"))
    return found.groupBy("conv_id", "turn").agg(best.alias("b"), F.count(F.lit(1)).alias("n_linked")).select("conv_id", "turn", F.col("b.original").alias("reply_to"), "n_linked")


def threads(links: DataFrame) -> DataFrame:
    """(conv_id, turn, reply_to, n_linked, thread_turn): ``links`` with the turn that each chain ends at."""
    rows = cut(links.withColumn("thread_turn", F.col("reply_to")), "threads")
    while True:
        on = F.col("a.conv_id").eqNullSafe(F.col("b.conv_id")) & (F.col("a.thread_turn") == F.col("b.turn"))
        step = rows.alias("a").join(rows.select("conv_id", "turn", F.col("thread_turn").alias("up")).alias("b"), on, "left")
        step = cut(step.select("a.conv_id", "a.turn", "a.reply_to", "a.n_linked", F.coalesce("b.up", "a.thread_turn").alias("thread_turn"), F.col("b.up").isNotNull().alias("moved")), "threads")
        rows = step.drop("moved")
        if step.where("moved").isEmpty():
            return rows


def reply_ordered(messages: DataFrame) -> DataFrame:
    """One row for each message: conv_id, turn, role, content without quotes, what it replies to, and its place.

    ``position`` runs from 0 without gaps over each conversation in reply order.
    """
    parsed = cut(parse(messages), "parsed")
    links = cut(threads(replies(parsed)), "links").alias("t")
    p = parsed.select("uid", "conv_id", "turn", "role", F.md5(F.col("content").cast("binary")).alias("_hash"), F.size("quoted").cast("long").alias("n_quoted"), F.col("max_level").cast("long").alias("max_level")).alias("p")
    on = F.col("p.conv_id").eqNullSafe(F.col("t.conv_id")) & (F.col("p.turn") == F.col("t.turn"))
    joined = p.join(links, on, "left").select(
        "p.uid", "p.conv_id", "p.turn", "p.role", "p._hash", "p.n_quoted", "p.max_level",
        F.coalesce("t.n_linked", F.lit(0).cast("long")).alias("n_linked"), "t.reply_to", F.coalesce("t.thread_turn", "p.turn").alias("thread_turn"),
    )
    placed = grouped_rank(joined, ["conv_id"], ["thread_turn", "turn", "role", "_hash"], "position").drop("_hash")
    return placed.join(parsed.select("uid", "content"), "uid").drop("uid")
