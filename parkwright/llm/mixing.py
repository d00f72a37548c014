"""Sources mixed to target weights by Pfair scheduling.

Each source's documents, in the order of a hash of their id, form blocks. With
whole-number weights w and a period of W = sum of w slots, the k-th block of a
source in a period is released at floor(k W / w) and due at ceil((k + 1) W / w);
each slot goes to the released block that is due first. Such windows can always be
met, so after any number of slots every source is less than one block away from
its share. A period is scheduled once and repeats. When a source has fewer blocks
left than its weight, one period is scheduled for what it has, and from then on
the others share its slots by their weights: at most 2 sources + 1 schedules.
All documents keep a place; none is repeated or dropped.

Scale: only (doc_id, source) rows move. The rank of a document in its source is
taken over ranges, so a hot source spreads over many tasks. Schedules depend on the
sources' weights and numbers of blocks, not on the documents: at most 2 sources + 1 of
at most W slots each, made in as many tasks. One slot costs a look at the first few
blocks by deadline and a copy of the list of those left, not a look at every source.
Running sums over the schedules, joined by (phase, source, block), give positions;
nothing is collected. Sources are meant to number up to some thousands.

Defined cases: a null source is a source of its own; null ids come first in their
source; repeated rows get a place each, in any order among them. Blocks due at the same
time go by source. Sources without a given weight get weight 1. Texts are not looked at,
however long, and neither are columns beyond doc_id and source, whatever their names.
No rows in, no rows out.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from parkwright.llm.shared import cut, grouped_rank, let, small

BLOCK_DOCS, PERIOD, AHEAD, TASKS, BUCKETS = 8, 1000, 32, 4096, 16_384


def root_weights(counts: DataFrame) -> DataFrame:
    """(source, n, weight): weights in proportion to the square root of the counts, at least 1, about PERIOD in all.

    Whole-number roots keep the result the same on every engine.
    """
    root = F.floor(F.sqrt(F.col("n").cast("double")) * 1000).cast("long")
    total = counts.agg(F.sum(root)).first()[0] or 1
    return counts.withColumn("weight", F.greatest(F.expr(f"cast(floor(sqrt(cast(n as double)) * 1000) as long) * {PERIOD} div {int(total)}L"), F.lit(1).cast("long")))


def given_weights(counts: DataFrame, weights: dict[str, int]) -> DataFrame:
    table = F.create_map(*[F.lit(x) for pair in weights.items() for x in pair]) if weights else None
    found = table[F.col("source")] if table is not None else F.lit(None)
    return counts.withColumn("weight", F.greatest(F.coalesce(found, F.lit(1)).cast("long"), F.lit(1).cast("long")))


_BLOCK = "struct<due:bigint,i:int,k:bigint,release:bigint>"


def earliest_deadline_first(shares: Column) -> Column:
    """For one period of sum(shares) slots: the (source index, block) of each slot."""
    return let(shares, _slots)


def _slots(shares: Column) -> Column:
    span = F.aggregate(shares, F.lit(0).cast("long"), lambda a, b: a + b)

    def schedule(w: Column) -> Column:
        one = lambda x, i, k: F.struct(F.ceil((k + 1) * w / x).alias("due"), i.alias("i"), k.alias("k"), F.floor(k * w / x).alias("release"))
        of_source = lambda x, i: F.when(x > 0, F.transform(F.sequence(F.lit(0).cast("long"), x - 1), lambda k: one(x, i, k))).otherwise(F.array().cast(f"array<{_BLOCK}>"))
        by_deadline = F.array_sort(F.flatten(F.transform(shares, of_source)))

        def slot(state: Column, t: Column) -> Column:
            left = state["left"]
            released = lambda some: F.get(F.filter(some, lambda b: b["release"] <= t), F.lit(0))
            # of blocks sorted by deadline, one of the first few is released as a rule
            first = F.coalesce(released(F.slice(left, 1, AHEAD)), released(left))

            def take(b: Column) -> Column:
                at = F.array_position(left, b).cast("int")
                rest = F.concat(F.slice(left, F.lit(1), at - 1), F.slice(left, at + 1, F.greatest(F.size(left) - at, F.lit(0))))
                return F.struct(rest.alias("left"), F.array_append(state["slots"], F.struct(b["i"].alias("i"), b["k"].alias("k"))).alias("slots"))

            return let(first, take)

        start = F.struct(by_deadline.alias("left"), F.array().cast("array<struct<i:int,k:bigint>>").alias("slots"))
        slots = F.transform(F.sequence(F.lit(0).cast("long"), w - 1), lambda t: t)
        return F.when(w > 0, F.aggregate(slots, start, slot, lambda s: s["slots"])).otherwise(F.array().cast("array<struct<i:int,k:bigint>>"))

    return let(span, schedule)


def plan(sources: DataFrame) -> DataFrame:
    """From (source, n, blocks, weight): the slots (phase, source, k, slot, span, first_period, periods, offset) of all schedules."""
    one = sources.agg(F.array_sort(F.collect_list(F.struct("source", "weight", "blocks"))).alias("s"))
    ends = F.flatten(F.transform("s", lambda x: F.array(F.expr("0L"), F.floor(x["blocks"] / x["weight"]), F.floor(x["blocks"] / x["weight"]) + 1)))
    phases = one.select("s", F.array_sort(F.array_distinct(ends)).alias("starts")).select("s", F.posexplode("starts").alias("phase", "first_period"), F.col("starts"))
    phases = phases.withColumn("periods", F.get("starts", F.col("phase") + 1) - F.col("first_period")).drop("starts")
    # only sources with blocks left go on to a phase's own task; a stated number of partitions is kept by adaptive execution
    tasks = min(2 * sources.count() + 1, TASKS)
    before = lambda x: F.least(x["blocks"], x["weight"] * F.col("first_period"))
    phases = phases.withColumn("offset", F.aggregate("s", F.lit(0).cast("long"), lambda a, x: a + before(x)))
    active = F.filter("s", lambda x: x["blocks"] > x["weight"] * F.col("first_period"))
    phases = phases.withColumn("s", F.transform(active, lambda x: F.struct(x["source"].alias("source"), F.least(x["blocks"] - x["weight"] * F.col("first_period"), x["weight"]).alias("share"))))
    phases = phases.where(F.size("s") > 0).repartition(tasks)
    slots = phases.withColumn("slots", earliest_deadline_first(F.transform("s", lambda x: x["share"])))
    slots = slots.select("phase", "first_period", "periods", "offset", F.size("slots").cast("long").alias("span"), "s", F.posexplode("slots").alias("slot", "at"))
    return slots.select("phase", F.get("s", F.col("at.i"))["source"].alias("source"), F.col("at.k").alias("k"), F.col("slot").cast("long").alias("slot"), "span", "first_period", "periods", "offset")


def with_gaps(slots: DataFrame, sources: DataFrame, block_docs: int) -> DataFrame:
    """``slots`` with the documents that sources' last blocks are short by, in all before the phase and, for its last period, before the slot.

    A source's last block lies in the last period of a phase, as phases begin and end
    where sources run out.
    """
    last = sources.select("source", "blocks", "weight", (F.col("blocks") * block_docs - F.col("n")).alias("short"))
    s, x = slots.alias("s"), small(last).alias("x")
    end = F.col("s.first_period") + F.col("s.periods") - 1
    rows = s.join(x, F.col("s.source").eqNullSafe(F.col("x.source"))).select("s.*", F.when(F.col("x.blocks") - 1 == end * F.col("x.weight") + F.col("s.k"), F.col("x.short")).otherwise(F.lit(0).cast("long")).alias("short"))
    within = Window.partitionBy("phase").orderBy("slot").rowsBetween(Window.unboundedPreceding, -1)
    rows = cut(rows.withColumn("short_in", F.coalesce(F.sum("short").over(within), F.lit(0).cast("long"))), "short")
    # one row a phase
    totals = rows.groupBy("phase").agg(F.sum("short").alias("short")).select("phase", F.coalesce(F.sum("short").over(Window.orderBy("phase").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0).cast("long")).alias("short_before"))
    return rows.drop("short").join(small(cut(totals, "totals")), "phase")


def _spans(slots: DataFrame) -> DataFrame:
    """(bucket, step, phase, first_period, periods): the phases by runs of ``step`` periods, at most BUCKETS of them and one row more for each phase."""
    phases = slots.select("phase", "first_period", "periods").distinct()
    step = F.greatest(F.ceil(F.max(F.col("first_period") + F.col("periods")).over(Window.partitionBy()) / BUCKETS), F.lit(1).cast("long"))
    phases = phases.withColumn("step", step)
    ends = F.floor((F.col("first_period") + F.col("periods") - 1) / F.col("step"))
    return phases.withColumn("bucket", F.explode(F.sequence(F.floor(F.col("first_period") / F.col("step")), ends)))


def _placed(blocks: DataFrame, sources: DataFrame, slots: DataFrame) -> DataFrame:
    """``blocks`` (source, block, ...) with their ``block_position`` and the documents missing before them."""
    spans = cut(_spans(slots), "spans")
    step = spans.agg(F.max("step")).first()[0] or 1
    b = blocks.alias("b").join(small(sources).alias("s"), F.col("b.source").eqNullSafe(F.col("s.source"))).select("b.*", "s.weight")
    b = b.withColumn("period", F.floor(F.col("block") / F.col("weight"))).withColumn("k", F.col("block") - F.col("period") * F.col("weight")).alias("b")
    of = F.floor(F.col("b.period") / step) == F.col("p.bucket")
    b = b.join(small(spans).alias("p"), of & (F.col("b.period") >= F.col("p.first_period")) & (F.col("b.period") < F.col("p.first_period") + F.col("p.periods"))).select("b.*", "p.phase").alias("b")
    on = (F.col("b.phase") == F.col("t.phase")) & F.col("b.source").eqNullSafe(F.col("t.source")) & (F.col("b.k") == F.col("t.k"))
    at = F.col("t.offset") + (F.col("b.period") - F.col("t.first_period")) * F.col("t.span") + F.col("t.slot")
    missing = F.col("t.short_before") + F.when(F.col("b.period") == F.col("t.first_period") + F.col("t.periods") - 1, F.col("t.short_in")).otherwise(F.lit(0).cast("long"))
    return b.join(small(slots).alias("t"), on).select(*[f"b.{c}" for c in blocks.columns], at.alias("block_position"), missing.alias("_missing"))


def mix(docs: DataFrame, weights: dict[str, int] | None = None, block_docs: int = BLOCK_DOCS) -> DataFrame:
    """(doc_id, source, source_rank, block, block_position, position) for each row of ``docs``.

    ``position`` runs from 0 without gaps over the mixed order. Weights default to
    ``root_weights``.
    """
    own = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"))
    own = own.withColumn("_key", F.md5(F.col("doc_id").cast("string").cast("binary")))
    ranked = cut(grouped_rank(own, ["source"], ["_key", "doc_id"], "source_rank").drop("_key"), "ranks")
    counts = cut(ranked.groupBy("source").agg(F.count(F.lit(1)).alias("n")), "counts")
    weighed = root_weights(counts) if weights is None else given_weights(counts, weights)
    weighed = cut(weighed.withColumn("blocks", F.ceil(F.col("n") / block_docs)), "weights")
    slots = cut(with_gaps(cut(plan(weighed), "slots"), weighed, block_docs), "slots")
    placed = _placed(ranked.withColumn("block", F.floor(F.col("source_rank") / block_docs)), weighed, slots)
    position = F.col("block_position") * block_docs + F.col("source_rank") % block_docs - F.col("_missing")
    return placed.withColumn("position", position.cast("long")).drop("_missing")


def mixed_documents(docs: DataFrame, weights: dict[str, int] | None = None) -> DataFrame:
    """The rows of ``docs`` in mixed order; rows that share an id stand together at its first place.

    Rows without an id come last.
    """
    order = mix(docs.select("doc_id", "source"), weights).groupBy("doc_id").agg(F.min("position").alias("_at")).where("doc_id is not null")
    d, o = docs.alias("d"), cut(order, "order").alias("o")
    joined = d.join(o, F.col("d.doc_id") == F.col("o.doc_id"), "left").select("d.*", F.col("o._at").alias("_parkwright_at"))
    return joined.orderBy(F.col("_parkwright_at").asc_nulls_last()).drop("_parkwright_at")
