"""Exact ranks without hot tasks."""

from __future__ import annotations

import math
from bisect import bisect_left
from functools import reduce
from operator import or_

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from parkwright.sources.shared import cut, small


def grouped_rank(df: DataFrame, group: list[str], order: list[str], out: str) -> DataFrame:
    """Add ``out``, the rank from 0 of each row of narrow ``df`` within its group.

    The rows are dealt out by range of (group, order) and sorted there, so that a group
    with a third of all rows spreads over many tasks. Each row is numbered within its
    range as it is written; a rank is the rows of the group in earlier ranges plus the
    row's number less that of its group's first in the range. So rows are shuffled once.
    Ties in ``order`` get distinct ranks. The offsets have one row per group and range.
    """
    keys = [F.col(k) for k in [*group, *order]]
    # the partition, shifted by 33 bits, plus the place in it
    ranged = cut(df.repartitionByRange(*keys).sortWithinPartitions(*keys).withColumn("_at", F.monotonically_increasing_id()), "ranked")
    part = F.shiftright("_at", 33)
    counts = ranged.groupBy(*group, part.alias("_range")).agg(F.count(F.lit(1)).alias("_n"), F.min("_at").alias("_first"))
    before = Window.partitionBy(*group).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = cut(counts.select(*group, "_range", "_first", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before")), "offsets")
    r, o = ranged.withColumn("_range", part).alias("r"), small(offsets).alias("o")
    on = [F.col(f"r.{k}").eqNullSafe(F.col(f"o.{k}")) for k in [*group, "_range"]]
    return r.join(o, on).select(*[f"r.{c}" for c in df.columns], (F.col("r._at") - F.col("o._first") + F.col("o._before")).cast("long").alias(out))


def row_index(df: DataFrame, order: list[str], out: str = "row_idx") -> DataFrame:
    """Add ``out``, the place from 0 of each row of ``df`` in ``order``, without sorting in one task."""
    return grouped_rank(df.withColumn("_all", F.lit(0)), ["_all"], order, out).drop("_all")


#: Bins that a range of values is cut into, and values that are looked at one by one when so few are left.
BINS, FEW = 2048, 10_000


def selected(rows: DataFrame, c: str, places) -> tuple[int, dict[int, float]]:
    """The number of values of ``c``, and those at the places from 0 in sorted order that ``places`` gives for that number; nulls and NaN are left out.

    Nothing is sorted or shuffled but counts: the range that holds a place is cut into
    bins, counted with their least and largest value before they move, and the bin with
    the place is the next range, until it is one value or few are left in all ranges.
    """
    v = F.col("v")
    kept = rows.select(F.col(c).cast("double").alias("v")).where(v.isNotNull() & ~F.isnan("v"))
    n, low, high = kept.agg(F.count(F.lit(1)), F.min("v"), F.max("v")).first()
    wanted = sorted({p for p in places(n) if 0 <= p < n})
    # of each range: its ends, how many values lie before and in it, the places in it
    ranges, found = ([(low, high, 0, n, wanted)] if wanted else []), {}
    while ranges:
        found |= {p: lo for lo, hi, _, _, own in ranges if lo == hi for p in own}
        ranges = [r for r in ranges if r[0] < r[1]]
        if sum(r[3] for r in ranges) <= FEW:
            inside = [(v >= lo) & (v <= hi) for lo, hi, *_ in ranges]
            values = sorted(r["v"] for r in kept.where(reduce(or_, inside)).collect()) if ranges else []
            for lo, hi, before, _, own in ranges:
                first = bisect_left(values, lo)
                found |= {p: values[first + p - before] for p in own}
            break
        place = F.lit(None).cast("struct<r:int,bin:int>")
        for k, (lo, hi, *_) in enumerate(ranges):
            # infinite ends are bins of their own; halves, as the width may not be a number
            ends = [x for x in (lo, hi) if math.isinf(x)]
            a, b = max(lo, -1.7e308), min(hi, 1.7e308)
            share = F.least(F.floor((v / 2 - a / 2) / (b / 2 - a / 2) * BINS), F.lit(BINS - 1)).cast("int")
            own = F.when(v == float("-inf"), -1).when(v == float("inf"), BINS).otherwise(share) if ends else share
            place = F.when((v >= lo) & (v <= hi), F.struct(F.lit(k).alias("r"), own.alias("bin"))).otherwise(place)
        bins = kept.select(place.alias("at"), "v").where("at is not null").groupBy("at").agg(F.count(F.lit(1)).alias("n"), F.min("v").alias("low"), F.max("v").alias("high"))
        # at most BINS + 2 rows for each range
        counted, narrower = sorted(bins.collect(), key=lambda r: (r["at"]["r"], r["at"]["bin"])), []
        for k, (_, _, before, _, own) in enumerate(ranges):
            for r in (x for x in counted if x["at"]["r"] == k):
                held = [p for p in own if before <= p < before + r["n"]]
                if held:
                    narrower.append((r["low"], r["high"], before, r["n"], held))
                before += r["n"]
        ranges = narrower
    return n, found


def interpolated(rows: DataFrame, c: str, shares: dict[str, float]) -> DataFrame:
    """One row with a column for each of ``shares``: the quantile of ``c``, between its two neighbours in sorted order; without values all are null."""
    n, at = selected(rows, c, lambda n: [p for x in shares.values() for p in (int((n - 1) * x), int((n - 1) * x) + 1)])

    def between(x: float) -> float | None:
        if not n:
            return None
        low = at[int(x)]
        return low + (at[int(x) + 1] - low) * (x - int(x)) if x > int(x) else low

    return rows.sparkSession.createDataFrame([tuple(between((n - 1) * x) for x in shares.values())], ", ".join(f"`{name}` double" for name in shares))


def run_lengths(rows: DataFrame, key: list[str], order: list[str], c: str, first: str) -> DataFrame:
    """(key, first, n): runs of equal ``c`` in each key's order, with the least ``first`` of each.

    A row's rank among its key's rows less that among those of equal ``c`` is one number
    for each run, so ranks over ranges do, and no task holds a key.
    """
    own = rows.select(*key, *order, F.col(c).alias("_c"), F.col(first).alias("_first"))
    ranked = grouped_rank(grouped_rank(own, key, order, "_all"), [*key, "_c"], order, "_same")
    runs = ranked.groupBy(*key, "_c", (F.col("_all") - F.col("_same")).alias("_run")).agg(F.min("_first").alias(first), F.count(F.lit(1)).alias("n"))
    return runs.drop("_c", "_run")
