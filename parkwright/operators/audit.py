"""Counts and distributions of prepared tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parkwright.functions.numbers import MAX_CLIP_SECONDS
from parkwright.functions.text import strip, text
from parkwright.operators.merging import digest
from parkwright.operators.ranking import interpolated


def splits(rows: DataFrame, keys: list[str], text_column: str, seconds: str) -> DataFrame:
    """Rows, rows without text and rows over 30 s of each split."""
    return rows.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("rows"), F.count_if(strip(text(text_column)) == "").alias("empty_text"), F.count_if(F.col(seconds) > MAX_CLIP_SECONDS).alias("over_30s")
    )


def sources(rows: DataFrame, source: str, clip: str) -> DataFrame:
    """Rows and distinct clips of each source, by their digests, and the rows that chunking added."""
    out = rows.groupBy(source).agg(F.count(F.lit(1)).alias("rows"), F.count_distinct(digest(F.col(clip))).alias("clips"))
    return out.withColumn("extra_rows", F.col("rows") - F.col("clips"))


def describe(rows: DataFrame, c: str) -> DataFrame:
    """count, mean, std, min, p50, p90, p95, p99, max; quantiles interpolate between neighbours."""
    own = rows.agg(F.count(c).alias("count"), F.avg(c).alias("mean"), F.stddev_samp(c).alias("std"), F.min(c).alias("min"), F.max(c).alias("max"))
    both = own.join(F.broadcast(interpolated(rows, c, {"p50": 0.5, "p90": 0.9, "p95": 0.95, "p99": 0.99})))
    return both.select("count", "mean", "std", "min", "p50", "p90", "p95", "p99", "max")


def histogram(rows: DataFrame, c: str, bins: int = 60) -> DataFrame:
    """(bin, low, high, n): equal widths from the least to the largest value, the last bin closed."""
    edge = rows.agg(F.min(c).alias("lo"), F.max(c).alias("hi")).first()
    if edge["lo"] is None:
        return rows.sparkSession.createDataFrame([], "bin int, low double, high double, n long")
    lo, width = float(edge["lo"]), (float(edge["hi"]) - float(edge["lo"])) / bins or 1.0 / bins
    place = F.least(F.floor((F.col(c) - lo) / width), F.lit(bins - 1)).cast("int")
    counts = rows.where(F.col(c).isNotNull()).groupBy(place.alias("bin")).agg(F.count(F.lit(1)).alias("n"))
    every = rows.sparkSession.range(bins).select(F.col("id").cast("int").alias("bin"))
    return every.join(F.broadcast(counts), "bin", "left").select("bin", (lo + F.col("bin") * width).alias("low"), (lo + (F.col("bin") + 1) * width).alias("high"), F.coalesce("n", F.lit(0).cast("long")).alias("n"))


def longest(rows: DataFrame, c: str) -> Column:
    return F.coalesce(F.max(c), F.lit(0.0))


def overlap(a: DataFrame, b: DataFrame, c: str) -> DataFrame:
    """One row: distinct values on either side and on both, and whether that leaks."""
    both = a.select(c).where(F.col(c).isNotNull()).intersect(b.select(c))
    sides = a.select(c, F.lit(1).alias("s")).unionByName(b.select(c, F.lit(2).alias("s"))).unionByName(both.select(c, F.lit(3).alias("s")))
    n = lambda s: F.count_distinct(F.when(F.col("s") == s, F.col(c)))
    return sides.agg(n(1).alias("left_n"), n(2).alias("right_n"), n(3).alias("shared_n"), (n(3) > 0).alias("leaks"))
