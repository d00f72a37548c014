"""Runs and sets put side by side: lookups, full outer merges, pivots, replay mixing."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from parkwright.operators.ranking import row_index
from parkwright.sources.shared import BROADCAST_ROWS, cut, small


def concatenated(tables: dict[str, DataFrame], tag: str = "source_dataset") -> DataFrame:
    """UNION ALL by name; each row carries the name of its table, missing columns read null."""
    out = None
    for name, table in tables.items():
        part = table.withColumn(tag, F.lit(name))
        out = part if out is None else out.unionByName(part, allowMissingColumns=True)
    return out


def zipped(left: DataFrame, right: DataFrame, on: str = "row_idx", how: str = "inner") -> DataFrame:
    return left.join(right, on, how)


def beside(tuned: DataFrame, base: DataFrame) -> DataFrame:
    """Each group's rates in two runs; a group without a baseline reads NaN. Pooled first, then by name."""
    t, b = tuned.alias("t"), base.alias("b")
    out = t.join(b, F.col("t.group") == F.col("b.group"), "left").select("t.group", F.coalesce("b.wer", F.lit(float("nan"))).alias("base_wer"), F.col("t.wer").alias("tuned_wer"))
    return out.withColumn("delta", F.col("tuned_wer") - F.col("base_wer"))


def group_order() -> list[Column]:
    return [F.when(F.col("group") == "pooled", 0).otherwise(1), F.col("group")]


def wide(rows: DataFrame, key: str, models: list[str]) -> DataFrame:
    """One row for each key with prediction_<model> and rtfx_<model>; the first known duration. Columns sorted in their kinds."""
    order = sorted(models)
    of = lambda c, m: F.max(F.when(F.col("model") == m, F.col(c))).alias(f"{c}_{m}")
    duration = F.min_by("audio_duration_s", F.when(F.col("audio_duration_s").isNotNull(), F.col("model"))).alias("audio_duration_s")
    return rows.groupBy(key).agg(duration, *[of("prediction", m) for m in order], *[of("rtfx", m) for m in order])


def merged(memory: DataFrame, stored: DataFrame, key: str) -> DataFrame:
    """Full outer merge: stored predictions win, stored speeds and durations only fill gaps."""
    m, s = memory.alias("m"), stored.alias("s")
    return m.join(s, F.col(f"m.{key}") == F.col(f"s.{key}"), "full_outer").select(
        F.coalesce(f"m.{key}", f"s.{key}").alias(key), F.coalesce("s.prediction", "m.prediction").alias("prediction"),
        F.coalesce("m.rtfx", "s.rtfx").alias("rtfx"), F.coalesce("m.audio_duration_s", "s.audio_duration_s").alias("audio_duration_s"),
    )


def model_means(rows: DataFrame) -> DataFrame:
    """n, mean decode time and mean speed of each model, over rows that have them, to 3 places."""
    return rows.groupBy("model").agg(F.count(F.lit(1)).alias("n"), F.round(F.avg("decode_wall_s"), 3).alias("avg_decode_s"), F.round(F.avg("rtfx"), 3).alias("avg_rtfx"))


def first_by(rows: DataFrame, key: str, order: list) -> DataFrame:
    return rows.withColumn("_n", F.row_number().over(Window.partitionBy(key).orderBy(*order))).where("_n = 1").drop("_n")


def digest(c: Column) -> Column:
    """A text's 256 bits, which stand for it in shuffles; null for null."""
    return F.unhex(F.sha2(c.cast("binary"), 256))


def distinct_texts(rows: DataFrame, c: str, key: str) -> DataFrame:
    """(c, key): each distinct text ``c`` with its least ``key``; a null text is one, and a null key comes after others.

    Rows are compared by digest. Then the first rows, or else the rows that go, are
    broadcast if they are few, so that no text is shuffled; only beyond that is a text moved, once.
    """
    own = rows.select(F.col(c), F.col(key), F.coalesce(digest(F.col(c)), F.lit(b"")).alias("_d"))
    narrow = cut(own.groupBy("_d", key).agg(F.count(F.lit(1)).alias("n")), "digests")
    firsts = cut(narrow.groupBy("_d").agg(F.min_by(F.struct(key, "n"), F.struct(F.col(key).isNull(), key)).alias("f"), F.count(F.lit(1)).alias("k")), "firsts")
    kept, several = firsts.select("_d", F.col(f"f.{key}").alias(key)), firsts.where("k > 1").select("_d", F.col(f"f.{key}").alias("first"))
    n, same = kept.count(), lambda a, b: (F.col(f"{a}._d") == F.col(f"{b}._d")) & F.col(f"{a}.{key}").eqNullSafe(F.col(f"{b}.{key}"))
    gone = cut(narrow.join(several, "_d").where(~F.col(key).eqNullSafe(F.col("first"))).select("_d", key), "gone")
    if n > BROADCAST_ROWS and (lost := gone.count()) <= BROADCAST_ROWS:
        out = own.alias("o").join(small(gone, lost).alias("g"), same("o", "g"), "left_anti")
    else:
        out = own.alias("o").join(small(kept, n).alias("g"), same("o", "g"), "left_semi")
    # rows that repeat text and key are the same row; only they are gathered
    twice = cut(firsts.where("f.n > 1").select("_d", F.col(f"f.{key}").alias(key)), "twice")
    if twice.isEmpty():
        return out.select(c, key)
    again = small(twice)
    once = out.alias("o").join(again.alias("g"), same("o", "g"), "left_anti").select(c, key)
    return once.unionByName(out.alias("o").join(again.alias("g"), same("o", "g"), "left_semi").groupBy("_d", key).agg(F.max(c).alias(c)).select(c, key))


def as_of(left: DataFrame, right: DataFrame, key: str, at: str, most: int, span: int = 100_000) -> DataFrame:
    """Each left row with the nearest right row at or before it within ``most``; a right row serves its first left row only.

    ``at`` counts in whole numbers. Rows are merged in order within ranges of
    ``span``; a right row also stands in the next range if that begins within
    ``most`` of it. So no pair is built, and one key spreads over many tasks.
    """
    size = max(span, most + 1)
    own, reach = F.floor(F.col(at) / size), F.floor((F.col(at) + most) / size)
    r = right.select(key, at, F.col(at).cast("long").alias("_r"), F.lit(0).alias("_side"), F.explode(F.sequence(own, reach)).alias("_range"))
    both = left.select(key, at, F.lit(None).cast("long").alias("_r"), F.lit(1).alias("_side"), own.alias("_range")).unionByName(r)
    w = Window.partitionBy(key, "_range").orderBy(at, "_side").rowsBetween(Window.unboundedPreceding, 0)
    seen = both.withColumn("matched", F.last("_r", ignorenulls=True).over(w)).where("_side = 1")
    seen = seen.withColumn("matched", F.when(F.col(at) - F.col("matched") <= most, F.col("matched")))
    # a right row has at most most + 1 left rows; rows without a match need no order among them
    first = F.row_number().over(Window.partitionBy(key, F.coalesce("matched", -F.col(at) - 1)).orderBy(at))
    return seen.withColumn("_n", first).select(key, at, F.when(F.col("_n") == 1, F.col("matched")).alias("matched"))


def replayed(domain: DataFrame, retention: DataFrame, order: list[str], share: float, seed: int = 42) -> DataFrame:
    """Interleave two sets: a slot is a retention row with probability ``share``, up to the last row of the set that ends first.

    The share is held to [0, 0.5]. A slot's draw is the first 32 bits of the MD5 of
    'seed:slot', which any engine can repeat. Slots are counted ranks, so every row's place
    is known without a sequential draw. A set without rows ends it where it is first drawn.
    """
    share = min(max(share, 0.0), 0.5)
    d, r = cut(row_index(domain, order, "_k"), "domain"), cut(row_index(retention, order, "_k"), "retention")
    sizes = [d.count(), r.count()]
    slots = domain.sparkSession.range(sum(sizes)).select(F.col("id").alias("slot"))
    draw = F.conv(F.left(F.md5(F.concat(F.lit(f"{seed}:"), F.col("slot").cast("string")).cast("binary")), F.lit(8)), 16, 10).cast("long") < int(share * 2**32)
    slots = cut(slots.withColumn("pick", draw.cast("int")), "slots")
    ranked = cut(row_index(slots.where("pick = 0"), ["slot"], "_k").unionByName(row_index(slots.where("pick = 1"), ["slot"], "_k")), "picked")
    left = F.when(F.col("pick") == 0, sizes[0]).otherwise(sizes[1]) - F.col("_k") - 1
    end = ranked.agg(F.min(F.when(left == 0, F.col("slot")).when(left < 0, F.col("slot") - 1))).first()[0]
    rows = d.withColumn("pick", F.lit(0)).unionByName(r.withColumn("pick", F.lit(1)), allowMissingColumns=True)
    kept = ranked if end is None else ranked.where(F.col("slot") <= end)
    return kept.join(rows, ["pick", "_k"]).drop("_k")


__all__ = ["as_of", "beside", "concatenated", "digest", "distinct_texts", "first_by", "group_order", "merged", "model_means", "replayed", "small", "wide", "zipped"]
