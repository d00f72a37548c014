"""Error analysis of scored predictions: bands, quantiles, loops, frequent edits."""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from parkwright.functions.bits import steps
from parkwright.functions.text import error_text, loop_score, text, words_on_space
from parkwright.operators.ranking import interpolated, selected
from parkwright.sources.shared import cut, slices

#: Half-open bands of error rates.
BANDS = (("good", 0.0, 0.2), ("moderate", 0.2, 0.4), ("fair", 0.4, 0.6), ("poor", 0.6, 0.8), ("bad", 0.8, 1.01), ("catastrophic", 1.01, 99.0))
#: What a reference says, and what is heard for it.
SHIFTS = (
    ("mauwa", "maua"), ("marage", "maharage"), ("kuusu", "kuhusu"), ("alizi", "ardhi"), ("kunaa", "kuna"),
    ("piya", "pia"), ("sanaa", "sana"), ("ukungu", "upunguu"), ("stage", "steji"),
)
LOOPING = 6


def bands(rows: DataFrame, c: str) -> DataFrame:
    """(band, n, pct) of all rows; bands without rows read 0.

    Each band is a count beside the others, so no join asks for rows of a band: such a
    filter would be moved below the rates and work them out a second time.
    """
    counts = rows.agg(F.count(F.lit(1)).alias("total"), *[F.count_if((F.col(c) >= low) & (F.col(c) < high)).alias(name) for name, low, high in BANDS])
    each = F.array(*[F.struct(F.lit(i).alias("place"), F.lit(name).alias("band"), F.col(name).alias("n")) for i, (name, _, _) in enumerate(BANDS)])
    return counts.select("total", F.inline(each)).select("place", "band", "n", F.when(F.col("total") > 0, 100.0 * F.col("n") / F.col("total")).otherwise(0.0).alias("pct"))


def middle(rows: DataFrame, c: str) -> DataFrame:
    """One row (mean, median)."""
    return rows.agg(F.avg(c).alias("mean")).join(F.broadcast(interpolated(rows, c, {"median": 0.5})))


def nearest_rank(rows: DataFrame, c: str, tenths: int = 9) -> DataFrame:
    """The value at place floor(n * tenths / 10) from 0 in sorted order; no row without values."""
    _, found = selected(rows, c, lambda n: [n * tenths // 10])
    return rows.sparkSession.createDataFrame([(v,) for v in found.values()], f"p{tenths}0 double")


def looping(rows: DataFrame, c: str) -> DataFrame:
    score = loop_score(text(c))
    return rows.select(score.alias("s")).agg(F.count_if(F.col("s") >= LOOPING).alias("looping"), (100.0 * F.count_if(F.col("s") >= LOOPING) / F.count(F.lit(1))).alias("pct"))


def shifts(pairs: DataFrame, patterns: tuple = SHIFTS, k: int = 12) -> DataFrame:
    """(shift, n): matches in references of pairs where both sides match; the k largest, ties by name."""
    ref, hyp = error_text(text("reference")), error_text(text("prediction"))
    each = F.array(*[F.struct(F.lit(f"{a}->{b}").alias("shift"), F.when(F.col("_r").rlike(a) & F.col("_h").rlike(b), F.regexp_count(F.col("_r"), F.lit(a))).alias("n")) for a, b in patterns])
    found = pairs.select(ref.alias("_r"), hyp.alias("_h")).select(F.inline(each)).where("n is not null")
    return found.groupBy("shift").agg(F.sum("n").cast("long").alias("n")).orderBy(F.desc("n"), "shift").limit(k)


def top_k_then(counts: DataFrame, n: str, ties: list[str], k: int, least: int) -> DataFrame:
    """The k largest, and of those the ones of at least ``least``: fewer than k may remain."""
    return counts.orderBy(F.desc(n), *ties).limit(k).where(F.col(n) >= least)


def by_duration(rows: DataFrame, seconds: str, c: str) -> DataFrame:
    """Mean rate of the rows of each duration band; bands without rows are left out."""
    band = F.when(F.col(seconds) < 30, "<30").when(F.col(seconds) < 60, "30-60").otherwise(">=60")
    return rows.where(F.col(seconds).isNotNull()).groupBy(band.alias("band")).agg(F.count(F.lit(1)).alias("n"), F.avg(c).alias("mean_wer"))


def align(ref: list[str], hyp: list[str]) -> list[tuple[str, str, str]]:
    """(kind, reference phrase, hypothesis phrase): runs of equal edits in the canonical alignment (``bits.steps``)."""
    out: list[tuple[str, list[str], list[str]]] = []
    r, h, former = iter(ref), iter(hyp), None
    for kind in steps(ref, hyp):
        if kind != former:
            out.append((kind, [], []))
        former = kind
        if kind != "insert":
            out[-1][1].append(next(r))
        if kind != "delete":
            out[-1][2].append(next(h))
    return [(kind, " ".join(a), " ".join(b)) for kind, a, b in out if kind != "equal"]


def edit_chunks(pairs: DataFrame) -> DataFrame:
    """(kind, ref_phrase, hyp_phrase, words): every edit chunk of every pair, in Arrow batches."""
    own = pairs.select(words_on_space(error_text(text("reference"))).alias("r"), words_on_space(error_text(text("prediction"))).alias("h"))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches):
            found = [x for r, h in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True) for x in align(r, h)]
            kinds, refs, hyps = (list(c) for c in zip(*found, strict=True)) if found else ([], [], [])
            sizes = [max(len(r.split()), len(h.split())) for r, h in zip(refs, hyps, strict=True)]
            yield pa.RecordBatch.from_arrays([pa.array(kinds, pa.string()), pa.array(refs, pa.string()), pa.array(hyps, pa.string()), pa.array(sizes, pa.int64())], names=["kind", "ref_phrase", "hyp_phrase", "words"])

    return own.mapInArrow(work, "kind string, ref_phrase string, hyp_phrase string, words long")


def frequent_edits(pairs: DataFrame, rules: dict[str, tuple[int, int]] | None = None) -> DataFrame:
    """The most frequent chunks of each kind: the k largest, then those that reach the least count."""
    rules = rules or {"substitute": (25, 8), "insert": (20, 12), "delete": (20, 12)}
    counts = edit_chunks(pairs).groupBy("kind", "ref_phrase", "hyp_phrase").agg(F.count(F.lit(1)).alias("n"))
    out = None
    for kind, (k, least) in rules.items():
        part = top_k_then(counts.where(F.col("kind") == kind), "n", ["ref_phrase", "hyp_phrase"], k, least)
        out = part if out is None else out.unionByName(part)
    return out


def report(rows: DataFrame, rules: dict[str, tuple[int, int]] | None = None) -> DataFrame:
    """(place, line) of the error analysis of (reference, prediction, wer, seconds): totals, bands, loops, shifts, edits, durations."""
    one = lambda df, line, *places: df.select(F.array(*places).cast("array<long>").alias("place"), line.alias("line"))
    said = lambda form, *cs: F.format_string(form, *cs)
    totals = rows.agg(F.count(F.lit(1)).alias("n"), F.avg("wer").alias("mean")).join(F.broadcast(interpolated(rows, "wer", {"median": 0.5}))).join(F.broadcast(nearest_rank(rows, "wer")), how="left")
    loops = looping(rows, "prediction")
    parts = [
        one(totals, said("Total utterances: %d", F.col("n")), F.lit(0)),
        one(totals, said("WER normalized: mean=%.3f median=%.3f p90=%.3f", F.col("mean"), F.col("median"), F.col("p90")), F.lit(1)),
        one(bands(rows, "wer"), said("  %s: %d (%.1f%%)", F.col("band"), F.col("n"), F.col("pct")), F.lit(2), F.col("place")),
        one(loops, said("Looping preds: %d (%.1f%%)", F.col("looping"), F.col("pct")), F.lit(3)),
        one(totals, F.lit("Lexical shifts:"), F.lit(4)),
        one(_numbered(shifts(rows), ["shift"]), said("  %4d  %s", F.col("n"), F.col("shift")), F.lit(5), F.col("_at")),
    ]
    edits = cut(frequent_edits(rows, rules), "edits")
    kinds = {"substitute": ("substitutions", said("  %4d  '%s' -> '%s'", F.col("n"), F.col("ref_phrase"), F.col("hyp_phrase"))), "insert": ("insertions", said("  %4d  +'%s'", F.col("n"), F.col("hyp_phrase"))), "delete": ("deletions", said("  %4d  -'%s'", F.col("n"), F.col("ref_phrase")))}
    for k, (kind, (name, line)) in enumerate(kinds.items()):
        parts += [one(totals, F.lit(f"Top {name}:"), F.lit(6 + 2 * k)), one(_numbered(edits.where(F.col("kind") == kind), ["ref_phrase", "hyp_phrase"]), line, F.lit(7 + 2 * k), F.col("_at"))]
    by = by_duration(rows, "seconds", "wer").withColumn("_at", F.when(F.col("band") == "<30", 0).when(F.col("band") == "30-60", 1).otherwise(2))
    parts.append(one(by, said("WER %ss: n=%d mean=%.3f", F.col("band"), F.col("n"), F.col("mean_wer")), F.lit(12), F.col("_at")))
    return reduce(DataFrame.unionByName, parts)


def _numbered(counts: DataFrame, ties: list[str]) -> DataFrame:
    """A few rows with their places by falling ``n``."""
    return counts.withColumn("_at", F.row_number().over(Window.orderBy(F.desc("n"), *ties)))
