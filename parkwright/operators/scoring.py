"""Word and character error rates as exact micro-averages.

Edits and lengths are computed once a row; every grouping after that is a sum of
whole numbers, so pooled and grouped rates come from one pass with map-side
partial sums.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType

from parkwright.functions import bits
from parkwright.functions import text as T

MODES = ("none", "simple", "jiwer_default")
#: Characters from which a pair is compared on the bits of whole numbers, in Arrow batches: the built-in distance looks at each pair of characters, 64 of which are one step there.
LONG = 256


def units(mode: str, c: Column) -> tuple[Column, Column]:
    """(words, characters) of text under ``mode``."""
    if mode == "none":
        return T.raw_words(c), T.strip(c)
    if mode == "simple":
        return T.raw_words(T.simple(c)), T.simple(c)
    if mode == "jiwer_default":
        return T.plain_words(c), T.plain_chars(c)
    raise ValueError(f"unknown mode {mode}; one of {MODES}")


@F.pandas_udf(LongType())
def _long_edits(reference: pd.Series, hypothesis: pd.Series) -> pd.Series:
    """Edits of arrays or strings; null where a side is."""
    return pd.Series([None if r is None or h is None else bits.distance(list(r), list(h)) for r, h in zip(reference, hypothesis, strict=True)], dtype="Int64")


def edits(reference: Column, hypothesis: Column, there: Column, long: Column, short) -> Column:
    """The edits of two sequences where ``there``: ``short`` says them of pairs that aren't ``long``."""
    given = there & long
    return F.when(given, _long_edits(F.when(given, reference), F.when(given, hypothesis))).when(there, short(reference, hypothesis))


def scored(pairs: DataFrame, mode: str = "none", suffix: str = "") -> DataFrame:
    """``pairs`` (reference, prediction, ...) with edits and lengths in words and characters.

    Pairs with a blank reference are not scored: their counts are null. A
    reference that normalises to nothing counts 0 words and what was inserted.
    """
    ref, hyp = T.text("reference"), T.text("prediction")
    (rw, rc), (hw, hc) = units(mode, ref), units(mode, hyp)
    there, long = T.strip(ref) != "", F.greatest(F.length(ref), F.length(hyp)) > LONG
    sides = pairs.withColumns({"_rw": rw, "_rc": rc, "_hw": hw, "_hc": hc, "_there": there, "_long": long})
    named = lambda *cs: [F.col(c) for c in cs]
    out = sides.withColumns({
        f"word_edits{suffix}": edits(*named("_rw", "_hw", "_there", "_long"), T.word_edits), f"n_words{suffix}": F.when(F.col("_there"), F.size("_rw").cast("long")),
        f"char_edits{suffix}": edits(*named("_rc", "_hc", "_there", "_long"), T.char_edits), f"n_chars{suffix}": F.when(F.col("_there"), F.length("_rc").cast("long")),
    })
    return out.drop("_rw", "_rc", "_hw", "_hc", "_there", "_long")


def rate(edits: Column, n: Column) -> Column:
    return F.when(n > 0, edits / n)


def row_rates(rows: DataFrame, suffix: str = "") -> DataFrame:
    """Each row's own rates; 0.0 where nothing was scored."""
    one = lambda e, n: F.coalesce(rate(F.col(e + suffix), F.col(n + suffix)), F.lit(0.0))
    return rows.withColumns({f"wer{suffix}": one("word_edits", "n_words"), f"cer{suffix}": one("char_edits", "n_chars")})


def totals(suffix: str = "") -> list[Column]:
    """Aggregates of scored rows, named with ``suffix``: those scored, sums and rates; null rates if nothing was scored."""
    s = {k: F.sum(k + suffix) for k in ("word_edits", "n_words", "char_edits", "n_chars")}
    return [
        F.count("n_words" + suffix).alias("n_scored" + suffix), *[v.alias(k + suffix) for k, v in s.items()],
        rate(s["word_edits"], s["n_words"]).alias("wer" + suffix), rate(s["char_edits"], s["n_chars"]).alias("cer" + suffix),
    ]


def grouped(rows: DataFrame, sets: list[list[str]], suffixes: tuple[str, ...] = ("",)) -> DataFrame:
    """Totals for each grouping set of columns, under each suffix; columns outside a set read 'pooled'."""
    names = list(dict.fromkeys(c for s in sets for c in s))
    table = rows.select(*names, *[c + x for x in suffixes for c in ("word_edits", "n_words", "char_edits", "n_chars")])
    sums = [F.count(F.lit(1)).alias("n"), *[t for x in suffixes for t in totals(x)]]
    if not names:
        return table.agg(*sums)
    out = table.groupingSets([[F.col(c) for c in s] for s in sets], *names).agg(*sums, *[F.grouping(c).alias(f"_{c}") for c in names])
    return out.select(*[F.when(F.col(f"_{c}") == 1, "pooled").otherwise(F.col(c)).alias(c) for c in names], *[c for c in out.columns if c not in names and c[1:] not in names])


def require_scored(total: DataFrame) -> DataFrame:
    """``total`` of one pooled row, failing at run time when nothing could be scored."""
    return total.withColumn("wer", F.when(F.col("n_scored") > 0, F.col("wer")).otherwise(F.raise_error(F.lit("no pair has a reference")).cast("double")))
