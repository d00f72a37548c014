"""Quality rules with thresholds that follow each language and source.

Each document gets whole-number measures of its whole text. Their distributions
are kept as quantile sketches: counts of log-linear buckets (exact below 256, then
the eight leading bits, so within 1/128 of a value). Sketches of two sets of
documents merge by adding counts, so a (language, source) with few documents
falls back to the merged sketch of its language, then of all. A measure is out of
line when it exceeds the median by more than SPREADS times the distance from the
lower quartile to the median; the width of the median's bucket, which is what the
sketch rounds by, is the only allowance beside that. SPREADS follows from the part of
clean texts that a measure may reject (LOST): a tail that falls off like an exponential
halves with each quartile distance, so beyond t distances lies 2^-(t + 1) of the group. Both quantiles lie in the
lower half, so up to half of a group may be junk without moving its threshold. A
group whose quartile equals its median takes the distance of the next wider
sketch that has one. The measures are ones that vary in any text (marks, capitals,
length of words, sameness of words), so that quantiles have something to follow.

Scale: one pass measures each text within its own task; sketches pre-aggregate
before the shuffle and their size does not depend on the number of documents. The
thresholds are broadcast only after a check of their number. ``filter_documents``
writes documents beside their measures once and reads them back to filter, so that
texts are neither shuffled nor measured twice.

Defined cases: null and empty texts have no words; documents with under 50 words, or
with over half their words in repeated three-word windows, fail the base rules and
are left out of the sketches. A measure equal to its threshold passes. Null languages
and sources are groups of their own. Very long texts are measured whole, in the
memory of their task. Repeated rows are measured and returned each. Columns beyond
text, lang and source are not looked at, whatever their names. No rows in, no rows out.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from parkwright.llm.shared import cut, let, small

#: What the rules look at: marks and capitals per ten thousand characters of words, hundredths of a character per word, and n * sqrt(n) / distinct^2 in thousandths.
MEASURES = ("marks_ptt", "upper_ptt", "word_length_c", "sameness_pm")
LEAST_ROWS, MIN_WORDS, SKETCH_BITS = 200, 50, 8
#: The part of a group's clean texts that a measure may reject, and the quartile distances that this asks for: a tail that halves with each distance holds 2^-(t + 1) beyond t of them.
LOST = 2.0**-13
SPREADS = round(-math.log2(2 * LOST))
SPACE = r"[\x20\x09-\x0D]"
SYMBOLS = "#*$%&|<>"


def repeated_words(words: Column) -> Column:
    """Words inside three-word windows that occur twice or more, first occurrences included."""
    return let(words, _repeated)


def _repeated(words: Column) -> Column:
    last = F.size(words) - 3

    def covered(hashes: Column) -> Column:
        def places(by_hash: Column) -> Column:
            again = F.filter(by_hash, lambda x, k: F.coalesce(F.get(by_hash, k - 1)["h"] == x["h"], F.lit(False)) | F.coalesce(F.get(by_hash, k + 1)["h"] == x["h"], F.lit(False)))
            return let(F.sort_array(F.transform(again, lambda x: x["i"])), lambda at: F.aggregate(F.transform(at, lambda p, k: F.least(F.lit(3), F.coalesce(F.get(at, k + 1) - p, F.lit(3)))), F.lit(0).cast("long"), lambda a, b: a + b))

        by_hash = F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
        return F.when(F.size(F.array_distinct(hashes)) == F.size(hashes), F.lit(0).cast("long")).otherwise(let(by_hash, places))

    by_word = F.transform(words, lambda w: F.xxhash64(w))
    hashes = let(by_word, lambda hs: F.transform(F.sequence(F.lit(0), last), lambda i: F.xxhash64(F.get(hs, i), F.get(hs, i + 1), F.get(hs, i + 2))))
    return F.when(last >= 0, let(hashes, covered)).otherwise(F.lit(0).cast("long"))


def measure(docs: DataFrame, keep: list[str]) -> DataFrame:
    """The columns in ``keep`` and the counts and measures of each text."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    own = docs.select(*[F.col(c) for c in keep], F.col("lang").alias("_lang"), F.col("source").alias("_source"), text.alias("_text"))
    own = own.withColumn("_words", F.array_remove(F.split("_text", SPACE + "+"), ""))
    own = own.withColumn("_lines", F.filter(F.split("_text", "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]")))
    found = lambda pattern: F.regexp_count("_text", F.lit(pattern)).cast("long")
    # a generator, so that no filter above makes the optimiser repeat the work inside
    counts = F.struct(
        F.size("_words").cast("long").alias("n_words"),
        (F.length("_text").cast("long") - found(SPACE)).alias("word_chars"),
        found(f"[{SYMBOLS}]").alias("n_symbols"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
        repeated_words(F.col("_words")).alias("n_repeat_words"),
        F.size(F.array_distinct("_words")).cast("long").alias("n_distinct"),
        found(r"[^\p{L}\p{M}\p{N}\x20\x09-\x0D]").alias("n_marks"),
        found(r"\p{Lu}").alias("n_upper"),
    )
    own = own.select(*keep, "_lang", "_source", F.inline(F.array(counts)))
    rate = lambda x, of, times: F.expr(f"cast({times} * {x} div greatest({of}, 1L) as long)")
    return own.withColumns({
        "base_failed": (F.col("n_words") < MIN_WORDS) | (F.col("n_repeat_words") * 100 > F.col("n_words") * 50),
        "marks_ptt": rate("n_marks", "word_chars", 10000),
        "upper_ptt": rate("n_upper", "word_chars", 10000),
        "word_length_c": rate("word_chars", "n_words", 100),
        # grows little with length, as vocabularies grow about as the power 3/4; the root is exact on every engine
        "sameness_pm": F.expr("cast(floor(1000.0D * n_words * sqrt(cast(n_words as double)) / greatest(n_distinct * n_distinct, 1L)) as long)"),
    })


def _shift(value: Column) -> Column:
    return F.greatest(F.length(F.bin(value)) - SKETCH_BITS, F.lit(0))


def bucket(value: Column) -> Column:
    """The lower edge of the sketch bucket of a whole number of at least 0."""
    shift = _shift(value)
    return F.call_function("shiftleft", F.call_function("shiftright", value, shift), shift)


def width(edge: Column) -> Column:
    """The number of values in the bucket at ``edge``."""
    return F.call_function("shiftleft", F.lit(1).cast("long"), _shift(edge))


def sketch(measured: DataFrame) -> DataFrame:
    """(_lang, _source, measure, bucket, n): the mergeable sketch of each measure."""
    pairs = F.array(*[F.struct(F.lit(m).alias("measure"), F.col(m).alias("value")) for m in MEASURES])
    long = measured.where(~F.col("base_failed")).select("_lang", "_source", F.inline(pairs)).withColumn("bucket", bucket(F.col("value")))
    return long.groupBy("_lang", "_source", "measure", "bucket").agg(F.count(F.lit(1)).alias("n"))


def thresholds(sketches: DataFrame) -> DataFrame:
    """(_lang, _source, a column for each measure): the largest value that passes."""
    sketches = cut(sketches, "sketches")
    levels = {"own": ["_lang", "_source"], "lang": ["_lang"], "all": []}
    found = None
    for level, keys in levels.items():
        merged = sketches.groupBy(*keys, "measure", "bucket").agg(F.sum("n").alias("n"))
        upto = Window.partitionBy(*keys, "measure").orderBy("bucket")
        merged = merged.withColumn("seen", F.sum("n").over(upto)).withColumn("total", F.sum("n").over(Window.partitionBy(*keys, "measure")))
        at = lambda pm: F.min(F.when(F.col("seen") * 1000 >= F.col("total") * pm, F.col("bucket")))  # noqa: B023, E731
        part = merged.groupBy(*keys, "measure").agg(F.max("total").alias(f"n_{level}"), at(500).alias(f"mid_{level}"), at(250).alias("q25"))
        # null where the sketch shows no distance
        part = part.withColumn(f"spread_{level}", F.nullif(F.col(f"mid_{level}") - F.col("q25"), F.lit(0).cast("long"))).drop("q25")
        if found is None:
            found = part
        else:
            left, right = found.alias("a"), part.alias("b")
            on = F.col("a.measure") == F.col("b.measure")
            for k in keys:
                on = on & F.col(f"a.{k}").eqNullSafe(F.col(f"b.{k}"))
            found = left.join(right, on).select("a.*", f"b.n_{level}", f"b.mid_{level}", f"b.spread_{level}")
    own, lang = F.col("n_own") >= LEAST_ROWS, F.col("n_lang") >= LEAST_ROWS
    mid = F.when(own, F.col("mid_own")).when(lang, F.col("mid_lang")).otherwise(F.col("mid_all"))
    spread = F.coalesce(F.when(own, F.col("spread_own")), F.when(own | lang, F.col("spread_lang")), F.col("spread_all"), width(mid))
    top = mid + SPREADS * spread + width(mid) - 1
    return found.groupBy("_lang", "_source").agg(*[F.max(F.when(F.col("measure") == m, top)).alias(f"top_{m}") for m in MEASURES])


def judge(measured: DataFrame, tops: DataFrame) -> DataFrame:
    """``measured`` with the thresholds of its group and ``kept``."""
    m, t = measured.alias("m"), small(tops).alias("t")
    on = F.col("m._lang").eqNullSafe(F.col("t._lang")) & F.col("m._source").eqNullSafe(F.col("t._source"))
    joined = m.join(t, on, "left").select("m.*", *[f"t.top_{x}" for x in MEASURES])
    within = ~F.col("base_failed")
    for x in MEASURES:
        within = within & (F.col(x) <= F.col(f"top_{x}"))
    return joined.withColumn("kept", F.coalesce(within, F.lit(False)))


def apply_rules(docs: DataFrame) -> DataFrame:
    """(doc_id, counts, measures, thresholds, base_failed, kept) for each row of ``docs``."""
    measured = cut(measure(docs, ["doc_id"]), "measures")
    return judge(measured, cut(thresholds(sketch(measured)), "thresholds")).drop("_lang", "_source")


def filter_documents(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that the rules keep, with its columns."""
    names = [f"_c{i}" for i in range(len(docs.columns))]
    tagged = docs.select("text", "lang", "source", *[F.col(c).alias(n) for c, n in zip(docs.columns, names, strict=True)])
    measured = cut(measure(tagged, names), "measured")
    kept = judge(measured, cut(thresholds(sketch(measured)), "thresholds")).where("kept")
    return kept.select(*[F.col(n).alias(c) for n, c in zip(names, docs.columns, strict=True)])
