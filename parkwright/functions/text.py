"""Text expressions: normalisers, edit counts, loop scores. All are built-in column functions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def let(value: Column, body) -> Column:
    """``body`` of ``value``, evaluated once a row however often it is named."""
    return F.transform(F.array(value), body)[0]


def once(rows: DataFrame, **columns: Column) -> DataFrame:
    """``rows`` with ``columns`` out of a generator: the optimiser repeats what is inside neither in a lambda that names it nor for a filter above."""
    return rows.select(*[c for c in rows.columns if c not in columns], F.inline(F.array(F.struct(*[c.alias(name) for name, c in columns.items()]))))


def text(c: Column | str) -> Column:
    """A null text counts as empty."""
    return F.coalesce(F.col(c) if isinstance(c, str) else c, F.lit(""))


def strip(c: Column) -> Column:
    """Without white space at either end; ``trim`` knows spaces only."""
    return F.regexp_replace(c, r"^\s+|\s+$", "")


def words_on_space(c: Column) -> Column:
    return F.array_remove(F.split(c, " "), "")


def raw_words(c: Column) -> Column:
    """Words of unnormalised text: runs of white space collapse to a space, then split at spaces."""
    return words_on_space(strip(F.regexp_replace(c, r"\s\s+", " ")))


def simple(c: Column) -> Column:
    """Lower case, stripped, all white space collapsed."""
    return strip(F.regexp_replace(F.lower(c), r"\s+", " "))


def plain(c: Column) -> Column:
    """Lower case, stripped, runs of white space collapsed, punctuation deleted."""
    return F.regexp_replace(F.regexp_replace(strip(F.lower(c)), r"\s\s+", " "), r"\p{P}", "")


def plain_words(c: Column) -> Column:
    return words_on_space(plain(c))


def plain_chars(c: Column) -> Column:
    """``plain`` without any white space, as one string of characters."""
    return F.regexp_replace(plain(c), r"\s", "")


def align_words(c: Column) -> Column:
    """Words for forced alignment: apostrophes stay, other marks part words."""
    return F.array_remove(F.split(strip(F.regexp_replace(F.lower(c), r"(?U)[^\w\s']", " ")), r"(?U)\s+"), "")


def error_text(c: Column) -> Column:
    """Text for error analysis: every mark parts words."""
    return strip(F.regexp_replace(F.regexp_replace(F.lower(c), r"(?U)[^\w\s]", " "), r"(?U)\s+", " "))


def tokens(c: Column) -> Column:
    """Runs of Latin letters of lower-cased text."""
    return F.regexp_extract_all(F.lower(c), F.lit("([a-zA-ZÀ-ÿ]+)"), 1)


def polish(c: Column) -> Column:
    """Upper-case the first letter and each first letter after a sentence end, however much white space lies between."""

    def raised(parts: Column) -> Column:
        # white space belongs to the part before it, and so does what it follows
        begins = lambda i: F.when(i == 0, F.get(parts, i).rlike(r"^[a-zà-ɏ]")).otherwise(F.get(parts, i - 1).rlike(r"[.!?]\s+$"))
        return F.transform(parts, lambda p, i: F.when(begins(i), F.concat(F.upper(F.substring(p, 1, 1)), F.substr(p, F.lit(2)))).otherwise(p))

    return F.array_join(let(F.split(strip(c), r"(?<=\s)(?=[a-zà-ɏ])"), raised), "")


def collapse_runs(words: Column) -> Column:
    """Without words that repeat the one before, in any case."""
    return let(words, lambda ws: F.filter(ws, lambda w, i: (i == 0) | (F.lower(w) != F.lower(F.element_at(ws, F.greatest(i, F.lit(1)))))))


#: Characters for coded words: from 256 up, without the 2,048 that stand for halves of others, and two for words of one side.
_CODES, _HALVES = 0x110000 - 256 - 2048 - 2, 0xD800 - 256


def _coded(words: Column, shared: Column, alone: int) -> Column:
    """One character for each word, so that a character distance counts words; ``alone`` for words that only this side has."""
    place = lambda w: F.array_position(shared, w) + 1
    code = lambda p: F.when(p == 1, alone).when(p < _HALVES, p + 256).otherwise(p + 256 + 2048)
    unit = lambda w: F.decode(F.unhex(F.lpad(F.hex(let(place(w), code)), 8, "0")), "UTF-32")
    return F.array_join(F.transform(words, unit), "")


def _edits_by_rows(r: Column, h: Column) -> Column:
    """The edit distance of two arrays row by row, for pairs with more shared words than there are characters."""

    def next_row(above: Column, word: Column) -> Column:
        def cell(a: Column, j: Column) -> Column:
            least = F.least(F.get(above, j) + 1, a["left"] + 1, F.get(above, j - 1) + F.when(F.get(h, j - 1) == word, 0).otherwise(1))
            return F.struct(least.cast("int").alias("left"), F.array_append(a["row"], least.cast("int")).alias("row"))

        first = (F.get(above, F.lit(0)) + 1).cast("int")
        return F.aggregate(F.sequence(F.lit(1), F.size(h)), F.struct(first.alias("left"), F.array(first).alias("row")), cell, lambda a: a["row"])

    rows = F.aggregate(r, F.transform(F.sequence(F.lit(0), F.size(h)), lambda j: j), next_row)
    return F.when(F.size(h) == 0, F.size(r)).otherwise(F.element_at(rows, -1)).cast("int")


def word_edits(reference: Column, hypothesis: Column, codes: int = _CODES) -> Column:
    """Least word insertions, deletions and substitutions between two word arrays.

    Words of one side never match, whatever they are, so only shared words need a code
    of their own; pairs that share more than ``codes`` are compared row by row.
    """
    pair = F.struct(reference.alias("r"), hypothesis.alias("h"))

    def edits(p: Column) -> Column:
        coded = lambda v: F.struct(_coded(p["r"], v, 32).alias("r"), _coded(p["h"], v, 33).alias("h"))
        by_codes = lambda v: let(coded(v), lambda c: _distance(c["r"], c["h"]))
        return let(F.array_intersect(p["r"], p["h"]), lambda v: F.when(F.size(v) <= codes, by_codes(v)).otherwise(_edits_by_rows(p["r"], p["h"])))

    return let(pair, edits).cast("long")


def _distance(a: Column, b: Column) -> Column:
    """The edit distance of two strings, looked for within 32 edits, then four times as many, and so on: near strings cost little."""
    wider = lambda d, k: F.when(d >= 0, d).otherwise(F.call_function("levenshtein", a, b, F.call_function("shiftleft", F.lit(32), 2 * k)))
    return F.aggregate(F.sequence(F.lit(0), F.lit(12)), F.lit(-1), wider)


def char_edits(reference: Column, hypothesis: Column) -> Column:
    """Least insertions, deletions and substitutions of characters between two strings."""
    return let(F.struct(reference.alias("r"), hypothesis.alias("h")), lambda p: _distance(p["r"], p["h"])).cast("long")


def _repeats(w: Column, n: Column, g: int):
    """A fold from the right: the run of words that equal those ``g`` later, and the most words in whole repeats."""

    def back(a: Column, i: Column) -> Column:
        run = F.when(F.get(w, i.cast("int")) == F.get(w, (i + g).cast("int")), a["run"] + 1).otherwise(F.lit(0).cast("long"))
        score = F.when(i < n - 3 * g, (F.floor(run / g) + 1) * g).otherwise(F.lit(0).cast("long"))
        return F.struct(run.alias("run"), F.greatest(a["best"], score).alias("best"))

    return back


def loop_score(c: Column) -> Column:
    """The longest run of one word, or the most words in repeats of a group of 2, 3 or 4 words."""

    def of_words(w: Column) -> Column:
        n, zero = F.size(w).cast("long"), F.lit(0).cast("long")
        start = F.struct(F.lit("").alias("prev"), zero.alias("run"), zero.alias("best"))

        def extend(a: Column, x: Column) -> Column:
            run = F.when(x == a["prev"], a["run"] + 1).otherwise(F.lit(1).cast("long"))
            return F.struct(x.alias("prev"), run.alias("run"), F.greatest(a["best"], run).alias("best"))

        scores = [F.aggregate(w, start, extend, lambda a: a["best"])]
        for g in (2, 3, 4):
            places = F.when(n > g, F.sequence(n - g - 1, zero, F.lit(-1).cast("long"))).otherwise(F.array().cast("array<bigint>"))

            scores.append(F.aggregate(places, F.struct(zero.alias("run"), zero.alias("best")), _repeats(w, n, g), lambda a: a["best"]))
        return F.greatest(*scores)

    return let(words_on_space(error_text(c)), of_words)


def label(*candidates: Column) -> Column:
    """The base name of the first candidate that isn't blank; null if all are."""
    return F.regexp_extract(F.coalesce(*[F.nullif(strip(F.replace(c, F.lit("\\"), F.lit("/"))), F.lit("")) for c in candidates]), "[^/]*$", 0)


def dataset_spec(c: Column, default: str = "test") -> Column:
    """(repo, split) of 'repo[:split]'; null for blanks."""
    parts = F.split(strip(c), ":", 2)
    split = F.nullif(strip(F.get(parts, F.lit(1))), F.lit(""))
    return F.when(strip(c) != "", F.struct(strip(F.get(parts, F.lit(0))).alias("repo"), F.coalesce(split, F.lit(default)).alias("split")))


def recogniser_text(answer: Column, chunks: Column) -> Column:
    """Text of a recogniser's answer: its stripped text if there is one, else its chunks' texts joined without blanks."""
    kept = F.filter(F.transform(chunks, lambda x: strip(F.coalesce(x, F.lit("")))), lambda x: x != "")
    return F.coalesce(strip(answer), F.array_join(kept, " "), F.lit(""))
