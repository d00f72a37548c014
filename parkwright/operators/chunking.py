"""Clips cut into chunks, and chunk texts put together again."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parkwright.functions.numbers import MAX_CLIP_SECONDS, SAMPLE_RATE
from parkwright.functions.text import align_words, let, once, polish, strip

#: Fixed value: the longest chunk of an aligned clip.
MAX_CHUNK_SECONDS = 28.0


def samples(seconds: float, rate: int = SAMPLE_RATE) -> int:
    return max(1, int(seconds * rate))


def windows(n: Column, size: int, step: int) -> Column:
    """(start, end) of chunks of ``size`` samples every ``step``, the last cut at the end; one for a short clip."""
    n = n.cast("long")
    many = F.least(F.ceil((n - size) / step) + 1, F.ceil(n / step))
    count = F.when(n <= size, F.lit(1).cast("long")).otherwise(many)
    starts = F.sequence(F.lit(0).cast("long"), count - 1)
    return F.transform(starts, lambda i: F.struct((i * step).alias("start"), F.least(i * step + size, n).alias("end")))


def tail_merged(n: Column, size: int, least: int) -> Column:
    """(start, end, padding): cut every ``size``; a last piece under ``least`` joins the one before, a lone one is padded."""
    n = n.cast("long")
    pieces = F.greatest(F.ceil(n / size), F.lit(1).cast("long"))
    short = (pieces > 1) & (n - (pieces - 1) * size < least)
    count = F.when(short, pieces - 1).otherwise(pieces)
    end = lambda i: F.when(i == count - 1, n).otherwise((i + 1) * size)
    pad = lambda i: F.greatest(F.lit(least).cast("long") - (end(i) - i * size), F.lit(0).cast("long"))
    return F.transform(F.sequence(F.lit(0).cast("long"), count - 1), lambda i: F.struct((i * size).alias("start"), end(i).alias("end"), pad(i).alias("padding")))


def cap(values: Column, seconds: float = MAX_CLIP_SECONDS, rate: int = SAMPLE_RATE) -> Column:
    return F.slice(values, 1, samples(seconds, rate))


def downmix(channels: Column) -> Column:
    """One channel of an array of arrays: the mean over the outer one if it is at most 8 long and shorter than the inner, else over the inner."""
    n, mean = F.size(channels), lambda c: F.aggregate(c, F.lit(0.0), lambda a, x: a + x.cast("double")) / F.size(c)
    first = F.get(channels, F.lit(0))
    total = F.aggregate(F.slice(channels, 2, F.greatest(n - 1, F.lit(0))), F.transform(first, lambda x: x.cast("double")), lambda a, c: F.zip_with(a, c, lambda x, y: x + y))
    return F.when((n <= 8) & (n < F.size(first)), F.transform(total, lambda x: x / n)).otherwise(F.transform(channels, mean))


def packed_spans(spans: Column, most: float) -> Column:
    """Places of (start, end) spans packed greedily into chunks no longer than ``most`` seconds.

    One walk notes where chunks begin; only there is anything appended, so the walk is linear in the spans.
    """
    ints = "array<int>"

    def fold(s: Column) -> Column:
        def step(a: Column, i: Column) -> Column:
            new = F.get(s, i)["end"] - a["start"] > most
            return F.struct(F.when(new, F.get(s, i)["start"]).otherwise(a["start"]).alias("start"), F.when(new, F.array_append(a["firsts"], i)).otherwise(a["firsts"]).alias("firsts"))

        later = F.filter(F.sequence(F.lit(0), F.size(s) - 1), lambda i: i > 0)
        firsts = F.aggregate(later, F.struct(F.get(s, F.lit(0))["start"].alias("start"), F.array(F.lit(0)).alias("firsts")), step, lambda a: a["firsts"])
        return let(firsts, lambda at: F.transform(at, lambda x, k: F.sequence(x, F.coalesce(F.get(at, k + 1), F.size(s)) - 1)))

    return let(spans, lambda s: F.when(F.size(s) > 0, fold(s)).otherwise(F.array().cast(f"array<{ints}>")))


def frame_runs(labels: Column, blank: int) -> Column:
    """(label, start, end) runs of equal labels of a frame path, without blanks."""

    def runs(p: Column) -> Column:
        starts = F.filter(F.sequence(F.lit(0), F.size(p) - 1), lambda i: (i == 0) | (F.get(p, i) != F.get(p, i - 1)))
        found = let(starts, lambda at: F.transform(at, lambda s, k: F.struct(F.get(p, s).alias("label"), s.alias("start"), F.coalesce(F.get(at, k + 1), F.size(p)).alias("end"))))
        return F.filter(found, lambda r: r["label"] != blank)

    return let(labels, lambda p: F.when(F.size(p) > 0, runs(p)).otherwise(F.array().cast("array<struct<label:int,start:int,end:int>>")))


def checked_runs(labels: Column, targets: Column, blank: int) -> Column:
    """(runs, error): the runs of a frame path, and why they don't spell ``targets``, if they don't."""

    def check(p: Column) -> Column:
        runs, want = p["runs"], p["targets"]
        found = F.transform(runs, lambda r: r["label"])
        error = (
            F.when(F.size(want) == 0, "no targets").when(F.size(runs) != F.size(want), "wrong number of labels")
            .when(found != want, "wrong label")
        )
        return F.struct(runs.alias("runs"), error.alias("error"))

    return let(F.struct(frame_runs(labels, blank).alias("runs"), targets.alias("targets")), check)


def seconds_of(runs: Column, n_samples: Column, n_frames: Column, rate: int = SAMPLE_RATE) -> Column:
    """(start, end) in seconds of frame runs."""
    one = n_samples / F.lit(rate) / n_frames
    return F.transform(runs, lambda r: F.struct((r["start"] * one).alias("start"), (r["end"] * one).alias("end")))


def chosen_words(text: Column) -> Column:
    """The words as written, or the normalised ones if their numbers differ."""
    both = F.struct(F.array_remove(F.split(strip(text), r"\s+"), "").alias("written"), align_words(text).alias("normal"))
    return let(both, lambda w: F.when(F.size(w["written"]) == F.size(w["normal"]), w["written"]).otherwise(w["normal"]))


def token_ranges(words: Column, letters: str, separator: bool = True) -> Column:
    """(labels, ranges): a label for each letter that ``letters`` has, by its place from 1, and one more between words; where each word's begin and end."""
    clean = F.transform(words, lambda w: F.regexp_replace(w, f"[^{letters}]", ""))

    label = F.lit(len(letters) + 1)
    spelt = lambda w: F.when(w != "", F.transform(F.split(w, ""), lambda c: F.instr(F.lit(letters), c))).otherwise(F.array().cast("array<int>"))

    def of(ws: Column) -> Column:
        gap = lambda i: F.when(i < F.size(ws) - 1, F.array(label)).otherwise(F.array().cast("array<int>"))

        def ranged(marked: Column) -> Column:
            # a word ends at the mark after it, the last at the end; without marks all after one move up by one
            ends = F.filter(F.sequence(F.lit(0), F.size(marked)), lambda i: (i == F.size(marked)) | (F.get(marked, i) == label))
            moved = lambda place, k: place if separator else place - k
            first = lambda at, k: F.when(k > 0, F.get(at, k - 1) + 1).otherwise(0)
            ranges = let(ends, lambda at: F.transform(ws, lambda w, k: F.struct(moved(first(at, k), k).alias("start"), moved(F.get(at, k), k).alias("end"))))
            return F.struct((marked if separator else F.filter(marked, lambda x: x != label)).alias("labels"), ranges.alias("ranges"))

        return let(F.flatten(F.transform(ws, lambda w, i: F.concat(spelt(w), gap(i)))), ranged)

    return let(clean, of)


def word_spans(path: Column, tokens: Column, blank: int, n_samples: Column, rate: int = SAMPLE_RATE) -> Column:
    """(spans, error): seconds of each word that has a letter, from a frame path that must spell the ``tokens`` (labels, ranges)."""

    def of(t: Column) -> Column:
        checked = checked_runs(path, t["labels"], blank)

        def timed(x: Column) -> Column:
            seconds = seconds_of(x["runs"], n_samples, F.size(path), rate)
            of_word = lambda at: F.transform(F.filter(t["ranges"], lambda r: r["end"] > r["start"]), lambda r: F.struct(F.get(at, r["start"])["start"].alias("start"), F.get(at, r["end"] - 1)["end"].alias("end")))
            return F.struct(F.when(x["error"].isNull(), let(seconds, of_word)).alias("spans"), x["error"].alias("error"))

        return let(checked, timed)

    return let(tokens, of)


def chunked(clips: DataFrame, spans: str, reassembly: bool = False, most: float = MAX_CHUNK_SECONDS) -> DataFrame:
    """Clips (clip_id, text, duration_s, n_samples, ...) cut at their words' ``spans`` into chunks of at most ``most`` seconds.

    Short clips and clips without text pass unsplit, and so do those without spans,
    whose alignment failed; ``outcome`` tells which, so that failures can be counted.
    ``start`` and ``end`` are samples. With ``reassembly`` the rows also have
    full_text and num_chunks.
    """
    text = strip(F.coalesce(F.col("text"), F.lit("")))
    outcome = F.when((F.col("duration_s") <= MAX_CLIP_SECONDS) | (text == ""), "passed").when(F.coalesce(F.size(spans), F.lit(0)) <= 0, "failed").otherwise("chunked")
    # the words are looked up once for each word, and the pieces are filtered: both are made once a row
    rows = once(clips, outcome=outcome, full_text=text, _words=chosen_words(text))
    whole = F.array(F.struct(F.lit(0).cast("long").alias("start"), F.col("n_samples").cast("long").alias("end"), F.col("text").alias("text")))
    at = lambda i: F.get(F.col(spans), i)

    def cut_at(c: Column) -> Column:
        start, end = at(F.element_at(c, 1))["start"], at(F.element_at(c, -1))["end"]
        words = F.transform(c, lambda j: F.get(F.col("_words"), j))
        return F.struct(
            F.greatest(F.floor(start * SAMPLE_RATE), F.lit(0).cast("long")).alias("start"), F.least(F.floor(end * SAMPLE_RATE), F.col("n_samples").cast("long")).alias("end"), F.array_join(words, " ").alias("text")
        )

    pieces = F.when(F.col("outcome") == "chunked", F.transform(packed_spans(F.col(spans), most), cut_at)).otherwise(whole)
    kept = [c for c in clips.columns if c not in (spans, "text")]
    out = once(rows, _pieces=pieces).select(*kept, "outcome", "full_text", F.size("_pieces").alias("num_chunks"), F.posexplode("_pieces").alias("chunk_index", "_p"))
    out = out.select(*kept, "outcome", "full_text", "num_chunks", "chunk_index", "_p.start", "_p.end", "_p.text")
    return out if reassembly else out.drop("full_text", "num_chunks")


def routed(clips: DataFrame, spans: str, chunk_test: bool = False) -> DataFrame:
    """All splits: train and validation chunked, test too if asked, with what reassembly needs; else test gets chunk_index 0, and others stay as they are."""
    split = F.coalesce(F.col("split"), F.lit(""))
    trained = chunked(clips.where(split.isin("train", "validation")), spans)
    rest = clips.where(~split.isin("train", "validation", "test")).drop(spans)
    test = clips.where(split == "test")
    test = chunked(test, spans, reassembly=True) if chunk_test else test.drop(spans).withColumn("chunk_index", F.lit(0))
    return trained.unionByName(test, allowMissingColumns=True).unionByName(rest, allowMissingColumns=True)


def reassembled(chunks: DataFrame, keys: list[str], place: str, hypothesis: str) -> DataFrame:
    """One row a clip: chunk texts stripped, blanks dropped, joined in order with one space, polished."""
    parts = F.array_sort(F.collect_list(F.struct(F.col(place).alias("p"), F.col(hypothesis).alias("h"))))
    kept = F.filter(F.transform(parts, lambda x: strip(F.coalesce(x["h"], F.lit("")))), lambda x: x != "")
    return chunks.groupBy(*keys).agg(F.count(F.lit(1)).alias("num_chunks"), polish(F.array_join(kept, " ")).alias("full_text"))


def chunk_seconds(asked: float | None, longest: Column) -> Column:
    """The chunk length to use: one asked for, none if it isn't positive, else 30 s if any clip is longer."""
    if asked is not None:
        return F.lit(float(asked) if asked > 0 else None).cast("double")
    return F.when(longest > MAX_CLIP_SECONDS, F.lit(MAX_CLIP_SECONDS))
