"""Expressions against short plain versions, over random and edge inputs."""

import random
import re

import pytest
from pyspark.sql import functions as F

from parkwright.functions import bits
from parkwright.functions import numbers as N
from parkwright.functions import text as T
from parkwright.operators import audit
from parkwright.operators import chunking as C
from parkwright.operators import audio, errors, flac, gates, merging, predictors, ranking, scoring
from parkwright.sources import sinks, tables
from parkwright.sources.shared import new_path

R = random.Random(11)
EDGES = ["", " ", "\n", "...", "one", "Élan vital, déjà", "a a A b b", "x. y!  z?", "don't stop", "tab\tand  spaces \n end.", None, "$5 + 3% (off)", "hiyo.A"]


def random_words(n, k):
    return " ".join(R.choice("abcdefgh"[:k]) for _ in range(n))


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def test_edits(spark):
    rows = [(random_words(R.randrange(12), 4).split(), random_words(R.randrange(12), 4).split()) for _ in range(300)]
    got = spark.createDataFrame(rows, "r array<string>, h array<string>").select("r", "h", T.word_edits(F.col("r"), F.col("h")).alias("e")).collect()
    assert all(x["e"] == distance(x["r"], x["h"]) for x in got)
    assert all(distance(x["r"], x["h"]) == sum(max(len(a.split()), len(b.split())) for _, a, b in errors.align(x["r"], x["h"])) for x in got)


def test_edits_of_more_words_than_codes(spark):
    """Pairs of any vocabulary: row by row where shared words outnumber the characters, and 60,000 different words by characters."""
    rows = [(random_words(R.randrange(9), 6).split(), random_words(R.randrange(9), 6).split()) for _ in range(120)]
    got = spark.createDataFrame(rows, "r array<string>, h array<string>").select("r", "h", T.word_edits(F.col("r"), F.col("h"), codes=2).alias("e")).collect()
    assert all(x["e"] == distance(x["r"], x["h"]) for x in got)
    many = spark.range(1).select(F.transform(F.sequence(F.lit(1), F.lit(60_000)), lambda i: F.concat(F.lit("w"), i)).alias("r"))
    near = F.transform(F.filter("r", lambda w, i: i != 59_990), lambda w, i: F.when(i == 57_000, "other").otherwise(w))
    assert many.select(T.word_edits(F.col("r"), near).alias("e")).first()["e"] == 2


def test_char_edits(spark):
    rows = [("".join(R.choice("abc é") for _ in range(R.randrange(k))), "".join(R.choice("abc é") for _ in range(R.randrange(k)))) for k in (1, 5, 60, 120) for _ in range(40)] + [("a" * 900, "b" * 700), ("ab" * 300, "ba" * 300)]
    got = spark.createDataFrame(rows, "r string, h string").select("r", "h", T.char_edits(F.col("r"), F.col("h")).alias("e")).collect()
    assert all(x["e"] == distance(x["r"], x["h"]) for x in got)


def plain_steps(a, b):
    """The whole table, walked back from its end."""
    d = [list(range(len(b) + 1))]
    for i, x in enumerate(a, 1):
        row = [i]
        for j, y in enumerate(b, 1):
            row.append(min(d[-1][j] + 1, row[-1] + 1, d[-1][j - 1] + (x != y)))
        d.append(row)
    out, i, j = [], len(a), len(b)
    while i or j:
        if i and j and d[i][j] == d[i - 1][j - 1] + (a[i - 1] != b[j - 1]):
            i, j = i - 1, j - 1
            out.append("equal" if a[i] == b[j] else "substitute")
        elif i and d[i][j] == d[i - 1][j] + 1:
            i -= 1
            out.append("delete")
        else:
            j -= 1
            out.append("insert")
    return d[-1][-1], out[::-1]


def test_bits_of_edits():
    """Distances and canonical alignments on bits, against the whole table."""
    for _ in range(1500):
        k = R.randrange(1, 6)
        a, b = ([R.choice("abcde"[:k]) for _ in range(R.randrange(14))] for _ in range(2))
        assert (bits.distance(a, b), bits.steps(a, b)) == plain_steps(a, b)
    a, b = ([R.choice("ab") for _ in range(700)] for _ in range(2))
    assert (bits.distance(a, b), bits.steps(a, b)) == plain_steps(a, b)


def test_long_pairs(spark):
    """20,000 words with 3,000 changed, and 100,000 characters with 2,000 changed, left out or put in; short pairs beside them."""
    words = [f"word{R.randrange(30_000)}" for _ in range(20_000)]
    heard = [w if i % 7 else "other" for i, w in enumerate(words)]
    letters = "".join(R.choice("abcdefgh") for _ in range(100_000))
    typed = "".join("" if i % 100 == 3 else c + "z" if i % 100 == 50 else c for i, c in enumerate(letters))
    rows = [(" ".join(words), " ".join(heard)), (letters, typed), ("a b", "a c"), (None, "x" * 9000), ("", "x"), ("x" * 9000, None)]
    got = [(r["word_edits"], r["char_edits"]) for r in scoring.scored(spark.createDataFrame(rows, "reference string, prediction string")).collect()]
    assert got[0][0] == 2858 and got[1] == (1, 2000) and got[2] == (1, 1) and got[3:] == [(None, None), (None, None), (1, 9000)]


def plain_loop(text):
    """The longest run of one word; for groups of 2 to 4, how far the repeats reach from each start that leaves three groups."""
    w = text.split()
    best = max((sum(1 for _ in run) for run in _runs(w)), default=0)
    for g in (2, 3, 4):
        for i in range(len(w) - 3 * g):
            n = 1
            while w[i + n * g : i + (n + 1) * g] == w[i : i + g]:
                n += 1
            best = max(best, n * g)
    return best


def _runs(w):
    import itertools

    return [list(g) for _, g in itertools.groupby(w)]


def test_loops(spark):
    rows = [(random_words(R.randrange(30), R.choice([1, 2, 3])),) for _ in range(400)]
    assert all(x["s"] == plain_loop(x["t"]) for x in spark.createDataFrame(rows, "t string").select("t", T.loop_score(F.col("t")).alias("s")).collect())


def test_normalisers(spark):
    got = spark.createDataFrame([(x,) for x in EDGES], "t string").select("t", T.simple(T.text("t")).alias("s"), T.align_words(T.text("t")).alias("a"), T.raw_words(T.text("t")).alias("r"), T.polish(T.text("t")).alias("p"), T.tokens(T.text("t")).alias("k")).collect()
    for x in got:
        t = x["t"] or ""
        assert x["s"] == " ".join(t.lower().split())
        assert x["a"] == re.sub(r"[^\w\s']", " ", t.lower()).split()
        assert x["k"] == re.findall(r"[a-zA-ZÀ-ÿ]+", t.lower())
        low = t.strip()
        want = re.sub(r"(^|[.!?]\s+)([a-zà-ɏ])", lambda m: m[1] + m[2].upper(), low)
        assert x["p"] == want


def test_polish_over_wide_gaps(spark):
    for text, want in ((f"one.{' ' * 100}two", f"One.{' ' * 100}Two"), (f"a!{chr(10) * 70}b? \t c d", f"A!{chr(10) * 70}B? \t C d"), ("x .y", "X .y"), ("1. é", "1. É")):
        assert spark.createDataFrame([(text,)], "t string").select(T.polish(F.col("t"))).first()[0] == want


@pytest.mark.parametrize(("size", "step"), [(10, 10), (10, 4), (7, 9), (1, 1)])
def test_windows(spark, size, step):
    def plain(n):
        out, at = [], 0
        while True:
            out.append((at, min(at + size, n)))
            at += step
            if at >= n or out[-1][1] >= n:
                return out

    got = spark.range(60).select("id", C.windows(F.col("id"), size, step).alias("w")).collect()
    assert all([tuple(p) for p in x["w"]] == plain(x["id"]) for x in got)


def test_tails(spark):
    for x in spark.range(90).select("id", C.tail_merged(F.col("id"), 20, 6).alias("w")).collect():
        n, w = x["id"], [tuple(p) for p in x["w"]]
        assert w[0][0] == 0 and w[-1][1] == n and all(a[1] == b[0] for a, b in zip(w, w[1:], strict=False))
        assert all(e - s + pad >= 6 for s, e, pad in w) and (len(w) == 1 or all(pad == 0 for *_, pad in w))


def test_packed_spans(spark):
    def plain(spans):
        out, cur, start = [], [], None
        for i, (s, e) in enumerate(spans):
            if cur and e - start > 5.0:
                out, cur = [*out, cur], []
            start = s if not cur else start
            cur = [*cur, i]
        return [*out, cur] if cur else out

    rows = []
    for k in range(200):
        at, spans = 0.0, []
        for _ in range(R.randrange(12)):
            s = at + R.random()
            at = s + R.random() * 4
            spans.append((s, at))
        rows.append((k, spans))
    df = spark.createDataFrame(rows, "k int, s array<struct<start:double,end:double>>")
    assert all(x["c"] == plain([tuple(p) for p in x["s"]]) for x in df.select("s", C.packed_spans(F.col("s"), 5.0).alias("c")).collect())


def test_frame_runs(spark):
    rows = [([R.randrange(3) for _ in range(R.randrange(12))],) for _ in range(100)]
    for x in spark.createDataFrame(rows, "p array<int>").select("p", C.frame_runs(F.col("p"), 0).alias("r")).collect():
        at, want = 0, []
        for run in _runs(x["p"]):
            want += [(run[0], at, at + len(run))] if run[0] else []
            at += len(run)
        assert [tuple(r) for r in x["r"]] == want


def test_blank_references_are_not_scored(spark):
    rows = [("a b", "a b"), (None, "x"), ("  \n", "x"), ("a b", None), ("...", "x")]
    total = scoring.grouped(scoring.scored(spark.createDataFrame(rows, "reference string, prediction string"), "jiwer_default"), []).first()
    assert (total["n"], total["n_scored"], total["word_edits"], total["n_words"]) == (5, 3, 3, 4)
    nothing = scoring.grouped(scoring.scored(spark.createDataFrame(rows[1:3], "reference string, prediction string")), [])
    assert nothing.first()["wer"] is None
    with pytest.raises(Exception, match="no pair has a reference"):
        scoring.require_scored(nothing).collect()
    with pytest.raises(ValueError):
        scoring.units("other", F.lit(""))


def test_row_index_and_ties(spark):
    df = spark.createDataFrame([(i % 3, i) for i in range(200)], "g int, v int").repartition(5)
    got = ranking.grouped_rank(df, ["g"], ["v"], "n").collect()
    assert all(x["n"] == x["v"] // 3 for x in got)
    same = ranking.row_index(df.select(F.lit(1).alias("a")), ["a"]).collect()
    assert sorted(x["row_idx"] for x in same) == list(range(200))


def test_quantiles_between_ranks(spark):
    import numpy as np

    for n in (1, 2, 7, 200):
        values = [R.random() * 10 for _ in range(n)]
        df = spark.createDataFrame([(v,) for v in [*values, None]], "v double").repartition(3)
        got = ranking.interpolated(df, "v", {"a": 0.5, "b": 0.9, "c": 0.0, "d": 1.0}).first()
        assert np.allclose(list(got), np.quantile(values, [0.5, 0.9, 0, 1]))
    nothing = spark.createDataFrame([(None,)], "v double")
    assert audit.describe(nothing, "v").first()["p50"] is None and errors.middle(nothing, "v").first()["median"] is None


def test_run_lengths(spark):
    import itertools

    rows = [(R.randrange(3), i, R.choice("ab")) for i in range(300)]
    got = ranking.run_lengths(spark.createDataFrame(rows, "k int, i int, c string").repartition(4), ["k"], ["i"], "c", "i").collect()
    want = []
    for k in range(3):
        own = [(i, c) for kk, i, c in rows if kk == k]
        want += [(k, run[0][0], len(run)) for _, g in itertools.groupby(own, key=lambda x: x[1]) for run in [list(g)]]
    assert sorted(map(tuple, got)) == sorted(want)


def test_as_of(spark):
    left, right = [("f", R.randrange(400)) for _ in range(60)], [("f", x) for x in R.sample(range(400), 40)]
    left = list(set(left))
    make = lambda rows: spark.createDataFrame(rows, "file string, line long")
    want, used = {}, set()
    for _, at in sorted(left):
        near = max((r for _, r in right if at - 5 <= r <= at), default=None)
        want[at] = near if near not in used else None
        used.add(near)
    for span in (7, 100_000):
        got = {x["line"]: x["matched"] for x in merging.as_of(make(left), make(right), "file", "line", 5, span).collect()}
        assert got == want


def test_columns_by_candidates(spark):
    assert tables.resolve(["X", "SENTENCE", "Text"], tables.TEXT_COLUMNS) == "Text"
    assert tables.resolve(["text", "TEXT"], tables.TEXT_COLUMNS) == "TEXT"
    assert tables.resolve(["a", "b"], tables.TEXT_COLUMNS, "B") == "b"
    with pytest.raises(ValueError):
        tables.resolve(["a"], tables.AUDIO_COLUMNS)


def test_csv_round_trip_of_edges(spark):
    rows = [(str(i), x if x is not None else "", 'quote " and, comma') for i, x in enumerate(EDGES)]
    df = spark.createDataFrame(rows, "id string, a string, b string")
    back = tables.csv(spark, sinks.csv(df, new_path(spark, "csv")), ["id", "a", "b"])
    assert sorted(map(tuple, back.collect())) == sorted(rows)


def test_result_files(spark, tmp_path):
    """A JSON array and a CSV file as Python's own writers give them."""
    import csv
    import io
    import json

    rows = [(i, t, None if i % 2 else 0.1 * i, None) for i, t in enumerate(["", 'quote " and, comma', "Élan\nvital", None])]
    df = spark.createDataFrame(rows, "id long, text string, rate double, audio_path string").repartition(2)
    as_dicts = [dict(zip(df.columns, r, strict=True)) for r in rows]
    path = sinks.json_array(df, ["id"], f"file://{tmp_path}/a.json")
    assert (tmp_path / "a.json").read_text(encoding="utf-8") == json.dumps(as_dicts, indent=2, ensure_ascii=False) + "\n" and path.endswith("a.json")
    sinks.json_array(df.limit(0), ["id"], f"file://{tmp_path}/a.json")
    assert (tmp_path / "a.json").read_text(encoding="utf-8") == "[]\n"
    sinks.csv_file(df, ["id"], f"file://{tmp_path}/a.csv", optional=("audio_path",))
    out = io.StringIO(newline="")
    w = csv.DictWriter(out, fieldnames=["id", "text", "rate"], extrasaction="ignore")
    w.writeheader()
    w.writerows(as_dicts)
    assert (tmp_path / "a.csv").read_bytes().decode() == out.getvalue()
    assert sinks.csv_file(df.limit(0), ["id"], f"file://{tmp_path}/b.csv") is None and not (tmp_path / "b.csv").exists()


def test_files_of_many_parts(spark, tmp_path, monkeypatch):
    """Rows in many parts, some of them empty: the bytes are those of the plain writers, no task has more than a share, and parts are joined in order."""
    import csv
    import io
    import json

    rows = [(i, f'line "{i}"\n  }}, next' if i % 7 else "é,\r\n", [i, None], None if i % 5 else {"k": i}) for i in range(5000)]
    df = spark.createDataFrame(rows, "id long, text string, list array<long>, map map<string, long>").repartition(16)
    as_dicts = [dict(zip(df.columns, r, strict=True)) for r in rows]
    as_dicts = [d | {"map": None if d["map"] is None else list(d["map"].items())} for d in as_dicts]
    seen, whole = [], sinks.joined_file

    def watched(lines, *args, **options):
        seen.append([r["n"] for r in lines.groupBy(F.spark_partition_id()).agg(F.count(F.lit(1)).alias("n")).collect()])
        return whole(lines, *args, **options)

    monkeypatch.setattr(sinks, "joined_file", watched)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        path = sinks.json_array(df, ["id"], f"file://{tmp_path}/a.json")
        sinks.csv_file(df.select("id", "text"), ["id"], f"file://{tmp_path}/a.csv")
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert (tmp_path / "a.json").read_text(encoding="utf-8") == json.dumps(as_dicts, indent=2, ensure_ascii=False) + "\n"
    out = io.StringIO(newline="")
    csv.writer(out).writerows([("id", "text"), *[r[:2] for r in rows]])
    assert (tmp_path / "a.csv").read_bytes().decode() == out.getvalue()
    assert all(len(n) > 4 and max(n) < 2000 for n in seen) and [f.name for f in sorted(tmp_path.iterdir()) if f.name[0] != "."] == ["a.csv", "a.json"]
    back = tables.indented_array(spark, path, "id long, text string, list array<long>")
    assert sorted((r["id"], r["text"], r["list"]) for r in back.collect()) == sorted(r[:3] for r in rows)
    assert tables.indented_array(spark, sinks.json_array(df.limit(0), ["id"], f"file://{tmp_path}/b.json"), "id long").collect() == []


@pytest.mark.parametrize("able", [True, False])
def test_parts_are_joined_by_the_store(spark, tmp_path, able):
    """A store that concatenates is asked to, and nothing is read; where it can't, files are copied in order."""
    from types import SimpleNamespace

    from pyspark.errors import UnsupportedOperationException

    at, calls = spark.sparkContext._jvm.org.apache.hadoop.fs.Path, []
    for k in range(3):
        (tmp_path / f"p{k}").write_text(f"part {k}\n")
    paths = [at(f"file://{tmp_path}/p{k}") for k in range(3)]
    local = paths[0].getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).getRawFileSystem()

    def concat(whole, files):
        calls.append([f.getName() for f in files])
        if not able:
            raise UnsupportedOperationException("no")

    uri = SimpleNamespace(getScheme=lambda: "blocks")
    sinks._concatenate(spark, SimpleNamespace(getUri=lambda: uri, concat=concat, rename=local.rename, create=local.create, open=local.open), paths[0], paths[1:])
    assert calls == [["p1", "p2"]] and (tmp_path / "p0").read_text() == ("part 0\n" if able else "part 0\npart 1\npart 2\n")


def test_report_lines(spark):
    rows = [("a b c d", "a x c d", 0.25, 10.0)] * 9 + [("a b", "a b c", 0.5, 40.0)] * 13 + [("kuusu b", "kuhusu b", 2.0, None)]
    got = [x["line"] for x in errors.report(spark.createDataFrame(rows, "reference string, prediction string, wer double, seconds double")).orderBy("place").collect()]
    assert got == [
        "Total utterances: 23", "WER normalized: mean=0.467 median=0.500 p90=0.500", "  good: 0 (0.0%)", "  moderate: 9 (39.1%)", "  fair: 13 (56.5%)", "  poor: 0 (0.0%)", "  bad: 0 (0.0%)", "  catastrophic: 1 (4.3%)",
        "Looping preds: 0 (0.0%)", "Lexical shifts:", "     1  kuusu->kuhusu", "Top substitutions:", "     9  'b' -> 'x'", "Top insertions:", "    13  +'c'", "Top deletions:", "WER <30s: n=9 mean=0.250", "WER 30-60s: n=13 mean=0.500",
    ]


def test_frequent_edits(spark):
    """Counts of chunks, of which the k largest are taken before the least count is asked for."""
    from collections import Counter

    rows = [(random_words(R.randrange(12), 4), random_words(R.randrange(12), 4)) for _ in range(300)]
    counts = Counter((kind, r, h) for a, b in rows for kind, r, h in errors.align(a.split(), b.split()))
    rules = {"substitute": (5, 12), "insert": (7, 20), "delete": (6, 1)}
    got = {tuple(x)[:3]: x["n"] for x in errors.frequent_edits(spark.createDataFrame(rows, "reference string, prediction string"), rules).collect()}
    want = {}
    for kind, (k, least) in rules.items():
        own = sorted(((-n, key) for key, n in counts.items() if key[0] == kind))[:k]
        want |= {key: -n for n, key in own if -n >= least}
    assert got == want and len(got) < 18


def test_audio(spark, tmp_path):
    """WAV bytes of several kinds, files, structs, and what can't be read; the filter keeps a low tone and leaves out a high one."""
    import struct
    import wave

    import numpy as np

    x = np.array([[0, 100], [-200, 300], [32767, -32768]])
    with wave.open(str(tmp_path / "a.wav"), "wb") as f:
        f.setnchannels(2)
        f.setsampwidth(2)
        f.setframerate(8000)
        f.writeframes(x.astype("<i2").tobytes())
    assert (tmp_path / "a.wav").read_bytes() == audio.encode_wav(x, 8000)
    frames, rate = audio.decode_wav(audio.encode_wav(x, 8000))
    assert rate == 8000 and np.array_equal(frames * 32768, x)
    form = lambda kind, width, body: b"RIFF\0\0\0\0WAVEfmt " + struct.pack("<IHHIIHH", 16, kind, 1, 8000, 8000 * width, width, 8 * width) + b"LIST" + struct.pack("<I", 3) + b"odd\0data" + struct.pack("<I", len(body)) + body
    assert np.allclose(audio.decode_wav(form(3, 4, np.array([0.5, -0.25], "<f4").tobytes()))[0].ravel(), [0.5, -0.25])
    assert np.allclose(audio.decode_wav(form(1, 3, b"\0\0\x40\0\0\xc0"))[0].ravel(), [0.5, -0.5])
    assert np.allclose(audio.decode_wav(form(1, 1, bytes([128, 192, 0])))[0].ravel(), [0, 0.5, -1])
    rows = [(1, None, None, audio.encode_wav(x, 16000)), (2, [[0.5, 0.25], [0.1, 0.3], [0.0, 1.0]], 16000, None), (3, None, None, b"no sound"), (4, None, None, None), (5, [[0.0] * 40, [1.0] * 40], 16000, None)]
    df = spark.createDataFrame([(i, (a, r, b)) for i, a, r, b in rows], "id int, audio struct<array:array<array<double>>,sampling_rate:int,bytes:binary>")
    got = {r["id"]: r for r in audio.prepared(df, "id", "audio", most_seconds=0.001).collect()}
    assert np.allclose(got[1]["samples"], x.mean(axis=1) / 32768) and np.allclose(got[2]["samples"], [0.375, 0.2, 0.5])
    assert got[3]["error"].startswith("[ERROR") and got[4]["samples"] is None and got[5]["samples"] == [0.5] * 16
    files = audio.prepared(audio.audio_files(spark, f"file://{tmp_path}"), "path", "audio").collect()
    assert len(files) == 1 and len(files[0]["samples"]) == 6 and files[0]["sampling_rate"] == 16000
    t = np.arange(4800) / 48000
    low, high = audio.resampled(np.sin(2 * np.pi * 500 * t), 48000), audio.resampled(np.sin(2 * np.pi * 12000 * t), 48000)
    assert len(low) == 1600 and np.abs(low - np.sin(2 * np.pi * 500 * np.arange(1600) / 16000))[50:-50].max() < 0.01 and np.abs(high[50:-50]).max() < 0.01


def test_flac_files():
    """What is written comes back: silence, noise, tones, steps; one channel and more; sync codes inside the sound."""
    import numpy as np

    r = np.random.default_rng(4)
    assert flac.crc8(b"123456789") == 0xF4 and flac.crc16(b"123456789") == 0xFEE8  # fixed values: check sums of the usual test
    for n, channels, block in ((0, 1, 16), (1, 1, 16), (5, 2, 16), (1000, 2, 300), (6000, 1, 4096), (900, 3, 6)):
        for x in (r.integers(-32768, 32768, (n, channels)), np.full((n, channels), -7), np.cumsum(r.integers(-9, 10, (n, channels)), 0), np.full((n, channels), -1) * (np.arange(n) % 5 > 0)[:, None]):
            for joint in (True, False):
                frames, rate = flac.decode(flac.encode(x, 8000, block=block, joint=joint))
                assert rate == 8000 and np.array_equal(frames * 32768, x)


def test_flac_frames_of_other_writers():
    """Frames made bit by bit: linear prediction, mid and side, wasted bits, verbatim, several partitions, raw residuals, numbers of samples."""
    import numpy as np

    def frame(channels, samples, *subframes, number=b"\x00", sync=b"\xff\xf8"):
        head = sync + bytes([6 << 4, channels << 4 | 4 << 1]) + number + bytes([samples - 1])
        bits = "".join(subframes)
        body = int(bits + "0" * (-len(bits) % 8), 2).to_bytes((len(bits) + 7) // 8, "big")
        whole = head + bytes([flac.crc8(head)]) + body
        return whole + flac.crc16(whole).to_bytes(2, "big")

    num = lambda x, n: format(x & (1 << n) - 1, f"0{n}b")
    rice = lambda xs, k: "".join("0" * ((x << 1 ^ x >> 63) >> k) + "1" + (num(x << 1 ^ x >> 63, k) if k else "") for x in xs)
    x = [5, 9, 20, -3, 7, 7, 100, -90]
    factors, shift = [3, -2], 1
    left = [x[i] - (factors[0] * x[i - 1] + factors[1] * x[i - 2] >> shift) for i in range(2, 8)]
    # order 2, five bits for a factor, two partitions: one in Rice code, one raw in nine bits
    lpc = "0" + num(33, 6) + "0" + num(5, 16) + num(9, 16) + num(4, 4) + num(shift, 5) + num(3, 5) + num(-2, 5) + "00" + num(1, 4) + num(3, 4) + rice(left[:2], 3) + num(15, 4) + num(9, 5) + "".join(num(e, 9) for e in left[2:])
    assert flac.decode_frame(frame(0, 8, lpc), 16)[:, 0].tolist() == x
    wasted = "0" + num(1, 6) + "1" + "001" + "".join(num(v, 13) for v in x)
    assert flac.decode_frame(frame(0, 8, wasted), 16)[:, 0].tolist() == [v * 8 for v in x]
    a, b = np.array(x), np.array([4, 4, -7, 30, 2, -2, 99, 3])
    plain = lambda v, n: "0" + num(1, 6) + "0" + "".join(num(int(e), n) for e in v)
    for kind, first, second in ((8, plain(a, 16), plain(a - b, 17)), (9, plain(a - b, 17), plain(b, 16)), (10, plain(a + b >> 1, 16), plain(a - b, 17)), (1, plain(a, 16), plain(b, 16))):
        assert np.array_equal(flac.decode_frame(frame(kind, 8, first, second), 16), np.c_[a, b])
    damaged = bytearray(frame(0, 8, lpc))
    damaged[-4] ^= 1
    with pytest.raises(ValueError, match="damaged"):
        flac.decode_frame(bytes(damaged), 16)
    # two frames numbered by their first sample, with a sync code and a sound header inside the first
    inner = frame(0, 2, plain([1, 2], 16), number=b"\x05")
    noise = frame(0, 10, "0" + num(1, 6) + "0" + "".join(num(int.from_bytes(inner[i : i + 2], "big"), 16) for i in range(0, 12, 2)) + num(0, 64), sync=b"\xff\xf9")
    both = noise + frame(0, 8, lpc, number=b"\x0a", sync=b"\xff\xf9")
    info = b"fLaC\x80\x00\x00\x22" + bytes(10) + (16000 << 44 | 15 << 36 | 18).to_bytes(8, "big") + bytes(16)
    assert [at for at, _ in flac.frames(info + both)] == [0, 10] and flac.decode(info + both)[0].shape == (18, 1)


def test_frames_are_rows(spark):
    """A long recording becomes rows that many tasks decode; what is damaged or no such file has an error of its own."""
    import numpy as np

    x = (9000 * np.sin(np.arange(40_000) / 17)).astype(int)
    whole = flac.encode(x, 16000, block=512)
    broken = bytearray(whole)
    broken[len(whole) // 2] ^= 64
    rows = spark.createDataFrame([(1, bytearray(whole), "f"), (2, broken, "f"), (3, bytearray(b"RIFF"), "f"), (4, None, "f"), (5, bytearray(b"fLaC\x00"), "f")], "id long, content binary, frame string")
    parts = flac.frame_rows(rows, "id", "content")
    found = flac.decoded(parts, "id").withColumn("p", F.spark_partition_id()).collect()
    own = sorted((r for r in found if r["id"] == 1), key=lambda r: r["first_sample"])
    assert len(own) == 79 and len({r["p"] for r in own}) > 1 and np.array_equal(np.round(np.concatenate([r["samples"] for r in own]) * 32768), x)
    assert [r["error"] is not None for r in found if r["id"] == 2].count(True) == 1 and all(r["error"].startswith("[ERROR") for r in found if r["id"] > 2)
    one = spark.createDataFrame([(1, (None, None, bytearray(whole)))], "id long, audio struct<array:array<double>,sampling_rate:int,bytes:binary>")
    got = audio.prepared(one, "id", "audio").first()
    assert got["error"] is None and np.array_equal(np.round(np.array(got["samples"]) * 32768), x)


def test_predictors_by_name(spark):
    rows = [(1, [1, 1, 0, 2, 27, 27, 3], "a A b", " one. two? Three"), (2, [28], None, None), (3, None, "x", "é. é")]
    df = spark.createDataFrame(rows, "id long, path array<int>, text string, said string")
    got = lambda name, c: {r["id"]: (r["prediction"], r["error"]) for r in predictors.predict(df, name, "id", c).collect()}
    assert {"frame_labels", "anti_loop", "casing"} <= set(predictors.names())
    assert got("frame_labels", "path") == {1: ("ab c", None), 2: (None, "[ERROR: label 28]"), 3: ("", None)}
    assert got("anti_loop", "text") == {1: ("a b", None), 2: ("", None), 3: ("x", None)}
    assert got("casing", "said") == {1: ("One. Two? Three", None), 2: ("", None), 3: ("É. É", None)}
    predictors.register("length", lambda: lambda batch: [str(len(x)) for x in batch])
    assert sorted(r["prediction"] for r in predictors.predict(df.where("text is not null"), "length", "id", "text").collect()) == ["1", "5"]


def test_a_predictor_is_set_up_once_a_task(spark, tmp_path):
    """One set-up for each task with rows; batches of one size over the borders of Arrow batches; a failed batch is tried again, then row by row."""
    import uuid

    def note(kind, text=""):
        (tmp_path / f"{kind}-{uuid.uuid4().hex}").write_text(text)

    def setup():
        note("setup")
        tries = []

        def model(batch):
            note("batch", str(len(batch)))
            tries.append(batch)
            if any(x % 100 == 17 for x in batch):
                raise ValueError("seventeen")
            if any(x % 100 == 50 for x in batch) and tries.count(batch) == 1:
                raise ValueError("not at first")
            return [str(2 * x) for x in batch] + ([] if 99 not in batch else ["too many"])

        return model

    predictors.register("noted", setup, batch=7, retries=1)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "10")
    try:
        rows = spark.range(0, 400, 1, 5).where("id < 320").withColumn("x", F.col("id"))
        got = {r["id"]: r for r in predictors.predict(rows, "noted", "id", "x").collect()}
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert len(got) == 320 and all(r["decode_wall_s"] >= 0 for r in got.values())
    for i, r in got.items():
        want = "[ERROR: seventeen]" if i % 100 == 17 else "[ERROR: 2 answers for 1 rows]" if i == 99 else None
        assert r["error"] == want and r["prediction"] == (None if want else str(2 * i))
    sizes = [int(f.read_text()) for f in tmp_path.glob("batch-*")]
    assert len(list(tmp_path.glob("setup-*"))) == 4  # the fifth task has no rows
    # of 80 rows eleven batches of seven and one of three; some again, and rows of failed ones alone
    assert sizes.count(3) >= 4 and set(sizes) == {1, 3, 7} and sizes.count(7) >= 44


def test_word_spans_of_wrong_paths(spark):
    """Letters to labels, words without any, and paths that don't spell them."""
    rows = [(["ab", "é", "b"], [1, 0, 2, 2, 3, 3, 0, 2]), (["ab"], [1, 1, 1]), (["é"], [0, 0])]
    df = spark.createDataFrame(rows, "w array<string>, p array<int>")
    t = C.token_ranges(F.col("w"), "ab")
    got = df.select(t.alias("t"), C.word_spans(F.col("p"), t, 0, F.lit(1600), 1600).alias("x")).collect()
    assert got[0]["t"]["labels"] == [1, 2, 3, 3, 2] and [tuple(r) for r in got[0]["t"]["ranges"]] == [(0, 2), (3, 3), (4, 5)]
    assert got[0]["x"]["error"] == "wrong number of labels" and got[1]["x"]["error"] == "wrong number of labels" and got[2]["x"]["error"] == "no targets"
    good = spark.createDataFrame([(["ab", "é", "b"], [1, 0, 2, 2, 3, 0, 3, 2])], "w array<string>, p array<int>")
    spans = good.select(C.word_spans(F.col("p"), t, 0, F.lit(1600), 1600)["spans"].alias("s")).first()["s"]
    assert [(round(s["start"], 6), round(s["end"], 6)) for s in spans] == [(0.0, 0.5), (0.875, 1.0)]


def test_shared_folder_is_needed_on_a_cluster():
    from types import SimpleNamespace

    from parkwright.sources.shared import shared_root

    conf = SimpleNamespace(get=lambda key, default: default)
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared_root(SimpleNamespace(sparkContext=SimpleNamespace(getConf=lambda: conf, master="spark://host:7077", applicationId="none")))


def test_metrics_skips_what_is_no_rate(spark):
    doc = '{"text_normalize":"none","pooled":{"wer":0.5,"cer":0.25,"n":4},"per_set":{"a":{"wer":1.0,"cer":0.5,"n":2},"text_normalize":null}}'
    got = tables.parsed_metrics(spark.createDataFrame([(doc,)], "value string")).collect()
    assert sorted(map(tuple, got)) == [("a", 2, 1.0, 0.5), ("pooled", 4, 0.5, 0.25)]


def test_checks_of_replies(spark):
    rows = [("", "thanks"), (None, "x"), ("12 3.", "how_to"), ("Asante sana, karibu tena", "thanks"), ("Weka mbolea kwa mimea na maji", None)]
    got = gates.judged(spark.createDataFrame(rows, "response string, category string")).collect()
    assert got[0]["failed_checks"] == ["non_empty", "has_swahili_content", "has_substance"]
    assert got[1]["failed_checks"] == ["non_empty", "has_swahili_content", "not_generic_greeting", "has_substance"]
    assert got[2]["failed_checks"] == ["not_digits_only", "has_swahili_content", "has_substance"]
    assert got[3]["passed"] and got[4]["passed"]


def plain_replay(domain, retention, share, seed=42):
    """One slot after the other, until one of the sets has no row left."""
    import hashlib

    out, left, slot = [], {0: list(domain), 1: list(retention)}, 0
    while True:
        pick = int(int(hashlib.md5(f"{seed}:{slot}".encode()).hexdigest()[:8], 16) < int(share * 2**32))
        if not left[pick]:
            return out
        out.append((slot, left[pick].pop(0), "dr"[pick]))
        if not left[pick]:
            return out
        slot += 1


@pytest.mark.parametrize(("n", "m", "share"), [(400, 400, 0.9), (50, 400, 0.1), (400, 5, 0.3), (30, 30, 0.0), (30, 0, 0.2), (0, 30, 0.5), (0, 0, 0.5)])
def test_replay(spark, n, m, share):
    a = spark.range(n).select("id", F.lit("d").alias("kind"))
    b = spark.range(m).select("id", F.lit("r").alias("kind"))
    rows = merging.replayed(a, b, ["id"], share).orderBy("slot").select("slot", "id", "kind").collect()
    assert [tuple(r) for r in rows] == plain_replay(range(n), range(m), min(share, 0.5))


def test_distinct_texts(spark, monkeypatch):
    """The least key of each text, whichever way the texts are found again."""
    rows = [(i, f"t{i % 40}" if i % 7 else None) for i in range(300)] + [(3, "t3"), (3, "t3"), (None, "t3"), (None, "alone"), (None, "alone"), (5, "")]
    df = spark.createDataFrame(rows, "id long, k string").repartition(4)
    want = {k: min((i for i, x in rows if x == k and i is not None), default=None) for _, k in rows}
    for most in (50_000, 45, 0):
        monkeypatch.setattr(merging, "BROADCAST_ROWS", most)
        got = merging.distinct_texts(df, "k", "id").collect()
        assert {r["k"]: r["id"] for r in got} == want and len(got) == len(want)


def test_selection(spark, monkeypatch):
    """Values at places, against sorting; ties, huge spreads and infinities, with so few bins that many passes are needed."""
    inf = float("inf")
    for values in ([1.0] * 50, [R.random() for _ in range(500)], [R.choice([1.0, 2.0, 2.5]) for _ in range(300)], [10.0 ** R.randrange(-300, 300) * R.choice([-1, 1]) for _ in range(200)], [-inf, inf, inf, 0.0, 1.5, -1.7e308, 1.7e308], [5.0], []):
        df = spark.createDataFrame([(v,) for v in [*values, None, float("nan")]], "x double").repartition(3)
        for bins, few in ((2048, 10_000), (4, 3), (16, 0)):
            monkeypatch.setattr(ranking, "BINS", bins)
            monkeypatch.setattr(ranking, "FEW", few)
            n, got = ranking.selected(df, "x", lambda n: [0, n // 3, n // 2, n * 9 // 10, n - 1, n, -1])
            assert n == len(values) and got == {p: sorted(values)[p] for p in {0, n // 3, n // 2, n * 9 // 10, n - 1} if 0 <= p < n}


def test_long_clips_pack_in_one_walk(spark):
    """20,000 words: linear, and as the plain walk; with spans that are longer than a chunk, and ranges of letters with and without marks."""
    import time

    ends = [0.37 * i + (40 if i > 15_000 else 0) for i in range(1, 20_001)]
    df = spark.createDataFrame([([(e - 0.37, e) for e in ends], [f"w{'abc'[i % 3] * (i % 4)}" for i in range(20_000)])], "s array<struct<start:double,end:double>>, w array<string>").cache()
    df.count()
    began = time.perf_counter()
    got = df.select(C.packed_spans(F.col("s"), 28.0).alias("c")).first()["c"]
    assert time.perf_counter() - began < 20
    want, start = [[0]], ends[0] - 0.37
    for i in range(1, 20_000):
        if ends[i] - start > 28.0:
            want.append([])
            start = ends[i] - 0.37
        want[-1].append(i)
    assert got == want
    for separator in (True, False):
        t = df.select(C.token_ranges(F.col("w"), "abc", separator).alias("t")).first()["t"]
        at, ranges = 0, []
        for i in range(20_000):
            ranges.append((at, at + i % 4))
            at += i % 4 + separator
        assert [tuple(r) for r in t["ranges"]] == ranges and len(t["labels"]) == ranges[-1][1]


def test_numbers(spark):
    got = spark.range(0, 60).select("id", N.soft_tokens(F.col("id"), 9).alias("s"), N.real_time_factor(F.col("id").cast("double"), F.lit(0.0)).alias("none")).collect()
    for x in got:
        t = x["id"]
        for _ in range(2):
            t = (t + 2 - 3) // 2 + 1
        assert x["s"] == (min(t, 9) if x["id"] else 0) and x["none"] is None


def test_settled_leaves_its_rows_only(spark):
    from parkwright.sources import shared

    first, inner = shared.cut(spark.range(5), "first"), []

    def make():
        inner.append(shared.cut(first.where("id > 0"), "inner"))
        return inner[0].where("id > 1")

    got = shared.settled(spark, make, "last")
    assert got.count() == 3 and first.count() == 5
    with pytest.raises(Exception, match="(?i)not exist|no such|not found"):
        inner[0].collect()


def test_sweep(spark):
    from parkwright.sources.shared import cut, sweep

    kept = cut(spark.range(3), "x")
    assert kept.count() == 3
    sweep(spark)
    with pytest.raises(Exception, match="(?i)not exist|no such|not found"):
        kept.collect()
