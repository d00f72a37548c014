"""Work that must not be repeated, and memory and tasks that must not grow with the table."""

from csv import writer

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from parkwright.functions import bits
from parkwright.llm import shingles
from parkwright.operators import audio, chunking, errors, flac
from parkwright.sources import shared, tables


def planned(df) -> str:
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_chunks_split_a_text_once(spark):
    """Words are looked up a word at a time and pieces are filtered; neither splits the text again."""
    words = [f"w{i}" for i in range(3000)]
    clips = spark.createDataFrame([(1, " ".join(words), 3000.0, 48_000_000)], "clip_id long, text string, duration_s double, n_samples long")
    clips = clips.withColumn("spans", F.transform(F.split("text", " "), lambda w, i: F.struct(i.cast("double").alias("start"), (i + 1).cast("double").alias("end"))))
    out = chunking.chunked(clips, "spans", reassembly=True)
    # as written and normalised; the spans of this table are a split of their own
    assert planned(out).count("array_remove(split(") == 2
    rows = sorted(out.collect(), key=lambda r: r["chunk_index"])
    assert [r["text"].split() for r in rows] == [words[at : at + 28] for at in range(0, 3000, 28)]
    assert {r["num_chunks"] for r in rows} == {len(rows)} and {r["full_text"] for r in rows} == {" ".join(words)}


def test_bands_work_rates_out_once(spark):
    """No filter below the rates repeats them, and bands without rows are there."""
    double = F.udf(lambda x: None if x is None else x * 2.0, "double")
    rows = spark.createDataFrame([(0.05,), (0.1,), (0.25,), (0.6,), (40.0,), (float("nan"),), (None,)], "x double").withColumn("wer", double(F.col("x")))
    out = errors.bands(rows.withColumn("wer", F.when(F.col("x").isNotNull(), F.col("wer"))), "wer")
    assert planned(out).count("EvalPython") == 1
    got = [(r["place"], r["band"], r["n"], round(r["pct"], 6)) for r in out.orderBy("place").collect()]
    share = lambda n: round(100 * n / 7, 6)
    assert got == [(0, "good", 1, share(1)), (1, "moderate", 1, share(1)), (2, "fair", 1, share(1)), (3, "poor", 0, 0.0), (4, "bad", 0, 0.0), (5, "catastrophic", 2, share(2))]
    assert [(r["n"], r["pct"]) for r in errors.bands(rows.where("false"), "wer").collect()] == [(0, 0.0)] * 6


def test_costly_rows_are_dealt_by_their_number(spark, tmp_path, monkeypatch):
    """The longest task doesn't grow with the table, however few files it has."""
    spark.range(2000).repartition(8).write.parquet(str(tmp_path / "t"))
    rows = spark.read.parquet(str(tmp_path / "t"))
    assert shared.spread(rows).rdd.getNumPartitions() == max(8, rows.rdd.getNumPartitions())
    monkeypatch.setattr(shared, "DEALT", 100)
    dealt = shared.spread(rows)
    assert dealt.rdd.getNumPartitions() == 20 and dealt.distinct().count() == 2000


def test_left_out_items_need_no_table_of_edits(monkeypatch):
    """A pair of which one side only lacks items costs a walk, and others the same edits as ever."""
    line = [str(i % 97) for i in range(2000)]
    kept = [x for i, x in enumerate(line) if i % 7 != 3]
    assert bits.distance([*kept, "z"], line) == plain_distance([*kept, "z"], line)
    monkeypatch.setattr(bits, "columns", None)
    assert bits.distance(line, kept) == bits.distance(kept, line) == len(line) - len(kept)
    assert bits.distance([], line) == 2000 and bits.distance(line, line) == bits.distance([], []) == 0


def test_csv_with_line_breaks_is_read_in_splits(spark, tmp_path):
    """Records over many lines and splits, with quotes and line breaks of both kinds in their fields."""
    texts = ["plain", "a,b", 'say "no"', "two\nlines", "win\r\ndows", '"\r\n"', "", " x ", '\r\n'.join(f'line "{i}", more' for i in range(90)), "é\nü", '"']
    rows = [(str(i), texts[i % len(texts)], "end" if i % 3 else "") for i in range(400)]
    for sep in ("\r\n", "\n"):
        folder = tmp_path / f"{len(sep)}"
        folder.mkdir()
        for k, own in enumerate((rows[:390], rows[390:])):
            with open(folder / f"{k}.csv", "w", newline="") as f:
                writer(f, lineterminator=sep).writerows([("id", "text\nhere", "last"), *own])
        for most in ("100", "700", "128m"):
            spark.conf.set("spark.sql.files.maxPartitionBytes", most)
            spark.conf.set("spark.sql.files.openCostInBytes", "0")
            try:
                back = tables.csv(spark, str(folder), ["id", "text", "last"], lineSep=sep)
                got = [tuple(r) for r in back.collect()]
                assert most != "700" or spark.read.text(str(folder), lineSep=sep).rdd.getNumPartitions() > 20
            finally:
                spark.conf.unset("spark.sql.files.maxPartitionBytes")
                spark.conf.unset("spark.sql.files.openCostInBytes")
            # blanks without quotes have always read as null
            assert sorted(got, key=lambda r: int(r[0])) == [tuple(x or None for x in r) for r in rows]


def given_rows(monkeypatch, rows, make, columns: list[pa.Array]) -> list[int]:
    """Rows of each batch that the worker of ``make(rows)`` gives for one batch of ``columns``."""
    workers = []
    with monkeypatch.context() as patch:
        patch.setattr(type(rows), "mapInArrow", lambda self, work, schema: workers.append(work) or self)
        make(rows)
    batch = pa.RecordBatch.from_arrays(columns, names=[f"c{i}" for i in range(len(columns))])
    return [b.num_rows for b in workers[0](iter([batch]))]


def test_workers_hold_a_few_clips(spark, monkeypatch):
    """Sound is made into objects by slices of a batch, however many rows that has."""
    rows = spark.createDataFrame([], "id long, x array<array<int>>, audio struct<bytes:binary>")
    ids, frames = pa.array(range(200), pa.int64()), pa.array([[[i, -i]] * 30 for i in range(200)])
    files = pa.array([{"bytes": audio.encode_wav(np.array([[i], [i]]))} for i in range(200)])
    for make, own in (
        (lambda r: audio.wav_bytes(r, "id", "x"), frames), (lambda r: flac.flac_bytes(r, "id", "x", 16000), frames), (lambda r: audio.prepared(r, "id", "audio"), files),
    ):
        assert given_rows(monkeypatch, rows, make, [ids, own]) == [64, 64, 64, 8]


def test_workers_hold_a_few_alignments(spark, monkeypatch):
    rows = spark.createDataFrame([], "reference string, prediction string")
    found = given_rows(monkeypatch, rows, errors.edit_chunks, [pa.array([["a", "b"]] * 1200), pa.array([["a", "c"]] * 1200)])
    assert found == [512, 512, 176]


def plain_distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def test_blocks_hold_a_few_shingles(spark, monkeypatch):
    """A bucket of few members is cut as well if their texts are long; what is alike is found all the same."""
    monkeypatch.setattr(shingles, "BLOCK_SHINGLES", 3000)
    # a third of the words is a text's own, but every third text is nearly the one before it
    texts = [(f"k{i:02}", " ".join([f"w{j}" for j in range(800)] + [f"o{i - (i % 3 == 2)}-{j}" for j in range(400)] + ["end"] * (i % 3))) for i in range(30)]
    table = spark.createDataFrame([(bytearray(k.encode()), bytearray(t.encode())) for k, t in texts], "key binary, text binary")
    sizes = {k: len(shingles.shingles(t.encode())) for k, t in texts}
    rows = spark.createDataFrame([(bytearray(k.encode()), n, 1) for k, n in sizes.items()], "key binary, size int, bucket long")
    items = []

    def seen(df, name, cut=shingles.cut):
        found = cut(df, name)
        if name == "open":
            items.extend(r["blocks"] for r in found.collect())
        return found

    monkeypatch.setattr(shingles, "cut", seen)
    found = {tuple(sorted((bytes(r["a"]).decode(), bytes(r["b"]).decode()))) for r in shingles.inside(table, rows, spark.createDataFrame([], "node binary, root binary")).collect()}
    assert items == [-(-sum(sizes.values()) // 3000)]
    assert found == {(f"k{i - 1:02}", f"k{i:02}") for i in range(2, 30, 3)}
