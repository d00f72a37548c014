"""Queries that read and write: sources, sinks, and their round trips."""

from __future__ import annotations

from pyspark.sql import functions as F

from parkwright.functions.text import dataset_spec
from parkwright.operators import audio, errors, flac, merging, scoring
from parkwright.plans import fixtures as X
from parkwright.plans.registry import query, table
from parkwright.sources import sinks, tables
from parkwright.plans.rates import spread_rates
from parkwright.sources.shared import cut, new_path


@query("""SELECT 'documents' AS source_dataset, lang AS split, doc_id AS row_id, text FROM documents
UNION ALL SELECT 'benchmark', 'test', item_id, text FROM benchmark
UNION ALL SELECT 'conversations', role, conv_id * 1000 + turn, text FROM conversations""")
def src_multi(spark, d):
    """All splits of several named datasets, tagged and unioned."""
    return tables.load_many({
        "documents": table(spark, d, "documents").select(F.col("lang").alias("split"), F.col("doc_id").alias("row_id"), "text"),
        "benchmark": table(spark, d, "benchmark").select(F.lit("test").alias("split"), F.col("item_id").alias("row_id"), "text"),
        "conversations": table(spark, d, "conversations").select(F.col("role").alias("split"), (F.col("conv_id") * 1000 + F.col("turn")).alias("row_id"), "text"),
    }).select("source_dataset", "split", "row_id", "text")


@query("SELECT doc_id, text, n_chars FROM documents WHERE lang = 'de' ORDER BY doc_id LIMIT 50")
def src_split(spark, d):
    """One split with a cap, of the rows that come first."""
    return tables.load_split(table(spark, d, "documents"), "lang", "de", ["doc_id"], cap=50).select("doc_id", "text", "n_chars")


@query("""WITH s AS (SELECT doc_id AS id, CASE doc_id % 6 WHEN 0 THEN ' ' || source || '/' || lang || ':train ' WHEN 1 THEN source WHEN 2 THEN '' WHEN 3 THEN '  ' WHEN 4 THEN source || ': validation' ELSE source || ':' END AS s FROM documents)
SELECT id, trim(split_part(trim(s), ':', 1)) AS repo, coalesce(nullif(trim(split_part(trim(s), ':', 2)), ''), 'test') AS split FROM s WHERE trim(s) <> ''""")
def src_spec(spark, d):
    """Settings 'repo[:split]' taken apart; blank ones name nothing."""
    kind = F.col("doc_id") % 6
    said = F.when(kind == 0, F.concat(F.lit(" "), "source", F.lit("/"), "lang", F.lit(":train "))).when(kind == 1, F.col("source")).when(kind == 2, "").when(kind == 3, "  ").when(kind == 4, F.concat("source", F.lit(": validation"))).otherwise(F.concat("source", F.lit(":")))
    return table(spark, d, "documents").select(F.col("doc_id").alias("id"), dataset_spec(said).alias("x")).where("x is not null").select("id", "x.repo", "x.split")


@query(f"WITH {X.CLIPS} SELECT split, count(*) AS n, CAST(sum(n_samples) AS BIGINT) AS samples FROM clips GROUP BY split")
def src_disk(spark, d):
    """A prepared dataset written by split and opened again."""
    path = sinks.prepared(X.clips(spark, d), new_path(spark, "prepared"))
    return spark.read.parquet(path).groupBy("split").agg(F.count(F.lit(1)).alias("n"), F.sum("n_samples").alias("samples"))


@query("SELECT doc_id, lang FROM documents ORDER BY doc_id LIMIT 20")
def src_slice(spark, d):
    return tables.head(table(spark, d, "documents"), ["doc_id"], 20).select("doc_id", "lang")


@query("SELECT doc_id, text FROM documents ORDER BY doc_id LIMIT 1")
def src_iter(spark, d):
    return tables.head(table(spark, d, "documents"), ["doc_id"], 1).select("doc_id", "text")


@query("""SELECT 'clips/' || split_part(url, '://', 2) || CASE page_id % 5 WHEN 0 THEN '.wav' WHEN 1 THEN '.WAV' WHEN 2 THEN '.txt' WHEN 3 THEN '.Flac' ELSE '' END AS name, page_id FROM pages WHERE page_id % 5 IN (0, 1, 3) ORDER BY name, page_id LIMIT 200""")
def src_dir(spark, d):
    """The first 200 sound files of a listing, by extension in any case, in order of their names."""
    extension = F.element_at(F.array(*[F.lit(x) for x in (".wav", ".WAV", ".txt", ".Flac", "")]), (F.col("page_id") % 5 + 1).cast("int"))
    names = table(spark, d, "pages").select(F.concat(F.lit("clips/"), F.split_part("url", F.lit("://"), F.lit(2)), extension).alias("name"), "page_id")
    return tables.by_extension(names, "name", (".wav", ".flac"), 200)


@query("SELECT conv_id * 1000 + turn AS id, text AS prompt, role AS category FROM conversations")
def src_jsonl(spark, d):
    """Prompts from JSON lines, blank lines skipped."""
    rows = table(spark, d, "conversations").select((F.col("conv_id") * 1000 + F.col("turn")).alias("id"), F.col("text").alias("prompt"), F.col("role").alias("category"))
    path = new_path(spark, "prompts")
    blank = rows.select(F.explode(F.array(F.to_json(F.struct("*")), F.lit(""))).alias("value"))
    blank.write.text(path)
    return tables.json_lines(spark, path, "id long, prompt string, category string")


@query("SELECT conv_id * 1000 + turn AS id, role, text FROM conversations")
def src_csv(spark, d):
    """Quoted CSV with line breaks in fields, every column read as text, then cast."""
    path = sinks.csv(table(spark, d, "conversations").select((F.col("conv_id") * 1000 + F.col("turn")).alias("id"), "role", "text"), new_path(spark, "csv"))
    return tables.csv(spark, path, ["id", "role", "text"]).select(F.col("id").cast("long").alias("id"), "role", "text")


PER_SET = f"""WITH {X.pairs_sql()} SELECT source_dataset AS "group", count(*) AS n, sum(word_edits) / sum(n_words) AS wer, sum(char_edits) / sum(n_chars) AS cer FROM p GROUP BY 1
UNION ALL SELECT 'pooled', count(*), sum(word_edits) / sum(n_words), sum(char_edits) / sum(n_chars) FROM p"""


def _metrics(spark, d):
    return scoring.grouped(scoring.scored(X.pairs(spark, d)), [[], ["source_dataset"]]).withColumnRenamed("source_dataset", "group")


@query(PER_SET)
def src_json(spark, d):
    """A metrics document written whole and read back into rows."""
    path = sinks.metrics_document(_metrics(spark, d), "jiwer_default", new_path(spark, "metrics"))
    return tables.metrics(spark, path).select("group", "n", "wer", "cer")


@query("""SELECT vec_id, CAST(len(embedding) AS BIGINT) AS n_samples, CAST(list_sum(list_transform(embedding, lambda x: CAST(floor(x::DOUBLE * 1000) AS BIGINT))) * 2 AS BIGINT) AS total, kind
FROM embeddings, (SELECT unnest(['array', 'bytes', 'flac']) AS kind)""")
def src_audio(spark, d):
    """Clips as structs with samples of two channels, and as WAV and FLAC bytes of them; the mean of a sample and its triple is its double."""
    whole = F.transform("embedding", lambda x: F.floor(x.cast("double") * 1000).cast("int"))
    rows = table(spark, d, "embeddings").select("vec_id", whole.alias("w"))
    arrays = rows.select("vec_id", F.struct(F.array(F.transform("w", lambda x: x / 32768), F.transform("w", lambda x: x * 3 / 32768)).alias("array"), F.lit(16000).alias("sampling_rate")).alias("audio"))
    both = rows.select("vec_id", F.transform("w", lambda x: F.array(x, x * 3)).alias("w"))
    held = lambda content: content.select("vec_id", F.struct(F.col("content").alias("bytes")).alias("audio"))
    files, packed = held(audio.wav_bytes(both, "vec_id", "w")), held(flac.flac_bytes(both, "vec_id", "w", 16000, block=24))
    total = F.aggregate("samples", F.lit(0).cast("long"), lambda a, x: a + F.round(x.cast("double") * 32768).cast("long"))
    read = {"array": audio.prepared(arrays, "vec_id", "audio"), "bytes": audio.prepared(files, "vec_id", "audio"), "flac": audio.prepared(packed, "vec_id", "audio")}
    return merging.concatenated({k: v.select("vec_id", F.size("samples").cast("long").alias("n_samples"), total.alias("total")) for k, v in read.items()}, "kind")


@query("""SELECT vec_id, i // 24 * 24 AS first_sample, count(*) AS n_samples, CAST(sum(CAST(floor(x::DOUBLE * 1000) AS BIGINT) * 2 * (i % 24 + 1)) AS BIGINT) AS total, 16000 AS rate
FROM (SELECT vec_id, unnest(embedding) AS x, unnest(range(len(embedding))) AS i FROM embeddings) GROUP BY ALL""")
def src_flac(spark, d):
    """Recordings cut at their frames, each frame decoded in a row of its own; samples weighed by their place in the frame."""
    whole = F.transform("embedding", lambda x: F.floor(x.cast("double") * 1000).cast("int"))
    rows = table(spark, d, "embeddings").select("vec_id", F.transform(whole, lambda x: F.array(x, x * 3)).alias("w"))
    files = cut(flac.flac_bytes(rows, "vec_id", "w", 16000, block=24), "flac")
    parts = flac.decoded(flac.frame_rows(files, "vec_id", "content"), "vec_id")
    weighed = F.transform("samples", lambda x, i: F.round(x.cast("double") * 32768).cast("long") * (i + 1))
    return parts.select("vec_id", "first_sample", F.size("samples").cast("long").alias("n_samples"), F.aggregate(weighed, F.lit(0).cast("long"), lambda a, x: a + x).alias("total"), "rate")


@query("SELECT event_id AS line, CASE WHEN event_id % 5 = 0 THEN 'model_type' ELSE 'data_path' END AS kind, event_type || event_id AS value FROM events WHERE event_id % 5 IN (0, 2)")
def src_log(spark, d):
    """(line, kind, value) hits of two patterns in a tool's log."""
    kind = F.when(F.col("event_id") % 5 == 0, "model_type: ").when(F.col("event_id") % 5 == 2, "data_path: ").otherwise("note ")
    lines = table(spark, d, "events").select(F.col("event_id").alias("line"), F.concat(F.lit("[info] "), kind, "event_type", F.col("event_id").cast("string")).alias("value"))
    return tables.log_hits(lines, "line", "value", {"model_type": r"model_type: (\S+)", "data_path": r"data_path: (\S+)"})


@query(f"WITH {X.CLIPS} SELECT clip_id, split FROM clips WHERE clip_id % 2 = 0")
def snk_overwrite(spark, d):
    """Written twice to one place: the second replaces the first."""
    path = new_path(spark, "overwrite")
    sinks.prepared(X.clips(spark, d), path)
    sinks.prepared(X.clips(spark, d).where("clip_id % 2 = 0"), path)
    return spark.read.parquet(path).select("clip_id", "split")


@query("SELECT conv_id, turn, text FROM conversations")
def snk_json(spark, d):
    """One file with an indented array, written and read back in parallel."""
    path = sinks.json_array(table(spark, d, "conversations").select("conv_id", "turn", "text"), ["conv_id", "turn"], new_path(spark, "json"))
    return tables.indented_array(spark, path, "conv_id long, turn long, text string")


@query("SELECT conv_id, turn, text, CASE WHEN turn % 2 = 0 THEN role END AS note FROM conversations")
def snk_csv(spark, d):
    """One file, whose header is that of the first row; and none without rows."""
    rows = table(spark, d, "conversations").select("conv_id", "turn", "text", F.lit(None).cast("string").alias("absent"), F.when(F.col("turn") % 2 == 0, F.col("role")).alias("note"))
    path = sinks.csv_file(rows, ["conv_id", "turn"], new_path(spark, "csv"), optional=("absent", "note"))
    if sinks.csv_file(rows.where("conv_id < 0"), ["conv_id"], new_path(spark, "csv")) is not None:
        raise AssertionError("a file without rows")
    back = tables.csv(spark, path, ["conv_id", "turn", "text", "note"], lineSep="\r\n")
    return back.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), "text", F.nullif("note", F.lit("")).alias("note"))


@query(f"WITH {X.pairs_sql()} SELECT reference AS ref, prediction AS hyp, source_dataset FROM p")
def snk_jsonl(spark, d):
    rows = X.pairs(spark, d).select(F.col("reference").alias("ref"), F.col("prediction").alias("hyp"), "source_dataset")
    return spark.read.schema("ref string, hyp string, source_dataset string").json(sinks.json_rows(rows, new_path(spark, "jsonl")))


@query(f"""WITH {X.pairs_sql()}, r AS (SELECT row_idx, dataset, source_dataset, reference, prediction, CASE WHEN row_idx % 3 = 0 THEN CAST(row_idx AS VARCHAR) END AS note FROM p)
SELECT part, row_idx, dataset, source_dataset, reference, prediction, note, NULL::BIGINT AS n, NULL::DOUBLE AS wer, NULL::DOUBLE AS cer FROM r, (SELECT unnest(['csv', 'json']) AS part)
UNION ALL SELECT 'metrics', NULL, NULL, source_dataset, NULL, NULL, NULL, count(*), sum(word_edits) / sum(n_words), sum(char_edits) / sum(n_chars) FROM p GROUP BY source_dataset
UNION ALL SELECT 'metrics', NULL, NULL, 'pooled', NULL, NULL, NULL, count(*), sum(word_edits) / sum(n_words), sum(char_edits) / sum(n_chars) FROM p""")
def snk_eval(spark, d):
    """The three parts of a result set, all their values read back; the note is null in the second and third of three rows."""
    rows = X.pairs(spark, d).withColumn("note", F.when(F.col("row_idx") % 3 == 0, F.col("row_idx").cast("string")))
    parts = sinks.result_set(rows, _metrics(spark, d), "none", new_path(spark, "eval"), ["row_idx"], optional=("note",))
    names = ["row_idx", "dataset", "source_dataset", "reference", "prediction", "note"]
    typed = lambda df: df.select(F.col("row_idx").cast("long").alias("row_idx"), *[F.col(c) for c in names[1:-1]], F.nullif("note", F.lit("")).alias("note"))
    read = {
        "csv": typed(tables.csv(spark, parts["csv"], rows.columns, lineSep="\r\n")), "json": typed(tables.indented_array(spark, parts["json"], rows.schema)),
        "metrics": tables.metrics(spark, parts["metrics"]).withColumnRenamed("group", "source_dataset"),
    }
    return merging.concatenated(read, "part").select("part", *names, "n", "wer", "cer")


@query(PER_SET)
def snk_metrics(spark, d):
    """The nested document as one value, taken apart again."""
    return tables.parsed_metrics(sinks.metrics_value(_metrics(spark, d), "none")).select("group", "n", "wer", "cer")


@query(f"""WITH {X.pairs_sql(7, 'b')}, {X.pairs_sql(13, 't')}, bg AS (SELECT source_dataset g, sum(word_edits) / sum(n_words) w FROM b GROUP BY 1 UNION ALL SELECT 'pooled', sum(word_edits) / sum(n_words) FROM b),
tg AS (SELECT source_dataset g, sum(word_edits) / sum(n_words) w FROM t GROUP BY 1 UNION ALL SELECT 'pooled', sum(word_edits) / sum(n_words) FROM t)
SELECT printf('| %s | %d | %d |', tg.g, CAST(floor(bg.w * 10000) AS BIGINT), CAST(floor(tg.w * 10000) AS BIGINT)) AS line, CAST(row_number() OVER (ORDER BY CASE WHEN tg.g = 'pooled' THEN 0 ELSE 1 END, tg.g) AS INTEGER) AS place FROM tg JOIN bg ON tg.g = bg.g""")
def snk_md(spark, d):
    """Lines of a comparison table, pooled first; rates in ten-thousandths."""
    run = lambda n: scoring.grouped(scoring.scored(X.pairs(spark, d, n)), [[], ["source_dataset"]]).withColumnRenamed("source_dataset", "group")
    return sinks.markdown(merging.beside(run(13), run(7)))


_REPORT = f"""WITH RECURSIVE {X.pairs_sql()}, s AS (SELECT row_idx AS id, prediction AS text, CASE WHEN row_idx % 13 = 0 THEN 1.5::DOUBLE ELSE word_edits / n_words * (1 + row_idx % 7) END AS wer, n_words * 0.5::DOUBLE AS seconds FROM p), {X.loops_sql("s")},
b AS (SELECT * FROM (VALUES (0, 'good', 0.0, 0.2), (1, 'moderate', 0.2, 0.4), (2, 'fair', 0.4, 0.6), (3, 'poor', 0.6, 0.8), (4, 'bad', 0.8, 1.01), (5, 'catastrophic', 1.01, 99.0)) AS v(place, band, lo, hi)),
c AS (SELECT band, count(wer) AS n, 100.0 * count(wer) / (SELECT count(*) FROM s) AS pct FROM b LEFT JOIN s ON wer >= lo::DOUBLE AND wer < hi::DOUBLE GROUP BY band),
r AS (SELECT wer, row_number() OVER (ORDER BY wer) - 1 AS i, count(*) OVER () AS n FROM s),
ew AS (SELECT row_idx AS id, {X.error_words_sql("reference")} AS r, {X.error_words_sql("prediction")} AS h FROM p), {X.chunks_sql("ew")},
es AS (SELECT x || '->' || y AS shift, CAST(sum(len(regexp_extract_all(array_to_string(r, ' '), x))) AS BIGINT) AS n FROM ew, (VALUES {", ".join(f"('{a}', '{b}')" for a, b in errors.SHIFTS)}) AS v(x, y) WHERE regexp_matches(array_to_string(r, ' '), x) AND regexp_matches(array_to_string(h, ' '), y) GROUP BY 1 ORDER BY n DESC, shift LIMIT 12),
ec AS (SELECT kind, ref_phrase, hyp_phrase, count(*) AS n FROM chunks GROUP BY ALL),
ek AS (SELECT *, row_number() OVER (PARTITION BY kind ORDER BY n DESC, ref_phrase, hyp_phrase) AS place FROM ec)
SELECT 'Total utterances: ' || count(*) AS line FROM s UNION ALL SELECT printf('WER normalized: mean=%.3f median=%.3f p90=%.3f', avg(wer), quantile_cont(wer, 0.5), (SELECT wer FROM r WHERE i = n * 9 // 10)) FROM s
UNION ALL SELECT printf('  %s: %d (%.1f%%)', band, n, pct) FROM c UNION ALL SELECT printf('Looping preds: %d (%.1f%%)', count(*) FILTER (score >= 6), 100.0 * count(*) FILTER (score >= 6) / count(*)) FROM loops
UNION ALL SELECT printf('  %4d  %s', n, shift) FROM es UNION ALL SELECT CASE kind WHEN 'substitute' THEN printf('  %4d  ''%s'' -> ''%s''', n, ref_phrase, hyp_phrase) WHEN 'insert' THEN printf('  %4d  +''%s''', n, hyp_phrase) ELSE printf('  %4d  -''%s''', n, ref_phrase) END FROM ek WHERE n >= CASE kind WHEN 'substitute' THEN 8 ELSE 12 END AND place <= CASE kind WHEN 'substitute' THEN 25 ELSE 20 END
UNION ALL SELECT unnest(['Lexical shifts:', 'Top substitutions:', 'Top insertions:', 'Top deletions:'])
UNION ALL SELECT printf('WER %ss: n=%d mean=%.3f', CASE WHEN seconds < 30 THEN '<30' WHEN seconds < 60 THEN '30-60' ELSE '>=60' END, count(*), avg(wer)) FROM s GROUP BY CASE WHEN seconds < 30 THEN '<30' WHEN seconds < 60 THEN '30-60' ELSE '>=60' END"""


@query(_REPORT)
def snk_txt(spark, d):
    """The error report as one file, every line of it read back."""
    path = sinks.report(errors.report(cut(spread_rates(spark, d), "rates")), new_path(spark, "report"))
    return spark.read.text(path).select(F.col("value").alias("line"))


@query(f"WITH {X.MODEL_ROWS} SELECT model, count(*) AS n FROM model_rows GROUP BY model")
def snk_flush(spark, d):
    """One partition replaced for each model as it ends, so a crash keeps what was done."""
    rows, path = X.model_rows(spark, d), new_path(spark, "flush")
    for model in ("model_a", "model_b", "model_a", "model_c"):
        sinks.flush(rows.where(F.col("model") == model), "model", path)
    return spark.read.parquet(path).groupBy("model").agg(F.count(F.lit(1)).alias("n"))
