"""Queries of clips and chunks, batched functions and streams."""

from __future__ import annotations

from pyspark.sql import functions as F

from parkwright.functions.text import let
from parkwright.operators import audio, merging, predictors
from parkwright.operators import chunking as C
from parkwright.plans import fixtures as X
from parkwright.plans.columns import stuttering
from parkwright.plans.registry import ORACLE_SQL, query, table
from parkwright.streaming.running import running_rates

_EMB = "CAST(round(x::DOUBLE * 1000) AS BIGINT)"


@query("SELECT vec_id, CAST(list_sum(list_transform(embedding, lambda x: CAST(floor(x::DOUBLE * 1000) AS BIGINT) * 2)) AS BIGINT) AS total, CAST(len(embedding) AS BIGINT) AS n_samples FROM embeddings")
def ts_mono(spark, d):
    """Two channels, the second three times the first, as lists of channels or as lists of frames: the mean is twice the first either way."""
    a = F.transform("embedding", lambda x: F.floor(x.cast("double") * 1000))
    rows = table(spark, d, "embeddings").select("vec_id", a.alias("a"))
    channels = F.when(F.col("vec_id") % 2 == 0, F.array("a", F.transform("a", lambda x: x * 3))).otherwise(F.transform("a", lambda x: F.array(x, x * 3)))
    rows = rows.select("vec_id", C.downmix(channels).alias("m"))
    return rows.select("vec_id", F.aggregate("m", F.lit(0).cast("long"), lambda s, x: s + x.cast("long")).alias("total"), F.size("m").cast("long").alias("n_samples"))


_BAND = f"(least(1.0::DOUBLE, 16000.0::DOUBLE / rate) * {audio.ROLLOFF}::DOUBLE)"
_TAP = f"(CASE WHEN u = 0 THEN 1.0::DOUBLE ELSE sin(pi() * u) / (pi() * u) END) * (CASE WHEN abs(u) < {audio.CROSSINGS} THEN cos(pi() * u / {audio.CROSSINGS} / 2) * cos(pi() * u / {audio.CROSSINGS} / 2) ELSE 0 END)"


@query(f"""WITH r AS (SELECT vec_id, embedding AS e, CASE WHEN vec_id % 2 = 0 THEN 8000 ELSE 24000 END AS rate FROM embeddings),
o AS (SELECT *, {_BAND} AS band, unnest(range(CAST(ceil(len(e) * 16000.0::DOUBLE / rate) AS BIGINT))) AS i FROM r), k AS (SELECT *, unnest(range(len(e))) AS k FROM o),
t AS (SELECT vec_id, i, band, e[k + 1]::DOUBLE AS x, (i * rate / 16000.0::DOUBLE - k) * band AS u FROM k),
y AS (SELECT vec_id, i, sum(x * band * {_TAP}) AS y FROM t GROUP BY vec_id, i)
SELECT vec_id, count(*) AS n_samples, round(sum(y::FLOAT::DOUBLE * (i % 7)), 3) AS total FROM y GROUP BY vec_id""")
def ts_resample(spark, d):
    """8 and 24 kHz to 16 kHz through the filter."""
    clip = F.struct(F.col("embedding").alias("array"), F.when(F.col("vec_id") % 2 == 0, 8000).otherwise(24000).alias("sampling_rate"))
    rows = audio.prepared(table(spark, d, "embeddings").select("vec_id", clip.alias("audio")), "vec_id", "audio")
    total = F.aggregate(F.transform("samples", lambda x, i: x.cast("double") * (i % 7)), F.lit(0.0), lambda a, x: a + x)
    return rows.select("vec_id", F.size("samples").cast("long").alias("n_samples"), F.round(total, 3).alias("total"))


@query("SELECT vec_id, CAST(len(e) AS BIGINT) AS n_samples, CAST(list_sum(list_transform(e, lambda x: CAST(floor(x::DOUBLE * 1000) AS BIGINT))) AS BIGINT) AS total FROM (SELECT vec_id, embedding[1:32] AS e FROM embeddings)")
def ts_cap(spark, d):
    """What a limit of 2 ms leaves."""
    rows = table(spark, d, "embeddings").select("vec_id", C.cap(F.col("embedding"), 0.002).alias("e"))
    return rows.select("vec_id", F.size("e").cast("long").alias("n_samples"), F.aggregate("e", F.lit(0).cast("long"), lambda a, x: a + F.floor(x.cast("double") * 1000)).alias("total"))


@query(f"""WITH {X.CLIPS}, k AS (SELECT clip_id, n_samples AS n, CASE WHEN n_samples <= 480000 THEN 1 ELSE least(1 + CAST(ceil((n_samples - 480000) / 400000) AS BIGINT), CAST(ceil(n_samples / 400000) AS BIGINT)) END AS k FROM clips)
SELECT clip_id, i AS chunk_index, i * 400000 AS start, least(i * 400000 + 480000, n) AS "end" FROM k, LATERAL (SELECT unnest(range(k)) AS i)""")
def ts_chunk(spark, d):
    """Hopping chunks of 30 s every 25 s."""
    rows = X.clips(spark, d).select("clip_id", F.posexplode(C.windows(F.col("n_samples"), C.samples(30), C.samples(25))).alias("i", "w"))
    return rows.select("clip_id", F.col("i").cast("long").alias("chunk_index"), "w.start", "w.end")


@query(f"WITH {X.CLIPS} SELECT CASE WHEN max(duration_s) > 30 THEN 30.0::DOUBLE END AS auto, 12.0::DOUBLE AS given, NULL::DOUBLE AS off FROM clips")
def ts_auto(spark, d):
    top = F.max("duration_s")
    return X.clips(spark, d).agg(C.chunk_seconds(None, top).alias("auto"), C.chunk_seconds(12, top).alias("given"), C.chunk_seconds(0, top).alias("off"))


@query(f"""WITH {X.CLIPS}, a AS (SELECT clip_id, n_samples AS n, greatest(CAST(ceil(n_samples / 480000) AS BIGINT), 1) AS k0 FROM clips),
b AS (SELECT *, CASE WHEN k0 > 1 AND n - (k0 - 1) * 480000 < 4000 THEN k0 - 1 ELSE k0 END AS k FROM a), c AS (SELECT clip_id, i, i * 480000 AS start, CASE WHEN i = k - 1 THEN n ELSE (i + 1) * 480000 END AS "end" FROM b, LATERAL (SELECT unnest(range(k)) AS i))
SELECT clip_id, i AS chunk_index, start, "end", greatest(4000 - ("end" - start), 0) AS padding FROM c""")
def ts_tail(spark, d):
    rows = X.clips(spark, d).select("clip_id", F.posexplode(C.tail_merged(F.col("n_samples"), 480_000, 4000)).alias("i", "w"))
    return rows.select("clip_id", F.col("i").cast("long").alias("chunk_index"), "w.start", "w.end", "w.padding")


@query("""WITH RECURSIVE w AS (SELECT conv_id * 1000 + turn AS id, list_transform(list_filter(string_split_regex(text, '\\s+'), lambda x: x <> ''), lambda x: length(x) * 0.25::DOUBLE) AS ls FROM conversations),
u AS (SELECT id, unnest(ls) AS l, unnest(range(len(ls))) AS i FROM w), s AS (SELECT id, i, sum(l) OVER (PARTITION BY id ORDER BY i) - l AS s, sum(l) OVER (PARTITION BY id ORDER BY i) AS e FROM u),
p AS (SELECT id, i, s AS st, 0 AS c FROM s WHERE i = 0 UNION ALL SELECT s.id, s.i, CASE WHEN s.e - p.st > 28 THEN s.s ELSE p.st END, p.c + CASE WHEN s.e - p.st > 28 THEN 1 ELSE 0 END FROM p JOIN s ON s.id = p.id AND s.i = p.i + 1)
SELECT id, c AS chunk_index, CAST(min(i) AS INTEGER) AS first, CAST(max(i) AS INTEGER) AS last, count(*) AS n FROM p GROUP BY id, c""")
def ts_pack(spark, d):
    """Words of a quarter second a letter, packed into chunks of at most 28 s: the first and last of each."""
    words = F.transform(F.array_remove(F.split("text", r"\s+"), ""), lambda w: F.length(w) * F.lit(0.25))

    def spans(ls):
        step = lambda a, x: F.array_append(a, F.struct(F.coalesce(F.element_at(a, -1)["end"], F.lit(0.0)).alias("start"), (F.coalesce(F.element_at(a, -1)["end"], F.lit(0.0)) + x).alias("end")))
        return F.slice(F.aggregate(ls, F.array(F.struct(F.lit(0.0).alias("start"), F.lit(0.0).alias("end"))), step), F.lit(2), F.greatest(F.size(ls), F.lit(0)))

    rows = table(spark, d, "conversations").select((F.col("conv_id") * 1000 + F.col("turn")).alias("id"), C.packed_spans(let(words, spans), 28.0).alias("chunks"))
    return rows.select("id", F.posexplode("chunks").alias("chunk_index", "c")).select("id", "chunk_index", F.element_at("c", 1).alias("first"), F.element_at("c", -1).alias("last"), F.size("c").cast("long").alias("n"))


_WORDS = "list_filter(string_split_regex(text, '\\s+'), lambda x: x <> '')"


@query(f"""WITH w AS (SELECT conv_id * 1000 + turn AS id, {_WORDS} AS ws FROM conversations), k AS (SELECT *, CAST(ceil(len(ws) / 28) AS BIGINT) AS k FROM w)
SELECT id, i AS chunk_index, k AS num_chunks, array_to_string(ws[i * 28 + 1:least((i + 1) * 28, len(ws))], ' ') AS text, least((i + 1) * 28, len(ws)) * 16000 AS end_sample FROM k, LATERAL (SELECT unnest(range(k)) AS i)""")
def ts_emit(spark, d):
    """Words of a second each, packed into chunks of at most 28 s: text, end and place of each chunk."""
    words = F.array_remove(F.split("text", r"\s+"), "")
    rows = table(spark, d, "conversations").select((F.col("conv_id") * 1000 + F.col("turn")).alias("id"), words.alias("ws"))
    spans = F.transform("ws", lambda w, i: F.struct(i.cast("double").alias("start"), (i + 1).cast("double").alias("end")))
    rows = rows.withColumn("chunks", C.packed_spans(spans, 28.0))
    rows = rows.select("id", "ws", F.size("chunks").cast("long").alias("num_chunks"), F.posexplode("chunks").alias("i", "c"))
    text = F.array_join(F.slice("ws", F.element_at("c", 1) + 1, F.size("c")), " ")
    end = F.least(F.element_at("c", -1) + 1, F.size("ws")).cast("long") * 16000
    return rows.select("id", F.col("i").cast("long").alias("chunk_index"), "num_chunks", text.alias("text"), end.alias("end_sample"))


@query(f"WITH {X.SPOKEN} SELECT outcome, count(DISTINCT clip_id) AS clips, count(*) AS n_rows, CAST(sum(\"end\" - start) AS BIGINT) AS samples FROM spoken_chunks GROUP BY outcome")
def ts_pass(spark, d):
    """Clips and rows by outcome: short clips and blank texts pass unsplit, a failed alignment leaves one row, the others are cut."""
    rows = C.chunked(X.spoken(spark, d), "spans")
    return rows.groupBy("outcome").agg(F.count_distinct("clip_id").alias("clips"), F.count(F.lit(1)).alias("n_rows"), F.sum(F.col("end") - F.col("start")).alias("samples"))


@query(f"""SELECT conv_id * 1000 + turn AS id, array_to_string(CASE WHEN len(list_filter(string_split_regex(text, '\\s+'), lambda x: x <> '')) = len({X.ALIGNED}) THEN list_filter(string_split_regex(text, '\\s+'), lambda x: x <> '') ELSE {X.ALIGNED} END, '|') AS words FROM conversations""")
def ts_words(spark, d):
    """The words as written, unless their number differs from the normalised ones."""
    return table(spark, d, "conversations").select((F.col("conv_id") * 1000 + F.col("turn")).alias("id"), F.array_join(C.chosen_words(F.col("text")), "|").alias("words"))


@query(f"WITH {X.FRAMES} SELECT id, CASE WHEN error = 'wrong number of labels' THEN t - 1 ELSE t END AS n_runs, error FROM frames")
def ts_ctc(spark, d):
    """Runs of frame paths, and why they don't spell their words if they don't."""
    rows = X.frames(spark, d)
    x = C.checked_runs(F.col("path"), C.token_ranges(F.col("words"), X.LETTERS)["labels"], 0)
    return rows.select("id", x.alias("x")).select("id", F.size("x.runs").cast("long").alias("n_runs"), "x.error")


@query(f"""WITH {X.FRAMES}, b AS (SELECT id, t, unnest(ls) AS l, unnest(list_transform(ls, lambda x, i: i - 1 + coalesce(list_sum(ls[1:i - 1]), 0))) AS first_at FROM frames WHERE error IS NULL),
s AS (SELECT id, (3 * first_at) * (t * 3 * 320 / 16000::DOUBLE / (t * 3)) AS s, (3 * (first_at + l - 1) + 2) * (t * 3 * 320 / 16000::DOUBLE / (t * 3)) AS e FROM b WHERE l > 0)
SELECT frames.id, error, CASE WHEN error IS NULL THEN count(s) END AS n_spans, round(min(s), 6) AS first, round(max(e), 6) AS last, round(sum(e - s), 4) AS seconds FROM frames LEFT JOIN s USING (id) GROUP BY frames.id, error""")
def ts_span(spark, d):
    """Seconds of words from frame paths at 20 ms a frame; words without a known letter have none."""
    rows = X.frames(spark, d)
    x = C.word_spans(F.col("path"), C.token_ranges(F.col("words"), X.LETTERS), 0, F.size("path") * 320)
    rows = rows.select("id", x.alias("x")).select("id", "x.error", "x.spans")
    seconds = F.aggregate("spans", F.lit(0.0), lambda a, s: a + (s["end"] - s["start"]))
    return rows.select("id", "error", F.when(F.col("error").isNull(), F.size("spans").cast("long")).alias("n_spans"), F.round(F.get("spans", F.lit(0))["start"], 6).alias("first"), F.round(F.element_at("spans", -1)["end"], 6).alias("last"), F.round(seconds, 4).alias("seconds"))


_JOINED = "string_agg(CASE WHEN turn % 4 <> 1 THEN regexp_replace(text, '^\\s+|\\s+$', '', 'g') END, ' ' ORDER BY turn)"


@query(f"SELECT conv_id AS clip_id, count(*) AS num_chunks, length(coalesce({_JOINED}, '')) AS chars FROM conversations GROUP BY conv_id")
def ts_reasm(spark, d):
    """Chunk texts of each clip stitched in order; blank ones leave nothing."""
    rows = table(spark, d, "conversations").select(F.col("conv_id").alias("clip_id"), "turn", F.when(F.col("turn") % 4 != 1, F.col("text")).otherwise("  ").alias("h"))
    return C.reassembled(rows, ["clip_id"], "turn", "h").select("clip_id", "num_chunks", F.length("full_text").cast("long").alias("chars"))


@query("SELECT role AS source_dataset, conv_id AS clip_id, string_agg(regexp_replace(text, '^\\s+|\\s+$', '', 'g'), ' ' ORDER BY turn) AS full_text FROM conversations GROUP BY role, conv_id")
def ts_reasm2(spark, d):
    """Prepared chunks of each (source, clip) as full texts; sentences of this table start in upper case already."""
    rows = table(spark, d, "conversations").select(F.col("role").alias("source_dataset"), F.col("conv_id").alias("clip_id"), "turn", "text")
    return C.reassembled(rows, ["source_dataset", "clip_id"], "turn", "text").select("source_dataset", "clip_id", "full_text")


@query(f"""WITH {X.SPOKEN}, full_texts AS (SELECT clip_id, regexp_replace(text, '^\\s+|\\s+$', '', 'g') AS f FROM spoken)
SELECT clip_id, split, CAST(i AS INTEGER) AS chunk_index, CASE WHEN split = 'test' THEN CAST(k AS INTEGER) END AS num_chunks, CASE WHEN split = 'test' THEN f END AS full_text, text, 'test' AS chunks FROM spoken_chunks JOIN full_texts USING (clip_id) WHERE split <> 'other'
UNION ALL SELECT clip_id, split, CAST(i AS INTEGER), NULL, NULL, text, '' FROM spoken_chunks WHERE split IN ('train', 'validation')
UNION ALL SELECT clip_id, split, CASE WHEN split = 'test' THEN 0 END, NULL, NULL, text, c FROM spoken, (SELECT unnest(['', 'test']) AS c) WHERE split = 'other' OR (split = 'test' AND c = '')""")
def ts_route(spark, d):
    """Train and validation are always chunked, test on demand, other splits never; with test and without."""
    clips, names = X.spoken(spark, d), ["clip_id", "split", "chunk_index", "num_chunks", "full_text", "text", "chunks"]
    asked = C.routed(clips, "spans", chunk_test=True).withColumn("chunks", F.lit("test"))
    return asked.select(*names).unionByName(C.routed(clips, "spans").withColumn("chunks", F.lit("")).select(*[c for c in names if c not in ("num_chunks", "full_text")]), allowMissingColumns=True)


#: What the frame paths spell: their last label is one more than it should be in some, and missing in others; the label after the word mark is unknown.
_SPELT = f"""spelt_w AS (SELECT conv_id * 1000 + turn AS id, array_to_string(list_transform({X.ALIGNED}, lambda w: regexp_replace(w, '[^{X.LETTERS}]', '', 'g')), ' ') AS s FROM conversations),
spelt_c AS (SELECT id, CASE WHEN s IS NULL OR s = '' THEN '' WHEN id % 7 = 0 THEN s[1:length(s) - 1] || CASE right(s, 1) WHEN 'z' THEN ' ' WHEN ' ' THEN '#' ELSE chr(ascii(right(s, 1)) + 1) END WHEN id % 7 = 1 THEN s[1:length(s) - 1] ELSE s END AS s FROM spelt_w),
spelt AS (SELECT id, CASE WHEN NOT contains(s, '#') THEN trim(regexp_replace(s, ' +', ' ', 'g')) END AS prediction, CASE WHEN contains(s, '#') THEN '[ERROR: label 28]' END AS error FROM spelt_c)"""


@query(f"WITH {_SPELT} SELECT id, prediction, error FROM spelt")
def udf_batched(spark, d):
    """Frame paths decoded in batches; a path with an unknown label fails its batch, whose other rows are decoded alone, and keeps its error."""
    return predictors.predict(X.frames(spark, d), "frame_labels", "id", "path").select("id", "prediction", "error")


@query(f"""WITH {_SPELT} SELECT id, 'frame_labels' AS model, prediction FROM spelt UNION ALL SELECT id, 'anti_loop', out FROM ({ORACLE_SQL["str_collapse"]}) UNION ALL SELECT id, 'casing', out FROM ({ORACLE_SQL["str_polish"]})""")
def udf_registry(spark, d):
    """Three predictors asked by name, each over its own inputs."""
    key = (F.col("conv_id") * 1000 + F.col("turn")).alias("id")
    rows = table(spark, d, "conversations")
    inputs = {
        "frame_labels": X.frames(spark, d).select("id", F.col("path").alias("x")), "anti_loop": rows.select(key, F.array_join(stuttering(F.col("text")), " ").alias("x")),
        "casing": rows.select(key, F.lower(F.replace("text", F.lit(" "), F.lit("  "))).alias("x")),
    }
    return merging.concatenated({m: predictors.predict(x, m, "id", "x").select("id", "prediction") for m, x in inputs.items()}, "model")


@query(f"WITH {X.pairs_sql()} SELECT coalesce(source_dataset, 'pooled') AS source_dataset, CAST(sum(word_edits) AS BIGINT) AS word_edits, CAST(sum(n_words) AS BIGINT) AS n_words FROM p GROUP BY GROUPING SETS ((), (source_dataset))")
def stream_wer(spark, d):
    """Running sums over a directory of predictions, read as a stream to its end."""
    return running_rates(spark, X.pairs(spark, d))
