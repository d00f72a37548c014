"""Queries of projections, scalar functions and filters."""

from __future__ import annotations

from pyspark.sql import functions as F

from parkwright.functions import numbers as N
from parkwright.functions import text as T
from parkwright.operators import gates, ranking, scoring
from parkwright.plans import fixtures as X
from parkwright.plans.registry import query, table
from parkwright.sources import tables

KEY = "conv_id * 1000 + turn AS id"
DOC_TEXT = "SELECT doc_id AS row_id, text FROM documents"


def _messages(spark, d):
    return table(spark, d, "conversations").select((F.col("conv_id") * 1000 + F.col("turn")).alias("id"), "role", "text")


def _documents(spark, d):
    return table(spark, d, "documents")


@query("SELECT doc_id, text FROM documents")
def prj_resolve(spark, d):
    """The text column found by candidates among others, in any case."""
    df = _documents(spark, d).withColumnRenamed("text", "Transcript").withColumnRenamed("lang", "sentence")
    return df.select("doc_id", F.col(tables.resolve(df.columns, tables.TEXT_COLUMNS)).alias("text"))


@query("SELECT doc_id AS speaker_id, text, CAST(n_chars AS DOUBLE) AS audio FROM documents")
def prj_rename(spark, d):
    df = _documents(spark, d).select(F.col("doc_id").alias("speaker_id"), F.col("text").alias("Sentence"), F.col("n_chars").alias("Path"))
    return tables.canonical(df, {"audio": tables.AUDIO_COLUMNS, "text": tables.TEXT_COLUMNS}).withColumn("audio", F.col("audio").cast("double")).select("speaker_id", "text", "audio")


@query("SELECT doc_id, 'documents' AS source_dataset, 'suite-a' AS suite FROM documents")
def prj_tag(spark, d):
    return tables.load_many({"documents": _documents(spark, d).select("doc_id")}, "suite-a").select("doc_id", "source_dataset", "suite")


@query("SELECT doc_id, 0 AS chunk_index, 'absent' AS given FROM documents UNION ALL SELECT doc_id, CAST(doc_id % 3 AS INTEGER), 'there' FROM documents")
def prj_chunk0(spark, d):
    """The first chunk for rows that know of none; a table that has chunks keeps them."""
    docs = _documents(spark, d).select("doc_id")
    there = docs.withColumn("chunk_index", (F.col("doc_id") % 3).cast("int"))
    return tables.with_default(docs, "chunk_index", F.lit(0)).withColumn("given", F.lit("absent")).unionByName(tables.with_default(there, "chunk_index", F.lit(0)).withColumn("given", F.lit("there")))


@query(f"WITH {X.CLIPS} SELECT clip_id, duration_s, row_number() OVER (ORDER BY duration_s, clip_id) - 1 AS row_idx FROM clips")
def prj_rowidx(spark, d):
    return ranking.row_index(X.clips(spark, d).select("clip_id", "duration_s"), ["duration_s", "clip_id"])


@query("SELECT doc_id, coalesce(CASE WHEN doc_id % 3 = 0 THEN text END, CASE WHEN doc_id % 3 = 1 THEN lang END, '') AS text FROM documents")
def prj_textfirst(spark, d):
    one = lambda k, c: F.when(F.col("doc_id") % 3 == k, F.col(c))
    return _documents(spark, d).select("doc_id", F.coalesce(one(0, "text"), one(1, "lang"), F.lit("")).alias("text"))


@query("""SELECT page_id, coalesce(nullif(regexp_extract(CASE WHEN page_id % 3 = 0 THEN url WHEN page_id % 3 = 1 THEN 'a\\b\\' || page_id || '.wav' END, '[^/\\\\]*$'), ''), 'row_' || page_id) AS label FROM pages""")
def prj_label(spark, d):
    """The base name of the first label that isn't blank, else row_<i>."""
    page = F.when(F.col("page_id") % 3 == 0, F.col("url"))
    path = F.when(F.col("page_id") % 3 == 1, F.concat(F.lit("a\\b\\"), "page_id", F.lit(".wav")))
    found = F.nullif(T.label(F.lit("  "), page, path), F.lit(""))
    return table(spark, d, "pages").select("page_id", F.coalesce(found, F.concat(F.lit("row_"), "page_id")).alias("label"))


@query("SELECT page_id, url FROM pages")
def prj_prunepath(spark, d):
    """Only the columns named are read from the files."""
    return table(spark, d, "pages").select("page_id", "url")


@query("SELECT doc_id AS row_idx, 'doc_' || doc_id AS audio_path, n_chars / 16.0::DOUBLE AS audio_duration_s FROM documents")
def prj_meta(spark, d):
    return _documents(spark, d).select(F.col("doc_id").alias("row_idx"), F.concat(F.lit("doc_"), "doc_id").alias("audio_path"), (F.col("n_chars") / 16).alias("audio_duration_s"))


@query(f"""WITH {X.pairs_sql()} SELECT dataset, source_dataset, row_idx, reference, prediction, word_edits / n_words AS wer, char_edits / n_chars AS cer,
CASE WHEN n_words_n > 0 THEN word_edits_n / n_words_n ELSE 0 END AS wer_normalized, CASE WHEN n_chars_n > 0 THEN char_edits_n / n_chars_n ELSE 0 END AS cer_normalized FROM p""")
def prj_pred(spark, d):
    """Prediction rows with raw and normalised rates."""
    rows = scoring.scored(scoring.scored(X.pairs(spark, d)), "jiwer_default", "_n")
    rows = scoring.row_rates(scoring.row_rates(rows), "_n")
    return rows.select("dataset", "source_dataset", "row_idx", "reference", "prediction", "wer", "cer", F.col("wer_n").alias("wer_normalized"), F.col("cer_n").alias("cer_normalized"))


@query(f"SELECT {KEY}, regexp_replace(regexp_replace(lower(text), '\\s+', ' ', 'g'), '^\\s+|\\s+$', '', 'g') AS out FROM conversations")
def str_simple(spark, d):
    return _messages(spark, d).select("id", T.simple(T.text("text")).alias("out"))


_PLAIN = "regexp_replace(regexp_replace(regexp_replace(lower(text), '^\\s+|\\s+$', '', 'g'), '\\s\\s+', ' ', 'g'), '\\p{P}', '', 'g')"


@query(f"SELECT {KEY}, array_to_string(list_filter(string_split({_PLAIN}, ' '), lambda x: x <> ''), '|') AS out FROM conversations")
def str_jw_w(spark, d):
    return _messages(spark, d).select("id", F.array_join(T.plain_words(T.text("text")), "|").alias("out"))


@query(f"SELECT {KEY}, regexp_replace({_PLAIN}, '\\s', '', 'g') AS out FROM conversations")
def str_jw_c(spark, d):
    return _messages(spark, d).select("id", T.plain_chars(T.text("text")).alias("out"))


@query(f"SELECT {KEY}, array_to_string(list_filter(string_split_regex(regexp_replace(lower(text), '[^\\p{{L}}\\p{{M}}\\p{{N}}_\\s'']', ' ', 'g'), '\\s+'), lambda x: x <> ''), ' ') AS out FROM conversations")
def str_align(spark, d):
    return _messages(spark, d).select("id", F.array_join(T.align_words(T.text("text")), " ").alias("out"))


@query(f"SELECT {KEY}, trim(regexp_replace(regexp_replace(lower(text), '[^\\p{{L}}\\p{{M}}\\p{{N}}_\\s]', ' ', 'g'), '\\s+', ' ', 'g')) AS out FROM conversations")
def str_erra(spark, d):
    return _messages(spark, d).select("id", T.error_text(T.text("text")).alias("out"))


@query(f"""SELECT {KEY}, coalesce(array_to_string(list_transform(regexp_extract_all(regexp_replace(lower(replace(text, ' ', '  ')), '^\\s+|\\s+$', '', 'g'), '(?s).*?(?:[.!?]\\s+|$)'),
lambda s: CASE WHEN regexp_matches(s, '^[a-zà-ɏ]') THEN upper(s[1]) || s[2:] ELSE s END), ''), '') AS out FROM conversations""")
def str_polish(spark, d):
    """Messages in lower case with wide gaps, as sentences again."""
    return _messages(spark, d).select("id", T.polish(F.lower(F.replace("text", F.lit(" "), F.lit("  ")))).alias("out"))


def stuttering(c):
    """Words of a text and its first again, every eleventh of them three times."""
    words = F.array_remove(F.split(F.concat(c, F.lit(" "), F.split_part(c, F.lit(" "), F.lit(1))), r"\s+"), "")
    return F.flatten(F.transform(words, lambda w, i: F.when(i % 11 == 0, F.array(w, F.when(w.rlike("^[ -~]+$"), F.upper(w)).otherwise(w), w)).otherwise(F.array(w))))


@query("""SELECT conv_id * 1000 + turn AS id, array_to_string(list_transform(list_filter(list_zip(ws, list_prepend(NULL, ws)), lambda z: z[1] IS NOT NULL AND (z[2] IS NULL OR lower(z[1]) <> lower(z[2]))), lambda z: z[1]), ' ') AS out
FROM (SELECT *, list_filter(string_split_regex(text || ' ' || split_part(text, ' ', 1), '\\s+'), lambda x: x <> '') AS w0 FROM conversations), LATERAL (SELECT flatten(list_transform(w0, lambda x, i: CASE WHEN i % 11 = 1 THEN [x, CASE WHEN regexp_full_match(x, '[ -~]+') THEN upper(x) ELSE x END, x] ELSE [x] END)) AS ws)""")
def str_collapse(spark, d):
    """Stuttered words collapsed to their first."""
    return _messages(spark, d).select("id", F.array_join(T.collapse_runs(stuttering(F.col("text"))), " ").alias("out"))


@query(f"WITH {X.STUTTERED}, {X.loops_sql('stuttered')} SELECT id, score FROM loops")
def str_loop(spark, d):
    return X.stuttered(spark, d).select("id", T.loop_score(F.col("text")).alias("score"))


@query("SELECT doc_id, CASE WHEN doc_id % 4 = 0 THEN trim(lang) WHEN doc_id % 4 = 1 THEN source || ' ' || lang ELSE '' END AS out FROM documents")
def str_piped(spark, d):
    """A recogniser's answer as text, as chunks, or nothing."""
    answer = F.when(F.col("doc_id") % 4 == 0, F.concat(F.lit(" "), "lang", F.lit("\n")))
    chunks = F.when(F.col("doc_id") % 4 == 1, F.array(F.concat("source", F.lit(" ")), F.lit("  "), F.lit(None).cast("string"), F.col("lang")))
    return _documents(spark, d).select("doc_id", T.recogniser_text(answer, chunks).alias("out"))


@query(f"SELECT {KEY}, array_to_string(regexp_extract_all(lower(text), '[a-zA-ZÀ-ÿ]+'), ' ') AS out FROM conversations")
def str_tokens(spark, d):
    return _messages(spark, d).select("id", F.array_join(T.tokens(F.col("text")), " ").alias("out"))


def _list(words) -> str:
    return "[" + ", ".join(f"'{w}'" for w in words) + "]"


_TOKENS = "regexp_extract_all(lower(response), '[a-zA-ZÀ-ÿ]+')"
_SHARE = f"CASE WHEN len({_TOKENS}) > 0 THEN len(list_filter({_TOKENS}, lambda x: list_contains({_list(gates.COMMON_WORDS)}, x))) / len({_TOKENS}) END"


@query(f"WITH {X.REPLIES_SQL} SELECT id, {_SHARE} AS share FROM replies")
def str_swfrac(spark, d):
    return X.replies(spark, d).select("id", gates.common_share(F.col("response")).alias("share"))


_any = lambda c, words: "(" + " OR ".join(f"contains({c}, '{w}')" for w in words) + ")"
_STRIPPED = "regexp_replace(response, '^\\s+|\\s+$', '', 'g')"
_GREET = f"""CASE WHEN lower(category) IN ('thanks', 'acknowledgment') THEN false WHEN {_STRIPPED} = '' THEN true WHEN regexp_matches({_STRIPPED}, '{gates.GREETING}') THEN true
WHEN {_any('lower(response)', gates.TOPIC_WORDS)} OR {_any('lower(response)', gates.ACTION_WORDS)} THEN false
WHEN len({_TOKENS}) <= 12 AND contains(lower(response), 'habari') THEN true WHEN len({_TOKENS}) <= 8 AND {_any('lower(response)', gates.OFFERS)} THEN true ELSE false END"""
_SUBST = f"""CASE WHEN lower(category) IN ('thanks', 'acknowledgment') THEN {_any('lower(response)', gates.THANKS_WORDS)}
WHEN {_any('lower(response)', gates.TOPIC_WORDS)} OR {_any('lower(response)', gates.ACTION_WORDS)} OR regexp_matches(lower(response), '{gates.STEPS}') THEN true ELSE length({_STRIPPED}) >= 50 END"""
_CHECKS = f"""list_filter([CASE WHEN {_STRIPPED} = '' THEN 'non_empty' END, CASE WHEN regexp_full_match({_STRIPPED}, '[\\d\\s.,]+') THEN 'not_digits_only' END,
CASE WHEN {_any('lower(response)', gates.ECHOES)} THEN 'not_asr_echo' END, CASE WHEN coalesce({_SHARE} < CASE WHEN lower(category) IN ('thanks', 'acknowledgment', 'greeting') THEN 0.08 ELSE 0.10 END, true) THEN 'has_swahili_content' END,
CASE WHEN {_GREET} THEN 'not_generic_greeting' END, CASE WHEN NOT ({_SUBST}) THEN 'has_substance' END], lambda x: x IS NOT NULL)"""
SCORED_SQL = f"WITH {X.REPLIES_SQL}, scored AS (SELECT id, category, response, {_CHECKS} AS failed FROM replies)"


@query(f"WITH {X.REPLIES_SQL} SELECT id, {_GREET} AS generic FROM replies")
def str_greet(spark, d):
    return X.replies(spark, d).select("id", gates.generic_greeting(F.col("response"), F.col("category")).alias("generic"))


@query(f"WITH {X.REPLIES_SQL} SELECT id, {_SUBST} AS substantive FROM replies")
def str_subst(spark, d):
    return X.replies(spark, d).select("id", gates.substantive(F.col("response"), F.col("category")).alias("substantive"))


@query(f"{SCORED_SQL} SELECT id, array_to_string(failed, ',') AS failed, len(failed) = 0 AS passed FROM scored")
def str_score(spark, d):
    return gates.judged(X.replies(spark, d)).select("id", F.array_join("failed_checks", ",").alias("failed"), "passed")


PROMPTS = "prompts AS (SELECT conv_id * 1000 + turn AS id, text || CASE WHEN turn % 2 = 0 THEN '?' ELSE '' END AS prompt, CASE role WHEN 'user' THEN 'greeting' WHEN 'assistant' THEN 'FollowUp' ELSE 'thanks' END AS category FROM conversations)"


def _prompts(spark, d):
    category = F.when(F.col("role") == "user", "greeting").when(F.col("role") == "assistant", "FollowUp").otherwise("thanks")
    return table(spark, d, "conversations").select((F.col("conv_id") * 1000 + F.col("turn")).alias("id"), F.concat("text", F.when(F.col("turn") % 2 == 0, "?").otherwise("")).alias("prompt"), category.alias("category"))


@query(f"""WITH {PROMPTS} SELECT id, CASE WHEN lower(category) = 'followup' THEN '{gates.FOLLOWUP_CONTEXT}' || chr(10) || prompt
WHEN lower(category) = 'greeting' AND contains(prompt, '?') AND len(list_filter(string_split_regex(prompt, '\\s+'), lambda x: x <> '')) < 15 THEN prompt || chr(10) || '{gates.GREETING_REQUEST}' ELSE prompt END AS out FROM prompts""")
def str_augment(spark, d):
    return _prompts(spark, d).select("id", gates.augmented(F.col("prompt"), F.col("category")).alias("out"))


@query(f"""WITH {PROMPTS}, s AS (SELECT *, CASE WHEN id % 2 = 0 THEN 'Be brief.' ELSE '' END || CASE WHEN lower(category) = 'thanks' THEN '{gates.THANKS_SUFFIX}' WHEN lower(category) = 'followup' THEN '{gates.FOLLOWUP_SUFFIX}' ELSE '' END AS sys FROM prompts)
SELECT id, CASE WHEN trim(sys, ' ' || chr(10)) = '' THEN 'user' ELSE 'system,user' END AS roles, CASE WHEN trim(sys, ' ' || chr(10)) = '' THEN prompt ELSE trim(sys, ' ' || chr(10)) END AS first_text FROM s""")
def str_msgs(spark, d):
    """A prompt as a list of messages: roles, and the first text."""
    m = gates.message_list(F.col("prompt"), F.col("category"), F.when(F.col("id") % 2 == 0, "Be brief."))
    rows = _prompts(spark, d).select("id", m.alias("m"))
    return rows.select("id", F.array_join(F.transform("m", lambda x: x["role"]), ",").alias("roles"), F.col("m")[0]["content"][0]["text"].alias("first_text"))


@query("SELECT vec_id, len(embedding) / 16000::DOUBLE AS duration_s FROM embeddings")
def num_dur(spark, d):
    return table(spark, d, "embeddings").select("vec_id", N.duration(F.size("embedding")).alias("duration_s"))


@query(f"WITH {X.MODEL_ROWS} SELECT audio_file, model, rtfx FROM model_rows")
def num_rtfx(spark, d):
    rows = X.model_rows(spark, d)
    return rows.select("audio_file", "model", N.real_time_factor(F.col("audio_duration_s"), F.col("decode_wall_s")).alias("rtfx"))


@query("SELECT doc_id, CASE WHEN n_chars > 0 THEN least((((n_chars + 2 - 3) // 2 + 1) + 2 - 3) // 2 + 1, 188) ELSE 0 END AS soft FROM documents")
def num_soft(spark, d):
    return _documents(spark, d).select("doc_id", N.soft_tokens(F.col("n_chars"), 188).alias("soft"))


@query("SELECT doc_id, n_chars / 1000.0::DOUBLE - doc_id / 1000.0::DOUBLE AS delta, n_chars / 1000.0::DOUBLE - doc_id / 1000.0::DOUBLE <= 0.02 AS ok FROM documents")
def num_delta(spark, d):
    both = N.delta(F.col("n_chars") / 1000.0, F.col("doc_id") / 1000.0)
    return _documents(spark, d).select("doc_id", both.alias("x")).select("doc_id", "x.*")


@query(r"""SELECT doc_id, '{"lang":"' || lang || '","text":"' || replace(replace(replace(text, '\', '\\'), '"', '\"'), chr(10), '\n') || '"}' AS out FROM documents""")
def json_esc(spark, d):
    """Characters outside ASCII stay as they are."""
    return _documents(spark, d).select("doc_id", F.to_json(F.struct("lang", "text")).alias("out"))


@query(f"WITH {X.pairs_sql()} SELECT row_idx FROM p WHERE row_idx % 3 <> 0 AND trim(reference) <> ''")
def flt_ref(spark, d):
    """Pairs with a reference; an absent prediction stays."""
    rows = X.pairs(spark, d).withColumn("reference", F.when(F.col("row_idx") % 3 != 0, F.col("reference")).otherwise(" \n"))
    return rows.where(T.strip(T.text("reference")) != "").select("row_idx")


@query(f"WITH {X.CLIPS} SELECT clip_id, duration_s FROM clips WHERE duration_s <= 30")
def flt_dur(spark, d):
    return X.clips(spark, d).where(F.col("duration_s") <= N.MAX_CLIP_SECONDS).select("clip_id", "duration_s")


@query(f"WITH {X.CLIPS} SELECT count(*) FILTER (duration_s > 30) AS over_30s, count(*) FILTER (duration_s <= 30) AS kept FROM clips")
def flt_long(spark, d):
    return X.clips(spark, d).agg(F.count_if(F.col("duration_s") > N.MAX_CLIP_SECONDS).alias("over_30s"), F.count_if(F.col("duration_s") <= N.MAX_CLIP_SECONDS).alias("kept"))


@query("SELECT count(*) FILTER (doc_id % 5 IN (0, 1)) AS empty_text FROM documents")
def flt_empty(spark, d):
    c = F.when(F.col("doc_id") % 5 == 0, F.lit(" \n")).when(F.col("doc_id") % 5 != 1, F.col("text"))
    return _documents(spark, d).agg(F.count_if(T.strip(T.text(c)) == "").alias("empty_text"))


@query("SELECT doc_id, lang || ' ' || source AS out FROM documents")
def flt_part(spark, d):
    parts = F.array(F.concat(F.lit(" "), "lang"), F.lit("  "), F.lit(""), F.concat("source", F.lit("\n")))
    kept = F.filter(F.transform(parts, T.strip), lambda x: x != "")
    return _documents(spark, d).select("doc_id", F.array_join(kept, " ").alias("out"))


@query("SELECT vec_id, CAST(len(list_filter(embedding, lambda x: x >= 0)) AS BIGINT) AS kept FROM embeddings")
def flt_mask(spark, d):
    """Positions of masked labels leave both sides."""
    labels = F.transform("embedding", lambda x: F.when(x < 0, -100).otherwise(1))
    both = F.filter(F.arrays_zip(labels.alias("label"), F.col("embedding").alias("value")), lambda z: z["label"] != -100)
    return table(spark, d, "embeddings").select("vec_id", F.size(both).cast("long").alias("kept"))


@query("SELECT source, n FROM (SELECT source, count(*) AS n FROM documents WHERE doc_id % 3 <> 0 OR lang = 'en' GROUP BY source ORDER BY n DESC, source LIMIT 8) WHERE n >= 42")
def flt_having(spark, d):
    from parkwright.operators.errors import top_k_then

    counts = _documents(spark, d).where("doc_id % 3 <> 0 or lang = 'en'").groupBy("source").agg(F.count(F.lit(1)).alias("n"))
    return top_k_then(counts, "n", ["source"], 8, 42)
