"""Queries of joins, windows, orders and sets."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from parkwright.operators import audit, gates, merging, ranking, scoring
from parkwright.plans import fixtures as X
from parkwright.plans.columns import SCORED_SQL
from parkwright.plans.registry import query, table


@query(f"WITH {X.pairs_sql()} SELECT row_idx, word_edits, CASE WHEN row_idx % 4 <> 0 THEN source_dataset END AS source_dataset FROM p")
def jn_zip(spark, d):
    """Rows beside their meta by position; missing meta reads null."""
    rows = scoring.scored(X.pairs(spark, d))
    meta = rows.where("row_idx % 4 <> 0").select("row_idx", "source_dataset")
    return merging.zipped(rows.select("row_idx", "word_edits"), meta, how="left")


def _runs(spark, d):
    run = lambda n: scoring.grouped(scoring.scored(X.pairs(spark, d, n)), [[], ["source_dataset"]]).withColumnRenamed("source_dataset", "group")
    return run(13), run(7)


_RUNS = f"""WITH {X.pairs_sql(7, 'b')}, {X.pairs_sql(13, 't')}, bg AS (SELECT source_dataset g, sum(word_edits) / sum(n_words) w FROM b GROUP BY 1 UNION ALL SELECT 'pooled', sum(word_edits) / sum(n_words) FROM b),
tg AS (SELECT source_dataset g, sum(word_edits) / sum(n_words) w FROM t GROUP BY 1 UNION ALL SELECT 'pooled', sum(word_edits) / sum(n_words) FROM t)"""


@query(f"""{_RUNS} SELECT tg.g AS "group", bg.w AS base_wer, tg.w AS tuned_wer FROM tg LEFT JOIN bg ON tg.g = bg.g""")
def jn_lookup(spark, d):
    tuned, base = _runs(spark, d)
    return merging.beside(tuned, base).select("group", "base_wer", "tuned_wer")


@query(f"""WITH {X.MODEL_ROWS} SELECT coalesce(a.audio_file, b.audio_file) AS audio_file, coalesce(b.prediction, a.prediction) AS prediction, coalesce(a.rtfx, b.rtfx) AS rtfx, coalesce(a.audio_duration_s, b.audio_duration_s) AS audio_duration_s
FROM (SELECT * FROM model_rows WHERE model = 'model_a') a FULL OUTER JOIN (SELECT * FROM model_rows WHERE model = 'model_b') b ON a.audio_file = b.audio_file""")
def jn_outer(spark, d):
    rows = X.model_rows(spark, d)
    return merging.merged(rows.where("model = 'model_a'"), rows.where("model = 'model_b'"), "audio_file")


@query(f"{_RUNS} SELECT tg.w - bg.w <= 0.02 AS ok, tg.w - bg.w AS delta FROM tg, bg WHERE tg.g = 'pooled' AND bg.g = 'pooled'")
def jn_scalar(spark, d):
    tuned, base = _runs(spark, d)
    mode = lambda df: df.withColumn("normalize", F.lit("none"))
    return gates.retention(mode(tuned), mode(base)).select("ok", "delta")


@query("SELECT e.event_id FROM events e WHERE e.event_type IN ('click', 'view') OR e.user_id IN (SELECT user_id FROM events WHERE value > 489)")
def jn_semi(spark, d):
    """Membership in a literal list, and in a set of another table."""
    events = table(spark, d, "events")
    users = events.where("value > 489").select("user_id").distinct().withColumn("hit", F.lit(True))
    return events.join(users, "user_id", "left").where(F.col("event_type").isin("click", "view") | F.col("hit")).select("event_id")


@query("""WITH m AS (SELECT event_id AS line FROM events WHERE event_id % 9 = 0), p AS (SELECT event_id AS line FROM events WHERE event_id % 4 = 0),
n AS (SELECT p.line, max(m.line) AS near FROM p LEFT JOIN m ON m.line <= p.line AND m.line >= p.line - 5 GROUP BY p.line)
SELECT line, CASE WHEN row_number() OVER (PARTITION BY near ORDER BY line) = 1 THEN near END AS matched FROM n""")
def jn_asof(spark, d):
    """The nearest hit before each line, within 5 lines, each used once."""
    lines = table(spark, d, "events").select(F.lit("log").alias("file"), F.col("event_id").alias("line"))
    return merging.as_of(lines.where("line % 4 = 0"), lines.where("line % 9 = 0"), "file", "line", 5).select("line", "matched")


@query("SELECT conv_id, turn, 'conversations' AS repo, role AS split FROM conversations")
def jn_sub(spark, d):
    key = F.concat(F.lit("conversations:"), "role")
    return table(spark, d, "conversations").select("conv_id", "turn", F.split_part(key, F.lit(":"), F.lit(1)).alias("repo"), F.split_part(key, F.lit(":"), F.lit(2)).alias("split"))


@query("SELECT source, doc_id, row_number() OVER (PARTITION BY source ORDER BY doc_id) - 1 AS clip_id FROM documents")
def win_id(spark, d):
    return ranking.grouped_rank(table(spark, d, "documents").select("source", "doc_id"), ["source"], ["doc_id"], "clip_id")


@query("""WITH f AS (SELECT user_id, event_id, ts, CASE WHEN lag(event_type) OVER w IS DISTINCT FROM event_type THEN 1 ELSE 0 END AS s FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)),
g AS (SELECT user_id, event_id, sum(s) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS run FROM f)
SELECT user_id, min(event_id) AS event_id, count(*) AS n FROM g GROUP BY user_id, run""")
def win_runs(spark, d):
    """Runs of equal events of each user."""
    return ranking.run_lengths(table(spark, d, "events"), ["user_id"], ["ts", "event_id"], "event_type", "event_id")


def _attempts(spark, d):
    return X.replies(spark, d).withColumn("attempt", (F.col("id") % 3).cast("int")).withColumn("id", F.floor(F.col("id") / 3))


_ATTEMPTS = f"""{SCORED_SQL}, tries AS (SELECT id // 3 AS id, CAST(id % 3 AS INTEGER) AS attempt, response, len(failed) = 0 AS passed,
CASE WHEN trim(response, ' ' || chr(10)) = '' THEN -1 ELSE (CASE WHEN len(failed) = 0 THEN 100 ELSE greatest(0, 100 - 15 * len(failed)) END) + least(length(regexp_replace(response, '^\\s+|\\s+$', '', 'g')), 120) // 10 END AS score FROM scored)"""


@query(f"{_ATTEMPTS} SELECT id, attempt, CAST(score AS BIGINT) AS score FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY score DESC, attempt) AS n FROM tries) WHERE n = 1")
def win_best(spark, d):
    return gates.best_attempt(_attempts(spark, d), "id").select("id", "attempt", F.col("score").cast("long").alias("score"))


@query(f"{_ATTEMPTS} SELECT id, attempt, passed FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY CASE WHEN passed THEN attempt ELSE 1000 END, score DESC, attempt) AS n FROM tries) WHERE n = 1")
def gate_retry(spark, d):
    """Of up to three attempts the first that passes, else the best."""
    return gates.best_attempt(_attempts(spark, d), "id", stop_at_pass=True).select("id", "attempt", "passed")


@query("SELECT source, doc_id, n_chars FROM (SELECT *, row_number() OVER (PARTITION BY source ORDER BY n_chars DESC, length(lang), doc_id) AS n FROM documents WHERE n_chars >= 3) WHERE n = 1")
def win_rank(spark, d):
    """The highest score of each group, at least 3; the shorter name of equals."""
    rows = table(spark, d, "documents").where("n_chars >= 3").select("source", "doc_id", "n_chars", "lang")
    return merging.first_by(rows, "source", [F.desc("n_chars"), F.length("lang"), "doc_id"]).select("source", "doc_id", "n_chars")


@query(f"""{_RUNS} SELECT g AS "group", CAST(row_number() OVER (ORDER BY CASE WHEN g = 'pooled' THEN 0 ELSE 1 END, g) AS INTEGER) AS place FROM tg""")
def ord_group(spark, d):
    tuned, _ = _runs(spark, d)
    return tuned.select("group", F.row_number().over(Window.orderBy(*merging.group_order())).alias("place"))


def _pivot(c, m):
    return f"max({c}) FILTER (model = 'model_{m}') AS {c}_model_{m}"


@query(f"WITH {X.MODEL_ROWS} SELECT audio_file, max(audio_duration_s) AS audio_duration_s, " + ", ".join(_pivot(c, m) for c in ("prediction", "rtfx") for m in "abc") + " FROM model_rows GROUP BY audio_file")
def ord_cols(spark, d):
    """One row a file, columns in order: meta, predictions, speeds."""
    return merging.wide(X.model_rows(spark, d), "audio_file", ["model_c", "model_a", "model_b"])


@query("SELECT word, n FROM (SELECT unnest(list_filter(string_split_regex(lower(text), '\\s+'), lambda x: x <> '')) AS word, 1 AS one FROM conversations) GROUP BY word, one HAVING true QUALIFY row_number() OVER (ORDER BY count(*) DESC, word) <= 25".replace("word, n FROM", "word, count(*) AS n FROM"))
def topk(spark, d):
    words = table(spark, d, "conversations").select(F.explode(F.array_remove(F.split(F.lower("text"), r"\s+"), "")).alias("word"))
    return words.groupBy("word").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "word").limit(25)


@query("SELECT doc_id, lang FROM documents ORDER BY doc_id LIMIT 64")
def lim_head(spark, d):
    return table(spark, d, "documents").orderBy("doc_id").limit(64).select("doc_id", "lang")


@query("SELECT 'a' AS source_dataset, doc_id AS id, lang AS tag FROM documents UNION ALL SELECT 'b', item_id, NULL FROM benchmark")
def set_concat(spark, d):
    parts = {"a": table(spark, d, "documents").select(F.col("doc_id").alias("id"), F.col("lang").alias("tag")), "b": table(spark, d, "benchmark").select(F.col("item_id").alias("id"))}
    return merging.concatenated(parts).select("source_dataset", "id", "tag")


@query(f"WITH {X.CLIPS} SELECT DISTINCT split FROM clips UNION SELECT DISTINCT lang FROM documents")
def set_splits(spark, d):
    return X.clips(spark, d).select("split").union(table(spark, d, "documents").select("lang")).distinct()


@query(f"""WITH {X.CLIPS}, a AS (SELECT DISTINCT speaker_id FROM clips WHERE split = 'test'), b AS (SELECT DISTINCT speaker_id FROM clips WHERE split <> 'test')
SELECT (SELECT count(*) FROM a) AS left_n, (SELECT count(*) FROM b) AS right_n, (SELECT count(*) FROM a JOIN b USING (speaker_id)) AS shared_n, (SELECT count(*) FROM a JOIN b USING (speaker_id)) > 0 AS leaks""")
def set_inter(spark, d):
    """Speakers that the test split shares with the others."""
    clips = X.clips(spark, d)
    return audit.overlap(clips.where("split = 'test'"), clips.where("split <> 'test'"), "speaker_id")


@query("SELECT lower(text) AS k, min(doc_id) AS doc_id FROM documents GROUP BY 1")
def set_dedup(spark, d):
    """The first row of each text, found by digests."""
    return merging.distinct_texts(table(spark, d, "documents").select("doc_id", F.lower("text").alias("k")), "k", "doc_id").select("k", "doc_id")


@query("""WITH a AS (SELECT doc_id AS id, 'domain' AS kind, 0 AS pick, row_number() OVER (ORDER BY doc_id) AS k FROM documents), b AS (SELECT item_id AS id, 'retention' AS kind, 1 AS pick, row_number() OVER (ORDER BY item_id) AS k FROM benchmark),
m AS (SELECT * FROM a UNION ALL SELECT * FROM b), s AS (SELECT slot, CASE WHEN ('0x' || md5('42:' || slot)[1:8])::BIGINT < CAST(floor(0.05::DOUBLE * 4294967296) AS BIGINT) THEN 1 ELSE 0 END AS pick FROM (SELECT unnest(range((SELECT count(*) FROM m))) AS slot)),
x AS (SELECT slot, pick, row_number() OVER (PARTITION BY pick ORDER BY slot) AS k FROM s), e AS (SELECT min(slot) AS last FROM x WHERE (pick = 0 AND k = (SELECT count(*) FROM a)) OR (pick = 1 AND k = (SELECT count(*) FROM b)))
SELECT slot, id, kind FROM x JOIN m USING (pick, k) WHERE slot <= (SELECT last FROM e)""")
def smp_mix(spark, d):
    """Replay mixing by a draw that any engine can repeat."""
    a = table(spark, d, "documents").select(F.col("doc_id").alias("id"), F.lit("domain").alias("kind"))
    b = table(spark, d, "benchmark").select(F.col("item_id").alias("id"), F.lit("retention").alias("kind"))
    return merging.replayed(a, b, ["id"], 0.05).select("slot", "id", "kind")
