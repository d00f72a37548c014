"""Tables that queries derive from the synthetic ones, and the same in SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from parkwright.functions.text import align_words, error_text, words_on_space
from parkwright.operators.errors import SHIFTS
from parkwright.plans.registry import table
from parkwright.sources.shared import spread


def pairs(spark: SparkSession, sf_dir: str, drop_every: int = 7) -> DataFrame:
    """(dataset, source_dataset, row_idx, reference, prediction): lower-cased messages, and the same without every n-th word."""
    words = F.array_remove(F.split(F.lower("text"), r"\s+"), "")
    own = spread(table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")).select("conv_id", "turn", "role", words.alias("ws"))
    return own.select(
        F.lit("conversations:test").alias("dataset"), F.col("role").alias("source_dataset"), (F.col("conv_id") * 1000 + F.col("turn")).alias("row_idx"),
        F.array_join("ws", " ").alias("reference"), F.array_join(F.filter("ws", lambda w, i: i % drop_every != 3), " ").alias("prediction"),
    )


def pairs_sql(drop_every: int = 7, name: str = "p") -> str:
    """CTEs for ``pairs``. Leaving words out costs as many edits as are left out, so SQL needs no edit distance."""
    clean = "list_filter(list_transform({}, lambda x: regexp_replace(x, '\\p{{P}}', '', 'g')), lambda x: x <> '')"
    return f"""{name}_w AS (SELECT conv_id, turn, role, list_filter(string_split_regex(lower(text), '\\s+'), lambda x: x <> '') AS r FROM conversations),
{name}_h AS (SELECT *, list_filter(r, lambda x, i: (i - 1) % {drop_every} <> 3) AS h FROM {name}_w),
{name}_c AS (SELECT *, {clean.format('r')} AS rc, {clean.format('h')} AS hc FROM {name}_h),
{name} AS (SELECT 'conversations:test' AS dataset, role AS source_dataset, conv_id * 1000 + turn AS row_idx,
  coalesce(array_to_string(r, ' '), '') AS reference, coalesce(array_to_string(h, ' '), '') AS prediction,
  CAST(len(r) AS BIGINT) AS n_words, CAST(len(r) - len(h) AS BIGINT) AS word_edits,
  CAST(length(array_to_string(r, ' ')) AS BIGINT) AS n_chars, CAST(length(array_to_string(r, ' ')) - coalesce(length(array_to_string(h, ' ')), 0) AS BIGINT) AS char_edits,
  CAST(len(rc) AS BIGINT) AS n_words_n, CAST(len(rc) - len(hc) AS BIGINT) AS word_edits_n,
  CAST(coalesce(length(array_to_string(rc, '')), 0) AS BIGINT) AS n_chars_n, CAST(coalesce(length(array_to_string(rc, '')), 0) - coalesce(length(array_to_string(hc, '')), 0) AS BIGINT) AS char_edits_n FROM {name}_c)"""


def heard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(source_dataset, row_idx, reference, prediction): messages in ASCII without tildes, and the same with words put in and words changed, each marked by one."""
    words = F.array_remove(F.split(F.lower(F.regexp_replace("text", r"[^ -}\s]", "x")), r"\s+"), "")
    own = spread(table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")).select("conv_id", "turn", "role", words.alias("ws"))
    changed = F.flatten(F.transform("ws", lambda w, i: F.when(i % 11 == 0, F.array(w, F.lit("~~"))).when(i % 5 == 2, F.array(F.concat(F.lit("~"), F.reverse(w)))).otherwise(F.array(w))))
    return own.select(F.col("role").alias("source_dataset"), (F.col("conv_id") * 1000 + F.col("turn")).alias("row_idx"), F.array_join("ws", " ").alias("reference"), F.array_join(changed, " ").alias("prediction"))


#: Words that the reference lacks cost one edit each, and nothing is left out, so word edits are counted; characters are ASCII, as this edit distance asks.
HEARD = """hw AS (SELECT conv_id, turn, role, list_filter(string_split_regex(lower(regexp_replace(text, '[^ -}\\s]', 'x', 'g')), '\\s+'), lambda x: x <> '') AS r FROM conversations),
hh AS (SELECT *, flatten(list_transform(r, lambda x, i: CASE WHEN (i - 1) % 11 = 0 THEN [x, '~~'] WHEN (i - 1) % 5 = 2 THEN ['~' || reverse(x)] ELSE [x] END)) AS h FROM hw),
heard AS (SELECT role AS source_dataset, CAST(len(r) AS BIGINT) AS n_words, CAST(len(list_filter(h, lambda x: contains(x, '~'))) AS BIGINT) AS word_edits, CAST(length(array_to_string(r, ' ')) AS BIGINT) AS n_chars,
  CAST(levenshtein(coalesce(array_to_string(r, ' '), ''), coalesce(array_to_string(h, ' '), '')) AS BIGINT) AS char_edits FROM hh)"""


def misheard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(id, reference, prediction): messages as error analysis takes them, and the same with words put in, changed and left out, so that alignments have a choice."""
    words = words_on_space(error_text(F.coalesce("text", F.lit(""))))
    rows = spread(table(spark, sf_dir, "conversations").select("conv_id", "turn", "text")).select((F.col("conv_id") * 1000 + F.col("turn")).alias("id"), words.alias("ws"))
    near = lambda w, i: F.when(i % 11 == 0, F.array(w, w)).when(i % 5 == 2, F.array(F.lit("na"))).when(i % 7 == 3, F.array().cast("array<string>")).otherwise(F.array(w))
    return rows.select("id", F.array_join("ws", " ").alias("reference"), F.array_join(F.flatten(F.transform("ws", near)), " ").alias("prediction"))


def chunks_sql(source: str) -> str:
    """Recursive CTEs up to chunks (id, kind, ref_phrase, hyp_phrase, words) of the word lists in ``source`` (id, r, h): the whole table of edit distances of each pair, row by row, walked back from its end; runs of equal steps."""
    row = "list_reduce(list_transform(range(1, len(h) + 1), lambda j: [j]), lambda cur, jj: list_append(cur, least(above[jj[1] + 1] + 1, cur[-1] + 1, above[jj[1]] + (CASE WHEN w = h[jj[1]] THEN 0 ELSE 1 END))), [i + 1])"
    kind = "CASE WHEN s.i > 0 AND s.j > 0 AND r[s.i] = h[s.j] THEN 'e' WHEN s.i > 0 AND s.j > 0 AND d[s.i + 1][s.j + 1] = d[s.i][s.j] + 1 THEN 's' WHEN s.i > 0 AND d[s.i + 1][s.j + 1] = d[s.i][s.j + 1] + 1 THEN 'd' ELSE 'i' END"
    return f"""al_p AS (SELECT * FROM {source} WHERE len(r) > 0),
al_r AS (SELECT id, 0::BIGINT AS i, range(0, len(h) + 1) AS d FROM al_p UNION ALL SELECT id, i + 1, {row} FROM (SELECT t.id, t.i, t.d AS above, h, r[t.i + 1] AS w FROM al_r t JOIN al_p USING (id) WHERE t.i < len(r))),
al_d AS (SELECT id, list(d ORDER BY i) AS d FROM al_r GROUP BY id),
al_t AS (SELECT id, list_reduce(list_transform(range(len(r) + len(h)), lambda z: {{'i': z, 'j': z, 'ops': ''}}), lambda s, z: CASE WHEN s.i = 0 AND s.j = 0 THEN s ELSE {{'i': s.i - CASE WHEN ({kind}) = 'i' THEN 0 ELSE 1 END, 'j': s.j - CASE WHEN ({kind}) = 'd' THEN 0 ELSE 1 END, 'ops': ({kind}) || s.ops}} END, {{'i': len(r), 'j': len(h), 'ops': ''}}).ops AS ops FROM al_p JOIN al_d USING (id)),
al_s AS (SELECT id, unnest(string_split(ops, '')) AS k, unnest(range(length(ops))) AS step FROM al_t),
al_c AS (SELECT *, CAST(sum(CASE WHEN k <> 'i' THEN 1 ELSE 0 END) OVER w AS BIGINT) AS ri, CAST(sum(CASE WHEN k <> 'd' THEN 1 ELSE 0 END) OVER w AS BIGINT) AS hi, step - row_number() OVER (PARTITION BY id, k ORDER BY step) AS run FROM al_s WINDOW w AS (PARTITION BY id ORDER BY step)),
al_g AS (SELECT id, run, step, CASE k WHEN 's' THEN 'substitute' WHEN 'd' THEN 'delete' ELSE 'insert' END AS kind, CASE WHEN k <> 'i' THEN r[ri] END AS a, CASE WHEN k <> 'd' THEN h[hi] END AS b FROM al_c JOIN al_p USING (id) WHERE k <> 'e'),
chunks AS (SELECT id, kind, coalesce(string_agg(a, ' ' ORDER BY step), '') AS ref_phrase, coalesce(string_agg(b, ' ' ORDER BY step), '') AS hyp_phrase, count(*) AS words FROM al_g GROUP BY id, kind, run)"""


def misheard_sql() -> str:
    """``chunks_sql`` of ``misheard``."""
    return f"""mh_w AS (SELECT conv_id * 1000 + turn AS id, {error_words_sql("coalesce(text, '')")} AS r FROM conversations),
mh AS (SELECT id, r, flatten(list_transform(r, lambda x, i: CASE WHEN (i - 1) % 11 = 0 THEN [x, x] WHEN (i - 1) % 5 = 2 THEN ['na'] WHEN (i - 1) % 7 = 3 THEN [] ELSE [x] END)) AS h FROM mh_w), {chunks_sql("mh")}"""


def stuttered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(id, text): messages, of which some end in their first one to four words again and again."""
    first = F.array_join(F.slice(F.split("text", " "), F.lit(1), (F.col("turn") % 4 + 1).cast("int")), " ")
    text = F.concat("text", F.when(F.col("turn") % 3 == 0, F.repeat(F.concat(F.lit(" "), first), F.lit(5))).otherwise(""))
    return table(spark, sf_dir, "conversations").select((F.col("conv_id") * 1000 + F.col("turn")).alias("id"), text.alias("text"))


STUTTERED = """stuttered AS (SELECT conv_id * 1000 + turn AS id, text || CASE WHEN turn % 3 = 0 THEN repeat(' ' || array_to_string(string_split(text, ' ')[1:(turn % 4 + 1)::INT], ' '), 5) ELSE '' END AS text FROM conversations)"""


def error_words_sql(c: str) -> str:
    """The words of text in SQL as error analysis takes them."""
    return f"list_filter(string_split(trim(regexp_replace(regexp_replace(lower({c}), '[^\\p{{L}}\\p{{M}}\\p{{N}}_\\s]', ' ', 'g'), '\\s+', ' ', 'g')), ' '), lambda x: x <> '')"


def loops_sql(source: str) -> str:
    """CTEs up to loops (id, score) of the texts in ``source`` (id, text): how far the words from each place repeat those 1 to 4 earlier."""
    ends = ", ".join(f"min(CASE WHEN w{g} IS DISTINCT FROM w THEN i END) OVER later AS e{g}" for g in (1, 2, 3, 4))
    groups = ", ".join(f"coalesce(max(CASE WHEN i < n - {3 * g} THEN ((e{g} - i) // {g} + 1) * {g} END), 0)" for g in (2, 3, 4))
    return f"""lw AS (SELECT id, {error_words_sql("text")} AS ws FROM {source}), le AS (SELECT id, len(ws) AS n, unnest(ws) AS w, unnest(range(len(ws))) AS i FROM lw),
lg AS (SELECT *, {", ".join(f"lead(w, {g}) OVER ahead AS w{g}" for g in (1, 2, 3, 4))} FROM le WINDOW ahead AS (PARTITION BY id ORDER BY i)),
lf AS (SELECT *, {ends} FROM lg WINDOW later AS (PARTITION BY id ORDER BY i ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)),
ls AS (SELECT id, greatest(max(e1 - i + 1), {groups}) AS score FROM lf GROUP BY id),
loops AS (SELECT lw.id, CAST(coalesce(ls.score, 0) AS BIGINT) AS score FROM lw LEFT JOIN ls USING (id))"""


def shifted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(reference, prediction): messages in which every ninth word is one side of a known shift."""
    pairs = F.array(*[F.struct(F.lit(a).alias("a"), F.lit(b).alias("b")) for a, b in SHIFTS])
    own = table(spark, sf_dir, "conversations").select(F.split("text", " ").alias("ws"), F.get(pairs, ((F.col("conv_id") + F.col("turn")) % len(SHIFTS)).cast("int")).alias("s"))
    side = lambda c: F.array_join(F.transform("ws", lambda w, i: F.when(i % 9 == 4, F.col(f"s.{c}")).otherwise(w)), " ")
    return own.select(side("a").alias("reference"), side("b").alias("prediction"))


LETTERS = "abcdefghijklmnopqrstuvwxyz"


def spoken(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(clip_id, split, text, duration_s, n_samples, spans) from messages: a second for each aligned word, no spans where alignment fails."""
    words = align_words(F.col("text"))
    own = table(spark, sf_dir, "conversations").select((F.col("conv_id") * 1000 + F.col("turn")).alias("clip_id"), "conv_id", "text", F.size(words).alias("n"))
    split = F.when(F.col("clip_id") % 10 == 0, "test").when(F.col("clip_id") % 10 == 1, "validation").when(F.col("clip_id") % 10 == 2, "other").otherwise("train")
    spans = F.transform(F.sequence(F.lit(0), F.col("n") - 1), lambda i: F.struct(i.cast("double").alias("start"), (i + 1).cast("double").alias("end")))
    return own.select("clip_id", split.alias("split"), F.when(F.col("conv_id") % 13 == 0, " ").otherwise(F.col("text")).alias("text"), F.col("n").cast("double").alias("duration_s"), (F.col("n") * 16000).cast("long").alias("n_samples"), F.when((F.col("clip_id") % 11 != 0) & (F.col("n") > 0), spans).alias("spans"))


ALIGNED = "list_filter(string_split_regex(regexp_replace(lower(text), '[^\\p{L}\\p{M}\\p{N}_\\s'']', ' ', 'g'), '\\s+'), lambda x: x <> '')"
SPOKEN = f"""spoken_w AS (SELECT conv_id * 1000 + turn AS clip_id, conv_id, text, {ALIGNED} AS al, list_filter(string_split_regex(text, '\\s+'), lambda x: x <> '') AS wr FROM conversations),
spoken AS (SELECT clip_id, CASE clip_id % 10 WHEN 0 THEN 'test' WHEN 1 THEN 'validation' WHEN 2 THEN 'other' ELSE 'train' END AS split, CASE WHEN conv_id % 13 = 0 THEN ' ' ELSE text END AS text, len(al) AS n,
  CASE WHEN conv_id % 13 = 0 THEN [] WHEN len(al) = len(wr) THEN wr ELSE al END AS ws, CASE WHEN len(al) <= 30 OR conv_id % 13 = 0 THEN 'passed' WHEN clip_id % 11 = 0 THEN 'failed' ELSE 'chunked' END AS outcome FROM spoken_w),
spoken_k AS (SELECT *, CASE WHEN outcome = 'chunked' THEN CAST(ceil(n / 28) AS BIGINT) ELSE 1 END AS k FROM spoken),
spoken_c AS (SELECT *, unnest(range(k)) AS i FROM spoken_k),
spoken_chunks AS (SELECT clip_id, split, outcome, k, i, CASE WHEN outcome = 'chunked' THEN array_to_string(ws[i * 28 + 1:least((i + 1) * 28, n)], ' ') ELSE text END AS text,
  CASE WHEN outcome = 'chunked' THEN i * 28 * 16000 ELSE 0 END AS start, CASE WHEN outcome = 'chunked' THEN least((i + 1) * 28, n) * 16000 ELSE n * 16000 END AS "end" FROM spoken_c)"""


def frames(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(id, words, path): aligned words of messages and a frame path that spells them, two frames a letter and a blank; some paths are wrong or too short."""
    from parkwright.operators.chunking import token_ranges

    own = table(spark, sf_dir, "conversations").select((F.col("conv_id") * 1000 + F.col("turn")).alias("id"), align_words(F.col("text")).alias("words"))
    own = own.withColumn("labels", token_ranges(F.col("words"), LETTERS)["labels"])
    last = F.size("labels") - 1
    labels = F.when(F.col("id") % 7 == 0, F.transform("labels", lambda x, i: F.when(i == last, x + 1).otherwise(x))).when(F.col("id") % 7 == 1, F.slice("labels", F.lit(1), F.greatest(last, F.lit(0)))).otherwise(F.col("labels"))
    return own.select("id", "words", F.flatten(F.transform(labels, lambda x: F.array(x, x, F.lit(0)))).alias("path"))


FRAMES = f"""frames_w AS (SELECT conv_id * 1000 + turn AS id, list_transform({ALIGNED}, lambda w: CAST(length(regexp_replace(w, '[^{LETTERS}]', '', 'g')) AS BIGINT)) AS ls FROM conversations),
frames AS (SELECT *, CAST(list_sum(ls) + len(ls) - 1 AS BIGINT) AS t, CASE WHEN id % 7 = 0 THEN 'wrong label' WHEN id % 7 = 1 THEN 'wrong number of labels' END AS error FROM frames_w)"""


def clips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(clip_id, source, speaker_id, text, split, duration_s, n_samples) from events."""
    return table(spark, sf_dir, "events").select(
        F.col("event_id").alias("clip_id"), F.col("event_type").alias("source"), F.col("user_id").alias("speaker_id"), F.col("event_type").alias("text"),
        F.when(F.col("event_id") % 10 == 0, "test").when(F.col("event_id") % 10 == 1, "validation").otherwise("train").alias("split"),
        F.col("value").alias("duration_s"), F.floor(F.col("value") * 16000).alias("n_samples"),
    )


CLIPS = """clips AS (SELECT event_id AS clip_id, event_type AS source, user_id AS speaker_id, event_type AS text,
  CASE WHEN event_id % 10 = 0 THEN 'test' WHEN event_id % 10 = 1 THEN 'validation' ELSE 'train' END AS split,
  value AS duration_s, CAST(floor(value * 16000) AS BIGINT) AS n_samples FROM events)"""


def model_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(audio_file, model, prediction, audio_duration_s, decode_wall_s, rtfx): three models over documents, each without some files."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "n_chars", "lang", F.explode(F.array(*[F.lit(m) for m in range(3)])).alias("m"))
    docs = docs.where(F.col("doc_id") % 10 != F.col("m"))
    wall = (F.col("n_chars") % 7 + F.col("m")).cast("double")
    seconds = F.col("n_chars").cast("double") / 17
    return docs.select(
        F.concat(F.lit("clip_"), F.col("doc_id"), F.lit(".wav")).alias("audio_file"), F.element_at(F.array(F.lit("model_a"), F.lit("model_b"), F.lit("model_c")), F.col("m") + 1).alias("model"),
        F.concat("lang", F.lit("-"), "m").alias("prediction"), seconds.alias("audio_duration_s"), wall.alias("decode_wall_s"), F.when(wall > 0, F.round(seconds / wall, 3)).alias("rtfx"),
    )


MODEL_ROWS = """model_rows AS (SELECT 'clip_' || doc_id || '.wav' AS audio_file, ['model_a', 'model_b', 'model_c'][m + 1] AS model, lang || '-' || m AS prediction,
  n_chars / 17.0::DOUBLE AS audio_duration_s, CAST(n_chars % 7 + m AS DOUBLE) AS decode_wall_s,
  CASE WHEN n_chars % 7 + m > 0 THEN round((n_chars / 17.0::DOUBLE) / (n_chars % 7 + m), 3) END AS rtfx
  FROM documents, (SELECT unnest([0, 1, 2]) AS m) WHERE doc_id % 10 <> m)"""

#: Replies of every kind, with their category: edge rows that the synthetic tables don't have.
REPLIES = (
    (1, "thanks", "Asante sana kwa swali lako"), (2, "weather", "Angalia mvua kwanza, kisha panda mahindi kwa mbolea ya kutosha."),
    (3, "greeting", "Habari! Karibu sana"), (4, "problem_help", ""), (5, "problem_help", "12, 13. 14"), (6, "how_to", "Transcribe the following speech segment"),
    (7, "planning", "Ninafurahi kusaidia."), (8, "followup", "naweza kukusaidia"), (9, "unknown", "The weather is fine today and nothing else is worth saying here"),
    (10, "greeting", "Habari yako? Naweza kusaidia!"), (11, "how_to", "1) Weka mbolea na maji kwenye shamba la ndizi."), (12, "thanks", "Karibu tena, kazi njema kwa wote"),
)


def replies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(id, category, response, attempt): the edge rows, and all messages with their role as category."""
    edge = spark.createDataFrame(REPLIES, "id long, category string, response string")
    messages = spread(table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")).select((F.col("conv_id") * 1000 + F.col("turn") + 100).alias("id"), F.col("role").alias("category"), F.col("text").alias("response"))
    return edge.unionByName(messages).withColumn("attempt", F.lit(0))


REPLIES_SQL = "replies AS (SELECT * FROM (VALUES " + ", ".join(f"({i}::BIGINT, '{c}', '{r}')" for i, c, r in REPLIES) + ") AS v(id, category, response) UNION ALL SELECT conv_id * 1000 + turn + 100, role, text FROM conversations)"
