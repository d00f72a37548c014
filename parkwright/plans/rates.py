"""Queries of aggregations and gates."""

from __future__ import annotations

from pyspark.sql import functions as F

from parkwright.functions import text as T
from parkwright.operators import audit, errors, gates, merging, scoring
from parkwright.plans import fixtures as X
from parkwright.plans.columns import SCORED_SQL
from parkwright.plans.registry import query, table

SUMS = 'count(*) AS n_scored{s}, CAST(sum(word_edits{s}) AS BIGINT) AS word_edits{s}, CAST(sum(n_words{s}) AS BIGINT) AS n_words{s}, CAST(sum(char_edits{s}) AS BIGINT) AS char_edits{s}, CAST(sum(n_chars{s}) AS BIGINT) AS n_chars{s}, sum(word_edits{s}) / sum(n_words{s}) AS wer{s}, sum(char_edits{s}) / sum(n_chars{s}) AS cer{s}'
RAW, NORMAL = "count(*) AS n, " + SUMS.format(s=""), SUMS.format(s="_n")


@query(f"WITH {X.pairs_sql()} SELECT {RAW} FROM p")
def agg_wer(spark, d):
    return scoring.grouped(scoring.scored(X.pairs(spark, d)), [])


#: The textbook edit distance over words as nested list folds, for pairs that don't only leave words out.
DP = """CAST(list_last(list_reduce(list_transform(range(1, len(r) + 1), lambda i: [i]), lambda prev, ii: list_reduce(list_transform(range(1, len(h) + 1), lambda j: [j]),
lambda cur, jj: list_append(cur, least(prev[jj[1] + 1] + 1, cur[jj[1]] + 1, prev[jj[1]] + (CASE WHEN r[ii[1]] = h[jj[1]] THEN 0 ELSE 1 END))), [ii[1]]), range(0, len(h) + 1))) AS BIGINT)"""


@query(f"""WITH w AS (SELECT item_id, list_filter(string_split_regex(lower(text), '\\s+'), lambda x: x <> '') AS r FROM benchmark),
p AS (SELECT item_id, r, flatten(list_transform(r, lambda x, i: CASE WHEN i % 11 = 1 THEN [x, x] WHEN i % 5 = 3 THEN [reverse(x)] WHEN i % 7 = 4 THEN [] ELSE [x] END)) AS h FROM w)
SELECT item_id, CAST(len(r) AS BIGINT) AS n_words, {DP} AS word_edits FROM p""")
def agg_wer_edits(spark, d):
    """Edits of pairs with insertions, substitutions and deletions."""
    words = F.array_remove(F.split(F.lower("text"), r"\s+"), "")
    heard = F.flatten(F.transform("r", lambda w, i: F.when(i % 11 == 0, F.array(w, w)).when(i % 5 == 2, F.array(F.reverse(w))).when(i % 7 == 3, F.array().cast("array<string>")).otherwise(F.array(w))))
    rows = table(spark, d, "benchmark").select("item_id", words.alias("r")).withColumn("h", heard)
    return rows.select("item_id", F.size("r").cast("long").alias("n_words"), T.word_edits(F.col("r"), F.col("h")).alias("word_edits"))


@query(f"WITH {X.pairs_sql()} SELECT count(*) AS n_scored, sum(word_edits_n) / sum(n_words_n) AS wer FROM p")
def agg_wer2(spark, d):
    """The variant that fails when nothing can be scored."""
    return scoring.require_scored(scoring.grouped(scoring.scored(X.pairs(spark, d), "jiwer_default"), [])).select("n_scored", "wer")


@query(f"WITH {X.pairs_sql()} SELECT row_idx, CASE WHEN row_idx % 3 = 0 THEN 0 ELSE word_edits / n_words END AS wer, CASE WHEN row_idx % 3 = 0 THEN 0 ELSE char_edits / n_chars END AS cer FROM p")
def agg_utt(spark, d):
    """Each row's own rates; 0 without a reference."""
    rows = X.pairs(spark, d).withColumn("reference", F.when(F.col("row_idx") % 3 != 0, F.col("reference")))
    return scoring.row_rates(scoring.scored(rows)).select("row_idx", "wer", "cer")


_NORM = "coalesce(array_to_string({}, ' '), '')"


@query(f"WITH {X.pairs_sql()} SELECT conv_id * 1000 + turn AS row_idx, {_NORM.format('rc')} AS text_normalized, {_NORM.format('hc')} AS prediction_normalized FROM p_c")
def agg_extra(spark, d):
    """The normalised texts of each row."""
    return X.pairs(spark, d).select("row_idx", F.array_join(T.plain_words(F.col("reference")), " ").alias("text_normalized"), F.array_join(T.plain_words(F.col("prediction")), " ").alias("prediction_normalized"))


@query(f"WITH {X.pairs_sql()} SELECT coalesce(source_dataset, 'pooled') AS source_dataset, {RAW} FROM p GROUP BY GROUPING SETS ((), (source_dataset))")
def agg_group(spark, d):
    """Pooled and by group in one pass: the flagship query."""
    return scoring.grouped(scoring.scored(X.pairs(spark, d)), [[], ["source_dataset"]])


@query(f"WITH {X.pairs_sql()} SELECT coalesce(dataset, 'pooled') AS dataset, coalesce(source_dataset, 'pooled') AS source_dataset, {RAW}, {NORMAL} FROM p GROUP BY GROUPING SETS ((), (dataset), (dataset, source_dataset))")
def agg_sets(spark, d):
    """Raw and normalised rates of all sets together, of each set and of its groups, in one pass."""
    rows = scoring.scored(scoring.scored(X.pairs(spark, d)), "jiwer_default", "_n")
    return scoring.grouped(rows, [[], ["dataset"], ["dataset", "source_dataset"]], ("", "_n"))


@query(f"WITH {X.HEARD} SELECT coalesce(source_dataset, 'pooled') AS source_dataset, {RAW} FROM heard GROUP BY GROUPING SETS ((), (source_dataset))")
def agg_heard(spark, d):
    """Rates of pairs with insertions and substitutions, in words and characters."""
    return scoring.grouped(scoring.scored(X.heard(spark, d)), [[], ["source_dataset"]])


@query(f"WITH {X.pairs_sql()} SELECT {RAW} FROM p")
def agg_simple(spark, d):
    """Mode simple: case and white space don't count."""
    odd = F.concat(F.lit(" "), F.translate(F.regexp_replace("reference", " ", " \n "), "abc", "ABC"), F.lit("\t"))
    return scoring.grouped(scoring.scored(X.pairs(spark, d).withColumn("reference", odd), "simple"), [])


@query(f"WITH {X.CLIPS} SELECT round(avg(duration_s), 6) AS mean, round(quantile_cont(duration_s, 0.5), 6) AS median FROM clips")
def agg_mean(spark, d):
    return errors.middle(X.clips(spark, d), "duration_s").select(F.round("mean", 6).alias("mean"), F.round("median", 6).alias("median"))


@query(f"WITH {X.CLIPS} SELECT v AS p90 FROM (SELECT duration_s AS v, row_number() OVER (ORDER BY duration_s) - 1 AS i, count(*) OVER () AS n FROM clips) WHERE i = n * 9 // 10")
def agg_p90(spark, d):
    return errors.nearest_rank(X.clips(spark, d), "duration_s")


_ROWS = f"WITH {X.pairs_sql()}, s AS (SELECT *, CASE WHEN row_idx % 13 = 0 THEN 1.5::DOUBLE ELSE word_edits / n_words * (1 + row_idx % 7) END AS wer, n_words * 0.5::DOUBLE AS seconds FROM p)"


def spread_rates(spark, d):
    """Pairs with rates that fall into all bands, and seconds."""
    rows = scoring.row_rates(scoring.scored(X.pairs(spark, d)))
    return rows.withColumn("wer", F.when(F.col("row_idx") % 13 == 0, 1.5).otherwise(F.col("wer") * (1 + F.col("row_idx") % 7))).withColumn("seconds", F.col("n_words") * 0.5)


@query(f"""{_ROWS}, b AS (SELECT * FROM (VALUES (0, 'good', 0.0, 0.2), (1, 'moderate', 0.2, 0.4), (2, 'fair', 0.4, 0.6), (3, 'poor', 0.6, 0.8), (4, 'bad', 0.8, 1.01), (5, 'catastrophic', 1.01, 99.0)) AS v(place, band, lo, hi))
SELECT place, band, count(wer) AS n, round(100.0 * count(wer) / (SELECT count(*) FROM s), 6) AS pct FROM b LEFT JOIN s ON wer >= lo::DOUBLE AND wer < hi::DOUBLE GROUP BY place, band""")
def agg_bucket(spark, d):
    return errors.bands(spread_rates(spark, d), "wer").withColumn("pct", F.round("pct", 6))


@query(f"WITH {X.STUTTERED}, {X.loops_sql('stuttered')} SELECT count(*) FILTER (score >= 6) AS looping, 100.0 * count(*) FILTER (score >= 6) / count(*) AS pct FROM loops")
def agg_loop(spark, d):
    return errors.looping(X.stuttered(spark, d), "text")


_SHIFTS = ", ".join(f"('{a}', '{b}')" for a, b in errors.SHIFTS)
_SHIFT_LISTS = "[" + ", ".join(f"'{a}'" for a, _ in errors.SHIFTS) + "]", "[" + ", ".join(f"'{b}'" for _, b in errors.SHIFTS) + "]"


@query(f"""WITH t AS (SELECT string_split(text, ' ') AS ws, {_SHIFT_LISTS[0]}[((conv_id + turn) % {len(errors.SHIFTS)} + 1)::INT] AS a, {_SHIFT_LISTS[1]}[((conv_id + turn) % {len(errors.SHIFTS)} + 1)::INT] AS b FROM conversations),
s AS (SELECT array_to_string(list_transform(ws, lambda w, i: CASE WHEN (i - 1) % 9 = 4 THEN a ELSE w END), ' ') AS r, array_to_string(list_transform(ws, lambda w, i: CASE WHEN (i - 1) % 9 = 4 THEN b ELSE w END), ' ') AS h FROM t),
e AS (SELECT array_to_string({X.error_words_sql("r")}, ' ') AS r, array_to_string({X.error_words_sql("h")}, ' ') AS h FROM s)
SELECT x || '->' || y AS shift, CAST(sum(len(regexp_extract_all(r, x))) AS BIGINT) AS n FROM e, (VALUES {_SHIFTS}) AS v(x, y) WHERE regexp_matches(r, x) AND regexp_matches(h, y) GROUP BY 1 ORDER BY n DESC, shift LIMIT 12""")
def agg_lex(spark, d):
    return errors.shifts(X.shifted(spark, d))


@query(f"WITH {X.pairs_sql()}, e AS (SELECT CAST(sum(word_edits) AS BIGINT) AS n FROM p) SELECT 'words' AS what, n FROM e")
def agg_ops(spark, d):
    """Words in all edit chunks of the alignments, which must add up to the edits; the pairs leave words out only."""
    pairs = X.pairs(spark, d).select(*[F.regexp_replace(c, r"(?U)[^\w\s]", "x").alias(c) for c in ("reference", "prediction")])
    return errors.edit_chunks(pairs).agg(F.sum("words").alias("n")).select(F.lit("words").alias("what"), "n")


@query(f"WITH RECURSIVE {X.misheard_sql()} SELECT kind, ref_phrase, hyp_phrase, count(*) AS n, CAST(sum(words) AS BIGINT) AS words FROM chunks GROUP BY ALL")
def agg_ops_chunks(spark, d):
    """Every edit chunk of the canonical alignments with its phrases, how often it occurs and how many words that is."""
    return errors.edit_chunks(X.misheard(spark, d)).groupBy("kind", "ref_phrase", "hyp_phrase").agg(F.count(F.lit(1)).alias("n"), F.sum("words").alias("words"))


_TOP = "SELECT * FROM (SELECT kind, ref_phrase, hyp_phrase, count(*) AS n FROM chunks WHERE kind = '{kind}' GROUP BY ALL ORDER BY n DESC, ref_phrase, hyp_phrase LIMIT {k}) WHERE n >= {least}"
_TOPS = {"substitute": (25, 2), "insert": (20, 3), "delete": (20, 2)}


@query(f"WITH RECURSIVE {X.misheard_sql()} " + " UNION ALL ".join(f"({_TOP.format(kind=kind, k=k, least=least)})" for kind, (k, least) in _TOPS.items()))
def agg_ops_top(spark, d):
    """The most frequent edit chunks of each kind: the k largest, and of those the ones that occur often enough."""
    return errors.frequent_edits(X.misheard(spark, d), _TOPS)


@query(f"{_ROWS} SELECT CASE WHEN seconds < 30 THEN '<30' WHEN seconds < 60 THEN '30-60' ELSE '>=60' END AS band, count(*) AS n, round(avg(wer), 6) AS mean_wer FROM s GROUP BY 1")
def agg_durwer(spark, d):
    return errors.by_duration(spread_rates(spark, d), "seconds", "wer").withColumn("mean_wer", F.round("mean_wer", 6))


@query(f"""WITH {X.CLIPS} SELECT count(duration_s) AS "count", round(avg(duration_s), 4) AS mean, round(stddev_samp(duration_s), 4) AS std, min(duration_s) AS min, round(quantile_cont(duration_s, 0.5), 4) AS p50,
round(quantile_cont(duration_s, 0.9), 4) AS p90, round(quantile_cont(duration_s, 0.95), 4) AS p95, round(quantile_cont(duration_s, 0.99), 4) AS p99, max(duration_s) AS max FROM clips""")
def agg_desc(spark, d):
    out = audit.describe(X.clips(spark, d), "duration_s")
    return out.select("count", *[F.round(c, 4).alias(c) if c not in ("min", "max") else F.col(c) for c in out.columns[1:]])


@query("""WITH e AS (SELECT min(n_chars) AS lo, max(n_chars) AS hi FROM documents), b AS (SELECT least(CAST(floor((n_chars - lo) / ((hi - lo) / 60.0::DOUBLE)) AS INTEGER), 59) AS bin FROM documents, e)
SELECT CAST(g.bin AS INTEGER) AS bin, count(b.bin) AS n FROM (SELECT unnest(range(60)) AS bin) g LEFT JOIN b ON b.bin = g.bin GROUP BY g.bin""")
def agg_hist(spark, d):
    return audit.histogram(table(spark, d, "documents"), "n_chars").select("bin", "n")


@query("""WITH e AS (SELECT min(value) AS lo, max(value) AS hi FROM events), b AS (SELECT least(CAST(floor((value - lo) / ((hi - lo) / 60)) AS INTEGER), 59) AS bin FROM events, e)
SELECT CAST(g.bin AS INTEGER) AS bin, count(b.bin) AS n, g.bin <= (SELECT floor((30 - lo) / ((hi - lo) / 60)) FROM e) AS within_limit FROM (SELECT unnest(range(60)) AS bin) g LEFT JOIN b ON b.bin = g.bin GROUP BY g.bin""")
def snk_png(spark, d):
    """The numbers of the duration plot: bins, and whether a bin starts within 30 s."""
    return audit.histogram(X.clips(spark, d), "duration_s").select("bin", "n", (F.col("low") <= 30.0).alias("within_limit"))


@query(f"WITH {X.CLIPS} SELECT source, max(duration_s) AS longest FROM clips GROUP BY source UNION ALL SELECT 'none', 0.0::DOUBLE")
def agg_max(spark, d):
    """The longest clip of each source; 0 of none."""
    rows = X.clips(spark, d)
    none = rows.where("false").agg(audit.longest(rows, "duration_s").alias("longest")).select(F.lit("none").alias("source"), "longest")
    return rows.groupBy("source").agg(audit.longest(rows, "duration_s").alias("longest")).unionByName(none)


@query(f"""WITH {X.CLIPS} SELECT source, split, count(*) AS "rows", count(*) FILTER (clip_id % 6 = 0) AS empty_text, count(*) FILTER (duration_s > 30) AS over_30s FROM clips GROUP BY source, split""")
def agg_audit(spark, d):
    rows = X.clips(spark, d).withColumn("text", F.when(F.col("clip_id") % 6 != 0, F.col("text")))
    return audit.splits(rows, ["source", "split"], "text", "duration_s")


@query("""SELECT source, count(*) AS "rows", count(DISTINCT text) AS clips, count(*) - count(DISTINCT text) AS extra_rows FROM documents GROUP BY source""")
def agg_src(spark, d):
    return audit.sources(table(spark, d, "documents"), "source", "text")


@query(f"WITH {X.MODEL_ROWS} SELECT model, count(*) AS n, round(avg(decode_wall_s), 3) AS avg_decode_s, round(avg(rtfx), 3) AS avg_rtfx FROM model_rows GROUP BY model")
def agg_avgmodel(spark, d):
    return merging.model_means(X.model_rows(spark, d))


_PASS = "count(*) AS n, count(*) FILTER (len(failed) = 0) AS n_passed, round(avg(CASE WHEN len(failed) = 0 THEN 1.0 ELSE 0.0 END), 4) AS pass_rate, CASE WHEN avg(CASE WHEN len(failed) = 0 THEN 1.0 ELSE 0.0 END) >= {least} THEN 'PASS' ELSE 'FAIL' END AS gate"


@query(f"{SCORED_SQL} SELECT {_PASS.format(least=0.8)} FROM scored")
def agg_pass(spark, d):
    return gates.pass_rate(gates.judged(X.replies(spark, d)), []).withColumn("pass_rate", F.round("pass_rate", 4))


@query(f"{SCORED_SQL} SELECT category, {_PASS.format(least=0.8)}, CAST(row_number() OVER (ORDER BY min(id), category) AS INTEGER) AS place FROM scored GROUP BY category")
def agg_cat(spark, d):
    """Pass rates of categories in the order they are first seen."""
    return gates.by_category(gates.judged(X.replies(spark, d)), "id").withColumn("pass_rate", F.round("pass_rate", 4))


@query(f"{SCORED_SQL} SELECT {_PASS.format(least=0.8)}, CAST(count(*) FILTER (len(failed) > 0) AS BIGINT) AS failed, 0.8::DOUBLE AS threshold FROM scored")
def gate_chat(spark, d):
    """The verdict over all replies."""
    rows = gates.pass_rate(gates.judged(X.replies(spark, d)), [])
    return rows.select("n", "n_passed", F.round("pass_rate", 4).alias("pass_rate"), "gate", (F.col("n") - F.col("n_passed")).alias("failed"), F.lit(gates.PASS_RATE).alias("threshold"))


@query("""SELECT vec_id, CAST(len(list_filter(e, lambda x: x >= 0)) AS BIGINT) AS n_words, CAST(len(list_filter(e, lambda x: x > 0.2)) AS BIGINT) AS word_edits FROM (SELECT vec_id, embedding AS e FROM embeddings)""")
def agg_train(spark, d):
    """Word edits of token ids, masked places left out of both sides."""
    zipped = F.transform("embedding", lambda x, i: F.struct(F.when(x < 0, -100).otherwise(i).alias("y"), F.when(x > 0.2, -1).otherwise(i).alias("p")))
    kept = F.filter(zipped, lambda z: z["y"] != -100)
    rows = table(spark, d, "embeddings").select("vec_id", kept.alias("k"))
    words = lambda c: F.transform("k", lambda z: z[c].cast("string"))
    return rows.select("vec_id", F.size("k").cast("long").alias("n_words"), T.word_edits(words("y"), words("p")).alias("word_edits"))


@query(f"WITH {X.pairs_sql(7, 'b')}, {X.pairs_sql(13, 't')}, x AS (SELECT (SELECT sum(word_edits) / sum(n_words) FROM t) - (SELECT sum(word_edits) / sum(n_words) FROM b) AS delta) SELECT delta <= 0.02 AS ok, CASE WHEN delta <= 0.02 THEN 'ok' ELSE 'rate rose too much' END AS message, delta FROM x")
def gate_ret(spark, d):
    run = lambda n: scoring.grouped(scoring.scored(X.pairs(spark, d, n)), [[], ["source_dataset"]]).withColumnRenamed("source_dataset", "group").withColumn("normalize", F.lit("none"))
    return gates.retention(run(13), run(7))


@query(f"{SCORED_SQL}, g AS (SELECT avg(CASE WHEN len(failed) = 0 THEN 1.0 ELSE 0.0 END) >= 0.8 AS chat FROM scored) SELECT chat AS chat_ok, true AS retention_ok, chat AS publish, true AS publish_forced FROM g")
def gate_publish(spark, d):
    """All gates together, and with the chat gate overridden."""
    chat = gates.pass_rate(gates.judged(X.replies(spark, d)), []).select((F.col("gate") == "PASS").alias("chat_ok"))
    both = chat.join(F.broadcast(gate_ret(spark, d).select(F.col("ok").alias("retention_ok"))))
    return both.withColumn("publish", F.col("chat_ok") & F.col("retention_ok")).withColumn("publish_forced", F.col("retention_ok"))
