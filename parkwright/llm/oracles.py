"""SQL with the same rows as the registered queries, where SQL can express them; plain methods, not the operators' own."""

from __future__ import annotations

from parkwright.llm import licenses, mixing
from parkwright.llm.quality_rules import LEAST_ROWS, MEASURES, SKETCH_BITS, SPREADS

TOP_K = """WITH e AS (SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT q.vec_id AS query_id, c.vec_id, CAST(list_dot_product(q.v, c.v) AS BIGINT) AS score FROM e q JOIN e c ON q.vec_id <> c.vec_id WHERE q.vec_id % 50 = 0)
SELECT query_id, CAST(n AS INTEGER) AS rank, vec_id, score FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS n FROM s) WHERE n <= 5"""

_SPACE = "[\\x20\\x09-\\x0D]"


def _level(name: str, keys: list[str]) -> str:
    by = ", ".join([*keys, "measure"])
    q = lambda pm: f"min(bucket) FILTER (seen * 1000 >= total * {pm})"
    return f"""{name}_m AS (SELECT {by}, bucket, sum(n) AS n FROM sketch GROUP BY {by}, bucket),
{name}_s AS (SELECT *, sum(n) OVER (PARTITION BY {by} ORDER BY bucket) AS seen, sum(n) OVER (PARTITION BY {by}) AS total FROM {name}_m),
{name} AS (SELECT {by}, max(total) AS total, {q(500)} AS mid, nullif({q(500)} - {q(250)}, 0) AS spread FROM {name}_s GROUP BY {by})"""


_SHIFT = f"greatest(length(bin({{0}})) - {SKETCH_BITS}, 0)::BIGINT"

RULES = f"""WITH w AS (SELECT doc_id, lang, source, coalesce(text, '') AS text, list_filter(string_split_regex(coalesce(text, ''), '{_SPACE}+'), lambda x: x <> '') AS ws,
  list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) AS ls FROM documents),
pos AS (SELECT doc_id, i, ws[i] AS a, ws[i + 1] AS b, ws[i + 2] AS c FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 1)) AS i FROM w)),
again AS (SELECT doc_id, i FROM (SELECT *, count(*) OVER (PARTITION BY doc_id, a, b, c) AS n FROM pos) WHERE n > 1),
rep AS (SELECT doc_id, count(DISTINCT i + k) AS n FROM again, (SELECT unnest([0, 1, 2]) AS k) GROUP BY doc_id),
c AS (SELECT w.doc_id, lang, source, CAST(len(ws) AS BIGINT) AS n_words, CAST(length(regexp_replace(text, '{_SPACE}', '', 'g')) AS BIGINT) AS word_chars,
  CAST(length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols, CAST(len(ls) - len(list_distinct(ls)) AS BIGINT) AS n_dup_lines,
  coalesce(rep.n, 0) AS n_repeat_words, CAST(len(list_distinct(ws)) AS BIGINT) AS n_distinct, CAST(length(text) - length(regexp_replace(text, '[^\\p{{L}}\\p{{M}}\\p{{N}}\\x20\\x09-\\x0D]+', '', 'g')) AS BIGINT) AS n_marks,
  CAST(length(text) - length(regexp_replace(text, '\\p{{Lu}}', '', 'g')) AS BIGINT) AS n_upper FROM w LEFT JOIN rep USING (doc_id)),
m AS (SELECT *, n_words < 50 OR n_repeat_words * 100 > n_words * 50 AS base_failed, 10000 * n_marks // greatest(word_chars, 1) AS marks_ptt, 10000 * n_upper // greatest(word_chars, 1) AS upper_ptt,
  100 * word_chars // greatest(n_words, 1) AS word_length_c, CAST(floor(1000.0::DOUBLE * n_words * sqrt(n_words::DOUBLE) / greatest(n_distinct * n_distinct, 1)) AS BIGINT) AS sameness_pm FROM c),
long AS (SELECT lang, source, unnest([{", ".join(f"'{m}'" for m in MEASURES)}]) AS measure, unnest([{", ".join(MEASURES)}]) AS v FROM m WHERE NOT base_failed),
sketch AS (SELECT lang, source, measure, (v >> {_SHIFT.format("v")}) << {_SHIFT.format("v")} AS bucket, count(*) AS n FROM long GROUP BY ALL),
{_level("own", ["lang", "source"])}, {_level("lan", ["lang"])}, {_level("every", [])},
mids AS (SELECT own.lang, own.source, own.measure, CAST(CASE WHEN own.total >= {LEAST_ROWS} THEN own.mid WHEN lan.total >= {LEAST_ROWS} THEN lan.mid ELSE every.mid END AS BIGINT) AS mid,
  coalesce(CASE WHEN own.total >= {LEAST_ROWS} THEN own.spread END, CASE WHEN own.total >= {LEAST_ROWS} OR lan.total >= {LEAST_ROWS} THEN lan.spread END, every.spread) AS spread
  FROM own JOIN lan ON own.lang IS NOT DISTINCT FROM lan.lang AND own.measure = lan.measure JOIN every ON own.measure = every.measure),
tops AS (SELECT lang, source, measure, CAST(mid + {SPREADS} * coalesce(spread, 1::BIGINT << {_SHIFT.format("mid")}) + (1::BIGINT << {_SHIFT.format("mid")}) - 1 AS BIGINT) AS top FROM mids),
t AS (SELECT lang, source, {", ".join(f"max(top) FILTER (measure = '{m}') AS top_{m}" for m in MEASURES)} FROM tops GROUP BY lang, source)
SELECT m.* EXCLUDE (lang, source), {", ".join(f"top_{m}" for m in MEASURES)}, coalesce(NOT base_failed AND {" AND ".join(f"{m} <= top_{m}" for m in MEASURES)}, false) AS kept
FROM m LEFT JOIN t ON m.lang IS NOT DISTINCT FROM t.lang AND m.source IS NOT DISTINCT FROM t.source"""

_TEMPLATES = ", ".join("('" + name + "', '" + text.replace("'", "''") + "')" for name, text in sorted(licenses.TEMPLATES.items()))

LICENSES = f"""WITH tw AS (SELECT name, list_filter(string_split_regex(lower(x), '[^\\p{{L}}\\p{{N}}]+'), lambda w: w <> '') AS ws FROM (VALUES {_TEMPLATES}) AS v(name, x)),
t AS (SELECT name, list_distinct(list_transform(range(1, len(ws)), lambda i: ws[i] || ' ' || ws[i + 1])) AS b FROM tw),
l AS (SELECT doc_id, string_split(regexp_replace(lower(coalesce(text, '')), '[^\\p{{L}}\\p{{N}}\\n]+', ' ', 'g'), chr(10)) AS ls FROM documents),
u AS (SELECT doc_id, unnest(list_distinct(list_concat(list_concat(ls, list_filter(string_split_regex(array_to_string(ls, chr(10)), '\\n *(?:\\n *)+'), lambda p: contains(p, chr(10)))), [array_to_string(ls, chr(10))]))) AS s FROM l),
w AS (SELECT doc_id, s, list_filter(string_split_regex(s, '[ \\n]+'), lambda x: x <> '') AS ws FROM u),
a AS (SELECT doc_id, s, list_distinct(list_transform(range(1, len(ws)), lambda i: ws[i] || ' ' || ws[i + 1])) AS a FROM w WHERE len(ws) > 1),
m AS (SELECT doc_id, s, name, len(list_intersect(a, b)) AS shared, len(a) + len(b) AS sizes FROM a JOIN t ON 3 * len(a) >= 2 * len(b) AND 2 * len(a) <= 3 * len(b)),
f AS (SELECT *, row_number() OVER (PARTITION BY doc_id, s ORDER BY shared / sizes DESC, name) AS n FROM m WHERE 10 * shared >= 4 * sizes),
o AS (SELECT * FROM f WHERE n = 1), r AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY shared / sizes DESC, name) AS k FROM o)
SELECT d.doc_id, coalesce(x.licenses, '') AS licenses, coalesce(x.n_matches, 0) AS n_matches, x.best_license, x.best_shared, x.best_sizes, coalesce(x.restricted, false) AS restricted FROM documents d
LEFT JOIN (SELECT doc_id, array_to_string(list_sort(list_distinct(list(name))), ',') AS licenses, count(*) AS n_matches, max(name) FILTER (k = 1) AS best_license, max(shared) FILTER (k = 1) AS best_shared,
  max(sizes) FILTER (k = 1) AS best_sizes, bool_or(name IN ({", ".join(f"'{n}'" for n in licenses.RESTRICTED)})) AS restricted FROM r GROUP BY doc_id) x USING (doc_id)"""

_B = mixing.BLOCK_DOCS

MIXING = f"""WITH RECURSIVE ranked AS (SELECT doc_id, source, row_number() OVER (PARTITION BY source ORDER BY md5(doc_id::VARCHAR), doc_id) - 1 AS source_rank FROM documents),
c AS (SELECT source, count(*) AS n, CAST(floor(sqrt(count(*)::DOUBLE) * 1000) AS BIGINT) AS root FROM documents GROUP BY source),
s AS (SELECT source, n, greatest(root * {mixing.PERIOD} // (SELECT CAST(sum(root) AS BIGINT) FROM c), 1) AS w, (n + {_B - 1}) // {_B} AS nb, row_number() OVER (ORDER BY source) AS i FROM c),
st AS (SELECT fp, row_number() OVER (ORDER BY fp) - 1 AS phase FROM (SELECT 0 AS fp UNION SELECT nb // w FROM s UNION SELECT nb // w + 1 FROM s)),
sh AS (SELECT phase, fp, list(least(greatest(nb - fp * w, 0), w) ORDER BY i) AS shares, CAST(sum(least(greatest(nb - fp * w, 0), w)) AS BIGINT) AS span, CAST(sum(least(nb, w * fp)) AS BIGINT) AS off FROM st, s GROUP BY phase, fp),
sim AS (SELECT phase, shares, span, 0 AS t, list_transform(shares, lambda x: 0::BIGINT) AS done, NULL::BIGINT AS pick, NULL::BIGINT AS k FROM sh WHERE span > 0
  UNION ALL SELECT phase, shares, span, t + 1, list_transform(done, lambda x, j: CASE WHEN j = best THEN x + 1 ELSE x END), best, done[best] FROM (SELECT *, list_min(list_transform(shares, lambda x, j:
    CASE WHEN done[j] < x AND done[j] * span // x <= t THEN ((done[j] + 1) * span + x - 1) // x * 100000 + j END)) % 100000 AS best FROM sim WHERE t < span)),
slots AS (SELECT phase, pick, k, t - 1 AS slot FROM sim WHERE pick IS NOT NULL),
b AS (SELECT r.*, r.source_rank // {_B} AS block, s.w, s.i, s.nb, s.n, r.source_rank // {_B} // s.w AS period FROM ranked r JOIN s USING (source)),
p AS (SELECT b.*, (SELECT count(*) - 1 FROM st WHERE st.fp <= b.period) AS phase FROM b),
x AS (SELECT p.*, sh.off + (p.period - sh.fp) * sh.span + slots.slot AS block_position FROM p JOIN sh USING (phase) JOIN slots ON slots.phase = p.phase AND slots.pick = p.i AND slots.k = p.block - p.period * p.w),
gaps AS (SELECT DISTINCT block_position AS place, nb * {_B} - n AS short FROM x WHERE block = nb - 1 AND nb * {_B} > n)
SELECT doc_id, source, source_rank, block, block_position, CAST(block_position * {_B} + source_rank % {_B} - coalesce((SELECT sum(short) FROM gaps WHERE place < block_position), 0) AS BIGINT) AS position FROM x"""

_BITS = "array_to_string(list_transform(string_split(sha1(coalesce(html, '')), ''), lambda d: substr(bin(16 + instr('0123456789abcdef', d) - 1), 2)), '')"
_BASE32 = "array_to_string(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + list_sum(list_transform(range(5), lambda b: CASE WHEN substr(bits, 5 * i + b + 1, 1) = '1' THEN 1 << (4 - b)::INTEGER ELSE 0 END))::BIGINT, 1)), '')"

WARC = f"""WITH p AS (SELECT page_id, CAST(octet_length(encode(coalesce(html, ''))) AS BIGINT) AS payload_bytes, {_BITS} AS bits, max(page_id) OVER (PARTITION BY coalesce(html, '')) AS last FROM pages)
SELECT page_id, payload_bytes, {_BASE32} AS payload_digest, CASE WHEN page_id = last THEN 'response' ELSE 'revisit' END AS record_type, CASE WHEN page_id <> last THEN last END AS refers_to FROM p"""

_MARK = "^(?:[ \\t]*>)+[ \\t]?"
_CLEAN = "trim(regexp_replace(lower({}), '\\s+', ' ', 'g'))"
_EDGES = "regexp_replace({}, '^\\s+|\\s+$', '', 'g')"
_PARTS = "list_concat(list_concat([{0}], string_split_regex({0}, '\\n[ \\t]*\\n')), string_split({0}, chr(10)))"

QUOTES = f"""WITH RECURSIVE m AS (SELECT row_number() OVER () AS rid, conv_id, turn, role, regexp_replace(coalesce(text, ''), '\\r\\n?', chr(10), 'g') AS t FROM conversations),
l AS (SELECT rid, unnest(string_split(t, chr(10))) AS line, unnest(range(len(string_split(t, chr(10))))) AS i FROM m),
v AS (SELECT rid, i, length(regexp_replace(regexp_extract(line, '{_MARK}'), '[^>]', '', 'g')) AS level, regexp_replace(line, '{_MARK}', '') AS body FROM l),
g AS (SELECT *, CASE WHEN lag(level) OVER (PARTITION BY rid ORDER BY i) = level THEN 0 ELSE 1 END AS start FROM v),
h AS (SELECT *, sum(start) OVER (PARTITION BY rid ORDER BY i) AS run FROM g),
r AS (SELECT rid, run, level, string_agg(body, chr(10) ORDER BY i) AS body FROM h GROUP BY rid, run, level),
j AS (SELECT rid, count(*) AS runs, max(level) AS max_level, coalesce(string_agg(body, chr(10) ORDER BY run) FILTER (level = 0), '') AS body FROM r GROUP BY rid),
c AS (SELECT m.rid, conv_id, turn, role, max_level, trim({_EDGES.format("CASE WHEN runs > 1 THEN regexp_replace(body, '(?m)^On [^\\n]* wrote:[ \\t]*$', '', 'g') ELSE body END")}) AS content FROM m JOIN j USING (rid)),
q AS (SELECT DISTINCT rid, level, md5(n) AS hash, length(n) AS chars FROM (SELECT rid, level, {_CLEAN.format("s")} AS n FROM (SELECT rid, level, unnest({_PARTS.format("body")}) AS s FROM r WHERE level > 0)) WHERE n <> ''),
o AS (SELECT DISTINCT rid, md5(n) AS hash, length(n) AS chars FROM (SELECT rid, {_CLEAN.format("s")} AS n FROM (SELECT rid, unnest({_PARTS.format("content")}) AS s FROM c)) WHERE n <> ''),
f AS (SELECT conv_id, hash, chars, min(turn) AS original FROM o JOIN c USING (rid) WHERE turn IS NOT NULL GROUP BY ALL),
wa AS (SELECT c.conv_id, c.turn, q.level, q.chars, q.hash FROM q JOIN c USING (rid) WHERE c.turn IS NOT NULL),
a AS (SELECT wa.conv_id, wa.turn, wa.level, wa.chars, f.original FROM wa JOIN f ON f.conv_id IS NOT DISTINCT FROM wa.conv_id AND f.hash = wa.hash AND f.original < wa.turn),
k AS (SELECT conv_id, turn, original AS reply_to, n_linked FROM (SELECT *, count(*) OVER w AS n_linked, row_number() OVER (w ORDER BY level, chars DESC, original DESC) AS n FROM a WINDOW w AS (PARTITION BY conv_id, turn)) WHERE n = 1),
up AS (SELECT conv_id, turn, reply_to AS goal, 1 AS depth FROM k UNION ALL SELECT up.conv_id, up.turn, k.reply_to, depth + 1 FROM up JOIN k ON k.conv_id IS NOT DISTINCT FROM up.conv_id AND k.turn = up.goal),
top AS (SELECT conv_id, turn, arg_max(goal, depth) AS thread_turn FROM up GROUP BY conv_id, turn),
z AS (SELECT c.conv_id, c.turn, c.role, c.content, (SELECT count(*) FROM q WHERE q.rid = c.rid) AS n_quoted, c.max_level, coalesce(k.n_linked, 0) AS n_linked, k.reply_to, coalesce(top.thread_turn, c.turn) AS thread_turn
FROM c LEFT JOIN k ON k.conv_id IS NOT DISTINCT FROM c.conv_id AND k.turn = c.turn LEFT JOIN top ON top.conv_id IS NOT DISTINCT FROM c.conv_id AND top.turn = c.turn)
SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY thread_turn NULLS FIRST, turn NULLS FIRST, role NULLS FIRST, md5(content)) - 1 AS position FROM z"""

#: Every order is run over the kinds of documents: the first failing filter of each order removes them.
AUDIT = f"""WITH d AS (SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS t, list_filter(string_split_regex(coalesce(text, ''), '{_SPACE}+'), lambda x: x <> '') AS ws FROM documents),
l AS (SELECT doc_id, coalesce(max(quality) FILTER (quality = 1), 0) = 1 AS good, coalesce(max(toxic) FILTER (toxic = 1), 0) = 1 AS toxic FROM labels GROUP BY doc_id),
m AS (SELECT part, concat(CASE WHEN len(ws) < 50 THEN 'A' ELSE '' END, CASE WHEN 100 * len(list_distinct(ws)) < 65 * len(ws) THEN 'B' ELSE '' END, CASE WHEN 100 * len(regexp_extract_all(t, '[A-Z]')) > 5 * length(t) THEN 'C' ELSE '' END,
  CASE WHEN regexp_matches(t, '[#$%&*|]') THEN 'D' ELSE '' END, CASE WHEN doc_id > min(doc_id) OVER (PARTITION BY t) THEN 'E' ELSE '' END) AS fails, coalesce(good, false) AS good, coalesce(toxic, false) AS toxic FROM d LEFT JOIN l USING (doc_id)),
k AS (SELECT part, fails, count(*) AS n, count(*) FILTER (good) AS good, count(*) FILTER (toxic) AS toxic FROM m GROUP BY part, fails),
f AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS f),
o AS (SELECT concat(a.f, b.f, c.f, d.f, e.f) AS filter_order FROM f a, f b, f c, f d, f e WHERE len(list_distinct([a.f, b.f, c.f, d.f, e.f])) = 5),
s AS (SELECT filter_order, CAST(i AS INTEGER) AS step, filter_order[i] AS own, filter_order[1:i - 1] AS before FROM o, (SELECT unnest(range(1, 6)) AS i)),
x AS (SELECT part, filter_order, step, own, n, good, toxic, fails = own AS only_own, contains(fails, own) AS hit, before <> '' AND regexp_matches(fails, '[' || CASE WHEN before = '' THEN '_' ELSE before END || ']') AS gone FROM s, k),
r AS (SELECT part, filter_order, step, own, CAST(sum(CASE WHEN hit OR gone THEN 0 ELSE n END) AS BIGINT) AS kept, CAST(sum(CASE WHEN hit AND NOT gone THEN n ELSE 0 END) AS BIGINT) AS removed, CAST(sum(CASE WHEN hit AND gone THEN n ELSE 0 END) AS BIGINT) AS redundant,
  CAST(sum(CASE WHEN only_own THEN n ELSE 0 END) AS BIGINT) AS unique_fails, CAST(sum(CASE WHEN hit AND NOT gone THEN good ELSE 0 END) AS BIGINT) AS good_lost, CAST(sum(CASE WHEN hit AND NOT gone THEN toxic ELSE 0 END) AS BIGINT) AS toxic_lost FROM x GROUP BY ALL)
SELECT * EXCLUDE (own), CAST(sum(removed) OVER (PARTITION BY part, own) AS BIGINT) AS shapley FROM r"""

_CRC = "list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split({}, ''), lambda x: ascii(x)::BIGINT)), lambda c, b: list_reduce([xor(c, b), 0, 0, 0, 0, 0, 0, 0, 0], lambda x, z: xor(x >> 1, CASE WHEN x & 1 = 1 THEN 3988292384 ELSE 0 END)))"
#: From a state to the next retained turn's, and what is inserted between.
_MOVES = ("[" + ", ".join(f"{{'f': '{f}', 't': '{t}', 'k': {k}}}" for f, t, k in (("-", "s", 0), ("-", "u", 0), ("-", "a", 1), ("s", "u", 0), ("s", "a", 1), ("u", "a", 0), ("u", "u", 1), ("a", "u", 0), ("a", "a", 1))) + "]")

#: One turn after the other, with the least (cost, audit) of each state: delete it, keep it or give it another role.
REPAIR = f"""WITH RECURSIVE k AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text, xor({_CRC.format("coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ')")}, 4294967295) % 20 AS kind FROM conversations),
d AS (SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role, CASE kind WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text, copy FROM k, (SELECT unnest([0, 1]) AS copy) WHERE kind <> 0 AND (copy = 0 OR kind = 3)),
p AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, copy) AS i, row_number() OVER (PARTITION BY conv_id, role, text ORDER BY turn NULLS FIRST, copy) AS nth, regexp_extract(text, '([^\x20\x09-\x0D])[\x20\x09-\x0D]*$', 1) AS last FROM d),
f AS (SELECT *, CASE WHEN last = '' THEN 'b' WHEN nth > 1 THEN 'd' WHEN last NOT IN ('.', '!', '?') THEN 't' ELSE '-' END AS fault, role[1] AS initial, lag(role[1]) OVER (PARTITION BY conv_id ORDER BY i) AS former FROM p),
w AS (SELECT DISTINCT conv_id, 0::BIGINT AS i, [{{'s': '-', 'c': 0::BIGINT, 'a': '', 'l': ''}}] AS ways FROM f
  UNION ALL SELECT w.conv_id, f.i, list_filter(list_transform(['-', 's', 'u', 'a'], lambda state: list_sort(list_filter(list_concat(list_transform(w.ways, lambda x: {{'s': x.s, 'c': x.c + 2, 'a': x.a || 'D', 'l': x.l}}),
    CASE WHEN f.fault IN ('b', 'd') THEN [] ELSE flatten(list_transform(w.ways, lambda x: list_transform(list_filter({_MOVES}, lambda m: m.f = x.s AND (m.t = f.initial OR m.t <> 's')), lambda m: {{'s': m.t, 'c': x.c + 5 * m.k + CASE WHEN m.t = f.initial THEN 0 ELSE 1 END + CASE WHEN f.fault = 't' THEN 5 ELSE 0 END,
      'a': x.a || repeat('I', m.k) || CASE WHEN m.t = f.initial THEN 'K' ELSE 'R' END, 'l': x.l || CASE WHEN m.k = 0 THEN '' WHEN m.t = 'a' THEN 'user:' || chr(10) ELSE 'assistant:' || chr(10) END || CASE WHEN m.t = f.initial THEN f.role WHEN m.t = 'u' THEN 'user' ELSE 'assistant' END || ':' || f.text || chr(10)}}))) END),
    lambda y: y.s = state))[1]), lambda z: z IS NOT NULL) FROM w JOIN f ON f.conv_id IS NOT DISTINCT FROM w.conv_id AND f.i = w.i + 1),
e AS (SELECT conv_id, list_sort(list_transform(arg_max(ways, i), lambda x: {{'c': x.c + CASE x.s WHEN 's' THEN 10 WHEN 'u' THEN 5 ELSE 0 END, 'a': x.a || CASE x.s WHEN 's' THEN 'II' WHEN 'u' THEN 'I' ELSE '' END, 'l': x.l || CASE x.s WHEN 's' THEN 'user:' || chr(10) || 'assistant:' || chr(10) WHEN 'u' THEN 'assistant:' || chr(10) ELSE '' END}}))[1] AS best FROM w GROUP BY conv_id),
g AS (SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (fault = 'b') AS blank, count(*) FILTER (fault = 'd') AS duplicate, count(*) FILTER (fault = 't') AS truncated, count(*) FILTER (former IS NOT NULL AND former || initial NOT IN ('su', 'ua', 'au')) AS illegal FROM f GROUP BY conv_id)
SELECT c.conv_id, CAST(coalesce(gaps, 0) AS BIGINT) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, CAST(coalesce(best.c, 0) AS BIGINT) AS cost, coalesce(best.a, '') AS audit, sha256(regexp_replace(coalesce(best.l, ''), '\\n$', '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) c LEFT JOIN g ON g.conv_id IS NOT DISTINCT FROM c.conv_id LEFT JOIN e ON e.conv_id IS NOT DISTINCT FROM c.conv_id"""

ORACLE_SQL = {"op1_topk_search": TOP_K, "op2_quality_rules": RULES, "op6_mixing": MIXING, "op7_warc": WARC, "op8_quotes": QUOTES, "op9_licenses": LICENSES, "op11_filter_audit": AUDIT, "op13_conversation_repair": REPAIR}
