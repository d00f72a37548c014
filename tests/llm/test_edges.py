"""Defined results for nulls, empty and very long texts, ties, repeated rows, empty tables and clashing columns."""

import hashlib
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from parkwright.llm import licenses, mixing, packing, quality_fm, quality_rules, quotes, sharding, simhash_dedup, topk_search, warc
from parkwright.llm.components import components
from parkwright.llm.queries import tokenizer
from tests.llm.test_contracts import plain_components, plain_fingerprint, plain_rules

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, kept boolean, score double, fp string, shard string, position string, item string, digest string, h int"


def words(n, seed=1, most=500):
    r = random.Random(seed)
    return " ".join(f"w{r.randrange(most)}" for _ in range(n))


@pytest.fixture(scope="module")
def rows():
    long = words(120_000, 3, 100_000)
    base = words(80, 5)
    texts = [None, "", "   \n", "one", "one two", base, base, base + " end", long, words(70, 9).upper() + " É", "\n".join([words(6, 11)] * 30), "a  b\tc \n d", "x" * 20_000, "<|endoftext|> \x1e sep"]
    out = [(i, t, None if i % 4 == 0 else "en", None if i % 5 == 0 else f"s{i % 2}", None, None, 0.5, "f", "s", "p", "i", "d", i) for i, t in enumerate(texts)]
    return [*out, out[5], out[5], (None, "a text without an id", "en", "s1", 3, True, None, None, None, None, None, None, None)]


@pytest.fixture(scope="module")
def docs(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def test_rules(docs, rows):
    got = quality_rules.apply_rules(docs).collect()
    assert len(got) == len(rows)
    by = {r[0]: r[1] for r in rows}
    for r in got:
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"], r["base_failed"]) == plain_rules(by[r["doc_id"]])
    kept = quality_rules.filter_documents(docs)
    assert kept.columns == docs.columns
    want = sorted(r["doc_id"] for r in got if r["kept"])
    assert sorted(r["doc_id"] for r in kept.collect()) == want


def test_sketch_follows_its_group(spark):
    """A measure usual in one source is kept there and rejected in another; merging sketches adds counts."""
    plain_rows = [(i, words(100, i), "en", "prose", 0) for i in range(250)]
    table = [(1000 + i, words(100, i).replace(" ", " | "), "en", "tables", 0) for i in range(250)]
    odd = [(2000, words(100, 7).replace(" ", " | "), "en", "prose", 0)]
    got = {r["doc_id"]: r["kept"] for r in quality_rules.apply_rules(spark.createDataFrame(plain_rows + table + odd, "doc_id long, text string, lang string, source string, n_chars long")).collect()}
    assert all(got[r[0]] for r in plain_rows + table) and not got[2000]


def prose(seed, most=500):
    """Words some of which have a comma, a capital or a longer form, so that every measure varies from text to text."""
    r = random.Random(seed)
    return " ".join((w.upper() if r.random() < 0.1 else w) + ("," if r.random() < 0.1 else "x" * r.randrange(4)) for w in words(100, seed, most).split())


#: Texts of one source, and of another in which one measure is usually higher.
SHIFTED = {
    "marks_ptt": (prose, lambda i: prose(i).replace("x", ".")), "upper_ptt": (prose, lambda i: prose(i).upper()), "word_length_c": (prose, lambda i: " ".join(w * 9 for w in prose(i).split())),
    "sameness_pm": (lambda i: words(100, i, 60), lambda i: words(100, i, 14)),
}


@pytest.mark.parametrize("measure", SHIFTED)
def test_each_measure_follows_its_group(spark, measure):
    """A value of one measure that is usual in a source is kept there and rejected in another, by that measure."""
    here, there = SHIFTED[measure]
    usual = [(i, here(i), "en", "prose", 0) for i in range(250)]
    odd_there = [(1000 + i, there(i), "en", "other", 0) for i in range(250)]
    odd_here = [(2000, there(7), "en", "prose", 0)]
    got = {r["doc_id"]: r for r in quality_rules.apply_rules(spark.createDataFrame(usual + odd_there + odd_here, "doc_id long, text string, lang string, source string, n_chars long")).collect()}
    lost = [r[0] for r in usual + odd_there if got[r[0]][measure] > got[r[0]][f"top_{measure}"]]
    # with 12 quartile distances about one clean text in 8,192 may go for a measure
    assert len(lost) <= 1 and not got[2000]["base_failed"] and not got[2000]["kept"] and got[2000][measure] > got[2000][f"top_{measure}"]


def test_bucket(spark):
    got = spark.range(100_000).select("id", quality_rules.bucket(F.col("id")).alias("b")).where("b > id or id - b > id / 32").count()
    assert got == 0


def test_simhash(docs, rows):
    got = simhash_dedup.near_duplicates(docs).collect()
    assert len(got) == len(rows)
    fps = {r[0]: plain_fingerprint(r[1]) for r in rows if r[0] is not None}
    comps = plain_components(fps)
    for r in got:
        if r["doc_id"] is not None:
            assert (r["fp"] % 2**64, r["component_id"]) == (fps[r["doc_id"]], comps[r["doc_id"]])
    kept = simhash_dedup.keep_one(docs)
    assert kept.columns == docs.columns
    ids = [r["doc_id"] for r in kept.collect()]
    # the copy with one more word goes as well; rows 0 to 2 have no words
    assert sorted(i for i in ids if i is not None) == sorted({c for c in comps.values()} - {7}) and ids.count(None) == 1


def test_dense_and_chained_fingerprints(spark, monkeypatch):
    """A cell far over its block size, chains of links, and far fingerprints: components as by brute force."""
    monkeypatch.setattr(simhash_dedup, "BLOCK", 16)
    monkeypatch.setattr(simhash_dedup, "SAMPLE", 1)
    r = np.random.default_rng(2)
    core = int(r.integers(0, 2**63))
    near = {core ^ sum(1 << int(b) for b in r.choice(64, k, replace=False)) for k in (0, 1, 2) for _ in range(60)}
    chain, at = set(), int(r.integers(0, 2**63))
    for _ in range(40):
        at ^= sum(1 << int(b) for b in r.choice(64, 3, replace=False))
        chain.add(at)
    fps = sorted(near | chain | {int(x) for x in r.integers(0, 2**63, 200)})
    signed = [(f - 2**64 if f >= 2**63 else f,) for f in fps]
    got = {x["node"] % 2**64: x["root"] % 2**64 for x in components(simhash_dedup.links(spark.createDataFrame(signed, "fp long"))).collect()}
    want, groups = plain_components(dict(enumerate(fps))), {}
    for i, c in want.items():
        groups.setdefault(c, set()).add(fps[i])
    found = {}
    for n, root in got.items():
        found.setdefault(root, set()).add(n)
    assert {frozenset(g) for g in groups.values() if len(g) > 1} == {frozenset(g) for g in found.values()}


def test_components_of_paths(spark):
    edges = [(i, i + 1) for i in range(300)] + [(1000, 1000), (2000, 2001), (2001, 2000)]
    got = components(spark.createDataFrame(edges, "a long, b long")).collect()
    assert len({r["root"] for r in got if r["node"] <= 300}) == 1 and len({r["root"] for r in got}) == 2


def test_shards(docs, rows):
    got = sharding.assign(docs, 4).collect()
    assert len(got) == len(rows)
    by = {}
    for r in got:
        by.setdefault(r["shard"], []).append(r["slot"])
    assert all(sorted(s) == list(range(len(s))) for s in by.values())
    nulls = {r["shard"] for r in got if r["doc_id"] in (0, 1)}
    assert len(nulls) == 1 and {r["text_crc32"] for r in got if r["doc_id"] in (0, 1)} == {0}


def test_group_over_a_shard(spark):
    text, n = words(40, 2), 900
    table = spark.createDataFrame([(i, text if i < n else words(40, i)) for i in range(1800)], "doc_id long, text string")
    sizes = {}
    for r in sharding.assign(table, 10).collect():
        sizes[r["shard"]] = sizes.get(r["shard"], 0) + r["size"]
    assert len(sizes) == 10 and max(sizes.values()) < 1.05 * min(sizes.values())


def plain_best_fit(sizes, shards):
    """Best fit decreasing by looking at every bin, for the same capacities as the operator tries."""

    def pack(capacity):
        left, out = [], {}
        for name, size in sorted(sizes.items(), key=lambda x: (-x[1], x[0])):
            fits = [(r, b) for b, r in enumerate(left) if r >= size]
            if not fits:
                if len(left) == shards or size > capacity:
                    return None
                left.append(capacity)
                fits = [(capacity, len(left) - 1)]
            out[name] = min(fits)[1]
            left[out[name]] -= size
        return out

    share = -(-sum(sizes.values()) // shards)
    capacity, step = max(share, max(sizes.values())), max(1, share // sharding.PRECISION)
    if pack(capacity):
        return pack(capacity)
    low = capacity
    while pack(low + step) is None:
        low, step = low + step, step * 2
    high = low + step
    while high - low > max(1, share // sharding.PRECISION):
        middle = (low + high) // 2
        low, high = (middle, high) if pack(middle) is None else (low, middle)
    return pack(high)


def test_shards_by_plain_best_fit(spark):
    """Groups that are all listed: the same shard for each as by brute force."""
    r = random.Random(17)
    texts = [words(r.randrange(120, 200), i) for i in range(400)]
    table = [(i, texts[r.randrange(400)]) for i in range(700)]
    sizes = {}
    for _, t in table:
        key = hashlib.sha256(t.encode()).hexdigest()
        sizes[key] = sizes.get(key, 0) + len(t.encode()) + 16
    want = plain_best_fit(sizes, 10)
    got = sharding.assign(spark.createDataFrame(table, "doc_id long, text string"), 10).collect()
    assert {bytes(x["digest"]).hex(): x["shard"] for x in got} == want and len(got) == 700


def test_shards_of_small_groups(spark):
    """Groups that are all counted: each stays whole and shards are nearly equal."""
    r = random.Random(18)
    table = [(i, words(r.randrange(1, 60), r.randrange(15_000))) for i in range(20_000)]
    bytes_of, shard_of = {}, {}
    for x in sharding.assign(spark.createDataFrame(table, "doc_id long, text string"), 20).collect():
        bytes_of[x["shard"]] = bytes_of.get(x["shard"], 0) + x["size"]
        assert shard_of.setdefault(bytes(x["digest"]), x["shard"]) == x["shard"]
    assert len(bytes_of) == 20 and max(bytes_of.values()) < 1.02 * min(bytes_of.values())
    # each goes by its own size: the same shard as by brute force over all groups
    sizes = {}
    for _, t in table:
        key = hashlib.sha256(t.encode()).digest()
        sizes[key] = sizes.get(key, 0) + len(t.encode()) + 16
    assert max(sizes.values()) * sharding.GRAIN < sum(sizes.values()) / 20 and shard_of == plain_best_fit(sizes, 20)


@pytest.mark.parametrize("one_id", [5, None])
def test_shards_of_repeated_rows(spark, one_id):
    """A group of rows that are equal in id too is cut like any other; a row over a share has a shard of its own."""
    table = spark.createDataFrame([(one_id, words(180, 1)) for _ in range(20_000)] + [(i, words(30, i)) for i in range(2000)], "doc_id long, text string")
    sizes = {}
    for x in sharding.assign(table).collect():
        sizes[x["shard"]] = sizes.get(x["shard"], 0) + x["size"]
    assert len(sizes) == 40 and max(sizes.values()) < 1.05 * min(sizes.values())
    huge = spark.createDataFrame([(0, "x" * 400_000), (1, "y" * 300_000), *[(i, words(30, i)) for i in range(2, 3000)]], "doc_id long, text string")
    sizes = {}
    for x in sharding.assign(huge, 10).collect():
        sizes.setdefault(x["shard"], []).append(x["size"])
    rest = sorted(sum(v) for v in sizes.values() if len(v) > 1)
    assert len(rest) == 8 and rest[-1] < 1.05 * rest[0]


def test_best_fit_tree():
    r, tree, held = random.Random(4), sharding.Tree(), []
    for _ in range(3000):
        if held and r.random() < 0.45:
            x = held.pop(r.randrange(len(held)))
            tree.drop(x)
        else:
            x = (r.randrange(500), r.randrange(1000))
            if x not in held:
                held.append(x)
                tree.add(x)
        ask = (r.randrange(500), -1)
        assert tree.at_least(ask) == min((h for h in held if h >= ask), default=None)


def test_classifier(spark, docs, rows):
    labels = spark.createDataFrame([(i, i % 2, 0) for i in range(14)] + [(None, 1, 0), (3, None, 0), (5, 1, 0)], "doc_id long, quality int, toxic int")
    machine = quality_fm.train(docs, labels)
    got = quality_fm.score(docs, machine).collect()
    assert len(got) == len(rows) and all(0 <= r["score"] <= 1 for r in got)
    assert quality_fm.keep_good(docs, machine).columns == docs.columns
    assert {r["score"] for r in quality_fm.score(docs, quality_fm.train(docs, labels.limit(0))).collect()} == {0.5}


def test_labels_of_other_tables(spark):
    """Labels without documents, whatever their number, leave those with one to learn from."""
    good, bad = "A calm line of words, as people write them. ", "@@ ## $$ buy!!! || now!!! "
    docs = spark.createDataFrame([(i, (good if i % 2 else bad) * 12 + words(20, i)) for i in range(300)], "doc_id long, text string")
    labels = docs.selectExpr("doc_id", "cast(doc_id % 2 as int) quality").unionByName(spark.range(10**6, 10**6 + 20_000).selectExpr("id doc_id", "1 quality"))
    scores = {r["doc_id"]: r["score"] for r in quality_fm.score(docs, quality_fm.train(docs, labels)).collect()}
    assert min(s for i, s in scores.items() if i % 2) > 0.8 and max(s for i, s in scores.items() if not i % 2) < 0.2


def test_interactions_in_linear_time():
    """The sum-of-squares identity equals the sum over pairs."""
    r = np.random.default_rng(1)
    m = quality_fm.Machine(np.zeros(quality_fm.STATS), np.ones(quality_fm.STATS), 0.1, r.normal(size=quality_fm.STATS + quality_fm.BUCKETS), r.normal(size=(quality_fm.STATS + quality_fm.BUCKETS, quality_fm.RANK)) / 9)
    text = b"Some words, some lines.\nAnd 3 more words | here"
    stats, at = quality_fm.features(text)
    x = np.zeros(len(m.w))
    x[: quality_fm.STATS] = m.dense(stats)
    x[at + quality_fm.STATS] = 1 / np.sqrt(len(at))
    used = np.flatnonzero(x)
    z = m.w0 + m.w @ x + sum((m.v[i] @ m.v[j]) * x[i] * x[j] for i in used for j in used if j < i)
    assert abs(1 / (1 + np.exp(-z)) - m.score([text])[0]) < 1e-9


def check_pfair(rows, weights, block_docs):
    """Within each stretch where all sources have blocks, every source is less than one block from its share."""
    blocks = sorted({(r["block_position"], r["source"]) for r in rows})
    assert [b for b, _ in blocks] == list(range(len(blocks)))
    left = {s: 0 for s in weights}
    for _, x in blocks:
        left[x] += 1
    at = 0
    while at < len(blocks):
        share = {s: min(left[s], weights[s]) for s in weights if left[s]}
        span, names = sum(share.values()), list(share)
        of, seen, want = {s: i for i, s in enumerate(names)}, np.zeros(len(names)), np.array([share[s] for s in names])
        for t in range(1, span + 1):
            seen[of[blocks[at + t - 1][1]]] += 1
            assert (np.abs(seen * span - want * t) < span).all()
        left = {s: left[s] - share.get(s, 0) for s in weights}
        at += span


def test_mixing_deviation(spark):
    weights = {"a": 5, "b": 3, "c": 1}
    table = spark.createDataFrame([(i, "a" if i % 10 < 3 else "b" if i % 10 < 9 else "c") for i in range(700)], "doc_id long, source string")
    got = mixing.mix(table, weights, 4).collect()
    check_pfair(got, weights, 4)
    assert sorted(r["position"] for r in got) == list(range(700))
    by_place = sorted(got, key=lambda r: r["position"])
    assert by_place == sorted(got, key=lambda r: (r["block_position"], r["source_rank"]))


def test_mixing_of_many_sources(spark):
    """2,000 sources of unlike sizes: gapless, in order, and each less than a block from its share."""
    rows, at = [], 0
    for source in range(2000):
        for _ in range(1 + source % 23 + (600 if source % 500 == 7 else 0)):
            rows.append((at, f"s{source:04d}"))
            at += 1
    got = mixing.mix(spark.createDataFrame(rows, "doc_id long, source string"), None, 2).collect()
    assert sorted(r["position"] for r in got) == list(range(at))
    assert sorted(got, key=lambda r: r["position"]) == sorted(got, key=lambda r: (r["block_position"], r["source_rank"]))
    counts = {}
    for r in got:
        counts[r["source"]] = counts.get(r["source"], 0) + 1
    roots = {s: int(n**0.5 * 1000) for s, n in counts.items()}
    check_pfair(got, {s: max(1, x * mixing.PERIOD // sum(roots.values())) for s, x in roots.items()}, 2)


def test_mixing_edges(docs, rows, empty):
    got = mixing.mix(docs).collect()
    assert sorted(r["position"] for r in got) == list(range(len(rows)))
    out = mixing.mixed_documents(docs)
    assert out.columns == docs.columns and out.count() == len(rows)
    assert out.collect()[-1]["doc_id"] is None
    assert mixing.mix(empty).count() == 0 and mixing.mixed_documents(empty).count() == 0


def test_clashing_columns_of_other_tables(spark):
    """Extra columns named like the operators' own, for vectors, pages and messages."""
    extra = {c: F.lit("x") for c in ("dim", "pivot", "block", "q", "floor", "kind", "sha", "last", "refers_to", "revisit", "uid", "quoted", "position", "thread_turn", "_hash")}
    rows = spark.createDataFrame([(i, [float(i % 7), 1.0]) for i in range(40)], "id long, v array<double>")
    plain_rows = topk_search.search(rows, rows.where("id = 0"), 3).collect()
    assert topk_search.search(rows.withColumns(extra), rows.where("id = 0").withColumns(extra), 3).collect() == plain_rows
    pages = spark.createDataFrame([(1, "u", "a"), (2, "u", "a")], "page_id long, url string, html string").withColumns(extra)
    assert sorted((r["page_id"], r["refers_to"]) for r in warc.round_trip(pages).collect()) == [(1, 2), (2, None)]
    said = spark.createDataFrame([(1, 0, "a", "What is a passage, asked the first?"), (1, 1, "b", "> What is a passage, asked the first?\nThis.")], "conv_id long, turn long, role string, text string").withColumns(extra)
    assert {r["turn"]: r["reply_to"] for r in quotes.reply_ordered(said).collect()} == {0: None, 1: 0}


def test_long_texts_of_other_tables(spark):
    """A page and a message of some megabytes."""
    body = words(400_000, 5, 90_000)
    page = spark.createDataFrame([(1, "u", body)], "page_id long, url string, html string")
    assert [r["payload_bytes"] for r in warc.round_trip(page).collect()] == [len(body)]
    said = spark.createDataFrame([(1, 0, "a", body), (1, 1, "b", "> " + body[:300_000].replace("w7 ", "w7\n> ") + "\nSo it is.")], "conv_id long, turn long, role string, text string")
    assert [r["content"] for r in quotes.reply_ordered(said).orderBy("turn").collect()] == [body, "So it is."]


def test_search_edges(spark):
    r = np.random.default_rng(5)
    rows = [(i, r.normal(size=6).tolist()) for i in range(300)]
    rows += [(300, None), (301, [1.0, None, 0.0, 0.0, 0.0, 0.0]), (302, [float("nan")] * 6), (303, [float("inf")] * 6), (304, []), (305, [1.0, 2.0]), (306, [1.0, 2.0]), (0, rows[0][1]), *[(400 + i, rows[7][1]) for i in range(9)], (None, rows[1][1])]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>").select(F.col("vec_id").alias("id"), topk_search.whole_numbers(F.col("embedding")).alias("v"))
    got = {}
    for x in topk_search.search(table, table.where("id % 50 = 0 or id = 305"), 5).collect():
        got.setdefault(x["query_id"], []).append((x["rank"], x["id"], x["score"]))
    good = {(i, tuple(np.floor(256 * np.array(v)))) for i, v in rows if i is not None and v is not None and all(c is not None and np.isfinite(c) for c in v)}
    for q, v in good:
        if q % 50 == 0 or q == 305:
            best = sorted((-int(np.dot(v, w)), i) for i, w in good if i != q and len(w) == len(v))[:5]
            assert sorted(got.get(q, [])) == [(k + 1, i, -s) for k, (s, i) in enumerate(best)]
    assert topk_search.search(table.limit(0), table.limit(0), 5).count() == 0


def test_search_prunes_nothing_wrongly(spark, monkeypatch):
    """Small annuli and blocks, clustered rows, many ties."""
    monkeypatch.setattr(topk_search, "ANNULUS", 7)
    monkeypatch.setattr(topk_search, "ROW_BLOCK", 150)
    monkeypatch.setattr(topk_search, "LEAST_BLOCK", 40)
    monkeypatch.setattr(topk_search, "BOUNDS", 100)  # a few queries at a time
    r = np.random.default_rng(6)
    centres = r.normal(size=(9, 8)) * 3
    x = np.floor(256 * np.round(centres[r.integers(0, 9, 900)] + r.normal(size=(900, 8)) * 0.02, 1))
    table = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "id long, v array<double>")
    routed, real = [], topk_search._routed
    monkeypatch.setattr(topk_search, "_routed", lambda *a, **b: routed.append(real(*a, **b)) or routed[-1])
    got = {(a["query_id"], a["rank"]): (a["id"], a["score"]) for a in topk_search.search(table, table.where("id % 50 = 0"), 5).collect()}
    # clustered rows: most blocks are ruled out before the shuffle
    assert routed[0].count() == 18 and routed[1].count() < 18 * 22 / 3
    for q in range(0, 900, 50):
        best = sorted((-int(s), i) for i, s in enumerate(x @ x[q]) if i != q)[:5]
        assert [got[q, k + 1] for k in range(5)] == [(i, -s) for s, i in best]


def test_warc_edges(spark):
    import io

    rows = [(1, "http://a/", None), (2, None, ""), (3, "u\r\nx: y", "é" * 9000), (4, "u", "é" * 9000), (4, "u", "é" * 9000), (5, "v", words(90_000, 8, 80_000)), (None, "n", "solo"), (None, "n", "é" * 9000)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(2)
    from parkwright.llm.shared import new_path

    files = warc.write(pages, new_path(spark, "warc"))
    for split in (700, 50_000, 4 << 20):
        got = sorted(((r["page_id"] or 0, r["record_type"], r["refers_to"], r["payload_bytes"]) for r in warc.read(spark, files, split).collect()))
        assert got == sorted([(1, "revisit", 2, 0), (2, "response", None, 0), (3, "revisit", 4, 18000), (4, "response", None, 18000), (4, "response", None, 18000), (5, "response", None, len(rows[5][2])), (0, "response", None, 4), (0, "revisit", 4, 18000)])
    assert warc.round_trip(pages.limit(0)).count() == 0
    # noise between and inside members, and a payload that holds a whole record
    inner = warc.member(warc.encode(9, "i", b"inner", None, False))
    outer = warc.member(warc.encode(8, "o", inner * 3, None, False))
    data = b"\x1f\x8b\x08 noise" + outer + b"\x1f\x8b\x08\x00" + inner + outer[: len(outer) // 2]
    for cut_at in range(0, len(data), 37):
        ids = [r["page_id"] for s, e in ((0, cut_at), (cut_at, len(data))) for r in warc.records(io.BytesIO(data), s, e)]
        assert ids == [8, 9]


def test_member_always_ends(monkeypatch):
    """Whatever seems to hold another record is written in some other way that doesn't."""
    import io

    real, tries = warc.seems_to_hold_another, []

    def suspicious(packed):
        tries.append(1)
        return len(tries) < 8 or real(packed)

    monkeypatch.setattr(warc, "seems_to_hold_another", suspicious)
    packed = warc.member(warc.encode(3, "u", b"some text " * 500, None, False))
    assert len(tries) == 8 and [r["payload"] for r in warc.records(io.BytesIO(packed), 0, len(packed))] == [b"some text " * 500]


def test_one_task_for_each_split(spark, sf):
    from parkwright.llm.shared import new_path

    pages = spark.read.parquet(f"{sf}/pages.parquet")
    files = warc.write(pages, new_path(spark, "warc"))
    n = sum(-(-r["bytes"] // 50_000) for r in files.collect())
    read = warc.read(spark, files, 50_000)
    tasks = read.select(F.spark_partition_id().alias("p")).distinct().count()
    assert read.count() == pages.count() and n > 8 and tasks > 0.6 * n


def test_quotes(spark):
    rows = [
        (1, 0, "user", "How do I prune a vine in winter?\n\nAlso, when do I water it?"), (1, 1, "assistant", "Cut it back to two buds."),
        (1, 2, "user", "> Also,  when do I WATER it?\n\nThat part was not answered yet."), (1, 3, "assistant", "On Monday, user wrote:\n>> Also, when do I water it?\n> That part was not answered yet.\nEvery second week is enough."),
        (1, 4, "user", "> Cut it back to two buds.\nThanks for that advice."), (2, 0, "user", "> Cut it back to two buds.\nNothing here."), (2, 1, "user", None), (2, None, "user", ""), (None, 0, "user", "text text text"), (1, 4, "user", "a repeated turn, without quotes"),
    ]
    got = quotes.reply_ordered(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")).collect()
    assert len(got) == len(rows)
    links = {(r["conv_id"], r["turn"]): (r["reply_to"], r["thread_turn"]) for r in got if r["conv_id"] == 1}
    assert links == {(1, 0): (None, 0), (1, 1): (None, 1), (1, 2): (0, 0), (1, 3): (2, 0), (1, 4): (1, 1)}
    assert not any(">" in r["content"] for r in got) and {r["content"] for r in got if r["turn"] == 3} == {"Every second week is enough."}
    order = [r["turn"] for r in sorted((r for r in got if r["conv_id"] == 1), key=lambda r: r["position"])]
    assert order == [0, 2, 3, 1, 4, 4]
    assert quotes.reply_ordered(spark.createDataFrame(rows[:0], "conv_id long, turn long, role string, text string")).count() == 0


def test_short_quotes(spark):
    """Short passages link to their earliest holder like others, unless a longer one of the level links."""
    rows = [
        (1, 0, "a", "Shall I prune?"), (1, 1, "b", "Yes, do it."), (1, 2, "a", "> Yes, do it.\nI will then."), (1, 3, "b", "Yes, do it."), (1, 4, "a", "> Yes, do it.\nOnce more?"),
        (1, 5, "c", "> Shall I prune?\n> Yes, do it.\nA long one first."), (1, 6, "c", "> Yes, do it.\n>> Shall I prune?\nOK"), (2, 0, "a", "\u597d\u7684"), (2, 1, "b", "> \u597d\u7684\n>\nok"), (None, 0, "a", "no"), (None, 1, "b", "> no\nok"), (3, 0, "a", "> no\nnothing"),
    ]
    got = quotes.reply_ordered(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")).collect()
    assert {(r["conv_id"], r["turn"]): r["reply_to"] for r in got if r["reply_to"] is not None} == {(1, 2): 1, (1, 4): 1, (1, 5): 0, (1, 6): 1, (2, 1): 0, (None, 1): 0}
    assert {r["turn"]: r["thread_turn"] for r in got if r["conv_id"] == 1} == {0: 0, 1: 1, 2: 1, 3: 3, 4: 1, 5: 0, 6: 1}


def test_long_reply_chain(spark):
    rows = [(1, i, "user", (f"> message number {i - 1} of a chain\n" if i else "") + f"message number {i} of a chain") for i in range(40)]
    got = quotes.reply_ordered(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")).collect()
    assert {r["thread_turn"] for r in got} == {0} and sorted(r["position"] for r in got) == list(range(40))


def plain_dice(text, templates):
    import re

    found = []
    lines = [" ".join(re.findall(r"[^\W_]+", x.lower())) for x in (text or "").split("\n")]
    whole, paragraphs, part = " ".join(lines).split(), [], []
    for x in [*lines, ""]:
        if x:
            part.append(x)
        elif part:
            paragraphs, part = [*paragraphs, " ".join(part).split()] if len(part) > 1 else paragraphs, []
    for unit in [*[x.split() for x in lines], *paragraphs, whole]:
        a = {f"{x} {y}" for x, y in zip(unit, unit[1:], strict=False)}
        for name, t in templates.items():
            b = set(licenses.template_bigrams(t))
            if 5 * 2 * len(a & b) >= 4 * (len(a) + len(b)) and a:
                found.append((2 * len(a & b) / (len(a) + len(b)), name))
    return found


def test_licenses(spark, docs, rows):
    t = licenses.TEMPLATES
    texts = [None, "", "prose", t["MIT"], "words\n" + t["GPL-3.0"] + "\nwords", t["MPL-2.0"].replace(". ", ".\n"), "Intro line.\n\n" + t["ISC"].replace("copies", "works").replace(", and", ",\nand") + "\n\nOutro.", t["Apache-2.0-header"], "Licensed under CC BY-NC 4.0!!", "Licensed under the MIT Licence by me"]
    table = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for r in licenses.scan(table).collect():
        want = plain_dice(texts[r["doc_id"]], t)
        best = max((d for d, _ in want), default=None)
        assert (r["best_license"] is None) == (best is None)
        if best is not None:
            assert abs(2 * r["best_shared"] / r["best_sizes"] - best) < 1e-12 and (best, r["best_license"]) in want
            assert set(r["licenses"].split(",")) <= {n for _, n in want}
    assert licenses.scan(docs).count() == len(rows)


def test_licenses_inside_longer_units(spark):
    t = licenses.TEMPLATES
    long, prose = " ".join(f"word{i}" for i in range(300)), "All figures were checked twice before print. "
    texts = {
        prose + t["GPL-3.0"] + " Readers may write to us at any time.": "GPL-3.0",
        "Copyright 2021 Some Author and others. Licensed under CC BY-NC 4.0.": "CC-BY-NC-4.0",
        "Released under the MIT License. Licensed under CC BY-NC 4.0.": "CC-BY-NC-4.0,MIT",
        f"{long} {t['MIT-grant']}, including without limitation the rights to use, copy, modify, merge, publish {long}": "MIT-grant",
        f"{long}\n{long} {t['Apache-2.0-header'].replace(' you may', chr(10) + 'you may')}\n{long}": "Apache-2.0-header",
        t["GPL-3.0-header"] + " " + t["CC-BY-NC-4.0"]: "CC-BY-NC-4.0,GPL-3.0-header",
        f"{prose} {t['CC-BY-SA-4.0']} {prose}": "CC-BY-SA-4.0",
        t["MIT"] + "\n" + prose + t["MIT"] + " " + prose: "MIT",
        f"{prose} The licence was released under the old rules and the MIT campus is near. {prose}": "",
    }
    table = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r["doc_id"]: r for r in licenses.scan(table).collect()}
    assert [got[i]["licenses"] for i in range(len(texts))] == list(texts.values())
    assert [got[i]["restricted"] for i in range(4)] == [True, True, True, False] and got[0]["best_shared"] * 2 == got[0]["best_sizes"]


MIT_TEXT = """MIT License

Copyright (c) 2021 Some Author

Permission is hereby granted, free of charge, to any person obtaining a copy
of this software and associated documentation files (the "Software"), to deal
in the Software without restriction, including without limitation the rights
to use, copy, modify, merge, publish, distribute, sublicense, and/or sell
copies of the Software, and to permit persons to whom the Software is
furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all
copies or substantial portions of the Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR
IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY,
FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE
AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER
LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM,
OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE
SOFTWARE.
"""
APACHE_TEXT = """# Copyright 2020 The Authors
#
# Licensed under the Apache License, Version 2.0 (the "License");
# you may not use this file except in compliance with the License.
# You may obtain a copy of the License at
#
#     http://www.apache.org/licenses/LICENSE-2.0
#
# Unless required by applicable law or agreed to in writing, software
# distributed under the License is distributed on an "AS IS" BASIS,
# WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.
# See the License for the specific language governing permissions and
# limitations under the License.
import os
"""


def test_whole_licenses(spark):
    """Licence texts as files carry them are found by their paragraphs."""
    t = licenses.TEMPLATES
    wrap = lambda text, n=9: "\n".join(" ".join(text.split()[i : i + n]) for i in range(0, len(text.split()), n))
    bsd = "Copyright (c) 2019, Some Author\nAll rights reserved.\n\n" + wrap(t["BSD-3-Clause"]) + ":\n\n" + "\n\n".join(wrap(t[f"BSD-clause-{i}"]) for i in (1, 2, 3)) + "\n\n" + wrap(t["BSD-warranty"])
    isc = "Copyright 2018 Some Author\n\n" + wrap(t["ISC"]) + "\n\n" + wrap(t["ISC-warranty"])
    texts = {
        MIT_TEXT: {"MIT-grant", "MIT-notice", "MIT-warranty"}, APACHE_TEXT: {"Apache-2.0-header", "Apache-2.0-warranty"}, bsd: {"BSD-3-Clause", "BSD-clause-1", "BSD-clause-2", "BSD-clause-3", "BSD-warranty"}, isc: {"ISC", "ISC-warranty"},
        "int main() {}\n" + MIT_TEXT.replace("\n\n", "\n") + "int x;": {"MIT-grant", "MIT-notice", "MIT-warranty"},
    }
    got = {r["doc_id"]: set(r["licenses"].split(",")) for r in licenses.scan(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()}
    for i, want in enumerate(texts.values()):
        assert want <= got[i] and not any(x.startswith(("GPL", "AGPL", "CC", "MPL")) for x in got[i]), (i, got[i])


def test_many_templates(spark):
    """Hundreds of templates, made from whole texts by their paragraphs: found like few, with a plan of the same size."""
    import time

    texts = {f"licence-{i}": "\n\n".join(words(30, 1000 * i + k, 10**6) for k in range(3)) + "\n\nshort one" for i in range(150)}
    many = licenses.by_paragraphs(texts | {"MIT": MIT_TEXT})
    assert len(many) == 150 * 3 + 3 and many["licence-4/2"] == words(30, 4001, 10**6)
    rows = [(0, "A file.\n\n" + texts["licence-7"].replace("\n\n", "\n \n")), (1, MIT_TEXT), (2, f"{words(40, 1)} {many['licence-149/3']} {words(40, 2)}"), (3, words(200, 5))]
    table = spark.createDataFrame(rows, "doc_id long, text string")
    licenses.scan(table).count()
    began = time.perf_counter()
    got = {r["doc_id"]: r["licenses"] for r in licenses.scan(table, many).collect()}
    took = time.perf_counter() - began
    assert got == {0: "licence-7/1,licence-7/2,licence-7/3", 1: "MIT/1,MIT/2,MIT/3", 2: "licence-149/3", 3: ""}
    size = lambda t: len(licenses.scan(table, t)._jdf.queryExecution().analyzed().toString().split("lambda"))
    assert took < 30 and size(many) == size(dict(list(many.items())[:2]))


def test_packing_edges(spark, docs, rows):
    import public_tokenizers
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    ids = {r[0]: np.array([*t.encode(r[1] or "", add_special_tokens=False).ids, 0], "<u4") for r in rows}
    pieces = packing.pack(docs, *tokenizer()).collect()
    for p in pieces:
        own = ids[p["doc_id"]]
        assert p["doc_tokens"] == len(own) and p["ids_crc32"] == zlib.crc32(own[p["start"] : p["start"] + p["length"]].tobytes())
    assert sum(p["length"] for p in pieces) == sum(len(ids[r[0]]) for r in rows)
    with pytest.raises(ValueError):
        packing.pack(docs, *tokenizer(), capacity=1000)


def test_added_tokens():
    """Random texts that hold the end-of-text mark inside, at the ends and doubled, against the tokenizer file."""
    import public_tokenizers
    from tokenizers import Tokenizer

    t, r, mark = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json")), random.Random(12), "<|endoftext|>"
    parts = [mark, mark + mark, " ", "  ", "\n", " word", "word ", "caf\u00e9", "<|", "endoftext|>", "3 + 4", "\x1e"]
    texts = [mark, mark * 2, f"a{mark}b", f" {mark} ", f"{mark} a", f"a {mark}", *["".join(r.choice(parts) for _ in range(r.randrange(12))) for _ in range(2000)]]
    ranks, pattern, added = tokenizer()
    for encoder, plain_marks in ((packing.Encoder(ranks, pattern, added), False), (packing.Encoder(ranks, pattern, {}), True)):
        t.encode_special_tokens = plain_marks
        want = [e.ids for e in t.encode_batch(texts, add_special_tokens=False)]
        assert [x.tolist() for x in encoder.encode(texts)] == want


def test_balance():
    """Costs are near each other, no sequence overflows, and nothing is lost."""
    r = random.Random(3)
    lengths = [r.randrange(1, 1024) for _ in range(500)]
    rooms = [1024] * (sum(lengths) // 1024)
    placed, left = packing.balance(lengths, rooms)
    used, cost = [0] * len(rooms), [0.0] * len(rooms)
    for _, _, n, s in placed:
        used[s] += n
        cost[s] += packing.LINEAR * n + packing.QUADRATIC * n * n
    assert max(used) <= 1024 and sum(used) + sum(lengths[i] - at for i, at in left) == sum(lengths)
    assert min(used) == 1024 and max(cost) < 2.2 * min(cost)


def test_empty_tables(empty):
    assert quality_rules.apply_rules(empty).count() == 0 and quality_rules.filter_documents(empty).count() == 0
    assert simhash_dedup.near_duplicates(empty).count() == 0 and simhash_dedup.keep_one(empty).count() == 0
    assert sharding.assign(empty).count() == 0
    assert quality_fm.score(empty, None).count() == 0 and quality_fm.keep_good(empty, None).count() == 0
    assert licenses.scan(empty).count() == 0 and packing.pack(empty, *tokenizer()).count() == 0


def test_quotes_by_sql(spark):
    """Random conversations that quote each other at several levels, against the SQL."""
    import duckdb

    from parkwright.llm.oracles import QUOTES

    r, rows = random.Random(8), []
    for conv in range(30):
        said = []
        for turn in range(r.randrange(1, 9)):
            parts = [f"said {conv} {r.randrange(6)} and {words(5, r.randrange(40))}" if r.random() < 0.8 else r.choice(["yes", "No.", "ok then"]) for _ in range(r.randrange(1, 4))]
            if said and r.random() < 0.7:
                quoted = r.choice(said).split("\n")
                announced = f"On {words(60, 3)} wrote:\n" if r.random() < 0.2 else ""
                parts.insert(r.randrange(len(parts) + 1), announced + "\n".join("> " + x if r.random() < 0.9 else ">" + x.upper() for x in quoted))
            said.append(r.choice(["\n", "\n\n"]).join(parts))
            rows.append((conv, turn, "user", said[-1]))
    table = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    con, frame = duckdb.connect(), table.toPandas()
    con.register("conversations", frame)
    found = con.execute(QUOTES)
    names = [d[0] for d in found.description]
    got = quotes.reply_ordered(table)
    assert sorted(got.columns) == sorted(names)
    assert sorted(map(tuple, got.select(*names).collect()), key=repr) == sorted(found.fetchall(), key=repr)
    assert got.where("n_linked > 0").count() > 40 and got.where("max_level > 1").count() > 5
