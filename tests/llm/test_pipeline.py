"""The pipeline's stages, each on its own input, against plain versions."""

from collections import defaultdict

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from parkwright.llm import mixing, quality_fm, quality_rules, simhash_dedup
from parkwright.llm.shared import cut
from tests.llm.test_contracts import plain_fingerprint
from tests.llm.test_edges import check_pfair, words


@pytest.fixture(scope="module")
def stages(spark, sf):
    """Rows before and after each stage."""
    docs, out = spark.read.parquet(f"{sf}/documents.parquet"), []
    for name, stage in corpus_pipeline.STAGES:
        after = cut(stage(spark, docs, sf), "stage")
        out.append((name, docs, after))
        docs = after
    return {name: (before, after) for name, before, after in out}


def ids(df):
    return sorted(r["doc_id"] for r in df.select("doc_id").collect())


def test_names_and_columns(stages):
    assert list(stages) == [n for n, _ in corpus_pipeline.STAGES]
    for name, (before, after) in list(stages.items())[:-1]:
        assert after.columns == before.columns == ["doc_id", "text", "lang", "source", "n_chars"], name


def test_rules_go_by_the_query(stages):
    before, after = stages["quality rules"]
    assert ids(after) == sorted(r["doc_id"] for r in quality_rules.apply_rules(before).where("kept").collect())


def test_classifier_goes_by_its_scores(spark, sf, stages):
    before, after = stages["quality classifier"]
    machine = quality_fm.train(spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet"))
    rows = before.select("doc_id", "text").collect()
    scores = quality_fm.score_texts(machine, [r["text"].encode() for r in rows])
    assert ids(after) == sorted(r["doc_id"] for r, s in zip(rows, scores, strict=True) if s >= quality_fm.CUTOFF)


def plain_groups(rows):
    """Least id of each group of (id, text): fingerprints within 3 bits, or a Jaccard of 0.8 by five-word shingles, linked by brute force."""
    sets, fps = {}, {}
    for i, text in rows:
        w = text.encode().lower().split()
        sets[i], fps[i] = {tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))}, plain_fingerprint(text)
    home = {i: i for i in sets}
    for i, s in sets.items():
        for j, t in sets.items():
            alike = 5 * min(len(s), len(t)) >= 4 * max(len(s), len(t)) and 5 * len(s & t) >= 4 * len(s | t)
            if i < j and home[i] != home[j] and (alike or (fps[i] ^ fps[j]).bit_count() <= 3):
                a, b = home[i], home[j]
                home = {k: min(a, b) if v in (a, b) else v for k, v in home.items()}
    return home


def test_one_of_each_group_stays(stages):
    before, after = stages["simhash near-dedup"]
    home = plain_groups([(r["doc_id"], r["text"]) for r in before.collect()])
    assert ids(after) == sorted(set(home.values())) and len(set(home.values())) < len(home)


def test_mixing_orders_all(stages):
    before, after = stages["source mixing"]
    assert ids(before) == ids(after)
    placed = mixing.mix(before).collect()
    counts = defaultdict(int)
    for r in placed:
        counts[r["source"]] += 1
    roots = {s: int(n**0.5 * 1000) for s, n in counts.items()}
    check_pfair(placed, {s: max(1, x * mixing.PERIOD // sum(roots.values())) for s, x in roots.items()}, mixing.BLOCK_DOCS)


def test_packing_covers_all(stages):
    before, after = stages["packing"]
    pieces, ends = defaultdict(list), {}
    for r in after.collect():
        pieces[r["doc_id"]].append((r["start"], r["length"]))
        ends[r["doc_id"]] = r["doc_tokens"]
    assert sorted(pieces) == ids(before)
    for i, own in pieces.items():
        at = 0
        for start, n in sorted(own):
            assert start == at
            at += n
        assert at == ends[i]


def test_run_gives_the_last_stage(spark, sf, stages):
    columns = ["doc_id", "start", "length", "ids_crc32", "doc_tokens"]
    whole = lambda df: sorted({(r["doc_id"], r["doc_tokens"]) for r in df.select(*columns).collect()})
    assert whole(corpus_pipeline.run(spark, sf)) == whole(stages["packing"][1])


def test_near_dedup_edges(spark):
    base = [f"word{i}" for i in range(100)]
    text = lambda n: " ".join([*base[:n], "other", *base[n + 1 :]])
    rows = [(5, " ".join(base)), (3, text(50)), (9, text(99)), (None, text(0)), (7, " ".join(base[:60])), (8, None), (10, ""), (11, None), (5, "a text of its own with the same id"), (12, "few words"), (13, "few words"), (14, "Few  words")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted(((r["doc_id"], r["text"]) for r in simhash_dedup.keep_one(docs).collect()), key=repr)
    assert got == sorted([rows[1], rows[4], rows[5], rows[8], rows[9]], key=repr)
    assert simhash_dedup.keep_one(docs.limit(0)).count() == 0


def test_near_dedup_of_boilerplate(spark):
    """Texts that share most of a bucket's passage: every planted pair is found, and nothing else goes."""
    shared, rows = words(140, 1, 10**6), []
    for i in range(300):
        own = words(39, 100 + i, 10**6).split()
        rows += [(2 * i, f"{shared} {' '.join(own)}"), (2 * i + 1, f"{shared} {' '.join(own[:-8])} {words(8, 5000 + i, 10**6)}")]
    home = plain_groups(rows)
    assert len(set(home.values())) < 302
    assert ids(simhash_dedup.keep_one(spark.createDataFrame(rows, "doc_id long, text string").repartition(6))) == sorted(set(home.values()))


def test_forest_connects_what_is_alike():
    """The groups that a bucket's members end in, against all pairs, whatever groups they begin in."""
    import numpy as np

    from parkwright.llm import shingles

    r = np.random.default_rng(3)
    for trial in range(20):
        base = [set(r.integers(0, 400, 40).tolist()) for _ in range(6)]
        sets = [set(list(base[k])[: int(r.integers(30, 41))]) | set(r.integers(400, 10**6, int(r.integers(0, 6))).tolist()) for k in r.integers(0, 6, 60)] + [{7}, {7}]
        groups = [bytes([int(x)]) for x in r.integers(0, 62 if trial % 2 else 20, 62)]

        def ends(pairs):
            home = list(groups)
            for i, j in pairs:
                a, b = home[i], home[j]
                home = [a if h == b else h for h in home]
            return [home.index(h) for h in home]

        every = [(i, j) for i in range(62) for j in range(i) if 5 * len(sets[i] & sets[j]) >= 4 * len(sets[i] | sets[j])]
        found = shingles.forest([np.array(sorted(s), np.int64) for s in sets], groups)
        assert ends(found) == ends(every) and len(found) < 62 and all((max(p), min(p)) in every for p in found)


def test_buckets_in_blocks(spark, monkeypatch):
    """Buckets of more members than a block: what is alike meets in some pair of blocks."""
    from parkwright.llm import shingles

    monkeypatch.setattr(shingles, "BLOCK", 16)
    shared, texts = words(60, 2, 10**6), []
    for i in range(80):
        own = words(14, 900 + i // 2, 10**6)
        texts.append((f"k{i:02}".encode(), f"{shared} {own}{' tail' * (i % 2)}".encode()))
    table = spark.createDataFrame([(bytearray(k), bytearray(t), "x") for k, t in texts], "key binary, text binary, root string")
    one = spark.createDataFrame([(bytearray(k), 1) for k, _ in texts], "key binary, bucket long")
    found = {(bytes(r["a"]), bytes(r["b"])) for r in shingles.inside(table, one, spark.createDataFrame([], "node binary, root binary")).collect()}
    sets = {k: set(shingles.shingles(t).tolist()) for k, t in texts}
    alike = {(a, b) for a in sets for b in sets if a < b and 5 * len(sets[a] & sets[b]) >= 4 * len(sets[a] | sets[b])}
    assert found <= alike

    def roots(pairs):
        home = {k: k for k in sets}
        for a, b in pairs:
            x, y = home[a], home[b]
            home = {k: min(x, y) if v in (x, y) else v for k, v in home.items()}
        return home

    assert roots(found) == roots(alike) and len(set(roots(alike).values())) < 80


def test_one_id_with_two_texts(spark):
    """The unique text of a shared id stays, and the copy goes; of repeated rows one stays, that of the least other columns."""
    a, b = " ".join(f"a{i}" for i in range(40)), " ".join(f"b{i}" for i in range(40))
    rows = [(1, a, 2), (5, a, 1), (5, b, 4), (5, b, 3), (None, b, 0), (None, "alone", 9), (None, "alone", 8)]
    got = simhash_dedup.keep_one(spark.createDataFrame(rows, "doc_id long, text string, _id int")).collect()
    assert sorted(map(tuple, got), key=repr) == sorted([(1, a, 2), (5, b, 3), (None, "alone", 8)], key=repr)


def test_sequences_follow_the_mix(spark, sf):
    """On the mixing stage's own rows, in several files: sequences come in the order of their documents, which stand near each other in the mix."""
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        mixed = cut(corpus_pipeline.mix_sources(spark, docs, sf), "mixed")
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    files = {r["f"]: r["ids"] for r in mixed.groupBy(F.input_file_name().alias("f")).agg(F.collect_list("doc_id").alias("ids")).collect()}
    at = {r["doc_id"]: r["position"] for r in mixing.mix(docs).collect()}
    assert len(files) > 4 and all(sorted(at[i] for i in own) == list(range(min(at[i] for i in own), min(at[i] for i in own) + len(own))) for own in files.values())
    first, members = {}, defaultdict(set)
    for r in corpus_pipeline.pack_sequences(spark, mixed, sf).collect():
        first[r["sequence_id"]] = min(at[r["doc_id"]], first.get(r["sequence_id"], at[r["doc_id"]]))
        members[r["sequence_id"]].add(r["doc_id"])
    assert sorted(first) == list(range(len(first))) and [first[s] for s in sorted(first)] == sorted(first.values())
    # a sequence takes its documents from one file, or from two at a seam
    home = {i: f for f, own in files.items() for i in own}
    assert set().union(*members.values()) == set(at)
    assert sum(len({home[i] for i in own}) == 1 for own in members.values()) > 0.5 * len(members)


def test_stages_on_odd_rows(spark, sf):
    """Every stage over nulls, empty and long texts, repeated rows and extra columns with clashing names, and over no rows."""
    long, base = words(60_000, 3, 30_000), words(90, 5)
    texts = [None, "", " \n ", "one", base, base, base + " end", long, words(120, 9), "x" * 20_000, "<|endoftext|> text", words(80, 11) + "\n" + words(80, 12)]
    rows = [(i, t, None if i % 4 == 0 else "en", None if i % 5 == 0 else f"s{i % 3}", None, 1.0, "k", "f", 7, "p") for i, t in enumerate(texts)]
    rows += [rows[4], rows[4], (None, words(70, 20), "en", None, 1, None, None, None, None, None)]
    schema = "doc_id long, text string, lang string, source string, n_chars long, score double, key string, fp string, position int, sequence_id string"
    for docs in (spark.createDataFrame(rows, schema).repartition(3), spark.createDataFrame([], schema)):
        n, got = docs.count(), {}
        for name, stage in corpus_pipeline.STAGES:
            after = stage(spark, docs, sf)  # each on all the rows, whatever the one before it would leave
            got[name] = after.collect()
            assert after.columns == docs.columns or name == "packing"
            assert n or not got[name]
        assert {r["doc_id"] for r in got["packing"]} == {r["doc_id"] for r in docs.select("doc_id").collect()}
        if n:
            # one of the texts without words, one of the copies of base, and the others each
            assert sorted(str(r["doc_id"]) for r in got["simhash near-dedup"]) == sorted(["0", "3", "4", "7", "8", "9", "10", "11", "None"])
            assert len(got["source mixing"]) == n and got["source mixing"][-1]["doc_id"] is None
