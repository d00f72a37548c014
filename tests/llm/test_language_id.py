"""Cross-parsing against plain substring search, held-out accuracy, and odd rows."""

import random
import zlib

import numpy as np
from pyspark.sql import functions as F

from parkwright.llm import language_id as L
from parkwright.llm import queries as q


def plain_phrases(text, learnt):
    """Longest matches one after the other, by searching the learnt text; phrases end with their block."""
    n = 0
    for start in range(0, len(text), L.BLOCK):
        block, at = text[start : start + L.BLOCK], 0
        while at < len(block):
            size = 1
            while at + size < len(block) and block[at : at + size + 1] in learnt:
                size += 1
            at, n = at + size, n + 1
    return n


def test_phrases_by_substring_search():
    r = random.Random(5)
    word = lambda k: "".join(r.choice("abcdefgh"[:k]) for _ in range(r.randrange(1, 9)))
    learnt = {"x": " ".join(word(4) for _ in range(600)).encode(), "y": " ".join(word(8) for _ in range(600)).encode(), "z": b"q"}
    model = L.Model(learnt)
    texts = [" ".join(word(k) for _ in range(n)).encode() for k, n in ((4, 50), (8, 2500), (8, 1), (6, 300))] + [b"", b"\xc3\xa9 zz a", b"q" * 9000]
    costs = model.costs(texts)
    for i, t in enumerate(texts):
        for k, name in enumerate(model.names):
            assert np.isclose(costs[i, k], plain_phrases(t, learnt[name]) * np.log2(max(len(learnt[name]), 2)))


def test_automaton_knows_every_substring():
    r = random.Random(3)
    text = bytes(r.choice(b"abc") for _ in range(60))
    moves = L.suffix_automaton(text)
    assert len(moves) <= 2 * len(text)
    for a in range(60):
        at = 0
        for b in text[a:]:
            at = moves[at][b]
    paths = lambda at: 1 + sum(paths(x) for x in moves[at].values())
    assert paths(0) == len({text[a:b] for a in range(60) for b in range(a + 1, 61)}) + 1


def test_op12_held_out(spark, sf):
    langs = {r["doc_id"]: (r["lang"], r["text"]) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    got = q.op12_language_id(spark, sf).collect()
    assert sorted(r["doc_id"] for r in got) == sorted(langs)
    right = []
    for r in got:
        lang, text = langs[r["doc_id"]]
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1) and 0 <= r["score"] <= 1
        assert (r["lang_pred"] == "und") == (not any(c.isalpha() for c in text or ""))
        right += [r["lang_pred"] == lang] if r["held_out"] and lang and r["lang_pred"] != "und" else []
    assert len(right) > 200 and np.mean(right) >= 0.99


def test_odd_rows(spark):
    docs = [(i, f"the {w} of the land and the {w}", "en") for i, w in enumerate(["house", "tree", "stone", "river", "hill"] * 4)] + [(100 + i, f"der {w} von dem Land und der {w}", "de") for i, w in enumerate(["Baum", "Stein", "Fluss", "Hügel", "Haus"] * 4)]
    odd = [(None, None, None), (None, "the land", "en"), (900, "", "en"), (901, "12 ; 3 — ½", "en"), (902, "THE LAND OF THE RIVER", None), (902, "THE LAND OF THE RIVER", None), (903, "é", None), (904, "the land of the river " * 40_000, None), (905, "日本", None)]
    rows = spark.createDataFrame([(*d, "h", 1, 2.0) for d in docs + odd], "doc_id long, text string, lang string, h string, bytes int, score double").repartition(3)
    got = L.identify(rows, L.learn(rows)).collect()
    assert len(got) == len(rows.collect())
    by = {(r["doc_id"]): r for r in got}
    assert by[900]["lang_pred"] == by[901]["lang_pred"] == "und" and by[901]["score"] == 0
    assert by[902]["lang_pred"] == "en" and by[902]["score"] > 0.5 and by[903]["lang_pred"] in ("de", "en") and by[905]["lang_pred"] in ("de", "en")
    assert [r["lang_pred"] for r in got if r["doc_id"] == 902] == ["en", "en"]
    empty = rows.limit(0)
    assert L.identify(empty, L.learn(empty)).collect() == [] and L.learn(empty).names == []
    assert {(r["lang_pred"], r["score"]) for r in L.identify(rows, L.learn(empty)).collect()} == {("und", 0.0)}
    one = L.learn(rows.where("lang = 'en'"))
    assert one.names == ["en"] and L.identify(rows.where("doc_id = 902"), one).first()["score"] == 1.0


def test_sample_is_bounded_and_fills(spark):
    """A share of bytes for each language, whatever it holds: many short texts, copies of one, or very long ones only."""
    rows = spark.range(9000).selectExpr("id * 3 as doc_id", "case when id % 3 = 0 then concat('short text ', id) when id % 3 = 1 then if(id % 2 = 0, 'the same', concat('x', id)) else repeat(concat('long', id, ' '), 9000) end as text", "concat('l', id % 3) as lang")
    got = L.sample(rows, 4000, 9000).groupBy("lang", "share").agg(F.sum(F.octet_length("text")).alias("n"), F.count(F.lit(1)).alias("k"), F.count_distinct("text").alias("d")).collect()
    assert {r["lang"] for r in got} == {"l0", "l1", "l2"}
    for r in got:
        assert r["share"] == 3000 and r["n"] >= 3000 and r["k"] == r["d"] and (r["k"] == 1 if r["lang"] == "l2" else r["n"] < 3100)
    learnt = L.learn(rows, 4000, 9000)
    assert [x.size <= 3000 for x in learnt.languages] == [True] * 3
