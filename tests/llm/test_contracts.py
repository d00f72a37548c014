"""Every registered query against a plain version, over whole tables."""

import base64
import hashlib
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
import xxhash

from parkwright.llm import queries as q

WORD = re.compile(r"[^\x20\x09-\x0D]+")


@pytest.fixture(scope="module")
def docs(spark, sf):
    return [r.asDict() for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]


def test_op1_top_k(spark, sf):
    rows = spark.read.parquet(f"{sf}/embeddings.parquet").collect()
    x = np.floor(256 * np.array([r["embedding"] for r in rows], np.float64)).astype(np.int64)
    ids, want = np.array([r["vec_id"] for r in rows]), set()
    for i in np.flatnonzero(ids % 50 == 0):
        scores = x @ x[i]
        best = sorted((-int(s), int(v)) for s, v in zip(scores, ids, strict=True) if v != ids[i])[:5]
        want |= {(int(ids[i]), k + 1, v, -s) for k, (s, v) in enumerate(best)}
    assert {tuple(r) for r in q.op1_topk_search(spark, sf).collect()} == want


def plain_rules(text):
    w = WORD.findall(text or "")
    lines = [x for x in (text or "").split("\n") if WORD.search(x)]
    grams, marked = Counter(zip(w, w[1:], w[2:], strict=False)), set()
    for i in range(len(w) - 2):
        if grams[w[i], w[i + 1], w[i + 2]] > 1:
            marked |= {i, i + 1, i + 2}
    failed = len(w) < 50 or 100 * len(marked) > 50 * len(w)
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), len(marked), failed


def test_op2_base_and_verdict(spark, sf, docs):
    got = {r["doc_id"]: r for r in q.op2_quality_rules(spark, sf).collect()}
    assert len(got) == len(docs)
    for d in docs:
        r = got[d["doc_id"]]
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"], r["base_failed"]) == plain_rules(d["text"])
        assert not (r["base_failed"] and r["kept"])
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    good = [got[i]["kept"] for i, y in labels.items() if y and not got[i]["base_failed"]]
    bad = [got[i]["kept"] for i, y in labels.items() if not y]
    assert sum(good) >= 0.98 * len(good) and sum(bad) <= 0.02 * len(bad)


def plain_fingerprint(text):
    w = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    w = WORD.findall(w)
    shingles = [" ".join(w[i : i + 3]) for i in range(len(w) - 2)] or ([" ".join(w)] if w else [])
    h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def plain_components(fps):
    ids, values = list(fps), np.array(list(fps.values()), np.uint64)
    root = {i: i for i in ids}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for k, i in enumerate(ids):
        for j in np.flatnonzero(np.bitwise_count(values ^ values[k]) <= 3):
            a, b = find(i), find(ids[j])
            root[max(a, b)] = min(a, b)
    return {i: find(i) for i in ids}


def test_op3_fingerprints_and_components(spark, sf, docs):
    got = {r["doc_id"]: r for r in q.op3_simhash_dedup(spark, sf).collect()}
    fps = {d["doc_id"]: plain_fingerprint(d["text"]) for d in docs}
    assert {i: r["fingerprint"] for i, r in got.items()} == {i: f"{v:016x}" for i, v in fps.items()}
    assert {i: r["component_id"] for i, r in got.items()} == plain_components(fps)


def test_op4_shards(spark, sf, docs):
    got = {r["doc_id"]: r for r in q.op4_sharding(spark, sf).collect()}
    assert len(got) == len(docs)
    shards, slots, groups = Counter(), defaultdict(list), defaultdict(set)
    for d in docs:
        r, raw = got[d["doc_id"]], (d["text"] or "").encode()
        assert (r["size"], r["text_crc32"], r["law"], r["grown_shard"]) == (len(raw) + 16, zlib.crc32(raw), "bytes", None)
        shards[r["shard"]] += r["size"]
        slots[r["shard"]].append(r["slot"])
        groups[raw].add(r["shard"])
    assert set(shards) == set(range(40)) and all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert all(len(s) == 1 for s in groups.values())
    assert max(shards.values()) <= 1.05 * min(shards.values())


def test_op5_classifier(spark, sf):
    got = {r["doc_id"]: r for r in q.op5_quality_classifier(spark, sf).collect()}
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    for i, r in got.items():
        assert r["held_out"] == (zlib.crc32(str(i).encode()) % 5 == 0)
        assert 0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.3)
    test = [(r["predicted"], labels[i]) for i, r in got.items() if r["held_out"] and i in labels]
    assert len(test) > 50 and sum(a == b for a, b in test) >= 0.97 * len(test)


def test_op5_scores_by_pairs(spark, sf, docs):
    """Every score of the query as the plain sum over all pairs of inputs."""
    from parkwright.llm import quality_fm as fm

    m = fm.train(spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet"))
    got = {r["doc_id"]: r["score"] for r in q.op5_quality_classifier(spark, sf).collect()}
    for d in docs:
        stats, at = fm.features((d["text"] or "").encode())
        x = np.r_[np.clip((stats - m.mean) / m.spread, -4, 4), np.full(len(at), 1 / np.sqrt(max(len(at), 1)))]
        rows = np.r_[np.arange(fm.STATS), at + fm.STATS]
        v = m.v[rows].astype(float) * x[:, None]
        z = m.w0 + m.w[rows].astype(float) @ x + np.triu(v @ v.T, 1).sum()
        assert abs(1 / (1 + np.exp(-z)) - got[d["doc_id"]]) < 1e-5


def test_op6_mixing(spark, sf):
    rows = sorted(q.op6_mixing(spark, sf).collect(), key=lambda r: r["position"])
    assert [r["position"] for r in rows] == list(range(1000))
    by = defaultdict(list)
    for r in rows:
        by[r["source"]].append(r)
    for own in by.values():
        assert [r["source_rank"] for r in own] == list(range(len(own)))
        assert [r["doc_id"] for r in own] == [i for _, i in sorted((hashlib.md5(str(r["doc_id"]).encode()).hexdigest(), r["doc_id"]) for r in own)]


def test_op7_warc(spark, sf):
    pages = {r["page_id"]: (r["html"] or "").encode() for r in spark.read.parquet(f"{sf}/pages.parquet").collect()}
    got = {r["page_id"]: r for r in q.op7_warc(spark, sf).collect()}
    last = {}
    for i, html in pages.items():
        last[html] = max(i, last.get(html, i))
    for i, html in pages.items():
        target = None if last[html] == i else last[html]
        want = (i, len(html), base64.b32encode(hashlib.sha1(html).digest()).decode(), "response" if target is None else "revisit", target)
        assert tuple(got[i]) == want
    assert len(got) == len(pages)


def test_op10_packing(spark, sf, docs):
    import public_tokenizers
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    ids = {d["doc_id"]: np.array([*e.ids, 0], "<u4") for d, e in zip(docs, t.encode_batch([d["text"] or "" for d in docs], add_special_tokens=False), strict=True)}
    pieces, sequences = defaultdict(list), defaultdict(list)
    for r in q.op10_packing(spark, sf).collect():
        own = ids[r["doc_id"]]
        assert r["doc_tokens"] == len(own) and r["ids_crc32"] == zlib.crc32(own[r["start"] : r["start"] + r["length"]].tobytes()) and r["length"] > 0
        pieces[r["doc_id"]].append((r["start"], r["length"]))
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
    assert set(pieces) == set(ids)
    for i, own in pieces.items():
        at = 0
        for start, n in sorted(own):
            assert start == at
            at += n
        assert at == len(ids[i])
    padding = 0
    for own in sequences.values():
        at = 0
        for offset, n in sorted(own):
            assert offset == at
            at += n
        assert at <= 1024
        padding += 0 if at & (at - 1) == 0 else 1024 - at
    assert padding == 0
