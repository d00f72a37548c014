"""The filter audit against filters run one after the other over documents."""

import re
from collections import Counter, defaultdict
from itertools import permutations

from parkwright.llm import filter_audit
from parkwright.llm import queries as q

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plain_audit(docs, labels):
    """Each order run step by step over all documents (doc_id, text, source); labels are (doc_id, quality, toxic)."""
    first, good, toxic, parts = {}, set(), set(), defaultdict(list)
    for i, text, _ in docs:
        if i is not None:
            first[text or ""] = min(i, first.get(text or "", i))
    for i, quality, bad in labels:
        good |= {i} if quality == 1 and i is not None else set()
        toxic |= {i} if bad == 1 and i is not None else set()
    for i, text, source in docs:
        t = text or ""
        w = WORD.findall(t)
        fails = {n for n, c in zip("ABCDE", [len(w) < 50, 100 * len(set(w)) < 65 * len(w), 100 * len(re.findall("[A-Z]", t)) > 5 * len(t), bool(re.search(r"[#$%&*|]", t)), i is not None and first[t] < i], strict=True) if c}
        parts[source or ""].append((fails, i in good, i in toxic))
    out = set()
    for part, rows in parts.items():
        steps, shapley = [], Counter()
        for order in permutations("ABCDE"):
            left = rows
            for k, f in enumerate(order):
                gone, left = [x for x in left if f in x[0]], [x for x in left if f not in x[0]]
                shapley[f] += len(gone)
                steps.append((part, "".join(order), k + 1, len(left), len(gone), sum(f in x[0] for x in rows) - len(gone), sum(x[0] == {f} for x in rows), sum(x[1] for x in gone), sum(x[2] for x in gone)))
        out |= {(*s, shapley[s[1][s[2] - 1]]) for s in steps}
    return out


def test_op11_over_the_table(spark, sf):
    read = lambda t, *c: [tuple(r) for r in spark.read.parquet(f"{sf}/{t}.parquet").select(*c).collect()]
    got = [tuple(r) for r in q.op11_filter_audit(spark, sf).collect()]
    assert set(got) == plain_audit(read("documents", "doc_id", "text", "source"), read("labels", "doc_id", "quality", "toxic")) and len(got) == len(set(got))


def test_odd_rows(spark):
    long = " ".join(f"word{i}" for i in range(90_000))
    same = "Ab c | d"
    docs = [(1, None, None), (2, "", "s"), (2, "", "s"), (None, "", "s"), (None, same, "s"), (7, same, None), (5, same, "s"), (9, long, ""), (10, "é" * 40 + "AB", "s"), (11, "é" * 40 + "ABC", "s"), (12, "x " * 50, "s"), (13, "\x1ca\x85b c", "t")]
    labels = [(1, 1, 0), (1, 0, 1), (None, 1, 1), (5, None, 1), (9, 1, None), (99, 1, 1)]
    rows = spark.createDataFrame([(*d, "x", 1, True) for d in docs], "doc_id long, text string, source string, digest string, mask int, good boolean").repartition(3)
    marks = spark.createDataFrame([(*x, "p") for x in labels], "doc_id long, quality int, toxic int, part string")
    got = [tuple(r) for r in filter_audit.audit_documents(rows, marks).collect()]
    assert set(got) == plain_audit(docs, labels) and len(got) == 3 * 600
    assert filter_audit.audit_documents(rows.limit(0), marks).collect() == []
    assert {r["good_lost"] for r in filter_audit.audit_documents(rows, marks.limit(0)).collect()} == {0}


def test_any_number_of_filters(spark):
    """Three filters of another table: 6 orders of 3 steps."""
    rows = spark.createDataFrame([("p", m, m == 5, m == 2) for m in (0, 1, 1, 3, 5, 5, 2, 7)], "part string, mask int, good boolean, toxic boolean")
    got = {(r["filter_order"], r["step"]): r for r in filter_audit.audit(rows, "XYZ").collect()}
    assert len(got) == 18 and got["XYZ", 1]["removed"] == 6 and got["ZYX", 2]["removed"] == 2 and got["ZYX", 2]["redundant"] == 1
    assert got["YZX", 2]["good_lost"] == 2 and got["XYZ", 2]["toxic_lost"] == 1 and got["XYZ", 3]["kept"] == 1 and got["XYZ", 1]["unique_fails"] == 2


def test_one_text_held_by_most(spark):
    """A text of most rows: all but its least id fail E, in whatever part they are."""
    rows = spark.range(4000).selectExpr("id + 1 as doc_id", "if(id % 10 = 0, concat('t', id), 'same') as text", "if(id % 2 = 0, 'a', 'b') as source")
    marks = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    got = {(r["part"], r["filter_order"], r["step"]): r for r in filter_audit.audit_documents(rows, marks).collect()}
    assert got["a", "EABCD", 1]["removed"] == 1600 and got["b", "EABCD", 1]["removed"] == 1999
