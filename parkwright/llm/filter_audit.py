"""What each filter does in each order of filters, from one count of failure masks.

A document's failures are bits of a mask. Documents are counted by part and mask
once; a subset-zeta transform turns the counts into those of documents that fail no
filter outside a subset, so the survivors of every set of filters are one lookup. A
step of an order is the difference between two neighbouring sets; what a filter
would remove alone, what only it removes and its Shapley sum are differences too. The
same holds for counts of labelled documents. No order is ever run over documents.

Filters of ``failures`` read a text once. A copy (filter E) is a document whose text
some smaller doc_id has: the first of each text is found by its 256-bit digest, and a
document is looked up by (digest, doc_id), so a text that a third of all documents
share is not a key that one task gets.

Scale: texts are read once, in their own tasks, and never shuffled. The least doc_id of
a digest, the labels of a doc_id and the counts of masks pre-aggregate before they move.
A part's counts are 2^n numbers, and its result n * n! rows, whatever the number of documents.

Defined cases: a null text is the empty one; a null part is the empty string. A null
doc_id is smaller than none and larger than none, so it is no copy and makes none, and
it has no label. Rows that repeat a doc_id are counted each, and do not make each other
copies. Of several labels of a doc_id any 1 counts; null labels don't. Very long texts are
read whole, in the memory of their task. Columns beyond those named are not looked at,
whatever their names. No rows in, no rows out.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import sha256
from itertools import permutations
from math import factorial

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parkwright.llm.shared import cut, let, slices

FILTERS = "ABCDE"
LEAST_WORDS, LEAST_DISTINCT_PCT, MOST_UPPER_PCT = 50, 65, 5
UPPER, MARKS = bytes(range(65, 91)), b"#$%&*|"
#: Bytes of UTF-8 that go on with a character.
_CONTINUED = bytes(range(0x80, 0xC0))
COUNTS = ("n", "good", "toxic")


def failures(text: bytes) -> int:
    """The mask of filters A to D that UTF-8 ``text`` fails; bytes split at ASCII white space only."""
    words, without = text.split(), text.translate(None, UPPER)
    upper, points = len(text) - len(without), len(text.translate(None, _CONTINUED))
    short, same = len(words) < LEAST_WORDS, 100 * len(set(words)) < LEAST_DISTINCT_PCT * len(words)
    return short | same << 1 | (100 * upper > MOST_UPPER_PCT * points) << 2 | (len(text.translate(None, MARKS)) < len(text)) << 3


def scanned(docs: DataFrame, part: str) -> DataFrame:
    """(doc_id, part, digest, mask) of each row of ``docs``, with the filters of one text."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches):
            texts = [t or b"" for t in b.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array([sha256(t).digest() for t in texts], pa.binary()), pa.array(map(failures, texts), pa.int32())], names=["doc_id", "part", "digest", "mask"])

    own = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col(part).cast("string"), F.lit("")).alias("part"), F.col("text").cast("string").cast("binary").alias("text"))
    return own.mapInArrow(work, "doc_id long, part string, digest binary, mask int")


def marked(docs: DataFrame, labels: DataFrame, part: str = "source") -> DataFrame:
    """(part, mask, good, toxic) of each row of ``docs``: what it fails, copies included, and whether its labels say so."""
    own = cut(scanned(docs, part), "scanned")
    firsts = own.where("doc_id is not null").groupBy("digest").agg(F.min("doc_id").alias("first")).alias("f")
    is_one = lambda c: F.max(F.coalesce(F.col(c) == 1, F.lit(False))).alias(c)
    known = labels.where("doc_id is not null").groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(is_one("quality"), is_one("toxic")).alias("l")
    rows = own.alias("d").join(firsts, (F.col("d.digest") == F.col("f.digest")) & (F.col("d.doc_id") == F.col("f.first")), "left")
    rows = rows.join(known, F.col("d.doc_id") == F.col("l.doc_id"), "left")
    copy = F.col("d.doc_id").isNotNull() & F.col("f.first").isNull()
    yes = lambda c: F.coalesce(F.col(f"l.{c}"), F.lit(False))
    return rows.select("d.part", (F.col("d.mask") + F.when(copy, 1 << FILTERS.index("E")).otherwise(0)).alias("mask"), yes("quality").alias("good"), yes("toxic").alias("toxic"))


def subset_sums(counts: Column, bits: int) -> Column:
    """The subset-zeta transform of an array by mask: at each mask, the sum over all masks within it."""

    def with_bit(bit: int):
        zero = F.lit(0).cast("long")
        return lambda a: F.transform(a, lambda x, i: x + F.when(i.bitwiseAND(F.lit(bit)) != 0, F.get(a, i - bit)).otherwise(zero))

    for k in range(bits):
        counts = let(counts, with_bit(1 << k))
    return counts


def _shapley(sums: Column, bits: int, k: int) -> Column:
    """What filter ``k`` removes, summed over all orders: each set before it stands in |set|! (bits - 1 - |set|)! of them."""
    every, weights = (1 << bits) - 1, F.lit([factorial(n) * factorial(bits - 1 - n) if n < bits else 0 for n in range(bits + 1)]).cast("array<long>")
    removed = lambda s: F.get(sums, F.lit(every) - s) - F.get(sums, F.lit(every - (1 << k)) - s)
    sets = F.filter(F.sequence(F.lit(0), F.lit(every)), lambda s: s.bitwiseAND(F.lit(1 << k)) == 0)
    return F.aggregate(sets, F.lit(0).cast("long"), lambda a, s: a + F.get(weights, F.bit_count(s)) * removed(s))


def audit(rows: DataFrame, filters: str = FILTERS) -> DataFrame:
    """For each part of ``rows`` (part, mask, good, toxic), each order of ``filters`` and each step of it, what the step does.

    (part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost, shapley);
    bit k of a mask says that the k-th filter fails.
    """
    bits, every = len(filters), (1 << len(filters)) - 1
    by_mask = rows.groupBy("part", "mask").agg(F.count(F.lit(1)).alias("n"), F.count_if("good").alias("good"), F.count_if("toxic").alias("toxic"))
    # at most 2^bits entries to a part
    parts = by_mask.groupBy("part").agg(F.map_from_entries(F.collect_list(F.struct("mask", F.struct(*COUNTS)))).alias("m"))
    masks, zero = F.sequence(F.lit(0), F.lit(every)), F.lit(0).cast("long")
    sums = lambda c: subset_sums(F.transform(masks, lambda i: F.coalesce(F.try_element_at("m", i)[c], zero)), bits)
    parts = parts.select("part", *[sums(c).alias(c) for c in COUNTS])
    parts = parts.withColumn("shapley", F.array(*[_shapley(F.col("n"), bits, k) for k in range(bits)]))
    orders = parts.withColumn("filter_order", F.explode(F.lit(["".join(p) for p in permutations(filters)])))
    steps = orders.select("*", F.posexplode(F.split("filter_order", "")).alias("at", "name"))
    place = lambda name: F.instr(F.lit(filters), name) - 1
    bit = lambda name: F.call_function("shiftleft", F.lit(1), place(name))
    before = F.aggregate(F.split(F.substring("filter_order", 1, F.col("at")), ""), F.lit(0), lambda a, x: a + F.when(x == "", 0).otherwise(bit(x)))
    steps = steps.withColumn("own", bit(F.col("name"))).withColumn("before", before)
    # survivors of a set are the documents that fail nothing in it: the sum over masks within the rest
    alive = lambda c, s: F.get(F.col(c), F.lit(every) - s)
    own, sofar = F.col("own"), F.col("before")
    removed = lambda c: alive(c, sofar) - alive(c, sofar + own)
    return steps.select(
        "part", "filter_order", (F.col("at") + 1).cast("int").alias("step"), alive("n", sofar + own).alias("kept"), removed("n").alias("removed"),
        (alive("n", F.lit(0)) - alive("n", own) - removed("n")).alias("redundant"), (alive("n", F.lit(every) - own) - alive("n", F.lit(every))).alias("unique_fails"),
        removed("good").alias("good_lost"), removed("toxic").alias("toxic_lost"), F.get("shapley", place(F.col("name"))).alias("shapley"),
    )


def audit_documents(docs: DataFrame, labels: DataFrame, part: str = "source") -> DataFrame:
    """The audit of filters A to E over ``docs`` (doc_id, text, part), with ``labels`` (doc_id, quality, toxic)."""
    return audit(marked(docs, labels, part))
