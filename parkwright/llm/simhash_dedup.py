"""SimHash near-dedup through segment bit counts.

A 64-bit fingerprint is cut into 32 segments of two bits and mapped to the bit
count of each. The Manhattan distance of two such vectors is a lower bound of the
Hamming distance. Within RADIUS = 3 of each other, two vectors are within 1 in at
least one half of their segments, so the half vectors are the cells of a grid:
each fingerprint stands in its home cell of either half, and looks into the cells
one step down; of two cells one step apart, one is a step down from the other.
All pairs that share a cell are verified exactly on the fingerprints. Inside a
cell only a spanning forest of the verified links is kept, never all pairs, so a
cell of n linked fingerprints gives at most n - 1 of them.

Scale: texts are read once and never shuffled; equal fingerprints collapse before
the grid, which is made and shuffled once. A cell of more than about BLOCK rows is cut
into blocks, and pairs of blocks are searched in separate tasks, without a cap on
partners. How many rows a cell has is estimated from the cells of one fingerprint in
SAMPLE; that decides only how a cell is cut, so no result rests on it.

``keep_one`` also takes texts as copies that share 0.8 of their five-word shingles.
Three bits of 64 find few of those (at 0.8 texts differ in about ten), and a radius of
ten or more is beyond any grid over 64 bits, so their candidates come from ``shingles``.

Defined cases: a null or empty text has fingerprint zero and links like any
other; ties of a bit (set in exactly half the shingles) give 0. Repeated rows are
returned each by ``near_duplicates``; ``keep_one`` keeps one of them. Rows that share an
id with different texts are rows of their own. Rows with a null id get a component like
others; the smallest id ignores nulls. Very long texts are hashed whole, in parts of
bounded size. Columns beyond doc_id and text are not looked at, whatever their names.
No rows in, no rows out.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parkwright.llm.components import components
from parkwright.llm.shared import cut, slices, small
from parkwright.llm.shingles import bands, minhashes, shingle_digests, shingles, similar

RADIUS, BLOCK, SAMPLE, WORDS = 3, 4096, 64, 3
#: For each byte, its eight bits as bytes of a word: adding 255 of them cannot overflow.
_LANES = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1).copy().view(np.uint64).ravel()


def fingerprint(text: bytes | None) -> int:
    """The SimHash of UTF-8 ``text``, as a signed 64-bit number."""
    words = (text or b"").lower().split()  # on bytes both know ASCII only
    if not words:
        return 0
    digests = np.frombuffer(shingle_digests(words, WORDS), np.uint8)
    n, counts = len(digests) // 8, np.zeros(64, np.int64)
    for part in range(0, n, 255 * 1024):
        lanes = _LANES[digests[8 * part : 8 * (part + 255 * 1024)]].reshape(-1, 8)
        blocks = np.add.reduceat(lanes, np.arange(0, len(lanes), 255), axis=0)
        counts += blocks.view(np.uint8).reshape(-1, 64).sum(0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * counts > n).tobytes(), "big", signed=True)


def fingerprints(docs: DataFrame) -> DataFrame:
    """(doc_id, fp) for each row of ``docs`` (doc_id, text)."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches):
            fps = [fingerprint(t.as_py()) for t in b.column(1)]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(fps, pa.int64())], names=["doc_id", "fp"])

    own = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").cast("binary").alias("text"))
    return own.mapInArrow(work, "doc_id long, fp long")


def grid(fps: DataFrame) -> DataFrame:
    """(cell, fp, home) of distinct ``fps``: home cells of either half, and those one step down."""
    even = F.lit(0x55555555)
    halves = F.array(F.expr("fp & 4294967295L"), F.expr("shiftrightunsigned(fp, 32)"))
    vectors = F.transform(halves, lambda x, half: F.struct((half.cast("long") * F.lit(1 << 32) + x - F.shiftright(x, 1).bitwiseAND(even)).alias("cell")))

    def steps(v):
        down = F.transform(F.sequence(F.lit(0), F.lit(30), F.lit(2)), lambda i: F.when(F.call_function("shiftright", v["cell"], i).bitwiseAND(F.lit(3)) > 0, v["cell"] - F.call_function("shiftleft", F.lit(1).cast("long"), i)))
        down = F.transform(F.filter(down, lambda c: c.isNotNull()), lambda c: F.struct(c.alias("cell"), F.lit(0).alias("home")))
        return F.concat(F.array(F.struct(v["cell"].alias("cell"), F.lit(1).alias("home"))), down)

    return fps.select("fp", F.explode(F.flatten(F.transform(vectors, steps))).alias("c")).select("c.cell", "fp", "c.home")


def _differing(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    # unsigned: of negative numbers numpy counts the bits of the magnitude
    return np.bitwise_count((a ^ b).view(np.uint64))


def forest(fps: np.ndarray) -> tuple[list[int], list[int]]:
    """Edges that connect ``fps`` as their links at RADIUS do, each to the first found of its tree."""
    left, a, b = np.unique(fps), [], []
    while len(left) > 1:
        root, front, left = left[0], [left[0]], left[1:]
        while front and len(left):
            near = _differing(left, np.int64(front.pop())) <= RADIUS
            if near.any():
                got = left[near].tolist()
                a += got
                b += [int(root)] * len(got)
                front += got
                left = left[~near]
    return a, b


def _forests(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Of rows sorted by (cell, lo, hi): the forest of each such item with a home row, one at a time."""
    keys, rest = ["cell", "lo", "hi"], None
    schema = {"a": np.int64, "b": np.int64}

    def links(rows: pd.DataFrame) -> pd.DataFrame:
        k, fp = rows[keys].to_numpy(), rows["fp"].to_numpy(np.int64)
        edges = np.r_[np.flatnonzero(np.r_[True, (k[1:] != k[:-1]).any(1)]), len(k)] if len(k) else np.array([0])
        sizes, a, b = np.diff(edges), [], []
        # of two rows that both look into a cell, neither has its home there to be found
        homes = np.add.reduceat(rows["home"].to_numpy(np.int64), edges[:-1]) if len(k) else sizes
        two = edges[:-1][(sizes == 2) & (homes > 0)]
        x, y = fp[two], fp[two + 1]
        near = (_differing(x, y) <= RADIUS) & (x != y)
        for i in np.flatnonzero((sizes > 2) & (homes > 0)):
            p, q = forest(fp[edges[i] : edges[i + 1]])
            a += p
            b += q
        return pd.DataFrame({"a": np.r_[x[near], np.array(a, np.int64)], "b": np.r_[y[near], np.array(b, np.int64)]}).astype(schema)

    for rows in batches:
        rows = rows if rest is None else pd.concat([rest, rows], ignore_index=True)
        if not len(rows):
            continue
        # the last item may go on in the next batch
        last = (rows[keys] == rows[keys].iloc[-1]).all(axis=1).to_numpy()
        yield links(rows[~last])
        rest = rows[last]
    if rest is not None:
        yield links(rest)


def links(fps: DataFrame) -> DataFrame:
    """(a, b): edges between distinct ``fps`` (fp) that connect them as all links at RADIUS do."""
    seen = grid(fps.where(F.pmod(F.xxhash64("fp"), F.lit(SAMPLE)) == 0)).groupBy("cell").agg(F.count(F.lit(1)).alias("n"))
    dense = cut(seen.where(F.col("n") * SAMPLE > BLOCK).select("cell", F.ceil(F.col("n") * SAMPLE / BLOCK).cast("int").alias("blocks")), "dense")
    rows = grid(fps).join(small(dense), "cell", "left").withColumn("blocks", F.coalesce("blocks", F.lit(1)))
    own = F.pmod(F.xxhash64("fp"), F.col("blocks")).cast("int")
    pairs = F.transform(F.sequence(F.lit(0), F.col("blocks") - 1), lambda j: F.struct(F.least(j, F.col("own")).alias("lo"), F.greatest(j, F.col("own")).alias("hi")))
    items = rows.withColumn("own", own).select("cell", "fp", F.col("home").cast("byte").alias("home"), F.explode(pairs).alias("p")).select("cell", "p.lo", "p.hi", "fp", "home")
    return items.repartition("cell", "lo", "hi").sortWithinPartitions("cell", "lo", "hi").mapInPandas(_forests, "a long, b long")


def near_duplicates(docs: DataFrame) -> DataFrame:
    """(doc_id, fp, component_id) for each row of ``docs``; component_id is the smallest doc_id reachable."""
    own = cut(fingerprints(docs), "fingerprints")
    firsts = cut(own.groupBy("fp").agg(F.min("doc_id").alias("first"), F.count(F.lit(1)).alias("n")), "firsts")
    roots = cut(components(links(firsts.select("fp"))), "roots")
    linked = cut(firsts.alias("f").join(roots.alias("r"), F.col("f.fp") == F.col("r.node")).select("f.fp", "f.first", "r.root"), "linked")
    least = cut(linked.groupBy("root").agg(F.min("first").alias("least")), "least")
    linked = linked.join(least, "root").select("fp", "least")
    # a fingerprint of one row, without links, needs no label
    several = firsts.alias("f").join(linked.alias("l"), "fp", "left").where("n > 1 or least is not null")
    labels = cut(several.select("fp", F.coalesce("least", "first").alias("component_id")), "labels")
    return own.join(labels, "fp", "left").select("doc_id", "fp", F.coalesce("component_id", "doc_id").alias("component_id"))


def _scanned(docs: DataFrame) -> DataFrame:
    """(doc_id, key, fp, size, bands) for each row of ``docs``, in one pass over its texts; size is the number of shingles."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches):
            texts = b.column(2).to_pylist()
            fps = pa.array([fingerprint(t) for t in texts], pa.int64())
            marks = [(len(s), bands(minhashes(s)) if len(s) else []) for s in map(shingles, texts)]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), fps, pa.array([n for n, _ in marks], pa.int32()), pa.array([m for _, m in marks], pa.list_(pa.int64()))], names=["doc_id", "key", "fp", "size", "bands"])

    return _keyed(docs).mapInArrow(work, "doc_id long, key binary, fp long, size int, bands array<long>")


def _key(text: Column) -> Column:
    """128 bits of the SHA-256 of a text: texts that differ don't meet under one key."""
    return F.unhex(F.left(F.sha2(text.cast("binary"), 256), F.lit(32)))


def _keyed(docs: DataFrame) -> DataFrame:
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), _key(text).alias("key"), text.cast("binary").alias("text"))


def keep_one(docs: DataFrame) -> DataFrame:
    """``docs`` with one row of each group of near copies, that of the smallest doc_id; a null id comes after others.

    Copies are texts whose fingerprints link, or that share 0.8 of their five-word
    shingles. Texts that share an id go by 128 bits of their digest. Of rows that repeat id and text,
    that of the least other columns stays.
    """
    own = cut(_scanned(docs), "scanned")
    # one text speaks for all of its fingerprint
    firsts = cut(own.groupBy("fp").agg(F.min("key").alias("first"), F.max("key").alias("last")), "firsts")
    same = own.join(firsts.where("first < last"), "fp").select(F.col("first").alias("a"), F.col("key").alias("b"))
    ends = links(firsts.select("fp")).join(firsts.select(F.col("fp").alias("a"), F.col("first").alias("ka")), "a").join(firsts.select(F.col("fp").alias("b"), F.col("first").alias("kb")), "b")
    near = ends.select(F.least("ka", "kb").alias("a"), F.greatest("ka", "kb").alias("b"))
    known = cut(same.unionByName(near).where("a < b").distinct(), "linked")
    groups = similar(_keyed(docs), own.select("key", "size", "bands"), known)

    order = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "key")
    keys = own.groupBy("doc_id", "key").agg(F.count(F.lit(1)).alias("n"))
    keys = cut(keys.alias("k").join(groups.alias("g"), F.col("k.key") == F.col("g.node"), "left").select("doc_id", "key", "n", F.coalesce("root", "key").alias("root")), "keys")
    best = cut(keys.groupBy("root").agg(F.min(order).alias("best")), "best")
    judged = cut(keys.join(best, "root").withColumn("lost", F.col("best") != order).where("lost or n > 1").select("doc_id", "key", "lost"), "judged")
    names = [f"_c{i}" for i in range(len(docs.columns))]
    tagged = docs.select(*[F.col(c).alias(n) for c, n in zip(docs.columns, names, strict=True)], F.col("doc_id").cast("long").alias("_id"), _key(F.coalesce(F.col("text").cast("string"), F.lit(""))).alias("_key")).alias("t")
    on = lambda of: (F.col("t._key") == F.col(f"{of}.key")) & F.col("t._id").eqNullSafe(F.col(f"{of}.doc_id"))
    kept = tagged.join(small(judged).alias("j"), on("j"), "left_anti").select(*names)
    twice = judged.where("not lost")
    if not twice.isEmpty():
        rows = F.struct(*names)
        again = tagged.join(small(twice).alias("w"), on("w")).groupBy("t._id", "t._key").agg(F.min_by(rows, F.to_json(rows)).alias("r"))
        kept = kept.unionByName(again.select("r.*"))
    return kept.select(*[F.col(n).alias(c) for n, c in zip(names, docs.columns, strict=True)])
