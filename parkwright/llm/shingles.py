"""Word shingles of texts: their hashes, and pairs of texts that share SIMILARITY of them.

A text's shingles are hashed to a set of numbers, and the set to BANDS x ROWS
minhashes. Texts that agree in all minhashes of a band share a bucket: at 0.8
two texts share one with a chance of 1 - (1 - 0.8^4)^16, all but 2 in 10,000. What
shares a bucket is compared by the exact Jaccard coefficient of the sets, until it is
in one group: each text first with the text that it shares most buckets with among
the ends of its buckets (the first and the last in an order that differs from band to
band; sets of too different sizes can't be alike), then ends that are still apart, and at last, in buckets that still hold several
groups, every two members of different groups. So pairs are proposed in number of the
members, and what that leaves open is decided inside the buckets without a cap.

Scale: texts are read in their own tasks; sets are made only for texts in a pair or in a
bucket of several groups. Equal texts are one node, under 128 bits of their digest. Both
sides of each join come straight from an exchange. A bucket of more than BLOCK members, or of
more than BLOCK_SHINGLES shingles in all, is cut into blocks, and each pair of blocks is searched
in a task of its own, which gives a spanning forest of the pairs it finds. Work in a bucket of n members of different groups is
n^2 counts.

Defined cases: texts of at most WORDS words are one shingle; null and empty texts
have none and are in no pair. Very long texts are hashed whole, in parts of bounded
size. Repeated rows are one node. Columns beyond those named are not looked at, whatever
their names. No rows in, no rows out.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parkwright.llm.components import components
from parkwright.llm.shared import cut, slices, small

WORDS, BANDS, ROWS, BLOCK, BLOCK_SHINGLES, SIMILARITY, SEED = 5, 16, 4, 2048, 1 << 20, (4, 5), 42
_MULTIPLIERS = np.random.default_rng(42).integers(0, 2**63, BANDS * ROWS, np.uint64) * np.uint64(2) + np.uint64(1)


def shingle_digests(words: list[bytes], size: int) -> bytes:
    """XXH64 of each run of ``size`` words, joined by spaces; of all words if they are fewer."""
    from xxhash import xxh64_digest

    if len(words) <= size:
        return xxh64_digest(b" ".join(words), SEED)
    line = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
    starts = np.r_[0, ends[: 1 - size]].tolist()[: len(words) - size + 1]
    return b"".join([xxh64_digest(line[s:e], SEED) for s, e in zip(starts, (ends[size - 1 :] - 1).tolist(), strict=True)])


def shingles(text: bytes) -> np.ndarray:
    """The distinct shingle hashes of UTF-8 ``text``, sorted."""
    words = text.lower().split()
    return np.unique(np.frombuffer(shingle_digests(words, WORDS), np.uint64)) if words else np.zeros(0, np.uint64)


def minhashes(hashes: np.ndarray) -> np.ndarray:
    least = np.full(BANDS * ROWS, 2**64 - 1, np.uint64)
    for part in range(0, len(hashes), 1024):
        np.minimum(least, (hashes[part : part + 1024, None] * _MULTIPLIERS).min(0), out=least)
    return least


def bands(least: np.ndarray) -> np.ndarray:
    """One number for each band of minhashes; equal where all of them are."""
    mixed = np.arange(1, BANDS + 1, dtype=np.uint64)
    for row in least.reshape(BANDS, ROWS).T:
        mixed = (mixed ^ (row >> np.uint64(29)) ^ row) * np.uint64(0x9E3779B97F4A7C15)
    return mixed.view(np.int64)


def _able(a, b):
    """Whether sets of these sizes may have a coefficient of SIMILARITY: the smaller can't share more than it has."""
    part, whole = SIMILARITY
    return F.least(a, b) * whole >= F.greatest(a, b) * part


def buckets(marked: DataFrame) -> DataFrame:
    """(key, size, bucket) of each key in ``marked`` (key, size, bands): texts of one bucket agree in a band."""
    rows = marked.where(F.size("bands") > 0).dropDuplicates(["key"]).select("key", "size", F.posexplode("bands").alias("band", "value"))
    return cut(rows.select("key", "size", F.xxhash64("band", "value").alias("bucket")), "buckets")


def candidates(rows: DataFrame) -> DataFrame:
    """(a, b, n): each key in ``rows`` (key, size, bucket) with the ends of its buckets whose sizes allow it, and how many buckets propose the pair."""
    order = F.struct(F.xxhash64("key", "bucket").alias("h"), "key", "size")
    ends = rows.groupBy("bucket").agg(F.min(order).alias("low"), F.max(order).alias("high")).where("low.key <> high.key")
    paired = rows.join(cut(ends, "ends"), "bucket").select("key", "size", F.explode(F.array("low", "high")).alias("o"))
    paired = paired.where((F.col("key") != F.col("o.key")) & _able(F.col("size"), F.col("o.size"))).select("key", F.col("o.key").alias("other"))
    return cut(paired.groupBy(F.least("key", "other").alias("a"), F.greatest("key", "other").alias("b")).agg(F.count(F.lit(1)).alias("n")), "pairs")


def _ends(pairs: DataFrame) -> DataFrame:
    """The keys in ``pairs``, to be broadcast if they are few."""
    return small(cut(pairs.select(F.explode(F.array("a", "b")).alias("key")).distinct(), "wanted"))


def sets_of(texts: DataFrame, keys: DataFrame) -> DataFrame:
    """(key, s): the shingles of the ``texts`` (key, text as binary) whose key is in ``keys``."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches):
            found = [shingles(t.as_py()).view(np.int64) for t in b.column(1)]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(found, pa.list_(pa.int64()))], names=["key", "s"])

    sets = texts.select("key", "text").join(keys, "key", "left_semi").mapInArrow(work, "key binary, s array<long>")
    # written, so that each join has an exchange on both sides and a text in very many pairs is split
    return cut(sets.dropDuplicates(["key"]), "sets")


def verified(texts: DataFrame, pairs: DataFrame) -> DataFrame:
    """(a, b): the ``pairs`` (a, b) of keys whose shingles have a Jaccard coefficient of at least SIMILARITY; ``texts`` has (key, text as binary)."""
    sets = sets_of(texts, _ends(pairs))
    both = pairs.join(sets.select(F.col("key").alias("a"), F.col("s").alias("sa")), "a").join(sets.select(F.col("key").alias("b"), F.col("s").alias("sb")), "b")
    shared, sizes, (part, whole) = F.size(F.array_intersect("sa", "sb")), F.size("sa") + F.size("sb"), SIMILARITY
    return cut(both.where(_able(F.size("sa"), F.size("sb")) & (shared * whole >= (sizes - shared) * part)).select("a", "b"), "verified")


def forest(sets: list[np.ndarray], groups: list[bytes]) -> list[tuple[int, int]]:
    """Pairs of ``sets`` of SIMILARITY that connect their ``groups`` as all such pairs do; what one set holds alone is in no pair."""
    part, whole = SIMILARITY
    sizes, owner = np.array([len(s) for s in sets]), np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    _, place, held = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    several = held[place] > 1
    place, owner = place[several], owner[several]
    # of each shingle, the sets that hold it; of each set, its shingles
    by_shingle = owner[np.argsort(place, kind="stable")]
    starts = np.r_[0, np.cumsum(np.where(held > 1, held, 0))]
    mine = np.searchsorted(owner, np.arange(len(sets) + 1))
    number = {g: i for i, g in enumerate(dict.fromkeys(groups))}
    root, out = np.array([number[g] for g in groups]), []
    for i in range(len(sets)):
        own = place[mine[i] : mine[i + 1]]
        if not len(own) or (root[i:] == root[i]).all():
            continue
        # of each shingle's sets those after this one
        shared = np.bincount(np.concatenate([by_shingle[starts[p] : starts[p + 1]] for p in own.tolist()]), minlength=len(sets))
        alike = (shared * whole >= (sizes + sizes[i] - shared) * part) & (root != root[i])
        alike[: i + 1] = False
        while alike.any():
            j = int(alike.argmax())
            out.append((i, j))
            root[root == root[j]] = root[i]
            alike &= root != root[i]
    return out


def _forests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of rows (bucket, lo, hi, key, root, s) sorted by their first three: each such item's forest, one at a time."""
    item, keys, roots, sets = None, [], [], []

    def links() -> pa.RecordBatch:
        found = forest(sets, roots) if len(set(roots)) > 1 else []
        return pa.RecordBatch.from_arrays([pa.array([min(keys[i], keys[j]) for i, j in found], pa.binary()), pa.array([max(keys[i], keys[j]) for i, j in found], pa.binary())], names=["a", "b"])

    for b in batches:
        values = b.column(5)
        for k, at in enumerate(zip(*(b.column(c).to_pylist() for c in range(3)), strict=True)):
            if at != item:
                if len(keys) > 1:
                    yield links()
                item, keys, roots, sets = at, [], [], []
            keys.append(b.column(3)[k].as_py())
            roots.append(b.column(4)[k].as_py())
            sets.append(values[k].values.to_numpy(zero_copy_only=False))
    if len(keys) > 1:
        yield links()


def inside(texts: DataFrame, rows: DataFrame, groups: DataFrame) -> DataFrame | None:
    """(a, b): pairs of SIMILARITY that connect members of one bucket in ``rows`` (key, bucket) across ``groups`` (node, root); None if no bucket is open.

    A bucket is open if it has several groups and more than two members; two are each other's ends.
    Where ``rows`` has size, the number of shingles, it decides with the number of members how a bucket is cut.
    """
    size = (F.col("size") if "size" in rows.columns else F.lit(0)).cast("long").alias("size")
    rooted = rows.select("bucket", "key", size).join(groups.withColumnRenamed("node", "key"), "key", "left").select("bucket", "key", "size", F.coalesce("root", "key").alias("root"))
    several = rooted.groupBy("bucket").agg(F.count(F.lit(1)).alias("n"), F.sum("size").alias("total"), F.min("root").alias("low"), F.max("root").alias("high"))
    blocks = F.least(F.col("n"), F.ceil(F.greatest(F.col("n") / BLOCK, F.col("total") / BLOCK_SHINGLES))).cast("int").alias("blocks")
    several = cut(several.where("n > 2 and low <> high").select("bucket", blocks), "open")
    if several.isEmpty():
        return None
    members = cut(rooted.drop("size").join(several, "bucket"), "members")
    sets = sets_of(texts, small(cut(members.select("key").distinct(), "wanted")))
    own = members.withColumn("own", F.pmod(F.xxhash64("key"), F.col("blocks")).cast("int"))
    pairs = F.transform(F.sequence(F.lit(0), F.col("blocks") - 1), lambda j: F.struct(F.least(j, F.col("own")).alias("lo"), F.greatest(j, F.col("own")).alias("hi")))
    items = own.select("bucket", "key", "root", F.explode(pairs).alias("p")).join(sets, "key").select("bucket", "p.lo", "p.hi", "key", "root", "s")
    return cut(items.repartition("bucket", "lo", "hi").sortWithinPartitions("bucket", "lo", "hi").mapInArrow(_forests, "a binary, b binary").distinct(), "inside")


def similar(texts: DataFrame, marked: DataFrame, known: DataFrame) -> DataFrame:
    """(node, root): groups of keys that ``known`` edges (a < b) and pairs of at least SIMILARITY in one bucket connect.

    Each key is first compared with the one it shares most buckets with; of the other
    ends only those in different groups are left to compare, and so with the buckets' other members.
    """
    rows = buckets(marked)
    pairs = candidates(rows)
    most = pairs.select(F.explode(F.array(F.struct("a", "b"), F.struct(F.col("b").alias("a"), F.col("a").alias("b")))).alias("p"), "n").groupBy("p.a").agg(F.max(F.struct("n", F.col("p.b").alias("b")))["b"].alias("b"))
    likeliest = most.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    first = cut(likeliest.join(known, ["a", "b"], "left_anti"), "likeliest")
    edges = cut(known.unionByName(verified(texts, first)), "edges")
    groups = cut(components(edges), "groups")
    rest = cut(_apart(pairs.select("a", "b"), groups).join(first, ["a", "b"], "left_anti"), "rest")
    if not rest.isEmpty():
        edges = cut(edges.unionByName(verified(texts, rest)), "edges")
        groups = cut(components(edges), "groups")
    more = inside(texts, rows, groups)
    if more is None or more.isEmpty():
        return groups
    return cut(components(edges.unionByName(more)), "groups")


def _apart(pairs: DataFrame, groups: DataFrame) -> DataFrame:
    """The ``pairs`` whose ends are in different ``groups`` (node, root)."""
    p = pairs.alias("p").join(groups.alias("g"), F.col("p.a") == F.col("g.node"), "left").select("p.a", "p.b", F.coalesce("g.root", "p.a").alias("ra")).alias("p")
    p = p.join(groups.alias("g"), F.col("p.b") == F.col("g.node"), "left").select("p.a", "p.b", "p.ra", F.coalesce("g.root", "p.b").alias("rb"))
    return p.where("ra <> rb").select("a", "b")
