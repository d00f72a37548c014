"""Shards of near equal size by best-fit-decreasing packing of indivisible groups.

A group is all rows of one text. Groups are packed by their own size, largest first,
each into the bin with the tightest remaining capacity that holds it, found in a
balanced tree of remaining capacities. The capacity is the least, by bisection from
total / shards upwards, for which the bins suffice.

Groups of at least 1 / GRAIN of an even share, of which there are at most
shards * GRAIN, are listed one by one. Smaller ones are counted by their size: each size
below EXACT_BYTES is a class of its own. Larger sizes share a class with those within
1/128, and count as the largest of the class, so no bin gets more than its capacity. So
there are at most EXACT_BYTES classes and some thousands, whatever the number of groups. Best fit puts a run of items of one size into
the tightest bin until it is full, then into the next, so a class is placed in a few
steps, each a number of its groups for one bin. The groups of a class are then dealt to
bins by their rank in the order of their digests.

A group larger than an even share cannot stay whole in shards of near equal size: its
rows, which are of one size, are cut by rank into pieces that just fit a share, and
each piece is an item. Only such a group ever spans shards. A single row larger than a
share gets a shard of its own, and the others share the rest evenly.

Scale: texts are read once, for size, checksum and digest; then only narrow rows
move. Group sizes pre-aggregate. Rows of listed groups find their shard by a broadcast
whose size the parameters bound; those of the others, each a small part of a shard, by
a join on the digest; what a class gives to which bin is broadcast if it is short. Ranks are taken over ranges, so no task holds a group, a class or
a shard.

Defined cases: a null text has no bytes, checksum 0, and is in one group with
empty texts. Repeated rows are placed each, also in a group that is cut; null ids come
first in it. Very long texts are hashed in the task that reads them. Groups of equal
size go by their digest. Columns beyond doc_id and text are not looked at, whatever
their names. No rows in, no rows out; with fewer items than shards some shards stay empty.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from parkwright.llm.shared import cut, grouped_rank
from parkwright.llm.shared import small as few

SHARDS, ROW_BYTES, GRAIN, PRECISION, EXACT_BYTES, CLASS_BITS = 40, 16, 128, 20_000, 1 << 20, 8


class Tree:
    """An AA tree of (key, value) pairs, ordered; finds the least at or above a key."""

    __slots__ = ("root",)

    def __init__(self):
        self.root = None

    @staticmethod
    def _skew(t):
        if t and t[2] and t[2][1] == t[1]:
            left = t[2]
            t[2], left[3] = left[3], t
            return left
        return t

    @staticmethod
    def _split(t):
        if t and t[3] and t[3][3] and t[3][3][1] == t[1]:
            right = t[3]
            t[3], right[2] = right[2], t
            right[1] += 1
            return right
        return t

    def _add(self, t, item):
        if t is None:
            return [item, 1, None, None]
        side = 2 if item < t[0] else 3
        t[side] = self._add(t[side], item)
        return self._split(self._skew(t))

    def _drop(self, t, item):
        if t is None:
            return None
        if item != t[0]:
            side = 2 if item < t[0] else 3
            t[side] = self._drop(t[side], item)
        elif t[2] is None and t[3] is None:
            return None
        else:
            side, down = (3, 2) if t[3] else (2, 3)
            heir = t[side]
            while heir[down]:
                heir = heir[down]
            t[0] = heir[0]
            t[side] = self._drop(t[side], heir[0])
        level = min(t[2][1] if t[2] else 0, t[3][1] if t[3] else 0) + 1
        if level < t[1]:
            t[1] = level
            if t[3] and t[3][1] > level:
                t[3][1] = level
        t = self._skew(t)
        t[3] = self._skew(t[3])
        if t[3]:
            t[3][3] = self._skew(t[3][3])
        t = self._split(t)
        t[3] = self._split(t[3])
        return t

    def add(self, item) -> None:
        self.root = self._add(self.root, item)

    def drop(self, item) -> None:
        self.root = self._drop(self.root, item)

    def at_least(self, item):
        t, best = self.root, None
        while t:
            if t[0] >= item:
                best, t = t[0], t[2]
            else:
                t = t[3]
        return best


Item, Quota = tuple[int, str], tuple[int, int, int, int]


def best_fit_decreasing(items: list[Item], classes: list[tuple[int, int, int]], capacity: int, most_bins: int) -> tuple[dict[str, int], list[Quota]] | None:
    """The bin of each item name, and (class, bin, first rank, last rank + 1) of counted small items; None if the bins don't suffice.

    ``classes`` are (class, size, count); their sizes are below those of ``items``.
    """
    tree, bins, placed, quotas = Tree(), 0, {}, []

    def bin_for(size: int) -> tuple[int, int] | None:
        nonlocal bins
        found = tree.at_least((size, -1))
        if found is not None:
            tree.drop(found)
        elif size <= capacity and bins < most_bins:
            found, bins = (capacity, bins), bins + 1
        return found

    for size, name in sorted(items, key=lambda x: (-x[0], x[1])):
        if (found := bin_for(size)) is None:
            return None
        placed[name] = found[1]
        tree.add((found[0] - size, found[1]))
    for key, size, count in sorted(classes, key=lambda x: (-x[1], -x[0])):
        rank = 0
        while rank < count:
            if (found := bin_for(size)) is None:
                return None
            n = min(count - rank, found[0] // size)
            quotas.append((key, found[1], rank, rank + n))
            rank += n
            tree.add((found[0] - n * size, found[1]))
    return placed, quotas


def fewest_capacity(items: list[Item], classes: list[tuple[int, int, int]], shards: int) -> tuple[dict[str, int], list[Quota]]:
    """The packing into at most ``shards`` bins with the least capacity found, to 1 / PRECISION of an even share."""
    items, alone = sorted(items, key=lambda x: (-x[0], x[1])), {}
    total = sum(s for s, _ in items) + sum(s * n for _, s, n in classes)
    share = lambda: max(-(-total // (shards - len(alone))), 1)
    # what is larger than a share has a bin to itself; of those that are last, the first bin has more
    while len(alone) < shards - 1 and len(alone) < len(items) and items[len(alone)][0] > share():
        size, name = items[len(alone)]
        alone[name], total = shards - 1 - len(alone), total - size
    items, even, left = items[len(alone) :], share(), shards - len(alone)
    low = max(even, max((s for s, _ in items), default=0), max((s for _, s, _ in classes), default=0))
    if (best := best_fit_decreasing(items, classes, low, left)) is None:
        step = max(1, even // PRECISION)
        while (best := best_fit_decreasing(items, classes, low + step, left)) is None:
            low, step = low + step, step * 2
        high = low + step
        while high - low > max(1, even // PRECISION):
            middle = (low + high) // 2
            if (found := best_fit_decreasing(items, classes, middle, left)) is None:
                low = middle
            else:
                best, high = found, middle
    return best[0] | alone, best[1]


def size_class(size: Column) -> Column:
    """The least size of a class: a size below EXACT_BYTES, or the leading CLASS_BITS bits of one."""
    shift = F.when(size < EXACT_BYTES, 0).otherwise(F.length(F.bin(size)) - CLASS_BITS)
    return F.call_function("shiftleft", F.call_function("shiftright", size, shift), shift)


def assign(docs: DataFrame, shards: int = SHARDS) -> DataFrame:
    """(doc_id, size, text_crc32, digest, shard, slot) for each row of ``docs``."""
    spark: SparkSession = docs.sparkSession
    text = F.coalesce(F.col("text").cast("string"), F.lit("")).cast("binary")
    own = docs.select(F.col("doc_id").cast("long").alias("doc_id"), (F.octet_length(text) + ROW_BYTES).cast("long").alias("size"), F.crc32(text).alias("text_crc32"), F.unhex(F.sha2(text, 256)).alias("digest"))
    own = cut(own, "sized")
    groups = cut(own.groupBy("digest").agg(F.count(F.lit(1)).alias("n"), F.max("size").alias("row_size")).withColumn("bytes", F.col("n") * F.col("row_size")), "groups")
    total = groups.agg(F.sum("bytes")).first()[0] or 0
    share = max(1, -(-total // shards))
    small = F.col("bytes") * GRAIN < share
    # at most shards * GRAIN groups are listed
    listed = [(bytes(r["digest"]), r["n"], r["row_size"]) for r in groups.where(~small).select("digest", "n", "row_size").collect()]
    # rows to a piece; all rows of a group that a share holds
    piece = {d: n if n * size <= share else max(1, share // size) for d, n, size in listed}
    items = [(min(piece[d], n - at) * size, f"{d.hex()}/{at // piece[d]}") for d, n, size in listed for at in range(0, n, piece[d])]
    counted = groups.where(small).groupBy(size_class(F.col("bytes")).alias("class")).agg(F.count(F.lit(1)).alias("n"), F.max("bytes").alias("bytes"))
    classes = [(r["class"], r["bytes"], r["n"]) for r in counted.collect()]
    placed, quotas = fewest_capacity(items, classes, shards)

    where = [(bytearray.fromhex(name.split("/")[0]), int(name.split("/")[1]), shard) for name, shard in placed.items()]
    places = spark.createDataFrame(where, "digest binary, piece long, shard int")
    sizes = F.broadcast(spark.createDataFrame([(bytearray(d), n, piece[d]) for d, n, _ in listed], "digest binary, n long, piece_rows long"))
    rows = own.join(sizes, "digest", "left")
    whole = rows.where("n <= piece_rows").select(*own.columns, F.lit(0).cast("long").alias("piece"))
    ranked = grouped_rank(rows.where("n > piece_rows").select(*own.columns, "piece_rows"), ["digest"], ["doc_id"], "_rank")
    pieces = ranked.select(*own.columns, F.floor(F.col("_rank") / F.col("piece_rows")).alias("piece"))
    large = whole.unionByName(pieces).join(F.broadcast(places), ["digest", "piece"]).select(*own.columns, "shard")

    quota = few(spark.createDataFrame(quotas, "class long, shard int, low long, high long"), len(quotas)).alias("q")
    dealt = grouped_rank(groups.where(small).select("digest", size_class(F.col("bytes")).alias("class")), ["class"], ["digest"], "rank").alias("g")
    dealt = cut(dealt.join(quota, (F.col("g.class") == F.col("q.class")) & (F.col("g.rank") >= F.col("q.low")) & (F.col("g.rank") < F.col("q.high"))).select("g.digest", "q.shard"), "dealt")
    rest = rows.where("n is null").select(*own.columns).join(dealt, "digest").select(*own.columns, "shard")
    return grouped_rank(large.unionByName(rest), ["shard"], ["doc_id", "digest"], "slot")
