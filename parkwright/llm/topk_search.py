"""Exact top-k inner-product search over a pivot-distance index.

Inner products become Euclidean distances by one more component: with M the
largest norm, a row x is extended to (x, sqrt(M*M - |x|*|x|)) and a query q to
(q, 0), so |q' - x'|^2 = |q|^2 + M^2 - 2 q.x and the highest scores are the
nearest rows. Each row is keyed by its nearest pivot and its distance to it.
Rows sorted by that key form annuli; a query expands them from the least lower
bound |d(q, pivot) - d(x, pivot)| outwards and stops when no annulus left can
hold a row at or above its k-th score. Scores are computed on whole numbers, so
the bounds (with slack for rounding) only skip work and never change a result.

Scale: rows are cut into blocks of ROW_BLOCK by range of (length, pivot, distance); a
hot pivot, or many equal vectors, spread over many blocks. A table with the least and
largest distance of each (block, pivot), about one row for each block and pivot, tells before
anything is shuffled which blocks can hold an answer of a query. Each query first visits
the block of its highest bound; only blocks that can still reach its k-th score then get
it. A task holds one block and streams the queries that came to it, so the index moves
twice whatever the number of queries, and memory is that of a block. Whole numbers under
2^24 travel as floats, which hold them exactly. Pivots and the seed rows come from a
bounded sample.

Defined cases: vectors that are null, or hold a null or non-finite component,
take no part. Vectors are compared with those of equal length only; a length that the
sample lacks has no pivots, and all its rows are compared. Rows equal in id and vector
count once; rows that share an id with different vectors are all candidates, but never
of a query with that id. Ties go to the smaller id. Scores are exact below 2^53 and null
beyond 2^63. Columns beyond the id and the vector are not looked at. No rows in, no rows out.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from parkwright.llm.shared import cut

PIVOTS, SAMPLE_ROWS, ROW_BLOCK, LEAST_BLOCK, ANNULUS, FLOATS = 48, 2048, 131_072, 2_048, 512, 1 << 24
#: Bounds of (query, ring) that a task holds at a time.
BOUNDS = 1 << 20


def whole_numbers(vector: Column, scale: int = 256) -> Column:
    """floor(scale * x) of each component as double; null for vectors that take no part."""
    x = vector.cast("array<double>")
    bad = F.exists(x, lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf")))
    # as double: exact below 2^53, beyond which every double is whole
    return F.when(vector.isNotNull() & ~bad, F.transform(x, lambda v: F.when(F.abs(v * scale) < 2.0**53, F.floor(v * scale).cast("double")).otherwise(v * scale)))


def choose_pivots(sample: np.ndarray, n: int) -> np.ndarray:
    """Farthest-first traversal of the sample."""
    chosen = [0]
    nearest = ((sample - sample[0]) ** 2).sum(1)
    while len(chosen) < min(n, len(sample)) and nearest.max() > 0:
        chosen.append(int(nearest.argmax()))
        nearest = np.minimum(nearest, ((sample - sample[chosen[-1]]) ** 2).sum(1))
    return sample[chosen]


def _distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.sqrt(np.maximum((a * a).sum(1)[:, None] + (b * b).sum(1)[None, :] - 2 * (a @ b.T), 0))


def _extend(x: np.ndarray, most: float) -> np.ndarray:
    return np.c_[x, np.sqrt(np.maximum(most - (x * x).sum(1), 0))]


def _best(scores: np.ndarray, ids: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The k highest scores of each line, ties to smaller ids; -inf marks no candidate."""
    order = np.lexsort((ids, -scores), axis=1)[:, :k]
    return np.take_along_axis(scores, order, 1), np.take_along_axis(ids, order, 1)


def reach(norms: np.ndarray, most: float, bound: np.ndarray) -> np.ndarray:
    """The highest score that a row at least ``bound`` away can have, with slack for rounding."""
    return (norms[:, None] + most - bound**2) / 2 + 1e-6 * (norms[:, None] + most) + 1e-3


class Space:
    """What is known beforehand of the vectors of one length: pivots, the largest square of a norm, and seeds."""

    def __init__(self, most: float, seeds: list[tuple[int, tuple[float, ...]]]):
        self.most, self.seed_ids = most, np.array([i for i, _ in seeds], np.int64)
        self.seeds = np.array([v for _, v in seeds], float).reshape(len(seeds), len(seeds[0][1]))
        self.pivots = choose_pivots(_extend(self.seeds, most), PIVOTS)
        # repeated rows count once
        self.different = np.unique(np.c_[self.seed_ids[:, None], self.seeds], axis=0, return_index=True)[1]

    def keys(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        d = _distances(_extend(x, self.most), self.pivots)
        return d.argmin(1).astype(np.int32), d.min(1)

    def bounds(self, q: np.ndarray, pivot: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        """For each query and each ring (pivot, low, high): the highest score inside."""
        d = _distances(np.c_[q, np.zeros(len(q))], self.pivots)[:, pivot]
        return reach((q * q).sum(1), self.most, np.maximum(np.maximum(low[None, :] - d, d - high[None, :]), 0))

    def floors(self, ids: np.ndarray, q: np.ndarray, k: int) -> np.ndarray:
        """A k-th score that the seeds alone reach."""
        if len(self.different) <= k:  # one of them may be the query's own
            return np.full(len(q), -np.inf)
        got = q @ self.seeds[self.different].T
        got[ids[:, None] == self.seed_ids[self.different][None, :]] = -np.inf
        return np.sort(got, axis=1)[:, -k]


class _Block:
    """The rows of one length in one block, sorted by (pivot, distance), and their annuli."""

    def __init__(self, rows: pd.DataFrame, space: Space | None):
        rows = rows.sort_values(["pivot", "dist", "id"], kind="stable")
        rows = rows.assign(_v=rows["v"].map(lambda v: np.asarray(v).tobytes())).drop_duplicates(["id", "_v"])
        self.space, self.ids, self.x = space, rows["id"].to_numpy(np.int64), np.stack(rows["v"].to_numpy()).astype(float)
        pivot, dist = rows["pivot"].to_numpy(np.int64), rows["dist"].to_numpy(float)
        edges = np.flatnonzero(np.r_[True, pivot[1:] != pivot[:-1]])
        self.cuts = [(a, min(a + ANNULUS, z)) for s, z in zip(edges, np.r_[edges[1:], len(pivot)], strict=True) for a in range(s, z, ANNULUS)]
        self.pivot = np.array([pivot[a] for a, _ in self.cuts])
        self.low, self.high = np.array([dist[a] for a, _ in self.cuts]), np.array([dist[z - 1] for _, z in self.cuts])

    def search(self, ids: np.ndarray, q: np.ndarray, floor: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """The k best rows of each query; ``floor`` is a k-th score already known to be reached elsewhere."""
        # the highest score an annulus can hold, from its lower bound on the distance
        reach = self.space.bounds(q, self.pivot, self.low, self.high) if self.space else np.full((len(q), len(self.cuts)), np.inf)
        order = np.argsort(-reach, axis=1, kind="stable")
        scores, found = np.full((len(q), k), -np.inf), np.full((len(q), k), np.iinfo(np.int64).max)
        done, step, live = 0, 1, np.arange(len(q))
        while done < len(self.cuts) and len(live):
            now = order[live, done : done + step]
            worth = np.take_along_axis(reach[live], now, 1) >= np.maximum(scores[live, k - 1], floor[live])[:, None]
            for a in np.unique(now[worth]):
                who = live[((now == a) & worth).any(1)]
                start, end = self.cuts[a]
                got = q[who] @ self.x[start:end].T
                got[ids[who][:, None] == self.ids[None, start:end]] = -np.inf
                near = np.broadcast_to(self.ids[start:end], got.shape)
                if got.shape[1] > 4 * k:  # drop what can't enter before sorting; ties stay
                    kth = -np.partition(-got, k - 1, axis=1)[:, k - 1]
                    kth = np.maximum(kth, np.maximum(scores[who, k - 1], floor[who]))
                    keep = (got >= kth[:, None]).any(0)
                    got, near = got[:, keep], near[:, keep]
                scores[who], found[who] = _best(np.c_[scores[who], got], np.c_[found[who], near], k)
            done, step = done + step, step * 2
            if done < len(self.cuts):
                ahead = reach[live, order[live, done]]
                live = live[ahead >= np.maximum(scores[live, k - 1], floor[live])]
        return scores, found


def search(vectors: DataFrame, queries: DataFrame, k: int = 5) -> DataFrame:
    """The ``k`` rows of ``vectors`` with the highest inner product for each of ``queries``.

    Both have (id long, v array<double> of whole numbers, not null). Returns
    (query_id, rank, id, score). The queries are a stated set, matched in blocks.
    """
    spark = vectors.sparkSession
    vectors = vectors.where("id is not null and v is not null").select("id", "v")
    queries = queries.where("id is not null and v is not null").select("id", "v").distinct()
    seeds: dict[int, list] = {}
    for r in vectors.orderBy(F.xxhash64("id"), "id", "v").limit(SAMPLE_ROWS).collect():
        seeds.setdefault(len(r["v"]), []).append((r["id"], tuple(r["v"])))
    if not seeds:
        return spark.createDataFrame([], "query_id long, rank int, id long, score long")
    # one row for each length in the sample, and one for all others
    known = F.when(F.size("v").isin(list(seeds)), F.size("v"))
    stats = vectors.groupBy(known.alias("dim")).agg(F.count(F.lit(1)).alias("n"), F.max(F.aggregate("v", F.lit(0.0), lambda a, b: a + b * b)).alias("most"), F.max(F.array_max(F.transform("v", F.abs))).alias("largest")).collect()
    spaces = {r["dim"]: Space(r["most"], sorted(seeds[r["dim"]])) for r in stats if r["dim"] is not None}
    n, kind = sum(r["n"] for r in stats), "float" if max(r["largest"] or 0 for r in stats) < FLOATS else "double"
    blocks = max(1, min(-(-n // LEAST_BLOCK), max(-(-n // ROW_BLOCK), spark.sparkContext.defaultParallelism)))
    index, rings = _index(vectors.select("id", F.col("v").cast(f"array<{kind}>").alias("v")), spaces, kind, blocks)
    asked = queries.select("id", F.col("v").cast(f"array<{kind}>").alias("v"), F.xxhash64("v").alias("q"))

    first = cut(_routed(asked.withColumn("floor", F.lit(float("-inf"))).withColumn("home", F.lit(None).cast("int")), spaces, rings, kind, k, home=True), "first")
    met = cut(_met(index, first, spaces, kind, k, blocks), "met")
    reached = met.groupBy("query_id", "q").agg(F.count(F.lit(1)).alias("n"), F.min("score").alias("least"))
    told = first.alias("a").join(reached.alias("r"), (F.col("a.id") == F.col("r.query_id")) & (F.col("a.q") == F.col("r.q")), "left")
    told = told.select("a.id", "a.v", "a.q", F.greatest("a.floor", F.when(F.col("n") >= k, F.col("least")).otherwise(float("-inf"))).alias("floor"), F.col("a.block").alias("home"))
    then = _met(index, _routed(told, spaces, rings, kind, k, home=False), spaces, kind, k, blocks)
    best = Window.partitionBy("query_id", "q").orderBy(F.desc("score"), "id")
    return (
        met.unionByName(then).withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
        .select("query_id", F.col("rank").cast("int").alias("rank"), "id", F.col("score").try_cast("long").alias("score"))
    )


def _index(vectors: DataFrame, spaces: dict[int, Space], kind: str, blocks: int) -> tuple[DataFrame, pd.DataFrame]:
    """The rows with their keys and blocks, and the rings (block, dim, pivot, low, high) of them; dim -1 stands for lengths without pivots."""

    def key_rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in batches:
            for dim, own in rows.groupby(rows["v"].map(len)):
                space = spaces.get(dim)
                pivot, dist = space.keys(np.stack(own["v"].to_numpy()).astype(float)) if space else (-1, 0.0)
                yield own.assign(dim=np.int32(dim), pivot=pivot, dist=dist).astype({"pivot": np.int32, "dist": float})

    keyed = vectors.mapInPandas(key_rows, f"id long, v array<{kind}>, dim int, pivot int, dist double")
    # equal rows fall into one range, whatever its bounds
    index = cut(keyed.repartitionByRange(blocks, "dim", "pivot", "dist", "id").withColumn("block", F.spark_partition_id()), "annuli")
    dim = F.when(F.col("pivot") < 0, -1).otherwise(F.col("dim"))
    return index, index.groupBy("block", dim.alias("dim"), "pivot").agg(F.min("dist").alias("low"), F.max("dist").alias("high")).orderBy("block", "dim", "pivot").toPandas()


def _routed(asked: DataFrame, spaces: dict[int, Space], rings: pd.DataFrame, kind: str, k: int, home: bool) -> DataFrame:
    """``asked`` (id, v, q, floor, home) once for each block to visit: the one of the highest bound, or all others that reach the floor."""
    by_dim = {d: r for d, r in rings.groupby("dim")}

    def routed(space: Space | None, ring: pd.DataFrame, own: pd.DataFrame) -> pd.DataFrame:
        q, ids, floor = np.stack(own["v"].to_numpy()).astype(float), own["id"].to_numpy(np.int64), own["floor"].to_numpy(float)
        block, start = np.unique(ring["block"].to_numpy(np.int64), return_index=True)
        most = np.full((len(q), len(ring)), np.inf)
        if space:
            most = space.bounds(q, ring["pivot"].to_numpy(np.int64), ring["low"].to_numpy(float), ring["high"].to_numpy(float))
            floor = np.maximum(floor, space.floors(ids, q, k))
        most = np.maximum.reduceat(most, start, axis=1)
        if home:
            line, place = np.arange(len(q)), most.argmax(1)
        else:
            line, place = np.nonzero((most >= floor[:, None]) & (block[None, :] != own["home"].to_numpy(np.int64)[:, None]))
        return pd.DataFrame({"id": ids[line], "v": own["v"].to_numpy()[line], "q": own["q"].to_numpy()[line], "floor": floor[line], "block": block[place].astype(np.int32)})

    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in batches:
            for dim, same in rows.groupby(rows["v"].map(len)):
                ring = by_dim.get(dim if dim in spaces else -1)
                if ring is None:
                    continue
                step = BOUNDS // len(ring) + 1
                for at in range(0, len(same), step):
                    yield routed(spaces.get(dim), ring, same.iloc[at : at + step])

    return asked.mapInPandas(work, f"id long, v array<{kind}>, q long, floor double, block int")


def _met(index: DataFrame, asked: DataFrame, spaces: dict[int, Space], kind: str, k: int, blocks: int) -> DataFrame:
    """(query_id, q, id, score): the k best rows at or above the floor, of each block for each query that came to it."""
    none = lambda c, t: F.lit(None).cast(t).alias(c)
    rows = index.select("block", F.lit(0).alias("kind"), "id", "v", "dim", "pivot", "dist", none("q", "long"), none("floor", "double"))
    rows = rows.unionByName(asked.select("block", F.lit(1).alias("kind"), "id", "v", none("dim", "int"), none("pivot", "int"), none("dist", "double"), "q", "floor"))

    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held, parts, at = {}, [], None
        for batch in batches:
            for (block, is_query), own in batch.groupby(["block", "kind"], sort=True):
                if block != at:
                    held, parts, at = {}, [], block
                if not is_query:
                    parts.append(own)
                    continue
                if parts:  # all rows of the block came before its first query
                    whole, parts = pd.concat(parts, ignore_index=True), []
                    held = {dim: _Block(r, spaces.get(dim)) for dim, r in whole.groupby("dim")}
                for dim, asks in own.groupby(own["v"].map(len)):
                    if dim not in held:
                        continue
                    q, ids, floor = np.stack(asks["v"].to_numpy()).astype(float), asks["id"].to_numpy(np.int64), asks["floor"].to_numpy(float)
                    scores, found = held[dim].search(ids, q, floor, k)
                    line, place = np.nonzero(np.isfinite(scores) & (scores >= floor[:, None]))
                    yield pd.DataFrame({"query_id": ids[line], "q": asks["q"].to_numpy(np.int64)[line], "id": found[line, place], "score": scores[line, place]})

    dealt = rows.repartition(2 * blocks, "block").sortWithinPartitions("block", "kind")
    return dealt.mapInPandas(work, "query_id long, q long, id long, score double")
