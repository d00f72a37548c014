"""Connected components by rounds of contraction, for graphs of any size.

Each round hooks every node to its least neighbour in a random order (that of
its hash), replaces both ends of each edge by their hooks, and drops loops and
repeats, until no edge is left; the hooks of all rounds, applied in turn, give
every node its root. The random order makes a path of n nodes shrink in about
log n rounds, whatever its ids. Nothing is collected: each round is written to
the shared folder. Both sides of each join come straight from an exchange, so
that adaptive execution splits the partition of a hub.

Defined cases: repeated edges and loops count for nothing, but a node of loops only
is not returned. Nodes may be of any type that has an order. Columns beyond a and b are not
looked at, whatever their names. No edges in, no rows out.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parkwright.llm.shared import cut


def _rank(c: str):
    return F.struct(F.xxhash64(c).alias("h"), F.col(c).alias("v"))


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of ``edges`` (a, b); nodes of one component share a root of it."""
    edges = cut(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    rounds: list[DataFrame] = []
    while not rounds or not edges.isEmpty():
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min(_rank("b")).alias("m"))
        hooks = cut(least.select(F.col("a").alias("node"), F.when(F.col("m") < _rank("a"), F.col("m.v")).otherwise(F.col("a")).alias("hook")), "hooks")
        moved = edges.alias("e").join(hooks.alias("k"), F.col("e.a") == F.col("k.node")).select(F.col("k.hook").alias("a"), "e.b")
        moved = moved.alias("e").join(hooks.alias("k"), F.col("e.b") == F.col("k.node")).select("e.a", F.col("k.hook").alias("b")).where("a <> b")
        edges = cut(moved.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
        rounds.append(hooks)
    roots = rounds[0].withColumnRenamed("hook", "root")
    for hooks in rounds[1:]:
        roots = roots.alias("r").join(hooks.alias("k"), F.col("r.root") == F.col("k.node"), "left").select("r.node", F.coalesce("k.hook", "r.root").alias("root"))
    return roots
