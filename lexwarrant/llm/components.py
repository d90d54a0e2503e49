"""Connected components of links between rows, as DataFrame joins."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from ..storage import write_table

#: Links that one task joins by itself once contraction has left no more than these.
FINISH = 500_000


def _ordered(x: F.Column, y: F.Column) -> tuple[F.Column, F.Column]:
    return F.least(x, y).alias("a"), F.greatest(x, y).alias("b")


def _joined_in_one_task(links: DataFrame) -> DataFrame:
    """node, root of few links, by union and find over their arrays."""

    def join(batches):
        ends = [(b.column("a").to_numpy(), b.column("b").to_numpy()) for b in batches]
        if not ends:
            return
        a, b = (np.concatenate(x) for x in zip(*ends))
        nodes, at = np.unique(np.concatenate([a, b]), return_inverse=True)
        parent = list(range(len(nodes)))
        for x, y in zip(at[: len(a)].tolist(), at[len(a) :].tolist()):
            while parent[x] != x:
                parent[x] = parent[parent[x]]
                x = parent[x]
            while parent[y] != y:
                parent[y] = parent[parent[y]]
                y = parent[y]
            parent[max(x, y)] = min(x, y)
        for k in range(len(parent)):  # a parent is never above its node
            parent[k] = parent[parent[k]]
        yield pa.RecordBatch.from_arrays([pa.array(nodes, pa.int64()), pa.array(nodes[parent], pa.int64())], names=["node", "root"])

    return links.coalesce(1).mapInArrow(join, "node long, root long")


def components(links: DataFrame, finish: int = FINISH) -> DataFrame:
    """node, component: the least node each node of ``links`` (a, b) can reach.

    Rounds of contraction. Every round gives each node a priority by a hash; a node points to the least
    by priority among its neighbours and itself, pointers are followed once more, and links are redrawn
    between what nodes point to. Since priorities are new in each round and know nothing of ids, less
    than half of the nodes of a chain are left, however its ids run, so rounds grow with the logarithm of
    the longest chain. Once ``finish`` links or fewer are left, one task joins them. The least node of
    what shares a root is the component. Each round is written, so a lost executor costs no earlier
    round; groups by a node are summed in part before they are shuffled.
    """
    left = write_table(links.select(*_ordered(F.col("a"), F.col("b"))).where("a < b").distinct(), "links")
    found, rounds = None, 0

    def follow(points: DataFrame) -> DataFrame:
        """``found`` with roots replaced by what they point to."""
        to = points.select(F.col("node").alias("_n"), F.col("root").alias("_r"))
        return found.join(to, F.col("root") == F.col("_n"), "left").select("node", F.coalesce("_r", "root").alias("root"))

    while left.count() > finish:
        rounds += 1
        ranked = lambda node: F.struct(F.xxhash64(F.lit(rounds), node).alias("p"), node.alias("n"))  # noqa: E731, B023
        ends = left.select(F.col("a").alias("node"), F.col("b").alias("other")).union(left.select("b", "a"))
        nearest = ends.groupBy("node").agg(F.min(ranked(F.col("other"))).alias("m")).select("node", F.least("m", ranked(F.col("node")))["n"].alias("m"))
        nearest = write_table(nearest, "nearest")
        beyond = nearest.select(F.col("node").alias("_n"), F.col("m").alias("_m"))
        points = write_table(nearest.join(beyond, F.col("m") == F.col("_n")).select("node", F.col("_m").alias("root")), "points")
        found = points if found is None else write_table(follow(points), "roots")
        at_a, at_b = (points.select(F.col("node").alias(f"_{x}"), F.col("root").alias(x)) for x in ("x", "y"))
        drawn = left.join(at_a, F.col("a") == F.col("_x")).join(at_b, F.col("b") == F.col("_y")).where("x <> y")
        left = write_table(drawn.select(*_ordered(F.col("x"), F.col("y"))).distinct(), "links")
    last = write_table(_joined_in_one_task(left), "points")
    if found is None:
        return last.withColumnRenamed("root", "component")
    found = write_table(follow(last), "roots")
    least = found.groupBy("root").agg(F.min("node").alias("component"))
    return found.join(least, "root").select("node", "component")
