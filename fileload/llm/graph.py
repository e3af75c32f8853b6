"""Connected components of large graphs: union-find in tasks, then star joins."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fileload.session import stage_table

EDGE = "u long, v long"
#: Edges that the union-find of one task takes; fewer tasks leave less to join.
TASK_EDGES = 500_000


def _forest(batches):
    """Union-find over the edges of one task: each node below its tree's smallest."""
    parent: dict[int, int] = {}

    def find(x):
        root = x
        while parent.setdefault(root, root) != root:
            root = parent[root]
        while parent[x] != root:
            parent[x], x = root, parent[x]
        return root

    for batch in batches:
        for u, v in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            a, b = find(u), find(v)
            if a != b:
                parent[max(a, b)] = min(a, b)
    pairs = [(x, find(x)) for x in list(parent)]
    pairs = [p for p in pairs if p[0] != p[1]]
    for lo in range(0, len(pairs), 50_000):
        part = pairs[lo : lo + 50_000]
        yield pa.RecordBatch.from_arrays([pa.array([p[k] for p in part], pa.int64()) for k in range(2)], names=["u", "v"])


def components(edges: DataFrame) -> DataFrame:
    """``node, component`` for all ends of ``edges (u, v)``, a written table, that are
    not themselves the smallest node of their component, which ``component`` is.

    Stars alternate: larger neighbours go under a node's smallest neighbour, then
    smaller ones do, until all are stars.  Each step is written, so that a lost
    executor costs one step.  Minima are taken before the shuffle; a star's centre
    joins as a skewed key that Spark splits.
    """
    edges = edges.select(F.col("u").cast("long"), F.col("v").cast("long")).where("u <> v")
    tasks = max(1, -(-edges.count() // TASK_EDGES))
    now = stage_table(edges.coalesce(tasks).mapInArrow(_forest, EDGE), "forest")
    while not _is_stars(now):
        both = now.union(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = stage_table(large.distinct(), "large")
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).union(low.select("u", F.col("m").alias("v")))
        now = stage_table(small.where("u <> v").distinct(), "small")
    return now.select(F.col("u").alias("node"), F.col("v").alias("component"))


def _is_stars(edges: DataFrame) -> bool:
    """Whether every edge leads from a node with no other edge to a smaller centre."""
    doubled = edges.groupBy("u").agg(F.count("*").alias("n")).where("n > 1")
    inner = edges.select(F.col("v").alias("u")).join(edges.select("u"), "u", "left_semi")
    return doubled.select("u").union(inner).isEmpty()
