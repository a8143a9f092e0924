"""Connected components of a large graph: local union-find, then star contraction."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from seamfold.llm.core import scratch

#: Edges that one local union-find holds at a time.
CHUNK = 500_000


class UnionFind:
    """Over any hashable keys; the smallest member is the root."""

    def __init__(self) -> None:
        self.up: dict = {}

    def find(self, a):
        up = self.up
        root = up.setdefault(a, a)
        while (nxt := up[root]) != root:
            root = nxt
        while up[a] != root:
            up[a], a = root, up[a]
        return root

    def union(self, a, b) -> bool:
        a, b = self.find(a), self.find(b)
        if a == b:
            return False
        self.up[max(a, b)] = min(a, b)
        return True


def _forest(batches):
    """Stars (member, root) of the edges that this task sees, chunk by chunk."""

    def stars(uf: UnionFind):
        pairs = [(a, r) for a in uf.up if (r := uf.find(a)) != a]
        return pa.RecordBatch.from_arrays([pa.array([p[0] for p in pairs], pa.int64()), pa.array([p[1] for p in pairs], pa.int64())], names=["a", "b"])

    uf, n = UnionFind(), 0
    for batch in batches:
        for a, b in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            uf.union(a, b)
        n += batch.num_rows
        if n >= CHUNK:
            yield stars(uf)
            uf, n = UnionFind(), 0
    yield stars(uf)


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component) for every node of an edge, component being its smallest node.

    Each round points every node to its smallest neighbour below it, gives its other ones
    that neighbour to point to, and lets all nodes skip to what their neighbour pointed to;
    the rounds are logarithmic in the diameter. Steps are windows over what a node points
    to, which local forests keep short, and plain equi-joins, which Spark can split where a
    node is hot; the driver sees one boolean a round. Null ends and loops are ignored; no
    edges give no rows.
    """
    e = edges.select(F.col(a).cast("long").alias("a"), F.col(b).cast("long").alias("b")).where("a is not null and b is not null and a <> b")
    # written, since each round reads it twice
    e = scratch(e.mapInArrow(_forest, "a long, b long"), "forest")
    while True:
        held = e.distinct().withColumn("m", F.min("b").over(Window.partitionBy("a")))
        up = held.where("b = m").select("a", "m")
        skip = up.join(up.select(F.col("a").alias("m"), F.col("m").alias("further")), "m", "left")
        moved = skip.select("a", F.coalesce("further", "m").alias("b"), F.col("further").isNotNull().alias("moved"))
        e = scratch(moved.unionByName(held.where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"), F.lit(True).alias("moved"))), "stars")
        if not e.where("moved").limit(1).count():
            break
        e = e.select("a", "b")
    return e.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(e.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())
