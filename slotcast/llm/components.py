"""Connected components: spanning forests inside partitions, star rounds between them.

Links are cut into partitions of at most ``LINKS`` rows. Each round replaces the links of
a partition by a spanning forest of stars, which needs no shuffle, and then moves links
between partitions by a large-star and a small-star step, which are joins and
aggregations with map-side partial results. A node with very many neighbours is one row
on the aggregated side of a join, so Spark splits its other side. When all links fit one
partition, its forest is the result.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from slotcast.llm.common import staged

#: Links that one task joins into a forest.
LINKS = 250_000


def local_forest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(a, b) for every node a of these links that is not the least node b of its component."""
    root: dict[int, int] = {}

    def find(x: int) -> int:
        top = x
        while (up := root.get(top, top)) != top:
            top = up
        while x != top:
            root[x], x = top, root.get(x, x)
        return top

    for batch in batches:
        for a, b in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            a, b = find(a), find(b)
            if a != b:
                root[max(a, b)] = min(a, b)
    nodes = list(root)
    yield pa.RecordBatch.from_arrays(
        [pa.array(nodes, pa.int64()), pa.array([find(x) for x in nodes], pa.int64())], ["a", "b"]
    )


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    low = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
    return both.where("b > a").join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))


def _small_star(edges: DataFrame) -> DataFrame:
    low = edges.groupBy("a").agg(F.min("b").alias("m"))
    moved = edges.join(low, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.union(low.select("a", F.col("m").alias("b")))


def connected_components(edges: DataFrame, links: int = LINKS) -> DataFrame:
    """(node, component) for every node of the links (a, b); the component is its least node.

    Links may repeat and point either way. Links with a null end, and of a node with
    itself, link nothing; a node without links gets no row.
    """
    now, before = staged(edges.where("a <> b").select("a", "b"), "component-links"), None
    while True:
        tasks = -(-now.count() // links)
        stars = staged(now.coalesce(max(1, tasks)).mapInArrow(local_forest, "a long, b long"), "forests")
        if tasks <= 1:
            break
        mark = stars.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        now = staged(_small_star(_large_star(stars)).distinct(), "stars")
        if mark == before:
            stars = now
            break
        before = mark
    roots = stars.select(F.col("b").alias("node")).distinct()
    return stars.select(F.col("a").alias("node"), F.col("b").alias("component")).union(
        roots.select("node", F.col("node").alias("component"))
    )
