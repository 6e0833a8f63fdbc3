"""Connected components of a table of links, by alternating large and small stars; a table of few links is joined up in one task. Nothing is collected but two numbers a round."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import ONE_TASK, settle


def _stars(e: DataFrame, large: bool) -> DataFrame:
    """e: (u, v) with u > v. Large star: every larger neighbour of a node is tied to the node's least neighbour; small star: every smaller one is."""
    sym = e.select("u", "v").unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v"))) if large else e
    least = sym.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    tied = sym.filter("v > u") if large else sym
    tied = tied.join(least, "u").select(F.col("v").alias("a"), F.col("m").alias("b"))
    if not large:
        tied = tied.unionByName(least.select(F.col("u").alias("a"), F.col("m").alias("b")))
    return tied.filter("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()


def _joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(u, v) of at most ONE_TASK links -> (node, component), by joining the trees of both ends."""
    root: dict[int, int] = {}

    def find(x: int) -> int:
        top = x
        while root.setdefault(top, top) != top:
            top = root[top]
        while root[x] != top:
            root[x], x = top, root[x]
        return top

    for batch in batches:
        for u, v in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            a, b = find(u), find(v)
            root[max(a, b)] = min(a, b)
    nodes = list(root)
    yield pa.RecordBatch.from_arrays([pa.array(nodes, pa.int64()), pa.array([find(x) for x in nodes], pa.int64())], ["node", "component"])


def components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node of `edges` (a, b); component is the smallest node that can be reached. Self links are left out."""
    e = settle(edges.filter("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "links")
    state = lambda: tuple(e.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
    seen = state()
    while seen[0]:
        if seen[0] <= ONE_TASK:
            return e.select(F.col("u").cast("long"), F.col("v").cast("long")).coalesce(1).mapInArrow(_joined, "node long, component long")
        e = settle(_stars(_stars(e, True), False), "links")
        now = state()
        if now == seen:
            break
        seen = now
    return e.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(e.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
