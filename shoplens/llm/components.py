"""Connected components of links, by union-find in tasks and rounds of joins."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shoplens.llm.common import settle

#: Links that a task gathers before it replaces them by a forest.
GATHERED = 1 << 18


def forest(links: Iterator[tuple[int, int]]) -> list[tuple[int, int]]:
    """(node, smallest node of its tree) of a union-find over the links; roots are left out."""
    parent: dict[int, int] = {}

    def root(x: int) -> int:
        top = x
        while parent.setdefault(top, top) != top:
            top = parent[top]
        while parent[x] != top:
            parent[x], x = top, parent[x]
        return top

    for a, b in links:
        a, b = root(a), root(b)
        if a != b:
            parent[max(a, b)] = min(a, b)
    return [(x, root(x)) for x in list(parent) if root(x) != x]


def _forests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    links: list[tuple[int, int]] = []

    def emit() -> pa.RecordBatch:
        found = forest(iter(links))
        return pa.RecordBatch.from_arrays(
            [pa.array([x[i] for x in found], pa.int64()) for i in (0, 1)], ["u", "v"]
        )

    for batch in batches:
        links += zip(*(c.to_pylist() for c in batch.columns), strict=True)
        if len(links) >= GATHERED:
            yield emit()
            links.clear()
    yield emit()


def _rows_and_sum(edges: DataFrame) -> tuple[int, int]:
    counted = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
    return counted[0], int(counted[1] or 0)


def components(links: DataFrame) -> DataFrame:
    """node, component: for each node of ``links`` (a, b) but the smallest of its component.

    The component is named by its smallest node. Each task first replaces its links by a
    union-find forest. Then, in rounds, each node's larger neighbours and then its smaller ones
    are linked with the smallest node known near it, until nothing changes. A round is
    two aggregations and two joins on nodes, all of which Spark can split if a node has very
    many links; the number of rounds grows with the logarithm of the longest chain.
    """
    ordered = links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
    edges = settle(
        ordered.filter("u > v").mapInArrow(_forests, "u bigint, v bigint").distinct()
    )
    before = None
    while (now := _rows_and_sum(edges)) != before:
        before = now
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        up = both.filter("v > u").join(least, "u")
        larger = up.select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = settle(larger.filter("u > v").distinct())
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        edges = settle(
            small.filter("u > v").union(low.select("u", F.col("m").alias("v"))).distinct()
        )
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
