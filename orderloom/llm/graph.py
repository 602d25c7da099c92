"""Connected components of links between long ids: forests inside partitions, then large-star and small-star rounds."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialize


def _forests(edges: DataFrame) -> DataFrame:
    """Each partition's links as stars: every node with the smallest one that the partition's links lead it to."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        above: dict[int, int] = {}

        def root(x: int) -> int:
            top = x
            while (up := above.get(top, top)) != top:
                top = up
            while x != top:
                above[x], x = top, above.get(x, x)
            return top

        for batch in batches:
            for u, v in zip(batch.column("u").to_pylist(), batch.column("v").to_pylist()):
                a, b = root(u), root(v)
                if a != b:
                    above[max(a, b)] = min(a, b)
        nodes = list(above)
        for start in range(0, len(nodes), 100_000):
            part = nodes[start : start + 100_000]
            yield pa.RecordBatch.from_arrays([pa.array(part, pa.int64()), pa.array([root(x) for x in part], pa.int64())], names=["u", "v"])

    return edges.select("u", "v").mapInArrow(run, "u long, v long").filter("u != v")


def _large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node moves to the node's smallest neighbour."""
    both = edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    lowest = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    moved = both.filter("v > u").join(lowest, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.filter("u != v").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Every smaller neighbour of a node, and the node, move to its smallest neighbour."""
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    lowest = down.groupBy("u").agg(F.min("v").alias("m"))
    moved = down.join(lowest, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    own = lowest.select("u", F.col("m").alias("v"))
    return moved.union(own).filter("u != v").distinct()


def _are_stars(edges: DataFrame) -> bool:
    """Whether every node has one link down, and none of those it leads to has one itself."""
    ends = edges.select(F.col("u").alias("node"), F.lit(1).alias("down"), F.lit(0).alias("top")).union(
        edges.select("v", F.lit(0), F.lit(1))
    )
    seen = ends.groupBy("node").agg(F.sum("down").alias("down"), F.max("top").alias("top"))
    return seen.filter("down > 1 or (down > 0 and top > 0)").isEmpty()


def components(edges: DataFrame) -> DataFrame:
    """``(node, label)`` of all nodes with a link ``(u, v)``; the label is the component's smallest id.

    Links of a partition become stars before they are shuffled. Each round is written to the
    shared folder, so a lost executor costs no earlier round. Hub nodes are aggregated before the
    shuffle, and their links join as a skewed side. Links with a null end and links of a node to
    itself say nothing.
    """
    now = materialize(_forests(edges.filter("u is not null and v is not null and u != v")).distinct(), "links")
    while not _are_stars(now):
        now = materialize(_forests(_small_star(_large_star(now))), "links")
    return now.select(F.col("u").alias("node"), F.col("v").alias("label")).union(
        now.select(F.col("v").alias("node"), F.col("v").alias("label")).distinct()
    )
