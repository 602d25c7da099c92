"""Positions in an order, found without one task that holds the whole order."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .storage import stored


def starts(counts: DataFrame, tree: list[str], levels: list[str], weight: str, start: str) -> DataFrame:
    """``counts`` with the sum of ``weight`` over the earlier rows of the same ``tree``.

    ``levels`` are columns from the coarsest to the finest; together with ``tree`` they name one row.
    Each level is summed up inside the one above it, so no window holds more than the values that
    one level has below a value of the next coarser one.
    """
    before = counts.withColumn(start, F.lit(0).cast("long"))
    for depth in range(len(levels)):
        above = [*tree, *levels[:depth]]
        sums = counts.groupBy(*above, levels[depth]).agg(F.sum(weight).alias("_w"))
        order = Window.partitionBy(*above).orderBy(levels[depth]).rowsBetween(Window.unboundedPreceding, -1)
        prefix = sums.select(*above, levels[depth], F.coalesce(F.sum("_w").over(order), F.lit(0)).alias("_before"))
        before = before.join(prefix, [*above, levels[depth]]).withColumn(start, F.col(start) + F.col("_before")).drop("_before")
    return before


def ranked(rows: DataFrame, order: list[Column], rank: str, name: str = "ranked") -> DataFrame:
    """``rows`` with their position from 0 in ``order``, which has to tell all rows apart.

    The order is cut into ranges, one a task; positions are counted in each range and the sizes of
    the ranges before it are added. The ranges are written first, so that a repeated task finds the
    same ones; their sizes are one row a task.
    """
    cut = stored(rows.repartitionByRange(*order).withColumn("_part", F.spark_partition_id()), name)
    earlier = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    sizes = cut.groupBy("_part").agg(F.count("*").alias("_n"))
    offsets = sizes.select("_part", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before"))
    inside = F.row_number().over(Window.partitionBy("_part").orderBy(*order))
    return cut.withColumn(rank, inside - F.lit(1)).join(F.broadcast(offsets), "_part").withColumn(
        rank, F.col(rank) + F.col("_before")
    ).drop("_part", "_before")
