"""Measured broadcasts and even spreading of repeated rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BROADCAST_ROWS = 100_000
BROADCAST_BYTES = 64 * 1024 * 1024
REPEAT_CHUNK = 100_000


def broadcast_if_small(df: DataFrame, max_rows: int = BROADCAST_ROWS, max_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """Hint a broadcast when ``df`` was measured to fit: few enough rows, and few
    enough bytes as JSON text.

    Every task measures at most ``max_rows + 1`` rows, and only sizes leave it. A larger side is
    returned without a hint and joins by shuffle, where AQE splits skewed partitions.
    """
    sizes = df.select(F.octet_length(F.to_json(F.struct("*"))).alias("b")).limit(max_rows + 1)
    found = sizes.agg(F.count("*").alias("n"), F.coalesce(F.sum("b"), F.lit(0)).alias("b")).first()
    return F.broadcast(df) if found["n"] <= max_rows and found["b"] <= max_bytes else df


def repeat_rows(df: DataFrame, times: str, copy: str, chunk: int = REPEAT_CHUNK) -> DataFrame:
    """Each row ``times`` times, numbered from 1 in ``copy``; drops ``times``.

    A row repeated more than ``chunk`` times is first cut into chunks that are
    spread over all tasks, so no task writes one row's copies alone. Such rows
    are few (their copies over ``chunk``), so only they are shuffled.
    """
    others = [c for c in df.columns if c != times]
    one = F.lit(1).cast("bigint")
    few = df.filter(F.col(times) <= chunk).select(
        *others, F.explode(F.sequence(one, F.col(times).cast("bigint"))).alias(copy)
    )
    starts = F.sequence(one, F.col(times).cast("bigint"), F.lit(chunk).cast("bigint"))
    cut = df.filter(F.col(times) > chunk).select(*others, times, F.explode(starts).alias("_from"))
    parts = df.sparkSession.conf.get("spark.sql.shuffle.partitions")
    spread = cut.repartition(int(parts), *others, "_from") if parts.isdigit() else cut
    upto = F.least(F.col("_from") + (chunk - 1), F.col(times).cast("bigint"))
    many = spread.select(*others, F.explode(F.sequence(F.col("_from"), upto)).alias(copy))
    return few.unionByName(many)
