"""First-wins deduplication.

All variants are aggregates (``min_by``), which combine before the shuffle: a
key that holds a third of the rows sends one row per task, and no window sorts
a whole group in one place.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def first_by(df: DataFrame, keys: list[str], order: list[str | Column]) -> DataFrame:
    """The first row of each key by ``order``; NULL keys compare equal."""
    rest = [c for c in df.columns if c not in keys]
    if not rest:
        return df.distinct()
    rank = F.struct(*[o if isinstance(o, Column) else F.col(o) for o in order])
    picked = df.groupBy(*keys).agg(F.min_by(F.struct(*rest), rank).alias("_row"))
    return picked.select(*[F.col(c) if c in keys else F.col(f"_row.{c}") for c in df.columns])


def dedup_first_by_pair(df: DataFrame, first: str = "internalid", second: str = "createdfrom", pos: str = "pos") -> DataFrame:
    """First occurrence of each pair; NULLs equal."""
    return first_by(df, [first, second], [pos])


def dedup_first_by_key(df: DataFrame, key: str = "soint_id", pos: str = "pos") -> DataFrame:
    return first_by(df, [key], [pos])


def first_match(df: DataFrame, keys: list[str], value: str = "id") -> DataFrame:
    """One lookup result per key: the lowest value."""
    return df.groupBy(*keys).agg(F.min(value).alias(value))


def first_wins_merge(df: DataFrame, key: str, value: str, pos: str) -> DataFrame:
    """Merge of ``(pos, key, value)`` rows where the first value of a key stays."""
    return df.groupBy(key).agg(F.min_by(value, pos).alias(value))


def append_batches(*batches: DataFrame) -> DataFrame:
    """Concatenation by column name; a column a batch lacks is NULL there."""
    merged = batches[0]
    for batch in batches[1:]:
        merged = merged.unionByName(batch, allowMissingColumns=True)
    return merged
