"""Config-driven mapping of a document to an order record, inside the row.

Every document carries its vendor's mapping (``sources.configs``). A walk of the
document (``walk``) turns leaves that match an entry into *hits* ``(grp, field, idx,
inner, …)``; scalars are the last hit of their field and groups are hits aligned by
position, one sort and one pass a document. No leaf leaves its row, so mapping needs no shuffle and a hot vendor is harmless.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.common import built_once, let
from ..schemas import SCALAR_TARGETS
from ..session import share_library
from ..sizing import broadcast_if_small
from ..sources.configs import QUALIFIED_SIBLING
from .walk import mapped_column


def light_mapping() -> Column:
    """A compiled mapping as documents take it along: as text, without its entries, which would be copied with every row."""
    return F.col("mapping").dropFields("entries").alias("mapping")


def with_config(df: DataFrame, compiled: DataFrame) -> DataFrame:
    """Attach ``mapping`` and ``cfg`` by vendor; documents of unknown vendors get NULLs.

    Configs that do not fit a broadcast are hashed by shuffle partition, so that documents are not sorted.
    """
    compiled = compiled.withColumn("mapping", light_mapping())
    small = broadcast_if_small(compiled)
    return df.join(compiled.hint("shuffle_hash") if small is compiled else small, "vendor_id", "left")


def join_wildcard_values(matching: Column) -> Column:
    """Values of the matching leaves joined by ``', '`` in document order; NULLs are skipped."""
    return F.array_join(F.transform(matching, lambda x: x["value"]), ", ")


def find_qualified(lv: Column, qualifier: Column, sign: Column) -> Column:
    """The leaf next to the first ``…<qualifier>`` leaf whose value is ``sign``: an array of 0 or 1."""

    def sibling(key_path: Column) -> Column:
        return F.concat(
            F.substring(key_path, F.lit(1), F.length(key_path) - F.length(qualifier)), F.lit(QUALIFIED_SIBLING)
        )

    keyed = F.filter(lv, lambda x: x["path"].endswith(qualifier) & (x["value"] == sign))
    return let(
        F.get(keyed, F.lit(0))["path"],
        lambda key_path: F.filter(lv, lambda x: key_path.isNotNull() & (x["path"] == sibling(key_path))),
    )


def _scalar(field: str, in_context: bool) -> Column:
    """A mapped scalar; the order's own column stands in where the document has none."""
    mapped = F.col("_mapped.scalars")[field]
    return F.coalesce(mapped, F.col(field)) if in_context else mapped


def _regroup(items: Column, outer: Column) -> Column:
    """Items back into their outer positions, which ascend: one pass over the places where they change."""

    def changes(outer: Column) -> Column:
        return F.filter(F.transform(outer, lambda o, i: F.when((i == 0) | (F.get(outer, i - 1) != o), i)), lambda i: i.isNotNull())

    def cut(rows: Column, at: Column) -> Column:
        return F.transform(at, lambda i, k: F.slice(rows, i + 1, F.coalesce(F.get(at, k + 1), F.size(rows)) - i))

    return let(outer, lambda starts: let(changes(starts), lambda at: let(items, lambda rows: cut(rows, at))))


@built_once
def _mapped_column(lone_lists: bool, legacy_index: bool) -> Column:
    return mapped_column(F.col("_document"), F.col("_entries"), F.col("_serialized"), lone_lists, legacy_index)


def map_record(
    df: DataFrame,
    doc: str = "doc",
    text: str = "body",
    is_serialized: str | None = "need_serial_no",
    lone_lists: bool = False,
    legacy_index: bool = False,
) -> DataFrame:
    """Documents with ``mapping`` (see ``with_config``) to mapped orders.

    Keeps the other columns and adds the scalars, ``items``, ``item_groups``
    (set where the vendor nests items), ``deliveries`` and ``seen_fields`` (the
    scalar targets that were written, so that absent and null stay apart).
    Narrow: one projection chain, no exchange.
    """
    others = [c for c in df.columns if c not in (doc, text, "mapping")]
    share_library(df.sparkSession)
    flagged = F.lit(None).cast("boolean") if is_serialized is None else F.col(is_serialized)
    texts = df.select(
        *others, F.col(doc).alias("_document"), F.col("mapping.text").alias("_entries"), flagged.alias("_serialized"),
        F.col("mapping.nested").alias("_nested"),
    )
    walked = texts.select(*others, _mapped_column(lone_lists, legacy_index).alias("_mapped"), "_nested")
    mapped = walked.select(
        *[c for c in others if c not in SCALAR_TARGETS],
        *[_scalar(f, f in others).alias(f) for f in SCALAR_TARGETS],
        F.col("_mapped.seen").alias("seen_fields"),
        F.col("_mapped.items").alias("items"),
        F.col("_mapped.deliveries").alias("deliveries"),
        "_nested",
        F.col("_mapped.outer").alias("_outer"),
    )
    groups = _regroup(F.col("items"), F.coalesce("_outer", F.array().cast("array<int>")))
    return mapped.withColumn("item_groups", F.when(F.col("_nested"), groups)).drop("_nested", "_outer")
