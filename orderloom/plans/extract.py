"""Documents to finished records, all vendors in one job."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.common import is_blank
from ..operators.flatten import explode_multi_field, has_path
from ..operators.mapping import light_mapping, map_record, with_config
from ..operators.records import (
    drop_helpers,
    drop_unbillable,
    fill_weights,
    mirror_costs,
    money_from_multi,
    normalize_carriers,
    order_total,
    set_calculated_status,
    settle_record,
    single_dates,
    take_delivered_quantities,
)
from ..operators.splitting import split_records
from ..session import materialize
from ..sizing import broadcast_if_small
from ..sources.requests import enrich_second_call

# What tells a rejected document or record apart, as far as it has it.
IDENTITY = ("rec_id", "id", "vendor_id", "so_number", "po_number", "invoice_number", "piece", "status_code")


@dataclass
class ExtractResult:
    """Finished records, and what was not taken as rows with ``reject_reason``."""

    records: DataFrame
    rejects: DataFrame


def map_documents(documents: DataFrame, compiled: DataFrame, lone_lists: bool = False) -> DataFrame:
    """Parsed documents to mapped, settled records (not yet filtered)."""
    return _map_configured(with_config(documents, compiled), lone_lists)


def _map_configured(configured: DataFrame, lone_lists: bool) -> DataFrame:
    """One record per element of the vendor's multi-field list, or per document."""
    parts = explode_multi_field(configured, F.col("cfg.multi_field")).drop("element_pos")
    return map_record(parts, lone_lists=lone_lists).transform(settle_record)


def finish_record(mapped: DataFrame) -> DataFrame:
    """Split, status, carriers, weights, quantities, money, dates and totals, in this order."""
    return (
        mapped.transform(split_records)
        .transform(set_calculated_status)
        .transform(normalize_carriers)
        .transform(fill_weights)
        .transform(take_delivered_quantities)
        .transform(money_from_multi)
        .transform(single_dates)
        .transform(mirror_costs)
        .transform(order_total)
        .transform(drop_helpers)
    )


def _required(configured: DataFrame) -> Column:
    """Whether the document has what its vendor requires of a body."""
    path = F.col("cfg.required_path")
    return path.isNull() | has_path(F.col("doc"), path)


def _readable(finished: DataFrame) -> DataFrame:
    return finished.filter(F.size("cost_errors") == 0).drop("cost_errors")


def _calls_again() -> Column:
    """Whether the vendor has a second call."""
    return F.coalesce(F.col("cfg.second_call"), F.lit(False))


def _billable(direct: DataFrame, calling: DataFrame, second: DataFrame | None, key: tuple[str, ...]) -> DataFrame:
    """Records of vendors with one call, and those that second documents give for the others."""
    if second is None:
        return direct
    enriched = enrich_second_call(calling, second, key=key, calls="vendor").drop("invoice_pos")
    return direct.unionByName(enriched, allowMissingColumns=True)


def _with_mapping(second: DataFrame, compiled: DataFrame) -> DataFrame:
    """Second documents with their vendor's mapping; what crosses the join by order is its text alone."""
    light = compiled.select("vendor_id", light_mapping())
    small = broadcast_if_small(light)
    return second.join(light.hint("shuffle_hash") if small is light else small, "vendor_id", "left")


def extract(
    documents: DataFrame,
    compiled: DataFrame,
    lone_lists: bool = False,
    second: DataFrame | None = None,
    key: tuple[str, ...] = ("vendor_id", "so_number"),
) -> DataFrame:
    """Documents to finished, billable records.

    A vendor with a second call only gives records of its second documents:
    ``second`` has ``key``, ``invoice_number``, ``body`` and ``doc``. Vendors with and without a second
    call part before the mapping, which no filter goes through, so that each document is mapped once.
    """
    configured = with_config(documents, compiled)
    ready = configured.filter(_required(configured))
    direct, calling = (
        _map_configured(rows, lone_lists).transform(drop_unbillable)
        for rows in (ready.filter(~_calls_again()), ready.filter(_calls_again()))
    )
    if second is not None:
        second = _with_mapping(second, compiled)
    return _billable(direct, calling, second, key).transform(finish_record).transform(_readable)


def unbillable_reason() -> Column:
    cancelled = F.coalesce(F.col("invoice_status") == "CANCELLED", F.lit(False))
    return F.when(cancelled, "cancelled").when(is_blank(F.col("invoice_number")), "no invoice number")


def outcomes_of(documents: DataFrame, compiled: DataFrame, lone_lists: bool = False) -> DataFrame:
    """Mapped records with ``reject_reason`` for those that are not billable."""
    return map_documents(documents, compiled, lone_lists).withColumn("reject_reason", unbillable_reason())


def rejected(rows: DataFrame, reason: Column | str, columns: tuple[str, ...] = IDENTITY) -> DataFrame:
    """What identifies rows, and why they were not taken."""
    why = F.lit(reason) if isinstance(reason, str) else reason
    present = [c for c in columns if c in rows.columns]
    return rows.select(*present, why.cast("string").alias("reject_reason"))


def extract_with_rejects(
    documents: DataFrame,
    compiled: DataFrame,
    lone_lists: bool = False,
    second: DataFrame | None = None,
    key: tuple[str, ...] = ("vendor_id", "so_number"),
) -> ExtractResult:
    """``extract``, with everything that gives no record among the rejects.

    The mapped and the finished records are written once, since records and
    rejects both come from them. Documents are read once: those that are not taken are
    written beside the mapped ones, without their text, with what identifies them.
    """
    configured = with_config(documents, compiled)
    why = F.when(F.col("cfg").isNull(), "unknown vendor").when(~_required(configured), "required part of the body is missing")
    own = F.struct(*[c for c in IDENTITY if c in documents.columns])
    marked = configured.withColumn("_why", why).withColumns(
        {"_own": F.when(F.col("_why").isNotNull(), own), "doc": F.when(F.col("_why").isNull(), F.col("doc"))}
    )
    written = materialize(_map_configured(marked, lone_lists), "mapped")
    unread = written.filter(F.col("_why").isNotNull()).select("_own.*", F.col("_why").alias("reject_reason"))
    mapped = written.filter(F.col("_why").isNull()).drop("_why", "_own")
    billable = mapped.transform(drop_unbillable)
    if second is not None:
        second = _with_mapping(second, compiled)
    waiting = billable.filter(_calls_again())
    finished = materialize(_billable(billable.filter(~_calls_again()), waiting, second, key).transform(finish_record), "finished")
    if second is not None:
        answered = second.select(*key).distinct()
        waiting = waiting.join(answered, list(key), "left_anti").select(*billable.columns)
    parts = [
        unread,
        rejected(mapped.filter(unbillable_reason().isNotNull()), unbillable_reason()),
        rejected(waiting, "no second document"),
        rejected(finished.filter(F.size("cost_errors") > 0), F.array_join("cost_errors", "; ")),
    ]
    rejects = parts[0]
    for part in parts[1:]:
        rejects = rejects.unionByName(part, allowMissingColumns=True)
    return ExtractResult(_readable(finished), rejects)
