"""Item and order status rules."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .common import is_blank, let

# The canonical statuses and the ERP statuses still open for billing.
OPEN = "OPEN"
BACKORDERED = "BACKORDERED"
PROCESSING = "PROCESSING"
PARTIAL = "PARTIAL"
COMPLETED = "COMPLETED"
CANCELLED = "CANCELLED"
ERROR = "ERROR"
OPEN_FOR_BILLING = (
    "pendingReceipt",
    "partiallyReceived",
    "pendingBilling",
    "pendingBillPartReceived",
)


def item_status(
    ordered: Column,
    shipped: Column,
    backordered: Column,
    own: Column,
    has_ordered: Column,
    has_shipped: Column,
    has_backordered: Column,
) -> Column:
    """Status of one line from its three quantities.

    The ``has_*`` columns say whether the quantity counts as set; whether a
    zero does depends on its type in the document (see ``common.is_set``).
    """
    o, s, b = (c.try_cast("double") for c in (ordered, shipped, backordered))
    left = o - s
    partly = (left > 0) & (left < o)
    both = has_ordered & has_shipped
    unnamed = F.lit("")
    return (
        F.when(
            both & ~has_backordered,
            F.when(left == 0, COMPLETED).when(left == o, PROCESSING).when(partly, PARTIAL).otherwise(unnamed),
        )
        .when(
            both & has_backordered,
            F.when((o == b) & (s != o), BACKORDERED)
            .when(s == o, COMPLETED)
            .when(partly, PARTIAL)
            .otherwise(unnamed),
        )
        .when(has_ordered & ~has_backordered, PROCESSING)
        .when(has_shipped & ~has_ordered & ~has_backordered, COMPLETED)
        .when(
            has_shipped & has_backordered & ~has_ordered,
            F.when((b == 0) & (s > 0), COMPLETED)
            .when((b > 0) & (s == 0), BACKORDERED)
            .when((s > 0) & (b > 0), PARTIAL)
            .otherwise(unnamed),
        )
        .otherwise(own)
    )


def _by_precedence(n: Column, all_back: Column, any_partial: Column, any_processing: Column, all_done: Column) -> Column:
    return (
        F.when(n == 0, "")
        .when(all_back, BACKORDERED)
        .when(any_partial, PARTIAL)
        .when(any_processing, PROCESSING)
        .when(all_done, COMPLETED)
        .otherwise("")
    )


def rollup_status(statuses: Column) -> Column:
    """Order status from an array of item statuses; empty ones are ignored."""
    # Only which statuses there are counts.
    return let(
        F.array_except(F.coalesce(statuses, F.array().cast("array<string>")), F.array(F.lit(None).cast("string"), F.lit(""))),
        lambda known: _by_precedence(
            F.size(known),
            known == F.array(F.lit(BACKORDERED)),
            F.array_contains(known, BACKORDERED) | F.array_contains(known, PARTIAL),
            F.array_contains(known, PROCESSING),
            known == F.array(F.lit(COMPLETED)),
        ),
    )


def rollup_status_agg(status: Column) -> Column:
    """The same roll-up as an aggregate over rows: five flags per group, so it
    combines before the shuffle and no group is ever collected."""
    s = F.when(~is_blank(status), status)
    return _by_precedence(
        F.count(s),
        F.coalesce(F.bool_and(s == BACKORDERED), F.lit(False)),
        F.coalesce(F.bool_or(s.isin(BACKORDERED, PARTIAL)), F.lit(False)),
        F.coalesce(F.bool_or(s == PROCESSING), F.lit(False)),
        F.coalesce(F.bool_and(s == COMPLETED), F.lit(False)),
    )


def invert_status_map(mapping: dict[str, list[str] | str]) -> dict[str, str]:
    """``{canonical: [raw, …]}`` to ``{raw: canonical}``; the first canonical wins."""
    inverted: dict[str, str] = {}
    for canonical, raws in mapping.items():
        for raw in [raws] if isinstance(raws, str) else raws:
            inverted.setdefault(raw, canonical)
    return inverted


def map_literal(values: dict[str, object], value_type: str = "string") -> Column:
    """A small driver-side dict as a MAP literal."""
    if not values:
        return F.lit(None).cast(f"map<string,{value_type}>")
    return F.create_map(*[F.lit(x) for pair in values.items() for x in pair]).cast(f"map<string,{value_type}>")


def map_status(raw: Column, by_raw: Column) -> Column:
    """Canonical status of a raw one; an unknown one is returned unchanged."""
    return F.coalesce(F.try_element_at(by_raw, raw), raw)


def known_status(raw: Column, by_raw: Column) -> Column:
    """Canonical status of a raw one, NULL when unknown."""
    return F.try_element_at(by_raw, raw)


def apply_calculated_status(from_vendor: Column, calculated: Column, mapped: Column) -> Column:
    """The calculated status replaces the mapped one unless the vendor set its own."""
    return F.when(is_blank(from_vendor), calculated).otherwise(mapped)
