"""Rules on mapped orders: one row per record, all of them narrow.

Records have the columns of ``schemas`` plus ``cfg`` (their vendor's compiled
switches and maps) and ``seen_fields``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.carrier import carrier_switches, default_weight, normalize_delivery
from ..functions.common import built_once, is_blank, let
from ..functions.dates import first_of_list
from ..functions.money import clean_number, mirror_cost, money_value
from ..functions.status import (
    CANCELLED,
    COMPLETED,
    apply_calculated_status,
    item_status,
    known_status,
    map_status,
    rollup_status,
)

COSTS = ("ship_cost", "total", "extra_item_price")


def default_from_other_field(df: DataFrame, pairs: dict[str, str] | None = None, seen: str = "seen_fields") -> DataFrame:
    """Fill a field from another one where it is absent; an explicit null stays."""
    pairs = pairs or {"invoice_number": "tran_id", "ship_date": "tran_date"}
    present = F.coalesce(F.col(seen), F.array().cast("array<string>"))
    return df.withColumns(
        {
            target: F.when(F.array_contains(present, target), F.col(target)).otherwise(F.col(source))
            for target, source in pairs.items()
        }
    )


def map_record_status(df: DataFrame) -> DataFrame:
    """Canonical ``invoice_status``, or one derived from the invoice field where the vendor does so.

    Without a status and with the vendor's switch on: an invoice number that is a
    known raw status becomes the status (and stops being a number); else a
    tracking number means the order is complete. ``invoice_status_raw`` keeps
    the invoice field in both cases.
    """
    status, number = F.col("invoice_status"), F.col("invoice_number")
    by_raw = F.col("cfg.status_map")
    derive = is_blank(status) & F.coalesce(F.col("cfg.status_in_invoice_field"), F.lit(False)) & ~is_blank(number)
    known = known_status(number, by_raw)
    from_number = derive & known.isNotNull()
    from_tracking = derive & known.isNull() & ~is_blank(F.col("trackingnumber"))
    return df.withColumns(
        {
            "invoice_status": F.when(~is_blank(status), map_status(status, by_raw))
            .when(from_number, known)
            .when(from_tracking, COMPLETED)
            .otherwise(status),
            "invoice_status_raw": F.when(from_number | from_tracking, number),
            "invoice_number": F.when(~from_number, number),
        }
    )


def drop_unbillable(df: DataFrame) -> DataFrame:
    """Drop cancelled records and records without an invoice number."""
    cancelled = F.coalesce(F.col("invoice_status") == CANCELLED, F.lit(False))
    return df.filter(~cancelled & ~is_blank(F.col("invoice_number")))


QUANTITIES = ("quantity_ordered", "quantity", "quantity_backordered")


def _is_counted(item: Column, name: str) -> Column:
    """Whether a quantity counts as set, by the document's types."""
    zero = F.coalesce(F.array_contains(item["zero_fields"], name), F.lit(False))
    return ~is_blank(item[name]) & ~zero


def record_item_status(item: Column) -> Column:
    """Item status with the truth of each quantity taken from the document's types."""
    return item_status(*[item[n] for n in QUANTITIES], item["invoice_status"], *[_is_counted(item, n) for n in QUANTITIES])


def record_item_statuses(items: Column) -> Column:
    """``record_item_status`` of each item. Inside a lambda every use of an expression is evaluated
    again, so quantities are read once to a struct and the rules look at its fields."""

    def read(item: Column) -> Column:
        numbers = [item[n].try_cast("double").alias(n) for n in QUANTITIES]
        return F.struct(*numbers, *[_is_counted(item, n).alias(f"has_{n}") for n in QUANTITIES], item["invoice_status"].alias("own"))

    return F.transform(
        F.transform(items, read),
        lambda x: item_status(*[x[n] for n in QUANTITIES], x["own"], *[x[f"has_{n}"] for n in QUANTITIES]),
    )


@built_once
def _calculated_status() -> Column:
    return F.nullif(rollup_status(record_item_statuses(F.col("items"))), F.lit(""))


def set_calculated_status(df: DataFrame) -> DataFrame:
    """Roll item statuses up; the result replaces the mapped status unless the vendor set one.
    An empty result is NULL."""
    return df.withColumn(
        "invoice_status",
        apply_calculated_status(F.col("status_from_vendor"), _calculated_status(), F.col("invoice_status")),
    )


@built_once
def _normalized_deliveries() -> Column:
    rules = F.col("cfg.carrier")
    normalized = let(carrier_switches(rules), lambda s: F.transform("deliveries", lambda d: normalize_delivery(d, s)))
    return F.when(rules.isNull(), F.col("deliveries")).otherwise(normalized)


def normalize_carriers(df: DataFrame) -> DataFrame:
    return df.withColumn("deliveries", _normalized_deliveries())


def fill_weights(df: DataFrame) -> DataFrame:
    def filled(d: Column) -> Column:
        zero = F.coalesce(F.array_contains(d["zero_fields"], "weight"), F.lit(False))
        return d.withField("weight", default_weight(d["weight"], zero))

    return df.withColumn("deliveries", F.transform("deliveries", filled))


def zip_items_with_deliveries(items: Column, deliveries: Column) -> Column:
    """Item quantities from the deliveries at the same positions, up to the shorter list."""

    def taken(item: Column, shipped: Column) -> Column:
        zero = F.coalesce(F.array_contains(shipped["zero_fields"], "shipquantity"), F.lit(False))
        others = F.filter(item["zero_fields"], lambda z: z != "quantity")
        return item.withField("quantity", shipped["shipquantity"]).withField(
            "zero_fields", F.when(zero, F.array_append(others, F.lit("quantity"))).otherwise(others)
        )

    def zipped(boxes: Column) -> Column:
        return F.transform(
            items, lambda item, i: F.when(i < F.size(boxes), taken(item, F.get(boxes, i))).otherwise(item)
        )

    return F.when(F.size(deliveries) > 0, let(deliveries, zipped)).otherwise(items)


def take_delivered_quantities(df: DataFrame) -> DataFrame:
    zipped = zip_items_with_deliveries(F.col("items"), F.col("deliveries"))
    return df.withColumn("items", F.when(F.col("cfg.shipquantity_repeated"), zipped).otherwise(F.col("items")))


def _is_single(number: Column) -> Column:
    return ~F.coalesce(number.contains(","), F.lit(False))


def money_from_multi(df: DataFrame, compare: str = "string") -> DataFrame:
    """Costs as numbers. A single-invoice record takes the largest money token of
    each cost text and keeps the original total in ``raw_total``; a record with
    several invoices only has plain numbers cast. ``cost_errors`` lists the costs
    whose text gives no number: a total without them would be too low."""
    single = _is_single(F.col("invoice_number"))
    costs = {
        c: F.when(
            ~is_blank(F.col(c)),
            F.when(single, money_value(F.col(c), compare)).otherwise(F.col(c).try_cast("double")),
        )
        for c in COSTS
    }
    lost = [F.when(~is_blank(F.col(c)) & value.isNull(), F.lit(f"{c}: unreadable cost")) for c, value in costs.items()]
    # Without a lambda, which would have all three costs interpreted; no two errors are the same.
    errors = F.array_except(F.array(*lost), F.array(F.lit(None).cast("string")))
    raw_total = F.when(single & ~is_blank(F.col("total")), F.col("total"))
    return df.withColumns({"raw_total": raw_total, "cost_errors": errors, **costs})


def single_dates(df: DataFrame) -> DataFrame:
    """Dates of single-invoice records: the part before the first comma."""
    single = _is_single(F.col("invoice_number"))
    return df.withColumns(
        {c: F.when(single, first_of_list(F.col(c))).otherwise(F.col(c)) for c in ("ship_date", "tran_date")}
    )


def mirror_costs(df: DataFrame) -> DataFrame:
    ship, extra = mirror_cost(F.col("ship_cost"), F.col("extra_item_price"))
    same = F.coalesce(F.col("cfg.same_costs"), F.lit(False))
    return df.withColumns(
        {
            "ship_cost": F.when(same, ship).otherwise(F.col("ship_cost")),
            "extra_item_price": F.when(same, extra).otherwise(F.col("extra_item_price")),
        }
    )


# Fields of an item with its amount, in order.
PRICED_FIELDS = (
    "itemno", "mfg_itemno", "amount", "rate", "quantity_ordered", "quantity", "raw_quantity", "quantity_backordered", "invoice_status", "item_details",
)


@built_once
def _priced_items() -> Column:
    return priced_items(F.col("items"))


def priced_items(items: Column) -> Column:
    """Items with cleaned rate and quantity and an amount: the given one, else rate × quantity.

    An item without rate or quantity is left alone. Numbers are cleaned once to a struct, since
    inside a lambda every use of an expression is evaluated again.
    """

    def cleaned(item: Column) -> Column:
        no_amount = is_blank(item["amount"]) | F.coalesce(F.array_contains(item["zero_fields"], "amount"), F.lit(False))
        usable = ~is_blank(item["rate"]) & ~is_blank(item["quantity"])
        return F.struct(
            *[item[n].alias(n) for n in ("itemno", "mfg_itemno", "invoice_status", "item_details")],
            *[clean_number(item[n]).alias(n) for n in ("amount", "rate", "raw_quantity", *QUANTITIES)],
            usable.alias("counted"),
            (usable & no_amount).alias("computed"),
        )

    def amounts(rows: Column) -> Column:
        return F.transform(rows, lambda x: F.when(x["computed"], x["rate"] * x["quantity"]).otherwise(x["amount"]))

    def priced(rows: Column) -> Column:
        return F.arrays_zip(*[(amounts(rows) if n == "amount" else rows[n]).alias(n) for n in (*PRICED_FIELDS, "counted")])

    return let(F.transform(items, cleaned), priced)


def order_total(df: DataFrame) -> DataFrame:
    """Item amounts and the order total: the given one, else Σ amount + ship cost."""
    priced = df.withColumn("items", _priced_items())
    summed = F.aggregate(
        F.filter("items", lambda i: i["counted"]), F.lit(0.0), lambda acc, i: acc + F.coalesce(i["amount"], F.lit(0.0))
    )
    has_total = F.coalesce(F.col("total") != 0, F.lit(False))
    computed = F.coalesce(summed, F.lit(0.0)) + F.coalesce(F.col("ship_cost"), F.lit(0.0))
    return priced.withColumn("total", F.when(has_total, F.col("total")).otherwise(computed)).withColumn(
        "items", F.arrays_zip(*[F.col("items")[n].alias(n) for n in PRICED_FIELDS])
    )


def drop_helpers(df: DataFrame) -> DataFrame:
    """Deliveries without the field that only the rules above read."""
    return df.withColumn("deliveries", F.transform("deliveries", lambda d: d.dropFields("zero_fields")))


def settle_record(df: DataFrame) -> DataFrame:
    """What happens to a mapped record before it is split or finished."""
    return df.transform(default_from_other_field).transform(map_record_status)

