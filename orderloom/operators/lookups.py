"""Open orders, lookups and set joins that replace per-record queries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.common import is_blank
from ..functions.dates import first_date
from ..functions.money import money_or_zero
from ..functions.status import OPEN_FOR_BILLING
from ..functions.text import ship_complete_flag
from ..sizing import broadcast_if_small, repeat_rows
from .aggregates import items_object_array, object_agg, unbilled_invoice_filter


def orders_left_invoices(orders: DataFrame, invoices: DataFrame) -> DataFrame:
    """``orders ⟕ invoices`` on the order id where no invoice column is used:
    each order once per invoice, once if it has none.

    Invoices are counted per order first, so an order with very many invoices
    crosses the shuffle as one row and is repeated after the join.
    """
    counted = invoices.groupBy(F.col("purchase_order_id").alias("id")).agg(F.count("*").alias("_n"))
    joined = orders.join(counted, "id", "left").withColumn("_n", F.coalesce("_n", F.lit(1)))
    return repeat_rows(joined, "_n", "_copy").select(*orders.columns)


def _open_orders(orders: DataFrame, statuses: tuple[str, ...], vendor_id: int | None) -> DataFrame:
    rows = orders.filter(F.col("purchase_order_status").isin(*statuses))
    return rows if vendor_id is None else rows.filter(F.col("vendor_id") == vendor_id)


def _pending(orders, invoices, columns, statuses, vendor_id, distinct):
    kept = _open_orders(orders, statuses, vendor_id).select("id", "vendor_id", *[c for c, _ in columns])
    repeated = kept if distinct else orders_left_invoices(kept, invoices)
    out = repeated.select("vendor_id", *[F.col(c).alias(a) for c, a in columns])
    return out.distinct() if distinct else out


def pending_sales_orders(
    orders: DataFrame,
    invoices: DataFrame,
    vendor_id: int | None = None,
    statuses: tuple[str, ...] = OPEN_FOR_BILLING,
    distinct: bool = False,
) -> DataFrame:
    """Sales order numbers and serial flags of orders still open; all vendors, or one.

    An order repeats once per invoice unless ``distinct``.
    """
    columns = [("vendor_so_number", "so_number"), ("need_serial_number", "need_serial_no")]
    return _pending(orders, invoices, columns, statuses, vendor_id, distinct)


def pending_purchase_orders(
    orders: DataFrame,
    invoices: DataFrame,
    vendor_id: int | None = None,
    statuses: tuple[str, ...] = OPEN_FOR_BILLING,
    distinct: bool = False,
) -> DataFrame:
    """As ``pending_sales_orders``, with the purchase order number."""
    columns = [
        ("vendor_po_number", "po_number"),
        ("vendor_so_number", "so_number"),
        ("need_serial_number", "need_serial_no"),
    ]
    return _pending(orders, invoices, columns, statuses, vendor_id, distinct)


def order_id_by(requests: DataFrame, orders: DataFrame, number: str, order_column: str) -> DataFrame:
    """Every order id for each requested ``(vendor_id, number)``."""
    ids = orders.select("vendor_id", F.col(order_column).alias(number), "id")
    return requests.join(ids, ["vendor_id", number], "inner")


def order_id_by_so(requests: DataFrame, orders: DataFrame) -> DataFrame:
    return order_id_by(requests, orders, "so_number", "vendor_so_number")


def order_id_by_po(requests: DataFrame, orders: DataFrame) -> DataFrame:
    return order_id_by(requests, orders, "po_number", "vendor_po_number")


def existing_invoice_numbers(invoices: DataFrame) -> DataFrame:
    return invoices.filter(F.col("invoice_number").isNotNull()).select("purchase_order_id", "invoice_number")


def not_fully_billed(orders: DataFrame) -> DataFrame:
    """Orders whose status is known and not ``fullyBilled``."""
    return orders.filter(F.col("purchase_order_status") != "fullyBilled")


def vendor_schedule(configs: DataFrame, orders: DataFrame, vendors: DataFrame, config_prefix: str) -> DataFrame:
    """One row per vendor with orders: config path, template values, connection type.

    Orders only decide which vendors appear, so they join as distinct vendor ids.
    """
    active = orders.select("vendor_id").distinct()
    values = object_agg(
        configs.join(active, "vendor_id", "left_semi"), ["vendor_id"], "key_name", "value", "ord", "template_values"
    )
    return values.join(broadcast_if_small(vendors), "vendor_id", "inner").select(
        "vendor_id",
        F.concat(F.lit(config_prefix), F.col("vendor_id").cast("string"), F.lit(".json")).alias("config_file_path"),
        "template_values",
        "connection_type",
    )


def _no_match_salt(df: DataFrame, buckets: int = 1024) -> Column:
    """A spread-out stand-in for a missing key, so keyless rows do not meet in one task."""
    plain = [f.name for f in df.schema.fields if f.dataType.typeName() in ("string", "long", "integer", "double", "date")]
    return F.concat(F.lit("none-"), F.pmod(F.xxhash64(*plain), F.lit(buckets)).cast("string"))


def resolve_order_id(records: DataFrame, orders: DataFrame, mode: str = "quarantine") -> DataFrame:
    """Attach ``purchase_order_id`` by sales order number if the record has one,
    else by purchase order number; the lowest id wins.

    Adds ``reject_reason`` for records without a match (``mode='fail'`` aborts).
    A given sales order number without a match does not fall back to the other.
    Both lookups are one keyed table, so records are shuffled once.
    """
    if mode not in ("quarantine", "fail"):
        raise ValueError(f"mode must be 'quarantine' or 'fail', not {mode!r}")
    numbers = F.array(
        F.struct(F.lit("so").alias("_by"), F.col("vendor_so_number").alias("_number")),
        F.struct(F.lit("po").alias("_by"), F.col("vendor_po_number").alias("_number")),
    )
    known = (
        orders.select("vendor_id", "id", F.inline(numbers))
        .filter(F.col("_number").isNotNull())
        .groupBy("vendor_id", "_by", "_number")
        .agg(F.min("id").alias("_found"))
    )
    by = F.when(~is_blank(F.col("so_number")), "so").when(~is_blank(F.col("po_number")), "po").otherwise("none")
    keyed = records.withColumn("_by", by).withColumn(
        "_number",
        F.when(F.col("_by") == "so", F.col("so_number"))
        .when(F.col("_by") == "po", F.col("po_number"))
        .otherwise(_no_match_salt(records)),
    )
    joined = keyed.join(known, ["vendor_id", "_by", "_number"], "left")
    given = F.col("purchase_order_id") if "purchase_order_id" in records.columns else F.lit(None).cast("bigint")
    order_id = F.coalesce(given, F.col("_found"))
    why = F.when(F.col("_by") == "none", "no order number").otherwise("no matching order")
    if mode == "fail":
        why = F.raise_error(why).cast("string")
    rest = [c for c in records.columns if c != "purchase_order_id"]
    return joined.select(
        *rest,
        order_id.alias("purchase_order_id"),
        F.when(order_id.isNull(), why).alias("reject_reason"),
    )


def orders_of(records: DataFrame, orders: DataFrame) -> DataFrame:
    """The orders that a batch's records can name, by sales or purchase order number.

    A batch is small beside the orders: where its numbers were measured to fit, the
    orders are filtered as they are read and nothing of them is shuffled.
    """
    found = []
    for name in ("so_number", "po_number"):
        own = f"vendor_{name}"
        named = records.select("vendor_id", F.col(name).alias(own)).filter(F.col(own).isNotNull()).distinct()
        found.append(orders.join(broadcast_if_small(named), ["vendor_id", own], "left_semi").select(*orders.columns))
    return found[0].unionByName(found[1])


def drop_loaded_invoices(records: DataFrame, invoices: DataFrame, mode: str = "intent") -> DataFrame:
    """Remove records whose invoice is already stored for their order.

    Records without an invoice number stay. ``mode='strict'`` pools the stored
    numbers of all the batch's orders and, once that pool is not empty, keeps
    only records without a number.
    """
    stored = existing_invoice_numbers(invoices).distinct()
    if mode == "intent":
        return records.join(stored, ["purchase_order_id", "invoice_number"], "left_anti").select(*records.columns)
    if mode == "strict":
        pool = stored.join(records.select("purchase_order_id").distinct(), "purchase_order_id", "left_semi")
        has_pool = pool.agg((F.count("*") > 0).alias("_pooled")).select("_pooled").scalar()
        return records.filter(is_blank(F.col("invoice_number")) | ~has_pool)
    raise ValueError(f"mode must be 'intent' or 'strict', not {mode!r}")


def attach_sales_order_id(orders: DataFrame, key_to_id: DataFrame) -> DataFrame:
    """Replace ``soint_id`` by the generated parent id ``sales_order_id``.

    Orders without one are spread over all tasks by a second key.
    """
    spread = F.when(F.col("soint_id").isNull(), _no_match_salt(orders)).otherwise("").alias("_spread")
    ids = key_to_id.select("soint_id", F.lit("").alias("_spread"), F.col("id").alias("sales_order_id"))
    return orders.select("*", spread).join(ids, ["soint_id", "_spread"], "left").drop("soint_id", "_spread")


def attach_invoice_id(records: DataFrame, key_to_id: DataFrame) -> DataFrame:
    """One row per item with the generated id of its invoice.

    Keyed by order and invoice number, so two invoices of an order keep their
    own items.
    """
    key = F.coalesce(F.col("invoice_number"), F.lit("-1")).alias("_invoice")
    ids = key_to_id.select("purchase_order_id", key, F.col("id").alias("vendor_invoice_id"))
    items = records.select("purchase_order_id", key, "items").filter(F.size("items") > 0)
    return items.join(ids, ["purchase_order_id", "_invoice"], "inner").select("vendor_invoice_id", F.inline("items"))


def vendor_bill_objects(
    orders: DataFrame,
    invoices: DataFrame,
    items: DataFrame,
    outcomes: DataFrame,
    statuses: tuple[str, ...] = OPEN_FOR_BILLING,
    extra_item: tuple[int, int] = (0, 1),
) -> DataFrame:
    """Invoices ready to be billed, each with the JSON array of its items.

    ``extra_item`` is the ERP's id and the quantity of the item that a bill's extra cost is booked on.

    Invoices with an outcome row that has a success flag, a message or a bill id
    are out. The item array exists only for invoices with a positive quantity,
    which also makes the join to the items themselves redundant, and with one row
    per invoice there is nothing left to group.
    """
    vo = orders.filter(F.col("purchase_order_status").isin(*statuses)).select(
        F.col("id").alias("purchase_order_id"),
        "point_id",
        "sales_order_id",
        "vendor_id",
        "vendor_name",
        F.col("tran_date").alias("order_date"),
    )
    unbilled = unbilled_invoice_filter(invoices, outcomes)
    arrays = items_object_array(items).withColumnRenamed("vendor_invoice_id", "id")
    joined = unbilled.join(vo, "purchase_order_id", "inner").join(arrays, "id", "inner")
    return joined.select(
        "point_id",
        "sales_order_id",
        "vendor_id",
        "items",
        "tracking_numbers",
        ship_complete_flag(F.col("ship_date").cast("string")).alias("shipcomplete"),
        "ship_date",
        "tran_id",
        first_date(F.col("tran_date"), F.col("ship_date"), F.col("order_date")).alias("tran_date"),
        money_or_zero(F.col("ship_cost")).alias("ship_cost"),
        "vendor_name",
        F.col("total").cast("double").alias("total"),
        "id",
        F.lit(extra_item[0]).alias("extra_item_intid"),
        F.lit(extra_item[1]).alias("extra_item_qty"),
        money_or_zero(F.col("extra_item_price")).alias("extra_item_price"),
    )


def update_where_in_subquery(df: DataFrame, selected_ids: DataFrame, changes: dict[str, Column], key: str = "id") -> DataFrame:
    """Apply ``changes`` to rows whose key is among ``selected_ids``."""
    marks = selected_ids.select(key).distinct().withColumn("_hit", F.lit(True))
    joined = df.join(marks, key, "left")
    return joined.select(*[F.when(F.col("_hit"), changes[c]).otherwise(F.col(c)).alias(c) if c in changes else F.col(c) for c in df.columns])
