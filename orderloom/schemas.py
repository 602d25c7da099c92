"""Tables, keys and the shape of a mapped order."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import types as T

# Mapped order -------------------------------------------------------------

SERIALS = "array<struct<serialnumber:string>>"
SCALAR_TARGETS = (
    "po_number",
    "memo",
    "ship_date",
    "tran_id",
    "tran_date",
    "invoice_number",
    "invoice_status",
    "status_from_vendor",
    "trackingnumber",
    "ship_cost",
    "total",
    "extra_item_price",
    "tax_amount",
)
ITEM_FIELDS = (
    "itemno",
    "mfg_itemno",
    "amount",
    "rate",
    "quantity_ordered",
    "quantity",
    "raw_quantity",
    "quantity_backordered",
    "invoice_status",
)
DELIVERY_FIELDS = ("carrier", "carriermethod", "shipquantity", "weight", "trackingnumber", "shipdate")

# Targets that are left out when the mapped value counts as false.
SKIP_WHEN_FALSE = ("memo", "shipdate", "invoice_status", "invoice_number")


def _struct_ddl(fields: tuple[str, ...], *extra: str) -> str:
    return "struct<" + ",".join([f"{f}:string" for f in fields] + list(extra)) + ">"


# zero_fields names the fields whose value was a numeric zero or false in the document.
ITEM_TYPE = _struct_ddl(ITEM_FIELDS, f"item_details:{SERIALS}", "zero_fields:array<string>")
DELIVERY_TYPE = _struct_ddl(DELIVERY_FIELDS, "zero_fields:array<string>")

# Compiled vendor config (sources.configs) ------------------------------------

MAPPING_ENTRY = (
    "struct<ord:int,path:string,target:string,grp:string,field:string,kind:string,"
    "first:string,last:string,ends:string,sign:string,idx_seg:int,inner_seg:int,nested:boolean>"
)

# Relational tables ---------------------------------------------------------


@dataclass(frozen=True)
class Table:
    """A target table: writable columns, key, and what an upsert may change."""

    name: str
    columns: dict[str, str]
    key: tuple[str, ...] = ()
    required: tuple[str, ...] = ()
    defaults: dict[str, object] = field(default_factory=dict)
    on_conflict: tuple[str, ...] = ()
    foreign_keys: dict[str, str] = field(default_factory=dict)
    dates: tuple[str, ...] = ()
    json: tuple[str, ...] = ()
    tracks_changes: bool = False

    @property
    def generated(self) -> dict[str, str]:
        made = {"id": "bigint", "created_at": "timestamp_ntz"}
        if self.tracks_changes:
            made["modified_at"] = "timestamp_ntz"
        return made

    @property
    def schema(self) -> T.StructType:
        everything = {"id": "bigint", **self.columns, **self.generated}
        return T.StructType.fromDDL(", ".join(f"`{n}` {t}" for n, t in everything.items()))


SALES_ORDER = Table(
    "sales_order",
    {"soint_id": "bigint", "invoiced": "boolean", "sales_order_status": "string"},
    key=("soint_id",),
    required=("soint_id",),
    defaults={"invoiced": False},
    on_conflict=("sales_order_status",),
    tracks_changes=True,
)
PURCHASE_ORDER = Table(
    "purchase_order",
    {
        "sales_order_id": "bigint",
        "point_id": "bigint",
        "tran_date": "date",
        "vendor_id": "bigint",
        "vendor_po_number": "string",
        "purchase_order_status": "string",
        "vendor_so_number": "string",
        "vendor_name": "string",
        "need_serial_number": "boolean",
    },
    key=("point_id",),
    required=("sales_order_id", "point_id", "vendor_id"),
    on_conflict=("purchase_order_status",),
    foreign_keys={"sales_order_id": "sales_order"},
    dates=("tran_date",),
    tracks_changes=True,
)
VENDOR_INVOICE = Table(
    "vendor_invoice",
    {
        "purchase_order_id": "bigint",
        "memo": "string",
        "tracking_numbers": "string",
        "ship_date": "date",
        "deliveries": "string",
        "invoice_status": "string",
        "invoice_status_raw": "string",
        "tran_id": "string",
        "tran_date": "date",
        "ship_cost": "double",
        "total": "double",
        "raw_total": "string",
        "extra_item_price": "double",
        "invoice_number": "string",
        "tax_amount": "double",
    },
    key=("purchase_order_id", "invoice_number"),
    required=("purchase_order_id",),
    on_conflict=("invoice_status", "deliveries"),
    foreign_keys={"purchase_order_id": "purchase_order"},
    dates=("ship_date", "tran_date"),
    json=("deliveries",),
    tracks_changes=True,
)
VENDOR_INVOICE_ITEMS = Table(
    "vendor_invoice_items",
    {
        "vendor_invoice_id": "bigint",
        "itemno": "string",
        "mfg_itemno": "string",
        "item_details": "string",
        "amount": "double",
        "rate": "double",
        "quantity_ordered": "int",
        "quantity": "int",
        "raw_quantity": "int",
        "quantity_backordered": "int",
    },
    required=("vendor_invoice_id",),
    foreign_keys={"vendor_invoice_id": "vendor_invoice"},
    json=("item_details",),
)


def _outcome_table(name: str, parent_key: str, parent: str, result_id: str) -> Table:
    return Table(
        name,
        {parent_key: "bigint", result_id: "string", "success": "boolean", "message": "string"},
        required=(parent_key,),
        foreign_keys={parent_key: parent},
    )


NS_ITEM_FULFILLMENT = _outcome_table("ns_item_fulfillment", "vendor_invoice_id", "vendor_invoice", "fulfillment_id")
NS_VENDOR_BILL = _outcome_table("ns_vendor_bill", "vendor_invoice_id", "vendor_invoice", "vendor_bill_id")
NS_CUSTOMER_INVOICE = _outcome_table("ns_customer_invoice", "sales_order_id", "sales_order", "customer_invoice_id")

TABLES = {
    t.name: t
    for t in (
        SALES_ORDER,
        PURCHASE_ORDER,
        VENDOR_INVOICE,
        VENDOR_INVOICE_ITEMS,
        NS_ITEM_FULFILLMENT,
        NS_VENDOR_BILL,
        NS_CUSTOMER_INVOICE,
    )
}
