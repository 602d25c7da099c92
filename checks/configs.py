"""Vendor configs of the test documents: three variants, chosen by ``vendor_id % 3``."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .domain import Domain

MAPPING = [
    ("order.po", "po_number"),
    ("order.status", "invoice_status"),
    ("order.invoice", "invoice_number"),
    ("order.shipped", "ship_date"),
    ("order.tran.id", "tran_id"),
    ("order.tran.date", "tran_date"),
    ("order.ship.cost", "ship_cost"),
    ("order.total", "total"),
    ("order.extra", "extra_item_price"),
    ("RefIDQual['IN']", "memo"),
    ("order.lines[i].part", "items.itemno"),
    ("order.lines[i].mfg", "items.mfg_itemno"),
    ("order.lines[i].qty", "items.quantity"),
    ("order.lines[i].ordered", "items.quantity_ordered"),
    ("order.lines[i].back", "items.quantity_backordered"),
    ("order.lines[i].price", "items.rate"),
    ("order.serial", "items.item_details"),
    ("boxes[i].carrier", "deliveries.carrier"),
    ("boxes[i].service", "deliveries.carriermethod"),
    ("boxes[i].qty", "deliveries.shipquantity"),
    ("boxes[i].weight", "deliveries.weight"),
]
STATUSES = {
    "COMPLETED": ["shipped", "closed"],
    "PROCESSING": ["in process"],
    "PARTIAL": ["part shipped"],
    "CANCELLED": "void",
    "OPEN": ["shipped", "new"],
}
XML_MAPPING = [
    ("Resp.Order.Status", "invoice_status"),
    ("Resp.Order.Invoice", "invoice_number"),
    ("Resp.Order.Cost", "ship_cost"),
    ("Resp.Order.Line[i].Sku", "items.itemno"),
    ("Resp.Order.Line[i].Qty", "items.quantity"),
    ("Resp.Order.Line[i].Ord", "items.quantity_ordered"),
    ("Resp.Order.Line[i].Price", "items.rate"),
]
URL = "https://vendor.example/orders/<<so_number>>?po=<<po_number>>&by=<<vendor_name>>"


SECOND_CALL = {"multi_api_call": {"url": {"raw": "https://vendor.example/invoices/<<invoice_number>>", "method": "GET"}}}


def document(mapping: list[tuple[str, str]], variant: int | None = None) -> dict:
    doc = {
        "mapping": {"fulfillment_table": [{"destination_field": p, "source_field": t} for p, t in mapping]},
        "order_status_mapping": STATUSES,
        "api_request_template": {"url": {"raw": URL, "method": "POST" if variant == 1 else "GET"}, "header": []},
        "data": {"payload_value_to_upper": ["vendor_name"], "xml_payload": "<q><<po_number>></q>"},
    }
    ups, nonups = {"ground": 3, "Ground": 4, "2Day": 5}, {"2day": 7, "2Day": 8, "Overnight": 9}
    if variant == 0:
        doc |= {
            "check_multi_invoice_and_split": True,
            "fields_to_split_for_multi_invoice": ["invoice_number", "items", "ship_date"],
            "use_items_from_first_api_call": True,
            "carrier_mapping": {"ups": ups, "nonups": nonups, "check_character_for_mapping": True,
                                "carriermethod_for_mapping": "carriermethod"},
        }
    elif variant == 1:
        doc |= {
            "check_multi_invoice_and_split": True,
            "check_for_tracking_number_and_set_invoice_accordingly": True,
            "fields_to_split_for_multi_invoice": ["invoice_number", "items", "ship_date", "deliveries"],
            "carrier_mapping": {"ups": ups, "nonups": nonups, "check_string_for_mapping": True,
                                "carriermethod_for_mapping": "carriermethod", "change_carriermethod_to_lowercase": True},
        }
    else:
        doc |= {
            "is_shipcost_and_extraitemprice_same": True,
            "is_shipquantity_repeated": True,
            "order_status_in_different_field_and_deliveries_field_factor": True,
        }
    return doc


def vendor_configs(d: Domain, mapping: list[tuple[str, str]] = MAPPING, extra: list[dict] | None = None) -> DataFrame:
    """``(vendor_id, config)`` for every vendor; ``extra`` adds to the config of each variant."""
    variant = F.col("s_suppkey") % 3
    texts = [json.dumps(document(mapping, v) | (extra[v] if extra else {})) for v in range(3)]
    config = F.when(variant == 0, texts[0]).when(variant == 1, texts[1]).otherwise(texts[2])
    return d.base("supplier").select(F.col("s_suppkey").alias("vendor_id"), config.alias("config"))


def one_config(d: Domain, doc: dict) -> DataFrame:
    """The same config for every vendor."""
    return d.base("supplier").select(F.col("s_suppkey").alias("vendor_id"), F.lit(json.dumps(doc)).alias("config"))


def mapping_values(mapping: list[tuple[str, str]] = MAPPING) -> str:
    """The mapping as a SQL VALUES list ``(ord, path, target)``."""
    rows = ", ".join(f"({i}, '{p.replace(chr(39), chr(39) * 2)}', '{t}')" for i, (p, t) in enumerate(mapping))
    return f"SELECT * FROM (VALUES {rows}) v(ord, path, target)"
