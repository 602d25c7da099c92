"""Whole jobs: feed load, JSON and XML to the same invoices, incremental ingest and replay."""

import json
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from orderloom.plans.dispatch import dispatch
from orderloom.plans.extract import extract
from orderloom.plans.feed_load import load_feed
from orderloom.schemas import PURCHASE_ORDER, SALES_ORDER, VENDOR_INVOICE, VENDOR_INVOICE_ITEMS
from orderloom.sources.configs import compile_configs, config_frame
from orderloom.sources.responses import RESPONSE_SCHEMA, read_json_responses, read_landed, read_xml_responses, rejected_responses, valid_responses
from orderloom.streaming.ingest import InvoiceStore, StoredTable, ingest

FIELDS = [("Status", "invoice_status"), ("Invoice", "invoice_number"), ("Cost", "ship_cost"), ("Line[i].Sku", "items.itemno"),
          ("Line[i].Qty", "items.quantity"), ("Line[i].Ord", "items.quantity_ordered"), ("Line[i].Price", "items.rate")]
CONFIG = {
    "mapping": {"fulfillment_table": [{"destination_field": f"Resp.Order.{p}", "source_field": t} for p, t in FIELDS]},
    "order_status_mapping": {"COMPLETED": ["shipped"], "CANCELLED": ["void"]},
}
ORDERS = [
    (1, "shipped", "INV1", [("01", 2, 2, "$10.00"), ("02", 1, 3, "5.50")]),
    (2, "void", "INV2", [("03", 1, 1, "1.00")]),
    (3, "shipped", "INV3", [("04", 4, 4, "2.25")]),
    (4, "shipped", "", [("05", 4, 4, "2.25")]),
]


def as_json(status, invoice, lines):
    rows = [{"Sku": s, "Qty": str(q), "Ord": str(o), "Price": p} for s, q, o, p in lines]
    return json.dumps({"Resp": {"Order": {"Status": status, "Invoice": invoice, "Cost": "4.00", "Line": rows}}})


def as_xml(status, invoice, lines):
    rows = "".join(f"<Line><Sku>{s}</Sku><Qty>{q}</Qty><Ord>{o}</Ord><Price>{p}</Price></Line>" for s, q, o, p in lines)
    return f"<Resp><Order><Status>{status}</Status><Invoice>{invoice}</Invoice><Cost>4.00</Cost>{rows}</Order></Resp>"


def responses(spark, written, orders=ORDERS):
    rows = [(1, f"SO{n}", f"PO{n}", True, 200, "OK", written(*rest), None) for n, *rest in orders]
    rows += [(1, "SO8", "PO8", True, 404, "Not Found", "{}", None), (1, "SO9", "PO9", True, 200, "OK", "{bad", None), (1, "SO7", "PO7", True, 200, "OK", "", None)]
    return spark.createDataFrame(rows, RESPONSE_SCHEMA)


def purchase_orders(spark):
    rows = [(n, 1, f"SO{n}", f"PO{n}") for n in range(1, 6)]
    return spark.createDataFrame(rows, "id bigint, vendor_id bigint, vendor_so_number string, vendor_po_number string")


def compiled(spark):
    return compile_configs(config_frame(spark, {1: CONFIG}))


def view(invoices, items):
    joined = invoices.join(items.select(F.col("vendor_invoice_id").alias("id"), "itemno", "amount", "quantity"), "id", "left")
    return {(r.purchase_order_id, r.invoice_number, r.invoice_status, r.total, r.itemno, r.amount, r.quantity) for r in joined.collect()}


EXPECTED = {
    (1, "INV1", "PARTIAL", 29.5, "01", 20.0, 2),
    (1, "INV1", "PARTIAL", 29.5, "02", 5.5, 1),
    (3, "INV3", "COMPLETED", 13.0, "04", 9.0, 4),
}


def dispatched(spark, finished):
    result = dispatch(
        finished.drop("cfg"), purchase_orders(spark),
        spark.createDataFrame([], VENDOR_INVOICE.schema), spark.createDataFrame([], VENDOR_INVOICE_ITEMS.schema),
    )
    return view(result.vendor_invoice, result.vendor_invoice_items)


def test_json_and_xml_give_the_same_invoices(spark):
    tagged = read_json_responses(responses(spark, as_json))
    assert {r.so_number: r.reject_reason for r in rejected_responses(tagged).collect()} == {
        "SO7": "empty body", "SO8": "http status", "SO9": "malformed body",
    }
    assert dispatched(spark, extract(valid_responses(tagged), compiled(spark))) == EXPECTED
    parsed = valid_responses(read_xml_responses(responses(spark, as_xml)))
    assert parsed.count() == len(ORDERS)
    assert dispatched(spark, extract(parsed, compiled(spark), lone_lists=True)) == EXPECTED


def test_incremental_ingest_matches_the_batch_and_survives_replay(spark, tmp_path):
    landing, store = str(tmp_path / "landing"), InvoiceStore.at(str(tmp_path / "tables"), buckets=4)
    store.create(spark)

    def work_off():
        ingest(spark, landing, store, lambda: compiled(spark), lambda: purchase_orders(spark),
               checkpoint=str(tmp_path / "checkpoint"), max_files=1).awaitTermination()

    responses(spark, as_json, ORDERS[:2]).coalesce(1).write.mode("append").json(landing)
    work_off()
    responses(spark, as_json, ORDERS[2:]).coalesce(1).write.mode("append").json(landing)
    work_off()
    assert read_landed(spark, landing).count() == len(ORDERS) + 6
    stored = view(store.invoices.read(spark), store.items.read(spark))
    assert stored == EXPECTED
    ids = {r.id for r in store.invoices.read(spark).collect()}
    assert ids == {1, 2}

    # a batch that is replayed after it was staged, and one that brings known records again
    def finished():
        return extract(valid_responses(read_json_responses(responses(spark, as_json))), compiled(spark)).drop("cfg")

    for skip_loaded in (False, False, True):
        store.apply(spark, finished, lambda: purchase_orders(spark), batch=0, source="again", skip_loaded=skip_loaded)
        assert view(store.invoices.read(spark), store.items.read(spark)) == EXPECTED
        assert {r.id for r in store.invoices.read(spark).collect()} == ids


def test_a_batch_that_dies_while_replacing_is_completed_by_its_replay(spark, tmp_path):
    store = InvoiceStore.at(str(tmp_path / "tables"), buckets=4)
    store.create(spark)

    def finished():
        return extract(valid_responses(read_json_responses(responses(spark, as_json))), compiled(spark)).drop("cfg")

    class Dies(StoredTable):
        def replace_from(self, spark, path, touched):
            raise RuntimeError("lost")

    dying = replace(store, items=Dies(store.items.path, store.items.table, store.items.bucket_by, store.items.buckets))
    with pytest.raises(RuntimeError, match="lost"):
        dying.apply(spark, finished, lambda: purchase_orders(spark), batch=0)
    assert store.invoices.read(spark).count() == 2 and store.items.read(spark).count() == 0
    store.apply(spark, finished, lambda: purchase_orders(spark), batch=0)
    assert view(store.invoices.read(spark), store.items.read(spark)) == EXPECTED


def test_feed_load(spark):
    entries = [
        {"internalid": "1", "createdfrom": "10", "status": "pendingReceipt", "so": "70", "v": "3"},
        {"internalid": "1", "createdfrom": "10", "status": "fullyBilled", "so": "70", "v": "3"},
        {"internalid": "2", "createdfrom": None, "status": "pendingReceipt", "so": "70", "v": "3"},
        {"internalid": "3", "createdfrom": "12", "status": "bogus", "so": "71", "v": "3"},
    ]
    feed = spark.createDataFrame([(json.dumps({"data": entries}),)], "body string")
    mapping = {"point_id": "internalid", "soint_id": "so", "purchase_order_status": "status", "vendor_id": "v"}
    empty = lambda t: spark.createDataFrame([], t.schema)
    result = load_feed(feed, mapping, ("pendingReceipt", "fullyBilled"), empty(SALES_ORDER), empty(PURCHASE_ORDER))
    assert [(r.id, r.soint_id) for r in result.sales_order.collect()] == [(1, 70)]
    rows = {(r.point_id, r.sales_order_id, r.purchase_order_status) for r in result.purchase_order.collect()}
    assert rows == {(1, 1, "pendingReceipt"), (2, 1, "pendingReceipt")}
    assert [r.point_id for r in result.unknown_status.collect()] == ["3"]
