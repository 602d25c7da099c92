"""Table mutations and whole jobs."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderloom.operators import mutations
from orderloom.plans.dispatch import dispatch
from orderloom.plans.extract import extract
from orderloom.plans.feed_load import load_feed
from orderloom.schemas import PURCHASE_ORDER, SALES_ORDER, VENDOR_INVOICE, VENDOR_INVOICE_ITEMS
from orderloom.session import shared_folder
from orderloom.sources import configs, responses
from orderloom.streaming.ingest import InvoiceStore, ingest

from .configs import XML_MAPPING, vendor_configs
from .domain import Domain, oracle
from .q_nested import MAPPED_LINES, SPLIT_BASE
from .q_rules import FINISH_ORACLE, FINISHED, PIECES
from .q_sources import FEED_MAPPING, KNOWN, MAPPED_SQL, SETTLED_SQL, feed_documents
from .registry import query

BUCKET_SQL = "substr(md5({}), 1, 3)"


def stored(d: Domain, name: str, table) -> DataFrame:
    """A domain table with the generated columns of its declaration."""
    rows = d.table(name)
    return rows.select(
        *[
            (F.col(f.name).cast(f.dataType) if f.name in rows.columns else F.lit(None).cast(f.dataType)).alias(f.name)
            for f in table.schema.fields
        ]
    )


def invoice_items(d: Domain) -> DataFrame:
    """Stored items; ids are numbered by content, as the load does."""
    rows = d.table("vendor_invoice_items").select(
        "vendor_invoice_id", "itemno", "mfg_itemno", (F.col("amount") / 100).alias("amount"),
        F.col("quantity").cast("int").alias("quantity"),
    )
    empty = d.spark.createDataFrame([], VENDOR_INVOICE_ITEMS.schema)
    none = empty.select("vendor_invoice_id")
    return mutations.replace_children(empty, rows, none, "vendor_invoice_id")


NEW_CUSTOMERS = """SELECT c_custkey + {shift} AS soint_id, FALSE AS invoiced, 'new' AS sales_order_status FROM customer"""


@query(
    "insert_rows",
    oracle(
        f"""SELECT id, soint_id, sales_order_status, FALSE AS is_new FROM sales_order UNION ALL
        SELECT (SELECT max(id) FROM sales_order) + row_number() OVER (ORDER BY {BUCKET_SQL.format('CAST(soint_id AS VARCHAR)')}, CAST(soint_id AS VARCHAR)),
        soint_id, sales_order_status, TRUE FROM n""",
        "sales_order",
        n=NEW_CUSTOMERS.format(shift=10_000_000),
    ),
)
def _(d: Domain) -> DataFrame:
    target = stored(d, "sales_order", SALES_ORDER)
    d.base("customer").createOrReplaceTempView("customer")
    rows = d.spark.sql(NEW_CUSTOMERS.format(shift=10_000_000))
    result = mutations.insert_rows(target, rows, ["soint_id"])
    return result.select("id", "soint_id", "sales_order_status", F.col("created_at").isNotNull().alias("is_new"))


@query(
    "update_by_key",
    oracle(
        """SELECT id, CASE WHEN id % 3 = 0 THEN 'done' ELSE purchase_order_status END AS purchase_order_status, vendor_name,
        id % 3 = 0 AS touched FROM purchase_order""",
        "purchase_order",
    ),
)
def _(d: Domain) -> DataFrame:
    target = stored(d, "purchase_order", PURCHASE_ORDER)
    changes = d.table("purchase_order").filter("id % 3 = 0").select("id", F.lit("done").alias("purchase_order_status"))
    result = mutations.update_by_key(target, changes)
    return result.select("id", "purchase_order_status", "vendor_name", F.col("modified_at").isNotNull().alias("touched"))


def _upsert_oracle(update: str) -> str:
    new_id = f"row_number() OVER (ORDER BY {BUCKET_SQL.format('CAST(soint_id AS VARCHAR)')}, CAST(soint_id AS VARCHAR))"
    return oracle(
        f"""SELECT s.id, s.soint_id, {update} FROM sales_order s LEFT JOIN n ON n.soint_id = s.soint_id
        UNION ALL SELECT (SELECT max(id) FROM sales_order) + {new_id}, soint_id, sales_order_status, invoiced, 'inserted' FROM n
        WHERE soint_id NOT IN (SELECT soint_id FROM sales_order)""",
        "sales_order",
        n=NEW_CUSTOMERS.format(shift=50),
    )


def _upsert(d: Domain, update: str) -> DataFrame:
    target = stored(d, "sales_order", SALES_ORDER)
    d.base("customer").createOrReplaceTempView("customer")
    rows = d.spark.sql(NEW_CUSTOMERS.format(shift=50))
    result = mutations.bulk_upsert(target, rows, SALES_ORDER, update=update)
    return result.select("id", "soint_id", "sales_order_status", "invoiced", F.col("_change").alias("change"))


@query(
    "bulk_upsert",
    _upsert_oracle(
        """CASE WHEN n.soint_id IS NULL THEN s.sales_order_status ELSE n.sales_order_status END AS sales_order_status,
        CASE WHEN n.soint_id IS NULL THEN s.invoiced ELSE n.invoiced END AS invoiced, CASE WHEN n.soint_id IS NOT NULL THEN 'updated' END AS change"""
    ),
)
def _(d: Domain) -> DataFrame:
    return _upsert(d, "all")


@query("bulk_upsert_do_nothing", _upsert_oracle("s.sales_order_status, s.invoiced, NULL AS change"))
def _(d: Domain) -> DataFrame:
    return _upsert(d, "nothing")


@query(
    "upsert_sales_orders",
    _upsert_oracle(
        """CASE WHEN n.soint_id IS NULL THEN s.sales_order_status ELSE n.sales_order_status END AS sales_order_status,
        s.invoiced, CASE WHEN n.soint_id IS NOT NULL THEN 'updated' END AS change"""
    ),
)
def _(d: Domain) -> DataFrame:
    return _upsert(d, "declared")


_NEW_ORDERS = """SELECT o_orderkey + 500000000 + CASE WHEN o_orderkey % 10 = 0 THEN 400000000 ELSE 0 END AS point_id, o_custkey + 1000 AS sales_order_id,
  o_orderkey % 7 AS vendor_id, 'changed' AS purchase_order_status, 'other' AS vendor_name FROM orders WHERE o_orderkey % 2 = 0"""


@query(
    "upsert_purchase_orders",
    oracle(
        f"""SELECT p.id, p.point_id, CASE WHEN n.point_id IS NULL THEN p.purchase_order_status ELSE 'changed' END AS purchase_order_status, p.vendor_name
        FROM purchase_order p LEFT JOIN n ON n.point_id = p.point_id
        UNION ALL SELECT (SELECT max(id) FROM purchase_order) + row_number() OVER (ORDER BY {BUCKET_SQL.format('CAST(point_id AS VARCHAR)')}, CAST(point_id AS VARCHAR)),
        point_id, purchase_order_status, vendor_name FROM n WHERE point_id >= 900000000""",
        "purchase_order",
        n=_NEW_ORDERS,
    ),
)
def _(d: Domain) -> DataFrame:
    d.base("orders").createOrReplaceTempView("orders")
    result = mutations.upsert_purchase_orders(stored(d, "purchase_order", PURCHASE_ORDER), d.spark.sql(_NEW_ORDERS))
    return result.select("id", "point_id", "purchase_order_status", "vendor_name")


_NEW_INVOICES = """SELECT purchase_order_id, CASE WHEN id % 5 = 0 AND invoice_number IS NOT NULL THEN invoice_number || 'X' ELSE invoice_number END AS invoice_number,
  'PARTIAL' AS invoice_status, 'changed' AS memo, CAST(id AS VARCHAR(20)) AS deliveries FROM vendor_invoice WHERE id % 2 = 0"""


@query(
    "upsert_invoices",
    oracle(
        f"""SELECT v.id, v.purchase_order_id, v.invoice_number, CASE WHEN hit THEN 'PARTIAL' ELSE v.invoice_status END AS invoice_status, v.memo,
        CASE WHEN hit THEN n.deliveries ELSE v.deliveries END AS deliveries
        FROM vendor_invoice v LEFT JOIN (SELECT *, TRUE AS hit FROM n) n ON n.purchase_order_id = v.purchase_order_id AND coalesce(n.invoice_number, '-1') = coalesce(v.invoice_number, '-1')
        UNION ALL SELECT (SELECT max(id) FROM vendor_invoice) + row_number() OVER (ORDER BY {BUCKET_SQL.format("purchase_order_id || '|' || invoice_number")}, purchase_order_id || '|' || invoice_number),
        purchase_order_id, invoice_number, invoice_status, memo, deliveries FROM n WHERE invoice_number LIKE '%X'""",
        "vendor_invoice",
        n=_NEW_INVOICES,
    ),
)
def _(d: Domain) -> DataFrame:
    result = mutations.upsert_invoices(stored(d, "vendor_invoice", VENDOR_INVOICE), d.sql(_NEW_INVOICES, "vendor_invoice"))
    return result.select("id", "purchase_order_id", "invoice_number", "invoice_status", "memo", "deliveries")


@query(
    "replace_children",
    oracle(
        """SELECT vendor_invoice_id, itemno, mfg_itemno, amount / 100 AS amount, CAST(quantity AS INTEGER) AS quantity FROM vendor_invoice_items WHERE vendor_invoice_id % 4 <> 0
        UNION ALL SELECT id, 'NEW', NULL, 1.0, 1 FROM vendor_invoice WHERE id % 8 = 0""",
        "vendor_invoice",
        "vendor_invoice_items",
    ),
)
def _(d: Domain) -> DataFrame:
    invoices = d.table("vendor_invoice")
    new = invoices.filter("id % 8 = 0").select(
        F.col("id").alias("vendor_invoice_id"), F.lit("NEW").alias("itemno"), F.lit(1.0).alias("amount"), F.lit(1).alias("quantity")
    )
    parents = invoices.filter("id % 4 = 0").select(F.col("id").alias("vendor_invoice_id"))
    result = mutations.replace_children(invoice_items(d), new, parents, "vendor_invoice_id")
    return result.select("vendor_invoice_id", "itemno", "mfg_itemno", "amount", "quantity")


@query(
    "assign_ids",
    oracle(
        f"""SELECT (SELECT max(id) FROM sales_order) + row_number() OVER (ORDER BY {BUCKET_SQL.format("o || '|' || k")}, o || '|' || k) AS id, o, k FROM
        (SELECT l_orderkey AS o, row_number() OVER (PARTITION BY l_orderkey) AS k FROM lineitem)""",
        "sales_order",
    ),
)
def _(d: Domain) -> DataFrame:
    counted = d.base("lineitem").groupBy(F.col("l_orderkey").alias("o")).agg(F.count("*").alias("n"))
    rows = counted.select("o", F.explode(F.sequence(F.lit(1).cast("bigint"), "n")).alias("k"))
    return mutations.assign_ids(rows, d.table("sales_order"), ["o", "k"]).select("id", "o", "k")


@query(
    "update_bill_results",
    oracle(
        """SELECT id, CASE WHEN id % 2 = 0 THEN TRUE ELSE success END AS success, CASE WHEN id % 2 = 0 THEN 'N' || id ELSE vendor_bill_id END AS vendor_bill_id,
        CASE WHEN id % 2 = 0 THEN NULL ELSE message END AS message FROM bill_outcome""",
        "bill_outcome",
    ),
)
def _(d: Domain) -> DataFrame:
    outcomes = d.table("bill_outcome")
    # result arrays come in batches of about a hundred
    batches = outcomes.filter("id % 2 = 0").groupBy(F.floor(F.col("id") / 300).alias("batch")).agg(F.collect_list("id").alias("id"))
    arrays = batches.select(
        "id",
        F.transform("id", lambda i: F.lit(True)).alias("success"),
        F.transform("id", lambda i: F.concat(F.lit("N"), i.cast("string"))).alias("vendor_bill_id"),
        F.transform("id", lambda i: F.lit(None).cast("string")).alias("message"),
    )
    return mutations.update_bill_results(outcomes, arrays).select("id", "success", "vendor_bill_id", "message")


@query(
    "update_order_status",
    oracle(
        "SELECT point_id, CASE WHEN id % 3 = 1 THEN 'fullyBilled' ELSE purchase_order_status END AS purchase_order_status FROM purchase_order", "purchase_order"
    ),
)
def _(d: Domain) -> DataFrame:
    orders = d.table("purchase_order")
    batches = orders.filter("id % 3 = 1").groupBy(F.floor(F.col("id") / 300).alias("batch")).agg(F.collect_list("point_id").alias("point_id"))
    arrays = batches.select("point_id", F.transform("point_id", lambda p: F.lit("fullyBilled")).alias("purchase_order_status"))
    return mutations.update_order_status(orders, arrays).select("point_id", "purchase_order_status")


@query(
    "check_unique",
    "SELECT l_orderkey AS purchase_order_id, l_returnflag AS invoice_number, count(*) AS n FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1",
)
def _(d: Domain) -> DataFrame:
    rows = d.base("lineitem").select(F.col("l_orderkey").alias("purchase_order_id"), F.col("l_returnflag").alias("invoice_number"))
    return mutations.check_unique(rows, VENDOR_INVOICE)


@query(
    "check_foreign_keys",
    oracle("SELECT id, purchase_order_id FROM vendor_invoice WHERE purchase_order_id % 10 = 0", "vendor_invoice"),
)
def _(d: Domain) -> DataFrame:
    parents = d.table("purchase_order").filter("id % 10 <> 0")
    return mutations.check_foreign_keys(d.table("vendor_invoice"), "purchase_order_id", parents).select("id", "purchase_order_id")


# --- jobs ------------------------------------------------------------------------


@query(
    "feed_load_job",
    oracle(
        """SELECT o_orderkey AS point_id, o_custkey AS soint_id, CAST(o_orderdate AS DATE) AS tran_date, o_orderkey % 7 AS vendor_id,
        CASE o_orderstatus WHEN 'F' THEN 'fullyBilled' WHEN 'O' THEN 'pendingReceipt' ELSE 'partiallyReceived' END AS purchase_order_status,
        's' || min(o_orderkey) OVER (PARTITION BY o_custkey) || '-0' AS sales_order_status
        FROM orders WHERE o_orderkey % 13 <> 0"""
    ),
)
def _(d: Domain) -> DataFrame:
    result = load_feed(
        feed_documents(d), FEED_MAPPING, KNOWN,
        d.spark.createDataFrame([], SALES_ORDER.schema), d.spark.createDataFrame([], PURCHASE_ORDER.schema), order_by=("page",),
    )
    parents = result.sales_order.select(F.col("id").alias("sales_order_id"), "soint_id", "sales_order_status")
    return result.purchase_order.join(parents, "sales_order_id").select(
        "point_id", "soint_id", "tran_date", "vendor_id", "purchase_order_status", "sales_order_status"
    )


def finished_records(d: Domain) -> DataFrame:
    documents = responses.valid_responses(responses.read_json_responses(d.responses()))
    return extract(documents, configs.compile_configs(vendor_configs(d))).drop("cfg")


# Records of orders whose sales order number is shared meet at the lowest id.
DISPATCHED = """SELECT least_id AS purchase_order_id, f.* FROM (SELECT f.*, d.so_number, d.vendor_id, d.id AS own_id FROM fin f JOIN docs d ON d.rec_id = f.rec_id
  WHERE d.o % 19 <> 4 AND d.o % 23 <> 7 AND d.o % 17 NOT IN (3, 6)) f
  JOIN (SELECT vendor_id, vendor_so_number, min(id) AS least_id FROM purchase_order GROUP BY 1, 2) p ON p.vendor_id = f.vendor_id AND p.vendor_so_number = f.so_number"""
_DISPATCH_CTES = dict(
    mapped=MAPPED_SQL, settled=SETTLED_SQL, lines=MAPPED_LINES, base=SPLIT_BASE, pieces=PIECES, finished=FINISHED, fin=FINISH_ORACLE, sent=DISPATCHED
)
DISPATCH_SQL = oracle(
    """SELECT purchase_order_id, invoice_number, invoice_status, TRY_CAST(CASE WHEN contains(ship_date, ',') THEN NULL ELSE ship_date END AS DATE) AS ship_date, ship_cost, total, n_items
    FROM sent WHERE NOT contains(ship_date, ',')""",
    "docs",
    **_DISPATCH_CTES,
)


def _invoice_view(invoices: DataFrame, items: DataFrame) -> DataFrame:
    counted = items.groupBy(F.col("vendor_invoice_id").alias("id")).agg(F.count("*").alias("n_items"))
    return invoices.join(counted, "id", "left").select(
        "purchase_order_id", "invoice_number", "invoice_status", "ship_date",
        F.round("ship_cost", 2).alias("ship_cost"), F.round("total", 2).alias("total"), "n_items",
    )


@query("dispatch_job", DISPATCH_SQL)
def _(d: Domain) -> DataFrame:
    result = dispatch(
        finished_records(d),
        d.table("purchase_order"),
        d.spark.createDataFrame([], VENDOR_INVOICE.schema),
        d.spark.createDataFrame([], VENDOR_INVOICE_ITEMS.schema),
    )
    return _invoice_view(result.vendor_invoice, result.vendor_invoice_items)


@query("incremental_ingest", DISPATCH_SQL)
def _(d: Domain) -> DataFrame:
    root = f"{shared_folder(d.spark)}/ingest-{uuid.uuid4().hex}"
    landed = d.responses().select(
        "vendor_id", "so_number", "po_number", "need_serial_no", "status_code", "reason", "body", F.lit("json").alias("content_type")
    )
    landed.repartition(4, "so_number").write.json(f"{root}/landing")
    store = InvoiceStore.at(root, buckets=8)
    store.create(d.spark)
    ingest(
        d.spark, f"{root}/landing", store,
        lambda: configs.compile_configs(vendor_configs(d)), lambda: d.table("purchase_order"), f"{root}/checkpoint", max_files=2,
    ).awaitTermination()
    return _invoice_view(store.invoices.read(d.spark), store.items.read(d.spark))


@query(
    "xml_extract_job",
    oracle(
        """SELECT rec_id, any_value('INV' || docs.o) AS invoice_number, count(*) AS n_items, any_value(CAST(docs.o % 40 AS DOUBLE) + 0.25) AS ship_cost,
        round(CAST(sum(unit_cents * shipped) AS DOUBLE) / 100 + any_value(CAST(docs.o % 40 AS DOUBLE) + 0.25), 2) AS total
        FROM docs JOIN positioned p ON p.o = docs.o WHERE docs.o % 3 <> 1 AND docs.o % 9 <> 4 AND docs.o % 19 <> 4 AND docs.o % 23 <> 7 AND status_code BETWEEN 200 AND 209
        GROUP BY rec_id""",
        "docs",
    ),
)
def _(d: Domain) -> DataFrame:
    parsed = responses.valid_responses(responses.read_xml_responses(d.xml_responses()))
    plain = parsed.withColumn("vendor_id", F.col("vendor_id") * 0)
    compiled = configs.compile_configs(vendor_configs(d, XML_MAPPING))
    finished = extract(plain, compiled, lone_lists=True)
    return finished.select(
        "rec_id", "invoice_number", F.size("items").cast("bigint").alias("n_items"), "ship_cost", F.round("total", 2).alias("total")
    )
