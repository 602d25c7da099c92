"""Sources, sinks, filters and predicates."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderloom.functions.status import invert_status_map, map_literal
from orderloom.operators import aggregates, lookups, records, validate
from orderloom.operators.flatten import flatten_json
from orderloom.operators.mapping import map_record, with_config
from orderloom.schemas import PURCHASE_ORDER
from orderloom.session import materialize, shared_folder
from orderloom.sources import configs, feed, requests, responses, staging

from .configs import SECOND_CALL, STATUSES, mapping_values, vendor_configs
from .domain import Domain, oracle
from .registry import query

OPEN_SQL = "('pendingReceipt','partiallyReceived','pendingBilling','pendingBillPartReceived')"
ORDER_PARTS = "json_extract_string(json_body, '$.order.{}')"
REJECT_SQL = """CASE WHEN length(body) = 0 THEN 'empty body' WHEN status_code NOT BETWEEN 200 AND 209 THEN 'http status'
  WHEN NOT json_valid(body) THEN 'malformed body' END"""
STATUS_SQL = """CASE {0} WHEN 'shipped' THEN 'COMPLETED' WHEN 'closed' THEN 'COMPLETED' WHEN 'in process' THEN 'PROCESSING'
  WHEN 'part shipped' THEN 'PARTIAL' WHEN 'void' THEN 'CANCELLED' WHEN 'new' THEN 'OPEN' ELSE {0} END"""


# --- responses ---------------------------------------------------------------


@query(
    "read_json_responses",
    oracle(
        f"""SELECT rec_id, so_number, {REJECT_SQL} AS reject_reason,
        CASE WHEN json_valid(body) THEN json_extract_string(body, '$.order.number') END AS order_number FROM responses""",
        "responses",
    ),
)
def _(d: Domain) -> DataFrame:
    tagged = responses.read_json_responses(d.responses())
    number = F.try_variant_get("doc", "$.order.number", "string")
    return tagged.select("rec_id", "so_number", "reject_reason", number.alias("order_number"))


@query(
    "read_xml_responses",
    oracle(
        """SELECT rec_id, 'Resp.Order.@num' AS path, so_number AS value FROM ok
        UNION ALL SELECT rec_id, 'Resp.Order.Status', CASE o % 3 WHEN 0 THEN 'shipped' WHEN 1 THEN 'void' ELSE 'part shipped' END FROM ok
        UNION ALL SELECT rec_id, 'Resp.Order.Invoice', CASE WHEN o % 9 = 4 THEN NULL ELSE 'INV' || o END FROM ok
        UNION ALL SELECT rec_id, 'Resp.Order.Cost', (o % 40) || '.25' FROM ok
        UNION ALL SELECT rec_id, 'Resp.Order.Note', NULL FROM ok WHERE o % 5 = 0
        UNION ALL SELECT rec_id, 'Resp.Order.Line' || CASE WHEN n = 1 THEN '' ELSE '.' || pos END || '.' || tag, CASE tag WHEN 'Sku' THEN '0' || part
          WHEN 'Qty' THEN CAST(shipped AS VARCHAR) WHEN 'Ord' THEN CAST(ordered AS VARCHAR) ELSE price END
        FROM ok JOIN positioned p ON p.o = ok.o, (VALUES ('Sku'), ('Qty'), ('Ord'), ('Price')) t(tag)""",
        "docs",
        ok="SELECT * FROM docs WHERE o % 19 <> 4 AND o % 23 <> 7 AND status_code BETWEEN 200 AND 209",
    ),
)
def _(d: Domain) -> DataFrame:
    parsed = responses.valid_responses(responses.read_xml_responses(d.xml_responses()))
    return flatten_json(parsed, lone_lists=True).select("rec_id", "path", "value")


FEED_ENTRY = """
SELECT o_orderkey AS o, CAST(floor(o_orderkey / 100) AS BIGINT) AS page, copy, o_custkey,
  CASE WHEN o_orderkey % 13 = 0 THEN 'bogus' WHEN o_orderstatus = 'F' THEN 'fullyBilled'
       WHEN o_orderstatus = 'O' THEN 'pendingReceipt' ELSE 'partiallyReceived' END AS status,
  '{"internalid":"' || CAST(o_orderkey AS VARCHAR(20)) || '","createdfrom":' ||
  CASE WHEN o_orderkey % 5 = 0 THEN 'null' ELSE '"' || CAST(o_custkey AS VARCHAR(20)) || '"' END ||
  ',"status":"' || CASE WHEN o_orderkey % 13 = 0 THEN 'bogus' WHEN o_orderstatus = 'F' THEN 'fullyBilled'
       WHEN o_orderstatus = 'O' THEN 'pendingReceipt' ELSE 'partiallyReceived' END ||
  '","soint":"' || CAST(o_custkey AS VARCHAR(20)) || '","sostatus":"s' || CAST(o_orderkey AS VARCHAR(20)) || '-' || CAST(copy AS VARCHAR(2)) ||
  '","day":"' || CAST(CAST(o_orderdate AS DATE) AS VARCHAR(10)) || '","vendor":"' || CAST(o_orderkey % 7 AS VARCHAR(20)) ||
  '","copy":"' || CAST(copy AS VARCHAR(2)) || '"}' AS entry
FROM feed_rows"""
# Every tenth order is in the feed twice.
FEED_ORACLE = {
    "feed_rows": "SELECT orders.*, copy FROM orders, (VALUES (0), (1)) c(copy) WHERE copy = 0 OR o_orderkey % 10 = 3",
    "fe": FEED_ENTRY,
}
FEED_MAPPING = {
    "point_id": "internalid",
    "soint_id": "soint",
    "sales_order_status": "sostatus",
    "purchase_order_status": "status",
    "tran_date": "day",
    "vendor_id": "vendor",
}
KNOWN = ("pendingReceipt", "partiallyReceived", "fullyBilled")


def feed_documents(d: Domain, orders: int = 100) -> DataFrame:
    """The feed in documents of at most so many orders (twice as many entries)."""
    copies = F.explode(F.when(F.col("o_orderkey") % 10 == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0))))
    rows = d.base("orders").select("*", copies.alias("copy"))
    rows.createOrReplaceTempView("feed_rows")
    entries = d.spark.sql(FEED_ENTRY)
    listed = F.transform(F.sort_array(F.collect_list(F.struct("o", "copy", "entry"))), lambda e: e["entry"])
    return entries.withColumn("page", F.expr(f"o div {orders}")).groupBy("page").agg(
        F.concat(F.lit('{"data":['), F.array_join(listed, ","), F.lit("]}")).alias("body")
    )


@query(
    "read_feed",
    oracle(
        """SELECT page, CAST(row_number() OVER (PARTITION BY page ORDER BY o, copy) - 1 AS INTEGER) AS pos, CAST(o AS VARCHAR) AS internalid,
        CASE WHEN o % 5 = 0 THEN NULL ELSE CAST(o_custkey AS VARCHAR) END AS createdfrom, status FROM fe""",
        **FEED_ORACLE,
    ),
)
def _(d: Domain) -> DataFrame:
    rows = feed.read_feed(feed_documents(d))
    return rows.select("page", "pos", *[feed.order_field(f).alias(f) for f in ("internalid", "createdfrom", "status")])


# Documents of 10,000 orders; every third has three more elements that are no orders, every seventh lacks its end.
SPOILED = {
    "paged": "SELECT *, o // 10000 AS part, row_number() OVER (PARTITION BY o // 10000 ORDER BY o, copy) - 1 AS pos FROM fe",
    "parts": "SELECT part, count(*) AS n FROM paged GROUP BY part",
    "spoiled": """SELECT part, n + k AS pos, reason FROM parts, (VALUES (0, 'the element is not an object'), (1, 'the element is not an object'), (2, 'malformed element')) v(k, reason)
      WHERE part % 3 = 0 AND part % 7 <> 2
      UNION ALL SELECT part, NULL, 'the feed is not a JSON object with a data list' FROM parts WHERE part % 7 = 2""",
}


def spoiled_feed(d: Domain) -> DataFrame:
    docs = feed_documents(d, 10_000).withColumnRenamed("page", "part")
    more = F.when(F.col("part") % 3 == 0, F.lit(',5,["a}",{"b":[1]}],{"b":tru}')).otherwise(F.lit(""))
    end = F.when(F.col("part") % 7 == 2, F.lit("")).otherwise(F.lit(']}'))
    return docs.withColumn("body", F.concat(F.expr("left(body, length(body) - 2)"), more, end))


@query(
    "feed_rejects",
    oracle("SELECT part, CAST(pos AS INTEGER) AS pos, reason AS reject_reason FROM spoiled", **FEED_ORACLE, **SPOILED),
)
def _(d: Domain) -> DataFrame:
    return feed.tag_feed(spoiled_feed(d)).filter("reject_reason is not null").select("part", "pos", "reject_reason")


@query(
    "feed_files",
    oracle(
        """SELECT part, pos, CAST(o AS VARCHAR) AS internalid, status, CAST(NULL AS VARCHAR) AS reject_reason FROM paged WHERE part % 7 <> 2
        UNION ALL SELECT part, pos, NULL, NULL, reason FROM spoiled""",
        **FEED_ORACLE,
        **SPOILED,
    ),
)
def _(d: Domain) -> DataFrame:
    path = f"{shared_folder(d.spark)}/feed-{uuid.uuid4().hex}"
    spoiled_feed(d).write.partitionBy("part").text(path)
    tagged = feed.tag_feed_files(d.spark, path)
    part = F.regexp_extract("file", "part=([0-9]+)", 1).cast("bigint").alias("part")
    return tagged.select(part, "pos", *[feed.order_field(f).alias(f) for f in ("internalid", "status")], "reject_reason")


@query(
    "build_requests",
    oracle(
        f"""SELECT o.vendor_id, vendor_po_number AS po_number, CASE WHEN o.vendor_id % 3 = 1 THEN 'POST' ELSE 'GET' END AS method,
        'https://vendor.example/orders/' || vendor_so_number || '?po=' || vendor_po_number || '&by=' || upper(vendor_name) AS url,
        CASE WHEN o.vendor_id % 3 = 1 THEN '<q>' || vendor_po_number || '</q>' END AS payload
        FROM purchase_order o LEFT JOIN vendor_invoice f ON o.id = f.purchase_order_id WHERE purchase_order_status IN {OPEN_SQL}""",
        "purchase_order",
        "vendor_invoice",
    ),
)
def _(d: Domain) -> DataFrame:
    orders = d.table("purchase_order")
    pending = lookups.pending_purchase_orders(orders, d.table("vendor_invoice").select("purchase_order_id"))
    named = pending.withColumn("vendor_name", F.concat(F.lit("Vendor "), F.col("vendor_id").cast("string")))
    built = requests.build_requests(
        named, requests.request_templates(vendor_configs(d)), ["so_number", "po_number", "vendor_name"]
    )
    return built.select("vendor_id", "po_number", "method", "url", "payload")


_INVOICES_SQL = f"""SELECT *, {ORDER_PARTS.format('invoice')} AS listed FROM docs"""


_SINGLE_INVOICES = """SELECT *, trim(unnest(string_split(coalesce(nullif(listed, ''), 'T' || o), ','))) AS invoice_number,
          CAST(unnest(range(len(string_split(coalesce(nullif(listed, ''), 'T' || o), ',')))) AS INTEGER) AS k FROM listed"""


@query(
    "second_call_requests",
    oracle(
        """SELECT rec_id, k, invoice_number, 'GET' AS method, 'https://vendor.example/invoices/' || invoice_number AS url FROM split""",
        "docs",
        listed=_INVOICES_SQL,
        split=_SINGLE_INVOICES,
    ),
)
def _(d: Domain) -> DataFrame:
    made = vendor_configs(d, extra=[SECOND_CALL] * 3)
    settled = map_record(with_config(d.json_documents(), configs.compile_configs(made))).transform(records.settle_record)
    calls = requests.second_call_requests(settled, requests.second_call_templates(made), ["invoice_number", "so_number"])
    return calls.select("rec_id", F.col("invoice_pos").alias("k"), "invoice_number", "method", "url")


@query(
    "enrich_second_call",
    oracle(
        f"""SELECT rec_id, k, s.invoice_number, {STATUS_SQL.format("nullif(" + ORDER_PARTS.format("status") + ", '')")} AS invoice_status,
        k || '.50' AS total, CASE WHEN vendor_id % 3 = 0 THEN n ELSE NULL END AS n_items
        FROM split s""",
        "docs",
        listed=_INVOICES_SQL,
        split=_SINGLE_INVOICES,
    ).replace("FROM split s", "FROM split s WHERE k % 3 <> 2"),
)
def _(d: Domain) -> DataFrame:
    compiled = configs.compile_configs(vendor_configs(d))
    documents = with_config(d.json_documents(), compiled)
    mapped = map_record(documents.withColumn("_m", F.col("mapping"))).withColumnRenamed("_m", "mapping")
    settled = materialize(mapped.transform(records.settle_record), "settled")  # read twice below
    landed = settled.select(
        "vendor_id", "rec_id", F.posexplode(F.split("invoice_number", ",")).alias("k", "invoice_number")
    ).filter("k % 3 <> 2")
    body = F.concat(F.lit('{"order":{"status":"void","total":"'), F.col("k").cast("string"), F.lit('.50"}}'))
    second = landed.select(
        "vendor_id", "rec_id", F.trim("invoice_number").alias("invoice_number"), body.alias("body"), F.try_parse_json(body).alias("doc")
    )
    enriched = requests.enrich_second_call(settled, second, key=("vendor_id", "rec_id"))
    return enriched.select(
        "rec_id",
        F.col("invoice_pos").alias("k"),
        "invoice_number",
        "invoice_status",
        "total",
        F.when(F.size("items") > 0, F.size("items").cast("bigint")).alias("n_items"),
    )


# --- configs -------------------------------------------------------------------


@query(
    "vendor_mapping_rows",
    oracle(
        r"""SELECT s_suppkey AS vendor_id, path AS doc_path,
        CASE WHEN path LIKE 'Ref%' THEN 'RefIDQual' ELSE replace(string_split(path, '.')[1], '[i]', '') END AS first_segment,
        string_split(path, '.')[-1] AS last_segment, contains(path, '[i]') AS is_wildcard,
        CASE WHEN contains(target, '.') THEN string_split(target, '.')[1] ELSE '' END AS target_group,
        string_split(target, '.')[-1] AS target_field FROM supplier, m""",
        m=mapping_values(),
    ),
)
def _(d: Domain) -> DataFrame:
    return configs.vendor_mapping_rows(vendor_configs(d)).drop("kind")


@query(
    "vendor_status_rows",
    "SELECT s_suppkey AS vendor_id, raw, canonical FROM supplier, (VALUES ('shipped','COMPLETED'), ('closed','COMPLETED'), "
    "('in process','PROCESSING'), ('part shipped','PARTIAL'), ('void','CANCELLED'), ('shipped','OPEN'), ('new','OPEN')) t(raw, canonical)",
)
def _(d: Domain) -> DataFrame:
    return configs.vendor_status_rows(vendor_configs(d))


@query(
    "vendor_carrier_rows",
    "SELECT s_suppkey AS vendor_id, carrier, service, CAST(service_id AS INTEGER) AS service_id FROM supplier, (VALUES ('ups','ground',3), ('ups','Ground',4), "
    "('ups','2Day',5), ('nonups','2day',7), ('nonups','2Day',8), ('nonups','Overnight',9)) t(carrier, service, service_id) WHERE s_suppkey % 3 < 2",
)
def _(d: Domain) -> DataFrame:
    return configs.vendor_carrier_rows(vendor_configs(d))


# --- staging -------------------------------------------------------------------


def _staged(d: Domain, fmt: str) -> DataFrame:
    path = f"{shared_folder(d.spark)}/staged-{uuid.uuid4().hex}"
    orders = d.table("purchase_order").select("id", "vendor_id", "vendor_so_number")
    staging.stage_write(orders.filter("id % 2 = 0"), path, "r1", fmt)
    staging.stage_write(orders.filter("id % 2 = 1"), path, "r2", fmt)
    schema = "id bigint, vendor_so_number string, run_id string, vendor_id bigint"
    return staging.stage_read(d.spark, path, schema, fmt)


@query("stage_read", oracle("SELECT id, vendor_id, vendor_so_number FROM purchase_order WHERE id % 2 = 1", "purchase_order"))
def _(d: Domain) -> DataFrame:
    return _staged(d, "parquet").filter("run_id = 'r2'").select("id", "vendor_id", "vendor_so_number")


@query(
    "stage_write",
    oracle("SELECT id, vendor_id, vendor_so_number, CASE WHEN id % 2 = 0 THEN 'r1' ELSE 'r2' END AS run_id FROM purchase_order", "purchase_order"),
)
def _(d: Domain) -> DataFrame:
    return _staged(d, "json").select("id", "vendor_id", "vendor_so_number", "run_id")


@query(
    "table_query",
    oracle("SELECT id, vendor_po_number FROM purchase_order WHERE vendor_id = 3 AND purchase_order_status = 'pendingReceipt'", "purchase_order"),
)
def _(d: Domain) -> DataFrame:
    return staging.table_query(
        d.spark,
        "SELECT id, vendor_po_number FROM {orders} WHERE vendor_id = :vendor AND purchase_order_status = :status",
        {"orders": d.table("purchase_order")},
        vendor=3,
        status="pendingReceipt",
    )


# --- filters and predicates ----------------------------------------------------


@query("project_by_mapping", "SELECT o_orderkey AS point_id, o_custkey AS soint_id, o_orderstatus AS status FROM orders")
def _(d: Domain) -> DataFrame:
    return feed.project_by_mapping(
        d.base("orders"), {"point_id": "o_orderkey", "soint_id": "o_custkey", "status": "o_orderstatus"}
    )


@query(
    "filter_known_status",
    oracle(
        """SELECT id, purchase_order_status IN ('pendingReceipt', 'fullyBilled') IS TRUE AS known FROM purchase_order""",
        "purchase_order",
    ),
)
def _(d: Domain) -> DataFrame:
    kept, others = feed.filter_known_status(d.table("purchase_order"), ("pendingReceipt", "fullyBilled"))
    return kept.select("id", F.lit(True).alias("known")).unionByName(others.select("id", F.lit(False).alias("known")))


# Open orders as often as they have invoices, and at least once.
REPEATED_ORDERS = f"""SELECT p.*, unnest(range(greatest(1, (SELECT count(*) FROM vendor_invoice i WHERE i.purchase_order_id = p.id)))) AS copy
  FROM purchase_order p WHERE list_contains([{OPEN_SQL.strip("()")}], purchase_order_status)"""


@query(
    "pending_sales_orders",
    oracle(
        "SELECT vendor_id, vendor_so_number AS so_number, need_serial_number AS need_serial_no FROM repeated",
        "purchase_order",
        "vendor_invoice",
        repeated=REPEATED_ORDERS,
    ),
)
def _(d: Domain) -> DataFrame:
    return lookups.pending_sales_orders(d.table("purchase_order"), d.table("vendor_invoice"))


@query(
    "pending_purchase_orders",
    oracle(
        "SELECT vendor_id, vendor_po_number AS po_number, vendor_so_number AS so_number, need_serial_number AS need_serial_no FROM repeated",
        "purchase_order",
        "vendor_invoice",
        repeated=REPEATED_ORDERS,
    ),
)
def _(d: Domain) -> DataFrame:
    return lookups.pending_purchase_orders(d.table("purchase_order"), d.table("vendor_invoice"))


@query(
    "order_id_by_so",
    oracle(
        """SELECT r.vendor_id, r.so_number, p.id FROM (SELECT DISTINCT vendor_id, vendor_so_number AS so_number FROM purchase_order) r
        JOIN purchase_order p ON p.vendor_id = r.vendor_id AND p.vendor_so_number = r.so_number""",
        "purchase_order",
    ),
)
def _(d: Domain) -> DataFrame:
    orders = d.table("purchase_order")
    wanted = orders.select("vendor_id", F.col("vendor_so_number").alias("so_number")).distinct()
    return lookups.order_id_by_so(wanted, orders)


@query(
    "order_id_by_po",
    oracle("SELECT vendor_id, vendor_po_number AS po_number, id FROM purchase_order", "purchase_order"),
)
def _(d: Domain) -> DataFrame:
    orders = d.table("purchase_order")
    wanted = orders.select("vendor_id", F.col("vendor_po_number").alias("po_number")).distinct()
    return lookups.order_id_by_po(wanted, orders)


@query(
    "existing_invoice_numbers",
    oracle("SELECT purchase_order_id, invoice_number FROM vendor_invoice WHERE invoice_number IS NOT NULL", "vendor_invoice"),
)
def _(d: Domain) -> DataFrame:
    return lookups.existing_invoice_numbers(d.table("vendor_invoice"))


@query(
    "valid_responses",
    oracle(f"SELECT rec_id, vendor_id FROM responses WHERE {REJECT_SQL} IS NULL", "responses"),
)
def _(d: Domain) -> DataFrame:
    return responses.valid_responses(responses.read_json_responses(d.responses())).select("rec_id", "vendor_id")


@query(
    "require_body_path",
    oracle(f"SELECT rec_id FROM docs WHERE {ORDER_PARTS.format('invoice')} IS NOT NULL", "docs"),
)
def _(d: Domain) -> DataFrame:
    return responses.require_body_path(d.json_documents(), "order.invoice").select("rec_id")


@query(
    "attach_order_context",
    oracle(
        f"""SELECT rec_id, {ORDER_PARTS.format('po')} AS po, so_number AS __sales_order_number__,
        need_serial_no AS __need_serial_number__ FROM docs""",
        "docs",
    ),
)
def _(d: Domain) -> DataFrame:
    documents = d.json_documents().select("rec_id", "id", "doc")
    orders = d.table("purchase_order").select(
        "id", F.col("vendor_so_number").alias("so_number"), F.col("need_serial_number").alias("need_serial_no")
    )
    po = F.try_variant_get("doc", "$.order.po", "string").alias("po")
    return responses.attach_order_context(documents, orders, ["id"]).select(
        "rec_id", po, "__sales_order_number__", "__need_serial_number__"
    )


def mapped_records(d: Domain) -> DataFrame:
    compiled = configs.compile_configs(vendor_configs(d))
    return map_record(with_config(d.json_documents(), compiled))


MAPPED_SQL = f"""SELECT rec_id, id, o, n, vendor_id, vendor_id % 3 AS variant, so_number, need_serial_no,
  {ORDER_PARTS.format('po')} AS po_number, nullif({ORDER_PARTS.format('status')}, '') AS invoice_status,
  nullif({ORDER_PARTS.format('invoice')}, '') AS invoice_number, {ORDER_PARTS.format('shipped')} AS ship_date,
  {ORDER_PARTS.format('tran.id')} AS tran_id, {ORDER_PARTS.format('tran.date')} AS tran_date,
  {ORDER_PARTS.format('ship.cost')} AS ship_cost, {ORDER_PARTS.format('total')} AS total,
  {ORDER_PARTS.format('extra')} AS extra_item_price, json_extract_string(json_body, '$.refs[1].RefID') AS memo FROM docs"""
SETTLED_SQL = f"""SELECT * REPLACE (coalesce(invoice_number, tran_id) AS invoice_number, coalesce(ship_date, tran_date) AS ship_date,
  {STATUS_SQL.format('invoice_status')} AS invoice_status) FROM mapped"""


@query(
    "drop_unbillable",
    oracle(
        f"SELECT rec_id, {STATUS_SQL.format('invoice_status')} AS invoice_status, invoice_number FROM mapped "
        "WHERE invoice_number IS NOT NULL AND coalesce(invoice_status, '') <> 'void'",
        "docs",
        mapped=MAPPED_SQL,
    ),
)
def _(d: Domain) -> DataFrame:
    mapped = mapped_records(d).transform(records.map_record_status)
    return records.drop_unbillable(mapped).select("rec_id", "invoice_status", "invoice_number")


@query(
    "default_from_other_field",
    oracle("SELECT rec_id, invoice_number, ship_date FROM settled", "docs", mapped=MAPPED_SQL, settled=SETTLED_SQL),
)
def _(d: Domain) -> DataFrame:
    return records.default_from_other_field(mapped_records(d)).select("rec_id", "invoice_number", "ship_date")


@query(
    "not_fully_billed",
    oracle("SELECT point_id FROM purchase_order WHERE purchase_order_status <> 'fullyBilled'", "purchase_order"),
)
def _(d: Domain) -> DataFrame:
    return lookups.not_fully_billed(d.table("purchase_order")).select("point_id")


@query(
    "conform_to_schema",
    oracle(
        """SELECT sales_order_id, point_id, tran_date, vendor_id, vendor_po_number, purchase_order_status, CAST(NULL AS VARCHAR) AS vendor_so_number,
        vendor_name, need_serial_number FROM purchase_order""",
        "purchase_order",
    ),
)
def _(d: Domain) -> DataFrame:
    source = d.table("purchase_order").drop("vendor_so_number").withColumn("stray", F.lit(1))
    return validate.conform_to_schema(source, PURCHASE_ORDER)


@query(
    "unbilled_invoice_filter",
    oracle("SELECT id, invoice_number FROM vendor_invoice WHERE id % 7 NOT IN (0, 1)", "vendor_invoice"),
)
def _(d: Domain) -> DataFrame:
    return aggregates.unbilled_invoice_filter(d.table("vendor_invoice"), d.table("bill_outcome")).select("id", "invoice_number")


@query(
    "route_by_outcome",
    oracle(
        f"""SELECT rec_id, CASE WHEN {REJECT_SQL} IS NOT NULL THEN 'fetch' END AS stage, {REJECT_SQL} AS reason FROM responses""",
        "responses",
    ),
)
def _(d: Domain) -> DataFrame:
    tagged = responses.read_json_responses(d.responses()).select("rec_id", "reject_reason")
    ok, failed = aggregates.route_by_outcome(tagged, "fetch")
    nothing = F.lit(None).cast("string")
    return ok.select("rec_id", nothing.alias("stage"), nothing.alias("reason")).unionByName(failed)


@query(
    "route_by_connection_type",
    oracle(
        """SELECT p.id, CASE connection_type WHEN 'api' THEN 'json' WHEN 'xml' THEN 'xml' ELSE 'unknown connection type' END AS route
        FROM purchase_order p JOIN vendors v ON p.vendor_id = v.vendor_id""",
        "purchase_order",
        "vendors",
    ),
)
def _(d: Domain) -> DataFrame:
    orders = d.table("purchase_order").join(d.table("vendors"), "vendor_id").select("id", "connection_type")
    api, xml, others = responses.route_by_connection_type(orders)
    return (
        api.select("id", F.lit("json").alias("route"))
        .unionByName(xml.select("id", F.lit("xml").alias("route")))
        .unionByName(others.select("id", F.col("reject_reason").alias("route")))
    )


ERROR_CONFIG = {"error_status": "fault.code", "error_message": "fault.text"}


@query(
    "error_to_status",
    oracle(
        """SELECT rec_id, CASE o % 3 WHEN 0 THEN 'CANCELLED' WHEN 1 THEN 'E42' ELSE 'ERROR' END AS status_from_vendor,
        CASE WHEN o % 2 = 0 THEN 'no such order' ELSE reason END AS vendor_message FROM docs WHERE status_code NOT BETWEEN 200 AND 209""",
        "docs",
    ),
)
def _(d: Domain) -> DataFrame:
    docs = d.documents()
    code = F.when(F.col("o") % 3 == 0, '"void"').when(F.col("o") % 3 == 1, '"E42"').otherwise("null")
    text = F.when(F.col("o") % 2 == 0, "no such order").otherwise("")
    body = F.concat(F.lit('{"fault":{"code":'), code, F.lit(',"text":"'), text, F.lit('"}}'))
    tagged = responses.read_json_responses(docs.withColumn("body", body))
    failed = responses.rejected_responses(tagged)
    mapped = responses.error_to_status(
        failed, map_literal(invert_status_map(STATUSES)), ERROR_CONFIG["error_status"], ERROR_CONFIG["error_message"]
    )
    return mapped.select("rec_id", "status_from_vendor", "vendor_message")
