"""Joins, aggregations and deduplication."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderloom.functions.carrier import carrier_service
from orderloom.functions.money import max_money_token
from orderloom.functions.status import invert_status_map, map_literal, map_status, rollup_status_agg
from orderloom.operators import aggregates, dedup, lookups
from orderloom.operators.records import order_total, take_delivered_quantities
from orderloom.plans.extract import outcomes_of
from orderloom.sources import configs, feed, responses

from .configs import STATUSES, vendor_configs
from .domain import Domain, oracle
from .q_nested import MAPPED_LINES, long_items
from .q_sources import (
    FEED_ORACLE,
    MAPPED_SQL,
    OPEN_SQL,
    REJECT_SQL,
    SETTLED_SQL,
    feed_documents,
    mapped_records,
)
from .registry import query


def item_status_sql(o: str, s: str, b: str, own: str, has_o: str, has_s: str, has_b: str) -> str:
    """The status table as SQL, on numbers and set flags."""
    return f"""CASE
  WHEN ({has_o}) AND ({has_s}) AND NOT ({has_b}) THEN CASE WHEN {o} = {s} THEN 'COMPLETED' WHEN {s} = 0 THEN 'PROCESSING' WHEN {s} > 0 AND {s} < {o} THEN 'PARTIAL' ELSE '' END
  WHEN ({has_o}) AND ({has_s}) THEN CASE WHEN {o} = {b} AND {s} <> {o} THEN 'BACKORDERED' WHEN {s} = {o} THEN 'COMPLETED' WHEN {s} > 0 AND {s} < {o} THEN 'PARTIAL' ELSE '' END
  WHEN ({has_o}) AND NOT ({has_b}) THEN 'PROCESSING'
  WHEN ({has_s}) AND NOT ({has_o}) AND NOT ({has_b}) THEN 'COMPLETED'
  WHEN ({has_s}) AND ({has_b}) AND NOT ({has_o}) THEN CASE WHEN {b} = 0 AND {s} > 0 THEN 'COMPLETED' WHEN {b} > 0 AND {s} = 0 THEN 'BACKORDERED' WHEN {b} > 0 AND {s} > 0 THEN 'PARTIAL' ELSE '' END
  ELSE {own} END"""


ROLLUP_SQL = """CASE WHEN count(nullif(st, '')) = 0 THEN '' WHEN count(nullif(st, '')) = count(*) FILTER (WHERE st = 'BACKORDERED') THEN 'BACKORDERED'
  WHEN count(*) FILTER (WHERE st IN ('PARTIAL', 'BACKORDERED')) > 0 THEN 'PARTIAL' WHEN count(*) FILTER (WHERE st = 'PROCESSING') > 0 THEN 'PROCESSING'
  WHEN count(nullif(st, '')) = count(*) FILTER (WHERE st = 'COMPLETED') THEN 'COMPLETED' ELSE '' END"""
LINE_STATUS = item_status_sql(
    "ordered", "qty", "CASE supp % 5 WHEN 1 THEN 0 WHEN 2 THEN ordered WHEN 3 THEN 1 END", "NULL",
    "part % 9 <> 0", "part % 6 NOT IN (2, 4)", "supp % 5 IN (2, 3)",
)


# --- joins ---------------------------------------------------------------------


@query(
    "vendor_schedule",
    oracle(
        """SELECT v.vendor_id, 'configs/' || v.vendor_id || '.json' AS config_file_path, connection_type, key_name, value FROM
        (SELECT vendor_id, key_name, arg_max(value, ord) AS value FROM vendor_configs GROUP BY 1, 2) c JOIN vendors v ON v.vendor_id = c.vendor_id
        WHERE v.vendor_id IN (SELECT vendor_id FROM purchase_order)""",
        "vendors",
        "vendor_configs",
        "purchase_order",
    ),
)
def _(d: Domain) -> DataFrame:
    schedule = lookups.vendor_schedule(d.table("vendor_configs"), d.table("purchase_order"), d.table("vendors"), "configs/")
    return schedule.select(
        "vendor_id", "config_file_path", "connection_type", F.explode("template_values").alias("key_name", "value")
    )


@query(
    "orders_left_invoices",
    oracle("SELECT o.id, o.vendor_id FROM purchase_order o LEFT JOIN vendor_invoice f ON o.id = f.purchase_order_id", "purchase_order", "vendor_invoice"),
)
def _(d: Domain) -> DataFrame:
    return lookups.orders_left_invoices(d.table("purchase_order").select("id", "vendor_id"), d.table("vendor_invoice"))


_RECORDS = """SELECT id AS rid, vendor_id, CASE id % 5 WHEN 1 THEN '' WHEN 2 THEN NULL WHEN 3 THEN 'SO-unknown' WHEN 4 THEN NULL ELSE vendor_so_number END AS so_number,
  CASE WHEN id % 5 IN (1, 2, 3) THEN vendor_po_number END AS po_number FROM purchase_order"""


@query(
    "resolve_order_id",
    oracle(
        """SELECT rid, CASE WHEN coalesce(so_number, '') <> '' THEN (SELECT min(id) FROM purchase_order p WHERE p.vendor_id = r.vendor_id AND vendor_so_number = so_number)
          WHEN coalesce(po_number, '') <> '' THEN (SELECT min(id) FROM purchase_order p WHERE p.vendor_id = r.vendor_id AND vendor_po_number = po_number) END AS purchase_order_id,
        CASE rid % 5 WHEN 3 THEN 'no matching order' WHEN 4 THEN 'no order number' END AS reject_reason FROM recs r""",
        "purchase_order",
        recs=_RECORDS,
    ),
)
def _(d: Domain) -> DataFrame:
    records = d.sql(_RECORDS, "purchase_order")
    return lookups.resolve_order_id(records, d.table("purchase_order")).select("rid", "purchase_order_id", "reject_reason")


_INCOMING = """SELECT purchase_order_id, CASE id % 4 WHEN 1 THEN NULL WHEN 2 THEN 'NEW' || CAST(id AS VARCHAR(20)) ELSE 'INV' || CAST(purchase_order_id AS VARCHAR(20)) || 'A' END AS invoice_number,
  id AS rid FROM vendor_invoice"""


@query(
    "drop_loaded_invoices",
    oracle(
        """SELECT * FROM inc WHERE invoice_number IS NULL OR (purchase_order_id, invoice_number) NOT IN
        (SELECT (purchase_order_id, invoice_number) FROM vendor_invoice WHERE invoice_number IS NOT NULL)""",
        "vendor_invoice",
        inc=_INCOMING,
    ),
)
def _(d: Domain) -> DataFrame:
    return lookups.drop_loaded_invoices(d.sql(_INCOMING, "vendor_invoice"), d.table("vendor_invoice"))


@query("drop_loaded_invoices_strict", oracle("SELECT * FROM inc WHERE invoice_number IS NULL", "vendor_invoice", inc=_INCOMING))
def _(d: Domain) -> DataFrame:
    return lookups.drop_loaded_invoices(d.sql(_INCOMING, "vendor_invoice"), d.table("vendor_invoice"), mode="strict")


@query(
    "attach_sales_order_id",
    "SELECT o_orderkey AS point_id, o_custkey + 1000 AS sales_order_id FROM orders",
)
def _(d: Domain) -> DataFrame:
    orders = d.base("orders").select(F.col("o_orderkey").alias("point_id"), F.col("o_custkey").alias("soint_id"))
    return lookups.attach_sales_order_id(orders, d.table("sales_order").select("soint_id", "id"))


def invoice_records(d: Domain) -> DataFrame:
    """Invoices with the array of their items, keyed by order and number."""
    items = d.table("vendor_invoice_items").withColumnRenamed("vendor_invoice_id", "id")
    grouped = items.groupBy("id").agg(F.collect_list(F.struct("itemno", "quantity", "rate")).alias("items"))
    return d.table("vendor_invoice").select("id", "purchase_order_id", "invoice_number").join(grouped, "id").drop("id")


@query(
    "attach_invoice_id",
    oracle("SELECT vendor_invoice_id, itemno, quantity, rate FROM vendor_invoice_items", "vendor_invoice_items"),
)
def _(d: Domain) -> DataFrame:
    ids = d.table("vendor_invoice").select("purchase_order_id", "invoice_number", "id")
    return lookups.attach_invoice_id(invoice_records(d), ids)


ITEM_OBJECT = """'{' || CASE WHEN mfg_itemno IS NOT NULL AND coalesce(itemno, '') = '' THEN '"itemno":"' || mfg_itemno || '"'
    WHEN itemno IS NULL THEN '"itemno":null' ELSE '"itemno":"' || itemno || '"' END || ',"amount":' || amount || ',"rate":' || rate || ',"quantity":' || quantity ||
  CASE WHEN mfg_itemno IS NOT NULL THEN ',"mfg_itemno":"' || mfg_itemno || '"' ELSE '' END || '}'"""
ITEM_ARRAYS = f"""SELECT vendor_invoice_id, '[' || string_agg({ITEM_OBJECT}, ',' ORDER BY {ITEM_OBJECT}) || ']' AS items
  FROM vendor_invoice_items WHERE quantity > 0 GROUP BY vendor_invoice_id"""


@query(
    "vendor_bill_objects",
    oracle(
        f"""SELECT i.id, i.tran_id, i.total, i.tracking_numbers, i.ship_date, if(i.ship_date IS NULL, 'F', 'T') AS shipcomplete, a.items,
        ifnull(i.ship_cost, 0) AS ship_cost, 7001 AS extra_item_intid, 2 AS extra_item_qty, ifnull(i.extra_item_price, 0) AS extra_item_price,
        list_filter([i.tran_date, i.ship_date, p.tran_date], lambda x: x IS NOT NULL)[1] AS tran_date, p.point_id, p.sales_order_id, p.vendor_id, p.vendor_name
        FROM vendor_invoice i, purchase_order p, arrays a
        WHERE a.vendor_invoice_id = i.id AND i.id % 7 > 1 AND p.id = i.purchase_order_id AND list_contains([{OPEN_SQL.strip("()")}], p.purchase_order_status)""",
        "purchase_order",
        "vendor_invoice",
        "vendor_invoice_items",
        arrays=ITEM_ARRAYS,
    ),
)
def _(d: Domain) -> DataFrame:
    return lookups.vendor_bill_objects(
        d.table("purchase_order"), d.table("vendor_invoice"), d.table("vendor_invoice_items"), d.table("bill_outcome"),
        extra_item=(7001, 2),
    )


@query(
    "update_where_in_subquery",
    oracle(
        """SELECT id, CASE WHEN vendor_id = 7 AND vendor_so_number LIKE '%-S' THEN left(vendor_so_number, length(vendor_so_number) - 2)
        ELSE vendor_so_number END AS vendor_so_number FROM purchase_order""",
        "purchase_order",
    ),
)
def _(d: Domain) -> DataFrame:
    from orderloom.functions.text import strip_suffix

    orders = d.table("purchase_order").select("id", "vendor_id", "vendor_so_number")
    chosen = orders.filter((F.col("vendor_id") == 7) & F.col("vendor_so_number").endswith("-S"))
    changed = lookups.update_where_in_subquery(orders, chosen, {"vendor_so_number": strip_suffix(F.col("vendor_so_number"))})
    return changed.select("id", "vendor_so_number")


@query(
    "zip_items_with_deliveries",
    oracle(
        """SELECT rec_id, pos, itemno, CASE WHEN variant = 2 THEN CAST(ordered AS VARCHAR) ELSE quantity END AS quantity FROM lines""",
        "docs",
        lines=MAPPED_LINES,
    ),
)
def _(d: Domain) -> DataFrame:
    return long_items(take_delivered_quantities(mapped_records(d)), "itemno", "quantity")


@query(
    "carrier_service_lookup",
    oracle(
        """SELECT o, part, carrier, service, CASE WHEN carrier = 'UPS Ground' THEN CASE service WHEN 'Ground' THEN 4 WHEN '2Day' THEN 5 ELSE 0 END
        WHEN carrier = 'FedEx' THEN CASE service WHEN '2Day' THEN 8 WHEN 'Overnight' THEN 9 ELSE 0 END ELSE 0 END AS service_id FROM line_text""",
        "line_text",
    ),
)
def _(d: Domain) -> DataFrame:
    services = F.create_map(
        F.lit("ups"), map_literal({"Ground": 4, "2Day": 5}, "int"), F.lit("nonups"), map_literal({"2Day": 8, "Overnight": 9}, "int")
    )
    kind = F.when(F.col("carrier") == "UPS Ground", "ups").when(F.col("carrier") == "FedEx", "nonups").otherwise(F.col("carrier"))
    return d.table("line_text").select(
        "o", "part", "carrier", "service", carrier_service(kind, F.col("service"), services).alias("service_id")
    )


@query(
    "status_map_lookup",
    oracle(
        """SELECT o, CASE WHEN o % 3 = 0 THEN 'COMPLETED' WHEN o % 3 = 1 THEN 'CANCELLED' ELSE 'PARTIAL' END AS status, 'unknown' AS other
        FROM docs""",
        "docs",
    ),
)
def _(d: Domain) -> DataFrame:
    raw = F.when(F.col("o") % 3 == 0, "shipped").when(F.col("o") % 3 == 1, "void").otherwise("part shipped")
    by_raw = map_literal(invert_status_map(STATUSES))
    return d.documents().select("o", map_status(raw, by_raw).alias("status"), map_status(F.lit("unknown"), by_raw).alias("other"))


# --- aggregations --------------------------------------------------------------


@query(
    "object_agg",
    oracle("SELECT vendor_id, key_name, arg_max(value, ord) AS value FROM vendor_configs GROUP BY ALL", "vendor_configs"),
)
def _(d: Domain) -> DataFrame:
    grouped = aggregates.object_agg(d.table("vendor_configs"), ["vendor_id"], "key_name", "value", "ord")
    return grouped.select("vendor_id", F.explode("object").alias("key_name", "value"))


@query("items_object_array", oracle("SELECT * FROM arrays", "vendor_invoice_items", arrays=ITEM_ARRAYS))
def _(d: Domain) -> DataFrame:
    return aggregates.items_object_array(d.table("vendor_invoice_items"))


@query("key_to_id_agg", oracle("SELECT soint_id, id FROM sales_order", "sales_order"))
def _(d: Domain) -> DataFrame:
    return aggregates.key_to_id(d.table("sales_order"), "soint_id")


@query("group_distinct", oracle("SELECT DISTINCT vendor_id, purchase_order_status FROM purchase_order", "purchase_order"))
def _(d: Domain) -> DataFrame:
    return aggregates.group_distinct(d.table("purchase_order"), ["vendor_id", "purchase_order_status"])


@query(
    "order_total",
    oracle(
        """SELECT m.rec_id, round(CASE WHEN m.total IS NOT NULL THEN 1234.5 ELSE t.lines + CASE o % 4 WHEN 0 THEN 5 WHEN 1 THEN 9.5 ELSE 0 END END, 2) AS total,
        round(t.lines, 2) AS amount FROM mapped m JOIN (SELECT rec_id, CAST(coalesce(sum(unit_cents * qty), 0) AS DOUBLE) / 100 AS lines FROM lines GROUP BY 1) t
        ON t.rec_id = m.rec_id""",
        "docs",
        mapped=MAPPED_SQL,
        lines=MAPPED_LINES,
    ),
)
def _(d: Domain) -> DataFrame:
    mapped = mapped_records(d)
    costs = mapped.withColumns(
        {
            "ship_cost": F.when(F.col("ship_cost").startswith("5"), 5.0).when(F.col("ship_cost").startswith("$9"), 9.5),
            "total": F.when(F.col("total") != "", 1234.5),
        }
    )
    summed = F.aggregate("items", F.lit(0.0), lambda acc, i: acc + F.coalesce(i["amount"], F.lit(0.0)))
    return order_total(costs).select("rec_id", F.round("total", 2).alias("total"), F.round(summed, 2).alias("amount"))


@query(
    "order_total_long",
    oracle(
        """SELECT vendor_invoice_id, round(CAST(sum(amount) AS DOUBLE) / 100 + coalesce(max(ship_cost), 0), 2) AS total
        FROM vendor_invoice_items JOIN vendor_invoice ON vendor_invoice_id = id GROUP BY 1""",
        "vendor_invoice_items",
        "vendor_invoice",
    ),
)
def _(d: Domain) -> DataFrame:
    costs = d.table("vendor_invoice").select(F.col("id").alias("vendor_invoice_id"), "ship_cost")
    lines = d.table("vendor_invoice_items").join(costs, "vendor_invoice_id").withColumn("amount", F.col("amount") / 100)
    totals = aggregates.order_total_long(lines, ["vendor_invoice_id"], "ship_cost")
    return totals.select("vendor_invoice_id", F.round("total", 2).alias("total"))


@query(
    "rollup_status",
    oracle(f"SELECT o, {ROLLUP_SQL} AS status FROM (SELECT o, {LINE_STATUS} AS st FROM line_text) GROUP BY o", "line_text"),
)
def _(d: Domain) -> DataFrame:
    from orderloom.functions.status import item_status

    o, s = F.col("ordered"), F.col("qty")
    supp, part = F.col("supp") % 5, F.col("part")
    b = F.when(supp == 1, 0).when(supp == 2, o).when(supp == 3, 1)
    st = item_status(o, s, b, F.lit(None).cast("string"), part % 9 != 0, ~(part % 6).isin(2, 4), supp.isin(2, 3))
    return d.table("line_text").select("o", st.alias("st")).groupBy("o").agg(rollup_status_agg(F.col("st")).alias("status"))


@query(
    "max_money_token",
    oracle(
        """SELECT o, part, list_max(regexp_extract_all(text, '\\d+,*\\d*\\.\\d+')) AS token,
        list_max(list_transform(regexp_extract_all(text, '\\d+,*\\d*\\.\\d+'), lambda x: CAST(replace(x, ',', '') AS DOUBLE))) AS number
        FROM (SELECT o, part, price || ' / ' || ordered || '.50, ' || (ordered * 100) AS text FROM line_text)""",
        "line_text",
    ),
)
def _(d: Domain) -> DataFrame:
    from orderloom.functions.money import money_value

    n = F.col("ordered")
    text = F.concat(F.col("price"), F.lit(" / "), n.cast("string"), F.lit(".50, "), (n * 100).cast("string"))
    return d.table("line_text").select(
        "o", "part", max_money_token(text).alias("token"), money_value(text, "number").alias("number")
    )


@query(
    "distinct_invoices",
    oracle("SELECT DISTINCT invoice_number FROM (SELECT invoice_number FROM vendor_invoice UNION ALL SELECT invoice_number FROM inc) WHERE invoice_number IS NOT NULL",
           "vendor_invoice", inc=_INCOMING),
)
def _(d: Domain) -> DataFrame:
    return aggregates.distinct_invoices(d.table("vendor_invoice"), d.sql(_INCOMING, "vendor_invoice"))


@query(
    "run_summary",
    oracle(
        f"""SELECT 'fetch' AS stage, CASE WHEN {REJECT_SQL} IS NULL THEN 'fetched' ELSE 'not fetched' END AS conclusion,
          CASE WHEN {REJECT_SQL} IS NULL THEN 200 ELSE 500 END AS response_code, {REJECT_SQL} AS reason, count(*) AS n FROM responses GROUP BY ALL
        UNION ALL SELECT 'extract', CASE WHEN why IS NULL THEN 'extracted' ELSE 'not extracted' END, CASE WHEN why IS NULL THEN 200 ELSE 500 END, why, count(*)
          FROM (SELECT CASE WHEN invoice_status = 'CANCELLED' THEN 'cancelled' WHEN invoice_number IS NULL THEN 'no invoice number' END AS why
                FROM settled WHERE o % 19 <> 4 AND o % 23 <> 7 AND o % 17 NOT IN (3, 6)) GROUP BY ALL""",
        "responses",
        mapped=MAPPED_SQL,
        settled=SETTLED_SQL,
    ),
)
def _(d: Domain) -> DataFrame:
    tagged = responses.read_json_responses(d.responses())
    extracted = outcomes_of(responses.valid_responses(tagged), configs.compile_configs(vendor_configs(d)))
    return aggregates.run_summary(
        aggregates.stage_outcomes(tagged, "fetch", "rec_id", "fetched"),
        aggregates.stage_outcomes(extracted, "extract", "rec_id", "extracted"),
    )


# --- dedup and set operations ----------------------------------------------------


@query(
    "dedup_first_by_pair",
    oracle("SELECT page, CAST(o AS VARCHAR) AS internalid, CASE WHEN o % 5 = 0 THEN NULL ELSE CAST(o_custkey AS VARCHAR) END AS createdfrom, '0' AS copy FROM fe WHERE copy = 0", **FEED_ORACLE),
)
def _(d: Domain) -> DataFrame:
    rows = feed.read_feed(feed_documents(d))
    flat = rows.select("page", "pos", *[feed.order_field(f).alias(f) for f in ("internalid", "createdfrom", "copy")])
    return dedup.dedup_first_by_pair(flat).drop("pos")


@query(
    "dedup_first_by_key",
    "SELECT o_custkey AS soint_id, min(o_orderkey) AS first_order FROM orders GROUP BY 1",
)
def _(d: Domain) -> DataFrame:
    orders = d.base("orders").select(F.col("o_custkey").alias("soint_id"), F.col("o_orderkey").alias("first_order"), F.col("o_orderkey").alias("pos"))
    return dedup.dedup_first_by_key(orders).drop("pos")


@query(
    "first_match",
    oracle("SELECT vendor_id, vendor_so_number, min(id) AS id FROM purchase_order GROUP BY 1, 2", "purchase_order"),
)
def _(d: Domain) -> DataFrame:
    return dedup.first_match(d.table("purchase_order"), ["vendor_id", "vendor_so_number"])


@query("first_wins_merge", "SELECT o_custkey, arg_min(o_orderpriority, o_orderkey) AS o_orderpriority FROM orders GROUP BY 1")
def _(d: Domain) -> DataFrame:
    return dedup.first_wins_merge(d.base("orders"), "o_custkey", "o_orderpriority", "o_orderkey")


@query(
    "append_batches",
    "SELECT o_orderkey AS id, o_orderstatus AS status, CAST(NULL AS BIGINT) AS cust FROM orders UNION ALL SELECT l_orderkey, NULL, l_partkey FROM lineitem",
)
def _(d: Domain) -> DataFrame:
    return dedup.append_batches(
        d.base("orders").select(F.col("o_orderkey").alias("id"), F.col("o_orderstatus").alias("status")),
        d.base("lineitem").select(F.col("l_orderkey").alias("id"), F.col("l_partkey").alias("cust")),
    )
