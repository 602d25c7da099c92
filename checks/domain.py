"""Domain tables derived from the given parquet tables.

``TABLES`` holds portable SQL, used by Spark and by the DuckDB oracle alike.
Vendor documents are text built from order lines; Spark and DuckDB gather the
lines each in their own way (``json_documents`` / ``ORACLE_DOCS``).
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orderloom.session import shared_folder

# Schemas of the given tables that the domain reads, so that no read infers one.
BASE = {
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, l_extendedprice double, "
    "l_discount double, l_tax double, l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz",
}

_SO = """'SO' || CAST(CASE WHEN o_orderkey % 13 = 5 AND o_orderkey >= n_sup THEN o_orderkey - n_sup ELSE o_orderkey END AS VARCHAR(20))
      || CASE WHEN o_orderkey % 7 = 0 THEN '-S' ELSE '' END"""

TABLES = {
    "sized": "SELECT count(*) AS n_sup FROM supplier",
    "vendors": """
SELECT s_suppkey AS vendor_id,
  CASE WHEN s_suppkey % 7 = 3 THEN 'edi' WHEN s_suppkey % 2 = 0 THEN 'api' ELSE 'xml' END AS connection_type
FROM supplier""",
    "vendor_configs": """
SELECT s_suppkey AS vendor_id, 'nation' AS key_name, n_name AS value, 1 AS ord FROM supplier JOIN nation ON s_nationkey = n_nationkey
UNION ALL SELECT s_suppkey, 'account', s_name, 2 FROM supplier
UNION ALL SELECT s_suppkey, 'region', CAST(n_regionkey AS VARCHAR(10)), 3 FROM supplier JOIN nation ON s_nationkey = n_nationkey
UNION ALL SELECT s_suppkey, 'account', s_name || '#2', 4 FROM supplier WHERE s_suppkey % 5 = 0""",
    "purchase_order": f"""
SELECT o_orderkey AS id, o_custkey + 1000 AS sales_order_id, o_orderkey + 500000000 AS point_id,
  CAST(o_orderdate AS DATE) AS tran_date, o_orderkey % (SELECT n_sup FROM sized) AS vendor_id,
  'PO' || CAST(o_orderkey AS VARCHAR(20)) AS vendor_po_number,
  CASE WHEN o_orderkey % 11 = 0 THEN NULL WHEN o_orderstatus = 'F' THEN 'fullyBilled'
       WHEN o_orderstatus = 'O' THEN 'pendingReceipt' ELSE 'partiallyReceived' END AS purchase_order_status,
  {_SO.replace("n_sup", "(SELECT n_sup FROM sized)")} AS vendor_so_number,
  'Vendor ' || CAST(o_orderkey % (SELECT n_sup FROM sized) AS VARCHAR(20)) AS vendor_name,
  CASE o_orderkey % 3 WHEN 0 THEN TRUE WHEN 1 THEN FALSE ELSE NULL END AS need_serial_number
FROM orders""",
    "sales_order": """
SELECT o_custkey + 1000 AS id, o_custkey AS soint_id, (o_custkey % 2 = 0) AS invoiced, 'open' AS sales_order_status
FROM (SELECT DISTINCT o_custkey FROM orders) c""",
    "line": """
SELECT l_orderkey AS o, l_linenumber AS ln, l_partkey AS part, l_suppkey AS supp, l_shipdate, l_returnflag,
  CAST(l_quantity AS BIGINT) AS ordered, CAST(round(l_extendedprice * 100) AS BIGINT) AS cents,
  CAST(floor(CAST(CAST(round(l_extendedprice * 100) AS BIGINT) AS DOUBLE) / l_quantity) AS BIGINT) AS unit_cents,
  CAST(CAST(l_shipdate AS DATE) AS VARCHAR(10)) AS ship_day
FROM lineitem""",
    "vendor_invoice": """
SELECT o * 3 + CASE l_returnflag WHEN 'A' THEN 0 WHEN 'N' THEN 1 ELSE 2 END AS id, o AS purchase_order_id,
  CAST(NULL AS VARCHAR(10)) AS memo, 'TRK' || CAST(o AS VARCHAR(20)) AS tracking_numbers,
  CASE WHEN o % 8 = 3 THEN NULL ELSE CAST(min(l_shipdate) AS DATE) END AS ship_date,
  CAST(NULL AS VARCHAR(10)) AS deliveries,
  CASE o % 4 WHEN 0 THEN 'OPEN' WHEN 1 THEN 'PARTIAL' ELSE 'COMPLETED' END AS invoice_status,
  CAST(NULL AS VARCHAR(10)) AS invoice_status_raw,
  'T' || CAST(o AS VARCHAR(20)) || l_returnflag AS tran_id,
  CASE WHEN o % 4 = 1 THEN NULL ELSE CAST(max(l_shipdate) AS DATE) END AS tran_date,
  CASE WHEN o % 5 = 0 THEN NULL ELSE CAST(count(*) AS DOUBLE) * 1.5e0 END AS ship_cost,
  CAST(sum(cents) AS DOUBLE) / 100 AS total, CAST(NULL AS VARCHAR(10)) AS raw_total,
  CASE WHEN o % 6 = 0 THEN NULL ELSE 2.0e0 END AS extra_item_price,
  CASE WHEN o % 9 = 4 AND l_returnflag = 'R' THEN NULL ELSE 'INV' || CAST(o AS VARCHAR(20)) || l_returnflag END AS invoice_number,
  CAST(NULL AS DOUBLE) AS tax_amount
FROM line GROUP BY o, l_returnflag""",
    "vendor_invoice_items": """
SELECT o * 3 + CASE l_returnflag WHEN 'A' THEN 0 WHEN 'N' THEN 1 ELSE 2 END AS vendor_invoice_id,
  CASE part % 10 WHEN 0 THEN '' WHEN 1 THEN NULL ELSE 'P' || CAST(part AS VARCHAR(20)) END AS itemno,
  CASE WHEN supp % 4 = 0 THEN NULL ELSE 'M' || CAST(supp AS VARCHAR(20)) END AS mfg_itemno,
  cents AS amount, unit_cents AS rate,
  CASE WHEN ln = 7 THEN 0 ELSE ordered END AS quantity, ordered AS quantity_ordered
FROM line""",
    "bill_outcome": """
SELECT id, id AS vendor_invoice_id, CASE WHEN id % 7 = 0 THEN 'B' || CAST(id AS VARCHAR(20)) END AS vendor_bill_id,
  CASE WHEN id % 7 = 0 THEN TRUE WHEN id % 7 = 1 THEN FALSE END AS success,
  CASE WHEN id % 7 = 1 THEN 'rejected' END AS message
FROM vendor_invoice WHERE id % 7 < 3""",
    # one row per line with the JSON and XML pieces of a vendor document
    "line_text": """
SELECT t.*,
  '{"part":"P' || CAST(part AS VARCHAR(20)) || '"' ||
  CASE WHEN supp % 4 = 0 THEN '' ELSE ',"mfg":"M' || CAST(supp AS VARCHAR(20)) || '"' END ||
  CASE part % 6 WHEN 4 THEN '' ELSE ',"qty":' || qty_token END ||
  CASE WHEN part % 9 = 0 THEN '' ELSE ',"ordered":"' || CAST(ordered AS VARCHAR(20)) || '"' END ||
  CASE supp % 5 WHEN 0 THEN '' ELSE ',"back":' || back_token END ||
  ',"price":"' || price || '"}' AS json_line,
  '{"carrier":"' || carrier || '","service":"' || service || '","qty":"' || CAST(ordered AS VARCHAR(20)) || '","weight":' || weight_token || '}' AS json_box,
  '<Line><Sku>0' || CAST(part AS VARCHAR(20)) || '</Sku><Qty>' || CAST(shipped AS VARCHAR(20)) || '</Qty><Ord>' ||
  CAST(ordered AS VARCHAR(20)) || '</Ord><Price>' || price || '</Price></Line>' AS xml_line
FROM (SELECT r.*,
  CASE part % 6 WHEN 0 THEN ordered WHEN 1 THEN 0 WHEN 2 THEN 0 WHEN 3 THEN ordered - 1 WHEN 4 THEN NULL ELSE ordered + 2 END AS qty,
  CASE part % 6 WHEN 0 THEN ordered WHEN 1 THEN 0 WHEN 3 THEN ordered - 1 ELSE ordered + 2 END AS shipped,
  CASE part % 6 WHEN 0 THEN '"' || CAST(ordered AS VARCHAR(20)) || '"' WHEN 1 THEN '"0"' WHEN 2 THEN '0'
    WHEN 3 THEN '"' || CAST(ordered - 1 AS VARCHAR(20)) || '"' WHEN 4 THEN NULL ELSE '"' || CAST(ordered + 2 AS VARCHAR(20)) || '"' END AS qty_token,
  CASE supp % 5 WHEN 0 THEN NULL WHEN 1 THEN '0' WHEN 2 THEN '"' || CAST(ordered AS VARCHAR(20)) || '"' WHEN 3 THEN '"1"' ELSE '""' END AS back_token,
  '$' || CASE WHEN unit_cents >= 100000 THEN CAST(CAST(floor(CAST(unit_cents AS DOUBLE) / 100000) AS BIGINT) AS VARCHAR(20)) || ',' ||
      lpad(CAST(CAST(floor(CAST(unit_cents % 100000 AS DOUBLE) / 100) AS BIGINT) AS VARCHAR(20)), 3, '0')
    ELSE CAST(CAST(floor(CAST(unit_cents AS DOUBLE) / 100) AS BIGINT) AS VARCHAR(20)) END
    || '.' || lpad(CAST(unit_cents % 100 AS VARCHAR(20)), 2, '0') AS price,
  CASE supp % 4 WHEN 0 THEN 'UPS Ground' WHEN 1 THEN 'USPS' WHEN 2 THEN 'FedEx' ELSE '' END AS carrier,
  CASE part % 3 WHEN 0 THEN 'Ground' WHEN 1 THEN '2Day' ELSE 'Overnight' END AS service,
  CASE part % 4 WHEN 0 THEN '""' WHEN 1 THEN '0' WHEN 2 THEN '"0"' ELSE '"1.5"' END AS weight_token
  FROM line r) t""",
}

# Head of a document from its gathered lines: columns o, n (lines), lines, boxes,
# invoices, days, first_day, last_day, xml_lines and the order's columns. Portable SQL.
DOC_HEAD = """
SELECT rec_id, id, vendor_id, vendor_so_number AS so_number, vendor_po_number AS po_number, need_serial_number AS need_serial_no,
  CASE WHEN o % 17 = 3 THEN 404 WHEN o % 17 = 5 THEN 209 WHEN o % 17 = 6 THEN 210 ELSE 200 END AS status_code,
  CASE WHEN o % 17 = 3 THEN 'Not Found' ELSE 'OK' END AS reason,
  o, n,
  '{"order":{"number":"' || vendor_so_number || '","po":"' || vendor_po_number || '"' ||
  CASE o % 10 WHEN 9 THEN '' ELSE ',"status":"' || CASE o % 10 WHEN 0 THEN 'void' WHEN 5 THEN 'in process' WHEN 6 THEN 'part shipped'
    WHEN 7 THEN 'mystery' WHEN 8 THEN '' ELSE 'shipped' END || '"' END ||
  CASE o % 8 WHEN 0 THEN ',"invoice":"' || invoices || '"' WHEN 1 THEN ',"invoice":"' || invoices || ', INV' || CAST(o AS VARCHAR(20)) || '-X"'
    WHEN 2 THEN ',"invoice":""' WHEN 3 THEN '' WHEN 4 THEN ',"invoice":null' ELSE ',"invoice":"INV' || CAST(o AS VARCHAR(20)) || '"' END ||
  CASE WHEN o % 8 = 0 THEN ',"shipped":"' || days || '"' WHEN o % 6 = 3 THEN '' ELSE ',"shipped":"' || first_day || ',' || last_day || '"' END ||
  CASE o % 4 WHEN 0 THEN ',"ship":{"cost":"5.00, 7.50"}' WHEN 1 THEN ',"ship":{"cost":"$9.50, 10.00"}' WHEN 2 THEN '' ELSE ',"ship":{"cost":""}' END ||
  CASE WHEN o % 5 = 0 THEN ',"total":"$1,234.50"' ELSE '' END ||
  CASE WHEN o % 3 = 0 THEN ',"extra":"2.25"' ELSE '' END ||
  ',"tran":{"id":"T' || CAST(o AS VARCHAR(20)) || '","date":"' || last_day || '"},"serial":"SN' || CAST(o AS VARCHAR(20)) || '"' ||
  ',"lines":[' || lines || ']},"refs":[{"RefIDQual":"ON","RefID":"R' || CAST(o AS VARCHAR(20)) || '"},{"RefIDQual":"IN","RefID":"I' ||
  CAST(o AS VARCHAR(20)) || '"}],"boxes":[' || boxes || '],"empty":{},"none":[]}' AS json_body,
  '<Resp><Order num="' || vendor_so_number || '"><Status>' || CASE o % 3 WHEN 0 THEN 'shipped' WHEN 1 THEN 'void' ELSE 'part shipped' END ||
  '</Status><Invoice>' || CASE WHEN o % 9 = 4 THEN '' ELSE 'INV' || CAST(o AS VARCHAR(20)) END || '</Invoice><Cost>' ||
  CAST(o % 40 AS VARCHAR(20)) || '.25</Cost>' || CASE WHEN o % 5 = 0 THEN '<Note/>' ELSE '' END || xml_lines || '</Order></Resp>' AS xml_body
FROM gathered JOIN purchase_order ON o = id"""

# Lines of a document in order; the sort columns make the order total for the text.
ORACLE_DOCS = {
    "gathered": """
SELECT o, CAST(o AS VARCHAR) AS rec_id, count(*) AS n,
  string_agg(json_line, ',' ORDER BY ln, part, supp, ship_day, json_line) AS lines,
  string_agg(json_box, ',' ORDER BY ln, part, supp, ship_day, json_line) AS boxes,
  string_agg('INV' || o || '-' || pos, ', ' ORDER BY pos) AS invoices,
  string_agg(ship_day, ',' ORDER BY ln, part, supp, ship_day, json_line) AS days,
  min(ship_day) AS first_day, max(ship_day) AS last_day,
  string_agg(xml_line, '' ORDER BY ln, part, supp, ship_day, json_line) AS xml_lines
FROM positioned GROUP BY o""",
    "positioned": """
SELECT *, row_number() OVER (PARTITION BY o ORDER BY ln, part, supp, ship_day, json_line) - 1 AS pos FROM line_text""",
    "docs": DOC_HEAD,
    "responses": """
SELECT rec_id, id, vendor_id, so_number, po_number, need_serial_no, status_code, reason,
  CASE WHEN o % 19 = 4 THEN '' WHEN o % 23 = 7 THEN '{bad' ELSE json_body END AS body FROM docs""",
}

_DEPENDS = {
    "purchase_order": ["sized"],
    "vendor_invoice": ["line"],
    "vendor_invoice_items": ["line"],
    "bill_outcome": ["vendor_invoice"],
    "line_text": ["line"],
    "positioned": ["line_text"],
    "gathered": ["positioned"],
    "docs": ["gathered", "purchase_order"],
    "responses": ["docs"],
}
_ORACLE = {**TABLES, **ORACLE_DOCS}


def oracle(body: str, *tables: str, **extra: str) -> str:
    """``body`` with the CTEs it names (and theirs) in front; ``extra`` adds its own."""
    ordered: list[str] = []

    def need(name: str) -> None:
        for other in _DEPENDS.get(name, []):
            need(other)
        if name not in ordered:
            ordered.append(name)

    for t in tables:
        need(t)
    ctes = [f"{t} AS ({_ORACLE[t]})" for t in ordered] + [f"{k} AS ({v})" for k, v in extra.items()]
    return (f"WITH {', '.join(ctes)} " if ctes else "") + body


def shuffle_tasks(spark: SparkSession) -> int:
    """As many tasks as a shuffle has, for rows that grow after it: their size there says little of the work."""
    parts = spark.conf.get("spark.sql.shuffle.partitions")
    return int(parts) if parts.isdigit() else 200


#: Lines of one task that gathers documents: their texts, some 600 bytes a line, fit its memory and are not spilled.
TASK_LINES = 100_000


class Domain:
    """The domain tables of one data folder as DataFrames."""

    #: Documents written beforehand, by folder of the tables (``write_documents``).
    written: dict[str, str] = {}

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder

    def write_documents(self) -> None:
        """Write the documents once, so that queries on them read instead of building them."""
        path = f"{shared_folder(self.spark)}/documents-{uuid.uuid4().hex}"
        self.documents().write.parquet(path)
        Domain.written[self.folder] = path

    def base(self, name: str) -> DataFrame:
        return self.spark.read.schema(BASE[name]).parquet(f"{self.folder}/{name}.parquet")

    def sql(self, body: str, *tables: str) -> DataFrame:
        text = oracle(body, *tables)
        for name in BASE:
            if name in text:
                self.base(name).createOrReplaceTempView(name)
        return self.spark.sql(text)

    def table(self, name: str) -> DataFrame:
        return self.sql(f"SELECT * FROM {name}", name)

    def lines_by_document(self) -> DataFrame:
        """``line_text`` with ``rec_id``, the order; a document has all lines of its order.

        Lines meet by order as the numbers they are stored as, and texts are made of them afterwards:
        grouped by ``o``, no text crosses the shuffle. There are as many tasks as their counted lines ask for.
        """
        lines = self.base("lineitem")
        tasks = max(shuffle_tasks(self.spark), -(-lines.count() // TASK_LINES))
        lines = lines.repartition(tasks, "l_orderkey")
        lines.createOrReplaceTempView("lineitem_by_order")
        text = oracle("SELECT * FROM line_text", "line_text").replace("FROM lineitem", "FROM lineitem_by_order")
        return self.spark.sql(text).withColumn("rec_id", F.col("o").cast("string"))

    def documents(self) -> DataFrame:
        """One document per order: columns of ``DOC_HEAD``."""
        if self.folder in Domain.written:
            return self.spark.read.parquet(Domain.written[self.folder])
        entry = F.struct("ln", "part", "supp", "ship_day", "json_line", "json_box", "xml_line")
        grouped = (
            self.lines_by_document()
            .groupBy("o")
            .agg(F.sort_array(F.collect_list(entry)).alias("l"), F.min("ship_day").alias("first_day"), F.max("ship_day").alias("last_day"))
        )

        def joined(field: str, sep: str):
            return F.array_join(F.transform("l", lambda x: x[field]), sep)

        number = F.concat(F.lit("INV"), F.col("o").cast("string"), F.lit("-"))
        gathered = grouped.select(
            "o",
            F.col("o").cast("string").alias("rec_id"),
            F.size("l").cast("bigint").alias("n"),
            joined("json_line", ",").alias("lines"),
            joined("json_box", ",").alias("boxes"),
            F.array_join(F.transform("l", lambda x, i: F.concat(number, i.cast("string"))), ", ").alias("invoices"),
            joined("ship_day", ",").alias("days"),
            "first_day",
            "last_day",
            joined("xml_line", "").alias("xml_lines"),
        )
        gathered.createOrReplaceTempView("gathered")
        self.table("purchase_order").createOrReplaceTempView("purchase_order")
        return self.spark.sql(DOC_HEAD)

    def json_documents(self) -> DataFrame:
        """Well-formed JSON documents, parsed."""
        docs = self.documents()
        return docs.select(
            "rec_id", "id", "vendor_id", "so_number", "po_number", "need_serial_no",
            F.col("json_body").alias("body"), F.try_parse_json("json_body").alias("doc"),
        )

    def responses(self) -> DataFrame:
        """Response rows with empty and malformed bodies among them."""
        docs = self.documents()
        body = F.when(F.col("o") % 19 == 4, "").when(F.col("o") % 23 == 7, "{bad").otherwise(F.col("json_body"))
        return docs.select(
            "rec_id", "id", "vendor_id", "so_number", "po_number", "need_serial_no", "status_code", "reason", body.alias("body")
        )

    def xml_responses(self) -> DataFrame:
        docs = self.documents()
        body = F.when(F.col("o") % 19 == 4, "").when(F.col("o") % 23 == 7, "<bad").otherwise(F.col("xml_body"))
        return docs.select(
            "rec_id", "id", "vendor_id", "so_number", "po_number", "need_serial_no", "status_code", "reason", body.alias("body")
        )
