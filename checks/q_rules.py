"""Scalar rules."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderloom.functions import dates, money, status, text
from orderloom.functions.common import is_set
from orderloom.operators import records, validate
from orderloom.plans.extract import extract
from orderloom.schemas import PURCHASE_ORDER, VENDOR_INVOICE_ITEMS
from orderloom.sources import configs

from .configs import vendor_configs
from .domain import Domain, oracle
from .q_joins import LINE_STATUS, ROLLUP_SQL, item_status_sql
from .q_nested import MAPPED_LINES, SPLIT_BASE
from .q_sources import MAPPED_SQL, SETTLED_SQL, mapped_records
from .registry import query


@query(
    "clean_number",
    oracle(
        """SELECT o, part, CAST(unit_cents AS DOUBLE) / 100 AS price, CAST(ordered AS DOUBLE) AS n, CAST(NULL AS DOUBLE) AS nothing FROM line_text""",
        "line_text",
    ),
)
def _(d: Domain) -> DataFrame:
    return d.table("line_text").select(
        "o",
        "part",
        money.clean_number(F.col("price")).alias("price"),
        money.clean_number(F.concat(F.col("ordered").cast("string"), F.lit(" pcs"))).alias("n"),
        money.clean_number(F.col("carrier")).alias("nothing"),
    )


COSTS_SQL = """CASE {o} % 4 WHEN 0 THEN 7.5 WHEN 1 THEN 9.5 END"""


@query(
    "money_from_multi",
    oracle(
        """SELECT rec_id, CASE WHEN o % 29 = 3 THEN CASE WHEN single THEN NULL ELSE 5.0 END WHEN o % 29 = 5 THEN CASE WHEN single THEN 9.5 END
          WHEN single THEN CASE o % 4 WHEN 0 THEN 7.5 WHEN 1 THEN 9.5 END END AS ship_cost,
        CASE WHEN single AND total IS NOT NULL THEN 1234.5 END AS total, CASE WHEN single THEN total END AS raw_total,
        CASE WHEN extra_item_price IS NOT NULL THEN 2.25 END AS extra_item_price,
        array_to_string(list_filter([
          CASE WHEN o % 29 = 3 AND single OR o % 29 = 5 AND NOT single OR o % 29 NOT IN (3, 5) AND o % 4 < 2 AND NOT single THEN 'ship_cost: unreadable cost' END,
          CASE WHEN total IS NOT NULL AND NOT single THEN 'total: unreadable cost' END], lambda e: e IS NOT NULL), '; ') AS cost_errors
        FROM (SELECT *, NOT contains(coalesce(invoice_number, ''), ',') AS single FROM mapped)""",
        "docs",
        mapped=MAPPED_SQL,
    ),
)
def _(d: Domain) -> DataFrame:
    order = F.col("rec_id").cast("bigint") % 29
    texts = mapped_records(d).withColumn("ship_cost", F.when(order == 3, "5").when(order == 5, "$9.50").otherwise(F.col("ship_cost")))
    return records.money_from_multi(texts).select(
        "rec_id", "ship_cost", "total", "raw_total", "extra_item_price", F.array_join("cost_errors", "; ").alias("cost_errors")
    )


@query(
    "first_of_list",
    oracle(
        """SELECT rec_id, CASE WHEN contains(coalesce(invoice_number, ''), ',') THEN ship_date ELSE string_split(ship_date, ',')[1] END AS ship_date, tran_date FROM mapped""",
        "docs",
        mapped=MAPPED_SQL,
    ),
)
def _(d: Domain) -> DataFrame:
    return records.single_dates(mapped_records(d)).select("rec_id", "ship_date", "tran_date")


@query("parse_date_format", oracle("SELECT o, part, ship_day, l_shipdate IS NOT NULL AS known FROM line_text", "line_text"))
def _(d: Domain) -> DataFrame:
    written = F.date_format("l_shipdate", " dd.MM.yyyy ")
    parsed = dates.parse_date_format(written, "dd.MM.yyyy")
    return d.table("line_text").select("o", "part", parsed.alias("ship_day"), dates.parse_date_format(written, None).isNotNull().alias("known"))


@query(
    "parse_date_any",
    oracle(
        """SELECT o, part, ln, CASE WHEN ln = 7 THEN NULL ELSE CAST(l_shipdate AS DATE) END AS day FROM line_text""", "line_text"
    ),
)
def _(d: Domain) -> DataFrame:
    shapes = ["yyyy-MM-dd", "MM/dd/yyyy", "yyyyMMdd", "MMM d, yyyy", "yyyy/MM/dd", "yyyy-MM-dd HH:mm:ss"]
    written = F.lit("someday")
    for k, fmt in enumerate(shapes, 1):
        written = F.when(F.col("ln") == k, F.date_format("l_shipdate", fmt)).otherwise(written)
    return d.table("line_text").select("o", "part", "ln", dates.parse_date_any(written).alias("day"))


CARRIER_SQL = """CASE WHEN carrier = '' THEN '' WHEN variant = 0 THEN CASE WHEN lower(left(carrier, 1)) = 'u' THEN 'ups' ELSE 'nonups' END
  WHEN variant = 1 THEN CASE WHEN contains(lower(carrier), 'ups') THEN 'ups' ELSE 'nonups' END ELSE carrier END"""
SERVICE_SQL = """CASE WHEN carrier = '' OR variant = 2 THEN service
  WHEN variant = 0 AND lower(left(carrier, 1)) = 'u' THEN CASE service WHEN 'Ground' THEN '4' WHEN '2Day' THEN '5' ELSE '0' END
  WHEN variant = 0 THEN CASE service WHEN '2Day' THEN '8' WHEN 'Overnight' THEN '9' ELSE '0' END
  WHEN contains(lower(carrier), 'ups') THEN CASE lower(service) WHEN 'ground' THEN '3' ELSE '0' END
  ELSE CASE lower(service) WHEN '2day' THEN '7' ELSE '0' END END"""


@query(
    "normalize_carrier",
    oracle(f"SELECT rec_id, pos, {CARRIER_SQL} AS carrier, {SERVICE_SQL} AS carriermethod FROM lines", "docs", lines=MAPPED_LINES),
)
def _(d: Domain) -> DataFrame:
    rows = records.normalize_carriers(mapped_records(d)).select("rec_id", F.posexplode("deliveries").alias("pos", "x"))
    return rows.select("rec_id", "pos", "x.carrier", "x.carriermethod")


@query(
    "default_weight",
    oracle("SELECT rec_id, pos, CASE part % 4 WHEN 0 THEN '0.1' WHEN 1 THEN '0.1' WHEN 2 THEN '0' ELSE '1.5' END AS weight FROM lines", "docs", lines=MAPPED_LINES),
)
def _(d: Domain) -> DataFrame:
    rows = records.fill_weights(mapped_records(d)).select("rec_id", F.posexplode("deliveries").alias("pos", "x"))
    return rows.select("rec_id", "pos", "x.weight")


@query(
    "item_status",
    oracle(
        f"""SELECT rec_id, pos, {LINE_STATUS} AS status, {item_status_sql('ordered', 'qty', 'ln', "'own'", 'part % 9 <> 0', 'qty <> 0', 'ln <> 7')} AS numeric_status
        FROM (SELECT l.*, p.ln FROM lines l JOIN positioned p ON p.o = l.o AND p.pos = l.pos)""".replace("qty <> 0", "coalesce(qty, 0) <> 0"),
        "docs",
        lines=MAPPED_LINES,
    ),
)
def _(d: Domain) -> DataFrame:
    # Statuses meet, not the items and lines that they are made of.
    rows = mapped_records(d).select("rec_id", F.posexplode("items").alias("pos", "i"))
    rows = rows.select("rec_id", "pos", records.record_item_status(F.col("i")).alias("status"))
    entry = F.struct("ln", "part", "supp", "ship_day", "json_line", "ordered", "qty")
    lines = d.lines_by_document().groupBy("o").agg(F.sort_array(F.collect_list(entry)).alias("l"))
    numbered = lines.select(F.col("o").cast("string").alias("rec_id"), F.posexplode("l").alias("pos", "l"))
    o, s, b = F.col("l.ordered"), F.col("l.qty"), F.col("l.ln")
    numeric = status.item_status(o, s, b, F.lit("own"), F.col("l.part") % 9 != 0, is_set(s, numeric=True), b != 7)
    return rows.join(numbered.select("rec_id", "pos", numeric.alias("numeric_status")), ["rec_id", "pos"])


@query(
    "mirror_cost",
    oracle(
        """SELECT id, CASE WHEN ship_cost IS NULL THEN extra_item_price ELSE ship_cost END AS ship_cost,
        CASE WHEN extra_item_price IS NULL THEN ship_cost ELSE extra_item_price END AS extra_item_price FROM vendor_invoice""",
        "vendor_invoice",
    ),
)
def _(d: Domain) -> DataFrame:
    first, second = money.mirror_cost(F.col("ship_cost"), F.col("extra_item_price"))
    return d.table("vendor_invoice").select("id", first.alias("ship_cost"), second.alias("extra_item_price"))


@query("upper_selected", "SELECT s_suppkey, s_name AS plain, upper(s_name) AS name FROM supplier")
def _(d: Domain) -> DataFrame:
    values = F.create_map(F.lit("plain"), F.col("s_name"), F.lit("name"), F.col("s_name"))
    made = text.upper_selected(values, F.array(F.lit("name")))
    return d.base("supplier").select("s_suppkey", made["plain"].alias("plain"), made["name"].alias("name"))


@query("strip_suffix", oracle("SELECT id, regexp_replace(vendor_so_number, '-S$', '') AS so_number FROM purchase_order", "purchase_order"))
def _(d: Domain) -> DataFrame:
    return d.table("purchase_order").select("id", text.strip_suffix(F.col("vendor_so_number")).alias("so_number"))


@query(
    "item_no_fallback",
    oracle(
        "SELECT vendor_invoice_id, CASE WHEN mfg_itemno IS NULL OR itemno <> '' THEN itemno ELSE mfg_itemno END AS itemno, quantity FROM vendor_invoice_items",
        "vendor_invoice_items",
    ),
)
def _(d: Domain) -> DataFrame:
    made = text.item_no_fallback(F.col("itemno"), F.col("mfg_itemno")).alias("itemno")
    return d.table("vendor_invoice_items").select("vendor_invoice_id", made, "quantity")


@query("ship_complete_flag", oracle("SELECT id, CASE WHEN ship_date IS NULL THEN 'F' ELSE 'T' END AS shipcomplete FROM vendor_invoice", "vendor_invoice"))
def _(d: Domain) -> DataFrame:
    return d.table("vendor_invoice").select("id", text.ship_complete_flag(F.col("ship_date").cast("string")).alias("shipcomplete"))


@query(
    "first_date_of",
    oracle(
        """SELECT vin.id, coalesce(vin.tran_date, vin.ship_date, vo.tran_date) AS tran_date
        FROM vendor_invoice vin JOIN purchase_order vo ON vo.id = vin.purchase_order_id""",
        "vendor_invoice",
        "purchase_order",
    ),
)
def _(d: Domain) -> DataFrame:
    orders = d.table("purchase_order").select(F.col("id").alias("purchase_order_id"), F.col("tran_date").alias("order_date"))
    rows = d.table("vendor_invoice").join(orders, "purchase_order_id")
    return rows.select("id", dates.first_date(F.col("tran_date"), F.col("ship_date"), F.col("order_date")).alias("tran_date"))


@query("money_or_zero", oracle("SELECT id, coalesce(ship_cost, 0) AS ship_cost, coalesce(extra_item_price, 0) AS extra FROM vendor_invoice", "vendor_invoice"))
def _(d: Domain) -> DataFrame:
    return d.table("vendor_invoice").select(
        "id", money.money_or_zero(F.col("ship_cost")).alias("ship_cost"), money.money_or_zero(F.col("extra_item_price").cast("string")).alias("extra")
    )


@query(
    "empty_to_null",
    oracle("SELECT vendor_invoice_id, nullif(itemno, '') AS itemno, mfg_itemno, quantity FROM vendor_invoice_items", "vendor_invoice_items"),
)
def _(d: Domain) -> DataFrame:
    cleaned = validate.null_empty_values(d.table("vendor_invoice_items"), VENDOR_INVOICE_ITEMS)
    return cleaned.select("vendor_invoice_id", "itemno", "mfg_itemno", "quantity")


_RAW_ORDERS = """SELECT CAST(id AS VARCHAR(20)) AS point_id, CASE WHEN id % 10 = 1 THEN NULL ELSE sales_order_id END AS sales_order_id,
  CASE WHEN id % 10 = 2 THEN 'x1' ELSE CAST(vendor_id AS VARCHAR(20)) END AS vendor_id,
  CASE WHEN id % 10 = 3 THEN 'someday' WHEN id % 10 = 4 THEN '' ELSE CAST(tran_date AS VARCHAR(10)) END AS tran_date,
  CASE WHEN id % 10 = 5 THEN 'maybe' WHEN id % 10 = 6 THEN 'yes' ELSE 'false' END AS need_serial_number, vendor_name, 1 AS stray FROM purchase_order"""


@query(
    "coerce_and_validate",
    oracle(
        """SELECT CAST(point_id AS BIGINT) AS point_id, TRY_CAST(vendor_id AS BIGINT) AS vendor_id, TRY_CAST(tran_date AS DATE) AS tran_date,
        CASE need_serial_number WHEN 'yes' THEN TRUE WHEN 'false' THEN FALSE END AS need_serial_number,
        CASE CAST(point_id AS BIGINT) % 10 WHEN 1 THEN 'sales_order_id: required' WHEN 2 THEN 'vendor_id: not a valid bigint'
          WHEN 3 THEN 'tran_date: not a valid date' WHEN 5 THEN 'need_serial_number: not a valid boolean' ELSE '' END AS errors FROM raw""",
        "purchase_order",
        raw=_RAW_ORDERS,
    ),
)
def _(d: Domain) -> DataFrame:
    checked = validate.load(d.sql(_RAW_ORDERS, "purchase_order"), PURCHASE_ORDER)
    return checked.select("point_id", "vendor_id", "tran_date", "need_serial_number", F.array_join("errors", "; ").alias("errors"))


@query(
    "status_from_invoice_field",
    oracle(
        """SELECT rec_id, CASE o % 4 WHEN 0 THEN 'COMPLETED' WHEN 1 THEN 'COMPLETED' WHEN 2 THEN '' ELSE 'OPEN' END AS invoice_status,
        CASE o % 4 WHEN 0 THEN 'shipped' WHEN 1 THEN 'I' || o END AS invoice_status_raw, CASE o % 4 WHEN 0 THEN NULL ELSE 'I' || o END AS invoice_number FROM docs""",
        "docs",
    ),
)
def _(d: Domain) -> DataFrame:
    k = F.col("o") % 4
    number = F.when(k == 0, "shipped").otherwise(F.concat(F.lit("I"), F.col("o").cast("string")))
    by_raw = status.map_literal(status.invert_status_map({"COMPLETED": ["shipped"], "OPEN": ["new"]}))
    cfg = F.struct(by_raw.alias("status_map"), F.lit(True).alias("status_in_invoice_field"))
    rows = d.documents().select(
        "rec_id",
        F.when(k == 3, "new").otherwise("").alias("invoice_status"),
        number.alias("invoice_number"),
        F.when(k == 1, "1Z").alias("trackingnumber"),
        cfg.alias("cfg"),
    )
    return records.map_record_status(rows).select("rec_id", "invoice_status", "invoice_status_raw", "invoice_number")


@query(
    "apply_calculated_status",
    oracle(
        f"""SELECT l.rec_id, nullif({ROLLUP_SQL}, '') AS invoice_status FROM (SELECT rec_id, {LINE_STATUS} AS st FROM lines) l GROUP BY l.rec_id""",
        "docs",
        lines=MAPPED_LINES,
    ),
)
def _(d: Domain) -> DataFrame:
    return records.set_calculated_status(mapped_records(d)).select("rec_id", "invoice_status")


PIECES = """SELECT s.rec_id, s.o, s.variant, s.extra_item_price, s.total AS total_text, s.n, CASE WHEN cut THEN p ELSE 0 END AS piece, cut AND variant = 1 AND len(nums) = k AS by_column,
  CASE WHEN cut THEN nums[least(p + 1, len(nums))] ELSE s.invoice_number END AS invoice_number,
  CASE WHEN cut THEN days[least(p + 1, len(days))] ELSE s.ship_date END AS ship_date, p AS line_pos, cut, k
  FROM (SELECT *, variant < 2 AND len(nums) > 1 AS cut FROM base) s
  JOIN (SELECT CAST(unnest(range((SELECT max(greatest(len(nums), k, 1)) FROM base))) AS INTEGER) AS p) r ON p < CASE WHEN cut THEN greatest(len(nums), k) ELSE 1 END
  WHERE coalesce(invoice_status, '') <> 'CANCELLED' AND coalesce(invoice_number, '') <> ''"""
FINISHED = f"""SELECT p.rec_id, p.piece, any_value(p.invoice_number) AS invoice_number, any_value(p.ship_date) AS ship_dates, any_value(p.o) AS o, any_value(p.variant) AS variant,
  any_value(p.total_text) AS total_text, any_value(p.extra_item_price) AS extra, count(*) AS n_items,
  {ROLLUP_SQL} AS status, CAST(coalesce(sum(unit_cents * q), 0) AS DOUBLE) / 100 AS lines
  FROM pieces p JOIN (SELECT *, {LINE_STATUS} AS st, CASE WHEN variant = 2 THEN ordered ELSE qty END AS q FROM lines) l
  ON l.rec_id = p.rec_id AND (NOT p.cut OR l.pos = least(p.line_pos, p.k - 1)) GROUP BY p.rec_id, p.piece"""


FINISH_ORACLE = """SELECT rec_id, piece, invoice_number, nullif(status, '') AS invoice_status, n_items,
  CASE WHEN multi THEN ship_dates ELSE string_split(ship_dates, ',')[1] END AS ship_date,
  round(cost, 2) AS ship_cost, round(CASE WHEN NOT multi AND total_text IS NOT NULL THEN 1234.5 ELSE lines + coalesce(cost, 0) END, 2) AS total
  FROM (SELECT *, CASE WHEN variant = 2 AND own IS NULL THEN CASE WHEN extra IS NOT NULL THEN 2.25 END ELSE own END AS cost FROM
    (SELECT *, contains(invoice_number, ',') AS multi, CASE WHEN contains(invoice_number, ',') THEN NULL ELSE CASE o % 4 WHEN 0 THEN 7.5 WHEN 1 THEN 9.5 END END AS own FROM finished))
  WHERE NOT multi"""


def finish_oracle(body: str) -> str:
    return oracle(
        body, "docs", mapped=MAPPED_SQL, settled=SETTLED_SQL, lines=MAPPED_LINES, base=SPLIT_BASE, pieces=PIECES, finished=FINISHED
    )


@query("finish_record", finish_oracle(FINISH_ORACLE))
def _(d: Domain) -> DataFrame:
    finished = extract(d.json_documents(), configs.compile_configs(vendor_configs(d)))
    return finished.select(
        "rec_id", "piece", "invoice_number", "invoice_status", F.size("items").cast("bigint").alias("n_items"), "ship_date",
        F.round("ship_cost", 2).alias("ship_cost"), F.round("total", 2).alias("total"),
    )
