"""Flattening, mapping and splitting."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderloom.functions.text import nested_to_json, render_template, upper_selected
from orderloom.operators import mutations, splitting
from orderloom.operators.flatten import explode_multi_field, extract_path, flatten_json, path_index
from orderloom.operators.mapping import map_record, with_config
from orderloom.plans.extract import map_documents
from orderloom.sources import configs

from .configs import MAPPING, document, one_config, vendor_configs
from .domain import Domain, oracle
from .q_sources import MAPPED_SQL, ORDER_PARTS, SETTLED_SQL, mapped_records
from .registry import query


def mapped_by(d: Domain, mapping: list[tuple[str, str]], **extra: object) -> DataFrame:
    """All JSON documents mapped by one config."""
    doc = document(mapping) | extra
    return map_record(with_config(d.json_documents(), configs.compile_configs(one_config(d, doc))))


def long_items(df: DataFrame, *fields: str) -> DataFrame:
    return df.select("rec_id", F.posexplode("items").alias("pos", "i")).select(
        "rec_id", "pos", *[F.col(f"i.{f}").alias(f) for f in fields]
    )


LINE_LEAVES = """
SELECT rec_id, 'order.lines.' || pos || '.' || tag AS path, CASE tag WHEN 'part' THEN 'P' || part WHEN 'mfg' THEN 'M' || supp
    WHEN 'qty' THEN CAST(qty AS VARCHAR) WHEN 'ordered' THEN CAST(ordered AS VARCHAR) WHEN 'back' THEN trim(back_token, '"') ELSE price END AS value
  FROM docs JOIN positioned p ON p.o = docs.o, (VALUES ('part'), ('mfg'), ('qty'), ('ordered'), ('back'), ('price')) t(tag)
  WHERE CASE tag WHEN 'mfg' THEN supp % 4 <> 0 WHEN 'qty' THEN part % 6 <> 4 WHEN 'ordered' THEN part % 9 <> 0 WHEN 'back' THEN supp % 5 <> 0 ELSE TRUE END
UNION ALL SELECT rec_id, 'boxes.' || pos || '.' || tag, CASE tag WHEN 'carrier' THEN carrier WHEN 'service' THEN service
    WHEN 'qty' THEN CAST(ordered AS VARCHAR) ELSE trim(weight_token, '"') END
  FROM docs JOIN positioned p ON p.o = docs.o, (VALUES ('carrier'), ('service'), ('qty'), ('weight')) t(tag)
UNION ALL SELECT rec_id, 'refs.' || k || '.' || tag, CASE tag WHEN 'RefID' THEN json_extract_string(json_body, '$.refs[' || k || '].RefID')
    ELSE json_extract_string(json_body, '$.refs[' || k || '].RefIDQual') END
  FROM docs, (VALUES (0), (1)) r(k), (VALUES ('RefID'), ('RefIDQual')) t(tag)
UNION ALL SELECT rec_id, 'order.' || tag, json_extract_string(json_body, '$.order.' || tag) FROM docs,
    (VALUES ('number'), ('po'), ('status'), ('invoice'), ('shipped'), ('ship.cost'), ('total'), ('extra'), ('tran.id'), ('tran.date'), ('serial')) t(tag)
  WHERE json_exists(json_body, '$.order.' || tag)"""


@query("flatten_json", oracle(LINE_LEAVES, "docs"))
def _(d: Domain) -> DataFrame:
    return flatten_json(d.json_documents().select("rec_id", "body", "doc")).select("rec_id", "path", "value")


@query("extract_path", oracle(f"SELECT rec_id, {ORDER_PARTS.format('tran.id')} AS tran_id, {ORDER_PARTS.format('ship.cost')} AS cost FROM docs", "docs"))
def _(d: Domain) -> DataFrame:
    doc = F.col("doc")
    return d.json_documents().select(
        "rec_id",
        extract_path(doc, "order.tran.id", "string").alias("tran_id"),
        extract_path(doc, "order.ship.cost", "string").alias("cost"),
    )


@query(
    "explode_multi_field",
    oracle(
        """SELECT rec_id, CAST(pos AS INTEGER) AS element_pos, 'P' || part AS part FROM docs JOIN positioned p ON p.o = docs.o""", "docs"
    ),
)
def _(d: Domain) -> DataFrame:
    parts = explode_multi_field(d.json_documents().select("rec_id", "doc"), "order.lines")
    return parts.select("rec_id", "element_pos", F.try_variant_get("doc", "$.part", "string").alias("part"))


@query(
    "map_exact_scalar",
    oracle("SELECT rec_id, invoice_number, invoice_status, ship_cost, tran_id FROM mapped", "docs", mapped=MAPPED_SQL),
)
def _(d: Domain) -> DataFrame:
    exact = [(p, t) for p, t in MAPPING if "." not in t and "[" not in p]
    return mapped_by(d, exact).select("rec_id", "invoice_number", "invoice_status", "ship_cost", "tran_id")


@query(
    "map_exact_into_first_element",
    oracle(
        """SELECT rec_id, CAST(0 AS INTEGER) AS pos, 'T' || o AS itemno, 'P' || (SELECT part FROM positioned p WHERE p.o = docs.o AND pos = 0) AS mfg_itemno FROM docs""",
        "docs",
    ),
)
def _(d: Domain) -> DataFrame:
    mapped = mapped_by(d, [("order.tran.id", "items.itemno"), ("order.lines.0.part", "items.mfg_itemno")])
    return long_items(mapped, "itemno", "mfg_itemno")


@query(
    "collect_serial_numbers",
    oracle(
        """SELECT rec_id, CASE WHEN need_serial_no IS DISTINCT FROM FALSE THEN 'SN' || o || ',T' || o ELSE '' END AS serials FROM docs""", "docs"
    ),
)
def _(d: Domain) -> DataFrame:
    mapped = mapped_by(d, [("order.serial", "items.item_details"), ("order.tran.id", "items.item_details")])
    serials = F.transform(F.col("items")[0]["item_details"], lambda s: s["serialnumber"])
    return mapped.select("rec_id", F.array_join(serials, ",").alias("serials"))


@query("map_by_qualifier", oracle("SELECT rec_id, 'I' || o AS memo, 'R' || o AS po_number FROM docs", "docs"))
def _(d: Domain) -> DataFrame:
    mapped = mapped_by(d, [("RefIDQual['IN']", "memo"), ("RefIDQual['ON']", "po_number")])
    return mapped.select("rec_id", "memo", "po_number")


@query(
    "map_wildcard_to_array",
    oracle(
        """SELECT rec_id, CAST(pos AS INTEGER) AS pos, 'P' || part AS itemno, CASE WHEN supp % 4 <> 0 THEN 'M' || supp END AS mfg_itemno,
        CAST(qty AS VARCHAR) AS quantity, CASE WHEN part % 9 <> 0 THEN CAST(ordered AS VARCHAR) END AS quantity_ordered, price AS rate
        FROM docs JOIN positioned p ON p.o = docs.o""",
        "docs",
    ),
)
def _(d: Domain) -> DataFrame:
    mapped = mapped_by(d, [(p, t) for p, t in MAPPING if t.startswith("items.") and "[i]" in p])
    return long_items(mapped, "itemno", "mfg_itemno", "quantity", "quantity_ordered", "rate")


def nested_documents(d: Domain) -> DataFrame:
    """Documents ``{"g": [{"l": [{"p": …}, …]}, …]}`` with lines in groups by return flag."""
    lines = d.lines_by_document()
    inner = F.concat(F.lit('{"l":['), F.array_join(F.transform(F.sort_array(F.collect_list("json_line")), lambda x: x), ","), F.lit("]}"))
    groups = lines.groupBy("o", "l_returnflag").agg(inner.alias("g"))
    body = F.concat(F.lit('{"g":['), F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("l_returnflag", "g"))), lambda x: x["g"]), ","), F.lit("]}"))
    docs = groups.groupBy("o").agg(body.alias("body")).withColumn("rec_id", F.col("o").cast("string"))
    vendor = F.lit(0).cast("bigint").alias("vendor_id")
    return docs.select("rec_id", vendor, "body", F.try_parse_json("body").alias("doc"), F.lit(True).alias("need_serial_no"))


@query(
    "map_wildcard_nested_array",
    oracle(
        """SELECT CAST(o AS VARCHAR) AS rec_id, CAST(dense_rank() OVER (PARTITION BY o ORDER BY l_returnflag) - 1 AS INTEGER) AS outer_pos,
        CAST(row_number() OVER (PARTITION BY o, l_returnflag ORDER BY json_line) - 1 AS INTEGER) AS inner_pos,
        'P' || part AS itemno, CAST(qty AS VARCHAR) AS quantity FROM line_text""",
        "line_text",
    ),
)
def _(d: Domain) -> DataFrame:
    doc = document([("g[i].l[i].part", "items.itemno"), ("g[i].l[i].qty", "items.quantity")]) | {
        "make_items_inside_items": {"field_to_nest": "items"},
        "position_for_checking_idx_for_nesting": 3,
    }
    mapped = map_record(with_config(nested_documents(d), configs.compile_configs(one_config(d, doc))))
    outer = mapped.select("rec_id", F.posexplode("item_groups").alias("outer_pos", "g"))
    inner = outer.select("rec_id", "outer_pos", F.posexplode("g").alias("inner_pos", "i"))
    return inner.select("rec_id", "outer_pos", "inner_pos", "i.itemno", "i.quantity")


@query(
    "map_prefix_list",
    oracle(
        """SELECT rec_id, CAST(pos AS INTEGER) AS pos, trim(weight_token, '"') AS weight FROM docs JOIN positioned p ON p.o = docs.o""", "docs"
    ),
)
def _(d: Domain) -> DataFrame:
    # every leaf below ``boxes`` is written in path order, so the last one (weight) stays
    mapped = mapped_by(d, [("boxes[i]", "deliveries.weight")])
    return mapped.select("rec_id", F.posexplode("deliveries").alias("pos", "b")).select("rec_id", "pos", "b.weight")


@query(
    "map_suffix_to_array",
    oracle(
        """SELECT rec_id, CAST(pos AS INTEGER) AS pos, 'P' || part AS itemno, price AS rate FROM docs JOIN positioned p ON p.o = docs.o""", "docs"
    ),
)
def _(d: Domain) -> DataFrame:
    return long_items(mapped_by(d, [("order.part", "items.itemno"), ("order.price", "items.rate")]), "itemno", "rate")


@query(
    "path_index",
    oracle(
        """SELECT path, CASE WHEN regexp_matches(path, '^(boxes|refs)') THEN CAST(string_split(path, '.')[2] AS INTEGER)
        WHEN path LIKE 'order.lines.%' THEN CAST(string_split(path, '.')[3] AS INTEGER) ELSE 0 END AS first_index,
        CASE WHEN path LIKE 'order.lines.%' THEN CAST(string_split(path, '.')[3] AS INTEGER)
        WHEN path LIKE 'order.%' THEN 0 ELSE 0 END AS third_segment,
        CASE WHEN regexp_matches(path, '\\.[0-9]') THEN CAST(regexp_extract(path, '\\.([0-9])', 1) AS INTEGER) ELSE 0 END AS legacy_index
        FROM leaves""",
        "docs",
        leaves=LINE_LEAVES,
    ),
)
def _(d: Domain) -> DataFrame:
    path = F.col("path")
    rows = flatten_json(d.json_documents().select("rec_id", "body", "doc"))
    return rows.select(
        "path",
        path_index(path).alias("first_index"),
        path_index(path, 2).alias("third_segment"),
        path_index(path, legacy=True).alias("legacy_index"),
    )


MAPPED_LINES = """SELECT rec_id, vendor_id, vendor_id % 3 AS variant, CAST(pos AS INTEGER) AS pos, 'P' || part AS itemno,
  CASE WHEN supp % 4 <> 0 THEN 'M' || supp END AS mfg_itemno, CAST(qty AS VARCHAR) AS quantity,
  CASE WHEN part % 9 <> 0 THEN CAST(ordered AS VARCHAR) END AS quantity_ordered,
  trim(back_token, '"') AS quantity_backordered, price AS rate,
  CASE WHEN pos = 0 AND need_serial_no IS DISTINCT FROM FALSE THEN '[{"serialnumber":"SN' || docs.o || '"}]' END AS item_details,
  CASE WHEN part % 6 = 2 THEN 'q' ELSE '' END || CASE WHEN supp % 5 = 1 THEN 'b' ELSE '' END AS zeros, docs.o, part, supp, ordered, unit_cents, qty, back_token, ship_day,
  qty_token, carrier, service, weight_token
  FROM docs JOIN positioned p ON p.o = docs.o"""


@query(
    "map_record",
    oracle(
        """SELECT m.rec_id, pos, itemno, mfg_itemno, quantity, quantity_ordered, quantity_backordered, rate, item_details, zeros,
        memo, po_number, invoice_number, invoice_status, ship_date, ship_cost, total, extra_item_price, tran_date
        FROM mapped m JOIN lines l ON m.rec_id = l.rec_id""",
        "docs",
        mapped=MAPPED_SQL,
        lines=MAPPED_LINES,
    ),
)
def _(d: Domain) -> DataFrame:
    scalars = "memo po_number invoice_number invoice_status ship_date ship_cost total extra_item_price tran_date".split()
    rows = mapped_records(d).select("rec_id", *scalars, F.posexplode("items").alias("pos", "i"))
    zeros = F.array_join(
        F.transform("i.zero_fields", lambda z: F.when(z == "quantity", "q").when(z == "quantity_backordered", "b")), ""
    )
    fields = "itemno mfg_itemno quantity quantity_ordered quantity_backordered rate".split()
    return rows.select(
        "rec_id", "pos", *[f"i.{f}" for f in fields], nested_to_json(F.col("i.item_details")).alias("item_details"), zeros.alias("zeros"), *scalars
    )


@query(
    "join_wildcard_values",
    oracle(
        """SELECT rec_id, string_agg(service, ', ' ORDER BY pos) AS memo, string_agg(nullif(carrier, ''), ', ' ORDER BY pos) IS NOT NULL AS has_carrier,
        coalesce(string_agg(nullif(carrier, ''), ', ' ORDER BY pos), '') AS ship_date
        FROM docs JOIN positioned p ON p.o = docs.o GROUP BY rec_id""",
        "docs",
    ),
)
def _(d: Domain) -> DataFrame:
    mapped = mapped_by(d, [("boxes[i].service", "memo"), ("boxes[i].carrier", "ship_date")])
    return mapped.select("rec_id", "memo", (F.col("ship_date") != "").alias("has_carrier"), "ship_date")


@query(
    "render_template",
    oracle(
        """SELECT id, 'GET /' || vendor_po_number || '/' || upper(vendor_name) || '?s=' || coalesce(purchase_order_status, '') || '&all=<<other>>' AS text
        FROM purchase_order""",
        "purchase_order",
    ),
)
def _(d: Domain) -> DataFrame:
    values = F.create_map(
        F.lit("po"), F.col("vendor_po_number"), F.lit("name"), F.col("vendor_name"), F.lit("status"), F.col("purchase_order_status")
    )
    upper = upper_selected(values, F.array(F.lit("name")))
    text = render_template(F.lit("GET /<<po>>/<<name>>?s=<<status>>&all=<<other>>"), upper)
    return d.table("purchase_order").select("id", text.alias("text"))


@query(
    "nested_to_json",
    oracle(
        """SELECT rec_id, CASE WHEN need_serial_no IS DISTINCT FROM FALSE THEN '[{"serialnumber":"SN' || o || '"}]' END AS item_details FROM docs""",
        "docs",
    ),
)
def _(d: Domain) -> DataFrame:
    mapped = mapped_by(d, [("order.serial", "items.item_details")])
    return mapped.select("rec_id", nested_to_json(F.col("items")[0]["item_details"]).alias("item_details"))


@query(
    "unnest_parallel_arrays",
    oracle(
        """SELECT o, part, CASE WHEN pos < 3 THEN supp END AS supp FROM positioned""", "positioned"
    ),
)
def _(d: Domain) -> DataFrame:
    lines = d.lines_by_document()
    entry = F.struct("ln", "part", "supp", "ship_day", "json_line")
    arrays = lines.groupBy("o").agg(F.sort_array(F.collect_list(entry)).alias("l"))
    zipped = arrays.select(
        "o", F.transform("l", lambda x: x["part"]).alias("part"), F.slice(F.transform("l", lambda x: x["supp"]), 1, 3).alias("supp")
    )
    return mutations.unnest_parallel_arrays(zipped, ["part", "supp"])


# --- splitting -----------------------------------------------------------------


def settled_records(d: Domain) -> DataFrame:
    compiled = configs.compile_configs(vendor_configs(d))
    return map_documents(d.json_documents(), compiled)


def pieces(df: DataFrame) -> DataFrame:
    shipped = F.size("deliveries") if "deliveries" in df.columns else F.lit(0)
    return df.select(
        "rec_id", "piece", "invoice_number", "ship_date", "total",
        F.coalesce(F.array_join(F.transform("items", lambda i: i["itemno"]), ","), F.lit("")).alias("itemnos"),
        shipped.alias("n_deliveries"),
    )


SPLIT_BASE = """SELECT s.*, list_transform(string_split(s.invoice_number, ','), lambda x: trim(x)) AS nums,
  list_transform(string_split(s.ship_date, ','), lambda x: trim(x)) AS days, its, len(its) AS k
  FROM settled s JOIN (SELECT rec_id, list(itemno ORDER BY pos) AS its FROM lines GROUP BY rec_id) i ON i.rec_id = s.rec_id"""
WHOLE = """SELECT rec_id, 0 AS piece, invoice_number, ship_date, total, array_to_string(its, ',') AS itemnos, CAST(k AS INTEGER) AS n_deliveries FROM base"""


def split_oracle(body: str) -> str:
    return oracle(body, "docs", mapped=MAPPED_SQL, settled=SETTLED_SQL, lines=MAPPED_LINES, base=SPLIT_BASE)


_POSITIONS = "JOIN (SELECT CAST(unnest(range((SELECT max(greatest(len(nums), k, 1)) FROM base))) AS INTEGER) AS p) r ON p < {}"


@query(
    "split_zip",
    split_oracle(
        f"""{WHOLE} WHERE NOT (len(nums) > 1 AND len(nums) = k) UNION ALL
        SELECT rec_id, p, nums[p + 1], days[p + 1], total, its[p + 1], CAST(k AS INTEGER) FROM base {_POSITIONS.format('k')} WHERE len(nums) > 1 AND len(nums) = k"""
    ),
)
def _(d: Domain) -> DataFrame:
    fields = F.array(F.lit("ship_date"), F.lit("items"))
    return pieces(splitting.split_zip(settled_records(d), fields))


@query(
    "split_pad",
    split_oracle(
        f"""{WHOLE} WHERE NOT (len(nums) > 1 AND len(nums) <> k) UNION ALL
        SELECT rec_id, p, nums[least(p + 1, len(nums))], days[least(p + 1, len(days))], NULL, its[least(p + 1, k)], CAST(k AS INTEGER)
        FROM base {_POSITIONS.format('greatest(k, len(nums))')} WHERE len(nums) > 1 AND len(nums) <> k"""
    ),
)
def _(d: Domain) -> DataFrame:
    fields = F.array(F.lit("ship_date"), F.lit("total"))
    return pieces(splitting.split_pad(settled_records(d), fields))


@query(
    "split_columns",
    split_oracle(
        f"""{WHOLE} WHERE NOT (len(nums) > 1 AND len(nums) = k) UNION ALL
        SELECT rec_id, p, nums[p + 1], days[p + 1], total, its[p + 1], 1 FROM base {_POSITIONS.format('k')} WHERE len(nums) > 1 AND len(nums) = k"""
    ),
)
def _(d: Domain) -> DataFrame:
    fields = F.array(*[F.lit(f) for f in ("invoice_number", "items", "ship_date", "deliveries")])
    return pieces(splitting.split_columns(settled_records(d), fields))
