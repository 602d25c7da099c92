"""Mapping: the worked example, qualifiers, nesting, serials, precedence, plan shape."""

import json

from pyspark.sql import functions as F

from orderloom.operators.mapping import map_record, with_config
from orderloom.operators.records import money_from_multi, order_total, record_item_status, set_calculated_status
from orderloom.sources.configs import compile_configs, config_frame, read_configs, vendor_mapping_rows, vendor_status_rows


def config(pairs, **extra):
    return {"mapping": {"fulfillment_table": [{"destination_field": p, "source_field": t} for p, t in pairs]}} | extra


def mapped(spark, bodies, pairs, serial=True, lone_lists=False, **extra):
    docs = spark.createDataFrame([(i, 1, b, serial) for i, b in enumerate(bodies)], "rec int, vendor_id bigint, body string, need_serial_no boolean")
    compiled = compile_configs(config_frame(spark, {1: config(pairs, **extra)}))
    return map_record(with_config(docs.withColumn("doc", F.try_parse_json("body")), compiled), lone_lists=lone_lists)


EXAMPLE = """{"order": {"number": "SO1", "invoice": "INV1",
  "lines": [{"part": "P1", "qty": "2", "ordered": "2", "price": "$10.00"},
            {"part": "P2", "qty": "1", "ordered": "3", "price": "1,200.50"}],
  "ship": {"cost": "5.00"}}, "empty": {}}"""
PAIRS = [
    ("order.invoice", "invoice_number"),
    ("order.ship.cost", "ship_cost"),
    ("order.lines[i].part", "items.itemno"),
    ("order.lines[i].qty", "items.quantity"),
    ("order.lines[i].ordered", "items.quantity_ordered"),
    ("order.lines[i].price", "items.rate"),
]


def test_end_to_end_example(spark):
    df = mapped(spark, [EXAMPLE], PAIRS)
    statuses = df.select(F.transform("items", record_item_status)).first()[0]
    assert statuses == ["COMPLETED", "PARTIAL"]
    row = df.transform(set_calculated_status).transform(money_from_multi).transform(order_total).first()
    assert row.invoice_status == "PARTIAL" and row.invoice_number == "INV1"
    assert [i.amount for i in row["items"]] == [20.0, 1200.5]
    assert (row.ship_cost, row.total) == (5.0, 1225.5)


def test_positions_align_with_gaps_and_missing_fields(spark):
    body = '{"o":{"l":{"2":{"p":"c"},"12":{"p":"m","q":"4"},"0":{"q":"1"}}}}'
    rows = mapped(spark, [body], [("o.l[i].p", "items.itemno"), ("o.l[i].q", "items.quantity")]).first()["items"]
    assert [(i.itemno, i.quantity) for i in rows] == [(None, "1"), ("c", None), ("m", "4")]


def test_more_than_ten_positions_stay_in_order(spark):
    body = '{"o":{"l":[' + ",".join(f'{{"p":"p{i}"}}' for i in range(25)) + "]}}"
    rows = mapped(spark, [body], [("o.l[i].p", "items.itemno")]).first()["items"]
    assert [i.itemno for i in rows] == [f"p{i}" for i in range(25)]


def test_exact_path_wins_over_rule_and_falsy_scalars_are_skipped(spark):
    body = '{"a":{"x":"E","y":{"x":"R"}},"n":{"inv":""},"m":0,"s":"ok"}'
    df = mapped(spark, [body], [("a.x", "items.itemno"), ("n.inv", "invoice_number"), ("m", "memo"), ("s", "tran_id")])
    row = df.first()
    assert [i.itemno for i in row["items"]] == ["E"]
    assert row.invoice_number is None and row.memo is None and sorted(row.seen_fields) == ["tran_id"]


def test_numeric_zero_is_remembered(spark):
    row = mapped(spark, ['{"l":[{"q":0},{"q":"0"}]}'], [("l[i].q", "items.quantity")]).first()
    assert [i.zero_fields for i in row["items"]] == [["quantity"], []]


def test_qualifier_takes_the_first_match(spark):
    body = '{"r":[{"RefIDQual":"ON","RefID":"o"},{"RefIDQual":"IN","RefID":"i"},{"RefIDQual":"IN","RefID":"j"}]}'
    row = mapped(spark, [body, "{}"], [("RefIDQual['IN']", "memo"), ("RefIDQual['ON']", "tran_id")]).orderBy("rec").collect()
    assert [(r.memo, r.tran_id) for r in row] == [("i", "o"), (None, None)]


def test_serial_numbers(spark):
    pairs = [("s", "items.item_details"), ("l[i].p", "items.itemno")]
    body = '{"s":"SN1","l":[{"p":"a"},{"p":"b"}]}'
    for flagged, want in ((True, ["SN1"]), (None, ["SN1"]), (False, [])):
        items = mapped(spark, [body], pairs, serial=flagged).first()["items"]
        assert [s.serialnumber for s in items[0].item_details] == want
        assert items[1].item_details == [] and items[0].itemno == "a"


def test_nested_items(spark):
    body = '{"g":[{"l":[{"p":"a"},{"p":"b"}]},{"l":[{"p":"c"}]}]}'
    extra = {"make_items_inside_items": {"field_to_nest": "items"}, "position_for_checking_idx_for_nesting": 3}
    row = mapped(spark, [body], [("g[i].l[i].p", "items.itemno")], **extra).first()
    assert [[i.itemno for i in g] for g in row.item_groups] == [["a", "b"], ["c"]]
    assert [i.itemno for i in row["items"]] == ["a", "b", "c"]


def test_joined_wildcards(spark):
    body = '{"b":[{"d":"1","t":"x"},{"d":"","t":null},{"d":"3","t":"z"}]}'
    row = mapped(spark, [body, "{}"], [("b[i].d", "ship_date"), ("b[i].t", "trackingnumber")]).orderBy("rec").collect()
    assert [(r.ship_date, r.trackingnumber) for r in row] == [("1, 3", "x, z"), ("", "")]


def test_unknown_vendor_maps_to_nothing(spark):
    docs = spark.createDataFrame([(9, "{}", True)], "vendor_id bigint, body string, need_serial_no boolean")
    compiled = compile_configs(config_frame(spark, {1: config(PAIRS)}))
    row = map_record(with_config(docs.withColumn("doc", F.try_parse_json("body")), compiled)).first()
    assert row.invoice_number is None and row["items"] is None


def test_plan_has_no_shuffle(spark):
    plan = mapped(spark, [EXAMPLE], PAIRS)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange hashpartitioning" not in plan and "SortMergeJoin" not in plan
    # One walk of each document over Arrow columns, no row-at-a-time Python.
    assert plan.count("ArrowEvalPython [") == 1 and "BatchEvalPython" not in plan


def test_config_files_and_precedence(spark, tmp_path):
    doc = config([("a.b", "memo"), ("l[i].p", "items.itemno"), ("a.b", "tran_id")], order_status_mapping={"B": ["x", "y"], "A": "x"})
    (tmp_path / "7.json").write_text(json.dumps(doc, indent=1))
    read = read_configs(spark, str(tmp_path))
    rows = {(r.vendor_id, r.doc_path, r.target_group, r.target_field) for r in vendor_mapping_rows(read).collect()}
    assert rows == {(7, "l[i].p", "items", "itemno"), (7, "a.b", "", "tran_id")}
    assert sorted((r.raw, r.canonical) for r in vendor_status_rows(read).collect()) == [("x", "A"), ("x", "B"), ("y", "B")]
    assert compile_configs(read).select("cfg.status_map").first()[0] == {"x": "B", "y": "B"}
