"""What keeps jobs in proportion to their input: plans, files and tasks."""

import json

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from checks import domain, q_vendors
from checks.domain import Domain
from checks.registry import QUERIES
from orderloom.operators import records, walk
from orderloom.operators.mapping import map_record, with_config
from orderloom.plans import extract as extract_plan
from orderloom.plans.extract import ExtractResult, extract_with_rejects
from orderloom.sources import configs, staging
from orderloom.streaming import ingest

FOLDER = "/root/testdata/sf0.001"


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_lines_meet_as_numbers_and_documents_are_not_shuffled_again(spark):
    exchanges = [x for x in plan_of(Domain(spark, FOLDER).documents()).splitlines() if "Exchange hashpartitioning" in x]
    assert any("l_orderkey" in x for x in exchanges) and not any("rec_id" in x for x in exchanges)


def test_mapped_parts_come_from_the_walk(spark):
    docs = spark.createDataFrame([(1, '{"a":[{"b":"x"},{"b":0}]}', True)], "vendor_id bigint, body string, need_serial_no boolean")
    doc = {"mapping": {"fulfillment_table": [{"destination_field": "a[i].b", "source_field": "items.itemno"}]}}
    compiled = configs.compile_configs(configs.config_frame(spark, {1: doc}))
    mapped = map_record(with_config(docs.withColumn("doc", F.try_parse_json("body")), compiled))
    assert [(i.itemno, i.zero_fields) for i in mapped.first()["items"]] == [("x", []), ("0", ["itemno"])]
    assert "sort_array" not in plan_of(mapped)


def test_configs_are_compiled_in_many_tasks_and_hashed_where_large(spark, monkeypatch):
    from orderloom import sizing

    some = {v: {"mapping": {"fulfillment_table": [{"destination_field": "a", "source_field": "memo"}]}} for v in range(40)}
    compiled = configs.compile_configs(configs.config_frame(spark, some).coalesce(1))
    assert compiled.rdd.getNumPartitions() > 1
    monkeypatch.setattr(sizing.broadcast_if_small, "__defaults__", (10, 1000))
    rows = spark.createDataFrame([(3, "{}"), (99, "{}")], "vendor_id bigint, body string")
    joined = with_config(rows, compiled)
    assert "SortMergeJoin" not in plan_of(joined) and "BroadcastHashJoin" not in plan_of(joined)
    assert {r.vendor_id: r.mapping is None for r in joined.collect()} == {3: False, 99: True}


def test_staged_files_do_not_grow_with_the_vendors(spark, tmp_path):
    rows = spark.range(4000).select("id", F.when(F.col("id") % 7 > 0, F.col("id") % 1000).alias("vendor_id"))
    for fmt in ("parquet", "json"):
        path = str(tmp_path / fmt)
        staging.stage_write(rows, path, "r1", fmt)
        staging.stage_write(rows.limit(10), path, "r2", fmt)
        staging.stage_write(rows.filter("id < 100"), path, "r2", fmt)
        assert len([*(tmp_path / fmt).rglob("part-*")]) <= 2 * staging.BUCKETS * 8
        read = staging.stage_read(spark, path, "id bigint, run_id string, vendor_id bigint", fmt)
        assert sorted(read.groupBy("run_id").count().collect()) == [("r1", 4000), ("r2", 100)]
        assert sorted(map(tuple, read.filter("run_id = 'r1'").select("id", "vendor_id").collect())) == sorted(map(tuple, rows.collect()), key=lambda r: r[0])
        one = staging.stage_read(spark, path, "id bigint, run_id string, vendor_id bigint", fmt, only={"vendor_id": 3})
        assert sorted(r.id for r in one.filter("run_id = 'r1'").collect()) == [r.id for r in rows.filter("vendor_id = 3").collect()]


class Seen(Exception):
    """Ends a job where the test has seen what it looks at."""


def test_records_that_land_twice_are_finished_once(spark, monkeypatch):
    found = []

    def look(landed, *_):
        found.append(plan_of(landed))
        raise Seen

    monkeypatch.setattr(q_vendors, "dispatch", look)
    with pytest.raises(Seen):
        QUERIES["dispatch_duplicate_keys"](spark, FOLDER)
    assert "ArrowEvalPython" not in found[0]


def test_extracted_records_are_not_written_again(spark, tmp_path, monkeypatch):
    written = []

    def look(*_):
        raise Seen

    monkeypatch.setattr(ingest, "materialize", lambda df, name: written.append(name) or df)
    monkeypatch.setattr(ingest.InvoiceStore, "_stage", look)
    store, rows = ingest.InvoiceStore.at(str(tmp_path), buckets=2), spark.range(1)
    for made, names in ((ExtractResult(rows, rows), []), (rows, ["finished"])):
        with pytest.raises(Seen):
            store.apply(spark, lambda: made, lambda: rows, 1)
        assert written == names


def test_tasks_that_gather_documents_grow_with_the_lines(spark, monkeypatch):
    monkeypatch.setattr(domain, "TASK_LINES", 100)
    d = Domain(spark, FOLDER)
    assert d.lines_by_document().rdd.getNumPartitions() == -(-d.base("lineitem").count() // 100) > 8


def test_documents_are_read_once_for_records_and_rejects(spark):
    read = spark.sparkContext.accumulator(0)

    def counted(rows):
        for batch in rows:
            read.add(batch.num_rows)
            yield batch

    body = '{"order":{"invoice":"I1","status":"shipped"}}'
    rows = [(f"r{i}", i % 4, f"S{i}", "own", True, body if i % 3 else '{"other":1}') for i in range(24)]
    landed = spark.createDataFrame(rows, "rec_id string, vendor_id bigint, so_number string, tran_id string, need_serial_no boolean, body string")
    docs = landed.mapInArrow(counted, landed.schema).withColumn("doc", F.try_parse_json("body"))
    config = {"mapping": {"fulfillment_table": [{"destination_field": "order.invoice", "source_field": "invoice_number"}]}, "check_response_body": "order"}
    made = extract_with_rejects(docs, configs.compile_configs(configs.config_frame(spark, {v: config for v in range(3)})))
    whole = {(r.rec_id, r.vendor_id, r.so_number, r.reject_reason, r.invoice_number) for r in made.rejects.collect()}
    why = {i: "unknown vendor" if i % 4 == 3 else None if i % 3 else "required part of the body is missing" for i in range(24)}
    assert whole == {(f"r{i}", i % 4, f"S{i}", why[i], None) for i in range(24) if why[i]}
    assert sorted(r.rec_id for r in made.records.collect()) == sorted(f"r{i}" for i in range(24) if not why[i])
    assert read.value == 24


def test_a_document_is_mapped_by_its_vendors_kind_of_call_only(spark, monkeypatch):
    taken = []
    whole = extract_plan.map_record
    monkeypatch.setattr(extract_plan, "map_record", lambda df, **how: taken.append(df) or whole(df, **how))
    config = {"mapping": {"fulfillment_table": [{"destination_field": "number", "source_field": "invoice_number"}]}}
    calls = config | {"multi_api_call": {"url": {"raw": "u", "method": "GET"}}}
    compiled = configs.compile_configs(configs.config_frame(spark, {0: config, 1: calls}))
    rows = [(f"r{i}", i % 2, f"S{i}", True, f'{{"number":"I{i}"}}') for i in range(6)]
    docs = spark.createDataFrame(rows, "rec_id string, vendor_id bigint, so_number string, need_serial_no boolean, body string")
    docs = docs.withColumn("doc", F.try_parse_json("body"))
    second = docs.filter("rec_id <> 'r5'").select("vendor_id", "so_number", F.get_json_object("body", "$.number").alias("invoice_number"), "body", "doc")
    records = extract_plan.extract(docs, compiled, second=second)
    assert sorted((r.rec_id, r.invoice_number) for r in records.collect()) == [(f"r{i}", f"I{i}") for i in range(5)]
    assert [sorted(r.rec_id for r in df.collect()) for df in taken] == [["r0", "r2", "r4"], ["r1", "r3", "r5"]]


def test_few_documents_are_python_objects_at_a_time(monkeypatch):
    entries = json.dumps([dict(path="a", target="memo", kind="exact", first="a", last="a", ends="a|a", grp="", field="memo", ord=0)])
    sizes = []
    one = walk._walked
    monkeypatch.setattr(walk, "WALKED", 3)
    monkeypatch.setattr(walk, "_walked", lambda d, *others: sizes.append(len(d)) or one(d, *others))
    texts = [None if i == 4 else f'{{"a":"{i}"}}' for i in range(10)]
    for n in (10, 0):
        got = walk.mapped_of(pa.array(texts[:n], pa.string()), pa.array([entries] * n, pa.string()), pa.array([True] * n, pa.bool_()), False, False)
        assert [r["scalars"]["memo"] for r in got.to_pylist()] == [None if i == 4 else str(i) for i in range(n)]
    assert sizes == [3, 3, 3, 1, 0]


def test_documents_take_their_mapping_along_without_its_entries(spark):
    doc = {"mapping": {"fulfillment_table": [{"destination_field": "a", "source_field": "memo"}]}}
    compiled = configs.compile_configs(configs.config_frame(spark, {1: doc}))
    joined = with_config(spark.createDataFrame([(1, "{}")], "vendor_id bigint, body string"), compiled)
    assert joined.schema["mapping"].dataType.fieldNames() == ["text", "nested"]


def test_finishing_evaluates_costs_and_item_numbers_once(spark):
    costs = spark.createDataFrame([("I1", "$1.50", "x", None)], "invoice_number string, ship_cost string, total string, extra_item_price string")
    made = records.money_from_multi(costs)
    assert made.first()["cost_errors"] == ["total: unreadable cost"]
    assert "lambdafunction" not in plan_of(made.select("cost_errors"))
    texts = "itemno mfg_itemno amount rate quantity_ordered quantity raw_quantity quantity_backordered invoice_status item_details".split()
    schema = f"items array<struct<{', '.join(f'{t}: string' for t in texts)}, zero_fields: array<string>>>"

    def item(amount, rate, quantity, zeros=()):
        return ("a", None, amount, rate, "5", quantity, None, None, None, None, list(zeros))

    rows = [item("7", "2", "3"), item("0", "2", "3", ["amount"]), item(None, "$2", "3 pcs"), item("", "2", ""), item("8", None, "3"), item(None, "x", "3")]
    priced = spark.createDataFrame([(rows,)], schema).select(records.priced_items(F.col("items")).alias("p"))
    assert [(p.amount, p.counted) for p in priced.first()["p"]] == [
        (7.0, True), (6.0, True), (6.0, True), (None, False), (8.0, False), (None, True),
    ]
    assert str(records.priced_items(F.col("items"))).count("regexp_replace") == 6
    assert str(records.record_item_statuses(F.col("items"))).count("array_contains") == 3


def test_carrier_rules_are_read_once_for_all_deliveries(spark):
    schema = "deliveries array<struct<carrier: string, carriermethod: string>>, cfg struct<carrier: struct<services: map<string, map<string, int>>, " + (
        "check_character_for_mapping: string, check_string_for_mapping: string, carriermethod_for_mapping: string, change_carriermethod_to_lowercase: string>>"
    )
    boxes = [("UPS", "Ground"), ("DHL", "Ground"), ("", "Ground"), (None, "x")]
    by_letter = ({"ups": {"ground": 3}, "nonups": {"dhl": 4}}, "true", "0", "carriermethod", "true")
    by_name = ({"ups": {"UPS": 5}}, "", "1", None, "false")
    df = spark.createDataFrame([(boxes, (by_letter,)), (boxes, (by_name,)), (boxes, (None,))], schema)
    made = records.normalize_carriers(df).select("deliveries")
    assert [[tuple(d) for d in r[0]] for r in made.collect()] == [
        [("ups", "3"), ("nonups", "0"), ("", "Ground"), (None, "x")],
        [("ups", "5"), ("nonups", "0"), ("", "Ground"), (None, "x")],
        boxes,
    ]
    # The false values of a flag are asked for outside of the deliveries' lambda only.
    inner = str(records._normalized_deliveries()).split("transform(", 1)[1]
    assert "'null'" not in inner.split(" -> ", 1)[1]


def test_documents_are_walked_as_stored(spark):
    docs = spark.createDataFrame([(1, '{"a":[{"b":"x","c":10.0},{"b":1e10,"c":-0.5}],"s":[{"t":"é"}]}', True)], "vendor_id bigint, body string, need_serial_no boolean")
    pairs = [("a[i].b", "items.itemno"), ("a[i].c", "items.rate"), ("s[i].t", "deliveries.carrier")]
    doc = {"mapping": {"fulfillment_table": [{"destination_field": p, "source_field": t} for p, t in pairs]}}
    compiled = configs.compile_configs(configs.config_frame(spark, {1: doc}))
    mapped = map_record(with_config(docs.withColumn("doc", F.try_parse_json("body")), compiled))
    assert "to_json(doc" not in plan_of(mapped)  # which takes longer than the walk
    row = mapped.first()
    assert [(i.itemno, i.rate) for i in row["items"]] == [("x", "10"), ("1.0E10", "-0.5")]
    assert [d.carrier for d in row.deliveries] == ["é"]


def test_a_hit_of_a_suffix_rule_gives_way_to_the_literal_path():
    entry = {"ord": 0, "path": "o.s", "target": "items.rate", "grp": "items", "field": "rate", "kind": "suffix", "first": "o", "last": "s", "ends": "o|s", "nested": False}

    def rates(*texts):
        columns = pa.array(texts, pa.string()), pa.array([json.dumps([entry])] * len(texts), pa.string()), pa.array([True] * len(texts), pa.bool_())
        return [r["items"] and [i["rate"] for i in r["items"]] for r in walk.mapped_of(*columns, False, False).to_pylist()]

    assert rates('{"o":{"l":[{"s":"1"},{"s":"2"}]}}', '{"o":{"l":[{"s":"1"},{"s":"2"}],"s":"3"}}', '{"o":{}}') == [["1", "2"], ["3"], None]


def test_second_documents_take_the_mapping_along_as_text(spark, monkeypatch):
    found = []

    def look(calling, second, **_):
        found.append(second.schema["mapping"].dataType.fieldNames())
        raise Seen

    monkeypatch.setattr(extract_plan, "enrich_second_call", look)
    with pytest.raises(Seen):
        QUERIES["second_call_job"](spark, FOLDER)
    assert found == [["text", "nested"]]


def test_documents_with_second_calls_are_mapped_once(spark):
    # The first documents are written; only the second ones are still to be mapped.
    assert plan_of(QUERIES["enrich_second_call"](spark, FOLDER)).count("ArrowEvalPython") == 1


def test_statuses_meet_without_their_items(spark):
    plan = plan_of(QUERIES["item_status"](spark, FOLDER))
    above = plan[: plan.index("Join")]
    assert "quantity" not in above and "status" in above
