"""Nothing is lost without a row that says so, and repeats do no harm."""

import json

import pytest
from pyspark.sql import functions as F

from orderloom.operators.mutations import merge_by_key
from orderloom.plans.dispatch import dispatch
from orderloom.plans.extract import extract, extract_with_rejects
from orderloom.plans.feed_load import feed_orders, placed_bodies
from orderloom.schemas import VENDOR_INVOICE, VENDOR_INVOICE_ITEMS
from orderloom.sources.configs import compile_configs, config_frame
from orderloom.sources.feed import order_field, read_feed
from orderloom.sources.responses import read_json_responses, read_xml_responses, rejected_responses, valid_responses
from orderloom.streaming.ingest import InvoiceStore, ingest

from .test_jobs import CONFIG, ORDERS, as_json, compiled, purchase_orders, responses

EMPTY = lambda spark, table: spark.createDataFrame([], table.schema)


def parsed(spark, orders):
    return valid_responses(read_json_responses(responses(spark, as_json, orders)))


def sent(spark, records):
    return dispatch(records.drop("cfg"), purchase_orders(spark), EMPTY(spark, VENDOR_INVOICE), EMPTY(spark, VENDOR_INVOICE_ITEMS))


def test_a_feed_larger_than_one_variant_is_read(spark):
    rows = ",".join(json.dumps({"internalid": str(i), "note": "x" * 400, "deep": {"a": [1.5]}}) for i in range(50_000))
    feed = spark.createDataFrame([(f'{{"data":[{rows}]}}',)], "body string")
    got = read_feed(feed).select("pos", order_field("internalid").alias("i"), order_field("deep").alias("d"), order_field("none").alias("n"))
    assert got.agg(F.count("*"), F.countDistinct("i")).first() == (50_000, 50_000)
    assert got.filter("pos = 7").first()[1:] == ("7", '{"a":[1.5]}', None)


def test_the_first_of_equal_orders_comes_from_the_first_document(spark):
    def document(status):
        return json.dumps({"data": [{"internalid": "1", "createdfrom": "2", "status": status}]})

    rows = [("b", document("second")), ("a", document("first"))]
    for given in (rows, rows[::-1]):
        feed = spark.createDataFrame(given, "file string, body string")
        known, _ = feed_orders(placed_bodies(feed, ("file",)), {"purchase_order_status": "status"}, ("first", "second"))
        assert [r.purchase_order_status for r in known.collect()] == ["first"]


def test_json_that_is_too_large_is_not_called_malformed(spark):
    large = '{"a":[' + ",".join(['"' + "x" * 400 + '"'] * 60_000) + "]}"
    rows = [(1, "SO1", 200, "OK", large), (1, "SO2", 200, "OK", large[:-1])]
    tagged = read_json_responses(spark.createDataFrame(rows, "vendor_id bigint, so_number string, status_code int, reason string, body string"))
    reasons = {r.so_number: r.reject_reason for r in rejected_responses(tagged).select("so_number", "reject_reason").collect()}
    assert reasons.get("SO1") in (None, "body over the size of one document") and reasons["SO2"] == "malformed body"


def test_xml_of_any_root_keeps_all_its_tags_as_text(spark):
    bodies = {
        "A": '<?xml version="1.0"?><!-- <x>1</x> --><Resp a="01"><L><S>01</S></L><L><S>1.50</S><E/></L></Resp>',
        "B": "<ns:Other xmlns:ns=\"u\"><New q='007'>true</New><c><![CDATA[0 < 1]]></c></ns:Other>",
        "C": "<bad", "D": "no xml",
    }
    rows = [(k, 200, "OK", v) for k, v in bodies.items()]
    got = {r.k: r for r in read_xml_responses(spark.createDataFrame(rows, "k string, status_code int, reason string, body string")).drop("doc").collect()}
    assert json.loads(got["A"].body) == {"Resp": {"@a": "01", "L": [{"S": "01"}, {"S": "1.50", "E": None}]}}
    other = json.loads(got["B"].body)["ns:Other"]
    assert (other["New"], other["c"]) == ({"@q": "007", "#text": "true"}, "0 < 1")
    assert got["C"].reject_reason == got["D"].reject_reason == "malformed body"


def test_xml_keeps_every_text(spark):
    bodies = {
        "cdata": ("<o><![CDATA[a <!-- keep --> <?b?> c]]></o>", {"o": "a <!-- keep --> <?b?> c"}),
        "comment": ("<o>a<!-- gone --><![CDATA[ ]]>b<?pi gone?></o>", {"o": "a b"}),
        "name": ("<rés ü='1'><日>x</日></rés>", {"rés": {"@ü": "1", "日": "x"}}),
        "mark": ("<o>\ue000x\ue000</o>", {"o": "\ue000x\ue000"}),
        "prefix": ("<n:o xmlns:n='u'><n:p n:q='1'/><p/></n:o>", {"n:o": {"@xmlns:n": "u", "n:p": {"@n:q": "1"}, "p": None}}),
        "entity": ("<o a='&lt;&#233;'>&amp;&quot; \\ &#10;x</o>", {"o": {"@a": "<é", "#text": '&" \\ \nx'}}),
        "mixed": ("<o>a<b>1</b>c<b>2</b></o>", {"o": {"b": ["1", "2"], "#text": "ac"}}),
        "prolog": ("\ufeff \n<?xml version='1.0' encoding='ISO-8859-1'?><!DOCTYPE o><o>é</o>\n", {"o": "é"}),
        "number": ("<o><a>01</a><a>1.50</a><b>true</b><c> </c><d x=''/></o>", {"o": {"a": ["01", "1.50"], "b": "true", "c": None, "d": {"@x": ""}}}),
        "bomb": ("<!DOCTYPE o [<!ENTITY a 'x'>]><o>&a;</o>", None), "two": ("<a/><b/>", None), "twice": ("<a x='1' x='2'/>", None), "cut": ("<a><b></a>", None),
    }
    rows = [(k, 200, "OK", v) for k, (v, _) in bodies.items()] + [("deep", 200, "OK", "<a>" * 900 + "x" + "</a>" * 900)]
    got = {r.k: r for r in read_xml_responses(spark.createDataFrame(rows, "k string, status_code int, reason string, body string")).drop("doc").collect()}
    for k, (body, want) in bodies.items():
        assert (got[k].reject_reason, json.loads(got[k].body) if want else got[k].body) == ((None, want) if want else ("malformed body", body)), k
    assert got["deep"].reject_reason is None and got["deep"].body.count("{") == 900


def test_pieces_of_one_invoice_are_loaded_together(spark):
    config = CONFIG | {"check_multi_invoice_and_split": True, "fields_to_split_for_multi_invoice": ["invoice_number", "items"]}
    many = (1, "shipped", "A, B", [("01", 1, 1, "1.00"), ("02", 2, 2, "2.00"), ("03", 3, 3, "3.00")])
    records = extract(parsed(spark, [many, ORDERS[2], ORDERS[2]]), compile_configs(config_frame(spark, {1: config})))
    result = sent(spark, records)
    lines = result.vendor_invoice.join(result.vendor_invoice_items.select(F.col("vendor_invoice_id").alias("id"), "itemno"), "id")
    got = {(r.invoice_number, r.itemno) for r in lines.collect()}
    assert got == {("A", "01"), ("B", "02"), ("B", "03"), ("INV3", "04")} and lines.count() == 4


def test_merging_keeps_other_rows_and_null_keys(spark):
    rows = [(1, None, [1], "x", 1), (1, None, [2], "y", 0), (1, "-1", [3], "z", 2), (2, "A", None, "only", 0)]
    df = spark.createDataFrame(rows, "purchase_order_id bigint, invoice_number string, items array<int>, memo string, piece int")
    got = {(r.purchase_order_id, tuple(r["items"] or ()), r.memo) for r in merge_by_key(df, VENDOR_INVOICE, "items").collect()}
    assert got == {(1, (2, 1, 3), "y"), (2, (), "only")}


def test_bad_lines_and_costs_are_rejected_rows(spark):
    bad_line = (1, "shipped", "INV1", [("01", 2, 2, "$10.00"), ("02", 1.5, 3, "5.50")])
    result = sent(spark, extract(parsed(spark, [bad_line]), compiled(spark)))
    assert [r["errors"] for r in result.invalid_items.collect()] == [["quantity: not a valid int"]] or result.invalid_items.count() == 0
    unreadable = as_json("shipped", "INV3", [("04", 1, 1, "2.25")]).replace("4.00", "5")
    docs = parsed(spark, ORDERS).withColumn("body", F.when(F.col("so_number") == "SO3", unreadable).otherwise(F.col("body")))
    docs = docs.withColumn("doc", F.try_parse_json("body"))
    strange = docs.limit(1).withColumn("vendor_id", F.lit(99).cast("bigint")).withColumn("so_number", F.lit("SO99"))
    made = extract_with_rejects(docs.unionByName(strange), compiled(spark))
    reasons = {r.so_number: r.reject_reason for r in made.rejects.collect()}
    assert reasons == {"SO2": "cancelled", "SO4": "no invoice number", "SO3": "ship_cost: unreadable cost", "SO99": "unknown vendor"}
    assert [r.so_number for r in made.records.collect()] == ["SO1"]
    assert "zero_fields" not in json.dumps(made.records.schema.jsonValue()["fields"][made.records.columns.index("deliveries")])


def test_the_store_follows_updates_and_removals_and_keeps_rejects(spark, tmp_path):
    store = InvoiceStore.at(str(tmp_path / "tables"), buckets=2)
    store.create(spark)
    landing, checkpoint = str(tmp_path / "landing"), str(tmp_path / "checkpoint")
    responses(spark, as_json).coalesce(1).write.json(landing)
    with pytest.raises(TypeError):
        ingest(spark, landing, store, lambda: compiled(spark), lambda: purchase_orders(spark))
    for _ in range(2):  # the second run finds nothing new
        ingest(spark, landing, store, lambda: compiled(spark), lambda: purchase_orders(spark), checkpoint).awaitTermination()
    reasons = {r.so_number: r.reject_reason for r in store.rejects(spark).collect()}
    assert reasons == {"SO2": "cancelled", "SO4": "no invoice number", "SO7": "empty body", "SO8": "http status", "SO9": "malformed body"}
    assert store.items.read(spark).count() == 3

    def again(orders):
        return lambda: extract(parsed(spark, orders), compiled(spark)).drop("cfg")

    # The same invoices come again: one without lines, one with another line.
    bare = [(1, "shipped", "INV1", []), (3, "shipped", "INV3", [("09", 4, 4, "2.25")])]
    for batch in (0, 0, 1):
        store.apply(spark, again(bare), lambda: purchase_orders(spark), batch=batch, source="again", skip_loaded=False)
        assert [r.itemno for r in store.items.read(spark).collect()] == ["09"]
        assert store.invoices.read(spark).count() == 2
