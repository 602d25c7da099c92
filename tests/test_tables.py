"""Keyed changes, ids, lookups and splitting on hand-made rows."""

import pytest
from pyspark.sql import functions as F

from orderloom.operators import aggregates, dedup, lookups, mutations, splitting, validate
from orderloom.schemas import PURCHASE_ORDER, SALES_ORDER, VENDOR_INVOICE, VENDOR_INVOICE_ITEMS
from orderloom.sizing import broadcast_if_small, repeat_rows


def invoices(spark, rows):
    df = spark.createDataFrame(rows, "id bigint, purchase_order_id bigint, invoice_number string, invoice_status string")
    return mutations._like(spark.createDataFrame([], VENDOR_INVOICE.schema), df)


def test_upsert_invoices_matches_missing_numbers(spark):
    target = invoices(spark, [(1, 1, None, "OPEN")])
    source = spark.createDataFrame([(1, None, "COMPLETED"), (1, "A", "OPEN")], "purchase_order_id bigint, invoice_number string, invoice_status string")
    once = mutations.upsert_invoices(target, source)
    rows = {(r.id, r.invoice_number, r.invoice_status, r._change) for r in once.collect()}
    assert rows == {(1, None, "COMPLETED", "updated"), (2, "A", "OPEN", "inserted")}
    assert [r.modified_at is not None for r in once.orderBy("id").collect()] == [True, False]
    twice = mutations.upsert_invoices(mutations.plain_table(once), source)
    plain = lambda df: {(r.id, r.purchase_order_id, r.invoice_number, r.invoice_status) for r in df.collect()}
    assert plain(twice) == plain(once)


def test_repeated_source_key_is_an_error(spark):
    source = spark.createDataFrame([(1, "A", "x"), (1, "A", "y")], "purchase_order_id bigint, invoice_number string, invoice_status string")
    with pytest.raises(Exception, match="key occurs twice"):
        mutations.upsert_invoices(invoices(spark, []), source).collect()


def test_ids_are_dense_unique_and_repeatable(spark):
    target = spark.createDataFrame([(41,)], "id bigint")
    rows = spark.range(5000).select(F.col("id").alias("k"))
    first = mutations.assign_ids(rows, target, ["k"], hex_digits=2)
    got = {r.k: r.id for r in first.collect()}
    assert sorted(got.values()) == list(range(42, 5042))
    again = mutations.assign_ids(rows.repartition(3), target, ["k"], hex_digits=2)
    assert {r.k: r.id for r in again.collect()} == got


def test_replace_children_keeps_other_parents_and_equal_rows(spark):
    target = mutations._like(
        spark.createDataFrame([], VENDOR_INVOICE_ITEMS.schema),
        spark.createDataFrame([(1, 10, "a"), (2, 20, "b")], "id bigint, vendor_invoice_id bigint, itemno string"),
    )
    new = spark.createDataFrame([(10, "c")] * 3, "vendor_invoice_id bigint, itemno string")
    parents = spark.createDataFrame([(10,)], "vendor_invoice_id bigint")
    rows = sorted((r.id, r.vendor_invoice_id, r.itemno) for r in mutations.replace_children(target, new, parents, "vendor_invoice_id").collect())
    assert rows == [(2, 20, "b"), (3, 10, "c"), (4, 10, "c"), (5, 10, "c")]


def test_repeat_rows_cuts_large_counts(spark):
    df = spark.createDataFrame([("a", 1), ("b", 25), ("c", 7)], "k string, n bigint")
    rows = repeat_rows(df, "n", "i", chunk=10)
    assert sorted((r.k, r.i) for r in rows.collect()) == sorted(
        (k, i) for k, n in (("a", 1), ("b", 25), ("c", 7)) for i in range(1, n + 1)
    )


def test_broadcast_only_what_fits(spark):
    df = spark.range(50).withColumn("s", F.lit("x" * 100))
    hinted = lambda d: "ResolvedHint" in d._jdf.queryExecution().analyzed().toString()
    assert hinted(broadcast_if_small(df, 50))
    assert not hinted(broadcast_if_small(df, 49))
    assert not hinted(broadcast_if_small(df, 50, max_bytes=1000))


def test_pending_orders_with_a_hot_order(spark):
    orders = spark.createDataFrame(
        [(1, 7, "pendingReceipt", "S1", "P1", True), (2, 7, "pendingBilling", "S2", "P2", None), (3, 7, "fullyBilled", "S3", "P3", None)],
        "id bigint, vendor_id bigint, purchase_order_status string, vendor_so_number string, vendor_po_number string, need_serial_number boolean",
    )
    stored = spark.range(4000).select(F.lit(1).cast("bigint").alias("purchase_order_id"))
    rows = lookups.pending_sales_orders(orders, stored).groupBy("so_number").count().collect()
    assert {(r.so_number, r["count"]) for r in rows} == {("S1", 4000), ("S2", 1)}
    assert lookups.pending_purchase_orders(orders, stored, vendor_id=7, distinct=True).count() == 2


def test_resolve_order_id(spark):
    orders = spark.createDataFrame([(5, 1, "S", "P"), (4, 1, "S", "Q"), (9, 2, "S", "P")], "id bigint, vendor_id bigint, vendor_so_number string, vendor_po_number string")
    records = spark.createDataFrame(
        [("a", 1, "S", None), ("b", 1, "", "P"), ("c", 1, "zzz", "P"), ("d", 1, None, None), ("e", 2, None, "P")],
        "r string, vendor_id bigint, so_number string, po_number string",
    )
    got = {r.r: (r.purchase_order_id, r.reject_reason) for r in lookups.resolve_order_id(records, orders).collect()}
    assert got == {"a": (4, None), "b": (5, None), "c": (None, "no matching order"), "d": (None, "no order number"), "e": (9, None)}
    with pytest.raises(Exception, match="no matching order"):
        lookups.resolve_order_id(records.filter("r = 'c'"), orders, mode="fail").collect()


def test_drop_loaded_invoices(spark):
    stored = spark.createDataFrame([(1, "X"), (1, None)], "purchase_order_id bigint, invoice_number string")
    incoming = spark.createDataFrame([(1, "X"), (1, "Y"), (1, None), (2, "X")], "purchase_order_id bigint, invoice_number string")
    keep = lambda mode: {tuple(r) for r in lookups.drop_loaded_invoices(incoming, stored, mode).collect()}
    assert keep("intent") == {(1, "Y"), (1, None), (2, "X")}
    assert keep("strict") == {(1, None)}
    nothing = stored.filter("false")
    assert lookups.drop_loaded_invoices(incoming, nothing, "strict").count() == 4


def test_dedup_is_partial_before_the_shuffle(spark):
    rows = spark.createDataFrame(
        [("1", "10", "pendingReceipt", 0), ("1", "10", "fullyBilled", 1), ("1", "11", "x", 2), ("2", None, "y", 3), ("2", None, "z", 4)],
        "internalid string, createdfrom string, status string, pos int",
    )
    unique = dedup.dedup_first_by_pair(rows)
    assert sorted(r.status for r in unique.collect()) == ["pendingReceipt", "x", "y"]
    plan = unique._jdf.queryExecution().executedPlan().toString()
    assert "partial_min_by" in plan and "Window" not in plan


def test_object_agg_last_value_wins(spark):
    rows = spark.createDataFrame([(1, "a", "x", 1), (1, "a", "y", 2), (1, "b", "z", 3)], "v int, k string, val string, ord int")
    assert aggregates.object_agg(rows, ["v"], "k", "val", "ord").first()["object"] == {"a": "y", "b": "z"}


def split_input(spark, numbers, items, days, groups=None):
    schema = "invoice_number string, ship_date string, items array<struct<itemno:string>>, item_groups array<array<struct<itemno:string>>>, total string"
    nested = None if groups is None else [[(i,) for i in g] for g in groups]
    return spark.createDataFrame([(numbers, days, [(i,) for i in items], nested, "9")], schema)


def cut(df):
    return [(r.invoice_number, [i.itemno for i in r["items"]], r.ship_date, r.total) for r in df.orderBy("piece").collect()]


def test_split_zip(spark):
    fields = F.array(F.lit("total"))
    assert cut(splitting.split_zip(split_input(spark, "A, B", ["i1", "i2"], "d1,d2"), fields)) == [("A", ["i1"], "d1", None), ("B", ["i2"], "d2", None)]
    nested = split_input(spark, "A,B", ["i1", "i2", "i3"], "d1", [["i1", "i2"], ["i3"]])
    assert cut(splitting.split_zip(nested, F.array(F.lit("x")))) == [
        ("A", ["i1"], "d1", "9"), ("A", ["i2"], "d1", "9"), ("B", ["i3"], None, "9"),
    ]
    single = split_input(spark, "A", ["i1", "i2"], "d1")
    assert cut(splitting.split_zip(single, fields)) == [("A", ["i1", "i2"], "d1", "9")]


def test_split_pad(spark):
    got = cut(splitting.split_pad(split_input(spark, "A,B,C", ["i1", "i2"], "d1"), F.array(F.lit("x"))))
    assert got == [("A", ["i1"], "d1", "9"), ("B", ["i2"], "d1", "9"), ("C", ["i2"], "d1", "9")]


def test_split_columns(spark):
    fields = F.array(*[F.lit(f) for f in ("invoice_number", "ship_date", "total")])
    got = cut(splitting.split_columns(split_input(spark, "A,B", ["i1", "i2"], "d1"), fields))
    assert got == [("A", ["i1"], "d1", "9"), ("B", ["i2"], None, None)]


def test_validation(spark):
    rows = spark.createDataFrame([("1", 5, "3", "2022/01/31", ""), ("x", None, "3", "soon", "n")], "point_id string, sales_order_id bigint, vendor_id string, tran_date string, vendor_name string")
    checked = validate.load(rows, PURCHASE_ORDER)
    good = validate.good_rows(checked).first()
    assert (good.point_id, str(good.tran_date), good.vendor_name) == (1, "2022-01-31", None)
    assert sorted(validate.bad_rows(checked).first()["errors"]) == [
        "point_id: not a valid bigint", "sales_order_id: required", "tran_date: not a valid date",
    ]
    with pytest.raises(Exception, match="not a valid bigint"):
        validate.load(rows, PURCHASE_ORDER, mode="fail").collect()
    loaded = validate.load(spark.createDataFrame([(1,)], "soint_id int"), SALES_ORDER).first()
    assert loaded.invoiced is False and loaded.errors == []
