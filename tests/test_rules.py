"""Scalar rules on hand-worked rows."""

import pytest
from pyspark.sql import functions as F

from orderloom.functions import carrier, dates, money, status, text
from orderloom.functions.common import is_set


def one(spark, *columns):
    return tuple(spark.range(1).select(*[c.alias(f"c{i}") for i, c in enumerate(columns)]).first())


N = None
STATUS_ROWS = [
    (5, 5, N, "COMPLETED"),
    (5, "0", N, "PROCESSING"),
    (5, 0, N, "PROCESSING"),
    (5, 2, 0, "PARTIAL"),
    (5, 7, N, ""),
    (5, 2, 5, "BACKORDERED"),
    (5, 5, 3, "COMPLETED"),
    (5, 0, 5, "own"),
    (N, 4, N, "COMPLETED"),
    (N, 4, 2, "PARTIAL"),
    (N, "0", 2, "BACKORDERED"),
    (N, N, N, "own"),
]


@pytest.mark.parametrize("o,s,b,want", STATUS_ROWS)
def test_item_status(spark, o, s, b, want):
    values = [F.lit(v).cast("string" if isinstance(v, str) else "int") for v in (o, s, b)]
    has = [is_set(c, numeric=not isinstance(v, str)) for c, v in zip(values, (o, s, b))]
    assert one(spark, status.item_status(*values, F.lit("own"), *has)) == (want,)


@pytest.mark.parametrize(
    "statuses,want",
    [
        (["COMPLETED", "COMPLETED"], "COMPLETED"),
        (["COMPLETED", "PROCESSING"], "PROCESSING"),
        (["PROCESSING", "BACKORDERED"], "PARTIAL"),
        (["BACKORDERED", "BACKORDERED", ""], "BACKORDERED"),
        (["COMPLETED", "PARTIAL"], "PARTIAL"),
        (["COMPLETED", "CANCELLED"], ""),
        ([N, ""], ""),
        ([], ""),
    ],
)
def test_rollup(spark, statuses, want):
    array = F.lit(N).cast("array<string>") if not statuses else F.array(*[F.lit(s).cast("string") for s in statuses])
    rows = spark.createDataFrame([(s,) for s in statuses], "s string")
    assert one(spark, status.rollup_status(array)) == (want,)
    assert rows.agg(status.rollup_status_agg(F.col("s"))).first()[0] == want


def test_money(spark):
    tokens = ["9.50, 10.00", "$1,234.50", "1,234,567.89", "100"]
    assert one(spark, *[money.money_value(F.lit(t)) for t in tokens]) == (9.5, 1234.5, 234567.89, N)
    assert one(spark, money.money_value(F.lit(tokens[0]), "number")) == (10.0,)
    assert one(spark, money.clean_number(F.lit("$-1,200.50 EUR")), money.clean_number(F.lit("x"))) == (-1200.5, N)


def test_mirror_cost(spark):
    for a, b, want in ((N, "3", ("3", "3")), ("4", "", ("4", "4")), ("0", N, ("0", "0")), ("1", "2", ("1", "2")), (N, N, (N, N))):
        assert one(spark, *money.mirror_cost(F.lit(a).cast("string"), F.lit(b).cast("string"))) == want


def test_carrier(spark):
    on, off = F.lit(True), F.lit(False)
    names = ["UPS Ground", "USPS", "FedEx"]
    assert one(spark, *[carrier.carrier_name(F.lit(n), on, off) for n in names]) == ("ups", "ups", "nonups")
    assert one(spark, *[carrier.carrier_name(F.lit(n), off, on) for n in names]) == ("ups", "nonups", "nonups")
    services = F.create_map(F.lit("ups"), status.map_literal({"ground": 3}, "int"))
    assert one(
        spark, *[carrier.carrier_service(F.lit(c), F.lit(s), services) for c, s in (("ups", "ground"), ("ups", "x"), ("nonups", "ground"))]
    ) == (3, 0, 0)
    assert one(spark, *[carrier.default_weight(F.lit(w).cast("string"), F.lit(z)) for w, z in ((N, False), ("0", False), ("0", True), ("2", False))]) == (
        "0.1", "0", "0.1", "2",
    )


def test_dates(spark):
    texts = ["2022-01-31", "2022/01/31", "01/31/2022", "Jan 31, 2022", "31 Jan 2022", "20220131", "2022-01-31 10:11:12", "2022-02-31", "x"]
    got = one(spark, *[dates.parse_date_any(F.lit(t)) for t in texts])
    assert [str(v) for v in got[:7]] == ["2022-01-31"] * 7 and got[7:] == (N, N)
    assert one(spark, dates.parse_date_format(F.lit(" 31.01.2022 "), "dd.MM.yyyy"), dates.first_of_list(F.lit("a,b"))) == ("2022-01-31", "a")


def test_status_map(spark):
    by_raw = status.map_literal(status.invert_status_map({"COMPLETED": ["a", "b"], "OPEN": "b", "PARTIAL": "c"}))
    assert one(spark, *[status.map_status(F.lit(r), by_raw) for r in "abcx"]) == ("COMPLETED", "COMPLETED", "PARTIAL", "x")


def test_templates(spark):
    values = F.create_map(F.lit("a"), F.lit("x"), F.lit("b"), F.lit(N).cast("string"))
    upper = text.upper_selected(values, F.array(F.lit("a")))
    assert one(spark, text.render_template(F.lit("<<a>>-<<b>>-<<c>>"), upper)) == ("X--<<c>>",)
    assert one(spark, text.strip_suffix(F.lit("SO1-S")), text.strip_suffix(F.lit("S-SO"))) == ("SO1", "S-SO")
