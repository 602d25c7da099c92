"""Flattening: worked examples, rebuild property, depth, plan shape."""

import json

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from orderloom.operators.flatten import explode_multi_field, flatten_json, has_path, leaves, path_index

EXAMPLE = """{"order": {"number": "SO1", "invoice": "INV1",
  "lines": [{"part": "P1", "qty": "2", "ordered": "2", "price": "$10.00"},
            {"part": "P2", "qty": "1", "ordered": "3", "price": "1,200.50"}],
  "ship": {"cost": "5.00"}}, "empty": {}, "none": []}"""


def documents(spark, *bodies):
    df = spark.createDataFrame(list(enumerate(bodies)), "rec int, body string")
    return df.withColumn("doc", F.try_parse_json("body"))


def flat(value, path=""):
    """The expected leaves: dotted paths, positions as segments, empty containers gone."""
    if isinstance(value, dict):
        parts = [flat(v, f"{path}.{k}" if path else k) for k, v in value.items()]
    elif isinstance(value, list):
        parts = [flat(v, f"{path}.{i}" if path else str(i)) for i, v in enumerate(value)]
    else:
        return {path: value}
    return {k: v for part in parts for k, v in part.items()}


def test_example_has_eleven_leaves(spark):
    got = {r.path: r.value for r in flatten_json(documents(spark, EXAMPLE)).collect()}
    assert got == flat(json.loads(EXAMPLE))
    assert len(got) == 11


def test_both_routes_agree_and_depth_is_unlimited(spark):
    deep = "1"
    for i in range(40):
        deep = f'{{"k{i}":[{deep},{{}}]}}' if i % 2 else f"[{deep},null]"
    docs = documents(spark, EXAMPLE, '{"a":%s}' % deep, "{}", '{"x":null,"y":[[],{"z":0}]}')
    rows = {(r.rec, r.path, r.value) for r in flatten_json(docs).collect()}
    inside = docs.select("rec", F.explode(leaves(F.col("doc"), F.col("body"))).alias("l")).select("rec", "l.path", "l.value")
    assert rows == {(r.rec, r.path, r.value) for r in inside.collect()}
    assert max(r[1].count(".") for r in rows) >= 40


scalars = st.one_of(st.none(), st.text("ab1", max_size=3), st.integers(-9, 9))
trees = st.recursive(
    scalars,
    lambda inner: st.one_of(st.lists(inner, max_size=3), st.dictionaries(st.text("xyz", min_size=1, max_size=2), inner, max_size=3)),
    max_leaves=12,
)


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.dictionaries(st.text("pq", min_size=1, max_size=2), trees, max_size=3), min_size=1, max_size=8))
def test_any_document(spark, bodies):
    docs = documents(spark, *[json.dumps(b) for b in bodies])
    got = {(r.rec, r.path, r.value) for r in flatten_json(docs).collect()}
    want = {(i, p, None if v is None else str(v)) for i, b in enumerate(bodies) for p, v in flat(b).items()}
    assert got == want


def test_truth_of_scalars(spark):
    docs = documents(spark, '{"a":"","b":"0","c":0,"d":1.5,"e":false,"f":true,"g":null,"h":0.0}')
    rows = docs.select(F.explode(leaves(F.col("doc"), F.col("body"))).alias("l")).select("l.path", "l.truthy").collect()
    assert {r.path for r in rows if r.truthy} == {"b", "d", "f"}


def test_lone_lists_read_as_objects(spark):
    docs = documents(spark, '{"R":[{"L":[{"s":["01"]}],"n":["",""]}]}')
    got = {r.path: r.value for r in flatten_json(docs, lone_lists=True).collect()}
    assert got == {"R.L.s": "01", "R.n.0": None, "R.n.1": None}


def test_multi_field(spark):
    docs = documents(spark, '{"o":{"l":[{"a":1},{"a":2}]}}', '{"o":{"l":{"a":3}}}', '{"o":{"l":[]}}', '{"a":5}')
    value = F.try_variant_get("doc", "$.a", "int").alias("a")
    rows = explode_multi_field(docs, "o.l").select("rec", "element_pos", value).collect()
    assert sorted((r.rec, r.element_pos, r.a or 0) for r in rows) == [(0, 0, 1), (0, 1, 2), (1, 0, 3), (2, 0, 0), (3, 0, 5)]
    last = explode_multi_field(docs, "o.l", keep="last").filter("rec = 0").select("element_pos", value).collect()
    assert [(r.element_pos, r.a) for r in last] == [(1, 2)]


def test_path_index(spark):
    row = spark.range(1).select(
        path_index(F.lit("a.2.b")).alias("a"),
        path_index(F.lit("a.12.b")).alias("b"),
        path_index(F.lit("a.12.b"), legacy=True).alias("c"),
        path_index(F.lit("a.12.b"), 1).alias("d"),
        path_index(F.lit("a.b")).alias("e"),
        path_index(F.lit("a.3.l.7.x"), 3).alias("f"),
        path_index(F.lit("a.3.l.7.x"), 2).alias("g"),
        path_index(F.lit("a.3"), 5).alias("h"),
    ).first()
    assert tuple(row) == (2, 12, 1, 12, 0, 7, 0, 3)


def test_has_path(spark):
    docs = documents(spark, '{"a":{"b":1}}', '{"a":{"b":null}}', '{"a":{}}')
    assert [r[0] for r in docs.orderBy("rec").select(has_path(F.col("doc"), "a.b")).collect()] == [True, False, False]


def test_plan_is_narrow(spark):
    plan = flatten_json(documents(spark, EXAMPLE))._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Join" not in plan and "Python" not in plan
