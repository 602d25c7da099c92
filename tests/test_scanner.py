"""Feeds cut into elements: like a JSON parser on small ones, and the same in any number of ranges."""

import json
import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from orderloom.plans.feed_load import load_feed, load_feed_files
from orderloom.schemas import PURCHASE_ORDER, SALES_ORDER
from orderloom.sources.feed import order_field, read_feed, tag_feed, tag_feed_files
from orderloom.sources.scanner import Cutter, Transition, elements

scalars = st.one_of(st.none(), st.booleans(), st.integers(-9, 10**12), st.text('ab"\\{}[],: \n\té日🙂', max_size=8))
values = st.recursive(scalars, lambda v: st.one_of(st.lists(v, max_size=3), st.dictionaries(st.text('kd"\\{ é', max_size=3), v, max_size=3)), max_leaves=8)
feeds = st.tuples(
    st.dictionaries(st.sampled_from(["a", "more", "x\"data", "é"]), values, max_size=2), st.lists(values, max_size=6),
    st.dictionaries(st.sampled_from(["z", "data2", "list"]), values, max_size=2),
)


def written(before, data, after, **style):
    return json.dumps({**before, "data": data, **after}, **style)


@settings(max_examples=300, deadline=None)
@given(feeds, st.sampled_from([{}, {"indent": 1}, {"separators": (",", ":")}, {"ensure_ascii": False}]))
def test_elements_as_a_parser_finds_them(feed, style):
    assert [json.loads(e) for e in elements(written(*feed, **style))] == feed[1]


def in_ranges(text, cuts):
    """What the tasks of several ranges find, put together as the plan does it."""
    rows = text.encode().split(b"}")
    last = rows.pop() if rows[-1].strip() == b"" else None
    pieces = [r + b"}" for r in rows]
    edges = sorted({0, len(pieces), *(c % (len(pieces) + 1) for c in cuts)})
    ranges = [b"".join(pieces[a:b]) for a, b in zip(edges, edges[1:])]
    if last is not None:
        ranges[-1:] = [(ranges[-1] if ranges else b"") + last]
    inside = depth = 0
    found, region, first = {}, False, 0
    for block, data in enumerate(ranges):
        cutter, turn = Cutter(bool(inside), depth), Transition()
        rows = [r for i in range(0, len(data), 7 if b"\\" not in data else len(data)) for r in cutter.cut(data[i : i + 7] if b"\\" not in data else data)]
        rows += list(cutter.rest())
        turn.add(data)
        depth += turn.if_inside if inside else turn.if_outside
        inside = (inside + turn.quotes) % 2
        assert (cutter.inside, cutter.depth) == (bool(inside), depth)
        known, early = cutter.counts
        for is_early, nth, _, part in rows:
            if region or not is_early:
                at = first + nth + (early if region and not is_early else 0)
                found[at] = found.get(at, b"") + part
        first += known + (early if region else 0)
        region = region if cutter.last_region is None else cutter.last_region
    return [found[k].strip() for k in sorted(found) if k or found[k].strip()]


@settings(max_examples=300, deadline=None)
@given(feeds, st.lists(st.integers(0, 400), max_size=6))
def test_ranges_give_the_same_elements(feed, cuts):
    text = written(*feed) + "\n"
    assert [json.loads(e) for e in in_ranges(text, cuts)] == feed[1]


@pytest.mark.parametrize("text", [
    None, "", "[]", "5", "{}", '{"data":5}', '{"data":{"a":1}}', '{"data":[{"a":1}]', '{"data":[{"a":1}', '{"data":["a]}', '[{"data":[1]}]',
    '{"data":[]} x', '{"data":[]}{"data":[]}', '}{"data":[]', '{"x":{"data":[1]}}', '{"\\"data":[1]}',
])
def test_what_is_no_feed(text):
    assert elements(text) is None


MIXED = '{"meta":{"n":[1,2]},"data":[{"a":"1","n":1.50},5,null,"{\\"a\\":1}",[{"z":1},2],{"b":tru},{"a":"2","d":{"x":[1.0]}}],"more":[{"a":"9"}]}'


def test_bad_elements_are_rows_with_their_position(spark):
    df = spark.createDataFrame([("f", MIXED), ("g", '{"data":[]}'), ("h", "nothing"), ("i", None)], "file string, body string")
    rows = {(r.file, r.pos): r for r in tag_feed(df).collect()}
    assert {k: r.reject_reason for k, r in rows.items()} == {
        ("f", 0): None, ("f", 1): "the element is not an object", ("f", 2): "the element is not an object", ("f", 3): "the element is not an object",
        ("f", 4): "the element is not an object", ("f", 5): "malformed element", ("f", 6): None,
        ("h", None): "the feed is not a JSON object with a data list", ("i", None): "the feed is not a JSON object with a data list",
    }
    assert rows["f", 0].order_doc == {"a": "1", "n": "1.5"} and rows["f", 6].order_doc["d"] == '{"x":[1.0]}'
    assert read_feed(df, mode="skip").count() == 2
    for column in ("pos", "order_doc"):
        with pytest.raises(Exception, match="not an object|malformed|no feed|not a JSON"):
            read_feed(df).select(column).collect()


def entry(i, rng):
    note = "".join(rng.choice('ab"\\{}[],é') for _ in range(rng.randrange(12)))
    return {"internalid": str(i), "createdfrom": str(i % 50), "status": "pendingReceipt", "soint": str(i % 90), "sostatus": "s", "day": "2024-01-05", "vendor": "1", "note": note, "deep": [{"k": note}]}


@pytest.fixture
def small_ranges(spark):
    old = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    yield
    for k, v in old.items():
        spark.conf.set(k, v)


def test_a_file_in_many_ranges(spark, small_ranges, tmp_path):
    rng = random.Random(3)
    data = [entry(i, rng) for i in range(4000)]
    data[1000:1000] = [7, {"note": "}" * 50_000 + '"' * 40_000}, None]
    texts = {"a.json": written({"more": [{"x": 1}] * 3000}, data, {"late": [{"y": [1, 2]}] * 2000}), "b.json": '{"data":[]}\n', "c.json": written({}, [{"k": 1}], {}) + "\n \n",
             "d.json": written({}, data[:300], {})[:-1], "e.json": written({}, data[:300], {}) + "}", "f.json": "no feed"}
    for name, text in texts.items():
        (tmp_path / name).write_text(text)
    tagged = tag_feed_files(spark, str(tmp_path))
    assert spark.read.option("lineSep", "}").text(str(tmp_path)).rdd.getNumPartitions() > 20
    rows = [(r.file.rsplit("/", 1)[1], r.pos, r.reject_reason, r.element) for r in tagged.collect()]
    good = sorted((f, p, e) for f, p, _, e in rows if p is not None)
    assert [json.loads(e) for f, _, e in good if f == "a.json"] == data and [p for f, p, _ in good if f == "a.json"] == list(range(4003))
    assert [e for f, _, e in good if f == "c.json"] == ['{"k": 1}'] and {f for f, _, _ in good} == {"a.json", "c.json"}
    assert sorted((f, p) for f, p, r, _ in rows if r) == [("a.json", 1000), ("a.json", 1002)] + [("d.json", None), ("e.json", None), ("f.json", None)] or sorted(
        (f, -1 if p is None else p) for f, p, r, _ in rows if r
    ) == [("a.json", 1000), ("a.json", 1002), ("d.json", -1), ("e.json", -1), ("f.json", -1)]


def test_the_job_reads_files_as_it_reads_bodies(spark, small_ranges, tmp_path):
    rng = random.Random(4)
    mapping = {"point_id": "internalid", "soint_id": "soint", "sales_order_status": "sostatus", "purchase_order_status": "status", "tran_date": "day", "vendor_id": "vendor"}
    parts = [[entry(rng.randrange(300), rng) for _ in range(200)] + [n] for n in range(3)]
    for n, part in enumerate(parts):
        (tmp_path / f"{n}.json").write_text(written({}, part, {}))
    (tmp_path / "9.json").write_text('{"data":[{"internalid":"1"}')
    none = [spark.createDataFrame([], t.schema) for t in (SALES_ORDER, PURCHASE_ORDER)]
    by_file = load_feed_files(spark, str(tmp_path), mapping, ("pendingReceipt",), *none)
    bodies = spark.read.text(str(tmp_path), wholetext=True).select(F.col("value").alias("body"), F.col("_metadata.file_path").alias("file"))
    by_body = load_feed(bodies, mapping, ("pendingReceipt",), *none, order_by=("file",))

    def rows(df):
        return sorted(str(r) for r in df.drop("id", "sales_order_id", "created_at", "modified_at").collect())

    assert rows(by_file.purchase_order) == rows(by_body.purchase_order) and rows(by_file.sales_order) == rows(by_body.sales_order)
    assert by_file.purchase_order.count() == len({e["internalid"] for part in parts for e in part[:-1]})
    assert rows(by_file.rejects) == rows(by_body.rejects) and by_file.rejects.count() == 4
    with pytest.raises(ValueError):
        load_feed_files(spark, str(tmp_path), mapping, ("pendingReceipt",), *none, mode="fail")
    assert tag_feed(bodies).select(order_field("note")).count() == 604
