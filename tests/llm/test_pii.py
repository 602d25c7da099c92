import random
import re

import pytest

from orderloom.llm import pii

from .support import clashing, documents

SOME = "/root/testdata/sf0.01"

PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        x = int(c) * (1 + i % 2)
        total += x - 9 * (x > 9)
    return total % 10 == 0


def valid(kind, match):
    digits = re.sub("[^0-9]", "", match)
    if kind == "ip":
        return all(int(p) <= 255 for p in match.split("."))
    if kind == "card":
        return 12 <= len(digits) <= 19 and luhn(digits)
    return kind == "email" or 9 <= len(digits) <= 15


def brute(text):
    spans = [(m.start(), pii.KINDS.index(k), m.end()) for k, p in PATTERNS.items() for m in re.finditer(p, text or "") if valid(k, m[0])]
    return sorted(spans)


HARD = [
    "a@b.c@d.e", "x.y@z.com.", "4111 1111 1111 1111-", "4111-1111-1111-1111 4111111111111111", "1.2.3.4.5.6.7.8", "1.2.3.4.5",
    "256.1.1.1 0001.2.3.004 00255.1.1.1", "+1 (988) 555-2485 x +49 30 1234567.", "a@b..c q@r.s-", "é@b.de ñ a.b@c.d🙂x@y.zz",
    "\x01a@b\x01c.d 1\x012 a@b\x01c", " ", "", None, "foo@bar@baz.com", "a+b@c.d+e@f.g", "1" * 30 + " " + "2 " * 200, "+1.2.3.4.5.6.7.8.9",
    "4 1 1 1 1 1 1 1 1 1 1 1 1 1 1 1", "0" * 14, "1 " * 5000 + "a@" + "b." * 5000 + "c", "x@y.z " * 700, "1" * 5000, "a" * 3000 + "@",
    "a-b_c%d@e-f.g-h", "..@..", "+12 (", "+1" + "2" * 40, "12345678901234567890123",
]


def random_texts(seed, n):
    rng = random.Random(seed)
    bits = ["a", "@", ".", "-", " ", "1", "4", "25", "+", "(", ")", "é", "b.c", "x@y", "4111111111111111", "\x01", "\n", "_", "%"]
    return ["".join(rng.choice(bits) for _ in range(rng.randrange(40))) for _ in range(n)]


def test_base_spans_equal_the_patterns(spark):
    texts = HARD + random_texts(1, 4000)
    rows = pii.find(clashing(documents(spark, list(enumerate(texts)))), None).select("doc_id", "base", "text").collect()
    assert len(rows) == len(texts)
    for r in rows:
        assert [(s["start"], s["kind"], s["end"]) for s in r["base"]] == brute(texts[r["doc_id"]]), texts[r["doc_id"]]
        assert r["text"] == (texts[r["doc_id"]] or "")


@pytest.fixture(scope="module")
def model(spark):
    return pii.train(spark.read.parquet(f"{SOME}/documents.parquet"))


def test_reliabilities_follow_planted_accuracies():
    rng = random.Random(4)
    truth = [rng.random() < 0.4 for _ in range(20000)]
    accuracy = (0.9, 0.8, 0.7, 0.95)
    counted = {}
    for t in truth:
        votes = tuple((1 if t == (rng.random() < p) else -1) for p in accuracy)
        counted[votes] = counted.get(votes, 0) + 1
    posterior, found = pii._estimate([(0, v, n) for v, n in sorted(counted.items())])
    for want, (right, against) in zip(accuracy, found):
        assert abs(right - want) < 0.05 and abs(against - want) < 0.05
    assert all(0 <= p <= 1 for p in posterior)


def test_added_spans_keep_the_base(spark, model):
    docs = spark.read.parquet(f"{SOME}/documents.parquet")
    rows = pii.find(docs, model).collect()
    added = 0
    for r in rows:
        base, found = set(r["base"]), r["found"]
        assert base <= set(found) and found == sorted(found)
        for s in set(found) - base:
            added += 1
            assert not any(b["start"] < s["end"] and s["start"] < b["end"] for b in base)
    assert added
    secret = documents(spark, [(1, 'thor password=af91c6089defd4da03 as token = "6b526d9e98196c4dff5a73e8083186bb0ce9"'), (2, "plain words only")])
    got = {r["doc_id"]: r["found"] for r in pii.find(secret, model).collect()}
    assert {pii.KINDS[s["kind"]] for s in got[1]} == {"secret"} and got[2] == []


def test_masking_replaces_every_span(spark, model):
    rows = [(i, t) for i, t in enumerate(HARD + random_texts(2, 300))]
    found = pii.find(documents(spark, rows), model)
    for r in found.selectExpr("text", "found", f"{pii.masked()} as masked").collect():
        out, at = "", 0
        for s in r["found"]:
            if s["start"] >= at:
                out += r["text"][at : s["start"]] + f"<{pii.KINDS[s['kind']]}>"
                at = s["end"]
        assert r["masked"] == out + r["text"][at:]


def test_odd_rows(spark):
    rows = [(None, "a@b.cc"), (1, None), (1, None), (2, "x" * 200_000 + " a@b.cc")]
    got = pii.find(documents(spark, rows), None).selectExpr("doc_id", pii.spelled("found") + " as s", pii.count_of("email") + " as n").collect()
    assert sorted((r["doc_id"] or 0, r["s"], r["n"]) for r in got) == [
        (0, "email:0:6", 1), (1, "", 0), (1, "", 0), (2, "email:200001:200007", 1),
    ]
    assert pii.train(documents(spark, [])) is None and pii.find(documents(spark, []), None).count() == 0


def test_only_sql_runs_on_the_executors(spark, model):
    plan = pii.find(documents(spark, [(1, "a")]), model)._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow", plan)
