import math
import random
import re
import zlib
from hashlib import sha256

import numpy as np
import pyarrow as pa

from orderloom.llm import resample

from .support import clashing, documents, prose


def words(text):
    lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", lowered)


def features(text):
    w = words(text)
    return [zlib.crc32(" ".join(w[i : i + k]).encode()) % 10000 for k in (1, 2, 3) for i in range(len(w) - k + 1)]


def brute(docs, target):
    s, t = [0] * 10000, [0] * 10000
    for counts, texts in ((s, [d[1] for d in docs]), (t, target)):
        for text in texts:
            for b in features(text):
                counts[b] += 1
    have, want = sum(s) + 10000, sum(t) + 10000
    gains = [math.floor(1000 * math.log((b + 1) * have / ((a + 1) * want))) for a, b in zip(s, t)]
    rows = []
    for i, text in docs:
        f = features(text)
        h = int(sha256(f"42:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        weight = sum(gains[b] for b in f)
        rows.append((i, len(words(text)), len(f), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 2**32)))))
    able = sorted((r for r in rows if r[1] >= 20), key=lambda r: (-r[4], r[0] is None, r[0] or 0, r[2]))
    return rows, able[: len(able) * 5 // 100]


def key(row):
    return str(tuple(row))


def odd_texts(rng, n):
    parts = ["a", "B", "é", "7", " ", ".", "\n", "日", "x" * 70, "y" * 300, "_", "[", "`", "{"]
    return ["".join(rng.choice(parts) for _ in range(rng.randrange(60))) for _ in range(n)]


def test_buckets_of_odd_texts():
    rng = random.Random(3)
    texts = [*odd_texts(rng, 300), "", "z" * 5000 + " q " + "w" * 70000 + " r"]
    got = resample.Features(pa.array(texts), np.zeros(len(texts), np.int64))
    for i, text in enumerate(texts):
        assert sorted(got.buckets[got.starts[i] : got.starts[i + 1]].tolist()) == sorted(features(text))
        assert got.n_words[i] == len(words(text))


def test_long_texts_in_sections(monkeypatch):
    monkeypatch.setattr(resample, "SECTION_BYTES", 200)
    rng = random.Random(4)
    long = " ".join(rng.choice(["Ab", "é", "c7", "d" * 40, "e" * 500]) for _ in range(2000))
    texts = [long, "x y", "", None, long + "!", "f" * 1000]
    found, n_words = [[] for _ in texts], [0] * len(texts)
    for rows, part in resample.feature_parts(pa.RecordBatch.from_pydict({"text": pa.array(texts)})):
        for j, r in enumerate(rows):
            found[r] += part.buckets[part.starts[j] : part.starts[j + 1]].tolist()
            n_words[r] += part.n_words[j]
    assert [sorted(f) for f in found] == [sorted(features(t)) for t in texts] and n_words == [len(words(t)) for t in texts]


def test_against_brute_force(spark):
    rng = random.Random(5)
    docs = [(i, prose(rng, rng.randrange(60), 90)) for i in range(400)]
    docs += [(None, prose(rng, 30, 90)), (None, None), (7, docs[7][1]), (7, docs[7][1]), (9, docs[9][1] + " w1"), (-4, ""), (2**60, docs[3][1])]
    docs += [(1000 + i, t) for i, t in enumerate(odd_texts(rng, 40))]
    target = [prose(rng, 40, 30) for _ in range(20)] + [None, "", "W1 w2"]
    frame = spark.createDataFrame([(t, "clash") for t in target], "text string, doc_id string")
    got = [tuple(r) for r in resample.resample(clashing(documents(spark, docs)), frame).collect()]
    rows, drawn = brute(docs, target)
    assert sorted((r[:5] for r in got), key=key) == sorted(rows, key=key)
    ranks = sorted((r for r in got if r[5] is not None), key=lambda r: r[5])
    assert [r[5] for r in ranks] == list(range(1, len(drawn) + 1)) and [r[:5] for r in ranks] == drawn


def test_ties_and_equal_rows(spark):
    # One text under few ids: scores tie, and the last place lies inside a group of equal rows.
    text = " ".join(f"w{i}" for i in range(25))
    docs = [(i % 3, text) for i in range(400)]
    got = resample.resample(documents(spark, docs), documents(spark, [(1, "w1 w2")])).collect()
    assert sorted(r["rank"] for r in got if r["rank"] is not None) == list(range(1, 21))
    assert {r["doc_id"] for r in got if r["rank"] is not None} == {brute(docs, ["w1 w2"])[1][0][0]}


def test_empty_tables_and_nothing_to_draw(spark):
    empty = documents(spark, [])
    assert resample.resample(empty, empty).count() == 0
    got = resample.resample(documents(spark, [(1, "a b c"), (2, None)]), empty).collect()
    assert [r["rank"] for r in got] == [None, None] and {r["doc_id"]: r["n_features"] for r in got} == {1: 6, 2: 0}


def test_selection_finds_every_key(spark):
    rng = random.Random(6)
    scores = [rng.randrange(40) for _ in range(300)]
    rows = spark.createDataFrame([(s, i % 50 or None, i) for i, s in enumerate(scores)], "score long, doc_id long, row long")
    rows = rows.selectExpr("*", "0L as n_features").selectExpr("*", *[f"{e} as {c}" for c, e in resample.KEY.items() if c != e]).cache()
    order = sorted((-s, i % 50 == 0, i % 50, 0, i) for i, s in enumerate(scores))
    for k in (1, 2, 150, 299, 300):
        assert resample.select_key(rows, k) == order[k - 1]
    assert resample.select_key(rows, 301) is None and resample.select_key(rows, 0) is None
