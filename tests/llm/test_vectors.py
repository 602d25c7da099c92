import numpy as np
import pytest

from orderloom.llm import vectors

from .support import SMALL

SCHEMA = "vec_id long, embedding array<float>, label int, q string, c int, v double, list string"
IS_QUERY = "vec_id % 20 = 0"


def frame(spark, rows):
    return spark.createDataFrame([(i, None if v is None else [None if x is None else float(x) for x in v], 0, "q", 1, 2.0, "l") for i, v in rows], SCHEMA)


def brute(rows, k):
    good = [(i, np.float32(v).astype(float)) for i, v in rows if i is not None and v is not None and None not in v and len(v)]
    good = [(i, v) for i, v in good if np.isfinite(v).all() and v.any()]
    out = {}
    for i, v in good:
        if i % 20 == 0:
            others = sorted({(-(v * w).sum(), j) for j, w in good if j != i})
            out[i] = [(j, -s) for s, j in others[:k]]
    return out


def answers(df):
    out = {}
    for r in sorted(df.collect(), key=lambda r: (r["query_id"], r["rank"])):
        out.setdefault(r["query_id"], []).append((r["vec_id"], r["score"]))
        assert r["rank"] == len(out[r["query_id"]])
    return out


def recall(got, want):
    return sum(len({j for j, _ in got.get(i, [])} & {j for j, _ in near}) for i, near in want.items()) / sum(map(len, want.values()))


def test_recall_on_the_given_vectors(spark):
    table = spark.read.parquet(f"{SMALL}/embeddings.parquet")
    rows = [(r["vec_id"], list(r["embedding"])) for r in table.collect()]
    got, want = answers(vectors.search(table, IS_QUERY)), brute(rows, 20)
    assert set(got) == set(want) and all(len(got[i]) == len(want[i]) for i in want)
    assert recall(got, want) >= 0.9


@pytest.mark.parametrize("scaled", [False, True])
def test_recall_on_clusters_of_any_length(spark, scaled):
    rng = np.random.default_rng(3)
    centers = rng.normal(size=(30, 16))
    x = centers[rng.integers(0, 30, 3000)] + 0.4 * rng.normal(size=(3000, 16))
    if scaled:
        x *= rng.uniform(0.2, 3, (3000, 1))
    rows = list(enumerate(x.astype(np.float32).tolist()))
    got, want = answers(vectors.search(frame(spark, rows), IS_QUERY)), brute(rows, 20)
    assert recall(got, want) >= 0.9
    for i, near in got.items():
        exact = {j: float((np.float32(rows[i][1]).astype(float) * np.float32(rows[j][1]).astype(float)).sum()) for j, _ in near}
        assert all(s == pytest.approx(exact[j], rel=1e-14) for j, s in near)


def test_a_third_of_all_rows_is_one_vector(spark, monkeypatch):
    monkeypatch.setattr(vectors, "PIECE", 64)
    monkeypatch.setattr(vectors, "QUERY_PIECE", 8)
    rng = np.random.default_rng(4)
    rows = [(i, [1.0, 0.5, 0, 0] if i % 3 == 0 else rng.normal(size=4).astype(np.float32).tolist()) for i in range(900)]
    got, want = answers(vectors.search(frame(spark, rows), IS_QUERY)), brute(rows, 20)
    assert recall(got, want) >= 0.9
    # All copies tie, so those with the smallest ids are the ones found, without the query itself.
    for i, near in got.items():
        copies = [j for j, _ in near if j % 3 == 0]
        assert copies == [j for j in range(0, 900, 3) if j != i][: len(copies)]


def test_vectors_that_take_no_part(spark):
    rows = [(0, [1, 0]), (20, [0, 1]), (1, [1, 1]), (1, [1, 1]), (2, None), (3, [0, 0]), (4, [1, None]), (5, [float("nan"), 1]),
            (6, [float("inf"), 1]), (40, None), (60, [0, 0]), (None, [1, 1]), (7, [1, 2, 3]), (8, []), (9, [-1, 0.5])]
    got = answers(vectors.search(frame(spark, rows), IS_QUERY))
    assert got == {0: [(1, 1.0), (20, 0.0), (9, -1.0)], 20: [(1, 1.0), (9, 0.5), (0, 0.0)]}
    assert vectors.search(frame(spark, []), IS_QUERY).count() == 0
    assert vectors.search(frame(spark, [(1, None), (20, [0, 0])]), IS_QUERY).count() == 0
    assert answers(vectors.search(frame(spark, [(20, [1, 0])]), IS_QUERY)) == {}


def test_the_walk_finds_the_nearest_centroids():
    rng = np.random.default_rng(5)
    sample = rng.normal(size=(4000, 8))
    index = vectors.fit(sample, float(np.linalg.norm(sample, axis=1).max()), 60_000, 20)
    hits = 0
    for q in vectors._as_queries(rng.normal(size=(50, 8))):
        found, _ = vectors._walk(index, q, 32)
        hits += len(set(found) & set(((index.centroids - q) ** 2).sum(axis=1).argsort()[:16]))
    assert hits / 800 > 0.9


def test_the_walk_finds_a_centroid_once():
    # On a line the next centroid of the ring is a nearest one as well.
    centroids = np.arange(40.0)[:, None]
    near = np.argsort(np.abs(centroids - centroids.T), axis=1, kind="stable")[:, 1:5]
    graph = np.concatenate([near, np.roll(np.arange(40), -1)[:, None]], axis=1)
    index = vectors.Index(1.0, centroids, graph, np.array([0]), 1.0)
    found, _ = vectors._walk(index, np.array([30.2]), 12)
    assert len(found) == len(set(found.tolist())) == 12


def test_every_query_gets_all_its_answers(spark, monkeypatch):
    monkeypatch.setattr(vectors, "LIST_SIZE", 4)
    rng = np.random.default_rng(6)
    # Small groups far apart: the nearest lists hold fewer than 20 vectors.
    rows = [(i, (50 * np.eye(16)[i % 16] + rng.normal(size=16)).astype(np.float32).tolist()) for i in range(100)]
    got = answers(vectors.search(frame(spark, rows), IS_QUERY))
    assert {i: len(near) for i, near in got.items()} == {i: 20 for i in range(0, 100, 20)}


def test_lists_are_planned_from_different_vectors(spark, monkeypatch):
    monkeypatch.setattr(vectors, "LIST_SIZE", 16)
    asked = []
    fit = vectors.fit
    monkeypatch.setattr(vectors, "fit", lambda sample, scale, n, k: asked.append(n) or fit(sample, scale, n, k))
    rng = np.random.default_rng(7)
    kinds = rng.normal(size=(40, 8)).astype(np.float32).tolist()
    rows = [(i, kinds[i % 40]) for i in range(2000)]
    got = answers(vectors.search(frame(spark, rows), IS_QUERY))
    assert asked == [40] and all(len(near) == 20 for near in got.values())


def test_answers_of_many_lists_are_merged_once_each_and_not_compared_in_pairs(spark, monkeypatch, capsys):
    monkeypatch.setattr(vectors, "LIST_SIZE", 8)
    monkeypatch.setattr(vectors, "BOUNDARY", 4.0)
    rng = np.random.default_rng(8)
    rows = [(i, rng.normal(size=4).astype(np.float32).tolist()) for i in range(400)]
    found = vectors.search(frame(spark, rows), IS_QUERY)
    got, want = answers(found), brute(rows, 20)
    assert all(len({j for j, _ in near}) == 20 for near in got.values()) and recall(got, want) >= 0.9
    # Spark's array_distinct compares structs in pairs.
    found.explain(True)
    assert "array_distinct" not in capsys.readouterr().out


def test_rows_handed_on_do_not_grow_with_the_lists(monkeypatch):
    rng = np.random.default_rng(3)
    points = rng.normal(size=(600, 8))
    index = vectors.fit(points, float(np.linalg.norm(points, axis=1).max()), 600 * 512, 20)
    held = np.ones(len(index.centroids), np.int64)
    pairs = lambda h: [*vectors._pairs(index, points, h, 21)]
    whole = {"lists": pairs(None), "queries": pairs(held)}
    assert max(len(at) for at, _, _ in whole["queries"]) > 100
    monkeypatch.setattr(vectors, "ROWS_OUT", 100)
    monkeypatch.setattr(vectors, "AT_A_TIME", 1000)
    for name, h in (("lists", None), ("queries", held)):
        cut = pairs(h)
        # A single query's lists stay together.
        assert all(len(at) <= max(100, len(index.centroids)) for at, _, _ in cut) and len(cut) > len(whole[name])
        for column in range(3):
            assert np.array_equal(np.concatenate([c[column] for c in cut]), np.concatenate([c[column] for c in whole[name]]))


def test_answers_put_together_in_parts_are_the_same(spark, monkeypatch):
    rng = np.random.default_rng(4)
    rows = [(i, rng.normal(size=6)) for i in range(700)]
    monkeypatch.setattr(vectors, "LIST_SIZE", 16)
    table = frame(spark, rows).select("vec_id", "embedding")
    whole = answers(vectors.search(table, IS_QUERY, k=5))
    monkeypatch.setattr(vectors, "TOGETHER", 2)
    assert answers(vectors.search(table, IS_QUERY, k=5)) == whole and len(whole) == 35
