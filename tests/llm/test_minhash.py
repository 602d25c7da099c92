import random

import numpy as np
import pytest

from orderloom.llm import minhash
from orderloom.llm.graph import components

from .support import clashing, documents, prose, words


def brute(rows, size, percent):
    """Component and set size by comparing all pairs."""
    sets = {}
    for doc, text in rows:
        w = words(text)
        sets.setdefault(doc, []).append({tuple(w[i : i + size]) for i in range(max(1, len(w) - size + 1))} if w else set())
    label = {d: d for d in sets}

    def root(x):
        while label[x] != x:
            x = label[x]
        return x

    for a in sets:
        for b in sets:
            if a < b and any(s and t and 100 * len(s & t) >= percent * len(s | t) for s in sets[a] for t in sets[b]):
                x, y = sorted((root(a), root(b)))
                label[y] = x
    return {d: root(d) for d in sets}


def near_rows(seed, families, copies, length, edits):
    rng, rows = random.Random(seed), []
    for _ in range(families):
        base = prose(rng, length).split()
        for _ in range(copies):
            w = list(base)
            for _ in range(rng.randrange(edits + 1)):
                w[rng.randrange(len(w))] = f"e{rng.randrange(9999)}"
            rows.append((len(rows) * 3 + 1, " ".join(w)))
    return rows


@pytest.mark.parametrize("seed", [1, 2])
def test_components_equal_brute_force(spark, seed):
    rows = near_rows(seed, 12, 8, 60, 4)
    rows += [(1000, None), (1001, ""), (1002, " \n"), (1003, "one two"), (1004, "One  two"), (1005, "one two three"), (1006, "two")]
    rows += [(1007, rows[0][1]), (1008, rows[0][1]), rows[5], (1009, "long " * 30000 + "tail"), (1010, "long " * 30000 + "tail")]
    got = minhash.near_duplicates(clashing(documents(spark, rows)), 3, 85, 30, 6).collect()
    want = brute(rows, 3, 85)
    assert len(got) == len(rows)
    for r in got:
        assert (r["component_id"], r["kept"]) == (want[r["doc_id"]], want[r["doc_id"]] == r["doc_id"])
    sizes = {r["doc_id"]: r["n_shingles"] for r in got}
    assert [sizes[d] for d in (1000, 1001, 1002, 1003, 1006)] == [0, 0, 0, 1, 1]


def test_links_that_the_smallest_member_does_not_show(spark, monkeypatch):
    """Copies of a base differ from each other by more than the threshold allows, and the base is not the smallest."""
    monkeypatch.setattr(minhash, "BLOCK", 8)
    rng = random.Random(5)
    base = prose(rng, 200, 5000).split()
    rows = []
    for i in range(40):
        w = list(base)
        for _ in range(4):
            w[rng.randrange(len(w))] = f"e{rng.randrange(9999)}"
        rows.append((i, " ".join(w)))
    rows.append((40, " ".join(base)))
    got = {r["doc_id"]: r["component_id"] for r in minhash.near_duplicates(documents(spark, rows), 3, 85, 30, 6).collect()}
    assert got == brute(rows, 3, 85)


def test_null_ids_repeated_ids_and_empty_tables(spark):
    rows = [(None, "a b c d"), (None, "a b c d"), (5, "a b c d"), (5, "x y z"), (7, "x y z"), (6, "a b c d")]
    got = minhash.near_duplicates(documents(spark, rows), 3, 85, 30, 6).collect()
    assert sorted(((r["doc_id"] or -1), r["component_id"] or -1, r["kept"]) for r in got) == [
        (-1, -1, True), (-1, -1, True), (5, 5, True), (5, 5, True), (6, 5, False), (7, 5, False),
    ]
    assert minhash.near_duplicates(documents(spark, []), 3, 85, 30, 6).count() == 0


def test_block_links_equal_all_pairs():
    rng = np.random.default_rng(2)
    sets = [np.unique(rng.integers(0, 60, rng.integers(1, 50)).astype(np.uint64)) for _ in range(40)]
    for n_left in (40, 15):
        got = set(minhash.block_links(sets, n_left, 60))
        pairs = [(i, j) for i in range(n_left) for j in (range(n_left, 40) if n_left < 40 else range(i + 1, 40))]
        assert got == {(i, j) for i, j in pairs if minhash.similar(sets[i], sets[j], 60)}


def test_packed_lanes_estimate_the_similarity(spark):
    rng = random.Random(3)
    base = prose(rng, 2000, 100000).split()
    other = base[:1000] + prose(rng, 1000, 100000).split()
    sigs = minhash.signatures(documents(spark, [(1, " ".join(base)), (2, " ".join(other))]), 3, 30, 6)
    pair = sigs.filter("doc_id = 1").selectExpr("sig as a").crossJoin(sigs.filter("doc_id = 2").selectExpr("sig as b"))
    assert abs(pair.select(minhash.estimated_similarity("a", "b", 180).alias("s")).first()["s"] - 1 / 3) < 0.15


def test_components_of_a_long_chain(spark):
    edges = spark.range(200).selectExpr("id as u", "id + 1 as v").union(spark.range(300, 305).selectExpr("id as u", "null as v"))
    got = {r["node"]: r["label"] for r in components(edges).collect()}
    assert got == {i: 0 for i in range(201)}
