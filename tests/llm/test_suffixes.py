import random

import numpy as np
import pytest

from orderloom.llm import suffixes

from .support import clashing, documents, prose, words


def brute(rows, least):
    """Stretches covered by windows of ``least`` words that another document has."""
    holders = {}
    docs = {(d, t): words(t) for d, t in rows}
    for key, w in docs.items():
        for i in range(len(w) - least + 1):
            holders.setdefault(tuple(w[i : i + least]), set()).add(key)
    out = {}
    for key, w in docs.items():
        covered = np.zeros(len(w) + 2, int)
        for i in range(len(w) - least + 1):
            if len(holders[tuple(w[i : i + least])]) > 1:
                covered[i + 1 : i + least + 1] = 1
        edges = np.flatnonzero(np.diff(covered))
        if len(edges):
            out[key] = ",".join(f"{a}:{b}" for a, b in zip(edges[::2], edges[1::2]))
    return out


def rows_with_passages(seed):
    rng = random.Random(seed)
    passages = [prose(rng, n, 100000) for n in (50, 51, 64, 90, 200, 49)]
    rows = []
    for i in range(80):
        parts = [prose(rng, rng.randrange(1, 120), 100000)]
        for p in rng.sample(passages, rng.randrange(3)):
            parts += [p, prose(rng, rng.randrange(0, 40), 100000)]
        rows.append((i, " ".join(parts)))
    whole = prose(rng, 120, 100000)
    rows += [(200, whole), (201, whole.upper().replace("W", "w")), (202, whole), (202, whole), (203, None), (204, ""), (205, "x")]
    rows += [(206, prose(rng, 60, 100000)), (None, whole), (207, "w " * 3000), (208, "w " * 2000 + "end")]
    return rows


@pytest.mark.parametrize("hot", [50_000, 3])
def test_spans_equal_brute_force(spark, hot, monkeypatch):
    monkeypatch.setattr(suffixes, "HOT", hot)
    rows = rows_with_passages(hot)
    got = suffixes.repeated_passages(clashing(documents(spark, rows).repartition(5))).collect()
    want = brute(rows, 50)
    assert sorted(((r["doc_id"] or -1), r["spans"]) for r in got) == sorted(((d or -1), s) for (d, _), s in want.items())
    for r in got:
        assert r["n_repeated"] == sum(int(b) - int(a) for a, b in (s.split(":") for s in r["spans"].split(",")))


def test_every_window_holds_an_anchor_chosen_by_content():
    rng = np.random.default_rng(4)
    seq = rng.integers(0, 1 << 63, 900, dtype=np.uint64)
    starts = np.array([0, 300, 340, 900])
    at, keys = suffixes.anchors(seq, starts, 50)
    for a, b in zip(starts[:-1], starts[1:]):
        for s in range(a, b - 49):
            assert ((at >= s) & (at + suffixes.GRAM <= s + 50)).any()
        assert not ((at < b) & (at + suffixes.GRAM > b)).any()
    again, same = suffixes.anchors(seq[100:250], np.array([0, 150]), 50)
    assert set(again[(again > 34) & (again < 100)] + 100) <= set(at)


def test_no_repeats_and_empty_tables(spark):
    rng = random.Random(9)
    assert suffixes.repeated_passages(documents(spark, [(i, prose(rng, 80, 10**6)) for i in range(5)])).count() == 0
    assert suffixes.repeated_passages(documents(spark, [])).count() == 0


def test_a_partner_that_is_nearest_in_neither_order(spark):
    rng = random.Random(11)
    rows = []
    for group in range(12):
        new = lambda n: prose(rng, n, 10**8)
        before, anchor, after, left, right = new(20), new(16), new(20), new(5), new(5)
        rows += [f"{new(40)} {left} {before} {anchor} {after} {right} {new(40)}", f"{new(60)} {before} {anchor} {after} {new(60)}"]
        # Nearer to the first one in one order each, with 41 words in common.
        rows += [f"{new(60)} {anchor} {after} {right} {new(60)}" for _ in range(8)]
        rows += [f"{new(60)} {left} {before} {anchor} {new(60)}" for _ in range(8)]
    rows = list(enumerate(rows))
    rows += [(None, rows[0][1]), (0, rows[0][1])]
    got = suffixes.repeated_passages(documents(spark, rows).repartition(5)).collect()
    want = brute(rows, 50)
    assert len(want) >= 24
    assert sorted(((r["doc_id"] if r["doc_id"] is not None else -1), r["spans"]) for r in got) == sorted(((-1 if d is None else d), s) for (d, _), s in want.items())
