import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from orderloom.llm import decontaminate

from .support import clashing, documents, prose

BENCH = "item_id long, text string"


def plain(text):
    return re.sub(r"[\W_]+", " ", (text or "").lower()).split()


def grams(w, size):
    return Counter(tuple(w[i : i + size]) for i in range(max(1, len(w) - size + 1))) if w else Counter()


def brute(docs, items, at_least=0.8):
    out = {}
    for d, (doc, text) in enumerate(docs):
        w = plain(text)
        for i, (item, passage) in enumerate(items):
            p = plain(passage)
            best = None
            for s in range(len(w) - len(p) + 1) if p else ():
                a, b = grams(w[s : s + len(p)], 5), grams(p, 5)
                score = sum((a & b).values()) / sum((a | b).values())
                if score >= at_least and (best is None or score > best[1]):
                    best = (s, score)
            if best:
                out[d, i] = (doc, item, best[0], len(p), best[1])
    return sorted(out.values(), key=str)


def table(seed):
    rng = random.Random(seed)
    items = [(i, prose(rng, n, 3000)) for i, n in enumerate((14, 20, 36, 36, 59, 6, 5, 3, 40))]
    items += [(None, items[2][1]), (20, None), (21, ""), (22, "?!"), (8, items[8][1])]
    docs = []
    for d in range(60):
        w = prose(rng, rng.randrange(0, 150), 3000).split()
        passage = rng.choice(items[:9])[1].split()
        if d % 3:
            for _ in range(rng.randrange(3)):
                passage[rng.choice([0, len(passage) - 1, rng.randrange(len(passage))])] = "changed"
            at = rng.randrange(len(w) + 1)
            w[at:at] = [p.upper() + "," if d % 2 else p for p in passage]
        docs.append((d, " ".join(w)))
    docs += [(100, None), (101, ""), (None, items[3][1]), (102, items[4][1]), (102, items[4][1]), (103, "x " * 30000 + items[0][1])]
    return docs, items


def test_windows_equal_brute_force(spark):
    docs, items = table(1)
    got = decontaminate.contaminated(clashing(documents(spark, docs)), clashing(documents(spark, items, BENCH)))
    assert sorted((tuple(r) for r in got.collect()), key=str) == brute(docs, items)


def test_blocks_of_the_benchmark_give_the_same(spark, monkeypatch):
    docs, items = table(2)
    monkeypatch.setattr(decontaminate, "ITEM_BYTES", 500)
    got = decontaminate.contaminated(documents(spark, docs), documents(spark, items, BENCH))
    assert sorted((tuple(r) for r in got.collect()), key=str) == brute(docs, items)


def test_empty_tables(spark):
    docs, items = table(3)
    assert decontaminate.contaminated(documents(spark, []), documents(spark, items, BENCH)).count() == 0
    assert decontaminate.contaminated(documents(spark, docs), documents(spark, [], BENCH)).count() == 0


def test_the_index_finds_everything_within_the_radius():
    rng = np.random.default_rng(6)
    kept = rng.integers(0, 1 << 16, (50, decontaminate.BLOCKS), dtype=np.uint16)
    asked = np.concatenate([kept, kept[:5], rng.integers(0, 1 << 16, (40, decontaminate.BLOCKS), dtype=np.uint16)])
    for flips in range(50):
        for b in rng.choice(decontaminate.BITS, flips, replace=False):
            asked[flips, b // 16] ^= np.uint16(1 << (b % 16))
    q, i = decontaminate.MultiIndex(kept).within(asked)
    near = np.bitwise_count(asked[:, None] ^ kept[None]).sum(axis=2) <= decontaminate.RADIUS
    assert set(zip(q.tolist(), i.tolist())) == set(zip(*map(np.ndarray.tolist, np.nonzero(near))))


def changed(rng, w, lost, how):
    """``w`` with about ``lost`` of its five-word shingles changed."""
    w = list(w)
    if how == "end":
        for k in range(lost):
            w[len(w) - 1 - k] = f"n{rng.randrange(10**9)}"
    elif how == "start":
        for k in range(lost):
            w[k] = f"n{rng.randrange(10**9)}"
    else:
        for _ in range(max(1, lost // 5)):
            w[rng.randrange(len(w))] = f"n{rng.randrange(10**9)}"
    return w


@pytest.mark.parametrize("n", [20, 35, 50, 100, 200, 400])
def test_recall_of_fingerprints_by_item_length(n):
    """Of windows between 0.8 and 0.9 the index alone finds nearly all, whatever was changed."""
    rng = random.Random(n)
    kept, asked = [], []
    while len(kept) < 400:
        w = prose(rng, n, 10**6).split()
        v = changed(rng, w, rng.randrange(1, n // 5 + 2), rng.choice(["end", "start", "inside"]))
        a, b = grams(w, 5), grams(v, 5)
        if 0.8 <= sum((a & b).values()) / sum((a | b).values()) <= 0.9:
            kept.append(" ".join(w))
            asked.append(" ".join(v))
    prints = []
    for texts in (kept, asked):
        words = decontaminate.plain_words(pa.array(texts))
        sums = [decontaminate.bit_sums(words.hashes[words.ids[a:b]]) for a, b in zip(words.starts, words.starts[1:])]
        prints.append(np.concatenate([decontaminate.simhashes(s, n) for s in sums]))
    q, i = decontaminate.MultiIndex(prints[0]).within(prints[1])
    assert (q == i).sum() >= 0.99 * 400


def test_a_very_long_text(spark):
    rng = random.Random(9)
    items = [(i, prose(rng, 60, 10**6)) for i in range(300)]
    w = prose(rng, 30_000, 10**6).split() + " ".join(t for _, t in items).split() * 2 + prose(rng, 30_000, 10**6).split()
    got = decontaminate.contaminated(documents(spark, [(1, " ".join(w))]), documents(spark, items, BENCH)).collect()
    assert sorted((r["item_id"], r["start_word"], r["n_words"]) for r in got) == [(i, 30_000 + 60 * i, 60) for i in range(300)]


def test_documents_shorter_than_an_item(spark):
    rng = random.Random(4)
    items = [(1, prose(rng, 50, 10**6)), (2, prose(rng, 30, 10**6)), (3, prose(rng, 6, 10**6))]
    w, v = items[0][1].split(), items[1][1].split()
    docs = [(1, " ".join(w[:25] + w[26:])), (2, " ".join(w[:-1])), (3, " ".join(w[:40])), (4, " ".join(v[3:])), (5, " ".join(w[:3])), (6, " ".join(w[:49] + v))]
    got = decontaminate.contaminated(documents(spark, docs), documents(spark, items, BENCH)).collect()
    assert {(r["doc_id"], r["item_id"]): (r["start_word"], r["n_words"], round(r["similarity"], 9)) for r in got} == {
        (1, 1): (0, 49, round(41 / 50, 9)), (2, 1): (0, 49, round(45 / 46, 9)), (4, 2): (0, 27, round(23 / 26, 9)),
        (6, 1): (0, 50, round(45 / 47, 9)), (6, 2): (49, 30, 1.0),
    }


def test_windows_just_at_the_least_similarity(spark):
    rng = random.Random(5)
    items, docs = [], []
    for i in range(600):
        n = rng.choice((50, 100))
        w = prose(rng, n, 10**6).split()
        gone = (n - 4) // 9
        items.append((i, " ".join(w)))
        docs.append((i, " ".join(prose(rng, 3, 10**6).split() + w[: n - gone] + prose(rng, gone, 10**6).split())))
    got = decontaminate.contaminated(documents(spark, docs), documents(spark, items, BENCH)).collect()
    assert sorted((tuple(r) for r in got), key=str) == brute_pairs(docs, items)


def brute_pairs(docs, items):
    """Brute force of each document and the item it was made from; others share no shingle."""
    return sorted((m for d, i in zip(docs, items) for m in brute([d], [i])), key=str)
