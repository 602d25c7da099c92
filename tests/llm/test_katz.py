import math
import random
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from orderloom.llm import katz, queries

from .support import SMALL, clashing, documents, words


class Plain:
    """The same model with dictionaries, one token at a time."""

    def __init__(self, texts, order):
        self.order = order
        self.counts = [Counter() for _ in range(order)]
        self.contexts = [Counter() for _ in range(order)]
        for text in texts:
            seq = ["<s>"] * (order - 1) + words(text) + ["</s>"]
            for i in range(order - 1, len(seq)):
                for k in range(order):
                    self.counts[k][tuple(seq[i - k : i + 1])] += 1
                    self.contexts[k][tuple(seq[i - k : i])] += 1
        self.n = sum(self.counts[0].values())
        self.d = [katz.discounts(Counter(c.values())) for c in self.counts]
        self.followers = defaultdict(list)
        for k in range(1, order):
            for gram in self.counts[k]:
                self.followers[gram[:-1]].append(gram[-1])
        used = sum(self.mass(0, g) for g in self.counts[0])
        self.total = self.n + (self.n - used < 1e-9 * max(1, self.n))
        self.unknown = 1 - used / self.total
        self.memo = {}

    def mass(self, k, gram):
        c = self.counts[k][gram]
        return c * (self.d[k][c] if c <= katz.MOST_DISCOUNTED else 1.0)

    def weight(self, context):
        if context not in self.memo:
            k = len(context)
            c = self.contexts[k][context]
            if not c:
                return 1.0, 0
            mass = sum(self.mass(k, context + (w,)) for w in self.followers[context])
            lower = sum(self.p(w, context[1:]) for w in self.followers[context])
            raised = int(1 - mass / c < 1e-12)
            self.memo[context] = (1 - mass / (c + raised)) / (1 - lower), raised
        return self.memo[context]

    def p(self, word, context):
        k = len(context)
        if not k:
            return self.mass(0, (word,)) / self.total if (word,) in self.counts[0] else self.unknown
        weight, raised = self.weight(context)
        if context + (word,) in self.counts[k]:
            return self.mass(k, context + (word,)) / (self.contexts[k][context] + raised)
        return weight * self.p(word, context[1:])

    def score(self, text):
        seq = ["<s>"] * (self.order - 1) + words(text) + ["</s>"]
        at = range(self.order - 1, len(seq))
        return sum(math.log10(self.p(seq[i], tuple(seq[i - self.order + 1 : i]))) for i in at)


def corpus(seed=1, n=150):
    rng = random.Random(seed)
    pick = [f"w{min(int(rng.expovariate(0.08)), 90)}" for _ in range(4000)]
    rows = [(i, " ".join(rng.choice(pick) for _ in range(rng.randrange(40)))) for i in range(n)]
    return rows + [(n, None), (n + 1, ""), (n + 2, "never seen words"), (n + 3, "W1 w1\nw1 " * 400), (3, rows[3][1])]


@pytest.mark.parametrize("order", [1, 2, 3])
def test_scores_equal_the_plain_model(spark, order):
    rows = corpus()
    held = F.col("doc_id") % 5 == 1
    got = katz.fit_and_score(clashing(documents(spark, rows)), held, order).scores.collect()
    model = Plain([t for d, t in rows if d % 5 != 1], order)
    text = dict(rows)
    assert len(got) == len(rows)
    for r in got:
        tokens = words(text[r["doc_id"]]) + ["</s>"]
        assert r["held_out"] == (r["doc_id"] % 5 == 1)
        assert (r["n_tokens"], r["train_tokens"]) == (len(tokens), model.n)
        assert r["n_known"] == sum((w,) in model.counts[0] for w in tokens)
        base = sum(math.log10((model.counts[0][(w,)] + 0.5) / (model.n + 0.5 * (len(model.counts[0]) + 1))) for w in tokens)
        assert r["base_score"] == pytest.approx(base, rel=1e-9)
        assert r["score"] == pytest.approx(model.score(text[r["doc_id"]]), rel=1e-9)


def test_every_context_sums_to_one():
    model = Plain([t for _, t in corpus(2)], 2)
    for context in [("w1",), ("w30",), ("<s>",), ("no such word",)]:
        total = sum(model.p(w, context) for (w,) in model.counts[0]) + model.p("unknown word", context)
        assert total == pytest.approx(1, abs=1e-9)


def test_blocks_and_buckets_do_not_change_scores(spark, monkeypatch):
    rows = corpus(3, 60)
    held = F.col("doc_id") % 5 == 1
    whole = katz.fit_and_score(documents(spark, rows).coalesce(1), held).scores.collect()
    from orderloom.llm import blocks

    monkeypatch.setattr(blocks, "BUCKET_KEYS", 50)
    parts = katz.fit_and_score(documents(spark, rows).repartition(7), held).scores.collect()
    key = lambda r: (r["doc_id"], r["score"])
    for a, b in zip(sorted(whole, key=key), sorted(parts, key=key)):
        assert a["score"] == pytest.approx(b["score"], rel=1e-9) and a["n_known"] == b["n_known"]


def test_stored_counts_and_nothing_to_train_on(spark):
    rows = [(1, "a b a b c"), (None, "a b")]
    fitted = katz.fit_and_score(documents(spark, rows), F.col("doc_id") == 1)
    assert fitted.counts.groupBy("ord").agg(F.sum("n").alias("n")).orderBy("ord").collect() == [(1, 4), (2, 3)]
    assert sorted(r["held_out"] for r in fitted.scores.collect()) == [False, True]
    none = katz.fit_and_score(documents(spark, rows), F.lit(True)).scores.collect()
    assert [(r["train_tokens"], r["score"], r["base_score"]) for r in none] == [(0, 0.0, 0.0)] * 2
    assert katz.fit_and_score(documents(spark, []), F.lit(False)).scores.count() == 0


def test_irregular_counts_fall_back_to_an_absolute_discount():
    assert katz.discounts({1: 10, 2: 5})[1:].tolist() == pytest.approx([1 - 0.5 / r for r in range(1, 6)])
    regular = katz.discounts({1: 1000, 2: 300, 3: 140, 4: 80, 5: 50, 6: 34})
    assert all(0 < x <= 1 for x in regular[1:])


def test_the_query_scores_with_trigrams(spark):
    from zlib import crc32

    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()]
    model = Plain([t for d, t in rows if crc32(str(d).encode()) % 5 != 1], 3)
    got = {r["doc_id"]: r["score"] for r in queries.QUERIES["op1_katz_scores"](spark, SMALL).collect()}
    for d, t in rows[:40]:
        assert got[d] == pytest.approx(model.score(t), rel=1e-9)


@pytest.mark.parametrize("parts", [1, 7])
def test_backoff_weights_of_contexts_in_one_block_and_in_several(spark, parts):
    rows = corpus(4, 60)
    fitted = katz.fit_and_score(documents(spark, rows).repartition(parts), F.col("doc_id") % 5 == 1, 3)
    model = Plain([t for d, t in rows if d % 5 != 1], 3)
    for k, stored in enumerate(fitted.backoff, 1):
        contexts = {c for c in model.contexts[k] if any(model.counts[k][c + (w,)] for w in model.followers[c])}
        assert stored.agg(F.sum("n")).first()[0] == len(contexts)


@pytest.mark.parametrize("order", [3, 4])
def test_scores_of_several_blocks_equal_the_plain_model(spark, monkeypatch, order):
    from orderloom.llm import blocks

    monkeypatch.setattr(blocks, "BUCKET_KEYS", 300)
    # Frequent phrases besides, so that some contexts are never discounted and have to be raised.
    rows = corpus(5, 80) + [(200 + i, "x y z x y z q") for i in range(30)]
    got = katz.fit_and_score(documents(spark, rows).repartition(7), F.col("doc_id") % 5 == 1, order).scores.collect()
    model = Plain([t for d, t in rows if d % 5 != 1], order)
    want = sorted((d, model.score(t)) for d, t in rows)
    for r, (d, score) in zip(sorted(got, key=lambda r: (r["doc_id"], r["score"])), want, strict=True):
        assert r["doc_id"] == d and r["score"] == pytest.approx(score, rel=1e-9)


def test_ngrams_around_one_that_no_other_block_has_are_not_sent(spark, monkeypatch):
    sent = []
    stored = katz.stored

    def noted(df, name, *by):
        out = stored(df, name, *by)
        if name != "lm-blocks":
            sent.append(dict(out.filter("kind = 'answer'").groupBy("ord").agg(F.sum("n")).collect()))
            sent[-1] |= {f"weights {r['ord']}": r["n"] for r in out.filter("kind = 'weight'").groupBy("ord").agg(F.sum("n").alias("n")).collect()}
        return out

    monkeypatch.setattr(katz, "stored", noted)
    # Two blocks with words of their own but for one text.
    rows = [(i, " ".join(f"{'ab'[i % 2]}{i * 7 + j}" for j in range(9))) for i in range(20)] + [(20, "u v w"), (25, "u v w")]
    katz.fit_and_score(documents(spark, rows).repartitionByRange(2, F.col("doc_id") % 2, "doc_id"), F.lit(False), 3)
    assert sum(s.get(3, 0) for s in sent) <= 2 * 5
    # Nothing is held out, so no weight is asked for but of contexts too frequent to be discounted.
    assert sum(s.get("weights 1", 0) + s.get("weights 2", 0) for s in sent) <= 6


def test_distinct_is_unique():
    import numpy as np

    rng = np.random.default_rng(1)
    # Many keys that only differ in the bits that give way to places, too.
    for keys in (rng.integers(0, 1 << 63, 5000, np.uint64), rng.integers(0, 900, 5000).astype(np.uint64), np.zeros(0, np.uint64), np.full(3, 2**64 - 1, np.uint64)):
        for got, want in zip(katz.distinct(keys), np.unique(keys, return_index=True, return_inverse=True), strict=True):
            assert got.tolist() == want.tolist()
