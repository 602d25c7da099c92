import itertools
import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from orderloom.llm import langid
from orderloom.llm.words import Words

from .support import DOCS, SMALL, clashing, documents

SYLLABLES = {"aa": ["ka", "ta", "ra", "na", "sa"], "bb": ["lich", "ung", "ein", "sch", "ber"], "cc": ["çon", "eux", "té", "où", "ail"]}


def text(rng, lang, n):
    return " ".join("".join(rng.choice(SYLLABLES[lang]) for _ in range(rng.randrange(1, 4))) for _ in range(n))


def rows(seed=1, n=120):
    rng = random.Random(seed)
    return [(i, text(rng, lang := rng.choice(list(SYLLABLES)), rng.randrange(5, 80)), lang, "s", 1) for i in range(n)]


@pytest.fixture(scope="module")
def field(spark):
    return langid.fit(documents(spark, rows(), DOCS), F.col("doc_id") >= 0)


def test_forward_backward_equals_all_paths(field):
    words = Words(pa.array(["kata lichung téoù xyz", "", "ka", "sch sch ra ra ra"]))
    got = langid.posteriors(field, words)
    features, starts = langid.word_features(words.names)
    emission = np.stack([field.weights[features[a:b]].sum(axis=0) for a, b in zip(starts[:-1], starts[1:])]).astype(float)
    k = len(field.languages)
    for a, b in zip(words.starts[:-1], words.starts[1:]):
        total, marginal = 0.0, np.zeros((b - a, k))
        for path in itertools.product(range(k), repeat=b - a):
            score = sum(emission[words.ids[a + i], p] for i, p in enumerate(path))
            weight = np.exp(score + sum(field.transitions[p, q] for p, q in zip(path, path[1:])))
            total += weight
            for i, p in enumerate(path):
                marginal[i, p] += weight
        assert np.allclose(got[a:b], marginal / total, atol=1e-4)


def test_words_of_code_switched_text(field):
    rng = random.Random(7)
    words = Words(pa.array([text(rng, "aa", 30) + " " + text(rng, "bb", 30)]))
    label = langid.posteriors(field, words).argmax(axis=1)
    want = np.repeat([field.languages.index("aa"), field.languages.index("bb")], 30)
    assert (label == want).mean() > 0.95
    assert field.transitions.diagonal().min() > (field.transitions - 9 * np.eye(3)).max()


def test_features_are_those_of_each_word_alone(field):
    names = ["ka", "é", "ka", "w" * 5000, "a"]
    features, starts = langid.word_features(pa.array(names))
    for i, name in enumerate(names):
        alone, _ = langid.word_features(pa.array([name]))
        assert sorted(features[starts[i] : starts[i + 1]]) == sorted(alone)


def test_undecided_texts_and_odd_rows(spark, field):
    odd = [(1, None), (2, ""), (3, " 12 ?! "), (4, "kata rasa"), (4, "kata rasa"), (None, "lichung ein"), (5, "ka " * 20000)]
    got = langid.identify(clashing(documents(spark, odd)), field).collect()
    assert len(got) == len(odd)
    by_id = {r["doc_id"]: r for r in got}
    assert [(by_id[i]["lang_pred"], by_id[i]["score"]) for i in (1, 2, 3)] == [("und", 0.0)] * 3
    assert (by_id[4]["lang_pred"], by_id[5]["lang_pred"], by_id[None]["lang_pred"]) == ("aa", "aa", "bb")
    assert all(0 <= r["score"] <= 1 for r in got)
    assert langid.identify(documents(spark, []), field).count() == 0


def test_kept_columns_come_through(spark, field):
    docs = clashing(documents(spark, rows(3, 20), DOCS))
    got = langid.identify(docs, field, keep=tuple(docs.columns))
    assert got.columns == [*docs.columns, "answer"]
    key = lambda r: r["doc_id"]
    assert [tuple(r)[:-1] for r in sorted(got.collect(), key=key)] == [tuple(r) for r in sorted(docs.collect(), key=key)]


def test_nothing_labelled(spark):
    docs = documents(spark, [(1, "a", None, "s", 1), (2, None, "x", "s", 1)], DOCS)
    assert langid.fit(docs, F.lit(True)) is None
    assert [r["lang_pred"] for r in langid.identify(docs, None).collect()] == ["und", "und"]


def test_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    share = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4
    got = langid.identify(docs, langid.fit(docs, share != 2)).join(docs.select("doc_id", "lang"), "doc_id")
    held = got.filter(share == 2).select(F.avg((F.col("lang") == F.col("lang_pred")).cast("int")).alias("a")).first()["a"]
    assert held >= 0.95
