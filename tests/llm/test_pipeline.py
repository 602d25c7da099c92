import random
import re

import numpy as np
import public_tokenizers as tokenizers
import pytest
import tiktoken

import corpus_pipeline
from orderloom.llm import bpe, queries

from .support import DOCS, SMALL, clashing, documents, prose
from .test_decontaminate import brute as contaminated
from .test_minhash import brute as near
from .test_pii import PATTERNS


@pytest.fixture(scope="module")
def corpus(spark):
    given = [tuple(r) for r in spark.read.parquet(f"{SMALL}/documents.parquet").limit(60).collect()]
    item = spark.read.parquet(f"{SMALL}/benchmark.parquet").first()["text"]
    rng = random.Random(8)
    odd = [
        (9001, None, None, None, None), (9002, "", "en", "s", 0), (9003, "12 ?!", "en", "s", 5), (None, given[3][1] + " and more", "en", "s", 1),
        (9004, prose(rng, 90) + " " + item, "en", "s", 1), (9005, prose(rng, 60) + " mail me at some.one@mail1.example.com or 42.144.35.254", "en", "s", 1),
        (9006, given[2][1], "en", "s", 1), (9006, given[2][1], "en", "s", 1), (9007, "the that and " * 400, "en", "s", 1),
    ]
    rng.shuffle(odd)
    return given + odd


def stages(spark, docs):
    out = [docs.collect()]
    for _, stage in corpus_pipeline.STAGES:
        frame = spark.createDataFrame(out[-1], docs.schema) if out[-1] else spark.createDataFrame([], docs.schema)
        result = stage(spark, frame, SMALL)
        out.append(result.collect())
    return out


def test_each_stage_against_brute_force(spark, corpus):
    docs = documents(spark, corpus, DOCS)
    start, known, unique, clean, masked, tokens = stages(spark, docs)
    key = lambda r: str(tuple(r))
    # Language: rows without a letter go, the others stay as they are.
    assert sorted(known, key=key) == sorted((r for r in start if re.search(r"[^\W\d_]", r["text"] or "")), key=key)
    # Near copies: of each group the row with the smallest id, a null id coming last.
    label = near([(i, r["text"]) for i, r in enumerate(known)], 5, 80)
    groups = {}
    for i, r in enumerate(known):
        groups.setdefault(label[i], []).append((r["doc_id"] is None, r["doc_id"], i))
    want = {known[min(g)[2]] for g in groups.values()}
    assert not any(r["doc_id"] is None for r in want)
    assert len(unique) == len(set(unique)) and set(unique) == want
    # Benchmark: documents with an item go.
    items = [tuple(r) for r in spark.read.parquet(f"{SMALL}/benchmark.parquet").collect()]
    leaks = {m[0] for m in contaminated([(r["doc_id"], r["text"]) for r in unique], items)}
    assert 9004 in leaks
    assert sorted(clean, key=key) == sorted((r for r in unique if r["doc_id"] not in leaks), key=key)
    # Personal data: every e-mail address and ip is gone, other texts stay.
    before = {r["doc_id"]: r for r in clean}
    for r in masked:
        assert not re.search(PATTERNS["email"], r["text"])
        old = before[r["doc_id"]]
        assert r["lang"] == old["lang"] and r["source"] == old["source"]
        if re.search(r"<(email|ip|card|phone|secret)>", r["text"]) is None:
            assert r == old
        else:
            assert r["n_chars"] == len(r["text"])
    # Tokens: the ids that another implementation gives.
    ranks = bpe.read_ranks(tokenizers.path(corpus_pipeline.RANK_FILE))
    other = tiktoken.Encoding("t", pat_str=tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    text = {r["doc_id"]: r["text"] for r in masked}
    assert len(tokens) == len(masked)
    for r in tokens:
        assert np.frombuffer(r["ids"], "<u4").tolist() == other.encode_ordinary(text[r["doc_id"]])


NAMES = (
    "_row", "row", "base", "found", "kept", "lost", "_null", "_email", "_all", "candidates", "answer", "_answer", "lettered", "label", "component_id",
    "n_shingles", "u", "v", "item", "rows", "lang_pred", "score", "c", "ids",
)


def test_stages_keep_the_values_of_clashing_columns(spark):
    rng = random.Random(2)
    rows = [(i, prose(rng, 40) + " mail me at some.one@mail1.example.com", "en" if i % 2 else None, "s", 9) for i in range(12)]
    frame = documents(spark, rows, DOCS).selectExpr("*", *[f"concat('{n}', doc_id) as {n}" for n in NAMES])
    for _, stage in corpus_pipeline.STAGES[:-1]:
        got = stage(spark, frame, SMALL)
        assert got.columns == frame.columns and got.count() == 12
        for r in got.collect():
            assert all(r[n] == f"{n}{r['doc_id']}" for n in NAMES) and (r["source"], r["lang"]) == ("s", "en" if r["doc_id"] % 2 else None)
            assert r["text"].startswith(rows[r["doc_id"]][1][:80])
    assert corpus_pipeline.as_tokens(spark, frame, SMALL).count() == 12


def test_stages_take_empty_tables(spark):
    frame = clashing(documents(spark, [], DOCS))
    for _, stage in corpus_pipeline.STAGES[:-1]:
        got = stage(spark, frame, SMALL)
        assert got.columns == frame.columns and got.count() == 0
    assert corpus_pipeline.as_tokens(spark, frame, SMALL).count() == 0


def test_run_writes_every_stage(spark):
    got = corpus_pipeline.run(spark, SMALL)
    assert got.columns[0] == "doc_id" and 0 < got.count() < 200


def test_queries_are_registered():
    numbers = {int(n[2:].split("_")[0]) for n in queries.QUERIES}
    assert numbers == set(range(1, 14)) and set(queries.ORACLES) <= set(queries.QUERIES)


def test_rows_go_by_their_own_text(spark):
    rng = random.Random(12)
    item = spark.read.parquet(f"{SMALL}/benchmark.parquet").first()["text"]
    a, b, c, d = (prose(rng, 80, 10**6) for _ in range(4))
    rows = [(5, a), (1, a + " more"), (None, a + " and more"), (5, b), (5, c), (None, d), (None, None), (7, "")]
    got = corpus_pipeline.without_near_copies(spark, documents(spark, rows), SMALL).collect()
    key = lambda r: str(tuple(r))
    assert sorted(map(tuple, got), key=key) == sorted([(1, a + " more"), (5, b), (5, c), (None, d), (None, None), (7, "")], key=key)
    rows = [(5, a), (5, b + " " + item), (None, c), (None, item + " " + d)]
    got = corpus_pipeline.without_benchmark(spark, documents(spark, rows), SMALL).collect()
    assert sorted(map(tuple, got), key=key) == sorted([(5, a), (None, c)], key=key)
