import random

import public_tokenizers as tokenizers
from pyspark.sql import functions as F

from orderloom.llm import edit_counts

from .support import SMALL, clashing, documents

PATH = tokenizers.path("byte_bpe_multi_50k.tiktoken")
BITS = ["a", "b", "the", "é", "漢", "🙂", " ", "\n", "1", "12", "'s", "'re", "'l", "'", "\t", "ing", "   ", " \n ", "ß", "!", "..."]
SCHEMA = "doc_id long, text string, e array<struct<start:int,end:int,text:string>>"


def applied(text, edits):
    for start, end, new in edits:
        a = max(0, min(start or 0, len(text)))
        text = text[:a] + (new or "") + text[max(a, min(end or 0, len(text))) :]
    return text


def test_trees_equal_cutting_anew():
    tool = edit_counts.counter(PATH, tokenizers.PATTERN)
    rng = random.Random(3)
    for n in range(1200):
        text = "".join(rng.choice(BITS) for _ in range(rng.choice([0, 1, 3, 10, 60, 400, 2000 if n % 50 == 0 else 5])))
        tree = edit_counts.PieceTree(text, tool.cut, tool.count)
        for _ in range(6):
            start = rng.randint(-1, len(text) + 2)
            end = start + rng.choice([0, 0, 1, 2, 5, 50])
            new = "".join(rng.choice(BITS) for _ in range(rng.choice([0, 0, 1, 2, 5, 600 if n % 40 == 0 else 3])))
            tree.replace(start, end, new)
            text = applied(text, [(start, end, new)])
            assert [p for leaf in tree.leaves for p in leaf] == tool.cut(text)
            assert (tree.n_tokens, tree.n_chars) == (len(tool.encoding.encode_ordinary(text)), len(text))


def test_an_edit_encodes_little_of_a_long_text():
    tool = edit_counts.counter(PATH, tokenizers.PATTERN)
    tree = edit_counts.PieceTree("some words here. " * 20000, tool.cut, tool.count)
    tree.replace(150_000, 150_005, "other")
    assert tree.encoded < 20


def test_documents(spark):
    rows = [(1, "Hello the world", [(0, 5, "Bye"), (4, 4, " all"), (99, 120, "!")]), (2, None, [(0, 0, "new")]), (3, "", None), (4, "x y" * 30000, [(5, 9, None), None]),
            (4, "x y" * 30000, [(5, 9, None), None]), (None, "é", [(None, None, "z")])]
    got = edit_counts.count_edited(clashing(spark.createDataFrame(rows, SCHEMA)), F.col("e"), PATH, tokenizers.PATTERN).collect()
    tool = edit_counts.counter(PATH, tokenizers.PATTERN)
    count = lambda t: len(tool.encoding.encode_ordinary(t))
    assert len(got) == len(rows)
    for doc, text, edits in rows:
        real = [e for e in edits or [] if e]
        r = next(r for r in got if r["doc_id"] == doc)
        assert (r["n_tokens"], r["n_edits"], r["n_tokens_after"]) == (count(text or ""), len(real), count(applied(text or "", real)))
    assert edit_counts.count_edited(spark.createDataFrame([], SCHEMA), F.col("e"), PATH, tokenizers.PATTERN).count() == 0


def test_the_query_counts_as_encoding_anew_does(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    edits = edit_counts.sample_edits()
    tool = edit_counts.counter(PATH, tokenizers.PATTERN)
    given = {r["doc_id"]: r for r in docs.select("doc_id", "text", edits.alias("e")).collect()}
    for r in edit_counts.count_edited(docs, edits, PATH, tokenizers.PATTERN).collect():
        row = given[r["doc_id"]]
        assert r["n_edits"] >= 1
        assert r["n_tokens_after"] == len(tool.encoding.encode_ordinary(applied(row["text"], [tuple(e) for e in row["e"]])))


def test_the_number_of_edits_follows_the_length(spark):
    rows = documents(spark, [(1, "x" * 100_000), (2, "x" * 14_000), (3, ""), (4, None)])
    got = dict(rows.select("doc_id", F.size(edit_counts.sample_edits())).collect())
    assert got == {1: 51, 2: 8, 3: 1, 4: 1}
