import random
from collections import Counter

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from orderloom.llm import packing

from .support import SMALL, clashing, documents, prose

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(PATH)


def fill(pieces, size):
    """Checks that pieces ``(sequence, offset, tokens)`` lie gapless in their sequences; how full each is."""
    sequences = {}
    for sequence, offset, n in pieces:
        sequences.setdefault(sequence, []).append((offset, n))
    full = {}
    for sequence, parts in sequences.items():
        at = 0
        for offset, n in sorted(parts):
            assert offset == at
            at += n
        assert at <= size
        full[sequence] = at
    return full


def check_padding(full, size):
    short = [n for n in full.values() if n != size]
    assert all(n & (n - 1) == 0 for n in short) and len(short) == len(set(short))


@settings(max_examples=60, deadline=None)
@given(st.sampled_from([1, 2, 8, 13, 64, 2048]), st.lists(st.tuples(st.integers(1, 2047), st.integers(1, 90)), max_size=60))
def test_plan_holds_every_rest_once(size, counts):
    histogram = Counter()
    for length, n in counts:
        if length % size:
            histogram[length % size] += n
    plan = packing.Plan(histogram, size)
    pieces = []
    for length, n in histogram.items():
        for rank in range(n):
            parts = plan.pieces(length, rank)
            assert sum(p[0] for p in parts) == length
            pieces += [(sequence, offset, tokens) for tokens, sequence, offset in parts]
    full = fill(pieces, size)
    assert sorted(full) == list(range(plan.sequences))
    check_padding(full, size)


def test_patterns_take_long_lengths_first_and_the_most_room():
    assert packing.patterns_of({7: 1, 5: 2, 3: 1, 2: 2}, 10) == [(1, (5, 5)), (1, (7, 3)), (1, (2, 2))]
    assert packing.patterns_of({}, 10) == []
    # A count of any size takes no more steps than patterns.
    assert packing.patterns_of({4: 10**12, 2: 10**12 // 2}, 10)[0] == (10**12 // 2, (4, 4, 2))


def test_ids_as_the_library_gives_them(tokenizer):
    rng = random.Random(1)
    chars = "aB é́ 　\n\t\x0b\x1c.!'sS<|>0Σ日🙂ͅİHṮ"
    texts = ["".join(rng.choice(chars) for _ in range(rng.randrange(50))) for _ in range(1500)]
    texts += [prose(rng, 50).title() + ", A.", "H̱ ẖ H.", "It's. It'S! end.", "X", ".", "a.", "<|STARTOFTEXT|> A."]
    texts += [prose(rng, 300), "a <|endoftext|> b<|startoftext|>c", None, "", "x" * 9000, "y" * 100]
    coder = packing.Chunks(PATH)
    for _ in range(2):
        got = packing.ids_of(pa.RecordBatch.from_pydict({"text": pa.array(texts)}), coder)
        assert [g.tolist() for g in got] == [tokenizer.encode(t or "", add_special_tokens=False).ids for t in texts]


def test_long_texts_in_sections_and_small_memory(tokenizer, monkeypatch):
    monkeypatch.setattr(packing, "SECTION_BYTES", 100)
    monkeypatch.setattr(packing, "REMEMBERED", 20)
    rng = random.Random(2)
    texts = [prose(rng, 2000) + "é" * 400, "", prose(rng, 5), "日" * 90]
    got = packing.ids_of(pa.RecordBatch.from_pydict({"text": pa.array(texts)}), packing.Chunks(PATH))
    assert [g.tolist() for g in got] == [tokenizer.encode(t, add_special_tokens=False).ids for t in texts]


def rebuilt(pieces):
    """The ids of all documents, as a multiset by id, from their pieces in order of rows with one id."""
    docs = {}
    for r in pieces:
        assert r["length"] * 4 == len(r["ids"]) > 0
        docs.setdefault((r["doc_id"], r["doc_tokens"]), []).append((r["start"], r["ids"]))
    return docs


def test_all_documents(spark, tokenizer):
    rng = random.Random(3)
    rows = [tuple(r) for r in spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect()]
    rows += [(10_000 + i, prose(rng, rng.randrange(900))) for i in range(60)] + [(20_000, prose(rng, 20_000)), (20_001, None), (20_002, "")]
    pieces = packing.pack_documents(clashing(documents(spark, rows)).repartition(5), PATH).collect()
    found = rebuilt(pieces)
    assert {d for d, _ in found} == {d for d, _ in rows}
    for doc_id, text in rows:
        want = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 1]
        parts = sorted(found[doc_id, len(want)])
        assert [s for s, _ in parts] == [0, *np.cumsum([len(i) // 4 for _, i in parts])[:-1].tolist()]
        assert np.frombuffer(b"".join(i for _, i in parts), "<u4").tolist() == want
    check_padding(fill([(r["sequence_id"], r["offset"], r["length"]) for r in pieces], 2048), 2048)


def test_repeated_rows_and_empty_tables(spark):
    rows = [(1, "a b c")] * 700 + [(None, "d e")] * 300 + [(2, None)] * 5
    pieces = packing.pack_documents(documents(spark, rows), PATH, size=64).collect()
    tokens = sum(r["length"] for r in pieces)
    assert tokens == sum({1: 4, None: 3, 2: 1}[i] for i, _ in rows) and {r["doc_tokens"] for r in pieces} == {4, 3, 1}
    starts = Counter((r["doc_id"], r["start"]) for r in pieces)
    assert starts[1, 0] == 700 and starts[None, 0] == 300 and starts[2, 0] == 5
    check_padding(fill([(r["sequence_id"], r["offset"], r["length"]) for r in pieces], 64), 64)
    assert packing.pack_documents(documents(spark, []), PATH).count() == 0
