import hashlib
import random

import numpy as np
import public_tokenizers as tokenizers
import pyarrow as pa
import pytest
import tiktoken

from orderloom.llm import bpe

from .support import clashing, documents

PATH = tokenizers.path("byte_bpe_multi_50k.tiktoken")
BITS = ["a", "b", "the", "é", "漢", "🙂", " ", "\n", "1", "12", "'s", "'", "\t", "ing", "  ", "ß", "Ω", "ation", "xq"]


@pytest.fixture(scope="module")
def coder():
    return bpe.Encoder(PATH, tokenizers.PATTERN)


@pytest.fixture(scope="module")
def reference(coder):
    return tiktoken.Encoding("t", pat_str=tokenizers.PATTERN, mergeable_ranks=coder.vocabulary.ranks, special_tokens={})


def some_texts(seed, n):
    rng = random.Random(seed)
    texts = ["".join(rng.choice(BITS) for _ in range(rng.randrange(50))) for _ in range(n)]
    texts += ["".join(chr(rng.choice([rng.randint(1, 0x2FF), rng.randint(0x4E00, 0x4FFF), 0x1F642])) for _ in range(30)) for _ in range(n // 4)]
    return texts + ["", "a" * 3000, "ab" * 2000, "<|endoftext|>", "é" * 700, " " * 900, "9" * 999]


def test_ids_and_round_trip(coder, reference):
    for text in some_texts(1, 800):
        packed = coder.encode(text)
        assert np.frombuffer(packed, "<u4").tolist() == reference.encode_ordinary(text)
        assert coder.decode(packed) == text.encode()


def test_appends_and_edits_equal_encoding_anew(coder):
    rng = random.Random(2)
    for _ in range(300):
        data = "".join(rng.choice(BITS) for _ in range(rng.randrange(20))).encode()
        table = bpe.Prefixes(coder.vocabulary, data)
        more = rng.choice(BITS).encode()
        table.append(more)
        data += more
        a = rng.randrange(len(data) + 1)
        b = rng.randrange(a, len(data) + 1)
        new = rng.choice(BITS).encode()
        table.replace(a, b, new)
        data = data[:a] + new + data[b:]
        assert table.tokens() == bpe.Prefixes(coder.vocabulary, data).tokens() == coder.vocabulary.merged(data)


def test_forgetting_changes_nothing(reference):
    small = bpe.Encoder(PATH, tokenizers.PATTERN, remembered=3)
    for text in some_texts(3, 60):
        assert np.frombuffer(small.encode(text), "<u4").tolist() == reference.encode_ordinary(text)


def test_documents(spark, reference):
    rows = [(1, "Hello the world"), (2, None), (3, ""), (4, "x y" * 40000), (4, "x y" * 40000), (None, "é")]
    got = bpe.encode_documents(clashing(documents(spark, rows)), PATH, tokenizers.PATTERN).collect()
    assert len(got) == len(rows)
    for doc, text in rows:
        r = next(r for r in got if r["doc_id"] == doc)
        ids = np.array(reference.encode_ordinary(text or ""), "<u4")
        assert (r["n_tokens"], r["ids"]) == (len(ids), ids.tobytes())
        assert r["ids_sha256"] == hashlib.sha256(ids.tobytes()).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256((text or "").encode()).hexdigest()
    assert bpe.encode_documents(documents(spark, []), PATH, tokenizers.PATTERN).count() == 0


def test_pieces_stay_known_to_a_workers_later_tasks():
    batch = pa.RecordBatch.from_pydict({"doc_id": [1], "text": ["unrememberedly"]})
    coder = bpe.encoder(PATH, tokenizers.PATTERN)
    coder.forget()
    for forget in (False, True):
        (made,) = bpe.encoded_batches(iter([batch]), PATH, tokenizers.PATTERN, forget)
        assert coder.decode(made["ids"][0].as_py()) == b"unrememberedly"
        assert bool(coder.seen) is not forget
