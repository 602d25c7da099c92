import random

import numpy as np
import pyarrow as pa

from orderloom.llm.words import Words, bytes_hash, shingle_hashes, text_slices

from .support import words as plain

TEXTS = ["A b  a\n\tB", None, "", "  ", " x ", "É é Z", "\x1c a\x0b b\x0c", "one two three four"]


def test_words_are_the_runs_between_spaces():
    got = Words(pa.array(TEXTS))
    names = got.names.to_pylist()
    for i, text in enumerate(TEXTS):
        assert [names[k] for k in got.ids[got.starts[i] : got.starts[i + 1]]] == plain(text)


def test_slices_keep_every_row_and_text():
    rng = random.Random(1)
    texts = ["".join(rng.choice("aé \n") for _ in range(rng.randrange(60))) for _ in range(300)]
    batch = pa.RecordBatch.from_pydict({"text": texts})
    parts = list(text_slices(batch, limit=500))
    assert [t for p in parts for t in p.column("text").to_pylist()] == texts
    assert sum(len(Words(p.column("text")).ids) for p in parts) == sum(len(plain(t)) for t in texts)


def test_hashes_tell_words_apart():
    names = [f"{a}{b}" for a in "abcdé" for b in range(2000)] + ["", "ab", "ba", "aab", "aba"]
    assert len(np.unique(bytes_hash(pa.array(names)))) == len(set(names))


def test_shingles_of_short_texts_are_the_whole_sequence():
    hashes, starts = shingle_hashes(Words(pa.array(["a b c d", "a b", "", "b c d", "a b x"])), 3)
    assert np.diff(starts).tolist() == [2, 1, 0, 1, 1]
    assert hashes[1] == hashes[3] and hashes[2] not in (hashes[0], hashes[4])
