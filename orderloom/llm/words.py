"""Words of Arrow text columns as arrays: what the corpus operators share.

A word is a longest run of characters other than space and ``\\x09-\\x0D``, with
``A-Z`` lower-cased. Words are told apart by 64-bit hashes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

U64 = np.uint64
#: Text that one step of a task works on at a time.
SLICE_BYTES = 8 << 20


def mix(h: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit numbers (one to one)."""
    h = h ^ (h >> U64(30))
    h = h * U64(0xBF58476D1CE4E5B9)
    h = h ^ (h >> U64(27))
    h = h * U64(0x94D049BB133111EB)
    return h ^ (h >> U64(31))


def pair(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """One 64-bit hash of an ordered pair of 64-bit hashes."""
    return mix(a * U64(0x9E3779B97F4A7C15) + b + U64(0x632BE59BD9B4E019))


def text_slices(batch: pa.RecordBatch, column: str = "text", limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Parts of a batch with about ``limit`` bytes of text each; a longer text is a part of its own."""
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    ends = np.cumsum(sizes, dtype=np.int64)
    start = 0
    while start < batch.num_rows:
        base = ends[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, base + limit, "right")))
        # A copy: some Arrow kernels pass over the offset of a sliced array.
        yield batch.take(pa.array(np.arange(start, stop))) if stop - start < batch.num_rows else batch
        start = stop
    # Workers live on between tasks; what Arrow keeps for later would add up.
    pa.default_memory_pool().release_unused()


_RANDOM = np.random.default_rng(20240229).integers(1, 1 << 63, 256, dtype=np.uint64)
_STEP = U64(0x9E3779B97F4A7C15)


def bytes_hash(values: pa.Array) -> np.ndarray:
    """64-bit hashes of the strings of an array without nulls."""
    values = values.cast(pa.large_binary())
    n = len(values)
    _, offsets, data = values.buffers()
    ends = np.frombuffer(offsets, np.int64)[values.offset : values.offset + n + 1]
    sizes = np.diff(ends)
    if n == 0 or ends[-1] == ends[0]:
        return mix(sizes.astype(U64))
    raw = np.frombuffer(data, np.uint8)[ends[0] : ends[-1]]
    place = np.arange(len(raw)) - np.repeat(ends[:-1] - ends[0], sizes)
    powers = np.cumprod(np.full(int(sizes.max()) + 1, _STEP, U64))
    terms = _RANDOM[raw] * powers[place]
    full = sizes > 0
    sums = np.zeros(n, U64)
    sums[full] = np.add.reduceat(terms, (ends[:-1] - ends[0])[full])
    return mix(sums + sizes.astype(U64))


class Words:
    """The words of some texts: ``hashes[ids]`` are their hashes in order, and text ``i`` owns
    the words ``starts[i]`` to ``starts[i + 1]``. ``names`` has each distinct word once."""

    def __init__(self, text: pa.Array):
        if text.offset:
            text = text.take(pa.array(np.arange(len(text))))
        text = pc.ascii_trim_whitespace(pc.ascii_lower(pc.fill_null(text.cast(pa.large_string()), "")))
        lists = pc.ascii_split_whitespace(text)
        counts = np.diff(lists.offsets.to_numpy())
        counts[pc.equal(pc.binary_length(text), 0).to_numpy(zero_copy_only=False)] = 0
        flat = lists.flatten()
        coded = flat.dictionary_encode()
        names, ids = coded.dictionary, coded.indices.to_numpy(zero_copy_only=False)
        blank = pc.equal(pc.binary_length(names), 0).to_numpy(zero_copy_only=False)
        if blank.any():
            ids = ids[~blank[ids]]
        self.names = names
        self.ids = ids
        self.hashes = bytes_hash(names)
        self.starts = np.concatenate([[0], np.cumsum(counts)]).astype(np.int64)

    @classmethod
    def of(cls, hashes: np.ndarray) -> Words:
        """One text of words with these hashes."""
        one = cls.__new__(cls)
        one.hashes, one.ids, one.starts = hashes, np.arange(len(hashes)), np.array([0, len(hashes)])
        return one

    @property
    def sizes(self) -> np.ndarray:
        return np.diff(self.starts)

    def owners(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.starts) - 1), self.sizes)


def shingle_hashes(words: Words, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all ``size``-word shingles and the start of each text's own; a shorter text
    that has words gives its whole sequence as one."""
    seq = words.hashes[words.ids]
    sizes = words.sizes
    counts = np.where(sizes >= size, sizes - size + 1, np.minimum(sizes, 1))
    starts = np.concatenate([[0], np.cumsum(counts)]).astype(np.int64)
    out = np.empty(starts[-1], U64)
    rows = np.repeat(np.arange(len(sizes)), counts)
    first = words.starts[:-1][rows] + np.arange(starts[-1]) - starts[:-1][rows]
    last = words.starts[1:][rows]
    acc = seq[first] if len(first) else out
    for k in range(1, size):
        at = first + k
        inside = at < last
        step = pair(acc, seq[np.minimum(at, max(len(seq) - 1, 0))]) if len(first) else acc
        acc = np.where(inside, step, acc)
    length = np.minimum(sizes, size)[rows].astype(U64)
    return (mix(acc + length) if len(first) else out), starts
