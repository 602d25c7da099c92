"""Blocks of documents, and the buckets that their keys are counted in.

A block is a few million words of whole documents in one row: the hashes of its
different words, and the word numbers in order. Keys of a block (n-grams, anchors)
go to buckets by their top bits, each different key once per block, and buckets
answer blocks in the order of the block's own ascending keys.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from .words import U64, Words, text_slices

#: Words in a block (a longer text is a block of its own), and keys that a bucket is planned for.
BLOCK_WORDS = 1_000_000
BUCKET_KEYS = 2_000_000
_ARROW = {"long": pa.int64(), "boolean": pa.bool_()}


def pack(values: np.ndarray) -> bytes:
    """Numbers as compressed byte planes."""
    planes = np.ascontiguousarray(values.view(np.uint8).reshape(len(values), values.itemsize).T)
    return pa.compress(planes.tobytes(), codec="zstd", asbytes=True) if len(values) else b""


def unpack(data: bytes, n: int, dtype: type) -> np.ndarray:
    if not n:
        return np.zeros(0, dtype)
    size = np.dtype(dtype).itemsize
    planes = np.frombuffer(pa.decompress(data, decompressed_size=n * size, codec="zstd", asbytes=True), np.uint8)
    return np.ascontiguousarray(planes.reshape(size, n).T).view(dtype).ravel()


def pack_ascending(values: np.ndarray) -> bytes:
    """Ascending 64-bit numbers by their differences."""
    return pack(np.diff(values, prepend=U64(0)))


def unpack_ascending(data: bytes, n: int) -> np.ndarray:
    return np.cumsum(unpack(data, n, U64), dtype=U64)


def block_rows(docs: DataFrame, carried: dict[str, str]) -> DataFrame:
    """Documents as blocks; words are numbered by falling frequency in the block.

    ``carried`` names columns (``long`` or ``boolean``) that each block keeps as
    lists, one value for each of its documents.
    """

    def finish(number: int, parts: list) -> pa.RecordBatch:
        hashes = np.concatenate([words.hashes[words.ids] for _, words in parts])
        kinds, ids, counts = np.unique(hashes, return_inverse=True, return_counts=True)
        order = np.argsort(-counts, kind="stable")
        rank = np.empty(len(order), np.uint32)
        rank[order] = np.arange(len(order), dtype=np.uint32)
        sizes = np.concatenate([words.sizes for _, words in parts]).astype(np.int64)
        kept = [
            pa.array([pa.concat_arrays([part.column(c) for part, _ in parts]).to_pylist()], pa.list_(_ARROW[t]))
            for c, t in carried.items()
        ]
        return pa.RecordBatch.from_arrays(
            [
                pa.array([(TaskContext.get().partitionId() << 24) | number], pa.int64()),
                pa.array([len(ids) + len(sizes)], pa.int64()),
                pa.array([sizes], pa.list_(pa.int64())),
                pa.array([kinds[order].tobytes()], pa.binary()),
                pa.array([pack(rank[ids])], pa.binary()),
                *kept,
            ],
            names=["block", "n_tokens", "sizes", "words", "seq", *carried],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, n_words, number = [], 0, 0
        for batch in batches:
            for part in text_slices(batch):
                words = Words(part.column("text"))
                parts.append((part.select(list(carried)), words))
                n_words += len(words.ids)
                if n_words >= BLOCK_WORDS:
                    yield finish(number, parts)
                    parts, n_words, number = [], 0, number + 1
        if parts:
            yield finish(number, parts)

    kept = "".join(f", {c} array<{t}>" for c, t in carried.items())
    return docs.mapInArrow(run, f"block long, n_tokens long, sizes array<long>, words binary, seq binary{kept}")


def word_sequence(row: dict) -> np.ndarray:
    """The word hashes of a block in order."""
    words = np.frombuffer(row["words"], U64)
    return words[unpack(row["seq"], int(np.sum(row["sizes"], dtype=np.int64)), np.uint32)]


def bucket_bits(total: int) -> int:
    """How many top bits number the buckets for so many keys."""
    return max(0, math.ceil(math.log2(max(1, total / BUCKET_KEYS))))


def buckets_of(kinds: np.ndarray, bits: int) -> Iterator[tuple[int, slice]]:
    """The non-empty buckets of ascending keys."""
    if not bits:
        if len(kinds):
            yield 0, slice(0, len(kinds))
        return
    bucket = (kinds >> U64(64 - bits)).astype(np.int64)
    edges = np.searchsorted(bucket, np.arange((1 << bits) + 1))
    for b in np.flatnonzero(np.diff(edges)):
        yield int(b), slice(int(edges[b]), int(edges[b + 1]))


def gathered(table: pa.Table) -> tuple[list[dict], np.ndarray, np.ndarray, np.ndarray]:
    """A bucket's requests in order of block, its different keys, and where each requested key is among them."""
    rows = sorted(table.to_pylist(), key=lambda r: r["block"])
    keys = np.concatenate([unpack_ascending(r["keys"], r["n"]) for r in rows])
    kinds, at = np.unique(keys, return_inverse=True)
    ends = np.cumsum([r["n"] for r in rows])
    return rows, kinds, at, ends
