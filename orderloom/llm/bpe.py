"""Byte-level BPE by dynamic programming over byte prefixes.

For every prefix of a piece of text there is exactly one token that ends the
prefix's encoding, since a token sequence is an encoding exactly when each two
neighbours are. ``Prefixes`` stores that token per prefix. Bytes can then be
appended, or replaced near the end, by working out the prefixes from there on
alone, and the encoding is read off backwards.

A text is cut into pieces by the tokenizer's pattern, and each piece is encoded
by itself. A piece that is a token is that token.
"""

from __future__ import annotations

import base64
import hashlib
import struct
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Different pieces, in each of two generations, and pairs of tokens that a worker remembers; bounds memory, not results.
REMEMBERED, REMEMBERED_PAIRS = 200_000, 500_000


def read_ranks(path: str) -> dict[bytes, int]:
    """Token bytes to rank from a rank file: one base64 token and its rank a line."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


class Ranks:
    """A vocabulary: bytes by rank, and which neighbours are an encoding of their own bytes."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        #: What tokens end in: the rank of a token, or -1 for the end of longer ones only.
        self.ends = {token[i:]: -1 for token in ranks for i in range(1, len(token))} | ranks
        self.token = [b""] * (max(ranks.values()) + 1)
        for token, rank in ranks.items():
            self.token[rank] = token
        self._fits: dict[int, bool] = {}
        self._own: dict[int, bool] = {}
        self._halves: dict[int, tuple[int, int] | None] = {}

    def merged(self, data: bytes, below: int = 1 << 60) -> list[int]:
        """Encoding by merging the lowest-ranked neighbours again and again, with tokens of a rank
        under ``below``; for short inputs."""
        parts = [data[i : i + 1] for i in range(len(data))]
        while len(parts) > 1:
            best = min(range(len(parts) - 1), key=lambda i: (self.ranks.get(parts[i] + parts[i + 1], 1 << 60), i))
            if self.ranks.get(parts[best] + parts[best + 1], 1 << 60) >= below:
                break
            parts[best : best + 2] = [parts[best] + parts[best + 1]]
        return [self.ranks[p] for p in parts]

    def halves(self, rank: int) -> tuple[int, int] | None:
        """The two tokens whose merge makes the token; None for a single byte."""
        if rank not in self._halves:
            parts = self.merged(self.token[rank], rank)
            self._halves[rank] = (parts[0], parts[1]) if len(parts) == 2 else None
        return self._halves[rank]

    def reachable(self, rank: int) -> bool:
        """Whether merging the token's bytes gives the token."""
        found = self._own.get(rank)
        if found is None:
            found = self._own[rank] = self.merged(self.token[rank]) == [rank]
        return found

    def fits(self, left: int, right: int) -> bool:
        """Whether the two tokens are the encoding of their joined bytes."""
        key = left << 32 | right
        found = self._fits.get(key)
        if found is None:
            if len(self._fits) >= REMEMBERED_PAIRS:
                self._fits.clear()
            found = self._fits[key] = self._stay_apart(left, right)
        return found

    def forget(self) -> None:
        """Drop the remembered pairs."""
        self._fits.clear()

    def _stay_apart(self, left: int, right: int) -> bool:
        """Undo the merges next to the border, latest first, and see whether one across it would have come sooner.

        Both tokens must be what merging their own bytes gives. Of merges of one rank
        the one further left comes first.
        """
        token, ranks = self.token, self.ranks
        limit = 1 << 60
        while True:
            across = ranks.get(token[left] + token[right])
            if across is not None and across < limit:
                return False
            parts_left, parts_right = self.halves(left), self.halves(right)
            if parts_left and (left > right or not parts_right):
                limit, left = left, parts_left[1]
            elif parts_right:
                limit, right = right + 1, parts_right[0]
            else:
                return True


class Prefixes:
    """The last token of every byte prefix of a growing piece."""

    def __init__(self, ranks: Ranks, data: bytes = b""):
        self.ranks = ranks
        self.data = bytearray()
        self.last: list[int] = []
        self.append(data)

    def append(self, more: bytes) -> None:
        """Add bytes; no earlier prefix changes."""
        self.data += more
        data, last, known = bytes(self.data), self.last, self.ranks.ends.get
        fits, reachable, settled = self.ranks.fits, self.ranks.reachable, self.ranks._fits.get
        for end in range(len(last) + 1, len(data) + 1):
            # One token fits, so the order of trying is free: outwards, as long as some token ends so.
            for start in range(end - 1, -1, -1):
                rank = known(data[start:end])
                if rank is None:
                    break
                if rank < 0:
                    continue
                if not start:
                    good = reachable(rank)
                else:
                    good = settled(last[start - 1] << 32 | rank)
                    if good is None:
                        good = fits(last[start - 1], rank)
                if good:
                    last.append(rank)
                    break

    def replace(self, start: int, end: int, new: bytes) -> None:
        """Put ``new`` in place of the bytes from ``start`` to ``end``; prefixes up to ``start`` stay."""
        tail = bytes(self.data[end:])
        del self.data[start:], self.last[start:]
        self.append(new + tail)

    def tokens(self) -> list[int]:
        out, at = [], len(self.last)
        while at:
            out.append(self.last[at - 1])
            at -= len(self.ranks.token[out[-1]])
        return out[::-1]


class Encoder:
    """Texts to token ids and back."""

    def __init__(self, path: str, pattern: str, remembered: int = REMEMBERED):
        self.vocabulary = Ranks(read_ranks(path))
        self.find = regex.compile(pattern).findall
        self.remembered = remembered
        self.seen: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

    def forget(self) -> None:
        """Drop the remembered pieces and pairs, which lets a worker go on to other work with little memory."""
        self.seen, self.older = {}, {}
        self.vocabulary.forget()

    def piece(self, piece: str) -> bytes:
        """A piece's ids as little-endian 32-bit numbers."""
        packed = self.seen.get(piece) or self.older.get(piece)
        if packed is None:
            data = piece.encode()
            whole = self.vocabulary.ranks.get(data)
            ids = [whole] if whole is not None else Prefixes(self.vocabulary, data).tokens()
            packed = struct.pack(f"<{len(ids)}I", *ids)
        if len(piece) < 256:
            if len(self.seen) >= self.remembered:
                self.seen, self.older = {}, self.seen
            self.seen[piece] = packed
        return packed

    def encode(self, text: str) -> bytes:
        """The ids of a text, packed."""
        seen, piece = self.seen, self.piece
        return b"".join([seen.get(p) or piece(p) for p in self.find(text)])

    def decode(self, packed: bytes) -> bytes:
        token = self.vocabulary.token
        return b"".join([token[i] for i in np.frombuffer(packed, "<u4").tolist()])


@lru_cache(maxsize=4)
def encoder(path: str, pattern: str) -> Encoder:
    """One encoder a worker process; it is kept for the worker's later tasks."""
    return Encoder(path, pattern)


def encoded_batches(batches: Iterator[pa.RecordBatch], path: str, pattern: str, forget: bool) -> Iterator[pa.RecordBatch]:
    """Batches of ``doc_id, text`` encoded, see ``encode_documents``."""
    coder = encoder(path, pattern)
    for batch in batches:
        for start in range(0, batch.num_rows, 500):
            part = batch.slice(start, 500)
            ids = [coder.encode(t.as_py() or "") for t in part.column("text")]
            yield pa.RecordBatch.from_arrays(
                [
                    part.column("doc_id"), pa.array(ids, pa.binary()), pa.array([len(x) // 4 for x in ids], pa.int64()),
                    pa.array([hashlib.sha256(x).hexdigest() for x in ids], pa.string()),
                    pa.array([hashlib.sha256(coder.decode(x)).hexdigest() for x in ids], pa.string()),
                ],
                names=["doc_id", "ids", "n_tokens", "ids_sha256", "decoded_sha256"],
            )
        pa.default_memory_pool().release_unused()
    if forget:
        coder.forget()


def encode_documents(docs: DataFrame, path: str, pattern: str, forget: bool = False) -> DataFrame:
    """``doc_id, ids, n_tokens, ids_sha256, decoded_sha256`` of each text's encoding by the rank file at ``path``.

    ``ids`` packs the ids as little-endian 32-bit numbers; the decoded bytes are made
    from them. A null text counts as empty: no ids, the hash of no bytes. A null
    ``doc_id`` stays null, and repeated rows are encoded each. No other column is
    read; an empty table gives no rows. The rank file must exist on every worker. A
    worker's later tasks go on with the pieces it remembers, a bounded number, unless ``forget``.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return encoded_batches(batches, path, pattern, forget)

    schema = "doc_id long, ids binary, n_tokens long, ids_sha256 string, decoded_sha256 string"
    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, schema)
