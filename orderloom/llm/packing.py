"""Packing of token ids into sequences by shortest-pack-first over the length histogram.

A document's ids are cut into pieces of a whole sequence and a rest. How many rests have which length is
all that the packing needs: lengths are placed longest first, each into the patterns with the most room
left, as many documents at a time as a pattern has copies. Then the emptiest packs are given up: their
rests, one behind the other, are cut to fill the gaps of the others, go on as whole sequences, and end in
sequences of powers of two. So no sequence is padded, and only rests of packs that were given up are
cut again. Documents meet the patterns by their rank among the rests of their length.
"""

from __future__ import annotations

import os
from array import array
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..sizing import broadcast_if_small
from .blocks import pack, unpack
from .storage import stored
from .words import text_slices

SPACES = b" \t\n\r\x0b\x0c"
_IS_SPACE = np.isin(np.arange(256), list(SPACES))
_IS_MARK = np.isin(np.arange(256), list(b".,;:!?"))
#: Chunks whose ids a worker remembers, in each of two generations.
REMEMBERED = 400_000
#: Text that a task tokenizes at a time.
SECTION_BYTES = 8 << 20


class Chunks:
    """Token ids of chunks of text between spaces, remembered."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.seen: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

    def ids(self, chunks: list[str]) -> list[bytes]:
        """Each chunk's ids, packed as little-endian 32-bit numbers."""
        out = list(map(self.seen.get, chunks))
        lacking = [i for i, packed in enumerate(out) if packed is None]
        for i in lacking:
            out[i] = self.older.get(chunks[i])
        missing = [i for i in lacking if out[i] is None]
        for i, coded in zip(missing, self.tokenizer.encode_batch_fast([chunks[i] for i in missing], add_special_tokens=False)):
            out[i] = array("I", coded.ids).tobytes()
        if len(self.seen) + len(lacking) > REMEMBERED:
            self.seen, self.older = {}, self.seen
        self.seen.update((chunks[i], out[i]) for i in lacking if len(chunks[i]) < 64)
        return out


@lru_cache(maxsize=2)
def chunk_coder(path: str) -> Chunks:
    """One coder a worker process; it is kept for the worker's later tasks."""
    return Chunks(path)


def spaced(texts: pa.Array) -> pa.Array:
    """Texts with the same tokens and fewer different chunks.

    A mark between an ASCII letter and a space gets a space before it, where two pieces of text meet anyway;
    ``A-Z`` before another ASCII character become small, as the tokenizer makes them once it has composed
    characters. Where ``<|`` occurs, which special tokens begin with, letters stay.
    """
    data = texts.cast(pa.large_binary())
    offsets = np.frombuffer(data.buffers()[1], np.int64)[data.offset : data.offset + len(data) + 1]
    raw = np.frombuffer(data.buffers()[2] or b"", np.uint8)[offsets[0] : offsets[-1]].copy()
    offsets = offsets - offsets[0]
    if not len(raw):
        return data
    after = np.append(raw[1:], np.uint8(32))
    after[offsets[1:][offsets[1:] > 0] - 1] = 32
    capital = (raw >= 65) & (raw <= 90) & (after < 128)
    if b"<|" not in raw.tobytes():
        raw[capital] |= 32
    letter = ((raw | 32) >= 97) & ((raw | 32) <= 122)
    at = np.flatnonzero(_IS_MARK[raw[1:]] & _IS_SPACE[after[1:]] & letter[:-1]) + 1
    moved = offsets + np.searchsorted(at, offsets)
    return pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(data), [None, pa.py_buffer(moved), pa.py_buffer(np.insert(raw, at, 32))])


def tokenized(texts: pa.Array, coder: Chunks) -> tuple[np.ndarray, np.ndarray]:
    """The ids of all texts, and where each text's begin; space characters of ASCII always part tokens."""
    lists = pc.ascii_split_whitespace(spaced(texts).cast(pa.large_string()))
    coded = lists.flatten().dictionary_encode()
    packed = coder.ids(coded.dictionary.to_pylist())
    which = coded.indices.to_numpy(zero_copy_only=False)
    flat = np.frombuffer(b"".join(packed), "<u4")
    sizes = np.array(list(map(len, packed)), np.int64) // 4
    begins = np.cumsum(sizes) - sizes
    counts = sizes[which]
    ends = np.cumsum(counts)
    total = int(ends[-1]) if len(ends) else 0
    ids = flat[np.repeat(begins[which] - (ends - counts), counts) + np.arange(total)]
    chunk_starts = lists.offsets.to_numpy()
    return ids, np.concatenate([[0], ends])[chunk_starts - chunk_starts[0]].astype(np.int64)


def _sections(text: str) -> Iterator[str]:
    """A long text cut at spaces."""
    data, start = text.encode(), 0
    while start < len(data):
        stop = start + SECTION_BYTES
        while stop < len(data) and data[stop] not in SPACES:
            stop += 1
        yield data[start:stop].decode()
        start = stop


def ids_of(batch: pa.RecordBatch, coder: Chunks) -> Iterator[np.ndarray]:
    """The ids of each text of a batch, a null text having none."""
    for part in text_slices(batch, limit=SECTION_BYTES):
        texts = part.column("text").fill_null("")
        if part.num_rows == 1 and pc.binary_length(texts)[0].as_py() > SECTION_BYTES:
            yield np.concatenate([tokenized(pa.array([s]), coder)[0] for s in _sections(texts[0].as_py())])
            continue
        ids, starts = tokenized(texts, coder)
        for a, b in zip(starts[:-1], starts[1:]):
            yield ids[a:b]


_CODED = "part long, doc_id long, doc_tokens long, ids binary, rest int, nth long, wholes_before long"


def coded_documents(docs: DataFrame, path: str, size: int, end: int) -> DataFrame:
    """Every document's ids with ``end`` behind them, and how it counts in its task.

    ``rest`` is what remains after pieces of ``size``; ``nth`` numbers the documents with such a rest in
    the task, ``wholes_before`` counts the whole pieces of the task's earlier documents.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = chunk_coder(path)
        task = TaskContext.get().partitionId()
        seen, wholes = np.zeros(size, np.int64), 0
        for batch in batches:
            doc_ids = batch.column("doc_id")
            rows: list[tuple] = []
            held = 0
            first = 0
            for i, ids in enumerate(ids_of(batch, coder)):
                full = np.append(ids, np.uint32(end)).astype("<u4")
                rest = len(full) % size
                rows.append((len(full), pack(full), rest, int(seen[rest]), wholes))
                seen[rest] += 1
                wholes += len(full) // size
                held += len(rows[-1][1])
                if held > SECTION_BYTES or i == batch.num_rows - 1:
                    n_tokens, packed, rests, nth, before = zip(*rows)
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array([task] * len(rows), pa.int64()), doc_ids.slice(first, len(rows)), pa.array(n_tokens, pa.int64()),
                            pa.array(packed, pa.binary()), pa.array(rests, pa.int32()), pa.array(nth, pa.int64()), pa.array(before, pa.int64()),
                        ],
                        names=["part", "doc_id", "doc_tokens", "ids", "rest", "nth", "wholes_before"],
                    )
                    rows, held, first = [], 0, i + 1
            pa.default_memory_pool().release_unused()

    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return rows.mapInArrow(run, _CODED)


def patterns_of(histogram: dict[int, int], size: int) -> list[tuple[int, tuple[int, ...]]]:
    """Shortest-pack-first: ``(copies, lengths)`` of the patterns that hold all lengths.

    Lengths come longest first and go into the pattern with the most room; a new pattern takes as many
    of a length as it holds.
    """
    open_: dict[int, list[tuple[int, tuple[int, ...]]]] = {}
    done: list[tuple[int, tuple[int, ...]]] = []

    def put(room: int, copies: int, lengths: tuple[int, ...]) -> None:
        if copies:
            (open_.setdefault(room, []) if room else done).append((copies, lengths))

    for length in sorted(histogram, reverse=True):
        left = histogram[length]
        while left:
            room = max(open_, default=0)
            if room < length:
                fits = size // length
                put(size - fits * length, left // fits, (length,) * fits)
                if left % fits:
                    put(size - left % fits * length, 1, (length,) * (left % fits))
                break
            copies, lengths = open_[room].pop()
            if not open_[room]:
                del open_[room]
            used = min(copies, left)
            put(room, copies - used, lengths)
            put(room - length, used, (*lengths, length))
            left -= used
    return done + [p for room in sorted(open_) for p in open_[room]]


class Plan:
    """Where the rest of every length and rank goes.

    The ``n``-th document with a rest of ``length`` finds its row by ``(length, n)``. A row of a pattern that
    stays gives the sequence and the offset; one of a pattern that was given up gives a position in the stream
    of its rests, and the stream's parts lie in the gaps of the sequences.
    """

    def __init__(self, histogram: dict[int, int], size: int):
        self.size = size
        patterns = patterns_of(histogram, size)
        patterns.sort(key=lambda p: -sum(p[1]))  # those with the most room last
        room = sum(c * (size - sum(p)) for c, p in patterns)
        kept, given = list(patterns), []
        tokens = 0
        while kept and room > tokens:
            copies, lengths = kept.pop()
            filled = sum(lengths)
            # Giving one pack up takes its gap away and adds its tokens.
            needed = min(copies, -(-(room - tokens) // size))
            room -= needed * (size - filled)
            tokens += needed * filled
            given.append((needed, lengths))
            if needed < copies:
                kept.append((copies - needed, lengths))
        rows, gaps = [], []
        taken = dict.fromkeys(histogram, 0)
        sequence = 0

        def place(copies: int, lengths: tuple[int, ...], first: int, step: int, streamed: bool) -> None:
            offset = 0
            for length in lengths:
                rows.append((length, taken[length], first, step, offset, streamed))
                taken[length] += copies
                offset += length

        for copies, lengths in kept:
            place(copies, lengths, sequence, 1, False)
            filled = sum(lengths)
            if filled < size:
                gaps.append((copies, size - filled, sequence, filled))
            sequence += copies
        at = 0
        for copies, lengths in given:
            filled = sum(lengths)
            place(copies, lengths, at, filled, True)
            at += copies * filled
        over = at - sum(c * g for c, g, _, _ in gaps)
        gaps.append((over // size, size, sequence, 0))
        sequence += over // size
        for bit in reversed(range(size.bit_length())):
            if over % size >> bit & 1:
                gaps.append((1, 1 << bit, sequence, 0))
                sequence += 1
        self.sequences = sequence
        rows.sort()
        self.lengths, self.ranks, self.firsts, self.steps, self.offsets, self.streamed = (np.array(c, np.int64) for c in zip(*rows)) if rows else [np.zeros(0, np.int64)] * 6
        gaps = [g for g in gaps if g[0]]
        self.gap_copies, self.gap_sizes, self.gap_sequences, self.gap_offsets = (np.array(c, np.int64) for c in zip(*gaps)) if gaps else [np.zeros(0, np.int64)] * 4
        self.gap_starts = np.cumsum(self.gap_copies * self.gap_sizes) - self.gap_copies * self.gap_sizes
        self.edges = np.searchsorted(self.lengths, np.arange(size + 1))

    def pieces(self, length: int, rank: int) -> list[tuple[int, int, int]]:
        """``(tokens, sequence, offset)`` of the parts of one rest, in order."""
        a, b = self.edges[length], self.edges[length + 1]
        row = a + int(np.searchsorted(self.ranks[a:b], rank, "right")) - 1
        copy = rank - int(self.ranks[row])
        at = int(self.firsts[row]) + copy * int(self.steps[row])
        if not self.streamed[row]:
            return [(length, at, int(self.offsets[row]))]
        at += int(self.offsets[row])
        out = []
        while length:
            gap = int(np.searchsorted(self.gap_starts, at, "right")) - 1
            nth, inside = divmod(at - int(self.gap_starts[gap]), int(self.gap_sizes[gap]))
            used = min(length, int(self.gap_sizes[gap]) - inside)
            out.append((used, int(self.gap_sequences[gap]) + nth, int(self.gap_offsets[gap]) + inside))
            at, length = at + used, length - used
        return out


_PIECES = "doc_id long, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long"
_NAMES = ["doc_id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset"]


def _cut(plan: Plan):
    """Documents with the ranks of their rests and whole pieces to pieces with ids."""
    size = plan.size

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows: list[tuple] = []
            for row in batch.to_pylist():
                ids = unpack(row["ids"], row["doc_tokens"], np.uint32)
                wholes = len(ids) // size
                parts = [(size, row["first_whole"] + k, 0) for k in range(wholes)]
                if row["rest"]:
                    parts += plan.pieces(row["rest"], row["rank"])
                start = 0
                for length, sequence, offset in parts:
                    rows.append((row["doc_id"], start, length, ids[start : start + length].astype("<u4").tobytes(), row["doc_tokens"], sequence, offset))
                    start += length
                    if len(rows) >= 2000:
                        yield _batch(rows)
                        rows = []
            if rows:
                yield _batch(rows)

    return run


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.int64()]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], names=_NAMES)


def _before(counts: DataFrame, by: list[str], n: str, name: str) -> DataFrame:
    """Over the earlier tasks' ``n``: one row a task (and length), never more."""
    order = Window.partitionBy(*by).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    return counts.withColumn(name, F.coalesce(F.sum(n).over(order), F.lit(0))).drop(n)


def pack_documents(docs: DataFrame, path: str, size: int = 2048, end: int = 1) -> DataFrame:
    """Pieces of all ``docs`` (``doc_id, text``) in sequences of at most ``size`` tokens.

    ``path`` names a file of the ``tokenizers`` library that every worker has; its tokenizer must part tokens
    at spaces. A document is its text's ids without added special tokens, and ``end``. Returns one row a
    piece: ``doc_id``, ``start`` and ``length`` in the document, ``ids`` (little-endian 32-bit numbers),
    ``doc_tokens``, ``sequence_id`` and ``offset`` in the sequence. Sequences are full, but for at most one
    of each smaller power of two.

    A null or empty text is ``end`` alone. A null ``doc_id`` stays null, repeated rows are documents each.
    Texts of any length are tokenized whole, in sections. Other columns are not read; an empty table gives
    no rows. The driver holds the histogram and the patterns: ``size`` lengths at most.
    """
    coded = stored(coded_documents(docs, path, size, end), "coded")
    counts = stored(coded.filter("rest > 0").groupBy("part", "rest").agg(F.count("*").alias("n")), "rests")
    histogram = {r["rest"]: r["n"] for r in counts.groupBy("rest").agg(F.sum("n").alias("n")).collect()}
    plan = Plan(histogram, size)
    ranks = _before(counts, ["rest"], "n", "rests_before")
    wholes = coded.groupBy("part").agg(F.sum(F.expr(f"doc_tokens div {size}")).alias("n"))
    firsts = _before(wholes, [], "n", "wholes_of_tasks")
    rows = coded.join(broadcast_if_small(ranks), ["part", "rest"], "left").join(broadcast_if_small(firsts), "part").select(
        "doc_id", "doc_tokens", "ids", "rest", (F.col("nth") + F.col("rests_before")).alias("rank"),
        (F.lit(plan.sequences) + F.col("wholes_of_tasks") + F.col("wholes_before")).alias("first_whole"),
    )
    return rows.mapInArrow(_cut(plan), _PIECES)
