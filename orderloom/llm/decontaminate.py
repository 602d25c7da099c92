"""Benchmark passages in documents, by SimHash of item-sized windows.

A window of a document as long as an item has a SimHash of its words, of ``BITS`` bits.
The items' fingerprints are kept in a multi-index of ``BLOCKS`` blocks of 16 bits: two
fingerprints within ``RADIUS`` bits of each other differ in no more than ``BLOCK_RADIUS``
bits of at least one block, and every block lists its items under all values that near,
so looking up a window's blocks finds every item within the radius. What is found, and
nothing else, is verified exactly: the weighted Jaccard similarity of the five-word
shingles, a shingle weighing as often as it occurs. A document shorter than an item is a
single window.

Windows at a similarity of 0.8 lie 18 bits apart on average where a run of words is
changed at one end, which is the worst case, and less elsewhere; the radius is over three
deviations more.

A window that shares no shingle with any item has similarity 0 whatever its fingerprint,
so fingerprints are only taken in stretches around shingles that the benchmark has.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F

from ..sizing import broadcast_if_small
from .storage import stored
from .words import U64, Words, mix, shingle_hashes, text_slices

SHINGLE = 5
BITS, BLOCKS = 128, 8
#: Bits that a block may differ in, and with it the radius that the blocks guarantee.
BLOCK_RADIUS = 3
RADIUS = BLOCKS * (BLOCK_RADIUS + 1) - 1
#: Text of the benchmark that one pass over the documents compares; more takes more passes.
ITEM_BYTES = 1 << 20
#: Windows that are looked up at a time.
PIECE = 4096


def plain_words(text: pa.Array) -> Words:
    """Words without case and punctuation."""
    lowered = pc.utf8_lower(pc.fill_null(text.cast(pa.string()), ""))
    return Words(pc.replace_substring_regex(lowered, r"[^\p{L}\p{N}]+", " "))


def simhashes(sums: np.ndarray, length: int) -> np.ndarray:
    """Fingerprints of all windows of ``length`` words as rows of 16-bit blocks."""
    return np.packbits(sums[length:] > sums[:-length], axis=1, bitorder="little").view(np.uint16)


def bit_sums(seq: np.ndarray) -> np.ndarray:
    """For every place and bit how many more words before it have the bit than have not."""
    wide = np.stack([mix(seq ^ U64(0x5EED << k)) for k in range(BITS // 64)], axis=1)
    bits = np.unpackbits(wide.view(np.uint8).reshape(len(seq), -1), axis=1, bitorder="little")
    sums = np.zeros((len(seq) + 1, BITS), np.int32)
    np.cumsum(bits.astype(np.int8) * 2 - 1, axis=0, dtype=np.int32, out=sums[1:])
    return sums


def _near_values() -> np.ndarray:
    """All 16-bit numbers with at most ``BLOCK_RADIUS`` bits."""
    every = np.arange(1 << 16, dtype=np.uint16)
    return every[np.bitwise_count(every) <= BLOCK_RADIUS]


class MultiIndex:
    """Fingerprints of equally long items, found by their blocks of bits."""

    def __init__(self, fingerprints: np.ndarray):
        self.fingerprints = fingerprints
        near = _near_values()
        self.items, self.values = [], []
        for b in range(BLOCKS):
            values = (fingerprints[:, b, None] ^ near[None]).ravel()
            order = np.argsort(values, kind="stable")
            self.items.append((order // len(near)).astype(np.int32))
            self.values.append(values[order])

    def within(self, fingerprints: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All ``(query, item)`` positions within the radius."""
        n = len(self.fingerprints)
        found = []
        for b in range(BLOCKS):
            lo, hi = (np.searchsorted(self.values[b], fingerprints[:, b], side) for side in ("left", "right"))
            sizes = hi - lo
            place = np.repeat(lo - np.cumsum(sizes) + sizes, sizes) + np.arange(sizes.sum())
            query, item = np.repeat(np.arange(len(fingerprints)), sizes), self.items[b][place]
            apart = np.bitwise_count(fingerprints[query] ^ self.fingerprints[item]).sum(axis=1, dtype=np.int32)
            near = apart <= RADIUS
            found.append(query[near] * n + item[near])
        pairs = np.unique(np.concatenate(found))
        return pairs // n, pairs % n


class Items:
    """A block of the benchmark, ready to be looked up."""

    def __init__(self, rows: list[tuple[int, str]]):
        self.ids: list[int] = []
        self.shingles: list[tuple[np.ndarray, np.ndarray]] = []
        words = plain_words(pa.array([text for _, text in rows], pa.string()))
        hashes, starts = shingle_hashes(words, SHINGLE)
        by_length: dict[int, list[int]] = defaultdict(list)
        grams = []
        self.seqs: list[np.ndarray] = []
        for i, (item_id, _) in enumerate(rows):
            seq = words.hashes[words.ids[words.starts[i] : words.starts[i + 1]]]
            if len(seq):
                by_length[len(seq)].append(len(self.ids))
                self.ids.append(item_id)
                self.seqs.append(seq)
                grams.append(hashes[starts[i] : starts[i + 1]])
                self.shingles.append(np.unique(grams[-1], return_counts=True))
        self.members = {n: np.array(at) for n, at in sorted(by_length.items())}
        self.prints = {n: np.concatenate([simhashes(bit_sums(self.seqs[i]), n) for i in at]) for n, at in self.members.items()}
        #: Shingles of the items, by shingle size (shorter items are one shingle).
        self.grams = {
            size: np.unique(np.concatenate([grams[i] for n, at in self.members.items() if min(n, SHINGLE) == size for i in at]))
            for size in sorted({min(n, SHINGLE) for n in self.members})
        }

    def similarity(self, item: int, shingles: np.ndarray) -> float:
        """Weighted Jaccard similarity of an item and the shingles of a window."""
        kinds, counts = self.shingles[item]
        other, other_counts = np.unique(shingles, return_counts=True)
        at = np.minimum(np.searchsorted(other, kinds), len(other) - 1)
        common = np.minimum(counts, np.where(other[at] == kinds, other_counts[at], 0)).sum()
        return float(common / (counts.sum() + other_counts.sum() - common))


def _member(values: np.ndarray, known: np.ndarray, bitmap: np.ndarray) -> np.ndarray:
    """Which values are in the ascending array; the bitmap of their top bits rules most of them out."""
    maybe = np.flatnonzero(bitmap[(values >> U64(44)).astype(np.int64)])
    at = np.minimum(np.searchsorted(known, values[maybe]), len(known) - 1)
    return maybe[known[at] == values[maybe]]


def _search(items: Items, index: dict[int, MultiIndex], seq: np.ndarray, hits: dict[int, np.ndarray], at_least: float) -> Iterator[tuple[int, int, int, float]]:
    """``(item, first word, words, similarity)`` of the best window of each item in one document."""
    best: dict[int, tuple[float, int, int]] = {}
    for size, places in hits.items():
        lengths = [n for n in items.members if min(n, SHINGLE) == size]
        longest = max(lengths)
        # Stretches of the text around the hits, long enough for every window that holds one, in pieces that overlap by a window.
        cut = np.flatnonzero(np.diff(places) > 2 * longest)
        for group in np.split(places, cut + 1):
            first, stop = max(0, int(group[0]) - longest), min(len(seq), int(group[-1]) + size + longest)
            for a in range(first, max(first + 1, stop - min(lengths) + 1), PIECE):
                part = seq[a : min(stop, a + PIECE + longest)]
                sums = bit_sums(part)
                grams = shingle_hashes(Words.of(part), size)[0]
                for n in lengths:
                    width = min(n, len(part))
                    if width < n and len(seq) >= n:
                        continue
                    window, item = index[n].within(simhashes(sums, width)[:PIECE])
                    for w, i in zip(window.tolist(), items.members[n][item].tolist()):
                        score = items.similarity(i, grams[w : w + width - size + 1])
                        if score >= at_least and (i not in best or (score, -a - w) > (best[i][0], -best[i][1])):
                            best[i] = (score, a + w, width)
    for i, found in sorted(best.items()):
        score, start, width = _refined(items, seq, i, *found)
        yield i, start, width, score


def _refined(items: Items, seq: np.ndarray, item: int, score: float, start: int, width: int) -> tuple[float, int, int]:
    """The best window up to a quarter of its length away from a verified one, the first of equals."""
    reach = width // 4 + 1
    a = max(0, start - reach)
    size = min(len(items.seqs[item]), SHINGLE)
    grams = shingle_hashes(Words.of(seq[a : start + width + reach]), size)[0]
    n = width - size + 1
    near = [(items.similarity(item, grams[w : w + n]), -a - w) for w in range(len(grams) - n + 1)]
    score, start = max([(score, -start), *near])
    return score, -start, width


def _matches(docs: DataFrame, items: Items, at_least: float) -> DataFrame:
    shared = docs.sparkSession.sparkContext.broadcast(items)  # at most about ITEM_BYTES of text

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items = shared.value
        index = {n: MultiIndex(prints) for n, prints in items.prints.items()}
        bitmaps = {}
        for size, known in items.grams.items():
            bitmaps[size] = np.zeros(1 << 20, bool)
            bitmaps[size][(known >> U64(44)).astype(np.int64)] = True
        for batch in batches:
            for part in text_slices(batch, limit=1 << 20):
                words = plain_words(part.column("text"))
                hits: dict[int, dict[int, np.ndarray]] = defaultdict(dict)
                for size, known in items.grams.items():
                    hashes, starts = shingle_hashes(words, size)
                    found = _member(hashes, known, bitmaps[size])
                    row = np.searchsorted(starts, found, "right") - 1
                    for r in np.unique(row):
                        hits[int(r)][size] = found[row == r] - starts[r]
                out: list[tuple] = []
                for r, places in hits.items():
                    seq = words.hashes[words.ids[words.starts[r] : words.starts[r + 1]]]
                    doc = part.column("doc_id")[r].as_py()
                    out += [(doc, items.ids[i], s, n, score) for i, s, n, score in _search(items, index, seq, places, at_least)]
                columns = list(zip(*out)) or [()] * 5
                kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.float64())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, k) for c, k in zip(columns, kinds)],
                    names=["doc_id", "item", "start_word", "n_words", "similarity"],
                )

    schema = "doc_id long, item long, start_word long, n_words long, similarity double"
    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, schema)


def contaminated(docs: DataFrame, benchmark: DataFrame, at_least: float = 0.8) -> DataFrame:
    """``doc_id, item_id, start_word, n_words, similarity``: the best window of each item in each document.

    Words are compared without case and punctuation, and ``start_word`` counts them
    from 0. A document with fewer words than an item is one window. One row per document row and item row whose similarity is at least
    ``at_least``; ties go to the first window.

    - Documents or items that are null, empty or without words match nothing.
    - An item of fewer than five words is one shingle: it matches where all of it occurs.
    - Null ids are carried through; repeated rows match each; other columns are not read.
    - An empty table on either side gives no rows.
    - Texts of any length are searched whole, ``PIECE`` windows at a time.

    The benchmark is a query set: its different texts are compared in blocks of about
    ``ITEM_BYTES``, one pass over the documents each.
    """
    items = benchmark.select(F.col("item_id").cast("long"), F.col("text").cast("string")).filter("text is not null")
    texts = stored(items.groupBy("text").agg(F.collect_list(F.struct("item_id")).alias("rows")).withColumn("item", F.monotonically_increasing_id()), "items")
    size = texts.agg(F.coalesce(F.sum(F.octet_length("text") + 16), F.lit(0)).alias("n")).first()["n"]
    blocks = max(1, -(-size // ITEM_BYTES))
    parts: list[DataFrame] = []
    for b in range(blocks):
        rows: list[Row] = texts.filter(F.pmod(F.xxhash64("text"), F.lit(blocks)) == b).select("item", "text").collect()
        block = Items(sorted((r["item"], r["text"]) for r in rows))
        if block.ids:
            parts.append(_matches(docs, block, at_least))
    if not parts:
        schema = "doc_id long, item_id long, start_word long, n_words long, similarity double"
        return docs.sparkSession.createDataFrame([], schema)
    found = parts[0]
    for part in parts[1:]:
        found = found.unionByName(part)
    named = found.join(broadcast_if_small(texts.select("item", "rows")), "item").select("*", F.explode("rows").alias("_row"))
    return named.select("doc_id", "_row.item_id", "start_word", "n_words", "similarity")
