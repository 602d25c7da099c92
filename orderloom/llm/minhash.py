"""Near-duplicate documents by b-bit MinHash.

Each document's set of word shingles gives ``bands * rows`` minima. Groups of
``rows`` whole minima are band keys, which find candidates; four low bits of
every minimum are kept in packed words, and the share of equal lanes, corrected
for lanes that agree by chance, estimates the similarity of a candidate pair by
bit counts. What the estimate does not rule out is confirmed on the full sets.

Copies (equal sets) are one class and one vertex from the start. In a bucket
only links to its smallest member are tried first, which joins most groups
without looking at their pairs. Buckets that are then still in several parts are
settled exactly, block by block, with products of sparse sets, and a block pair
gives a spanning forest of its links, never the links themselves.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import materialize
from .graph import components
from .words import U64, Words, mix, shingle_hashes, text_slices

#: Bits kept of each minimum, and lanes in a packed 64-bit word.
LOW_BITS = 4
LANES = 64 // LOW_BITS
#: Documents in a block when a bucket is settled exactly.
BLOCK = 512
#: How far below the threshold an estimate may lie before a pair is ruled out (over six deviations).
SLACK = 0.25
_SLICE = 1 << 20


def _coefficients(n: int) -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(7)
    return rng.integers(1, 1 << 63, n, dtype=np.uint64) | U64(1), rng.integers(0, 1 << 63, n, dtype=np.uint64)


def distinct_shingles(text: pa.Array, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Each text's distinct shingle hashes in ascending order, and where each text's own start."""
    hashes, starts = shingle_hashes(Words(text), size)
    owners = np.repeat(np.arange(len(starts) - 1), np.diff(starts))
    order = np.lexsort((hashes, owners))
    hashes = hashes[order]
    fresh = np.ones(len(hashes), bool)
    fresh[1:] = (hashes[1:] != hashes[:-1]) | (owners[1:] != owners[:-1])
    counts = np.bincount(owners[fresh], minlength=len(starts) - 1)
    return hashes[fresh], np.concatenate([[0], np.cumsum(counts)]).astype(np.int64)


def _sums(values: np.ndarray, starts: np.ndarray) -> np.ndarray:
    out = np.zeros(len(starts) - 1, U64)
    full = np.diff(starts) > 0
    if full.any():
        out[full] = np.add.reduceat(values, starts[:-1][full])
    return out


def _minima(hashes: np.ndarray, starts: np.ndarray, n: int) -> np.ndarray:
    """``n`` minima of each non-empty set, one row per set."""
    at = starts[:-1][np.diff(starts) > 0]
    out = np.empty((len(at), n), np.uint32)
    scaled = np.empty_like(hashes)
    for i, (a, b) in enumerate(zip(*_coefficients(n))):
        np.multiply(hashes, a, out=scaled)
        np.add(scaled, b, out=scaled)
        np.right_shift(scaled, U64(32), out=scaled)
        out[:, i] = np.minimum.reduceat(scaled, at)
    return out


def _packed(minima: np.ndarray) -> np.ndarray:
    """Low bits of the minima, ``LANES`` to a 64-bit word; the last word is filled up with zero lanes."""
    n, k = minima.shape
    words = -(-k // LANES)
    low = np.zeros((n, words * LANES), U64)
    low[:, :k] = minima & ((1 << LOW_BITS) - 1)
    shifts = (np.arange(LANES, dtype=U64) * U64(LOW_BITS))[None, None, :]
    return (low.reshape(n, words, LANES) << shifts).sum(axis=2, dtype=U64)


def signatures(docs: DataFrame, shingle: int, bands: int, rows: int) -> DataFrame:
    """``doc_id, n_shingles``, a 128-bit fingerprint of the set, the packed signature and the band keys.

    A text without words has no shingles, no fingerprint and no keys.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in text_slices(batch, limit=_SLICE):
                hashes, starts = distinct_shingles(part.column("text"), shingle)
                sizes = np.diff(starts)
                full = sizes > 0
                fps = [_sums(mix(hashes ^ U64(s)), starts).view(np.int64) for s in (0x51ED270B, 0x2545F491)]
                n = int(full.sum())
                if n:
                    minima = _minima(hashes, starts, bands * rows)
                    sig = _packed(minima).view(np.int64)
                    keys = np.empty((n, bands), U64)
                    for b in range(bands):
                        key = np.full(n, (b + 1) * 0x9E3779B97F4A7C15 % (1 << 64), U64)
                        for r in range(rows):
                            key = mix(key + minima[:, b * rows + r].astype(U64) * U64(0xD6E8FEB86659FD93) + U64(r))
                        keys[:, b] = key
                    keys = keys.view(np.int64)
                else:
                    sig, keys = np.zeros((0, 1), np.int64), np.zeros((0, bands), np.int64)

                def lists(values: np.ndarray) -> pa.Array:
                    lengths = np.where(full, values.shape[1], 0)
                    offsets = np.concatenate([[0], np.cumsum(lengths)]).astype(np.int32)
                    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values.reshape(-1)))

                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("doc_id"), pa.array(sizes.astype(np.int64)),
                        pa.array(fps[0], mask=~full), pa.array(fps[1], mask=~full), lists(sig), lists(keys),
                    ],
                    names=["doc_id", "n_shingles", "fp_a", "fp_b", "sig", "bands"],
                )

    schema = "doc_id long, n_shingles long, fp_a long, fp_b long, sig array<long>, bands array<long>"
    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, schema)


def estimated_similarity(a: str, b: str, n_minima: int) -> Column:
    """Similarity by bit counts of two packed signatures, corrected for chance agreement of lanes."""
    words = -(-n_minima // LANES)
    ones = F.lit(sum(1 << (LOW_BITS * i) for i in range(LANES))).cast("long")
    different = F.lit(0)
    for w in range(words):
        x = F.col(a)[w].bitwiseXOR(F.col(b)[w])
        folded = x
        for s in range(1, LOW_BITS):
            folded = folded.bitwiseOR(F.shiftrightunsigned(x, s))
        different = different + F.bit_count(folded.bitwiseAND(ones))
    chance = 1.0 / (1 << LOW_BITS)
    return ((1.0 - different / F.lit(float(n_minima))) - chance) / (1.0 - chance)


def similar(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    """Whether two ascending arrays without repeats reach the similarity."""
    if len(a) > len(b):
        a, b = b, a
    if len(a) == 0 or 100 * len(a) < percent * len(b):
        return False
    at = np.searchsorted(b, a)
    common = int((b[np.minimum(at, len(b) - 1)] == a).sum())
    return 100 * common >= percent * (len(a) + len(b) - common)


def shingle_sets(docs: DataFrame, shingle: int) -> DataFrame:
    """``doc_id, shingles``: each full set as ascending 64-bit numbers in a binary."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in text_slices(batch, limit=_SLICE):
                hashes, starts = distinct_shingles(part.column("text"), shingle)
                offsets = pa.py_buffer((starts * 8).astype(np.int32))
                sets = pa.Array.from_buffers(pa.binary(), part.num_rows, [None, offsets, pa.py_buffer(hashes)])
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), sets], names=["doc_id", "shingles"])

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, "doc_id long, shingles binary")


def _confirm(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs ``(u, v)`` whose full sets reach the similarity."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            left, right = batch.column("a"), batch.column("b")
            good = [
                similar(np.frombuffer(x.as_buffer(), U64), np.frombuffer(y.as_buffer(), U64), percent)
                for x, y in zip(left, right)
            ]
            yield batch.select(["u", "v"]).filter(pa.array(good, pa.bool_()))

    a = sets.select(F.col("doc_id").alias("u"), F.col("shingles").alias("a"))
    b = sets.select(F.col("doc_id").alias("v"), F.col("shingles").alias("b"))
    return pairs.join(a, "u").join(b, "v").select("u", "v", "a", "b").mapInArrow(run, "u long, v long")


def _forest(n: int, links: Iterator[tuple[int, int]]) -> list[tuple[int, int]]:
    """Those links that join two trees."""
    parent = list(range(n))

    def root(x: int) -> int:
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    kept = []
    for i, j in links:
        a, b = root(i), root(j)
        if a != b:
            parent[a] = b
            kept.append((i, j))
    return kept


def block_links(sets: list[np.ndarray], n_left: int, percent: int) -> Iterator[tuple[int, int]]:
    """Links between the first ``n_left`` sets and the rest (or among all, if there is no rest).

    Shared shingles are counted by posting lists of the right side, a shingle at a
    time for all its holders, so memory is one row of counts.
    """
    right_at = n_left if n_left < len(sets) else 0
    right = sets[right_at:]
    sizes = np.array([len(s) for s in right], np.int64)
    flat = np.concatenate(right) if right else np.zeros(0, U64)
    holder = np.repeat(np.arange(len(right)), sizes)
    order = np.argsort(flat, kind="stable")
    flat, holder = flat[order], holder[order]
    for i in range(n_left):
        s = sets[i]
        lo, hi = np.searchsorted(flat, s, "left"), np.searchsorted(flat, s, "right")
        length = hi - lo
        total = int(length.sum())
        if not total:
            continue
        at = np.arange(total) - np.repeat(np.cumsum(length) - length, length) + np.repeat(lo, length)
        common = np.bincount(holder[at], minlength=len(right))
        good = 100 * common >= percent * (len(s) + sizes - common)
        for j in np.flatnonzero(good & (common > 0)):
            if right_at or j > i:
                yield i, right_at + int(j)


def _settle(groups: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Spanning links of work groups ``(g, doc_id, label)``, compared block by block.

    A group's members are numbered in order of label and id and cut into blocks of
    ``BLOCK``; each pair of blocks that holds several labels is one unit of work.
    """
    counted = groups.groupBy("g").agg(F.count("*").alias("n"))
    # Numbered within a bucket of the label's and id's hash, so no group is sorted in one task.
    spread = groups.join(counted, "g").withColumn("blocks", F.ceil(F.col("n") / BLOCK).cast("int"))
    placed = spread.withColumn("block", F.pmod(F.xxhash64("doc_id"), F.col("blocks")).cast("int"))
    others = F.sequence(F.lit(0), F.col("blocks") - 1)
    units = placed.select(
        "g", "doc_id", "label", "block", F.explode(others).alias("other")
    ).select(
        "g", "doc_id", "label", "block", F.least("block", "other").alias("x"), F.greatest("block", "other").alias("y")
    )
    work = units.join(sets, "doc_id")

    def run(table: pa.Table) -> pa.Table:
        block = table.column("block").to_numpy()
        x, y = table.column("x")[0].as_py(), table.column("y")[0].as_py()
        order = np.argsort(block, kind="stable")
        ids, labels = table.column("doc_id").to_numpy()[order], table.column("label").to_numpy()[order]
        out: list[tuple[int, int]] = []
        if len(np.unique(labels)) > 1:
            column = table.column("shingles").take(pa.array(order))
            sets_ = [np.frombuffer(v.as_buffer(), U64) for v in column]
            n_left = int((block == x).sum()) if x != y else len(sets_)
            links = ((i, j) for i, j in block_links(sets_, n_left, percent) if labels[i] != labels[j])
            out = _forest(len(sets_), links)
        u = [int(ids[i]) for i, _ in out]
        v = [int(ids[j]) for _, j in out]
        return pa.table({"u": pa.array(u, pa.int64()), "v": pa.array(v, pa.int64())})

    return work.groupBy("g", "x", "y").applyInArrow(run, "u long, v long")


def near_duplicates(
    docs: DataFrame, shingle: int = 5, percent: int = 80, bands: int = 40, rows: int = 6
) -> DataFrame:
    """One row per row of ``docs``: ``doc_id, n_shingles, component_id, kept``.

    Documents are linked when ``100 * common shingles >= percent * all shingles`` of
    the two sets. ``component_id`` is the smallest id that links lead to, ``kept``
    marks the document of that id. At the threshold a link of two documents is a
    candidate with probability ``1 - (1 - s ** rows) ** bands``, ``s = percent / 100``.

    - A null or empty text, or one without words, has 0 shingles and is linked with nothing.
    - Fewer words than ``shingle`` make the whole sequence one shingle.
    - Rows with one ``doc_id`` are one document, linked through any of their texts.
    - A null ``doc_id`` takes no part: no component, kept.
    - Other columns of ``docs`` are not read. An empty table gives no rows.
    """
    plain = docs.select("doc_id", "text")
    sigs = materialize(signatures(plain, shingle, bands, rows), "signatures")
    known = sigs.filter("n_shingles > 0 and doc_id is not null")
    fingerprint = ["fp_a", "fp_b", "n_shingles"]
    classes = known.groupBy(*fingerprint).agg(F.min("doc_id").alias("rep"), F.count("*").alias("copies"))
    member = known.select("doc_id", *fingerprint).join(classes, fingerprint).select("doc_id", "rep", "copies")
    member = materialize(member, "members")
    # A document with several texts may be in several classes, and links them.
    owned = member.select("doc_id", "rep").distinct()
    several = owned.groupBy("doc_id").agg(F.count("*").alias("n")).filter("n > 1").select("doc_id")
    bridges = owned.join(several, "doc_id", "left_semi").select(F.col("rep").alias("u"), F.col("doc_id").alias("v"))

    first = known.join(member.filter("doc_id = rep").select("doc_id").distinct(), "doc_id", "left_semi")
    keyed = first.select("doc_id", F.explode("bands").alias("key"))
    hubs = keyed.groupBy("key").agg(F.min("doc_id").alias("hub"), F.max("doc_id").alias("top"), F.count("*").alias("n"))
    hubs = hubs.filter("top > hub").select("key", "hub", "n")
    bucketed = materialize(keyed.join(hubs, "key").select("key", "doc_id", "hub", "n"), "buckets")

    star = bucketed.filter("doc_id != hub").select(F.col("hub").alias("u"), F.col("doc_id").alias("v")).distinct()
    sig = first.select("doc_id", "sig")
    with_sigs = star.join(sig.select(F.col("doc_id").alias("u"), F.col("sig").alias("sig_u")), "u").join(
        sig.select(F.col("doc_id").alias("v"), F.col("sig").alias("sig_v")), "v"
    )
    likely = with_sigs.filter(estimated_similarity("sig_u", "sig_v", bands * rows) >= percent / 100 - SLACK)
    likely = materialize(likely.select("u", "v").distinct(), "likely")

    # Full sets only of documents that may need them: in a likely pair, or in a bucket of three and more.
    needed = likely.select(F.col("u").alias("doc_id")).union(likely.select("v"))
    needed = needed.union(bucketed.filter("n > 2").select("doc_id")).distinct()
    sets = materialize(shingle_sets(plain.join(needed, "doc_id", "left_semi"), shingle).filter(F.octet_length("shingles") > 0), "sets")
    # A document with several texts joins its links once per text.
    links = materialize(_confirm(likely, sets, percent).distinct(), "confirmed")

    label = materialize(components(links.union(bridges)), "labels")
    open_rows = bucketed.filter("n > 2").select("key", "doc_id", "hub").join(
        label.select(F.col("node").alias("doc_id"), "label"), "doc_id", "left"
    ).withColumn("label", F.coalesce("label", "doc_id"))
    split = open_rows.groupBy("key").agg(F.min("label").alias("lo"), F.max("label").alias("hi")).filter("lo < hi")
    unsettled = materialize(open_rows.join(split.select("key"), "key", "left_semi"), "unsettled")
    if not unsettled.isEmpty():
        # Overlapping buckets are one group of work, so no pair is compared once per band.
        group = components(unsettled.select(F.col("hub").alias("u"), F.col("doc_id").alias("v")))
        rows_ = unsettled.select("doc_id", "label").distinct().join(
            group.select(F.col("node").alias("doc_id"), F.col("label").alias("g")), "doc_id"
        )
        label = _joined_labels(label, materialize(_settle(rows_, sets, percent), "settled"))
    # Copies have the label of their class's first document.
    first_class = owned.groupBy("doc_id").agg(F.min("rep").alias("rep"))
    named = sigs.select("doc_id", "n_shingles").join(first_class, "doc_id", "left").join(
        label.select(F.col("node").alias("rep"), F.col("label").alias("_label")), "rep", "left"
    )
    component = F.coalesce("_label", "rep", "doc_id")
    kept = F.coalesce(F.col("doc_id") == component, F.lit(True))
    return named.select("doc_id", "n_shingles", component.alias("component_id"), kept.alias("kept"))


def _joined_labels(label: DataFrame, links: DataFrame) -> DataFrame:
    """Labels after further links, which are followed between whole components."""

    def labelled(side: str) -> DataFrame:
        return label.select(F.col("node").alias(side), F.col("label").alias(f"_{side}"))

    between = links.join(labelled("u"), "u", "left").join(labelled("v"), "v", "left").select(
        F.coalesce("_u", "u").alias("u"), F.coalesce("_v", "v").alias("v")
    )
    merged = materialize(components(between), "merged")
    new = merged.select(F.col("node").alias("label"), F.col("label").alias("_new"))
    old = label.join(new, "label", "left").select("node", F.coalesce("_new", "label").alias("label"))
    return old.union(merged.join(label.select("node"), "node", "left_anti").select("node", "label"))
