"""Passages that repeat across documents, by a sparse suffix array.

Suffixes are kept only at anchors: positions whose ``GRAM``-word hash is the
smallest of some window, chosen by content alone. Every passage of ``least``
words holds an anchor, the same in each of its copies. Anchors that occur once in
the corpus cannot lie in a repeat and go first. Suffixes at anchors that occur
twice carry the words that decide about a passage of ``least`` words around the
anchor, are sorted by anchor and following words, and are compared with their
neighbours; matches are extended to the left.

With three and more occurrences a suffix's neighbours need not be the ones it
shares a passage with. There every window of ``least`` words around the anchor is
decided by its hash: a block sends each different one once to the bucket of the
hash, and the bucket answers which ones several documents have. Buckets are even,
since they go by the hash of the whole window, also where a third of the corpus
shares an anchor.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .blocks import block_rows, bucket_bits, buckets_of, gathered, pack, pack_ascending, unpack, word_sequence
from .storage import stored
from .words import U64, mix, pair

#: Words of the anchor hash.
GRAM = 16
#: Occurrences from which the windows around an anchor are decided by their hashes; neighbours are exact for fewer than 3.
HOT = 3


def _sliding(values: np.ndarray, width: int, best) -> np.ndarray:
    """``best`` (np.minimum or np.maximum) of every window of ``width`` values."""
    out, done = values, 1
    while 2 * done <= width:
        out = best(out[: len(out) - done], out[done:])
        done *= 2
    return best(out[: len(out) - (width - done)], out[width - done :]) if done < width else out


def grams(seq: np.ndarray, size: int) -> np.ndarray:
    """Hashes of all runs of ``size`` words."""
    n = len(seq) - size + 1
    if n < 1:
        return np.zeros(0, U64)
    out = seq[:n].copy()
    for k in range(1, size):
        out = pair(out, seq[k : n + k])
    return out


def anchors(seq: np.ndarray, starts: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
    """Positions in ``seq`` and hashes of the anchors of texts that start at ``starts``."""
    width = least - GRAM + 1
    keys = grams(seq, GRAM)
    if len(keys) < width:
        return np.zeros(0, np.int64), np.zeros(0, U64)
    lowest = _sliding(keys, width, np.minimum)
    # Windows that reach into the next text are no windows.
    own = np.searchsorted(starts, np.arange(len(lowest)), "right")
    valid = np.arange(len(lowest)) + least <= starts[np.minimum(own, len(starts) - 1)]
    lowest = np.where(valid, lowest, U64(0))
    ends = np.zeros(width - 1, U64)
    around = _sliding(np.concatenate([ends, lowest, ends]), width, np.maximum)
    at = np.flatnonzero((around == keys) & (around > 0))
    return at, keys[at]


def _ask(blocks: DataFrame, least: int, bits: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                starts = np.concatenate([[0], np.cumsum(row["sizes"])]).astype(np.int64)
                kinds, counts = np.unique(anchors(word_sequence(row), starts, least)[1], return_counts=True)
                rows = [
                    (b, row["block"], s.stop - s.start, pack_ascending(kinds[s]), pack(counts[s].astype(np.int64)))
                    for b, s in buckets_of(kinds, bits)
                ]
                columns = list(zip(*rows)) or [()] * 5
                types = (pa.int32(), pa.int64(), pa.int64(), pa.binary(), pa.binary())
                names = ["bucket", "block", "n", "keys", "a"]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=names)

    return blocks.mapInArrow(run, "bucket int, block long, n long, keys binary, a binary")


def _totals(table: pa.Table) -> pa.Table:
    rows, kinds, at, ends = gathered(table)
    counts = np.concatenate([unpack(r["a"], r["n"], np.int64) for r in rows])
    totals = np.bincount(at, counts, minlength=len(kinds)).astype(np.int64)[at]
    return pa.table({
        "bucket": pa.array([r["bucket"] for r in rows], pa.int32()),
        "block": pa.array([r["block"] for r in rows], pa.int64()),
        "n": pa.array([r["n"] for r in rows], pa.int64()),
        "a": pa.array([pack(totals[e - r["n"] : e]) for r, e in zip(rows, ends)], pa.binary()),
    })


_SUFFIX = (
    "g long, doc_id long, th long, at int, n_words int, after binary, before binary, by_after boolean, by_before boolean, "
    "first int, stop int"
)


def _counted_anchors(rows: list[dict], least: int) -> tuple:
    """A block's row, text starts, words, and its anchors' places, hashes and occurrences in the corpus."""
    own = next(r for r in rows if r["seq"] is not None)
    answers = sorted((r for r in rows if r["seq"] is None and r.get("w") is None), key=lambda r: r["bucket"])
    starts = np.concatenate([[0], np.cumsum(own["sizes"])]).astype(np.int64)
    seq = word_sequence(own)
    place, keys = anchors(seq, starts, least)
    kinds, inverse = np.unique(keys, return_inverse=True)
    counts = np.concatenate([np.zeros(0, np.int64)] + [unpack(r["a"], r["n"], np.int64) for r in answers])
    return own, starts, seq, place, keys, counts[inverse] if len(kinds) else np.zeros(0, np.int64)


def _identities(own: dict) -> np.ndarray:
    """What tells a block's documents apart: their id and text."""
    ids = np.array([-1 if x is None else x for x in own["doc_id"]], np.int64)
    null = np.array([x is None for x in own["doc_id"]], bool)
    return mix(mix(ids.view(U64) + U64(0x9E3779B97F4A7C15) * null) + mix(np.array(own["th"], np.int64).view(U64)))


def _hot_windows(rows: list[dict], least: int, hot_from: int) -> tuple:
    """A block's row, text starts, and the windows of ``least`` words around its hot anchors: first words, texts, hashes."""
    own, starts, seq, place, _, times = _counted_anchors(rows, least)
    place = place[times >= hot_from]
    doc = np.searchsorted(starts, place, "right") - 1
    edge = np.zeros(len(seq) + 1, np.int64)
    lo = np.maximum(place + GRAM - least, starts[doc])
    hi = np.minimum(place, starts[doc + 1] - least)
    np.add.at(edge, lo, 1)
    np.add.at(edge, hi + 1, -1)
    at = np.flatnonzero(np.cumsum(edge) > 0)
    hashes = grams(seq, least)[at] if len(at) else np.zeros(0, U64)
    return own, starts, at, np.searchsorted(starts, at, "right") - 1, hashes


def _ask_windows(blocks: DataFrame, totals: DataFrame, least: int, bits: int) -> DataFrame:
    """Each different window around a block's hot anchors: its hash, and the one document or -1 for several.

    Documents are numbered in the block (``a``); ``b`` has what tells them apart, by id and text.
    """
    hot_from = HOT

    def run(table: pa.Table) -> pa.Table:
        own, _, _, doc, hashes = _hot_windows(table.to_pylist(), least, hot_from)
        same = _identities(own)
        kinds, first, inverse = np.unique(hashes, return_index=True, return_inverse=True)
        holder = doc[first].astype(np.int32)
        holder[inverse[same[doc] != same[doc[first]][inverse]]] = -1
        rows = []
        for b, s in buckets_of(kinds, bits):
            used, number = np.unique(holder[s], return_inverse=True)
            several = int(len(used) > 0 and used[0] < 0)
            told = (number - several).astype(np.int32)
            rows.append((b, own["block"], s.stop - s.start, pack_ascending(kinds[s]), pack(told), same[used[several:]].tobytes()))
        columns = list(zip(*rows)) or [()] * 6
        types = (pa.int32(), pa.int64(), pa.int64(), pa.binary(), pa.binary(), pa.binary())
        return pa.table([pa.array(c, t) for c, t in zip(columns, types)], names=["bucket", "block", "n", "keys", "a", "b"])

    both = blocks.unionByName(totals, allowMissingColumns=True)
    return both.groupBy("block").applyInArrow(run, "bucket int, block long, n long, keys binary, a binary, b binary")


def _shared_windows(table: pa.Table) -> pa.Table:
    """For each block a bit for each window it asked for: whether several documents have it."""
    rows, kinds, at, ends = gathered(table)
    shared = np.zeros(len(kinds), bool)
    holder = np.zeros(len(at), U64)
    several = np.zeros(len(at), bool)
    for r, e in zip(rows, ends):
        told = unpack(r["a"], r["n"], np.int32)
        several[e - r["n"] : e] = told < 0
        known = np.append(np.frombuffer(r["b"], U64), U64(0))
        holder[e - r["n"] : e] = known[told]
    shared[at[several]] = True
    first = np.zeros(len(kinds), U64)
    first[at] = holder
    shared[at[holder != first[at]]] = True
    return pa.table({
        "bucket": pa.array([r["bucket"] for r in rows], pa.int32()),
        "block": pa.array([r["block"] for r in rows], pa.int64()),
        "n": pa.array([r["n"] for r in rows], pa.int64()),
        "w": pa.array([np.packbits(shared[at[e - r["n"] : e]]).tobytes() for r, e in zip(rows, ends)], pa.binary()),
    })


def _window_spans(blocks: DataFrame, totals: DataFrame, windows: DataFrame, least: int) -> DataFrame:
    """Stretches covered by windows around hot anchors that several documents have."""
    hot_from = HOT

    def run(table: pa.Table) -> pa.Table:
        rows = table.to_pylist()
        own, starts, at, doc, hashes = _hot_windows(rows, least, hot_from)
        told = sorted((r for r in rows if r["w"] is not None), key=lambda r: r["bucket"])
        bits = [np.unpackbits(np.frombuffer(r["w"], np.uint8), count=r["n"]) for r in told]
        shared = np.concatenate([np.zeros(0, np.uint8), *bits]).astype(bool)
        found = shared[np.unique(hashes, return_inverse=True)[1]] if len(hashes) else np.zeros(0, bool)
        at, doc = at[found], doc[found]
        new = np.ones(len(at), bool)
        new[1:] = (np.diff(at) > least) | (np.diff(doc) > 0)
        head = np.flatnonzero(new)
        tail = np.append(head[1:], len(at))[: len(head)] - 1
        d = doc[head]
        ids = pa.array(own["doc_id"], pa.int64()).take(pa.array(d))
        return pa.table({
            "doc_id": ids,
            "th": pa.array(np.array(own["th"], np.int64)[d]),
            "n_words": pa.array(np.array(own["sizes"], np.int32)[d]),
            "first": pa.array((at[head] - starts[d]).astype(np.int32)),
            "stop": pa.array((at[tail] - starts[d] + least).astype(np.int32)),
        })

    both = blocks.unionByName(totals, allowMissingColumns=True).unionByName(windows, allowMissingColumns=True)
    return both.groupBy("block").applyInArrow(run, "doc_id long, th long, n_words int, first int, stop int")


def _suffixes(blocks: DataFrame, totals: DataFrame, least: int) -> DataFrame:
    """A row for each suffix at an anchor that occurs more than once and is not hot, and spans that a block settles itself.

    Suffixes of a block that agree in all their words and belong to several documents
    match as far as they are compared. They give their spans here, and one of them
    goes on as a neighbour for other blocks.

    ``after`` has the words after the anchor, ``before`` the ones in front of it
    backwards, as 32-bit numbers whose bytes sort as they do; zeros stand beyond
    the text. The anchor of ``GRAM`` words lies between them, so ``least - GRAM``
    words on each side decide about every passage of ``least`` words.
    """
    side = least - GRAM
    hot_from = HOT

    def run(table: pa.Table) -> pa.Table:
        rows = table.to_pylist()
        own, starts, seq, place, keys, times = _counted_anchors(rows, least)
        repeated = (times > 1) & (times < hot_from)
        place, keys, times = place[repeated], keys[repeated], times[repeated]
        doc = np.searchsorted(starts, place, "right") - 1
        first, end = starts[doc], starts[doc + 1]
        short = ((mix(seq) >> U64(32)) | U64(1)).astype(">u4") if len(seq) else np.zeros(1, ">u4")
        steps = np.arange(side)
        right = place[:, None] + GRAM + steps
        after = np.where(right < end[:, None], short[np.minimum(right, len(short) - 1)], 0).astype(">u4")
        left = place[:, None] - 1 - steps
        before = np.where(left >= first[:, None], short[np.maximum(left, 0)], 0).astype(">u4")

        def rolled(words: np.ndarray, n: int, seed: int) -> np.ndarray:
            out = keys + U64(seed)
            for k in range(n):
                out = pair(out, words[:, k].astype(U64))
            return out

        def binaries(values: np.ndarray) -> pa.Array:
            data = pa.py_buffer(np.ascontiguousarray(values).tobytes())
            return pa.Array.from_buffers(pa.binary(4 * side), len(values), [None, data]).cast(pa.binary())

        ids, th = np.array([-1 if x is None else x for x in own["doc_id"]], np.int64), np.array(own["th"], np.int64)
        null = np.array([x is None for x in own["doc_id"]], bool)
        sizes = np.array(own["sizes"], np.int32)
        whole = rolled(after, side, 3) ^ mix(rolled(before, side, 4))
        kinds, at_first, kind = np.unique(whole, return_index=True, return_inverse=True)
        # A document is its id and text, so copies of one row do not make several.
        same = _identities(own)[doc] if len(doc) else whole
        shared = np.zeros(len(kinds), bool)
        shared[kind[same != same[at_first][kind]]] = True
        settled = shared[kind]
        goes = ~settled
        goes[at_first] = True
        at = place - first
        left_room, right_room = np.minimum(at, side), np.minimum(end - place - GRAM, side)
        span = np.flatnonzero(settled & (left_room + GRAM + right_room >= least))
        spans = pa.table({
            "g": pa.array(same[span].view(np.int64)),
            "doc_id": pa.array(ids[doc[span]], pa.int64(), mask=null[doc[span]]),
            "th": pa.array(th[doc[span]]),
            "n_words": pa.array(sizes[doc[span]]),
            "first": pa.array((at - left_room)[span].astype(np.int32)),
            "stop": pa.array((at + GRAM + right_room)[span].astype(np.int32)),
        })

        d = doc[goes]
        out = pa.table({
            "g": pa.array(keys[goes].view(np.int64)),
            "doc_id": pa.array(ids[d], pa.int64(), mask=null[d]),
            "th": pa.array(th[d]),
            "at": pa.array((place - first)[goes].astype(np.int32)),
            "n_words": pa.array(sizes[d]),
            "after": binaries(after[goes]),
            "before": binaries(before[goes]),
            "by_after": pa.array(np.full(len(d), True)),
            # Two suffixes are neighbours in either order.
            "by_before": pa.array(times[goes] > 2),
        })
        columns = pa.schema([
            ("g", pa.int64()), ("doc_id", pa.int64()), ("th", pa.int64()), ("at", pa.int32()), ("n_words", pa.int32()),
            ("after", pa.binary()), ("before", pa.binary()), ("by_after", pa.bool_()), ("by_before", pa.bool_()),
            ("first", pa.int32()), ("stop", pa.int32()),
        ])
        return pa.concat_tables([out, spans, columns.empty_table()], promote_options="default").select(columns.names)

    both = blocks.unionByName(totals, allowMissingColumns=True)
    return both.groupBy("block").applyInArrow(run, _SUFFIX)


def _equal_words(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """How many leading columns agree."""
    same = a == b
    return np.where(same.all(axis=1), same.shape[1], same.argmin(axis=1))


def _compare(least: int):
    """Spans around sorted suffixes and their nearest neighbours in other documents, on both sides."""
    side = least - GRAM

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: pa.Table | None = None
        done = 0  # rows of ``held`` whose spans are given already; they only serve as neighbours

        def spans(table: pa.Table, lo: int, hi: int) -> pa.RecordBatch:
            n = table.num_rows
            g = table.column("g").to_numpy()
            # Copies of one document row are one document: compared by id and text.
            key = [table.column(c).combine_chunks() for c in ("doc_id", "th")]
            ids, th = key[0].fill_null(-1).to_numpy(), key[1].to_numpy()
            null = key[0].is_null().to_numpy(zero_copy_only=False)
            new = np.ones(n, bool)
            new[1:] = (ids[1:] != ids[:-1]) | (th[1:] != th[:-1]) | (null[1:] != null[:-1]) | (g[1:] != g[:-1])
            start = np.maximum.accumulate(np.where(new, np.arange(n), 0))
            last = np.append(new[1:], True)
            stop = np.minimum.accumulate(np.where(last, np.arange(n), n)[::-1])[::-1]

            def words(name: str) -> np.ndarray:
                column = table.column(name).combine_chunks().cast(pa.binary())
                data = np.frombuffer(column.buffers()[2], np.uint8)
                offset = np.frombuffer(column.buffers()[1], np.int32)[column.offset]
                return data[offset : offset + n * 4 * side].view("<u4").reshape(n, side)

            after, before = words("after"), words("before")
            at = table.column("at").to_numpy().astype(np.int64)
            room = table.column("n_words").to_numpy() - at - GRAM
            rows = np.arange(lo, hi)
            best = np.zeros((hi - lo, 2), np.int64)
            size = np.zeros(hi - lo, np.int64)
            for other in (start[lo:hi] - 1, stop[lo:hi] + 1):
                real = (other >= 0) & (other < n)
                i, j = rows[real], other[real]
                match = g[i] == g[j]
                i, j = i[match], j[match]
                right = np.minimum(_equal_words(after[i], after[j]), room[i])
                left = np.minimum(_equal_words(before[i], before[j]), at[i])
                total = right + left + GRAM
                better = total > size[i - lo]
                i, right, left, total = i[better], right[better], left[better], total[better]
                size[i - lo] = total
                best[i - lo] = np.stack([at[i] - left, at[i] + GRAM + right], axis=1)
            good = np.flatnonzero(size >= least)
            taken = table.select(["doc_id", "th", "n_words"]).slice(lo, hi - lo).take(pa.array(good)).combine_chunks()
            taken = taken.append_column("first", pa.array(best[good, 0].astype(np.int32)))
            taken = taken.append_column("stop", pa.array(best[good, 1].astype(np.int32)))
            return pa.RecordBatch.from_arrays([c.combine_chunks() if c.num_chunks != 1 else c.chunk(0) for c in taken.columns], names=taken.column_names)

        for batch in batches:
            table = pa.Table.from_batches([batch])
            held = table if held is None else pa.concat_tables([held, table]).combine_chunks()
            n = held.num_rows
            if not n:
                continue
            g, th = held.column("g").to_numpy(), held.column("th").to_numpy()
            # The last run of one document may go on in the next batch; it waits, with the row before it.
            same = (g == g[-1]) & (th == th[-1])
            run_at = n - int(np.argmin(same[::-1])) if not same.all() else 0
            if run_at > done:
                yield spans(held, done, run_at)
            keep = max(0, run_at - 1)
            held, done = held.slice(keep), run_at - keep
        if held is not None and held.num_rows > done:
            yield spans(held, done, held.num_rows)

    return run


def repeated_passages(docs: DataFrame, least: int = 50) -> DataFrame:
    """``doc_id, n_words, n_repeated, spans`` of the documents that share passages with others.

    ``spans`` is ``first:stop`` of each stretch covered by passages of ``least`` words
    or more that occur in another document too, in words from 0, comma-joined;
    ``n_repeated`` counts their words. Words are compared with A-Z lower-cased.

    - Rows that agree in ``doc_id`` and text are one document, with one row.
    - Texts under one ``doc_id`` that differ are different documents.
    - Null ids count as one id. Null texts and texts of fewer than ``least`` words repeat nothing.
    - Documents without repeats have no row; other columns are not read.
    - An empty table gives no rows. A text of any length is compared whole: one longer than a block is a block of its own.
    """
    if least < 2 * GRAM:
        raise ValueError(f"least must be at least {2 * GRAM}")
    plain = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).withColumn("th", F.xxhash64("text"))
    blocks = stored(block_rows(plain, {"doc_id": "long", "th": "long"}), "suffix-blocks")
    total = blocks.agg(F.coalesce(F.sum("n_tokens"), F.lit(0)).alias("n")).first()["n"]
    totals = _ask(blocks, least, bucket_bits(total // 4)).groupBy("bucket").applyInArrow(_totals, "bucket int, block long, n long, a binary")
    totals = stored(totals, "suffix-totals")
    asked = _ask_windows(blocks, totals, least, bucket_bits(total))
    windows = asked.groupBy("bucket").applyInArrow(_shared_windows, "bucket int, block long, n long, w binary")
    around = _window_spans(blocks, totals, windows, least)
    suffixes = _suffixes(blocks, totals, least)
    parts = docs.sparkSession.conf.get("spark.sql.shuffle.partitions", "200")
    dealt = suffixes.repartition(int(parts) if parts.isdigit() else 200, "g")
    schema = "doc_id long, th long, n_words int, first int, stop int"
    by_after = dealt.filter("by_after").drop("first", "stop").sortWithinPartitions("g", "after", "before", "doc_id", "th").mapInArrow(_compare(least), schema)
    by_before = dealt.filter("by_before").drop("first", "stop").sortWithinPartitions("g", "before", "after", "doc_id", "th").mapInArrow(_compare(least), schema)
    settled = dealt.filter("first is not null").select("doc_id", "th", "n_words", "first", "stop")
    # Stretches of one document that overlap or touch become one.
    found = by_after.union(by_before).union(settled).union(around).groupBy("doc_id", "th").agg(
        F.max("n_words").cast("long").alias("n_words"), F.array_sort(F.collect_set(F.struct("first", "stop"))).alias("s")
    )
    merged = F.expr(
        "aggregate(s, named_struct('done', cast(array() as array<string>), 'n', 0L, 'a', -1, 'b', -1), (t, x) -> "
        "if(x.first <= t.b, named_struct('done', t.done, 'n', t.n, 'a', t.a, 'b', greatest(t.b, x.stop)), "
        "named_struct('done', if(t.b < 0, t.done, concat(t.done, array(concat(t.a, ':', t.b)))), 'n', t.n + t.b - t.a, 'a', x.first, 'b', x.stop)), "
        "t -> named_struct('n', t.n + t.b - t.a, 'spans', array_join(concat(t.done, array(concat(t.a, ':', t.b))), ',')))"
    )
    return found.withColumn("m", merged).select("doc_id", "n_words", F.col("m.n").alias("n_repeated"), F.col("m.spans").alias("spans"))
