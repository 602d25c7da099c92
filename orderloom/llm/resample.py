"""Importance resampling towards a target distribution of hashed word n-grams.

Features are runs of one to three words, counted in buckets by the ``crc32`` of their bytes. The array
of bucket counts of the corpus and that of the target give every bucket a gain; a document's weight is
the sum over its features. Noise drawn from its id makes the highest scores a sample without
replacement. The last score that is drawn is found by a distributed quickselect; only the documents up
to it are sorted and ranked.
"""

from __future__ import annotations

import math
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .ranks import ranked
from .storage import stored
from .words import text_slices

BUCKETS = 10_000
LONGEST = 3
#: Text that is worked on at a time; a longer text is cut between words.
SECTION_BYTES = 4 << 20
#: Tasks that add up the count arrays of all others.
ADDERS = 32
#: Random keys that one round of the selection divides by.
PIVOTS = 15

_BYTE = np.arange(256)
#: Bytes of words: digits, letters, and everything beyond ASCII; and bytes with A-Z lower-cased.
_IS_WORD = (_BYTE >= 0x80) | ((_BYTE >= 0x30) & (_BYTE <= 0x39)) | ((_BYTE >= 0x41) & (_BYTE <= 0x5A)) | ((_BYTE >= 0x61) & (_BYTE <= 0x7A))
_LOWER = np.where((_BYTE >= 0x41) & (_BYTE <= 0x5A), _BYTE + 32, _BYTE).astype(np.uint8)
_GAP = re.compile(rb"[\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]")
_WORD = re.compile(rb"[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")


def _crc_step(x: np.ndarray) -> np.ndarray:
    """A ``crc32`` register after one more zero byte."""
    for _ in range(8):
        x = np.where(x & 1, (x >> 1) ^ 0xEDB88320, x >> 1)
    return x


def _zero_tables() -> np.ndarray:
    """``[n, j, b]``: what byte ``j`` of a register, being ``b``, becomes after ``n`` zero bytes; up to 64."""
    now = (_BYTE.astype(np.int64)[None, :] << (8 * np.arange(4))[:, None]).astype(np.int64)
    out = [now]
    for _ in range(64):
        out.append(_crc_step(out[-1]))
    return np.array(out).astype(np.uint32)


_ZEROS = _zero_tables()


def _looked_up(tables: np.ndarray, x: np.ndarray) -> np.ndarray:
    return tables[0][x & 255] ^ tables[1][(x >> 8) & 255] ^ tables[2][(x >> 16) & 255] ^ tables[3][x >> 24]


def after_zeros(x: np.ndarray, n: np.ndarray) -> np.ndarray:
    """Registers ``x`` after ``n`` zero bytes each."""
    at = (n & 63) * 4
    flat = _ZEROS.reshape(-1, 256)
    x = flat[at, x & 255] ^ flat[at + 1, (x >> 8) & 255] ^ flat[at + 2, (x >> 16) & 255] ^ flat[at + 3, x >> 24]
    tables, rest = _ZEROS[64], n >> 6
    while rest.any():
        x = np.where(rest & 1, _looked_up(tables, x), x)
        rest = rest >> 1
        if rest.any():
            tables = np.array([_looked_up(tables, t) for t in tables])
    return x


def joined(a: np.ndarray, b: np.ndarray, size: np.ndarray) -> np.ndarray:
    """``crc32`` of two texts put together, from theirs and the second one's size in bytes."""
    return after_zeros(a, size) ^ b


class Features:
    """The feature buckets of some texts, whose first ``context`` words only begin features.

    ``buckets`` has them text by text; text ``i`` owns ``starts[i]`` to ``starts[i + 1]``, and has ``n_words`` words.
    """

    def __init__(self, texts: pa.Array, context: np.ndarray):
        data = texts.cast(pa.large_binary())
        offsets = np.frombuffer(data.buffers()[1], np.int64)[data.offset : data.offset + len(data) + 1]
        raw = np.frombuffer(data.buffers()[2] or b"", np.uint8)[offsets[0] : offsets[-1]]
        offsets = offsets - offsets[0]
        inside = _IS_WORD[raw]
        begins = inside.copy()
        begins[1:] &= ~inside[:-1]
        full = offsets[:-1][offsets[:-1] < offsets[1:]]
        begins[full] = inside[full]
        at = np.flatnonzero(begins)
        ends = np.concatenate([np.cumsum(inside)[at] - 1, [int(inside.sum())]]).astype(np.int64)
        letters = _LOWER[raw[inside]]
        words = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(at), [None, pa.py_buffer(ends), pa.py_buffer(letters)])
        coded = words.dictionary_encode()
        kinds = coded.dictionary.to_pylist()
        ids = coded.indices.to_numpy(zero_copy_only=False)
        own = np.array([zlib.crc32(w) for w in kinds], np.uint32)[ids] if kinds else np.zeros(0, np.uint32)
        spaced = np.array([zlib.crc32(b" " + w) for w in kinds], np.uint32)[ids] if kinds else own
        size = np.diff(ends) + 1
        first = np.searchsorted(at, offsets)  # the first word of each text
        text = np.repeat(np.arange(len(texts)), np.diff(first))
        place = np.arange(len(at)) - first[text] if len(at) else np.zeros(0, np.int64)
        new = place >= context[text] if len(at) else np.zeros(0, bool)
        # Features by the word that they end in; ``register`` is that of the run before it.
        crcs, owners, run = [own[new]], [text[new]], own
        for k in range(1, LONGEST):
            run = joined(run[:-1], spaced[k:], size[k:]) if len(run) else run
            ends_here = (place[k:] >= k) & new[k:]
            crcs.append(run[ends_here])
            owners.append(text[k:][ends_here])
        crcs, owners = np.concatenate(crcs), np.concatenate(owners)
        order = np.argsort(owners, kind="stable")
        self.buckets = (crcs % BUCKETS).astype(np.int64)[order]
        self.starts = np.concatenate([[0], np.cumsum(np.bincount(owners, minlength=len(texts)))]).astype(np.int64)
        self.n_words = np.diff(first) - context


def _sections(text: bytes) -> Iterator[tuple[bytes, int]]:
    """A long text in sections cut between words, each after the last words of the one before it, and how many these are."""
    start, before = 0, b""
    while start < len(text):
        gap = _GAP.search(text, start + SECTION_BYTES)
        stop = gap.start() if gap else len(text)
        section = before + b" " + text[start:stop]
        yield section, len(_WORD.findall(before))
        before = b" ".join(_last_words(section))
        start = stop


def _last_words(section: bytes) -> list[bytes]:
    """The last words of a section, as many as a feature can begin with."""
    reach = 4096
    while True:
        tail = section[-reach:]
        words = _WORD.findall(tail)
        if reach >= len(section) or len(words) > LONGEST:
            return words[-(LONGEST - 1) :]
        reach *= 4


def feature_parts(batch: pa.RecordBatch) -> Iterator[tuple[np.ndarray, Features]]:
    """The features of a batch's texts in parts of bounded size, with the rows that the part's texts belong to."""
    row = 0
    for part in text_slices(batch, limit=SECTION_BYTES):
        texts = part.column("text").fill_null("").cast(pa.large_binary())
        if part.num_rows == 1 and len(texts[0].as_buffer() or b"") > SECTION_BYTES:
            for section, context in _sections(texts[0].as_py()):
                yield np.array([row]), Features(pa.array([section], pa.large_binary()), np.array([context]))
        else:
            yield np.arange(row, row + part.num_rows), Features(texts, np.zeros(part.num_rows, np.int64))
        row += part.num_rows


def _count_features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts = np.zeros(BUCKETS, np.int64)
    for batch in batches:
        for _, features in feature_parts(batch):
            counts += np.bincount(features.buckets, minlength=BUCKETS)
    yield pa.RecordBatch.from_arrays([pa.array([counts.tobytes()], pa.binary())], names=["counts"])


def _add_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts = np.zeros(BUCKETS, np.int64)
    for batch in batches:
        for row in batch.column("counts"):
            counts += np.frombuffer(row.as_buffer(), np.int64)
    yield pa.RecordBatch.from_arrays([pa.array([counts.tobytes()], pa.binary())], names=["counts"])


def feature_counts(texts: DataFrame) -> np.ndarray:
    """How many features each bucket has over all texts: one array a task, added up by ``ADDERS`` tasks, then here."""
    counted = texts.select(F.col("text").cast("string")).mapInArrow(_count_features, "counts binary")
    added = counted.repartition(ADDERS).mapInArrow(_add_counts, "counts binary")
    return sum((np.frombuffer(r["counts"], np.int64) for r in added.toLocalIterator()), np.zeros(BUCKETS, np.int64))


def gains_of(corpus: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Each bucket's gain: 1000 times the log of how much more often the target has it, smoothed, rounded down."""
    have, want = float(corpus.sum() + BUCKETS), float(target.sum() + BUCKETS)
    ratios = [(t + 1.0) * have / ((s + 1.0) * want) for s, t in zip(corpus.tolist(), target.tolist())]
    return np.array([math.floor(1000 * math.log(r)) for r in ratios], np.int64)


def weighed(docs: DataFrame, gains: np.ndarray) -> DataFrame:
    """``doc_id, n_words, n_features, weight`` of every text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words, features, weights = (np.zeros(batch.num_rows, np.int64) for _ in range(3))
            for rows, part in feature_parts(batch):
                words[rows] += part.n_words
                features[rows] += np.diff(part.starts)
                weights[rows] += np.diff(np.concatenate([[0], np.cumsum(gains[part.buckets])])[part.starts])
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(words), pa.array(features), pa.array(weights)],
                names=["doc_id", "n_words", "n_features", "weight"],
            )

    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return rows.mapInArrow(run, "doc_id long, n_words long, n_features long, weight long")


def noise(seed: int) -> Column:
    """Gumbel noise in thousandths, rounded down, from 32 bits of a hash of the id; a null id counts as empty text."""
    name = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(name, 256), 1, 8), 16, 10).cast("double")
    return F.floor(F.lit(-1000.0) * F.log(-F.log((h + 0.5) / 4294967296.0)))


#: The order of the draw: high scores, then small ids (null last), then few features, then the row's own number.
KEY = {"_low": "-score", "_lost": "doc_id is null", "_id": "coalesce(doc_id, 0)", "n_features": "n_features", "row": "row"}


def _literal(pivot: tuple) -> Column:
    return F.struct(*[F.lit(v).alias(c) for c, v in zip(KEY, pivot)])


def select_key(rows: DataFrame, k: int) -> tuple | None:
    """The ``k``-th smallest key (from 1) of ``rows``, whose keys all differ; None where there are fewer.

    Every round draws some keys at random, counts exactly how many keys lie below each and whether
    it is the one, and goes on between the two pivots around the ``k``-th.
    """
    key = F.struct(*KEY)
    left, turn = rows, 0
    while k > 0:
        drawn = left.select(*KEY, F.xxhash64("row", F.lit(turn)).alias("_draw")).orderBy("_draw", "row").limit(PIVOTS)
        pivots = sorted(tuple(r[c] for c in KEY) for r in drawn.collect())
        if not pivots:
            return None
        below = left.agg(*[F.count_if(key < _literal(p)).alias(str(i)) for i, p in enumerate(pivots)], F.count("*").alias("all")).first()
        ranks = [below[str(i)] + 1 for i in range(len(pivots))]
        if k in ranks:
            return pivots[ranks.index(k)]
        if k > below["all"]:
            return None
        after = [p for p, r in zip(pivots, ranks) if r < k]
        before = [p for p, r in zip(pivots, ranks) if r > k]
        if after:
            left, k = left.filter(key > _literal(after[-1])).filter(F.col("_low") >= after[-1][0]), k - max(r for r in ranks if r < k)
        if before:
            left = left.filter(key < _literal(before[0])).filter(F.col("_low") <= before[0][0])
        turn += 1
    return None


def resample(docs: DataFrame, target: DataFrame, percent: int = 5, least_words: int = 20, seed: int = 42) -> DataFrame:
    """Scores of all ``docs`` (``doc_id, text``), and the ranks of the drawn ones.

    ``target`` has a column ``text``. Of the ``N`` documents with ``least_words`` words and more the
    ``percent * N // 100`` highest scores are drawn; ties go to the smaller ``doc_id``, a null id comes
    last, and rows with one id and score go by fewer features. Returns ``doc_id, n_words, n_features,
    weight, score, rank``, with a null ``rank`` where a document was not drawn.

    A null or empty text has no features and weight 0. Every row is a document, repeated ones too.
    A text of any length is read whole, in sections. Other columns are not read; an empty table gives
    no rows, an empty target gives gains from its smoothing alone.
    """
    gains = gains_of(feature_counts(docs), feature_counts(target))
    scored = weighed(docs, gains).withColumn("score", F.col("weight") + noise(seed)).withColumn("row", F.monotonically_increasing_id())
    rows = stored(scored.withColumns({c: F.expr(e) for c, e in KEY.items() if c != e}), "scored")
    able = rows.filter(F.col("n_words") >= least_words)
    last = select_key(able, able.count() * percent // 100)
    out = ["doc_id", "n_words", "n_features", "weight", "score"]
    if last is None:
        return rows.select(*out, F.lit(None).cast("long").alias("rank"))
    drawn = (F.col("n_words") >= least_words) & (F.col("_low") <= last[0]) & (F.struct(*KEY) <= _literal(last))
    winners = ranked(rows.filter(drawn), [F.col(c) for c in KEY], "rank", "winners")
    others = rows.filter(~drawn).select(*out, F.lit(None).cast("long").alias("rank"))
    return winners.select(*out, (F.col("rank") + 1).cast("long").alias("rank")).unionByName(others)
