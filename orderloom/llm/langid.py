"""Language of texts by a linear-chain conditional random field over their words.

A word's features are its affixes and inner n-grams (two to five bytes, with
marks at both ends) and the word itself as a lexicon entry, hashed to a fixed
number of weights per language. Neighbouring words are tied by learned transition
weights, so a text may change its language and a doubtful word follows its
neighbours. Words are labelled by forward-backward; a text's language is the one
with the largest mean posterior over its words.

The field is fitted by maximum likelihood on a bounded sample of labelled texts.
Windows of texts in different languages are put one after the other there, which
is what the transitions are learned from.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, LongType, StringType, StructField, StructType

from .storage import named_column
from .words import U64, Words, bytes_hash, mix, text_slices

UNDECIDED = "und"
FEATURE_BITS = 18
NGRAMS = (2, 3, 4, 5)
#: Bounds of the sample that the field is fitted on: languages, texts of each, all texts, characters of a text.
MOST_LANGUAGES, TEXTS_PER_LANGUAGE, TEXTS, TEXT_CHARS = 64, 200, 4000, 20_000
WINDOW, WINDOWS = 16, 4
WORDS_AT_ONCE = 20_000
_TABLES = np.random.default_rng(11).integers(0, 1 << 63, (max(NGRAMS), 256), dtype=np.uint64)


@dataclass(frozen=True)
class Field:
    """A fitted field: its languages, feature weights and transition weights."""

    languages: tuple[str, ...]
    weights: np.ndarray
    transitions: np.ndarray


def word_features(names: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Feature numbers of each word, one word after the other, and where each word's start."""
    parts = [_some_features(part) for part in _word_parts(names)]
    features = np.concatenate([np.zeros(0, np.int32), *[f for f, _ in parts]])
    counts = np.concatenate([np.zeros(0, np.int64), *[np.diff(s) for _, s in parts]])
    return features, np.concatenate([[0], np.cumsum(counts)]).astype(np.int64)


def _word_parts(names: pa.Array) -> Iterator[pa.Array]:
    """Words a few at a time, since the features of a word take far more room than the word."""
    for start in range(0, len(names), WORDS_AT_ONCE):
        yield names.slice(start, WORDS_AT_ONCE)


def _some_features(names: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    names = names.cast(pa.large_binary())
    ends = np.frombuffer(names.buffers()[1], np.int64)[names.offset : names.offset + len(names) + 1]
    raw = np.frombuffer(names.buffers()[2], np.uint8)[ends[0] : ends[-1]] if ends[-1] > ends[0] else np.zeros(0, np.uint8)
    sizes = np.diff(ends)
    padded = np.zeros(int(sizes.sum()) + 2 * len(sizes) + max(NGRAMS), np.uint8)
    first = np.concatenate([[0], np.cumsum(sizes + 2)]).astype(np.int64)
    padded[first[:-1]] = 2
    padded[first[1:] - 1] = 3
    inner = np.arange(len(raw)) + np.repeat(2 * np.arange(len(sizes)) + 1, sizes)
    padded[inner] = raw
    n = int(first[-1])
    word = np.repeat(np.arange(len(sizes)), sizes + 2)
    left = first[1:][word] - np.arange(n)
    acc = np.zeros(n, U64)
    found, owner = [bytes_hash(names)], [np.arange(len(sizes))]
    for k in range(max(NGRAMS)):
        acc = acc + _TABLES[k][padded[k : n + k]]
        if k + 1 in NGRAMS:
            inside = left > k
            found.append(acc[inside] + U64(k))
            owner.append(word[inside])
    features = (mix(np.concatenate(found)) >> U64(64 - FEATURE_BITS)).astype(np.int32)
    owners = np.concatenate(owner)
    order = np.argsort(owners, kind="stable")
    return features[order], np.concatenate([[0], np.cumsum(np.bincount(owners, minlength=len(sizes)))]).astype(np.int64)


def _emissions(weights: np.ndarray, features: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Score of each word in each language."""
    if len(starts) == 1:
        return np.zeros((0, weights.shape[1]))
    out = np.empty((len(starts) - 1, weights.shape[1]))
    for k in range(weights.shape[1]):
        out[:, k] = np.add.reduceat(weights[:, k][features], starts[:-1])
    return out


def _sample(docs: DataFrame, train: Column) -> list[tuple[str, str]]:
    """``(lang, text)`` of a bounded sample: about as many texts of every language, chosen by a hash of the id."""
    labelled = docs.filter(train & F.col("lang").isNotNull() & F.col("text").isNotNull() & F.col("doc_id").isNotNull())
    labelled = labelled.filter(F.length("text") <= TEXT_CHARS).select("doc_id", "lang", "text")
    counts = labelled.groupBy("lang").count().orderBy(F.desc("count"), "lang").limit(MOST_LANGUAGES).collect()
    if not counts:
        return []
    share = F.lit(0.0)
    wanted = min(TEXTS_PER_LANGUAGE, TEXTS // len(counts))
    for row in counts:
        share = F.when(F.col("lang") == row["lang"], min(1.0, wanted / row["count"])).otherwise(share)
    drawn = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) / float(1 << 30) < share
    chosen = labelled.filter(drawn).orderBy("doc_id").limit(TEXTS + TEXTS // 4)
    return sorted((r["lang"], r["text"]) for r in chosen.select("lang", "text").collect())


def fit(docs: DataFrame, train: Column, rounds: int = 20, rate: float = 0.3, decay: float = 1e-4) -> Field | None:
    """The field of the rows of ``docs`` for which ``train`` holds; None if none of them is labelled.

    At most ``MOST_LANGUAGES`` languages, the most frequent ones, with about
    ``TEXTS_PER_LANGUAGE`` whole texts each, and ``TEXTS`` in all, are taken; longer texts than
    ``TEXT_CHARS`` are not chosen for the sample.
    """
    sample = _sample(docs, train)
    if not sample:
        return None
    languages = tuple(sorted({lang for lang, _ in sample}))
    k = len(languages)
    words = Words(pa.array([text for _, text in sample], pa.string()))
    owner_lang = np.array([languages.index(lang) for lang, _ in sample])[words.owners()]
    n = len(words.ids) // WINDOW * WINDOW
    weights, transitions = np.zeros((1 << FEATURE_BITS, k)), np.zeros((k, k))
    if not n:
        return Field(languages, weights.astype(np.float32), transitions)
    shuffled = np.random.default_rng(3).permutation(n // WINDOW)
    shuffled = shuffled[: len(shuffled) // WINDOWS * WINDOWS] if len(shuffled) >= WINDOWS else shuffled
    width = WINDOW * min(WINDOWS, len(shuffled))
    place = (shuffled[:, None] * WINDOW + np.arange(WINDOW)).reshape(-1, width)
    ids, labels = words.ids[place], owner_lang[place]
    features, starts = word_features(words.names)
    spread = np.repeat(np.arange(len(starts) - 1, dtype=np.int32), np.diff(starts))
    squares, t_squares = np.full_like(weights, 1e-8), np.full((k, k), 1e-8)
    rows = len(ids)
    pairs = np.bincount((labels[:, :-1] * k + labels[:, 1:]).ravel(), minlength=k * k).reshape(k, k)
    for _ in range(rounds):
        scores = _emissions(weights, features, starts).astype(np.float32)[ids]
        scores = np.exp(np.maximum(scores - scores.max(axis=2, keepdims=True), -60.0))
        step = np.exp(transitions - transitions.max()).astype(np.float32)
        alpha = np.empty_like(scores)
        alpha[:, 0] = scores[:, 0] / scores[:, 0].sum(axis=1, keepdims=True)
        for t in range(1, width):
            a = (alpha[:, t - 1] @ step) * scores[:, t]
            alpha[:, t] = a / a.sum(axis=1, keepdims=True)
        beta = np.full((rows, k), 1.0 / k, np.float32)
        gamma = np.empty_like(scores)
        expected = np.zeros((k, k))
        gamma[:, -1] = alpha[:, -1]
        for t in range(width - 2, -1, -1):
            ahead = scores[:, t + 1] * beta
            joint = alpha[:, t][:, :, None] * step[None] * ahead[:, None, :]
            joint /= joint.sum(axis=(1, 2), keepdims=True)
            expected += joint.sum(axis=0, dtype=np.float64)
            gamma[:, t] = joint.sum(axis=2)
            beta = ahead @ step.T
            beta /= beta.sum(axis=1, keepdims=True)
        # Gradient of the mean log-likelihood of a word, step sizes by AdaGrad.
        flat = ids.ravel()
        gradient = np.empty_like(weights)
        for j in range(k):
            miss = (labels.ravel() == j) - gamma[:, :, j].ravel()
            per_word = np.bincount(flat, miss, minlength=len(starts) - 1)
            gradient[:, j] = np.bincount(features, per_word[spread], minlength=1 << FEATURE_BITS)
        gradient = gradient / flat.size - decay * weights
        squares += gradient**2
        weights += rate * gradient / np.sqrt(squares)
        t_gradient = (pairs - expected) / flat.size - decay * transitions
        t_squares += t_gradient**2
        transitions = transitions + rate * t_gradient / np.sqrt(t_squares)
    return Field(languages, weights.astype(np.float32), transitions)


def posteriors(field: Field, words: Words) -> np.ndarray:
    """Posterior of each language for each word of some texts, by forward-backward over all of each text."""
    k = len(field.languages)
    parts = (_emissions(field.weights, *_some_features(part)) for part in _word_parts(words.names))
    table = np.concatenate([np.zeros((0, k), np.float32), *[p.astype(np.float32) for p in parts]])
    table = np.exp(np.maximum(table - table.max(axis=1, keepdims=True), -60.0)) if len(table) else table
    step = np.exp(field.transitions - field.transitions.max())
    sizes = words.sizes
    order = np.argsort(-sizes, kind="stable")
    first, lengths = words.starts[:-1][order], sizes[order]
    ascending = lengths[::-1]
    score = table[words.ids].astype(np.float32)
    alpha = np.empty((len(words.ids), k), np.float32)
    longest = int(lengths[0]) if len(lengths) else 0
    # Texts in descending order of length: those still running at step t are the first ``live``.
    live = len(lengths) - np.searchsorted(ascending, np.arange(longest), "right")
    now = None
    for t in range(longest):
        at = first[: live[t]] + t
        now = score[at] if now is None else (now[: live[t]] @ step) * score[at]
        now = now / now.sum(axis=1, keepdims=True)
        alpha[at] = now
    ahead = np.zeros((0, k))
    for t in range(longest - 1, -1, -1):
        at = first[: live[t]] + t
        beta = np.full((live[t], k), 1.0 / k)
        if len(ahead):
            beta[: len(ahead)] = ahead @ step.T
        alpha[at] *= beta
        ahead = score[at] * beta
        ahead /= ahead.sum(axis=1, keepdims=True)
    return alpha / np.maximum(alpha.sum(axis=1, keepdims=True), 1e-30)


def has_letter(text: str = "text") -> Column:
    return F.coalesce(F.col(text).rlike(r"\p{L}"), F.lit(False))


def identify(docs: DataFrame, field: Field | None, keep: tuple[str, ...] = (), answer_name: str = "answer") -> DataFrame:
    """``doc_id, lang_pred, score, n_words, n_switches`` of every row, from its text alone.

    With ``keep`` these columns of ``docs`` come first, whatever their names, and the answer is in a
    struct column ``answer_name`` beside them. ``score`` is the language's mean posterior over the words (0 to 1) and
    ``n_switches`` counts neighbouring words labelled with different languages.
    A null text, one without a letter, or any text where ``field`` is None gets
    ``und`` and 0. Repeated rows get equal answers; a null ``doc_id`` stays null; no
    other column is read; an empty table gives no rows.
    """
    answer = {"lang_pred": StringType(), "score": DoubleType(), "n_words": LongType(), "n_switches": LongType()}
    if field is None:
        values = (F.lit(UNDECIDED), F.lit(0.0), F.lit(0).cast("long"), F.lit(0).cast("long"))
        named = [v.alias(n) for v, n in zip(values, answer)]
        if keep:
            return docs.select(*map(named_column, keep), F.struct(*named).alias(answer_name))
        return docs.select(F.col("doc_id").cast("long"), *named)
    # Each text is sent once: beside the other columns, and back only if it is kept.
    others = [c for c in keep or ("doc_id",) if c != "text"]
    kept = F.struct(*map(named_column, others)) if others else F.struct(F.lit(0).alias("nothing"))
    texts = docs.select(F.col("text").cast("string"), has_letter().alias("lettered"), kept.alias("kept"))
    returned = ["kept", "text"] if "text" in keep else ["kept"]
    types = {"kept": texts.schema["kept"].dataType, "text": StringType()}
    schema = StructType([StructField(c, types[c]) for c in returned] + [StructField(c, t) for c, t in answer.items()])
    # Bounded: 2 ** FEATURE_BITS weights for each of at most MOST_LANGUAGES languages.
    shared = docs.sparkSession.sparkContext.broadcast(field)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        field = shared.value
        names = np.array([*field.languages, UNDECIDED], dtype=object)
        for batch in batches:
            for part in text_slices(batch, limit=2 << 20):
                words = Words(pc.if_else(part.column("lettered"), part.column("text"), None))
                sizes, k = words.sizes, len(field.languages)
                gamma = posteriors(field, words)
                mean = np.zeros((len(sizes), k))
                full = sizes > 0
                if full.any():
                    mean[full] = np.add.reduceat(gamma, words.starts[:-1][full], axis=0, dtype=np.float64) / sizes[full, None]
                best = np.where(full, mean.argmax(axis=1), k)
                score = np.where(full, np.clip(mean.max(axis=1), 0.0, 1.0), 0.0)
                label, owner = gamma.argmax(axis=1), words.owners()
                changed = (label[1:] != label[:-1]) & (owner[1:] == owner[:-1])
                switches = np.bincount(owner[1:][changed], minlength=len(sizes))
                yield pa.RecordBatch.from_arrays(
                    [
                        *[part.column(c) for c in returned], pa.array(names[best], pa.string()), pa.array(score),
                        pa.array(sizes.astype(np.int64)), pa.array(switches.astype(np.int64)),
                    ],
                    names=[*returned, *answer],
                )

    found = texts.mapInArrow(run, schema)
    if keep:
        given = [F.col("text") if c == "text" else F.col("kept").getField(c).alias(c) for c in keep]
        return found.select(*given, F.struct(*answer).alias(answer_name))
    return found.select(F.col("kept.doc_id").cast("long").alias("doc_id"), *answer)
