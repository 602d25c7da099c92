"""Katz backoff language model: counted, normalised and evaluated over blocks of documents.

A block is a few million words of whole documents, kept as the hashes of its
different words and the word numbers in order. For every order a block sends each
of its different n-grams once, with its training count, to the bucket of the
n-gram's hash; the bucket adds up the counts and answers every block with the
totals. Frequent n-grams are thus summed up before the shuffle, and buckets are
even, since they go by the hash of the whole n-gram. A bit of the answer says
whether a single block has the n-gram. Longer n-grams around such a one are in that
block only, so from order 3 on, when the shorter ones are answered, they are not sent
and the block counts them itself. The same way contexts get their backoff weights: of
the blocks that have seen an n-gram in training one owns it and adds its probabilities
to the context's sums; a context of a single block is weighted there. Only held-out
texts back off, so sums are sent for contexts that some held-out text has, which is
another bit of the answer, and a weight is told to the blocks that back off from it.
Blocks then evaluate their tokens from the answers, recursively from the highest order
down.

Probabilities: ``d_r`` are Good-Turing discounts up to ``MOST_DISCOUNTED``. A seen
n-gram has ``d_r * r / c(context)``; an unseen one the context's backoff weight
times the probability of the shorter n-gram. A weight is the mass that discounts
leave, over the mass that the shorter n-grams give to the context's unseen words,
so every context sums to one over the training words and one unknown word. A
context whose n-grams are all too frequent to be discounted leaves no mass; its
count is raised by one, which leaves some.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .blocks import block_rows, bucket_bits, buckets_of, gathered, pack, pack_ascending, unpack, word_sequence
from .storage import stored
from .words import U64, pair

MOST_DISCOUNTED = 5
START, END = U64(0x5AFE0001_00000001), U64(0x5AFE0002_00000003)


def discounts(n: dict[int, int], most: int = MOST_DISCOUNTED) -> np.ndarray:
    """Good-Turing discounts ``d_0 .. d_most`` (``d_0`` unused) from counts of counts.

    Where these are too irregular for discounts between 0 and 1, an absolute discount
    takes their place.
    """
    d = np.ones(most + 1)
    if all(n.get(r, 0) > 0 for r in range(1, most + 2)):
        rest = (most + 1) * n[most + 1] / n[1]
        for r in range(1, most + 1):
            d[r] = ((r + 1) * n[r + 1] / n[r] / r - rest) / (1 - rest) if rest < 1 else 2.0
        if ((d[1:] > 0) & (d[1:] <= 1)).all():
            return d
    once, twice = n.get(1, 0), n.get(2, 0)
    off = min(0.9, once / (once + 2 * twice)) if once else 0.5
    return np.array([1.0] + [1 - off / r for r in range(1, most + 1)])


@dataclass(frozen=True)
class Model:
    """What is known of the whole training text: counts of tokens and words, and the discounts of each order."""

    order: int
    tokens: int
    words: int
    discounts: tuple[np.ndarray, ...]
    unigram_sum: float
    bits: int

    def mass(self, order: int, counts: np.ndarray) -> np.ndarray:
        """Discounted counts."""
        d = self.discounts[order - 1]
        return counts * d[np.where(counts < len(d), counts, 0)]

    def may_be_raised(self, k: int, counts: np.ndarray) -> np.ndarray:
        """Whether discounts may leave no mass to contexts of ``k`` words with these counts."""
        return (counts > MOST_DISCOUNTED) | bool(self.discounts[k][1:].max() > 1 - 1e-9)

    @property
    def total(self) -> int:
        """What unigram masses are divided by; one more than the tokens where discounts leave nothing."""
        return self.tokens + (self.tokens - self.unigram_sum < 1e-9 * max(1, self.tokens))

    @property
    def unknown(self) -> float:
        return 1 - self.unigram_sum / self.total


def distinct(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The different keys, where each comes first, and which one each key is, as ``np.unique`` gives them.

    Sorts the keys' upper bits with the places as lower bits, which is faster than sorting places by keys.
    """
    low = U64(max(1, len(keys)).bit_length())
    mixed = np.sort(keys >> low << low | np.arange(len(keys), dtype=U64))
    order = (mixed & (U64(1) << low) - U64(1)).astype(np.int64)
    ordered = keys[order]
    if (ordered[1:] < ordered[:-1]).any():
        order = np.argsort(keys, kind="stable")
        ordered = keys[order]
    new = np.ones(len(keys), bool)
    new[1:] = ordered[1:] != ordered[:-1]
    inverse = np.empty(len(keys), np.int32)
    inverse[order] = np.cumsum(new, dtype=np.int32) - 1
    return ordered[new], order[new], inverse


class Block:
    """A block's n-grams up to the order ``upto`` of ``order``. Position arrays run over ``order - 1`` start marks,
    the words and the end mark of each text."""

    def __init__(self, row: dict, order: int, upto: int):
        self.order = order
        self.number = row["block"]
        self.ids, self.held = row["doc_id"], np.array(row["held"], bool)
        sizes = np.array(row["sizes"], np.int64)
        lengths = sizes + order
        self.starts = np.concatenate([[0], np.cumsum(lengths)]).astype(np.int64)
        self.doc = np.repeat(np.arange(len(sizes), dtype=np.int32), lengths)
        place = np.arange(self.starts[-1]) - self.starts[:-1][self.doc]
        seq = np.full(len(self.doc), START)
        inner = (place >= order - 1) & (place < (lengths - 1)[self.doc])
        seq[inner] = word_sequence(row)
        seq[self.starts[1:] - 1] = END
        self.token = place >= order - 1
        self.context = place >= order - 2
        del place, inner
        self.kinds: list[np.ndarray] = []
        self.first: list[np.ndarray] = []
        self.at: list[np.ndarray] = []
        keys = seq
        for k in range(1, upto + 1):
            if k > 1:
                keys = pair(np.concatenate([[U64(0)], keys[:-1]]), seq)
            used = np.flatnonzero(self.token if k == order else self.context)
            kinds, first, inverse = distinct(keys[used])
            at = np.full(len(seq), -1, np.int32)
            at[used] = inverse
            self.kinds.append(kinds)
            self.first.append(used[first].astype(np.int32))
            self.at.append(at)

    def training_counts(self, k: int) -> np.ndarray:
        used = self.at[k - 1] >= 0
        trained = used & ~self.held[self.doc]
        return np.bincount(self.at[k - 1][trained], minlength=len(self.kinds[k - 1])).astype(np.int64)

    def asked_counts(self, k: int, sent: np.ndarray, bits: int) -> list[tuple]:
        """Requests for the totals of those n-grams that ``sent`` marks, with which of them held-out texts have."""
        kinds, counts = self.kinds[k - 1][sent], self.training_counts(k)[sent]
        held = np.zeros(len(sent), np.uint8)
        at = self.at[k - 1][self.held[self.doc]]
        held[at[at >= 0]] = 1
        held = held[sent]
        return [
            ("count", k, b, self.number, s.stop - s.start, pack_ascending(kinds[s]), pack(counts[s]), pack(held[s]), None)
            for b, s in buckets_of(kinds, bits)
        ]


def _start_key(k: int) -> np.uint64:
    key = np.array([START])
    for _ in range(1, k):
        key = pair(key, np.array([START]))
    return key[0]


_ASKED = "kind string, ord int, bucket int, block long, n long, keys binary, a binary, b binary, c binary"
_TOLD = "kind string, ord int, bucket int, block long, n long, keys binary, a binary, b binary"
_KINDS = (pa.string(), pa.int32(), pa.int32(), pa.int64(), pa.int64(), *[pa.binary()] * 4)
_NAMES = ("kind", "ord", "bucket", "block", "n", "keys", "a", "b", "c")


def _asked(rows: list[tuple]) -> pa.Table:
    columns = list(zip(*rows)) or [()] * 9
    return pa.table([pa.array(c, t) for c, t in zip(columns, _KINDS)], names=list(_NAMES))


def _told(rows: list[tuple]) -> pa.Table:
    columns = list(zip(*rows)) or [()] * 8
    return pa.table([pa.array(c, t) for c, t in zip(columns, _KINDS[:8])], names=list(_NAMES[:8]))


def _ask_counts(blocks: DataFrame, order: int, upto: int, bits: int) -> DataFrame:
    """Requests for the totals of all n-grams of up to ``upto`` words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                block = Block(row, order, upto)
                for k in range(1, upto + 1):
                    yield from _asked(block.asked_counts(k, np.ones(len(block.kinds[k - 1]), bool), bits)).to_batches()

    return blocks.mapInArrow(run, _ASKED)


def _stats(k: int, order: int, kinds: np.ndarray, totals: np.ndarray) -> np.ndarray:
    """Counts of counts, then tokens, different n-grams, and tokens of n-grams too frequent to be discounted."""
    seen = totals > 0
    counted = seen & (kinds != _start_key(k)) if k < order else seen
    of = np.bincount(np.minimum(totals[counted], MOST_DISCOUNTED + 2), minlength=MOST_DISCOUNTED + 3)
    large = int(totals[counted & (totals > MOST_DISCOUNTED)].sum())
    return np.concatenate([of, [int(totals[counted].sum()), int(counted.sum()), large]]).astype(np.int64)


def _add_counts(order: int, model: bool, table: pa.Table) -> pa.Table:
    """Partitions of the model, or else the blocks' answers and the counts of counts."""
    rows, kinds, at, ends = gathered(table)
    k, bucket = rows[0]["ord"], rows[0]["bucket"]
    counts = np.concatenate([unpack(r["a"], r["n"], np.int64) for r in rows])
    totals = np.bincount(at, counts, minlength=len(kinds)).astype(np.int64)
    if model:
        seen = totals > 0
        return _told([("model", k, bucket, -1, int(seen.sum()), pack_ascending(kinds[seen]), pack(totals[seen]), None)])
    # Of the blocks that trained on an n-gram the first one owns it.
    trained = np.flatnonzero(counts > 0)[::-1]
    owner = np.full(len(kinds), -1, np.int64)
    owner[at[trained]] = trained
    alone = np.bincount(at, minlength=len(kinds)) == 1
    wanted = np.zeros(len(kinds), bool)
    wanted[at[np.concatenate([unpack(r["b"], r["n"], np.uint8) for r in rows]) > 0]] = True
    answer = totals[at] << 3 | wanted[at] << 2 | alone[at] << 1 | (owner[at] == np.arange(len(at)))
    out = [
        ("answer", k, bucket, r["block"], r["n"], None, pack(answer[e - r["n"] : e]), None) for r, e in zip(rows, ends)
    ]
    return _told(out + _stats_rows(k, _stats(k, order, kinds, totals)))


def _stats_rows(k: int, stats: np.ndarray) -> list[tuple]:
    return [("stats", k, i, -1, int(value), None, None, None) for i, value in enumerate(stats)]


def _reply(order: int, model: bool = False):
    """Answers to the requests of one kind, order and bucket; with ``model`` the model's tables instead."""

    def run(table: pa.Table) -> pa.Table:
        kind = table.column("kind")[0].as_py()
        if kind == "count":
            return _add_counts(order, model, table)
        if kind == "weight":
            return _add_weights(model, table)
        rows = table.to_pylist()
        return _told(_stats_rows(rows[0]["ord"], sum(unpack(r["a"], r["n"], np.int64) for r in rows)))

    return run


def _replies(asked: DataFrame, order: int, model: bool = False) -> DataFrame:
    return asked.groupBy("kind", "ord", "bucket").applyInArrow(_reply(order, model), _TOLD)


class Answered(Block):
    """A block with the totals of its n-grams of up to ``counted`` words, and the backoff weights of its contexts
    of up to ``known`` words: of those whose value counts here (with ``every``, of all that only this block has),
    and the sign of all others."""

    def __init__(self, table: pa.Table, model: Model, counted: int, known: int, upto: int | None = None, every: bool = False):
        rows = table.to_pylist()
        own = next(r for r in rows if r["kind"] == "block")
        super().__init__(own, model.order, upto or counted)
        self.model = model
        self.counts, self.owned, self.alone, self.wanted, self.weights = [], [], [], [], []

        def answers(kind: str, k: int) -> list[dict]:
            return sorted((r for r in rows if r["kind"] == kind and r["ord"] == k), key=lambda r: r["bucket"])

        for k in range(1, counted + 1):
            coded = np.concatenate([np.zeros(0, np.int64)] + [unpack(r["a"], r["n"], np.int64) for r in answers("answer", k)])
            if k > 2:
                trained = self.training_counts(k)
                told, coded = coded, trained << 3 | 2 | (trained > 0)
                coded[self.shared(k)] = told
            self.counts.append(coded >> 3)
            self.wanted.append((coded & 4).astype(bool))
            self.alone.append((coded & 2).astype(bool))
            self.owned.append((coded & 1).astype(bool))
        for k in range(1, known + 1):
            sent, need, _, raised = self.weight_request(k)
            here = self.alone[k - 1] & (need | raised | every)
            weight = np.ones(len(here))
            weight[here] = _weights(*(x[here] for x in (*self.context_sums(k, here), self.counts[k - 1])))
            kinds, need, told = self.kinds[k - 1][sent], need[sent], np.ones(int(sent.sum()))
            for r, (_, s) in zip(answers("weight", k), buckets_of(kinds, model.bits), strict=True):
                part = np.where(unpack(r["b"], r["n"], np.uint8) > 0, -1.0, 1.0)
                part[need[s]] = unpack(r["a"], int(need[s].sum()), np.float64)
                told[s] = part
            weight[sent] = told
            self.weights.append(weight)

    def shared(self, k: int) -> np.ndarray:
        """Which n-grams of ``k`` words other blocks may have: those without a shorter one that is only here."""
        if k <= 2:
            return np.ones(len(self.kinds[k - 1]), bool)
        first, at, alone = self.first[k - 1], self.at[k - 2], self.alone[k - 2]
        here = [(i >= 0) & alone[i] for i in (at[first], at[first - 1])]
        return ~(here[0] | here[1])

    def weight_request(self, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """The contexts of ``k`` words to ask for, those whose weight's value is used here, those whose sums are sent
        (of contexts of held-out texts, and of such that may have to be raised), and those that may have to be raised."""
        token = np.flatnonzero(self.token & self.held[self.doc])
        unseen = token[self.counts[k][self.at[k][token]] == 0]
        need = np.zeros(len(self.kinds[k - 1]), bool)
        need[self.at[k - 1][unseen - 1]] = True
        raised = self.model.may_be_raised(k, self.counts[k - 1])
        summed = self.followed(k) & (self.wanted[k - 1] | raised)
        return ~self.alone[k - 1] & (need | summed | raised), need, summed, raised

    def log_probability(self, k: int, token: np.ndarray) -> np.ndarray:
        """log10 probability of the tokens at these positions after ``k - 1`` words: from the counts, or backing off."""
        model = self.model
        counts = self.counts[k - 1][self.at[k - 1][token]]
        seen = counts > 0
        out = np.empty(len(token))
        mass = model.mass(k, counts[seen])
        if k == 1:
            with np.errstate(divide="ignore"):
                out[~seen] = np.log10(model.unknown)
            out[seen] = np.log10(mass / model.total)
            return out
        before = self.at[k - 2][token - 1]
        weight, context = self.weights[k - 2], before[seen]
        out[seen] = np.log10(mass) - np.log10(np.maximum(self.counts[k - 2][context] + (weight[context] < 0), 1))
        out[~seen] = np.log10(np.abs(weight[before[~seen]])) + self.log_probability(k - 1, token[~seen])
        return out

    def successors(self, k: int) -> tuple[np.ndarray, np.ndarray]:
        """The n-grams that follow contexts of ``k`` words and are owned here, and the context of each."""
        own = np.flatnonzero(self.owned[k] & (self.counts[k] > 0) & self.token[self.first[k]])
        return own, self.at[k - 1][self.first[k][own] - 1]

    def context_sums(self, k: int, of: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For the contexts of ``k`` words that ``of`` marks: the mass and the shorter n-grams' probability of owned successors."""
        own, context = self.successors(k)
        own, context = own[of[context]], context[of[context]]
        mass = np.bincount(context, self.model.mass(k + 1, self.counts[k][own]), minlength=len(of))
        lower = np.bincount(context, 10.0 ** self.log_probability(k, self.first[k][own]), minlength=len(of))
        return mass, lower

    def followed(self, k: int) -> np.ndarray:
        """Which contexts of ``k`` words have owned successors."""
        some = np.zeros(len(self.kinds[k - 1]), bool)
        some[self.successors(k)[1]] = True
        return some


def _weights(mass: np.ndarray, lower: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Backoff weights of contexts with these sums and counts; negative where the count is raised by one."""
    seen = mass > 0
    rest = 1 - mass / np.maximum(counts, 1)
    raised = seen & (rest < 1e-12)
    rest = np.where(raised, 1 - mass / (counts + 1.0), rest)
    weight = np.where(seen, rest / np.maximum(1 - lower, 1e-300), 1.0)
    return np.where(raised, -weight, weight)


def _asked_weights(block: Answered, k: int, every: bool = False) -> list[tuple]:
    """Requests for the weights of shared contexts: of those ``weight_request`` has, or of all."""
    sent, need, summed, _ = block.weight_request(k)
    if every:
        sent, summed = ~block.alone[k - 1], block.followed(k)
    mass, lower = block.context_sums(k, sent & summed)
    kinds, counts, need, summed, mass, lower = (x[sent] for x in (block.kinds[k - 1], block.counts[k - 1], need, summed, mass, lower))
    rows = []
    for b, s in buckets_of(kinds, block.model.bits):
        own = summed[s]
        sums = np.concatenate([mass[s][own], lower[s][own]])
        known = pack(counts[s]), pack(own.astype(np.uint8) | need[s].astype(np.uint8) << 1), pack(sums)
        rows.append(("weight", k, b, block.number, s.stop - s.start, pack_ascending(kinds[s]), *known))
    return rows


def _ask(answered: DataFrame, model: Model, k: int) -> DataFrame:
    """Requests for the weights of contexts of ``k`` words, and for the totals of n-grams of two words more."""

    def run(table: pa.Table) -> pa.Table:
        more = k + 2 <= model.order
        block = Answered(table, model, k + 1, k - 1, k + 1 + more)
        rows = _asked_weights(block, k)
        if more:
            sent = block.shared(k + 2)
            rows += block.asked_counts(k + 2, sent, model.bits)
            own = _stats(k + 2, model.order, block.kinds[k + 1][~sent], block.training_counts(k + 2)[~sent])
            # Dealt out over as many groups as there are buckets.
            rows.append(("stats", k + 2, block.number % (1 << model.bits), block.number, len(own), None, pack(own), None, None))
        return _asked(rows)

    return answered.groupBy("block").applyInArrow(run, _ASKED)


def _ask_all_weights(answered: DataFrame, model: Model, k: int) -> DataFrame:
    def run(table: pa.Table) -> pa.Table:
        return _asked(_asked_weights(Answered(table, model, k + 1, k - 1), k, every=True))

    return answered.groupBy("block").applyInArrow(run, _ASKED)


def _add_weights(model: bool, table: pa.Table) -> pa.Table:
    rows, kinds, at, ends = gathered(table)
    mass, lower, counts = np.zeros(len(kinds)), np.zeros(len(kinds)), np.zeros(len(kinds), np.int64)
    flags = [unpack(r["b"], r["n"], np.uint8) for r in rows]
    for r, e, flag in zip(rows, ends, flags):
        own = at[e - r["n"] : e]
        counts[own] = unpack(r["a"], r["n"], np.int64)
        summed = own[(flag & 1).astype(bool)]
        sums = unpack(r["c"], 2 * len(summed), np.float64)
        mass[summed] += sums[: len(summed)]
        lower[summed] += sums[len(summed) :]
    weight = _weights(mass, lower, counts)
    k, bucket = rows[0]["ord"], rows[0]["bucket"]
    if model:
        seen = mass > 0
        return _told([("backoff", k, bucket, -1, int(seen.sum()), pack_ascending(kinds[seen]), pack(weight[seen]), None)])
    out = []
    for r, e, flag in zip(rows, ends, flags):
        part = weight[at[e - r["n"] : e]]
        out.append(("weight", k, bucket, r["block"], r["n"], None, pack(part[(flag & 2).astype(bool)]), pack((part < 0).astype(np.uint8))))
    return _told(out)


def _alone_weights(answered: DataFrame, model: Model, k: int) -> DataFrame:
    """The model's backoff weights of contexts that a single block has."""

    def run(table: pa.Table) -> pa.Table:
        block = Answered(table, model, k + 1, k, every=True)
        own = block.alone[k - 1] & block.followed(k)
        kinds, weight = block.kinds[k - 1][own], block.weights[k - 1][own]
        return _told([
            ("backoff", k, b, -1, s.stop - s.start, pack_ascending(kinds[s]), pack(weight[s]), None)
            for b, s in buckets_of(kinds, model.bits)
        ])

    return answered.groupBy("block").applyInArrow(run, _TOLD)


def _with_answers(blocks: DataFrame, answers: list[DataFrame]) -> DataFrame:
    """Blocks and what was answered to them in one schema, to be grouped by block."""
    own = blocks.withColumn("kind", F.lit("block"))
    out = own
    for a in answers:
        out = out.unionByName(a.filter(F.col("kind").isin("answer", "weight")).select("kind", "ord", "bucket", "block", "n", "a", "b"), allowMissingColumns=True)
    return out


def _scores(answered: DataFrame, model: Model) -> DataFrame:
    def run(table: pa.Table) -> pa.Table:
        block = Answered(table, model, model.order, model.order - 1)
        token = np.flatnonzero(block.token)
        counts = block.counts[0][block.at[0][token]]
        base = np.log10((counts + 0.5) / (model.tokens + 0.5 * (model.words + 1)))
        doc, n = block.doc[token], len(block.ids)
        score = block.log_probability(model.order, token)
        return pa.table({
            "doc_id": pa.array(block.ids, pa.int64()),
            "held_out": pa.array(block.held),
            "n_tokens": pa.array(np.bincount(doc, minlength=n).astype(np.int64)),
            "n_known": pa.array(np.bincount(doc[counts > 0], minlength=n).astype(np.int64)),
            "train_tokens": pa.array(np.full(n, model.tokens, np.int64)),
            "base_score": pa.array(np.bincount(doc, base, minlength=n)),
            "score": pa.array(np.bincount(doc, score, minlength=n)),
        })

    schema = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
    return answered.groupBy("block").applyInArrow(run, schema)


@dataclass(frozen=True)
class Fitted:
    """A model with its tables: per order and bucket the keys with counts, and the contexts' backoff weights
    (a negative weight marks a context whose count is raised by one). Both are worked out when they are read."""

    model: Model | None
    counts: DataFrame
    backoff: list[DataFrame]
    scores: DataFrame


def fit_and_score(docs: DataFrame, held: Column, order: int = 2) -> Fitted:
    """Train on the rows of ``docs`` where ``held`` is not true, and score all of them.

    Scores have one row per row of ``docs``: ``doc_id, held_out, n_tokens, n_known,
    train_tokens, base_score, score``. A null text counts as empty, so its only token
    is the end; a null ``held`` counts as false; a null or repeated ``doc_id`` is
    carried through. Other columns are not read. An empty table gives no rows; with
    nothing to train on, every token is the unknown word with probability 1.
    """
    if order < 1:
        raise ValueError("order must be at least 1")
    spark = docs.sparkSession
    plain = docs.select(
        F.col("doc_id").cast("long"), F.col("text").cast("string"), F.coalesce(held, F.lit(False)).alias("held")
    )
    blocks = stored(block_rows(plain, {"doc_id": "long", "held": "boolean"}), "lm-blocks")
    total = blocks.agg(F.coalesce(F.sum("n_tokens"), F.lit(0)).alias("n")).first()["n"]
    bits = bucket_bits(total)
    stats: dict[int, dict[int, int]] = {}
    answers: list[DataFrame] = []

    def answered(asked: DataFrame) -> Model:
        """Write the answers to the requests, and the model as far as it is known then."""
        told = stored(_replies(asked, order), "lm-answers", "kind")
        answers.append(told)
        # A few numbers for each order, summed up on the executors.
        sums = told.filter("kind = 'stats'").groupBy("ord", F.col("bucket").alias("pos")).agg(F.sum("n").alias("n"))
        for r in sums.collect():
            stats.setdefault(r["ord"], {})[r["pos"]] = r["n"]
        top = MOST_DISCOUNTED + 3
        found = tuple(discounts(stats.get(k, {})) for k in range(1, order + 1))
        first = stats.get(1, {})
        mass = sum(found[0][r] * r * first.get(r, 0) for r in range(1, MOST_DISCOUNTED + 1)) + first.get(top + 2, 0)
        return Model(order, first.get(top, 0), first.get(top + 1, 0), found, float(mass), bits)

    model = answered(_ask_counts(blocks, order, min(2, order), bits))
    for k in range(1, order):
        model = answered(_ask(_with_answers(blocks, answers), model, k))
    known = _with_answers(blocks, answers)
    backoff = [
        _replies(_ask_all_weights(known, model, k), order, True).unionByName(_alone_weights(known, model, k)) for k in range(1, order)
    ]
    counts = _replies(_ask_counts(blocks, order, order, bits), order, True)
    return Fitted(model, counts, backoff, _scores(known, model))
