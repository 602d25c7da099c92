"""Personal data in texts, by weakly supervised labelers; DataFrame and SQL functions only.

Base spans are those of four fixed patterns. Wider patterns propose further
candidates. Labelers vote on each candidate: a regex on its shape, a gazetteer of
issuers and key prefixes, and the words before it. Expectation-maximisation over
the counts of the vote patterns estimates how reliable each labeler is, and its
posteriors train a logistic classifier of candidate features, which decides.

A labeler has three answers and a candidate a handful of small features, so
the counts that reach the driver are a bounded table whatever the input's size.
Texts are never shuffled: one pass counts, one pass labels.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .sqltext import running_sums

#: Kinds in the order that breaks ties between spans with one start. The first four have base patterns.
KINDS = ("email", "ip", "card", "phone", "secret")
BASE = KINDS[:4]

# Base patterns, written so that Java's matcher neither recurses nor backtracks over long runs:
# ``prepared`` marks a joining character between two characters of a run with \x01 (same length),
# after which the run is one character class. A run is entered at its start or after the last match.
_JOINED_DOTS = r"regexp_replace(translate(text, '\u0001', '\u0002'), '(?<=[A-Za-z0-9-])\\.(?=[A-Za-z0-9-])', '\u0001')"
_JOINED_DIGITS = r"regexp_replace(translate(text, '\u0001', '\u0002'), '(?<=[0-9])[ -](?=[0-9])', '\u0001')"
PREPARED = {"email": _JOINED_DOTS, "ip": "text", "card": _JOINED_DIGITS, "phone": "text"}
PATTERNS = {
    "email": r"(?:\\G|(?<![A-Za-z0-9._%+\\x01-]))[A-Za-z0-9._%+\\x01-]++@[A-Za-z0-9-]++\\x01[A-Za-z0-9\\x01-]++",
    "ip": r"(?<![0-9])[0-9]++\\.[0-9]++\\.[0-9]++\\.[0-9]++",
    "card": r"(?<![0-9\\x01])[0-9][0-9\\x01]++",
    "phone": r"\\+[0-9][ ().0-9-]+[0-9]",
}
#: A text without these cannot hold a span of the kind.
HINTS = {"email": "contains(text, '@')", "ip": r"text rlike '[0-9]\\.[0-9]'", "card": "text rlike '[0-9][ -]?[0-9]'", "phone": "contains(text, '+')"}
#: Candidates beyond the base spans.
CANDIDATES = {
    "email": (r"text rlike '[@(]'", r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,64}+ ?(?:@|\\(at\\)) ?[A-Za-z0-9-]{2,63}+"),
    "card": ("text rlike '[0-9][ -]?[0-9]'", r"(?<![0-9 -])(?:[0-9]{4}[ -]?){3,4}[0-9]{0,4}(?![0-9])"),
    "phone": ("text rlike '[0-9]'", r"(?<![0-9+(])\\(?[0-9]{3}\\)?[ .-][0-9]{3}[ .-][0-9]{4}(?![0-9])"),
    "secret": ("text rlike '[0-9]'", r"(?<![A-Za-z0-9])(?=[A-Za-z]*[0-9])(?=[0-9]*[A-Za-z])[A-Za-z0-9]{16,}+"),
}
# Labelers: SQL conditions over a candidate ``c`` with text ``m`` and the lower-cased words ``before`` it;
# (votes for, votes against), neither is an abstention.
_SHAPE = {
    "email": ("c.m rlike '[A-Za-z0-9]@[A-Za-z0-9]|\\\\(at\\\\)'", "c.m rlike ' @ |^[0-9]+'"),
    "card": ("c.m rlike '^[3-6]' and length(regexp_replace(c.m, '[^0-9]', '')) in (15, 16)", "c.m rlike '^[0127-9]'"),
    "phone": (r"c.m rlike '^\\([2-9]|^[2-9][0-9]{2}[ .-][2-9]'", "c.m rlike '^[01]'"),
    "secret": ("c.m rlike '^[0-9a-f]{16,}$|^[A-Z0-9]{16,}$'", "c.m rlike '^[A-Za-z]?[a-z]+[0-9]{1,2}$|[0-9]{14}'"),
}
_GAZETTEER = {
    "email": "c.m rlike '(?i)(mail|gmx|outlook|yahoo|icloud|proton)'",
    "card": "c.m rlike '^(4|5[1-5]|34|37|6011|65)'",
    "phone": "c.m rlike '555|^\\\\(?(8[0-9]{2}|900)'",
    "secret": "c.m rlike '^(AKIA|ASIA|AIza|ghp|sk|xox)' or c.before rlike '(password|passwd|token|secret|apikey|api_key|key)[ =:\"]*$'",
}
_CONTEXT = {
    "email": "c.before rlike 'mail|contact|write'",
    "card": "c.before rlike 'card|visa|master|credit|pay'",
    "phone": "c.before rlike 'tel|phone|call|fax|mobile'",
    "secret": "c.before rlike '[=:] *\"?$|secret|key|login|auth'",
}
LABELERS = ("shape", "gazetteer", "context", "mixture")
CUE = 24


@dataclass(frozen=True)
class Classifier:
    """Weights of the span classifier by feature, and the labelers' estimated accuracies."""

    weights: dict[str, float]
    bias: float
    reliability: dict[str, tuple[float, float]]


def _found(df: DataFrame, name: str, prepared: str, hint: str, pattern: str) -> DataFrame:
    """Add ``name``: the leftmost matches as ``array<struct<m, before, start, end>>``, in code points."""
    source = f"if({hint}, {prepared}, '')"
    zipped = f"arrays_zip(split({name}_t, '{pattern}', -1), regexp_extract_all({name}_t, '{pattern}', 0))"
    pieces = f"transform(filter({zipped}, z -> z['1'] is not null), z -> named_struct('m', z['1'], 'before', lower(right(z['0'], {CUE})), 'n', length(z['1']), 'step', length(z['0']) + length(z['1'])))"
    df = df.withColumn(f"{name}_t", F.expr(source)).withColumn(f"{name}_p", F.expr(pieces))
    df = df.withColumn(f"{name}_l", F.expr(f"transform({name}_p, p -> p.step)"))
    df = df.withColumn(f"{name}_e", F.expr(running_sums(f"{name}_l")))
    spans = f"transform(arrays_zip({name}_p, {name}_e), z -> named_struct('m', z.{name}_p.m, 'before', z.{name}_p.before, 'start', z.{name}_e - z.{name}_p.n, 'end', z.{name}_e))"
    return df.withColumn(name, F.expr(spans)).drop(*[f"{name}_{x}" for x in "tple"])


_DIGITS = "length(translate(c.m, ' -().+\\u0001', ''))"
_LUHN = (
    "aggregate(sequence(1, length({d})), 0, (a, i) -> a + if(i % 2 = 1, cast(substr({d}, -i, 1) as int), "
    "cast(substr('0246813579', cast(substr({d}, -i, 1) as int) + 1, 1) as int))) % 10 = 0"
).format(d="translate(c.m, ' -\\u0001', '')")
VALID = {
    "email": "true",
    "ip": r"forall(split(c.m, '\\.'), p -> length(ltrim('0', p)) <= 3 and cast(concat('0', right(p, 3)) as int) <= 255)",
    "card": f"case when {_DIGITS} between 12 and 19 then {_LUHN} else false end",
    "phone": f"{_DIGITS} between 9 and 15",
}


def with_base(docs: DataFrame) -> DataFrame:
    """Add ``base``: the base spans as ``array<struct<start, kind, end>>`` in order of start and kind."""
    df = docs.withColumn("text", F.coalesce(F.col("text").cast("string"), F.lit("")))
    for kind in BASE:
        df = _found(df, f"_{kind}", PREPARED[kind], HINTS[kind], PATTERNS[kind])
    arrays = [
        f"transform(filter(_{kind}, c -> {VALID[kind]}), c -> named_struct('start', c.start, 'kind', {KINDS.index(kind)}, 'end', c.end))"
        for kind in BASE
    ]
    df = df.withColumn("base", F.expr(f"array_sort(concat({', '.join(arrays)}))"))
    return df.drop(*[f"_{kind}" for kind in BASE])


def _votes(kind: str) -> dict[str, str]:
    """Each labeler's vote on candidate ``c``: 1, -1, or 0 for an abstention."""
    yes, no = _SHAPE[kind]
    digits = "length(regexp_replace(c.m, '[^0-9]', ''))"
    return {
        "shape": f"case when {yes} then 1 when {no} then -1 else 0 end",
        "gazetteer": f"case when {_GAZETTEER[kind]} then 1 else 0 end",
        "context": f"case when {_CONTEXT[kind]} then 1 else 0 end",
        "mixture": f"case when {digits} * 4 >= length(c.m) then 1 when {digits} * 10 < length(c.m) then -1 else 0 end",
    }


def with_candidates(based: DataFrame) -> DataFrame:
    """Add ``candidates``: further possible spans that touch no base span, with votes and features."""
    df = based
    arrays = []
    for kind, (hint, pattern) in CANDIDATES.items():
        name = f"_c_{kind}"
        df = _found(df, name, "text", hint, pattern)
        votes = ", ".join(f"'{k}', {v}" for k, v in _votes(kind).items())
        arrays.append(
            f"transform({name}, c -> named_struct('start', c.start, 'kind', {KINDS.index(kind)}, 'end', c.end, "
            f"{votes}, 'long', least(4, cast(log2(c.end - c.start) as int) - 2)))"
        )
    df = df.withColumn("_all", F.expr(f"array_sort(concat({', '.join(arrays)}))"))
    # Only the few texts with candidates compare them with the base spans.
    free = "filter(_all, c -> not exists(base, b -> b.start < c.end and c.start < b.end))"
    df = df.withColumn("candidates", F.expr(f"if(size(_all) = 0 or size(base) = 0, _all, {free})"))
    return df.drop("_all", *[f"_c_{kind}" for kind in CANDIDATES])


def _estimate(counts: list[tuple[int, tuple[int, ...], int]], rounds: int = 50) -> tuple[list[float], list[tuple[float, float]]]:
    """EM over vote patterns ``(kind, votes, count)``: posterior per pattern, accuracy of each labeler.

    A labeler votes rightly for a real span with one probability and against a
    wrong one with another; an abstention says nothing. Both start at 0.8, and two
    made-up votes of that accuracy keep rare labelers from certainty.
    """
    accuracy = [(0.8, 0.8)] * len(LABELERS)
    prior = {kind: 0.5 for kind, _, _ in counts}
    posterior: list[float] = []
    for _ in range(rounds):
        posterior = []
        for kind, votes, _ in counts:
            odds = math.log(prior[kind] / (1 - prior[kind]))
            for (p, q), vote in zip(accuracy, votes):
                odds += math.log(p / (1 - q)) if vote > 0 else math.log((1 - p) / q) if vote < 0 else 0.0
            posterior.append(1 / (1 + math.exp(-max(-30.0, min(30.0, odds)))))
        for kind in prior:
            own = [(p, n) for p, (k, _, n) in zip(posterior, counts) if k == kind]
            prior[kind] = (1 + sum(p * n for p, n in own)) / (2 + sum(n for _, n in own))
        for i in range(len(LABELERS)):
            real = sum(p * n for p, (_, v, n) in zip(posterior, counts) if v[i])
            right = sum(p * n for p, (_, v, n) in zip(posterior, counts) if v[i] > 0)
            wrong = sum((1 - p) * n for p, (_, v, n) in zip(posterior, counts) if v[i])
            against = sum((1 - p) * n for p, (_, v, n) in zip(posterior, counts) if v[i] < 0)
            accuracy[i] = ((right + 8) / (real + 10), (against + 8) / (wrong + 10))
    return posterior, accuracy


def _features(kind: int, votes: tuple[int, ...], long: int) -> list[str]:
    named = [f"kind={kind}", f"kind={kind} long={long}"]
    return named + [f"{name}={vote}" for name, vote in zip(LABELERS, votes) if vote] + [
        f"kind={kind} {name}={vote}" for name, vote in zip(LABELERS, votes) if vote
    ]


def train(docs: DataFrame, rounds: int = 200, rate: float = 0.5, decay: float = 1e-3) -> Classifier | None:
    """Estimate the labelers and fit the classifier on all candidates of ``docs``; None if there are none."""
    # The outer form: the plain one would also test the candidates, and so find them, in a filter below it.
    listed = with_candidates(with_base(docs.select("text"))).select(F.explode_outer("candidates").alias("c"))
    exploded = listed.filter("c is not null").select("c.*")
    grouped = exploded.groupBy("kind", *LABELERS, "long").count()
    # Bounded: kinds x 3 ** labelers x lengths rows at most.
    rows = sorted((r["kind"], tuple(r[x] for x in LABELERS), r["long"], r["count"]) for r in grouped.collect())
    if not rows:
        return None
    patterns: dict[tuple[int, tuple[int, ...]], int] = {}
    for kind, votes, _, n in rows:
        patterns[kind, votes] = patterns.get((kind, votes), 0) + n
    counts = [(kind, votes, n) for (kind, votes), n in sorted(patterns.items())]
    posterior, accuracy = _estimate(counts)
    target = {(kind, votes): p for (kind, votes, _), p in zip(counts, posterior)}
    weights: dict[str, float] = {}
    bias = 0.0
    total = sum(n for *_, n in rows)
    for _ in range(rounds):
        step: dict[str, float] = {}
        b_step = 0.0
        for kind, votes, long, n in rows:
            names = _features(kind, votes, long)
            score = bias + sum(weights.get(x, 0.0) for x in names)
            miss = (target[kind, votes] - 1 / (1 + math.exp(-max(-30.0, min(30.0, score))))) * n / total
            b_step += miss
            for x in names:
                step[x] = step.get(x, 0.0) + miss
        bias += rate * b_step
        for x, s in step.items():
            weights[x] = weights.get(x, 0.0) + rate * (s - decay * weights.get(x, 0.0))
    return Classifier(weights, bias, dict(zip(LABELERS, accuracy)))


def _accepted(model: Classifier) -> str:
    """SQL condition over candidate ``c``: the classifier's score is positive."""
    terms = [repr(model.bias)]
    for name, weight in sorted(model.weights.items()):
        tests = " and ".join(f"c.{k} = {v}" for k, v in (x.split("=") for x in name.split(" ")))
        terms.append(f"if({tests}, {weight!r}D, 0.0D)")
    return f"cast({terms[0]} as double) + " + " + ".join(terms[1:]) + " > 0"


def find(docs: DataFrame, model: Classifier | None) -> DataFrame:
    """``docs`` with ``base`` and ``found`` added: base spans, and base and accepted spans together.

    Spans are ``struct<start, kind, end>`` with ``kind`` a position in ``KINDS``, in
    code points, end exclusive, by start and then kind. A null text counts as empty
    and has none (it is read as empty); ids may be null or repeated; further columns stay, but for
    those called ``base``, ``found``, ``candidates``, ``_all`` or like a kind after ``_`` or ``_c_``, which are
    replaced or go (in a struct they are safe); without a model only base spans are found. Texts are
    read whole, and an empty table gives no rows.
    """
    based = with_base(docs)
    if model is None:
        return based.withColumn("found", F.col("base"))
    both = with_candidates(based)
    added = f"transform(filter(candidates, c -> {_accepted(model)}), c -> named_struct('start', c.start, 'kind', c.kind, 'end', c.end))"
    joined = f"if(size(candidates) = 0, base, array_sort(concat(base, {added})))"
    return both.withColumn("found", F.expr(joined)).drop("candidates")


def spelled(spans: str) -> str:
    """SQL for ``kind:start:end`` of each span, comma-joined."""
    names = ", ".join(f"'{k}'" for k in KINDS)
    return f"array_join(transform({spans}, s -> concat(element_at(array({names}), s.kind + 1), ':', s.start, ':', s.end)), ',')"


def count_of(kind: str, spans: str = "base") -> str:
    return f"cast(size(filter({spans}, s -> s.kind = {KINDS.index(kind)})) as long)"


def masked(text: str = "text", spans: str = "found") -> str:
    """SQL for the text with every span replaced by its kind in angle brackets; overlapping spans count as the first.

    The text is cut at the spans' ends, so it is walked once per span.
    """
    names = ", ".join(f"'{k}'" for k in KINDS)
    apart = (
        f"aggregate({spans}, named_struct('end', 0, 'out', cast(array() as array<struct<start:int,kind:int,end:int,last:int>>)), "
        "(a, s) -> if(s.start < a.end, a, named_struct('end', s.end, 'out', concat(a.out, array(named_struct("
        "'start', s.start, 'kind', s.kind, 'end', s.end, 'last', a.end))))), a -> a.out)"
    )
    pieces = (
        f"transform({apart}, s -> concat(substr({text}, s.last + 1, s.start - s.last), '<', element_at(array({names}), s.kind + 1), '>'))"
    )
    tail = f"substr({text}, aggregate({spans}, 0, (a, s) -> if(s.start < a, a, s.end)) + 1)"
    return f"if(size({spans}) = 0, {text}, concat(array_join({pieces}, ''), {tail}))"
