"""SQL texts that several operators use."""

from __future__ import annotations

#: Elements summed up in one go.
CHUNK = 256


def running_sums(lengths: str) -> str:
    """SQL for the running sums of an array of ints, in chunks so that no long array is copied per element."""
    step = (
        "aggregate({0}, named_struct('at', {1}, 'out', cast(array() as array<int>)), "
        "(a, x) -> named_struct('at', a.at + x, 'out', concat(a.out, array(a.at + x))), a -> a.out)"
    )
    starts = f"filter(sequence(0, size({lengths}), {CHUNK}), i -> i < size({lengths}))"
    chunks = f"transform({starts}, i -> slice({lengths}, i + 1, {CHUNK}))"
    with_total = f"transform({chunks}, k -> named_struct('k', k, 'n', aggregate(k, 0, (a, x) -> a + x)))"
    placed = (
        f"aggregate({with_total}, named_struct('at', 0, 'out', cast(array() as array<struct<k:array<int>,at:int>>)), "
        "(a, x) -> named_struct('at', a.at + x.n, 'out', concat(a.out, array(named_struct('k', x.k, 'at', a.at)))), a -> a.out)"
    )
    return f"flatten(transform({placed}, p -> {step.format('p.k', 'p.at')}))"
