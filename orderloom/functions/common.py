"""Small expression helpers shared by the column rules."""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark import SparkContext
from pyspark.sql import Column
from pyspark.sql import functions as F


def built_once(build: Callable[..., Column]) -> Callable[..., Column]:
    """Keep the columns ``build`` makes, per argument list and application.

    Large expressions cost many round trips to the JVM to put together; those
    that depend on column names only are the same for every query.
    """
    made: dict[tuple, Column] = {}

    @functools.wraps(build)
    def get(*args: object) -> Column:
        context = SparkContext._active_spark_context
        key = (context.applicationId if context else None, *args)
        if key not in made:
            made[key] = build(*args)
        return made[key]

    return get


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Evaluate ``value`` once and hand it to ``body``.

    A column expression inside a lambda is evaluated again for every element, even
    if it was a column of its own before projections were merged; a lambda variable
    is not. A fold over one element binds the value without the copy that
    ``transform`` makes of each result.
    """
    return F.aggregate(F.array(F.lit(0)), value, lambda bound, _: bound, body)


def is_blank(col: Column) -> Column:
    """NULL or empty text."""
    return col.isNull() | (col.cast("string") == "")


def is_set(col: Column, numeric: bool = False) -> Column:
    """The truth rule for a value: text is set unless empty, a number unless 0."""
    empty = (col == 0) if numeric else (col == "")
    return col.isNotNull() & ~empty


def flag(col: Column) -> Column:
    """A configuration flag kept as text: anything but a false value switches it on."""
    return F.coalesce(~F.lower(col).isin("", "false", "0", "null", "[]", "{}"), F.lit(False))


def count_parts(col: Column) -> Column:
    """Number of comma-separated parts, 0 for NULL or empty text."""
    return F.when(is_blank(col), F.lit(0)).otherwise(F.size(F.split(col, ",")))
