"""Templates, identifiers and JSON text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .common import is_blank


def render_template(template: Column, values: Column) -> Column:
    """Replace every ``<<key>>`` by ``values[key]``; NULL values render as empty text."""
    return F.aggregate(
        F.map_entries(values),
        template,
        lambda text, e: F.replace(
            text, F.concat(F.lit("<<"), e["key"], F.lit(">>")), F.coalesce(e["value"], F.lit(""))
        ),
    )


def upper_selected(values: Column, keys: Column) -> Column:
    """Upper-case the values of the listed keys of a map."""
    return F.transform_values(
        values, lambda k, v: F.when(F.coalesce(F.array_contains(keys, k), F.lit(False)), F.upper(v)).otherwise(v)
    )


def strip_suffix(col: Column, suffix: str = "-S") -> Column:
    return F.when(col.endswith(suffix), F.left(col, F.length(col) - len(suffix))).otherwise(col)


def item_no_fallback(itemno: Column, mfg_itemno: Column) -> Column:
    """``itemno``, or the manufacturer's number when that exists and ``itemno`` is empty."""
    return F.when(mfg_itemno.isNotNull() & is_blank(itemno), mfg_itemno).otherwise(itemno)


def ship_complete_flag(ship_date: Column) -> Column:
    return F.when(is_blank(ship_date), "F").otherwise("T")


def nested_to_json(col: Column) -> Column:
    """JSON text of a list, NULL when missing or empty."""
    return F.when(F.size(col) > 0, F.to_json(col))


def open_structs_to_json(col: Column, extra: str = "extra") -> Column:
    """JSON text of a list of structs, with the entries of each one's map ``extra`` as further fields."""

    def merged(x: Column) -> Column:
        own, more = F.to_json(x.dropFields(extra)), F.to_json(x[extra])
        return (
            F.when(F.coalesce(F.size(x[extra]), F.lit(0)) <= 0, own)
            .when(own == "{}", more)
            .otherwise(F.concat(F.left(own, F.length(own) - 1), F.lit(","), F.substring(more, F.lit(2), F.length(more) - 1)))
        )

    return F.when(F.size(col) > 0, F.concat(F.lit("["), F.array_join(F.transform(col, merged), ","), F.lit("]")))


def empty_to_null(col: Column) -> Column:
    return F.when(~is_blank(col), col)
