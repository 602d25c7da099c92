"""The ERP purchase-order feed."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .scanner import NO_FEED, elements_of_bodies, elements_of_files

ORDER = "map<string,string>"


def _tagged(cut: DataFrame) -> DataFrame:
    """Cut elements to orders, with ``reject_reason`` where there is none."""
    order = F.when(F.col("element").startswith("{") & F.col("element").endswith("}"), F.from_json("element", ORDER))
    reason = (
        F.when(F.col("pos").isNull(), NO_FEED)
        .when(F.try_parse_json("element").isNull(), "malformed element")
        .otherwise("the element is not an object")
    )
    return cut.withColumn("order_doc", order).withColumn("reject_reason", F.when(F.col("order_doc").isNull(), reason))


def tag_feed(df: DataFrame, body: str = "body") -> DataFrame:
    """Feed documents ``{"data": [order, …]}`` to one row per element of the list.

    Adds ``pos`` (position in the list), ``element`` (its text as written), ``order_doc`` (field to text;
    a nested value is its JSON text, a number is as Spark writes it) and ``reject_reason``: an element that is
    malformed or no object has one, and so has a body that is no feed, with a null ``pos``.
    """
    return _tagged(elements_of_bodies(df, body))


def tag_feed_files(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """``tag_feed`` for files that are one feed each, with ``file``; a file of any size is read in many tasks."""
    found, broken = elements_of_files(spark, path)
    return _tagged(found.unionByName(broken, allowMissingColumns=True))


def read_feed(df: DataFrame, body: str = "body", mode: str = "fail") -> DataFrame:
    """The orders of ``tag_feed``; what is rejected aborts (``mode='fail'``) or is left out (``mode='skip'``)."""
    tagged = tag_feed(df, body)
    if mode == "fail":
        # Both columns carry the check, so that a query of either one aborts.
        broken = F.raise_error(F.concat(F.col("reject_reason"), F.lit(" at "), F.coalesce(F.col("pos").cast("string"), F.lit("-"))))
        tagged = tagged.withColumns({
            "order_doc": F.when(F.col("reject_reason").isNull(), F.col("order_doc")).otherwise(broken.cast(ORDER)),
            "pos": F.when(F.col("reject_reason").isNull(), F.col("pos")).otherwise(broken.cast("int")),
        })
    elif mode == "skip":
        tagged = tagged.filter("reject_reason is null")
    else:
        raise ValueError(f"mode must be 'fail' or 'skip', not {mode!r}")
    return tagged.drop("element", "reject_reason")


def order_field(name: str) -> Column:
    return F.try_element_at("order_doc", F.lit(name))


def project_by_mapping(df: DataFrame, mapping: dict[str, str]) -> DataFrame:
    """Keep and rename columns per ``{target: source}``; a missing source is an error."""
    missing = sorted(set(mapping.values()) - set(df.columns))
    if missing:
        raise ValueError(f"missing source columns: {', '.join(missing)}")
    return df.select(*[F.col(source).alias(target) for target, source in mapping.items()])


def project_feed(df: DataFrame, mapping: dict[str, str], keep: tuple[str, ...] = ("pos",)) -> DataFrame:
    """``project_by_mapping`` over the fields of feed orders."""
    return df.select(*keep, *[order_field(source).alias(target) for target, source in mapping.items()])


def filter_known_status(df: DataFrame, known: tuple[str, ...], column: str = "purchase_order_status") -> tuple[DataFrame, DataFrame]:
    """``(rows with a listed status, the others)``."""
    listed = F.coalesce(F.col(column).isin(*known), F.lit(False))
    return df.filter(listed), df.filter(~listed)
