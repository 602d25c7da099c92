"""ERP feed to sales and purchase orders."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.dedup import first_by
from ..operators.lookups import attach_sales_order_id
from ..operators.mutations import bulk_upsert, plain_table, returned_ids
from ..operators.validate import bad_rows, good_rows, load
from ..schemas import PURCHASE_ORDER, SALES_ORDER
from ..session import materialize
from ..sources.feed import filter_known_status, order_field, project_feed, tag_feed, tag_feed_files


@dataclass
class FeedResult:
    """The new tables, and what was not loaded: ``rejects`` are elements that are no orders and documents that are no feeds."""

    sales_order: DataFrame
    purchase_order: DataFrame
    unknown_status: DataFrame
    invalid: DataFrame
    invalid_sales_orders: DataFrame
    rejects: DataFrame


ORDER = "_document"
REJECT = ("pos", "reject_reason", "element")


def placed_bodies(feed: DataFrame, order_by: tuple[str, ...] = ()) -> DataFrame:
    """Tagged elements of feeds in a column ``body``, documents in order of ``order_by`` and text."""
    return tag_feed(feed.withColumn(ORDER, F.struct(*order_by, F.sha2("body", 256).alias("_text"))))


def feed_orders(tagged: DataFrame, mapping: dict[str, str], known: tuple[str, ...]) -> tuple[DataFrame, DataFrame]:
    """Deduplicated, projected feed orders: ``(known status, unknown status)``.

    The first one of equal orders stays: by document, then by the position in it.
    """
    rows = tagged.filter("reject_reason is null").withColumns(
        {"_internalid": order_field("internalid"), "_createdfrom": order_field("createdfrom")}
    )
    projected = project_feed(rows, mapping, keep=(ORDER, "pos", "_internalid", "_createdfrom"))
    unique = first_by(projected, ["_internalid", "_createdfrom"], [ORDER, "pos"]).drop("_internalid", "_createdfrom")
    return filter_known_status(unique, known)


def load_feed(
    feed: DataFrame,
    mapping: dict[str, str],
    known: tuple[str, ...],
    sales_order: DataFrame,
    purchase_order: DataFrame,
    order_by: tuple[str, ...] = (),
    mode: str = "quarantine",
) -> FeedResult:
    """Upsert the orders of feeds in a column ``body``.

    The first one of equal orders stays: by the feed's columns ``order_by`` (file and row,
    say), then by the document's text, then by the position in it. ``mode='fail'`` aborts where
    an element is no order or a body no feed.
    """
    others = tuple(c for c in feed.columns if c != "body")
    return _load(placed_bodies(feed, order_by), mapping, known, sales_order, purchase_order, mode, others)


def load_feed_files(
    spark: SparkSession,
    path: str | list[str],
    mapping: dict[str, str],
    known: tuple[str, ...],
    sales_order: DataFrame,
    purchase_order: DataFrame,
    mode: str = "quarantine",
) -> FeedResult:
    """``load_feed`` for files that are one feed each, in the order of their paths; each is read in many tasks."""
    tagged = tag_feed_files(spark, path).withColumn(ORDER, F.struct("file"))
    return _load(tagged, mapping, known, sales_order, purchase_order, mode, ("file",))


def _load(
    tagged: DataFrame,
    mapping: dict[str, str],
    known: tuple[str, ...],
    sales_order: DataFrame,
    purchase_order: DataFrame,
    mode: str,
    identity: tuple[str, ...],
) -> FeedResult:
    """Upsert tagged elements; the parents first, then the orders with their parents' ids.

    The parsed orders and the new parents are written, since later steps read them
    more than once and must see the same ids.
    """
    rejects = tagged.filter("reject_reason is not null").select(*identity, *REJECT)
    if mode == "fail":
        worst = rejects.first()
        if worst is not None:
            raise ValueError(f"{worst['reject_reason']} (position {worst['pos']})")
    elif mode != "quarantine":
        raise ValueError(f"mode must be 'quarantine' or 'fail', not {mode!r}")
    known_orders, unknown = feed_orders(tagged, mapping, known)
    orders = materialize(known_orders, "feed-orders")
    parents = load(first_by(orders, ["soint_id"], [ORDER, "pos"]), SALES_ORDER)
    new_sales = materialize(bulk_upsert(sales_order, good_rows(parents), SALES_ORDER), "sales-orders")
    ids = returned_ids(new_sales, ["soint_id"])
    keyed = attach_sales_order_id(orders.withColumn("soint_id", F.col("soint_id").try_cast("bigint")), ids)
    children = load(keyed, PURCHASE_ORDER)
    new_orders = bulk_upsert(purchase_order, good_rows(children), PURCHASE_ORDER)
    return FeedResult(
        plain_table(new_sales), plain_table(new_orders), unknown.drop(ORDER), bad_rows(children), bad_rows(parents), rejects
    )
