"""Aggregations."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import item_no_fallback


def object_agg(df: DataFrame, keys: list[str], name: str, value: str, order: str, out: str = "object") -> DataFrame:
    """Map ``name -> value`` per group; the last value of a name wins.

    Values are reduced per name before anything is gathered, so the gathered
    list has one entry per distinct name however many rows a group has.
    """
    latest = df.groupBy(*keys, name).agg(F.max_by(value, order).alias(value))
    return latest.groupBy(*keys).agg(
        F.map_from_entries(F.sort_array(F.collect_list(F.struct(name, value)))).alias(out)
    )


def key_to_id(rows: DataFrame, key: str, value: str = "id") -> DataFrame:
    """Natural key to generated id, one row per key."""
    return rows.groupBy(key).agg(F.min(value).alias(value))


def item_object() -> Column:
    """JSON text of one bill item; the manufacturer's number only where there is one."""
    base = [
        item_no_fallback(F.col("itemno"), F.col("mfg_itemno")).alias("itemno"),
        F.col("amount"),
        F.col("rate"),
        F.col("quantity"),
    ]
    options = {"ignoreNullFields": "false"}
    return F.when(
        F.col("mfg_itemno").isNotNull(), F.to_json(F.struct(*base, F.col("mfg_itemno")), options)
    ).otherwise(F.to_json(F.struct(*base), options))


def item_objects(items: DataFrame) -> DataFrame:
    """``(vendor_invoice_id, item)`` for items with a positive quantity."""
    return items.filter(F.col("quantity") > 0).select("vendor_invoice_id", item_object().alias("item"))


def items_object_array(items: DataFrame) -> DataFrame:
    """Per invoice the JSON array of its item objects, in text order.

    Equal objects are counted before they are gathered: an invoice with very
    many repeated lines crosses the shuffle as its distinct lines. The array
    itself is the result and is as long as the invoice.
    """
    counted = item_objects(items).groupBy("vendor_invoice_id", "item").agg(F.count("*").cast("int").alias("_n"))
    entries = F.sort_array(F.collect_list(F.struct("item", "_n")))
    repeated = F.flatten(F.transform(entries, lambda e: F.array_repeat(e["item"], e["_n"])))
    return counted.groupBy("vendor_invoice_id").agg(
        F.concat(F.lit("["), F.array_join(repeated, ","), F.lit("]")).alias("items")
    )


def group_distinct(df: DataFrame, columns: list[str]) -> DataFrame:
    return df.select(*columns).distinct()


def distinct_invoices(*batches: DataFrame) -> DataFrame:
    """Set of invoice numbers over all batches."""
    pooled = batches[0].select("invoice_number")
    for batch in batches[1:]:
        pooled = pooled.unionByName(batch.select("invoice_number"))
    return pooled.filter(F.col("invoice_number").isNotNull()).distinct()


def order_total_long(lines: DataFrame, keys: list[str], ship_cost: str) -> DataFrame:
    """Σ amount + ship cost per group from rows ``(keys, amount, ship_cost)``."""
    return lines.groupBy(*keys).agg(
        (F.coalesce(F.sum("amount"), F.lit(0.0)) + F.coalesce(F.max(ship_cost), F.lit(0.0))).alias("total")
    )


def unbilled_invoice_filter(invoices: DataFrame, outcomes: DataFrame) -> DataFrame:
    """Invoices without a billing outcome: no success flag, message or bill id."""
    done = outcomes.filter(
        F.col("success").isNotNull() | F.col("message").isNotNull() | F.col("vendor_bill_id").isNotNull()
    ).select(F.col("vendor_invoice_id").alias("id"))
    return invoices.join(done, "id", "left_anti").select(*invoices.columns)


def route_by_outcome(df: DataFrame, stage: str, reason: str = "reject_reason") -> tuple[DataFrame, DataFrame]:
    """``(rows that go on, summary rows of those that do not)``."""
    failed = F.col(reason).isNotNull()
    return df.filter(~failed).drop(reason), df.filter(failed).select(
        F.lit(stage).alias("stage"), *[c for c in df.columns if c != reason], F.col(reason).alias("reason")
    )


def stage_outcomes(df: DataFrame, stage: str, rec_id: str, done: str, reason: str = "reject_reason") -> DataFrame:
    """One outcome row ``(stage, rec_id, conclusion, response_code, reason)`` per record.

    ``done`` names the success, e.g. ``extracted``; failures read ``not extracted``.
    """
    ok = F.col(reason).isNull()
    return df.select(
        F.lit(stage).alias("stage"),
        F.col(rec_id).cast("string").alias("rec_id"),
        F.when(ok, done).otherwise(f"not {done}").alias("conclusion"),
        F.when(ok, 200).otherwise(500).alias("response_code"),
        F.col(reason).alias("reason"),
    )


def run_summary(*outcomes: DataFrame) -> DataFrame:
    """Counts per stage, conclusion, code and reason over all stages."""
    merged = outcomes[0]
    for o in outcomes[1:]:
        merged = merged.unionByName(o)
    return merged.groupBy("stage", "conclusion", "response_code", "reason").agg(F.count("*").alias("n"))
