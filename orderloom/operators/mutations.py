"""Keyed table changes as DataFrame functions: ``(target, source) -> new target``.

Plain parquet has no MERGE, so a change is a join that yields the new rows; the
caller writes them to a new path, or replaces the touched partitions
(``streaming.ingest``).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..schemas import PURCHASE_ORDER, SALES_ORDER, VENDOR_INVOICE, Table
from ..sizing import repeat_rows

NO_INVOICE = "-1"


def _now() -> Column:
    return F.current_timestamp().cast("timestamp_ntz")


def key_columns(table: Table) -> list[Column]:
    """The unique key as columns that compare NULLs: a missing invoice number reads ``-1``."""
    return [
        (F.coalesce(F.col(k), F.lit(NO_INVOICE)) if table.columns[k] == "string" else F.col(k)).alias(f"_k{i}")
        for i, k in enumerate(table.key)
    ]


def key_text(keys: list[str]) -> Column:
    return F.concat_ws("|", *[F.coalesce(F.col(k).cast("string"), F.lit(NO_INVOICE)) for k in keys])


def assign_ids(
    new_rows: DataFrame,
    target: DataFrame,
    keys: list[str],
    hex_digits: int = 3,
    id_column: str = "id",
    id_source: DataFrame | None = None,
) -> DataFrame:
    """Dense ids after the target's highest one, in order of a hash of the key.

    ``id_source`` stands in for ``target`` where only a part of the table is at hand.

    Rows are numbered inside ``16 ** hex_digits`` hash buckets, and a prefix sum
    over the bucket sizes (at most that many rows) gives each bucket its start.
    No task sees more than one bucket, and the ids depend on the keys alone, so a
    recomputed partition gives the same ones. ``keys`` must be unique.
    """
    text = key_text(keys)
    bucketed = new_rows.withColumn("_text", text).withColumn("_b", F.substring(F.md5("_text"), 1, hex_digits))
    ranked = bucketed.withColumn("_rn", F.row_number().over(Window.partitionBy("_b").orderBy("_text")))
    sizes = new_rows.select(F.substring(F.md5(text), 1, hex_digits).alias("_b")).groupBy("_b").agg(F.count("*").alias("_n"))
    before = F.coalesce(F.sum("_n").over(Window.orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    starts = sizes.select("_b", before.alias("_before"))
    highest = (target if id_source is None else id_source).agg(F.coalesce(F.max(id_column), F.lit(0)).cast("bigint").alias("_top"))
    top = highest.select("_top").scalar()
    numbered = ranked.join(F.broadcast(starts), "_b")  # at most 16 ** hex_digits rows
    made = (top + F.col("_before") + F.col("_rn")).cast("bigint").alias(id_column)
    rest = [c for c in new_rows.columns if c not in (id_column, "created_at", "modified_at")]
    return numbered.select(made, *rest)


def insert_rows(target: DataFrame, rows: DataFrame, keys: list[str], returning: bool = False) -> DataFrame:
    """Target plus the new rows with generated ids and ``created_at``; or the new rows alone."""
    numbered = assign_ids(rows, target, keys).withColumn("created_at", _now())
    new = _like(target, numbered)
    return new if returning else target.unionByName(new)


def _like(target: DataFrame, rows: DataFrame) -> DataFrame:
    return rows.select(
        *[
            (F.col(f.name).cast(f.dataType) if f.name in rows.columns else F.lit(None).cast(f.dataType)).alias(f.name)
            for f in target.schema.fields
        ]
    )


def update_by_key(target: DataFrame, changes: DataFrame, key: str = "id") -> DataFrame:
    """Set the other columns of ``changes`` where the key matches; touches ``modified_at``.

    One change per key; unmatched rows stay as they are.
    """
    columns = [c for c in changes.columns if c != key]
    renamed = changes.select(key, F.lit(True).alias("_hit"), *[F.col(c).alias(f"_new_{c}") for c in columns])
    joined = target.join(renamed, key, "left")

    def value(name: str) -> Column:
        if name in columns:
            return F.when(F.col("_hit"), F.col(f"_new_{name}")).otherwise(F.col(name)).alias(name)
        if name == "modified_at":
            return F.when(F.col("_hit"), _now()).otherwise(F.col(name)).alias(name)
        return F.col(name)

    return joined.select(*[value(c) for c in target.columns])


def unique_source(source: DataFrame, table: Table, on_duplicate: str = "fail") -> DataFrame:
    """One source row per key; a repeated key aborts the job, as it does in one upsert statement.

    ``on_duplicate='any'`` keeps one of the rows.
    """
    counted = source.groupBy(*key_columns(table)).agg(
        F.count("*").alias("_n"), F.first(F.struct(*[F.col(c) for c in source.columns])).alias("_row")
    )
    if on_duplicate == "fail":
        names = [f"_k{i}" for i in range(len(table.key))]
        message = F.concat(F.lit(f"{table.name}: key occurs twice: "), F.concat_ws("|", *names))
        row = F.when(F.col("_n") == 1, F.col("_row")).otherwise(
            F.raise_error(message).cast(source.schema.simpleString())
        )
        counted = counted.withColumn("_row", row)
    elif on_duplicate != "any":
        raise ValueError(f"on_duplicate must be 'fail' or 'any', not {on_duplicate!r}")
    return counted.drop("_n")


def _by_piece_and_text(a: Column, b: Column) -> Column:
    less = (a["_p"] < b["_p"]) | ((a["_p"] == b["_p"]) & (a["_t"] < b["_t"]))
    return F.when(less, -1).when((a["_p"] == b["_p"]) & (a["_t"] == b["_t"]), 0).otherwise(1)


def merge_by_key(source: DataFrame, table: Table, nested: str, piece: str = "piece") -> DataFrame:
    """One source row per key: rows of one key give the first one's values and all their ``nested`` elements.

    First is by ``piece`` (dropped here; 0 where there is none), then by the row's text; rows that agree in
    everything are one. Only keys that occur more than once are gathered.
    """
    placed = source if piece in source.columns else source.withColumn(piece, F.lit(0))
    columns = [c for c in placed.columns if c != piece]
    names = [f"_k{i}" for i in range(len(table.key))]
    keyed = placed.select(*key_columns(table), "*")
    several = keyed.groupBy(*names).agg(F.count("*").alias("_n")).filter("_n > 1").drop("_n")
    once = keyed.join(several, names, "left_anti").select(*columns)
    text = F.to_json(F.struct(*columns))
    row = F.struct(F.col(piece).alias("p"), text.alias("t"), F.struct(*columns).alias("r"))
    again = keyed.join(several, names, "left_semi").withColumn("_row", row)
    gathered = again.groupBy(*names, F.col("_row.p").alias("_p"), F.col("_row.t").alias("_t")).agg(F.first("_row.r").alias("_r"))
    ordered = F.transform(
        F.array_sort(F.collect_list(F.struct("_p", "_t", "_r")), _by_piece_and_text), lambda x: x["_r"]
    )
    merged = gathered.groupBy(*names).agg(ordered.alias("_rows"))
    elements = F.flatten(F.transform("_rows", lambda r: F.coalesce(r[nested], F.array().cast(source.schema[nested].dataType))))
    first = [F.col("_rows")[0][c].alias(c) if c != nested else elements.alias(nested) for c in columns]
    return once.unionByName(merged.select(*first))


def bulk_upsert(
    target: DataFrame,
    source: DataFrame,
    table: Table,
    update: str | tuple[str, ...] = "declared",
    on_duplicate: str = "fail",
    id_source: DataFrame | None = None,
) -> DataFrame:
    """Upsert ``source`` into ``target`` on the table's key.

    ``update`` says what a match changes: ``'declared'`` the table's own list,
    ``'all'`` every non-key column the source has, ``'nothing'`` leaves the row,
    or a tuple of columns. New rows get ids. The result has ``_change``:
    ``inserted``, ``updated`` or NULL.
    """
    names = [f"_k{i}" for i in range(len(table.key))]
    writable = [c for c in source.columns if c in table.columns]
    if update == "declared":
        columns = list(table.on_conflict)
    elif update == "all":
        columns = [c for c in writable if c not in table.key]
    elif update == "nothing":
        columns = []
    else:
        columns = list(update)
    incoming = unique_source(source.select(*writable), table, on_duplicate)
    existing = target.select(*key_columns(table), *target.columns)

    changes = incoming.select(*names, F.col("_row").alias("_src"))
    # Matched and untouched rows: the target's row with the listed columns replaced.
    merged = existing.join(changes, names, "left")
    hit = F.col("_src").isNotNull()

    def value(name: str) -> Column:
        if name in columns and name in writable:
            return F.when(hit, F.col(f"_src.{name}")).otherwise(F.col(name)).alias(name)
        if name == "modified_at" and columns:
            return F.when(hit, _now()).otherwise(F.col(name)).alias(name)
        return F.col(name)

    kept = merged.select(
        *[value(c) for c in target.columns],
        (F.when(hit, F.lit("updated")) if columns else F.lit(None).cast("string")).alias("_change"),
    )
    fresh = changes.join(existing.select(*names), names, "left_anti").select("_src.*")
    numbered = assign_ids(fresh, target, list(table.key), id_source=id_source).withColumn("created_at", _now())
    inserted = _like(target, numbered).withColumn("_change", F.lit("inserted"))
    return kept.unionByName(inserted)


def returned_ids(upserted: DataFrame, key: list[str]) -> DataFrame:
    """Natural key and id of the rows an upsert inserted or updated."""
    return upserted.filter(F.col("_change").isNotNull()).select(*key, "id")


def plain_table(upserted: DataFrame) -> DataFrame:
    return upserted.drop("_change")


def upsert_sales_orders(target: DataFrame, source: DataFrame) -> DataFrame:
    return bulk_upsert(target, source, SALES_ORDER)


def upsert_purchase_orders(target: DataFrame, source: DataFrame) -> DataFrame:
    return bulk_upsert(target, source, PURCHASE_ORDER)


def upsert_invoices(target: DataFrame, source: DataFrame) -> DataFrame:
    return bulk_upsert(target, source, VENDOR_INVOICE)


def replace_children(
    target: DataFrame,
    new_rows: DataFrame,
    parents: DataFrame,
    parent_key: str,
    id_source: DataFrame | None = None,
) -> DataFrame:
    """Drop all children of the touched parents and add the new ones.

    Children have no natural key, so their ids are numbered by a hash of the
    whole row and a running number among equal rows.
    """
    kept = target.join(parents.select(parent_key).distinct(), parent_key, "left_anti").select(*target.columns)
    columns = list(new_rows.columns)
    whole_row = F.to_json(F.struct(*columns, "_copy"), {"ignoreNullFields": "false"})
    counted = new_rows.groupBy(*columns).agg(F.count("*").alias("_n"))
    copies = repeat_rows(counted, "_n", "_copy")
    keyed = copies.withColumn("_row_text", whole_row)
    numbered = assign_ids(keyed, target, ["_row_text"], id_source=id_source).withColumn("created_at", _now())
    return kept.unionByName(_like(target, numbered))


def unnest_parallel_arrays(df: DataFrame, arrays: list[str]) -> DataFrame:
    """Rows of N arrays zipped by position; shorter ones are padded with NULL."""
    others = [c for c in df.columns if c not in arrays]
    return df.select(*others, F.inline(F.arrays_zip(*arrays)))


def update_bill_results(outcomes: DataFrame, arrays: DataFrame) -> DataFrame:
    """Set success, bill id and message by id from four parallel arrays."""
    changes = unnest_parallel_arrays(arrays, ["success", "vendor_bill_id", "message", "id"])
    return update_by_key(outcomes, changes, "id")


def update_order_status(orders: DataFrame, arrays: DataFrame) -> DataFrame:
    """Set the order status by ``point_id`` from two parallel arrays."""
    changes = unnest_parallel_arrays(arrays, ["point_id", "purchase_order_status"])
    return update_by_key(orders, changes, "point_id")


def check_unique(df: DataFrame, table: Table) -> DataFrame:
    """Keys that occur more than once, with their count."""
    names = [f"_k{i}" for i in range(len(table.key))]
    counted = df.groupBy(*key_columns(table)).agg(F.count("*").alias("n")).filter("n > 1")
    return counted.select(*[F.col(a).alias(b) for a, b in zip(names, table.key)], "n")


def check_foreign_keys(df: DataFrame, column: str, parent: DataFrame) -> DataFrame:
    """Rows whose parent does not exist."""
    ids = parent.select(F.col("id").alias(column))
    return df.filter(F.col(column).isNotNull()).join(ids, column, "left_anti").select(*df.columns)
