"""Hand-off between stages, and parameterised reads."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


#: Folders of a run: many vendors share one, so that their number does not grow with the vendors.
BUCKETS = 64
BUCKET = "bucket"


def _bucket(columns: tuple[str, ...]) -> Column:
    return F.pmod(F.xxhash64(*[F.col(c).cast("string") for c in columns]), F.lit(BUCKETS)).cast("int")


def stage_write(df: DataFrame, path: str, run_id: str, fmt: str = "parquet", partition_by: tuple[str, ...] = ("vendor_id",)) -> None:
    """Append a run's records under ``path/run_id=…``; a repeated run replaces its own part.

    Rows are dealt to ``BUCKETS`` folders by ``partition_by`` and sorted by it inside their files: a folder for
    each value would be a file or more a vendor, task and run. Large buckets are cut into several files.
    """
    spread = df.withColumn(BUCKET, _bucket(partition_by)).hint("rebalance", BUCKET)
    ordered = spread.sortWithinPartitions(BUCKET, *partition_by)
    ordered.write.mode("overwrite").partitionBy(BUCKET).format(fmt).save(f"{path}/run_id={run_id}")


def stage_read(
    spark: SparkSession, path: str, schema: str | None = None, fmt: str = "parquet", only: dict[str, object] | None = None
) -> DataFrame:
    """All runs under ``path``; filters on ``run_id`` prune files.

    ``only`` gives each column of the writer's ``partition_by`` one value: only the files of its bucket are read.
    """
    reader = spark.read.format(fmt).option("basePath", path)
    if schema:
        reader = reader.schema(T.StructType.fromDDL(schema).add(BUCKET, T.IntegerType()))
    rows = reader.load(path)
    for column, value in (only or {}).items():
        rows = rows.filter(F.col(column) == F.lit(value))
    if only:
        wanted = spark.range(1).select(*[F.lit(v).alias(c) for c, v in only.items()]).select(_bucket(tuple(only))).first()[0]
        rows = rows.filter(F.col(BUCKET) == wanted)
    return rows.drop(BUCKET)


def table_query(spark: SparkSession, sql: str, tables: dict[str, DataFrame], **args: object) -> DataFrame:
    """A SQL read with named parameters (``:name``) over ``{table}`` placeholders."""
    return spark.sql(sql, args=args, **tables)
