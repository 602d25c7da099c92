"""Tables written to the shared folder between jobs."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import share_library, shared_folder

BATCH_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"
#: Makes workers give large arrays back to the system when they are freed, and Arrow's buffers with them; it costs
#: about a quarter more time where these are made anew all the time.
SMALL_WORKERS = {"MALLOC_MMAP_THRESHOLD_": "1048576", "MALLOC_TRIM_THRESHOLD_": "8388608", "ARROW_DEFAULT_MEMORY_POOL": "system"}


def reach_workers(spark: SparkSession, small: bool = False) -> None:
    """Let Python workers import the library (``share_library``).

    Where the session has Spark's default of rows in an Arrow batch, it gets a smaller one: rows are whole
    texts here, and a batch is held several times over, in the JVM and in Python. ``small`` is for jobs of
    many kinds of work: workers live on between tasks, and what their allocator keeps would add up.
    """
    if spark.conf.get(BATCH_ROWS, "10000") == "10000":
        spark.conf.set(BATCH_ROWS, "2000")
    if small:
        for name, value in SMALL_WORKERS.items():
            spark.sparkContext.environment.setdefault(name, value)
    share_library(spark)


def named_column(name: str) -> Column:
    """The column of exactly this name, which may hold dots."""
    return F.col(f"`{name}`")


def unused(name: str, df: DataFrame) -> str:
    """``name``, with underscores before it until no column of ``df`` has it."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def stored(df: DataFrame, name: str, *partition_by: str) -> DataFrame:
    """Write ``df`` to the folder all executors share, partitioned if asked, and read it back.

    A lost executor then costs a read; nothing is worked out twice.
    """
    path = f"{shared_folder(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    writer = df.write.partitionBy(*partition_by) if partition_by else df.write
    writer.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
