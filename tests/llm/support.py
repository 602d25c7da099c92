"""Small tables for the operators' tests, and what the contracts call words."""

from __future__ import annotations

import random
import re

from pyspark.sql import DataFrame, SparkSession

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
SMALL = "/root/testdata/sf0.001"


def documents(spark: SparkSession, rows: list[tuple], schema: str = "doc_id long, text string") -> DataFrame:
    return spark.createDataFrame(rows, schema)


def words(text: str | None) -> list[str]:
    lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return re.findall("[^\x20\x09-\x0d]+", lowered)


def prose(rng: random.Random, n: int, vocabulary: int = 500) -> str:
    return " ".join(f"w{rng.randrange(vocabulary)}" for _ in range(n))


def clashing(df: DataFrame) -> DataFrame:
    """Extra columns named as ones the operators use themselves."""
    names = ("n_shingles", "u", "v", "key", "label", "block", "words", "score", "base", "found", "kept", "g", "th", "held", "c", "pieces")
    return df.selectExpr("*", *[f"'x' as {n}" for n in names if n not in df.columns])
