"""Cleaning of a corpus in stages, each on what the stage before it kept.

A stage is ``(spark, docs, sf_dir) -> DataFrame``; its result is written as Parquet
and read again as the next one's ``docs``. All stages but the last return the
columns of ``docs``.
"""

from __future__ import annotations

import uuid

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orderloom.llm import bpe, decontaminate, langid, minhash, pii
from orderloom.llm.storage import named_column, reach_workers, stored, unused
from orderloom.session import materialize, shared_folder
from orderloom.sizing import broadcast_if_small

#: A language is rejected where no letter gives one, or its mean posterior stays below this.
LEAST_SCORE = 0.4
RANK_FILE = "byte_bpe_multi_50k.tiktoken"


def with_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is identified; the others go.

    The field is fitted on those with a known ``lang`` outside the held-out quarter of
    the ids. Null, empty and letterless texts go. Every row is judged by its own whole text,
    also where its ``doc_id`` is null or repeated. An empty table stays empty.
    """
    reach_workers(spark, small=True)
    share = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4
    field = langid.fit(docs, share != 2)
    answer = unused("answer", docs)
    judged = langid.identify(docs, field, keep=tuple(docs.columns), answer_name=answer)
    identified = (F.col(answer).lang_pred != langid.UNDECIDED) & (F.col(answer).score >= LEAST_SCORE)
    return judged.filter(identified).select(*map(named_column, docs.columns))


def _numbered(docs: DataFrame) -> tuple[DataFrame, str]:
    """``docs`` with a number of its own for every row, written once so that it does not change, and the column's name."""
    name = unused("row", docs)
    return stored(docs.withColumn(name, F.monotonically_increasing_id()), "numbered"), name


def _without(rows: DataFrame, number: str, gone: DataFrame) -> DataFrame:
    """The rows whose number is not in the column ``_row`` of ``gone``, without their numbers."""
    gone = broadcast_if_small(gone.select(F.col("_row").alias(number)))
    return rows.join(gone, number, "left_anti").drop(number)


def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group that is linked by four fifths of its five-word shingles, the one with the smallest ``doc_id``.

    Every row is judged by its own text, also where its ``doc_id`` is null or repeated; a
    null id comes last. Rows without words are linked with nothing and stay. Repeated rows
    are copies. Texts are compared whole; an empty table stays empty.
    """
    reach_workers(spark, small=True)
    numbered, number = _numbered(docs)
    rows = numbered.select(F.col(number).alias("_row"), "doc_id", "text")
    verdict = minhash.near_duplicates(rows.select(F.col("_row").alias("doc_id"), "text"), shingle=5, percent=80)
    copies = materialize(verdict.filter("not kept").select(F.col("doc_id").alias("_row"), "component_id"), "copies")
    first = copies.select(F.col("component_id").alias("_row"), "component_id").distinct()
    members = copies.unionByName(first)
    order = F.struct(F.col("doc_id").isNull().alias("null"), "doc_id", "_row")
    best = members.join(rows.select("_row", "doc_id"), "_row").groupBy("component_id").agg(F.min(order).alias("m")).select("m._row")
    gone = materialize(members.select("_row").join(best, "_row", "left_anti"), "gone")
    return _without(numbered, number, gone)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows in whose text no benchmark item occurs, whatever their ``doc_id``.

    Null and empty texts hold none. Repeated rows stay or go together. Texts are searched whole;
    an empty table stays empty.
    """
    reach_workers(spark, small=True)
    numbered, number = _numbered(docs)
    rows = numbered.select(F.col(number).alias("doc_id"), "text")
    found = decontaminate.contaminated(rows, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    flagged = materialize(found.select(F.col("doc_id").alias("_row")).distinct(), "flagged")
    return _without(numbered, number, flagged)


def without_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts with every personal span replaced by its kind; a null text stays null, ``n_chars`` follows the text.

    Rows keep their other columns, whatever these are called; repeated rows are masked alike.
    Texts are read whole; an empty table stays empty.
    """
    reach_workers(spark, small=True)
    others = [c for c in docs.columns if c != "text"]
    packed = docs.select("text", F.col("text").isNull().alias("lost"), F.struct(*map(named_column, others)).alias("kept"))
    found = pii.find(packed, pii.train(docs)).select("kept", "lost", "found", F.expr(pii.masked()).alias("text"))
    columns = {c: F.col("kept").getField(c) for c in others} | {"text": F.when(~F.col("lost"), F.col("text"))}
    if "n_chars" in others:
        columns["n_chars"] = F.when(F.size("found") > 0, F.length("text").cast("long")).otherwise(columns["n_chars"])
    return found.select(*[columns[c].alias(c) for c in docs.columns])


def as_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The token ids of every text, with the hashes that prove the round trip.

    A null text counts as empty. Every row is encoded, repeated ones and those without a ``doc_id``
    too, whole texts each; only ``doc_id`` and ``text`` are read. An empty table gives no rows.
    """
    reach_workers(spark, small=True)
    return bpe.encode_documents(docs, public_tokenizers.path(RANK_FILE), public_tokenizers.PATTERN, forget=True)


STAGES = [
    ("language ID", with_language),
    ("MinHash near-dedup", without_near_copies),
    ("benchmark decontamination", without_benchmark),
    ("PII", without_personal_data),
    ("byte-level BPE", as_tokens),
]

#: Fitted models, near-duplicate search and BPE are beyond SQL; the stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is written to the shared folder and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    root = f"{shared_folder(spark)}/pipeline-{uuid.uuid4().hex}"
    for i, (_, stage) in enumerate(STAGES):
        out = stage(spark, docs, sf_dir)
        path = f"{root}/{i}"
        out.write.parquet(path)
        docs = spark.read.schema(out.schema).parquet(path)
    return docs
