"""From raw documents to packed training sequences.

Each stage reads what its predecessor kept and its decisions take effect: bad texts,
later near copies and contaminated texts go, personal data is masked, the rest is
packed. Every stage but the last returns the columns of ``documents``. Between stages
the rows are written as Parquet below ``spark.checkpoint.dir`` and read again, so a
lost executor costs at most a part of one stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vectrine.llm.classifier import keep_good
from vectrine.llm.common import shared_dir, table
from vectrine.llm.decontaminate import drop_contaminated
from vectrine.llm.packing import pack
from vectrine.llm.pii import redact
from vectrine.llm.queries import vocabulary
from vectrine.llm.simhash import keep_one

# Workers that went through all other stages have less memory to spare for the tokenizer.
CACHED_SEGMENTS = 100_000
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the compression classifier scores one half or more."""
    return keep_good(docs, docs, table(spark, sf_dir, "labels")).select(COLUMNS)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: that with the smallest id."""
    return keep_one(docs, shingle=3, radius=2).select(COLUMNS)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that share no window of ten words with a benchmark item."""
    return drop_contaminated(docs, table(spark, sf_dir, "benchmark")).select(COLUMNS)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, personal data masked; ``n_chars`` follows the text."""
    return redact(docs).withColumn("n_chars", F.coalesce(F.length("text").cast("long"), F.col("n_chars"))).select(COLUMNS)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every piece of every document with its sequence and offset."""
    return pack(docs, vocabulary(), cached=CACHED_SEGMENTS)


STAGES = [
    ("quality", quality),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("personal_data", personal_data),
    ("packing", packing),
]

# Compression sizes, XXH64 majorities and tokenisation have no SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; returns the rows of the last."""
    folder, docs = shared_dir(spark), table(spark, sf_dir, "documents")
    for i, (name, stage) in enumerate(STAGES):
        path = f"{folder}/{i}-{name}"
        stage(spark, docs, sf_dir).write.mode("overwrite").parquet(path)
        docs = spark.read.parquet(path)
    return docs
