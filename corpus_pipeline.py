"""A training corpus from ``documents``: language identification, near-duplicate
removal, benchmark decontamination, redaction of personal data, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; it is written
as Parquet and read again as the next stage's ``docs``. All but the last
return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from stratum.llm import decontaminate, language_id, order_minhash, packing, pii
from stratum.session import scratch_path


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is identified."""
    return language_id.accepted_documents(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates."""
    return order_minhash.deduplicate(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not contaminated by benchmark items."""
    return decontaminate.drop_contaminated(docs, spark.read.parquet(f"{sf_dir.rstrip('/')}/benchmark.parquet"))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with personal data replaced by its kind."""
    return pii.redact(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of full training windows, with their token ids."""
    return packing.pack_documents(docs, with_ids=True)


STAGES = [("language ID", language), ("MinHash near-dedup", near_duplicates),
          ("benchmark decontamination", decontamination), ("PII", personal_data), ("packing", pack)]

#: SQL cannot express language identification, Order MinHash or the tokenizer;
#: the tests compare the stages with brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The packed corpus of ``documents``; each stage is written to shared storage."""
    docs = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
    for name, stage in STAGES:
        path = scratch_path(spark, name.replace(" ", "-"))
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
