"""From raw documents to an encoded training set: the stages in order, each on what the one before kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martloom.llm import bpe, langid, mixing, pii, simhash
from martloom.llm.common import bound_batches
from martloom.session import materialize


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents without any letter (`und`). The label `lang` stays as it was given."""
    bound_batches(spark)
    model = langid.fit_or_none(docs)
    if model is None:
        return docs
    found = docs.withColumn("__language", langid.language(F.col("text"), model)["lang"])
    return found.where(F.col("__language") != langid.UNKNOWN).drop("__language")


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of linked documents the one with the smallest id stays."""
    bound_batches(spark)
    return simhash.keep_one(docs)


def mask_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Confirmed spans become [EMAIL], [IP], [CARD], [PHONE], [IBAN] or [SSN]; every document stays."""
    return docs.withColumn("text", pii.masked(F.col("text")))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A row for each copy that the mix takes, by training position."""
    return mixing.training_set(docs)


def encode_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, source, token ids, their number, and the digests of the ids and of the decoded bytes."""
    bound_batches(spark)
    return docs.select("doc_id", "source", bpe.encoded(F.col("text")).alias("e")).select("doc_id", "source", "e.*")


STAGES = [
    ("language", identify_language),
    ("near_duplicates", drop_near_duplicates),
    ("personal_data", mask_personal_data),
    ("mixing", mix_sources),
    ("tokens", encode_tokens),
]

#: The models and hashes of the stages cannot be written in SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return docs
