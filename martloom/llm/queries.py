"""One registered query for each operator of this package, over the whole of its table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martloom.llm import bpe, collocations, comparison, langid, merkle, mixing, neighbours, pii, sharding, simhash, syncmers, toxicity, urlfilter, warc
from martloom.llm.common import table


def op1_naive_bayes_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    return toxicity.score(table(spark, folder, "documents"), table(spark, folder, "labels"))


def op2_curriculum_mix(spark: SparkSession, folder: str) -> DataFrame:
    first, again = (F.col("copies")[k] for k in range(mixing.REPEATS))
    return mixing.mix(table(spark, folder, "documents")).select(
        "doc_id", "size", "source_size", "target", "taken", "position", first["taken"].alias("taken_first"),
        again["taken"].alias("taken_again"), again["position"].alias("position_again"),
    )


def op3_closed_syncmers(spark: SparkSession, folder: str) -> DataFrame:
    return syncmers.compare_with_next(table(spark, folder, "documents"))


def op4_two_tier_bpe(spark: SparkSession, folder: str) -> DataFrame:
    return bpe.encode(table(spark, folder, "documents"))


def op5_kmeans_tree(spark: SparkSession, folder: str) -> DataFrame:
    return neighbours.nearest(table(spark, folder, "embeddings"))


def op6_bit_sliced_simhash(spark: SparkSession, folder: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, folder, "documents"))


def op7_warc_derivatives(spark: SparkSession, folder: str) -> DataFrame:
    return warc.derivatives(warc.responses(table(spark, folder, "pages")))


def op8_virtual_slots(spark: SparkSession, folder: str) -> DataFrame:
    return sharding.shard(table(spark, folder, "documents"), 40)


def op9_personal_data(spark: SparkSession, folder: str) -> DataFrame:
    return pii.find(table(spark, folder, "documents"))


def op10_language_spans(spark: SparkSession, folder: str) -> DataFrame:
    return langid.identify(table(spark, folder, "documents"))


def op11_dynamic_collocations(spark: SparkSession, folder: str) -> DataFrame:
    return collocations.collocations(table(spark, folder, "documents"))


def op12_url_rules(spark: SparkSession, folder: str) -> DataFrame:
    return urlfilter.judge(table(spark, folder, "pages"))


def op13_merkle_manifest(spark: SparkSession, folder: str) -> DataFrame:
    return merkle.manifest(table(spark, folder, "documents"))


QUERIES = {
    f.__name__: f
    for f in (
        op1_naive_bayes_toxicity,
        op2_curriculum_mix,
        op3_closed_syncmers,
        op4_two_tier_bpe,
        op5_kmeans_tree,
        op6_bit_sliced_simhash,
        op7_warc_derivatives,
        op8_virtual_slots,
        op9_personal_data,
        op10_language_spans,
        op11_dynamic_collocations,
        op12_url_rules,
        op13_merkle_manifest,
    )
}
ORACLE = {
    "op2_curriculum_mix": comparison.MIX,
    "op7_warc_derivatives": warc.ORACLE,
    "op9_personal_data": comparison.PERSONAL_DATA,
    "op11_dynamic_collocations": collocations.ORACLE,
    "op12_url_rules": urlfilter.ORACLE,
    "op13_merkle_manifest": merkle.ORACLE,
}
