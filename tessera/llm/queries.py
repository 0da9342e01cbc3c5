"""The registered queries of the operators, over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm import (ann, decontamination, fm_index, langid, mixing, quality, sharding, simhash_dedup,
                         spelling, suffix_array, token_alignment, toxicity, url_filter)
from tessera.llm.common import table


def op1_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in 16 shards of nearly equal bytes."""
    out = sharding.assign_shards(table(spark, sf_dir, "documents"), 16)
    return out.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
                      F.lit(None).cast("int").alias("grown_shard"))


def op2_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the 50-byte strings of smaller documents."""
    return suffix_array.dedup(table(spark, sf_dir, "documents")).drop("spans")


def op3_passage_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the 13-word passages of smaller documents."""
    return fm_index.dedup(table(spark, sf_dir, "documents")).drop("spans")


def op4_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 nearest of every vector whose id is divisible by 20."""
    return ann.search(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0, k=20)


def op5_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document that holds a benchmark item, with the item."""
    return decontamination.find_contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op6_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's fingerprint and component of near-duplicates."""
    return simhash_dedup.near_duplicates(table(spark, sf_dir, "documents"))


def op7_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdict on every page's url."""
    return url_filter.judge_urls(table(spark, sf_dir, "pages")).select("page_id", "host", "path", "rule", "verdict")


def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents mixed to their sources' weights."""
    return mixing.mix_documents(table(spark, sf_dir, "documents")).drop("copies")


def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's quality score."""
    return quality.score_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's toxicity score and the byte offsets of its toxic spans."""
    return toxicity.score_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op11_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's tokens of two tokenizers, grouped and linked."""
    return token_alignment.align_tokenizers(table(spark, sf_dir, "documents"))


def op12_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's language."""
    return langid.identify_languages(table(spark, sf_dir, "documents"))


def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every word of all documents with its near words' most frequent form."""
    return spelling.spelling_variants(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (op1_sharding, op2_suffix_dedup, op3_passage_dedup, op4_nearest_neighbours,
                             op5_decontamination, op6_simhash_dedup, op7_url_filter, op8_mixing,
                             op9_quality, op10_toxicity, op11_token_alignment, op12_language_id,
                             op13_spelling_variants)
}
