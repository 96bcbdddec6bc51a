"""Registered queries of the corpus operators, each over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ratecraft.llm import oracles, quality, toxicity
from ratecraft.llm.bpe import encode_documents
from ratecraft.llm.clustering import centroid_digest, cluster_vectors
from ratecraft.llm.common import read_table
from ratecraft.llm.decontamination import contaminated
from ratecraft.llm.embedding_dedup import near_duplicates
from ratecraft.llm.html_extract import extract_pages
from ratecraft.llm.jaccard_join import jaccard_classes
from ratecraft.llm.line_dedup import dedup_lines
from ratecraft.llm.sharding import shard_documents
from ratecraft.llm.token_output import token_digest
from ratecraft.llm.url_filters import judge_urls
from ratecraft.llm.vector_codes import compress_vectors


def vocabulary(name: str) -> str:
    """Place of a public tokenizer's file; the operators take any path."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge_urls(read_table(spark, sf_dir, "pages"), read_table(spark, sf_dir, "labels"))


def op2_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode_documents(read_table(spark, sf_dir, "documents"), vocabulary("byte_bpe_50k.json"))


def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.score_documents(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.score_documents(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


def op5_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = dedup_lines(read_table(spark, sf_dir, "documents"))
    return out.select("doc_id", "text", "n_chunks", "n_removed", "words_removed")


def op6_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract_pages(read_table(spark, sf_dir, "pages"))


def op7_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(read_table(spark, sf_dir, "embeddings"))


def op8_token_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_digest(read_table(spark, sf_dir, "documents"), vocabulary("word_bpe_49k.json"))


def op9_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contaminated(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))


def op10_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_classes(read_table(spark, sf_dir, "documents")).select("doc_id", "n_shingles", "component_id")


def op11_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = shard_documents(read_table(spark, sf_dir, "documents"))
    crc = F.crc32(F.coalesce(F.col("text"), F.lit("")))
    return placed.select(
        "doc_id", "size", crc.alias("text_crc32"), F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )


def op12_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded = compress_vectors(read_table(spark, sf_dir, "embeddings"))
    return coded.select("vec_id", F.lower(F.hex("codes")).alias("code"), "error", "label_error", "codebooks_sha256")


def op13_clustering(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = cluster_vectors(read_table(spark, sf_dir, "embeddings"))
    return found.select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", centroid_digest().alias("centroid_sha256"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_url_filters,
        op2_bpe,
        op3_quality,
        op4_toxicity,
        op5_line_dedup,
        op6_html_extraction,
        op7_embedding_near_dedup,
        op8_token_output,
        op9_benchmark_decontamination,
        op10_jaccard_join,
        op11_sharding,
        op12_vector_codes,
        op13_clustering,
    )
}
ORACLES: dict[str, str] = {
    "op7_embedding_near_dedup": oracles.OP7,
    "op10_jaccard_join": oracles.OP10,
    "op11_sharding": oracles.OP11,
    "op12_vector_codes": oracles.OP12,
    "op13_clustering": oracles.OP13,
}
