"""Corpus pipeline: filter, deduplicate, decontaminate and tokenise documents.

Each stage takes (spark, docs, sf_dir). What it returns is written as Parquet
in the session's shared scratch folder and read again as the next stage's docs,
so a lost executor costs tasks of one stage only. All stages but the last
return the columns of documents.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ratecraft.llm.bpe import encode_documents
from ratecraft.llm.common import Scratch, read_table
from ratecraft.llm.decontamination import drop_contaminated
from ratecraft.llm.jaccard_join import keep_one
from ratecraft.llm.line_dedup import drop_repeated_lines
from ratecraft.llm.queries import vocabulary
from ratecraft.llm.toxicity import drop_toxic

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that aren't predicted toxic."""
    return drop_toxic(docs, read_table(spark, sf_dir, "labels"))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without passages that stand in an earlier one; emptied documents go."""
    return drop_repeated_lines(docs)


def jaccard_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group."""
    return keep_one(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return drop_contaminated(docs, read_table(spark, sf_dir, "benchmark"))


def bpe(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digests of the remaining documents (see encode_documents)."""
    return encode_documents(docs, vocabulary("byte_bpe_50k.json"))


STAGES: list[tuple[str, Stage]] = [
    ("toxicity", toxicity),
    ("line_dedup", line_dedup),
    ("jaccard_join", jaccard_join),
    ("decontamination", decontamination),
    ("bpe", bpe),
]

#: Content-defined chunks, segments and merges have no SQL form; tests/llm compares with brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole documents table; each stage's input is deleted when its output is written."""
    scratch = Scratch(spark, "pipeline")
    docs, written = read_table(spark, sf_dir, "documents"), None
    for _, stage in STAGES:
        out = scratch.write(stage(spark, docs, sf_dir))
        if written is not None:
            scratch.drop(written)
        docs = written = out
    return docs


QUERIES = {"pipeline": run}
ORACLES = {"pipeline": ORACLE_SQL}
