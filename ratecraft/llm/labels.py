"""Labelled training rows: a bounded sample, and the split into training and held-out rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Most labelled rows that a classifier is fitted on: those of smallest id hash.
#: Label samples are broadcast, 16 bytes a row.
TRAINING_ROWS = 30_000


def fold(doc_id: str, folds: int) -> Column:
    """crc32 of the id's text, modulo the number of folds (null for a null id)."""
    return F.crc32(F.col(doc_id).cast("string").cast("binary")) % folds


def training_labels(labels: DataFrame, label: str, folds: int, held_out: int) -> DataFrame:
    """(doc_id, label) of at most TRAINING_ROWS rows outside the held-out fold.

    Rows without id or with a label other than 0 and 1 are left out; an id with
    several labels counts with the largest.
    """
    rows = (
        labels.filter(F.col("doc_id").isNotNull() & F.col(label).isin(0, 1) & (fold("doc_id", folds) != held_out))
        .groupBy("doc_id")
        .agg(F.max(F.col(label).cast("int")).alias("label"))
    )
    return rows.orderBy(F.xxhash64("doc_id"), "doc_id").limit(TRAINING_ROWS)
