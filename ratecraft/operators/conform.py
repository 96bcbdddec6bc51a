"""Conform raw Bronze records into typed series with one row per business key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ratecraft.functions.parsing import month_of, parse_date, parse_rate
from ratecraft.specs import MONTH, SeriesSpec

LINEAGE = ["source_file", "source_path", "source_modified_at", "ingestion_timestamp"]


def dedup_latest(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """Keep the first row of every key under ``order`` (newest first).

    ``row_number() == 1`` is planned as a partial ``WindowGroupLimit`` before
    the shuffle: each map task forwards at most one row per key, so even a
    key holding a third of all rows arrives at its reducer as one row per
    map task. ``order`` must be a total order within a key for the result
    to be the same on every run.
    """
    w = Window.partitionBy(*keys).orderBy(*order)
    return (
        df.withColumn("_latest_rank", F.row_number().over(w))
        .where(F.col("_latest_rank") == 1)
        .drop("_latest_rank")
    )


def packed_order(*parts: tuple[Column, int]) -> Column:
    """One bigint that orders rows as ``parts`` do, the first part first: (integer column, its bits).

    A value takes ``bits`` of it, NULL being below all others. Values that are
    negative or too wide fail the query: the order is exact or there is none.
    """
    if sum(bits for _, bits in parts) > 63:
        raise ValueError("a packed order has 63 bits")
    out = F.lit(0).cast("bigint")
    for column, bits in parts:
        value = column.cast("bigint")
        fits = F.coalesce(value.between(0, (1 << bits) - 2), F.lit(True))
        place = F.when(fits, F.coalesce(value + 1, F.lit(0))).otherwise(F.raise_error(F.lit(f"a value doesn't fit {bits} bits")).cast("bigint"))
        out = F.shiftleft(out, bits).bitwiseOR(place)
    return out


def latest_by(df: DataFrame, keys: Sequence[str | Column], order: Column, values: Sequence[str]) -> DataFrame:
    """``values`` of each key's row with the highest ``order`` (one fixed-width value, such as
    :func:`packed_order`, distinct within a key).

    For fixed-width values this is a hash aggregate: one row a key leaves each map
    task, and nothing is sorted before the shuffle, unlike :func:`dedup_latest`,
    which takes any order and any columns.
    """
    return df.groupBy(*keys).agg(*(F.max_by(v, order).alias(v) for v in values))


def newest_first(*then: Column) -> list[Column]:
    """Ingestion order, newest first, with tie-breaks for one micro-batch.

    Records of one batch share an ingestion time, so the file's modification
    time and path decide between files, and ``then`` decides within a file.
    """
    return [
        F.col("ingestion_timestamp").desc(),
        F.col("source_modified_at").desc(),
        F.col("source_path").desc(),
        *then,
    ]


def typed_series(bronze: DataFrame, spec: SeriesSpec, raw: bool = False) -> DataFrame:
    """Parse date and rate; add the month key for monthly series (and keep the raw texts with ``raw``).

    Bad dates and unparsable rates become NULL (never a failed task); the
    quality rules count them.
    """
    date = parse_date("data_raw")
    cols = [
        F.col("series_name"),
        date.alias("reference_date"),
        parse_rate("valor_raw").alias(spec.rate_column),
        *[F.col(c) for c in LINEAGE],
    ]
    if spec.grain == MONTH:
        cols.append(month_of(date).alias("reference_month"))
    if raw:
        cols += [F.col("data_raw"), F.col("valor_raw")]
    return bronze.select(cols)


def record_order(spec: SeriesSpec) -> list[str]:
    """Columns by which the newest record of a key is the highest (see :func:`newest_first`)."""
    return ["ingestion_timestamp", "source_modified_at", "source_path", "reference_date", spec.rate_column]


def latest_records(typed: DataFrame, spec: SeriesSpec) -> DataFrame:
    """Latest record per (series, date or month) of a typed series."""
    order = newest_first(F.col("reference_date").desc(), F.col(spec.rate_column).desc())
    return dedup_latest(typed, spec.business_key, order)


def conform(bronze: DataFrame, spec: SeriesSpec) -> DataFrame:
    """Typed series, latest record per (series, date or month)."""
    return latest_records(typed_series(bronze, spec), spec)


def broken_rule(spec: SeriesSpec) -> Column:
    """The first row rule that a typed record breaks, null if none."""
    rate = F.col(spec.rate_column)
    return (
        F.when(F.col(spec.key_column).isNull(), F.lit("no valid date"))
        .when(rate.isNull(), F.lit("no valid rate"))
        .when(~rate.between(spec.rate_min, spec.rate_max), F.lit("rate out of range"))
    )
