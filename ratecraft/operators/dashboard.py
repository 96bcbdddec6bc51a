"""Queries behind the dashboard: monthly sums, latest month, counters."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ratecraft.operators.mart import MONTH_KEY


def dash_monthly(mart: DataFrame, measures: Sequence[str]) -> DataFrame:
    """Line charts: ``SUM(measure)`` by ``DATE_TRUNC('MONTH', month)``."""
    month = F.date_trunc("MONTH", F.col(MONTH_KEY)).cast("date").alias("month")
    return mart.groupBy(month).agg(*[F.sum(m).alias(f"sum_{m}") for m in measures])


def latest(
    mart: DataFrame, n: int = 1, columns: Sequence[str] | None = None, keys: Sequence[str] = ()
) -> DataFrame:
    """The ``n`` latest months of each series, or of the mart without ``keys``.

    Unkeyed it is ``ORDER BY month DESC LIMIT n``, a top-k sort; keyed, a row
    number by series, of which each map task forwards n rows a series at most.
    """
    if keys:
        w = Window.partitionBy(*keys).orderBy(F.col(MONTH_KEY).desc())
        out = mart.withColumn("_back", F.row_number().over(w)).where(F.col("_back") <= n).drop("_back")
    else:
        out = mart.orderBy(F.col(MONTH_KEY).desc()).limit(n)
    return out.select(*columns) if columns else out


def dash_latest(mart: DataFrame, measures: Sequence[str], keys: Sequence[str] = ()) -> DataFrame:
    """Counters: ``SUM(measure)`` over the latest month's row (of each series)."""
    sums = [F.sum(m).alias(f"sum_{m}") for m in measures]
    rows = latest(mart, 1, keys=keys)
    return rows.groupBy(*keys).agg(*sums) if keys else rows.agg(*sums)


def in_order(mart: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """The mart sorted by key and month (range-partitioned, no single task)."""
    return mart.orderBy(*keys, MONTH_KEY)


def metric_count(mart: DataFrame) -> DataFrame:
    """Dataset measure ``COUNT(*)``."""
    return mart.agg(F.count(F.lit(1)).alias("count"))
