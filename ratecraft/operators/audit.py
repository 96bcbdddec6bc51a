"""Audits over the layers: counts per table, grain, window coverage, gaps, reruns."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ratecraft.operators.mart import MONTH_KEY, rolling_window
from ratecraft.specs import WINDOW_MONTHS


def table_counts(name: str, df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``(table_name, total_rows, distinct_keys, distinct_known_keys)`` for one table.

    ``distinct_keys`` counts distinct rows of the key columns, a NULL being a
    value like any other; ``distinct_known_keys`` is SQL's ``COUNT(DISTINCT)``,
    which leaves out keys with a NULL. One row per key and map task is shuffled.
    """
    known = F.lit(True)
    for k in keys:
        known &= F.col(k).isNotNull()
    per_key = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_rows"))
    return per_key.agg(
        F.lit(name).alias("table_name"),
        F.coalesce(F.sum("_rows"), F.lit(0)).alias("total_rows"),
        F.count(F.lit(1)).alias("distinct_keys"),
        F.count_if(known).alias("distinct_known_keys"),
    )


def audit_counts(tables: Sequence[tuple[str, DataFrame, Sequence[str]]]) -> DataFrame:
    """UNION ALL of :func:`table_counts` over the given tables."""
    parts = [table_counts(name, df, keys) for name, df, keys in tables]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def grain_check(spark: SparkSession, mart: DataFrame, month_col: str = MONTH_KEY) -> DataFrame:
    """Rows, distinct months, first and last month, as SQL over the mart.

    The DataFrame is passed as a SQL argument: Spark registers it as a
    temporary view for the analysis and drops the view afterwards.
    """
    return spark.sql(
        f"""
        SELECT COUNT(*) AS total_rows,
               COUNT(DISTINCT {month_col}) AS distinct_months,
               MIN({month_col}) AS first_month,
               MAX({month_col}) AS last_month
        FROM {{mart}}
        """,
        mart=mart,
    )


def window_coverage(mart: DataFrame, accumulated_col: str) -> DataFrame:
    """Total rows, rows without a full window (NULL accumulation), rows with one."""
    missing = F.col(accumulated_col).isNull()
    return mart.agg(
        F.count(F.lit(1)).alias("total_months"),
        F.count_if(missing).alias("months_without_full_window"),
        F.count_if(~missing).alias("months_with_full_window"),
    )


def dropped_months(
    nominal_monthly: DataFrame,
    reference_monthly: DataFrame,
    keys: Sequence[str] = (),
    shared_keys: Sequence[str] = (),
) -> DataFrame:
    """Months the inner join drops, for each series: its months without a reference
    value (``nominal_only``), and the reference months it has no value for
    (``reference_only``; with ``shared_keys``, those of its own reference).

    Series are the distinct keys of the nominal side; without keys there is one.
    """
    own = [k for k in keys if k not in shared_keys]
    on = [*shared_keys, MONTH_KEY]
    nominal_only = nominal_monthly.join(reference_monthly, on, "left_anti").select(
        *keys, MONTH_KEY, F.lit("nominal_only").alias("side")
    )
    months = reference_monthly.select(*on).distinct()
    if own:  # one row per series and reference month, what the mart itself would hold
        series = nominal_monthly.select(*keys).distinct()
        # a list of months for each shared key (one list without): a few bytes a calendar month
        listed = months.groupBy(*shared_keys, F.lit(1).alias("_all")).agg(F.collect_set(MONTH_KEY).alias("_months"))
        listed = listed if shared_keys else F.broadcast(listed)
        joined = series.withColumn("_all", F.lit(1)).join(listed, [*shared_keys, "_all"])
        months = joined.select(*keys, F.explode("_months").alias(MONTH_KEY))
    reference_only = months.join(nominal_monthly, [*keys, MONTH_KEY], "left_anti").select(
        *keys, MONTH_KEY, F.lit("reference_only").alias("side")
    )
    return nominal_only.unionByName(reference_only)


def frame_gaps(monthly: DataFrame, keys: Sequence[str] = (), months: int = WINDOW_MONTHS) -> DataFrame:
    """Rows whose frame of ``months`` rows spans more calendar months than rows.

    The window counts rows, not months: a missing month stretches the frame.
    Lists the row, the first month in its frame and the months spanned.
    """
    w = rolling_window(keys, months)
    framed = monthly.select(
        *keys,
        MONTH_KEY,
        F.count(F.lit(1)).over(w).alias("months_in_window"),
        F.min(MONTH_KEY).over(w).alias("first_month_in_window"),
    )
    span = (F.months_between(MONTH_KEY, "first_month_in_window") + 1).cast("bigint")
    return framed.withColumn("months_spanned", span).where(
        F.col("months_spanned") != F.col("months_in_window")
    )


def content_fingerprint(df: DataFrame, exclude: Sequence[str] = ()) -> DataFrame:
    """Order-insensitive content hash: one row ``(rows, fingerprint)``.

    Sums a 64-bit hash of every row as a decimal (no overflow), so two runs
    with the same rows give the same value whatever the partitioning.
    """
    cols = [c for c in df.columns if c not in set(exclude)]
    h = F.xxhash64(*cols).cast("decimal(38,0)")
    return df.agg(F.count(F.lit(1)).alias("rows"), F.sum(h).alias("fingerprint"))


def partition_fingerprints(df: DataFrame, by: Sequence[str], exclude: Sequence[str] = ()) -> DataFrame:
    """:func:`content_fingerprint` of each partition: ``by``, rows, fingerprint. Combined before the shuffle."""
    left_out = {*by, *exclude}
    h = F.xxhash64(*(c for c in df.columns if c not in left_out)).cast("decimal(38,0)")
    return df.groupBy(*by).agg(F.count(F.lit(1)).alias("rows"), F.sum(h).alias("fingerprint"))


def differing_partitions(before: DataFrame, after: DataFrame, by: Sequence[str]) -> DataFrame:
    """The partitions that differ between two :func:`partition_fingerprints`: ``by``, rows_before, rows_after.

    A partition that only one side has counts as differing (0 rows on the other);
    a NULL partition value is a partition like any other.
    """
    one = before.withColumnsRenamed({"rows": "rows_before", "fingerprint": "_before"}).select(F.struct(*by).alias("_by"), "rows_before", "_before")
    two = after.withColumnsRenamed({"rows": "rows_after", "fingerprint": "_after"}).select(F.struct(*by).alias("_by"), "rows_after", "_after")
    both = one.join(two, "_by", "full")
    differs = ~F.col("_before").eqNullSafe(F.col("_after")) | ~F.col("rows_before").eqNullSafe(F.col("rows_after"))
    none = lambda c: F.coalesce(c, F.lit(0)).alias(c)
    return both.where(differs).select("_by.*", none("rows_before"), none("rows_after"))
