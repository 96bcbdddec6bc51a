"""Parsing of raw strings into typed keys and rates.

Both parsers return NULL on bad input instead of failing the task (ANSI mode
would raise mid-job); the quality rules then count and report those NULLs.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ratecraft.specs import RATE_TYPE, RAW_DATE_PATTERN

from .rates import ColumnOrName, _col


def parse_date(raw: ColumnOrName, pattern: str = RAW_DATE_PATTERN) -> Column:
    """``dd/MM/yyyy`` string to DATE; NULL when it does not match."""
    return F.try_to_date(_col(raw), pattern)


def parse_rate(raw: ColumnOrName, rate_type: str = RATE_TYPE) -> Column:
    """Rate string to decimal(18,8), accepting ``,`` as the decimal mark.

    Every ``,`` becomes ``.``, so ``1.234,56`` turns into ``1.234.56``, which
    is not a number and yields NULL.
    """
    return F.regexp_replace(_col(raw), ",", ".").try_cast(rate_type)


def month_of(date: ColumnOrName) -> Column:
    """First day of the month as a DATE (accepts DATE, TIMESTAMP, TIMESTAMP_NTZ)."""
    return F.trunc(_col(date), "month")


def year_of(date: ColumnOrName) -> Column:
    return F.year(_col(date))


# Partition column per grain; each is derived from the key date, so a key
# never changes partition.
PARTITION_COLUMNS = {"year": "reference_year", "month": "partition_month", "day": "partition_day"}


def partition_column(grain: str) -> str:
    if grain not in PARTITION_COLUMNS:
        raise ValueError(f"partition grain must be one of {sorted(PARTITION_COLUMNS)}, not {grain!r}")
    return PARTITION_COLUMNS[grain]


def partition_value(date: ColumnOrName, grain: str) -> Column:
    """The partition of a key date: its year, its month (first day) or the day."""
    partition_column(grain)
    d = _col(date)
    if grain == "year":
        return year_of(d)
    return month_of(d) if grain == "month" else d.cast("date")


#: Second partition column of a Silver table of many series.
SERIES_BUCKET = "series_bucket"


def series_bucket(buckets: int, series: ColumnOrName = "series_name") -> Column:
    """The bucket of a series: it depends on its name only."""
    return F.pmod(F.xxhash64(_col(series)), F.lit(buckets)).cast("int")
