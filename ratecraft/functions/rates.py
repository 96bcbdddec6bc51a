"""Column builders for rates quoted in percent.

All of these are plain Catalyst expressions: they run inside whole-stage
codegen, aggregate partially before a shuffle and need no UDF.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.window import WindowSpec

ColumnOrName = Column | str


def _col(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


def growth_factor(rate_pct: ColumnOrName) -> Column:
    """``1 + r/100`` as a double."""
    return _col(rate_pct).cast("double") / 100.0 + 1.0


def _from_log_sum(log_sum: Column) -> Column:
    return (F.exp(log_sum) - 1.0) * 100.0


def from_log_sum(log_sum: Column, least_factor: Column) -> Column:
    """The compounded rate in percent of rates whose log factors sum to ``log_sum``; NULL if a factor isn't positive."""
    return F.when(least_factor > 0, _from_log_sum(log_sum))


def compound(rate_pct: ColumnOrName) -> Column:
    """Aggregate: geometric compounding of the group's rates, in percent.

    ``(exp(sum(ln(1 + r/100))) - 1) * 100``. A factor ``<= 0`` (a rate of
    -100 % or less) has no logarithm; instead of silently summing the other
    rows, the whole result is NULL.
    """
    factor = growth_factor(rate_pct)
    return F.when(F.min(factor) > 0, _from_log_sum(F.sum(F.ln(factor))))


def compound_over(rate_pct: ColumnOrName, window: WindowSpec) -> Column:
    """Window version of :func:`compound` over the rows of ``window``."""
    factor = growth_factor(rate_pct)
    return F.when(
        F.min(factor).over(window) > 0, _from_log_sum(F.sum(F.ln(factor)).over(window))
    )


def real_rate(nominal_pct: ColumnOrName, inflation_pct: ColumnOrName) -> Column:
    """Fisher relation ``((1 + n/100) / (1 + p/100) - 1) * 100``.

    NULL when the inflation factor is zero (a -100 % price change).
    """
    ratio = F.try_divide(growth_factor(nominal_pct), growth_factor(inflation_pct))
    return (ratio - 1.0) * 100.0
