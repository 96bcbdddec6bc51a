"""Monthly mart: monthly nominal rates, a monthly reference (inflation) series,
the Fisher real rate, and rolling compounded accumulations.

Scale notes. The monthly aggregate combines map-side, so whatever the number
of daily rows, only (series x month) rows reach the shuffle. The rolling
window is partitioned by the series key: with n series it spreads over n
tasks, and each partition holds one row per month. With no key (a single
national series, as in the source pipeline) the window runs in one task, which
is only acceptable because it runs after the monthly aggregate.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType
from pyspark.sql.window import WindowSpec

from ratecraft.functions.parsing import month_of
from ratecraft.functions.rates import compound, compound_over, from_log_sum, growth_factor, real_rate
from ratecraft.specs import OUTPUT_SCALE, WINDOW_MONTHS

MONTH_KEY = "reference_month"


def monthly_rates(
    daily: DataFrame,
    rate_col: str,
    date_col: str = "reference_date",
    keys: Sequence[str] = (),
    name: str = "nominal",
) -> DataFrame:
    """Per series and calendar month: mean daily rate, compounded rate, observations."""
    return daily.groupBy(*keys, month_of(date_col).alias(MONTH_KEY)).agg(
        F.avg(rate_col).alias(f"{name}_daily_average_pct"),
        compound(rate_col).alias(f"{name}_monthly_effective_pct"),
        F.count(F.lit(1)).alias(f"{name}_observation_count"),
    )


def monthly_state(
    daily: DataFrame, rate_col: str, date_col: str = "reference_date", keys: Sequence[str] = ()
) -> DataFrame:
    """What :func:`monthly_rates` needs of each (keys, month), in a form that merges: observations,
    sum of rates, sum of log factors and least factor."""
    factor = growth_factor(rate_col)
    return daily.groupBy(*keys, month_of(date_col).alias(MONTH_KEY)).agg(
        F.count(F.lit(1)).alias("observations"),
        F.count(rate_col).alias("rates"),
        F.sum(rate_col).alias("rate_sum"),
        F.sum(F.ln(factor)).alias("log_sum"),
        F.min(factor).alias("least_factor"),
    )


def merged_rates(state: DataFrame, keys: Sequence[str] = (), name: str = "nominal") -> DataFrame:
    """:func:`monthly_rates` of the rows that :func:`monthly_state` summed up, by any of its keys."""
    total, n = F.sum("rate_sum"), F.sum("rates")
    mean = total / n
    if isinstance(kind := state.schema["rate_sum"].dataType, DecimalType):
        # the type and rounding of an average of the rates themselves, whose sum has ten digits more
        digits = kind.precision - 10
        mean = (total.cast(kind) / n.cast("decimal(20,0)")).cast(DecimalType(min(38, digits + 4), min(38, kind.scale + 4)))
    return state.groupBy(*keys, MONTH_KEY).agg(
        mean.alias(f"{name}_daily_average_pct"),
        from_log_sum(F.sum("log_sum"), F.min("least_factor")).alias(f"{name}_monthly_effective_pct"),
        F.sum("observations").alias(f"{name}_observation_count"),
    )


def monthly_reference(
    monthly: DataFrame,
    rate_col: str,
    month_col: str = MONTH_KEY,
    keys: Sequence[str] = (),
    name: str = "inflation",
) -> DataFrame:
    """A monthly series as (keys, month, rate as double)."""
    return monthly.select(
        *keys,
        F.col(month_col).alias(MONTH_KEY),
        F.col(rate_col).cast("double").alias(f"{name}_monthly_pct"),
    )


def join_monthly(
    nominal: DataFrame, reference: DataFrame, shared_keys: Sequence[str] = ()
) -> DataFrame:
    """Inner join on month (and shared keys): a month missing on either side is dropped.

    Both inputs are monthly aggregates, so AQE sees their real size at
    runtime and broadcasts the smaller one when it is under the threshold.
    """
    return nominal.join(reference, [*shared_keys, MONTH_KEY], "inner")


def rolling_window(keys: Sequence[str] = (), months: int = WINDOW_MONTHS) -> WindowSpec:
    """The last ``months`` rows of a series, ordered by month (rows, not calendar months)."""
    return Window.partitionBy(*keys).orderBy(MONTH_KEY).rowsBetween(-(months - 1), 0)


def rolling_accumulation(
    monthly: DataFrame,
    rate_cols: Sequence[str],
    keys: Sequence[str] = (),
    months: int = WINDOW_MONTHS,
) -> DataFrame:
    """Rows in frame and raw compounded accumulation of each rate over the frame."""
    w = rolling_window(keys, months)
    return monthly.select(
        "*",
        F.count(F.lit(1)).over(w).alias("months_in_window"),
        *[compound_over(c, w).alias(f"{c}_accumulated_{months}m_raw") for c in rate_cols],
    )


def full_window(value: Column, rows_in_frame: Column, months: int = WINDOW_MONTHS) -> Column:
    """``value`` only when the frame holds ``months`` rows, else NULL."""
    return F.when(rows_in_frame == months, value)


def monthly_mart(
    nominal_monthly: DataFrame,
    reference_monthly: DataFrame,
    keys: Sequence[str] = (),
    shared_keys: Sequence[str] = (),
    months: int = WINDOW_MONTHS,
    nominal: str = "nominal",
    reference: str = "inflation",
    scale: int = OUTPUT_SCALE,
) -> DataFrame:
    """One row per series and month with every mart measure.

    ``nominal_monthly`` comes from :func:`monthly_rates`, ``reference_monthly``
    from :func:`monthly_reference`. ``keys`` identify a nominal series (the
    window partition); ``shared_keys`` are the keys the reference has too.
    The 12-month real rate uses the unrounded accumulations; rounding is
    last. All window measures are in one projection, so Spark plans one
    Window node over one exchange and one sort.
    """
    w = rolling_window(keys, months)
    n_eff = F.col(f"{nominal}_monthly_effective_pct")
    p = F.col(f"{reference}_monthly_pct")
    # Each window aggregate once; guards and rounding in the next projection.
    framed = join_monthly(nominal_monthly, reference_monthly, shared_keys).select(
        "*",
        F.count(F.lit(1)).over(w).alias("_rows"),
        compound_over(n_eff, w).alias("_acc_n"),
        compound_over(p, w).alias("_acc_p"),
    )
    rows, acc_n, acc_p = F.col("_rows"), F.col("_acc_n"), F.col("_acc_p")

    def out(c: Column, alias: str) -> Column:
        return F.round(c, scale).alias(alias)

    return framed.select(
        *keys,
        MONTH_KEY,
        out(F.col(f"{nominal}_daily_average_pct"), f"{nominal}_daily_average_pct"),
        out(n_eff, f"{nominal}_monthly_effective_pct"),
        out(p, f"{reference}_monthly_pct"),
        out(real_rate(n_eff, p), "real_interest_monthly_pct"),
        out(full_window(acc_n, rows, months), f"{nominal}_accumulated_{months}m_pct"),
        out(full_window(acc_p, rows, months), f"{reference}_accumulated_{months}m_pct"),
        out(full_window(real_rate(acc_n, acc_p), rows, months),
            f"real_interest_accumulated_{months}m_pct"),
        F.col(f"{nominal}_observation_count"),
    )


def with_real_rate(joined: DataFrame, nominal: str = "nominal", reference: str = "inflation") -> DataFrame:
    """Add the monthly Fisher real rate to a joined monthly frame."""
    return joined.withColumn(
        "real_interest_monthly_pct",
        real_rate(f"{nominal}_monthly_effective_pct", f"{reference}_monthly_pct"),
    )
