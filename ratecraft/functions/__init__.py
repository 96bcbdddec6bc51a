"""Column builders: rate arithmetic and raw-value parsing."""

from .parsing import (
    PARTITION_COLUMNS,
    month_of,
    parse_date,
    parse_rate,
    partition_column,
    partition_value,
    year_of,
)
from .rates import compound, compound_over, growth_factor, real_rate

__all__ = [
    "PARTITION_COLUMNS",
    "compound",
    "compound_over",
    "growth_factor",
    "month_of",
    "parse_date",
    "parse_rate",
    "partition_column",
    "partition_value",
    "real_rate",
    "year_of",
]
