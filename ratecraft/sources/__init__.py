"""Sources: raw series files and layer tables."""

from .raw import (
    BRONZE_COLUMNS,
    BRONZE_SCHEMA,
    RAW_SCHEMA,
    bronze_projection,
    landing_glob,
    raw_contract,
    read_bronze,
    read_bronze_stream,
    read_raw,
    series_range,
)
from .tables import read_driver_table, read_table, table_exists, try_read_table

__all__ = [
    "BRONZE_COLUMNS",
    "BRONZE_SCHEMA",
    "RAW_SCHEMA",
    "bronze_projection",
    "landing_glob",
    "raw_contract",
    "read_bronze",
    "read_bronze_stream",
    "read_driver_table",
    "read_raw",
    "read_table",
    "series_range",
    "table_exists",
    "try_read_table",
]
