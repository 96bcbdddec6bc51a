"""Structured Streaming: incremental file ingest into Bronze."""

from .ingest import (
    await_all,
    ingest_series,
    read_raw_stream,
    run_ingest,
    start_append_stream,
    start_ingest,
    write_append_stream,
)

__all__ = [
    "await_all",
    "ingest_series",
    "read_raw_stream",
    "run_ingest",
    "start_append_stream",
    "start_ingest",
    "write_append_stream",
]
