"""Incremental ingest of raw series files into append-only Bronze tables.

Each run drains the files not yet seen (``availableNow``) and stops; the
checkpoint of the stream records which files were read, so a rerun on
unchanged input appends nothing and a file is never read twice. The parquet
sink writes a commit log next to the data, so readers only see files of
committed batches, and a batch whose tasks died is redone, not duplicated.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from ratecraft.session import file_rows
from ratecraft.sources.raw import RAW_SCHEMA, bronze_projection, landing_glob
from ratecraft.sources.tables import is_path
from ratecraft.specs import SeriesSpec


def read_raw_stream(spark: SparkSession, spec: SeriesSpec) -> DataFrame:
    """Streaming scan of a landing folder with the fixed raw schema.

    ``multiLine`` files (one JSON array per file) are one task each; large
    landings should arrive as many JSON-lines files instead, which split.
    ``max_files_per_trigger`` bounds one micro-batch. With ``archive`` set,
    files are moved out of the landing once their batch has committed
    (best effort, done by Spark), so the listing does not grow forever.
    """
    reader = (
        spark.readStream.format("json")
        .schema(RAW_SCHEMA)
        .option("multiLine", spec.multi_line)
        .option("mode", "PERMISSIVE")
    )
    if spec.max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", spec.max_files_per_trigger)
    if spec.archive:
        reader = reader.option("cleanSource", "archive").option("sourceArchiveDir", spec.archive)
    return reader.load(landing_glob(spec)).select(bronze_projection(spec))


def start_append_stream(df: DataFrame, target: str, checkpoint: str) -> StreamingQuery:
    """Start appending everything available to ``target``; the query stops when drained.

    ``target`` is a storage path (parquet sink) or a catalog table name. Files
    hold a bounded number of records, so that later jobs can deal them to tasks.
    """
    writer = (
        df.writeStream.format("parquet")
        .options(**file_rows())
        .outputMode("append")
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
    )
    return writer.start(target) if is_path(target) else writer.toTable(target)


def write_append_stream(df: DataFrame, target: str, checkpoint: str) -> StreamingQuery:
    """Append everything available to ``target``, then stop; blocks until done.

    A failure inside the stream is raised here.
    """
    query = start_append_stream(df, target, checkpoint)
    query.awaitTermination()
    return query


def _checked(spec: SeriesSpec) -> SeriesSpec:
    if not (spec.landing and spec.bronze and spec.checkpoint):
        raise ValueError(f"series {spec.name!r} has no landing/bronze/checkpoint location")
    return spec


def start_ingest(spark: SparkSession, spec: SeriesSpec) -> StreamingQuery:
    """Start ingesting one series (its own landing folder, checkpoint and Bronze table)."""
    spec = _checked(spec)
    return start_append_stream(read_raw_stream(spark, spec), spec.bronze, spec.checkpoint)


def ingest_series(spark: SparkSession, spec: SeriesSpec) -> StreamingQuery:
    """Ingest one series and wait until its available files are drained."""
    query = start_ingest(spark, spec)
    query.awaitTermination()
    return query


def await_all(queries: Iterable[StreamingQuery], failures: list[BaseException] | None = None) -> None:
    """Wait until every query has stopped, then raise the first failure, if any."""
    failures = list(failures or [])
    for query in queries:
        try:
            query.awaitTermination()
        except Exception as exc:
            failures.append(exc)
    if failures:
        raise failures[0]


#: Streams that run at the same time; each holds a driver thread.
STREAMS_AT_ONCE = 16


def run_streams(specs: Iterable[SeriesSpec], start: Callable[[SeriesSpec], StreamingQuery]) -> list[StreamingQuery]:
    """Start a stream for every spec, STREAMS_AT_ONCE at a time, and wait for all of them.

    A failed series does not keep others from running; the first failure is
    raised once every stream has stopped.
    """
    todo = list(specs)
    done: list[StreamingQuery] = []
    failures: list[BaseException] = []
    for at in range(0, len(todo), STREAMS_AT_ONCE):
        started: list[StreamingQuery] = []
        for spec in todo[at : at + STREAMS_AT_ONCE]:
            try:
                started.append(start(spec))
            except Exception as exc:  # a stream that cannot start (e.g. no landing folder)
                failures.append(exc)
        try:
            await_all(started)
        except Exception as exc:
            failures.append(exc)
        done += started
    if failures:
        raise failures[0]
    return done


def run_ingest(spark: SparkSession, specs: Iterable[SeriesSpec]) -> list[StreamingQuery]:
    """Bronze job: every registered series (see :func:`run_streams`), each with its own checkpoint.

    The streams share the cluster, so many small series do not queue behind
    each other.
    """
    return run_streams(specs, lambda spec: start_ingest(spark, spec))
