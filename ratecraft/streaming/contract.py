"""Contracts of newly landed files, judged from the records that their ingest appended.

A stream over Bronze (its own checkpoint) hands the rows appended since its
last run to an aggregate by file, whose report replaces the batch's folder in
the series' contract log; a landed file is therefore parsed once, by the
ingest, and its contract costs in proportion to its records. Files that were
listed before the ingest and left no record (an empty array, or no bytes at all)
are found by their names alone.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ratecraft.session import path_exists
from ratecraft.sources.raw import CONTRACT_SCHEMA, judged_files, landed_files, read_bronze_stream, without_records
from ratecraft.specs import SeriesSpec
from ratecraft.streaming.ingest import run_ingest, run_streams


def _part(spark: SparkSession, spec: SeriesSpec, name: str, schema: str) -> DataFrame:
    path = f"{spec.contracts}/{name}"
    return spark.read.schema(schema).parquet(path) if path_exists(spark, path) else spark.createDataFrame([], schema)


def contract_log(spark: SparkSession, spec: SeriesSpec) -> DataFrame:
    """Contract of every file ingested so far (CONTRACT_SCHEMA), and the batch that judged it (null: no records)."""
    judged = _part(spark, spec, "judged", f"{CONTRACT_SCHEMA}, batch_id long")
    return judged.unionByName(_part(spark, spec, "empty", CONTRACT_SCHEMA).withColumn("batch_id", F.lit(None).cast("long")))


def broken_files(spark: SparkSession, spec: SeriesSpec) -> DataFrame:
    """The files in the contract log that fail and haven't been accepted."""
    accepted = _part(spark, spec, "accepted", "source_path string")
    return contract_log(spark, spec).where("not contract_ok").join(accepted, "source_path", "left_anti")


def accept_files(spark: SparkSession, spec: SeriesSpec, files: Sequence[str]) -> int:
    """Accept broken files by name, so that the contract no longer stops on them; how many there were."""
    named = broken_files(spark, spec).where(F.col("source_file").isin(list(files))).select("source_path")
    found = [r.source_path for r in named.collect()]  # as many as were named
    if found:
        spark.createDataFrame([(x,) for x in found], "source_path string").write.mode("append").parquet(f"{spec.contracts}/accepted")
    return len(found)


def _start(spark: SparkSession, spec: SeriesSpec) -> StreamingQuery:
    def judge(records: DataFrame, batch_id: int) -> None:
        judged_files(records).write.mode("overwrite").parquet(f"{spec.contracts}/judged/batch_id={batch_id}")

    return (
        read_bronze_stream(spark, spec)
        .writeStream.foreachBatch(judge)
        .option("checkpointLocation", spec.contract_checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def run_ingest_with_contract(spark: SparkSession, specs: Iterable[SeriesSpec]) -> None:
    """Bronze job that also judges the new files; raises if broken files are left.

    The records of broken files are in Bronze then (where the Silver job's rules meet them);
    the run stops behind the ingest, naming up to ten files, until they are
    accepted (:func:`accept_files`). What is read of the landing is its listing
    and, by the ingest, its new files.
    """
    specs = list(specs)
    for spec in specs:
        if not (spec.contracts and spec.contract_checkpoint):
            raise ValueError(f"series {spec.name!r} has no contract location")
    # every file listed now is drained by the ingest; one that lands meanwhile is judged next time
    listed = [landed_files(spark, spec) for spec in specs]
    run_ingest(spark, specs)
    run_streams(specs, lambda spec: _start(spark, spec))
    for spec, files in zip(specs, listed, strict=True):
        empty = without_records(files, contract_log(spark, spec))
        empty.coalesce(1).write.mode("append").parquet(f"{spec.contracts}/empty")
    enforce_contract(spark, specs)


def enforce_contract(spark: SparkSession, specs: Sequence[SeriesSpec]) -> None:
    """Raise if the log of a series holds broken files, naming up to ten and how many there are."""
    for spec in specs:
        bad = broken_files(spark, spec)
        n = bad.count()  # of the log's rows that fail, a file each
        if n:
            some = [r.source_file for r in bad.select("source_file").orderBy("source_file").limit(10).collect()]
            raise ValueError(f"landing of {spec.name!r}: {n} files break the contract, such as {some}")
