"""Tasks of the layer jobs hold a bounded number of records, whatever the table's size in bytes."""

import json

import pytest
from pyspark.sql import functions as F

from ratecraft import session
from ratecraft.operators.upsert import staged
from ratecraft.plans import catalog
from ratecraft.plans.jobs import conform_batch, run_conform
from ratecraft.sources.raw import read_bronze
from ratecraft.sources.tables import read_table
from ratecraft.specs import DAY, SeriesSpec
from ratecraft.streaming.ingest import ingest_series

ROWS, PER_TASK = 1200, 100


@pytest.fixture
def spec(spark, tmp_path, monkeypatch):
    """A series of ROWS days, every record valid, landed in one file and ingested."""
    monkeypatch.setattr(session, "ROWS_A_TASK", PER_TASK)
    out = SeriesSpec(name="s", grain=DAY, rate_column="r", rate_min=-5, rate_max=10, multi_line=False).located(f"{tmp_path}/root")
    day = F.date_format(F.date_add(F.lit("2001-01-01").cast("date"), F.col("id").cast("int")), "dd/MM/yyyy")
    rows = spark.range(ROWS).select(day.alias("data"), F.lit("0.01").alias("valor")).collect()
    (tmp_path / "root/landing/s").mkdir(parents=True)
    (tmp_path / "root/landing/s/one.json").write_text("\n".join(json.dumps(r.asDict()) for r in rows))
    ingest_series(spark, out)
    return out


def most_tasks(spark, group, work):
    spark.sparkContext.setJobGroup(group, group)
    try:
        work()
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    tracker = spark.sparkContext.statusTracker()
    stages = [tracker.getStageInfo(s) for j in tracker.getJobIdsForGroup(group) for s in tracker.getJobInfo(j).stageIds]
    return max(s.numTasks for s in stages if s)


def test_bronze_files_hold_a_bounded_number_of_records(spark, spec):
    files = read_bronze(spark, spec).groupBy(F.col("_metadata.file_path")).count().collect()
    assert sum(f["count"] for f in files) == ROWS
    assert max(f["count"] for f in files) <= PER_TASK


def test_conform_jobs_deal_records_to_tasks_by_number(spark, spec):
    assert most_tasks(spark, "full", lambda: run_conform(spark, [spec])) >= ROWS / PER_TASK
    assert read_table(spark, spec.silver).count() == ROWS
    assert most_tasks(spark, "batch", lambda: conform_batch(spec, read_bronze(spark, spec), 0)) >= ROWS / PER_TASK
    assert read_table(spark, spec.silver).count() == ROWS


def test_scan_setting_is_put_back(spark, spec):
    before = spark.conf.get(session.SCAN_TASKS, None)
    task = F.spark_partition_id().alias("task")
    with staged(spark, read_bronze(spark, spec).select(task), "tasks", rows=ROWS) as out:
        assert spark.conf.get(session.SCAN_TASKS, None) == before
        assert max(r["count"] for r in out.groupBy("task").count().collect()) <= 2 * PER_TASK


def test_landing_deals_records_to_tasks_by_number(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(session, "ROWS_A_TASK", PER_TASK)
    rows = spark.range(ROWS).select(F.lit("a").alias("series"), F.col("id").cast("string").alias("data"), F.lit("1").alias("valor"))
    catalog._write_by_series(rows, str(tmp_path / "out"), ROWS)
    files = spark.read.json(str(tmp_path / "out")).groupBy(F.col("_metadata.file_path")).count().collect()
    assert sum(f["count"] for f in files) == ROWS and max(f["count"] for f in files) < 2 * PER_TASK
