"""Incremental Silver with broken records: rules by record, an idempotent quarantine, any way of cutting."""

import datetime as dt
import random
from collections import Counter
from dataclasses import replace
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from ratecraft.plans.jobs import conform_batch, quarantined, run_conform_incremental
from ratecraft.sources.raw import BRONZE_SCHEMA
from ratecraft.sources.tables import try_read_table
from ratecraft.specs import SELIC
from ratecraft.streaming import ingest_series

from .fixtures import fmt, write_raw

DAYS = [dt.date(2024, 1, 1) + dt.timedelta(days=k) for k in range(20)]
BAD_DATES = [None, "31/02/2024", "2024-01-05", ""]
BAD_RATES = [None, "x", ""]


def record(rng):
    """(data, valor, parsed) of a random record; parsed is (date, rate) or the rule it breaks."""
    day, rate = rng.choice(DAYS), rng.choice(["0.01", "0,02", "1.5", "10", "-5"])
    kind = rng.random()
    if kind < 0.15:
        return rng.choice(BAD_DATES), rng.choice([rate, "99", None]), "no valid date"
    if kind < 0.3:
        return fmt(day), rng.choice(BAD_RATES), "no valid rate"
    if kind < 0.45:
        return fmt(day), rng.choice(["10.5", "-5,01", "99"]), "rate out of range"
    return fmt(day), rate, (day, Decimal(rate.replace(",", ".")))


def expected(files):
    """Silver and quarantine of files (lists of records, oldest first): newest valid record, highest rate in a file."""
    silver, refused = {}, Counter()
    for records in files:
        best = {}
        for data, valor, parsed in records:
            if isinstance(parsed, str):
                refused[(data, valor, parsed)] += 1
            else:
                best[parsed[0]] = max(best.get(parsed[0], parsed[1]), parsed[1])
        silver |= best
    return silver, refused


def state(spark, spec):
    silver = try_read_table(spark, spec.silver)
    rows = {} if silver is None else {r.reference_date: r[spec.rate_column] for r in silver.collect()}
    assert silver is None or silver.count() == len(rows)
    return rows, Counter((r.data_raw, r.valor_raw, r.refused) for r in quarantined(spark, spec).collect())


@pytest.mark.parametrize("seed", range(3))
def test_any_cut_any_order_any_redo(spark, tmp_path, seed):
    """conform_batch over random parts of the same records, in random order, some twice."""
    rng = random.Random(seed)
    files = [[record(rng) for _ in range(rng.randint(1, 12))] for _ in range(10)]
    at = dt.datetime(2024, 3, 1)
    rows = [
        (data, valor, "selic", f"{k}.json", f"landing/{k}.json", at + dt.timedelta(seconds=k), at + dt.timedelta(hours=k // 3), at.date())
        for k, records in enumerate(files)
        for data, valor, _ in records
    ]
    results = []
    for cut in range(3):
        spec = SELIC.located(str(tmp_path / f"cut{cut}"))
        parts = [[] for _ in range(rng.randint(1, 5))]
        for r in rows:
            rng.choice(parts).append(r)
        order = list(enumerate(parts))
        rng.shuffle(order[1:]) if cut else None
        todo = order + [b for b in order[1:] if rng.random() < 0.6]  # batch 0 stands for a new checkpoint
        for batch_id, part in todo:
            conform_batch(spec, spark.createDataFrame(part, BRONZE_SCHEMA), batch_id)
        results.append(state(spark, spec))
    assert all(r == expected(files) for r in results)


@pytest.mark.parametrize("per_batch", [None, 1, 3])
def test_streams_of_any_cut(spark, tmp_path, per_batch):
    rng = random.Random(11)
    files = [[record(rng) for _ in range(8)] for _ in range(6)]
    spec = replace(SELIC, max_files_per_trigger=per_batch).located(str(tmp_path / "lake"))
    groups = {None: [6], 1: [2, 4], 3: [1, 5]}[per_batch]
    done, bad = 0, 0
    for n in groups:
        for k in range(done, done + n):
            records = [{"data": a, "valor": b} for a, b, _ in files[k]]
            write_raw(tmp_path / "lake" / "landing" / "selic", f"{k}.json", records, mtime=1_700_000_000 + k)
        done += n
        ingest_series(spark, spec)
        bad += run_conform_incremental(spark, [spec], fail_on_refused=False).get("selic", 0)
    silver, refused = expected(files)
    assert state(spark, spec) == (silver, refused) and bad == sum(refused.values())


def test_a_broken_record_does_not_hide_a_valid_one(spark, tmp_path):
    spec = SELIC.located(str(tmp_path))
    landing = tmp_path / "landing" / "selic"
    write_raw(landing, "a.json", [{"data": "02/01/2020", "valor": "0.05"}], mtime=1_700_000_000)
    write_raw(landing, "b.json", [{"data": "02/01/2020", "valor": "99"}, {"data": "x", "valor": "1"}, {"data": "y", "valor": "1"}], mtime=1_700_000_001)
    ingest_series(spark, spec)
    with pytest.raises(ValueError, match="'selic': 3"):
        run_conform_incremental(spark, [spec])
    silver, refused = state(spark, spec)
    assert silver == {dt.date(2020, 1, 2): Decimal("0.05")}
    assert refused == {("02/01/2020", "99", "rate out of range"): 1, ("x", "1", "no valid date"): 1, ("y", "1", "no valid date"): 1}
    run_conform_incremental(spark, [spec])  # nothing new: nothing refused again
    assert state(spark, spec) == (silver, refused)


def test_a_new_checkpoint_rebuilds_the_quarantine(spark, tmp_path):
    spec = SELIC.located(str(tmp_path))
    for k in range(3):
        write_raw(tmp_path / "landing" / "selic", f"{k}.json", [{"data": "x", "valor": str(k)}, {"data": "02/01/2020", "valor": "1"}])
        ingest_series(spark, spec)
        run_conform_incremental(spark, [spec], fail_on_refused=False)
    before = state(spark, spec)
    assert {r.batch_id for r in quarantined(spark, spec).collect()} == {0, 1, 2}
    again = replace(spec, silver_checkpoint=str(tmp_path / "new-checkpoint"))
    run_conform_incremental(spark, [again], fail_on_refused=False)
    assert state(spark, again) == before and sum(before[1].values()) == 3


def test_an_empty_quarantine_reads_as_empty(spark, tmp_path):
    spec = SELIC.located(str(tmp_path))
    assert quarantined(spark, spec).count() == 0
    conform_batch(spec, spark.createDataFrame([], BRONZE_SCHEMA), 0)
    assert quarantined(spark, spec).count() == 0 and try_read_table(spark, spec.silver) is None
    assert quarantined(spark, spec).columns[-3:] == ["refused", "refused_at", "batch_id"]


def test_a_monthly_series_is_quarantined_by_month_rules(spark, tmp_path):
    from ratecraft.specs import IPCA

    spec = IPCA.located(str(tmp_path))
    write_raw(tmp_path / "landing" / "ipca", "a.json", [{"data": "15/03/2020", "valor": "0.3"}, {"data": "01/03/2020", "valor": "51"}])
    ingest_series(spark, spec)
    assert run_conform_incremental(spark, [spec], fail_on_refused=False) == {"ipca": 1}
    rows = spark.read.parquet(spec.silver).select("reference_month", F.col("ipca_monthly_pct").cast("double")).collect()
    assert [tuple(r) for r in rows] == [(dt.date(2020, 3, 1), 0.3)]
