"""End to end over generated raw files: Bronze stream -> Silver -> Gold."""

import datetime as dt
import time
from dataclasses import replace
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from ratecraft.operators import content_fingerprint, dropped_months, frame_gaps, monthly_rates, monthly_reference
from ratecraft.plans.jobs import MartSpec, gold_view, run_conform, run_layers, run_mart
from ratecraft.session import checkpoint_root
from ratecraft.sources import raw_contract, read_raw, read_table
from ratecraft.sources.raw import file_contract
from ratecraft.specs import IPCA, SELIC
from ratecraft.streaming import ingest_series

from .fixtures import (
    FIVE_YEARS_DAYS,
    FIVE_YEARS_MONTHS,
    daily_records,
    fmt,
    monthly_records,
    write_raw,
)


def layout(tmp_path, months=FIVE_YEARS_MONTHS):
    root = tmp_path / "lake"
    selic, ipca = SELIC.located(str(root)), IPCA.located(str(root))
    write_raw(root / "landing" / "selic", "selic_2020_2024.json", daily_records(FIVE_YEARS_DAYS))
    write_raw(root / "landing" / "ipca", "ipca_2020_2024.json", monthly_records(months))
    mart = MartSpec(nominal=selic, reference=ipca, gold=str(root / "gold"))
    return root, selic, ipca, mart


def test_five_years_golden_counts_and_rerun(spark, tmp_path):
    root, selic, ipca, mart = layout(tmp_path)
    run_layers(spark, [selic, ipca], mart)
    gold = gold_view(spark, mart)
    assert gold.count() == 60
    assert gold.where(F.col("selic_accumulated_12m_pct").isNull()).count() == 11
    assert gold.where(F.col("selic_accumulated_12m_pct").isNotNull()).count() == 49
    assert set(gold.columns) >= {
        "reference_month", "selic_daily_average_pct", "selic_monthly_effective_pct",
        "ipca_monthly_pct", "real_interest_monthly_pct", "selic_accumulated_12m_pct",
        "ipca_accumulated_12m_pct", "real_interest_accumulated_12m_pct", "selic_observation_count",
    }
    assert dict(gold.dtypes)["selic_daily_average_pct"] == "decimal(19,8)"
    counts = (
        read_table(spark, selic.bronze).count(),
        read_table(spark, ipca.bronze).count(),
        read_table(spark, selic.silver).count(),
        read_table(spark, ipca.silver).count(),
    )
    assert counts == (len(FIVE_YEARS_DAYS), 60, len(FIVE_YEARS_DAYS), 60)
    before = content_fingerprint(gold).first()

    run_layers(spark, [selic, ipca], mart)  # unchanged input: same rows
    assert read_table(spark, selic.bronze).count() == len(FIVE_YEARS_DAYS)
    assert read_table(spark, selic.silver).count() == len(FIVE_YEARS_DAYS)
    assert content_fingerprint(gold_view(spark, mart)).first() == before


def test_staging_is_removed_after_the_upserts(spark, tmp_path):
    _, selic, ipca, mart = layout(tmp_path)
    scratch = Path(checkpoint_root(spark).removeprefix("file:")) / "ratecraft"
    before = set(scratch.glob("*")) if scratch.exists() else set()
    run_layers(spark, [selic, ipca], mart)
    run_layers(spark, [selic, ipca], mart)
    assert scratch.is_dir()  # staging was written here
    left = {p.name for p in set(scratch.glob("*")) - before}
    assert not {n for n in left if n.startswith(("silver-", "gold-", "upsert-"))}
    assert gold_view(spark, mart).count() == 60


def test_backfill_file_updates_and_adds(spark, tmp_path):
    root, selic, ipca, mart = layout(tmp_path)
    run_layers(spark, [selic, ipca], mart)
    new_day = dt.date(2025, 1, 2)
    write_raw(
        root / "landing" / "selic",
        "selic_backfill_001.json",
        [{"data": fmt(FIVE_YEARS_DAYS[0]), "valor": "0,099"}, {"data": fmt(new_day), "valor": "0.05"}],
    )
    run_layers(spark, [selic, ipca], mart)
    silver = read_table(spark, selic.silver)
    assert silver.count() == len(FIVE_YEARS_DAYS) + 1
    assert silver.groupBy("reference_date").count().where("count > 1").count() == 0
    first = silver.where(F.col("reference_date") == F.lit(FIVE_YEARS_DAYS[0])).first()
    assert float(first.selic_daily_pct) == pytest.approx(0.099)
    assert first.source_file == "selic_backfill_001.json"


def test_same_name_overwrite_is_not_read_again(spark, tmp_path):
    root, selic, _, _ = layout(tmp_path)
    ingest_series(spark, selic)
    n = read_table(spark, selic.bronze).count()
    time.sleep(1.1)
    write_raw(root / "landing" / "selic", "selic_2020_2024.json", daily_records(FIVE_YEARS_DAYS[:5], seed=1))
    ingest_series(spark, selic)
    assert read_table(spark, selic.bronze).count() == n


def test_corrupt_file_and_missing_field_fail_the_gate(spark, tmp_path):
    root, selic, ipca, mart = layout(tmp_path)
    landing = root / "landing" / "selic"
    (landing / "truncated.json").write_text('[{"data": "02/01/2020", "valor": "0.0')
    write_raw(landing, "missing.json", [{"data": "03/01/2020"}])
    contract = raw_contract(read_raw(spark, selic)).first()
    assert contract.invalid_records == 2 and not contract.contract_ok
    from ratecraft.streaming import run_ingest

    run_ingest(spark, [selic, ipca])
    with pytest.raises(ValueError, match="not_null"):
        run_conform(spark, [selic, ipca])
    # nothing was written to Silver for either series
    assert not (root / "silver").exists()


def test_gap_month_dropped_by_join_and_listed(spark, tmp_path):
    months = [m for m in FIVE_YEARS_MONTHS if m != dt.date(2021, 6, 1)]
    root, selic, ipca, mart = layout(tmp_path, months)
    run_layers(spark, [selic, ipca], mart)
    gold = gold_view(spark, mart)
    assert gold.count() == 59
    nominal = monthly_rates(read_table(spark, selic.silver), selic.rate_column, keys=["series_name"], name="selic")
    reference = monthly_reference(read_table(spark, ipca.silver), ipca.rate_column, name="ipca")
    dropped = dropped_months(nominal, reference, keys=["series_name"]).collect()
    assert [(str(r.reference_month), r.side) for r in dropped] == [("2021-06-01", "nominal_only")]
    gaps = frame_gaps(gold, keys=["series_name"]).collect()
    assert gaps and all(r.months_spanned == 13 and r.months_in_window == 12 for r in gaps)
    assert len(gaps) == 11  # 2021-07 .. 2022-05 span the missing month


def test_many_series_windows_do_not_leak(spark, tmp_path):
    root = tmp_path / "lake"
    rates = replace(SELIC, name="rates", series_from_dir=True).located(str(root))
    ipca = IPCA.located(str(root))
    for i, name in enumerate(["alpha", "beta", "gamma"]):
        days = FIVE_YEARS_DAYS[i * 21:]  # each series starts a month later
        write_raw(root / "landing" / "rates" / name, f"{name}.json", daily_records(days, seed=i))
    write_raw(root / "landing" / "ipca", "ipca.json", monthly_records(FIVE_YEARS_MONTHS))
    mart = MartSpec(nominal=rates, reference=ipca, gold=str(root / "gold"), nominal_name="selic")
    run_layers(spark, [rates, ipca], mart)
    gold = gold_view(spark, mart)
    per = {
        r.series_name: (r.n, r.nulls)
        for r in gold.groupBy("series_name")
        .agg(F.count("*").alias("n"), F.count_if(F.col("selic_accumulated_12m_pct").isNull()).alias("nulls"))
        .collect()
    }
    assert set(per) == {"alpha", "beta", "gamma"}
    assert all(nulls == 11 for _, nulls in per.values())
    assert per["alpha"][0] == 60 and per["gamma"][0] < 60


def test_ingest_runs_every_series_and_raises_after(spark, tmp_path):
    root = tmp_path / "lake"
    selic = SELIC.located(str(root))
    missing = IPCA.located(str(root))  # its landing folder is never created
    write_raw(root / "landing" / "selic", "selic.json", daily_records(FIVE_YEARS_DAYS[:30]))
    from ratecraft.streaming import run_ingest

    with pytest.raises(Exception):
        run_ingest(spark, [missing, selic])
    assert read_table(spark, selic.bronze).count() == 30


def _silver_and_gold(spark, selic, ipca, mart):
    volatile = ["silver_updated_at", "ingestion_timestamp", "ingestion_date", "source_modified_at", "source_path"]
    silver = content_fingerprint(read_table(spark, selic.silver), exclude=volatile).first()
    reference = content_fingerprint(read_table(spark, ipca.silver), exclude=volatile).first()
    gold = content_fingerprint(gold_view(spark, mart)).first()
    return silver, reference, gold


def test_incremental_silver_equals_full_recompute(spark, tmp_path):
    results = {}
    for incremental in (False, True):
        root, selic, ipca, mart = layout(tmp_path / str(incremental))
        run_layers(spark, [selic, ipca], mart, incremental=incremental)
        first = _silver_and_gold(spark, selic, ipca, mart)
        write_raw(
            root / "landing" / "selic",
            "selic_backfill_001.json",
            [{"data": fmt(FIVE_YEARS_DAYS[0]), "valor": "0,099"}, {"data": fmt(dt.date(2025, 1, 2)), "valor": "0.05"}],
        )
        run_layers(spark, [selic, ipca], mart, incremental=incremental)
        results[incremental] = (first, _silver_and_gold(spark, selic, ipca, mart))
    assert results[True] == results[False]
    (silver_1, _, _), (silver_2, _, _) = results[True]
    assert silver_2.rows == silver_1.rows + 1  # one new day; the changed day is updated in place
    assert silver_2.fingerprint != silver_1.fingerprint


def test_incremental_silver_reads_only_new_bronze(spark, tmp_path):
    from ratecraft.plans.jobs import run_conform_incremental
    from ratecraft.streaming import run_ingest

    root, selic, ipca, mart = layout(tmp_path)
    run_ingest(spark, [selic, ipca])
    run_conform_incremental(spark, [selic, ipca])
    stamp_1 = read_table(spark, selic.silver).agg(F.max("silver_updated_at")).first()[0]
    write_raw(root / "landing" / "selic", "selic_new.json", [{"data": fmt(dt.date(2025, 1, 2)), "valor": "0.05"}])
    run_ingest(spark, [selic, ipca])
    run_conform_incremental(spark, [selic, ipca])
    silver = read_table(spark, selic.silver)
    assert silver.count() == len(FIVE_YEARS_DAYS) + 1
    # only the new record carries a new load time
    later = silver.where(F.col("silver_updated_at") > F.lit(stamp_1))
    assert [r.reference_date for r in later.select("reference_date").collect()] == [dt.date(2025, 1, 2)]
    # nothing new: a rerun changes nothing
    before = content_fingerprint(silver).first()
    run_conform_incremental(spark, [selic, ipca])
    assert content_fingerprint(read_table(spark, selic.silver)).first() == before


@pytest.mark.parametrize("incremental", [False, True])
def test_layers_with_catalog_tables(spark, tmp_path, incremental):
    root = tmp_path / "lake"
    tag = "inc" if incremental else "full"
    tables = [f"{layer}_{s}_{tag}" for layer in ("bronze", "silver") for s in ("selic", "ipca")] + [f"gold_{tag}"]
    for t in tables:
        spark.sql(f"DROP TABLE IF EXISTS {t}")
    selic = replace(SELIC, bronze=f"bronze_selic_{tag}", silver=f"silver_selic_{tag}").located(str(root))
    ipca = replace(IPCA, bronze=f"bronze_ipca_{tag}", silver=f"silver_ipca_{tag}").located(str(root))
    write_raw(root / "landing" / "selic", "selic.json", daily_records(FIVE_YEARS_DAYS))
    write_raw(root / "landing" / "ipca", "ipca.json", monthly_records(FIVE_YEARS_MONTHS))
    mart = MartSpec(nominal=selic, reference=ipca, gold=f"gold_{tag}")
    run_layers(spark, [selic, ipca], mart, incremental=incremental)
    run_layers(spark, [selic, ipca], mart, incremental=incremental)  # rerun: same rows
    assert spark.table(f"bronze_selic_{tag}").count() == len(FIVE_YEARS_DAYS)
    assert spark.table(f"silver_selic_{tag}").count() == len(FIVE_YEARS_DAYS)
    gold = gold_view(spark, mart)
    assert gold.count() == 60
    assert gold.where(F.col("selic_accumulated_12m_pct").isNotNull()).count() == 49
    for t in tables:
        spark.sql(f"DROP TABLE IF EXISTS {t}")


def _files_by_date(spark, path):
    rows = spark.read.parquet(path).select("reference_date", F.col("_metadata.file_path").alias("f")).collect()
    return {r.reference_date: r.f for r in rows}


def test_finer_partitions_rewrite_only_touched_days(spark, tmp_path):
    from ratecraft.specs import DAY as DAY_GRAIN, MONTH as MONTH_GRAIN

    volatile = ["silver_updated_at", "ingestion_timestamp", "ingestion_date", "source_modified_at",
                "source_path", "reference_year", "partition_day"]
    results = {}
    for grain in ("year", DAY_GRAIN):
        root, selic, ipca, mart = layout(tmp_path / grain)
        selic = replace(selic, partition_grain=grain)
        mart = replace(mart, nominal=selic, partition_grain="year" if grain == "year" else MONTH_GRAIN)
        run_layers(spark, [selic, ipca], mart, incremental=True)
        before = _files_by_date(spark, selic.silver)
        changed, new_day = FIVE_YEARS_DAYS[0], dt.date(2025, 1, 2)
        write_raw(
            root / "landing" / "selic",
            "selic_backfill_001.json",
            [{"data": fmt(changed), "valor": "0,099"}, {"data": fmt(new_day), "valor": "0.05"}],
        )
        run_layers(spark, [selic, ipca], mart, incremental=True)
        after = _files_by_date(spark, selic.silver)
        rewritten = {d for d, f in after.items() if before.get(d) != f}
        results[grain] = (
            content_fingerprint(read_table(spark, selic.silver), exclude=volatile).first(),
            content_fingerprint(gold_view(spark, mart)).first(),
            rewritten,
        )
    assert results["year"][:2] == results[DAY_GRAIN][:2]
    assert results[DAY_GRAIN][2] == {changed, new_day}
    # with year partitions the whole touched years are rewritten
    assert results["year"][2] == {d for d in after if d.year in (changed.year, new_day.year)}


def test_max_files_per_trigger_splits_the_drain_and_the_later_batch_wins(spark, tmp_path):
    from ratecraft.plans.jobs import silver_content

    root = tmp_path / "lake"
    selic = replace(SELIC, max_files_per_trigger=1).located(str(root))
    landing = root / "landing" / "selic"
    days = FIVE_YEARS_DAYS[:10]
    # oldest first by modification time: the stream reads files in that order
    write_raw(landing, "a.json", daily_records(days[:5]), mtime=1_700_000_000)
    write_raw(landing, "b.json", daily_records(days[5:]), mtime=1_700_000_100)
    write_raw(landing, "c.json", [{"data": fmt(days[0]), "valor": "0.0999"}], mtime=1_700_000_200)
    query = ingest_series(spark, selic)
    batches = [p for p in query.recentProgress if p["numInputRows"] > 0]
    assert [p["numInputRows"] for p in batches] == [5, 5, 1]
    bronze = read_table(spark, selic.bronze)
    assert bronze.count() == 11
    assert bronze.select("ingestion_timestamp").distinct().count() == 3
    silver = silver_content(bronze, selic)
    assert silver.count() == 10
    first = silver.where(F.col("reference_date") == F.lit(days[0])).first()
    assert first.source_file == "c.json" and float(first.selic_daily_pct) == pytest.approx(0.0999)


@pytest.mark.parametrize("keys", [("series_name",), ()])
def test_incremental_gold_equals_full_recompute(spark, tmp_path, keys):
    steps = {}
    for incremental in (False, True):
        root, selic, ipca, mart = layout(tmp_path / f"gold-{incremental}")
        mart = replace(mart, keys=keys, checkpoint=str(root / "checkpoints" / "gold"))
        fingerprints, recomputed = [], None
        run_layers(spark, [selic, ipca], mart, incremental=incremental)
        fingerprints.append(content_fingerprint(gold_view(spark, mart)).first())
        # a changed first day and a new day in a month without a reference value yet
        write_raw(
            root / "landing" / "selic",
            "selic_backfill_001.json",
            [{"data": fmt(FIVE_YEARS_DAYS[0]), "valor": "0,099"}, {"data": fmt(dt.date(2025, 1, 2)), "valor": "0.05"}],
        )
        run_layers(spark, [selic, ipca], mart, incremental=incremental)
        fingerprints.append(content_fingerprint(gold_view(spark, mart)).first())
        stamp_2 = read_table(spark, mart.gold).agg(F.max("gold_updated_at")).first()[0]
        # a revised reference month and the missing month
        write_raw(
            root / "landing" / "ipca",
            "ipca_revision_001.json",
            [{"data": fmt(dt.date(2022, 6, 1)), "valor": "0.91"}, {"data": fmt(dt.date(2025, 1, 1)), "valor": "0.40"}],
        )
        run_layers(spark, [selic, ipca], mart, incremental=incremental)
        fingerprints.append(content_fingerprint(gold_view(spark, mart)).first())
        if incremental:
            recomputed = {
                r.reference_month
                for r in read_table(spark, mart.gold).where(F.col("gold_updated_at") > F.lit(stamp_2)).collect()
            }
        steps[incremental] = (fingerprints, recomputed)
    assert steps[True][0] == steps[False][0]
    assert [f.rows for f in steps[True][0]] == [60, 60, 61]
    months = steps[True][1]
    assert min(months) == dt.date(2022, 6, 1) and max(months) == dt.date(2025, 1, 1)
    assert len(months) == 32  # 2022-06 .. 2025-01; earlier rows kept their values


def test_archive_moves_landed_files_and_ingest_continues(spark, tmp_path):
    root = tmp_path / "lake"
    selic = replace(SELIC, archive=str(tmp_path / "archive")).located(str(root))
    landing = root / "landing" / "selic"
    write_raw(landing, "a.json", daily_records(FIVE_YEARS_DAYS[:5]))
    write_raw(landing, "b.json", daily_records(FIVE_YEARS_DAYS[5:8]))
    ingest_series(spark, selic)
    assert read_table(spark, selic.bronze).count() == 8
    write_raw(landing, "c.json", daily_records(FIVE_YEARS_DAYS[8:10]))
    ingest_series(spark, selic)
    assert read_table(spark, selic.bronze).count() == 10
    archived = {p.name for p in (tmp_path / "archive").rglob("*.json")}
    assert {"a.json", "b.json"} <= archived
    assert not (landing / "a.json").exists() and not (landing / "b.json").exists()


def test_incremental_layers_recover_from_bad_records_and_empty_files(spark, tmp_path):
    """Bad record, corrected record and an empty array: Silver and Gold equal the full jobs."""
    root, selic, ipca, mart = layout(tmp_path)
    mart = replace(mart, checkpoint=str(root / "checkpoints" / "gold"))
    landing = root / "landing" / "selic"
    run_layers(spark, [selic, ipca], mart, incremental=True)
    before = gold_view(spark, mart).count()

    write_raw(landing, "empty.json", [])
    run_layers(spark, [selic, ipca], mart, incremental=True)
    assert gold_view(spark, mart).count() == before

    write_raw(landing, "bad.json", [{"data": "02/01/2025", "valor": "11"}, {"data": "03/01/2025"}, {"data": "06/01/2025", "valor": "0.04"}])
    with pytest.raises(ValueError, match="refused"):
        run_layers(spark, [selic, ipca], mart, incremental=True)
    refused = {r.refused for r in spark.read.parquet(selic.quarantine).collect()}
    assert refused == {"rate out of range", "no valid rate"}
    silver = read_table(spark, selic.silver)
    assert silver.where(F.col("reference_date") == "2025-01-06").count() == 1
    with pytest.raises(ValueError):
        run_conform(spark, [selic, ipca])  # the full job refuses the same Bronze

    write_raw(landing, "corrected.json", [{"data": "02/01/2025", "valor": "0.05"}, {"data": "03/01/2025", "valor": "0.06"}])
    write_raw(root / "landing" / "ipca", "ipca_2025.json", [{"data": "01/01/2025", "valor": "0.3"}])
    run_layers(spark, [selic, ipca], mart, incremental=True)
    columns = ["series_name", "reference_date", "selic_daily_pct"]
    got = content_fingerprint(read_table(spark, selic.silver).select(columns)).first()
    gold = content_fingerprint(gold_view(spark, mart)).first()
    assert gold.rows == before + 1

    full = replace(selic, silver=str(root / "full_silver")), replace(ipca, silver=str(root / "full_ipca"))
    run_conform(spark, full)
    assert content_fingerprint(read_table(spark, full[0].silver).select(columns)).first() == got
    full_mart = replace(mart, nominal=full[0], reference=full[1], gold=str(root / "full_gold"))
    run_mart(spark, full_mart)
    assert content_fingerprint(gold_view(spark, full_mart)).first() == gold


def test_contract_stops_behind_the_ingest(spark, tmp_path):
    root, selic, ipca, mart = layout(tmp_path)
    run_layers(spark, [selic, ipca], mart, contract=True)
    landing = root / "landing" / "selic"
    write_raw(landing, "empty.json", [])
    write_raw(landing, "holes.json", [{"data": "03/01/2025"}, {"data": "2025-01-04", "valor": "x"}, {"data": "05/01/2025", "valor": "1"}, {"data": "05/01/2025", "valor": "2"}])
    report = {r.source_file: r for r in file_contract(spark, selic).collect()}
    assert not report["empty.json"].contract_ok and report["empty.json"].records == 0
    holes = report["holes.json"]
    assert (holes.records, holes.missing_data, holes.missing_valor, holes.bad_data, holes.bad_valor, holes.repeated_keys) == (4, 0, 1, 1, 1, 1)
    assert sum(not r.contract_ok for r in report.values()) == 2
    with pytest.raises(ValueError, match="2 files break the contract"):
        run_layers(spark, [selic, ipca], mart, contract=True)
