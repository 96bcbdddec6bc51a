"""Incremental Gold by any keys: equal to a mart built anew from Silver after every step."""

import datetime as dt
import random
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from ratecraft.operators import content_fingerprint
from ratecraft.operators.mart import merged_rates, monthly_rates, monthly_state
from ratecraft.plans.jobs import MartSpec, build_mart, conform_batch, gold_view, refresh_gold_by_state, run_mart_incremental
from ratecraft.sources.raw import BRONZE_SCHEMA
from ratecraft.sources.tables import read_table
from ratecraft.specs import IPCA, SELIC

MONTHS = [dt.date(2020 + k // 12, k % 12 + 1, 1) for k in range(20)]


def records(rng, series, days, file, batch):
    at = dt.datetime(2024, 3, 1) + dt.timedelta(hours=batch)
    return [
        (d.strftime("%d/%m/%Y"), f"{rng.uniform(-0.5, 1.5):.6f}", series, file, f"landing/{file}", at, at, at.date()) for d in days
    ]


def days_of(rng, n):
    return [m + dt.timedelta(days=rng.randrange(28)) for m in rng.choices(MONTHS, k=n)]


MARTS = {
    "two columns": {"keys": ("series_name", "half"), "key_columns": (("half", "if(day(reference_date) <= 15, 1, 2)"),)},
    "several series": {"keys": ("desk",), "key_columns": (("desk", "substring(series_name, 1, 1)"),)},
    "moving groups": {"keys": ("series_name", "source_file"), "key_columns": ()},
}


@pytest.mark.parametrize("name", MARTS)
def test_every_step_equals_a_mart_built_anew(spark, tmp_path, name):
    rng = random.Random(name)
    rates, ipca = SELIC.located(str(tmp_path)), IPCA.located(str(tmp_path))
    mart = MartSpec(nominal=rates, reference=ipca, gold=str(tmp_path / "gold"), months=4, partition_grain="month", **MARTS[name])
    month_records = lambda months, b: records(rng, "ipca", months, f"ipca{b}", b)
    steps = [
        ([r for s in ("a1", "a2", "b1") for r in records(rng, s, days_of(rng, 60), "f0", 0)], month_records(MONTHS[:-2], 0)),
        (records(rng, "a2", days_of(rng, 6), "f1", 1), []),  # restated days move to another file's group
        ([], month_records(MONTHS[5:7], 2)),
        (records(rng, "c1", days_of(rng, 5), "f1", 3) + records(rng, "b1", days_of(rng, 3), "f0", 3), month_records(MONTHS[-2:], 3)),
    ]
    for batch, (daily, monthly) in enumerate(steps):
        for spec, rows in ((rates, daily), (ipca, monthly)):
            if rows:
                conform_batch(spec, spark.createDataFrame(rows, BRONZE_SCHEMA), batch)
        before = read_table(spark, mart.gold).agg(F.max("gold_updated_at")).first()[0] if batch else None
        run_mart_incremental(spark, mart)
        expected = build_mart(spark, mart)
        assert content_fingerprint(gold_view(spark, mart).select(expected.columns)).first() == content_fingerprint(expected).first()
        if batch == 1:  # other series' groups weren't touched
            again = read_table(spark, mart.gold).where(F.col("gold_updated_at") > F.lit(before))
            group = "desk" if name == "several series" else "series_name"
            assert {r[0] for r in again.select(group).distinct().collect()} == {"a" if group == "desk" else "a2"}
    # the change logs don't grow with the runs
    run_mart_incremental(spark, mart)
    left = [p for log in (rates.changes, ipca.changes) for p in (tmp_path / log / "gold").glob("*.parquet")]
    assert len(left) <= 2


def test_a_refresh_that_died_between_gold_and_state_is_done_again(spark, tmp_path, monkeypatch):
    from ratecraft.plans import jobs

    rng = random.Random(3)
    rates, ipca = SELIC.located(str(tmp_path)), IPCA.located(str(tmp_path))
    mart = MartSpec(nominal=rates, reference=ipca, gold=str(tmp_path / "gold"), keys=("series_name", "source_file"), months=3)
    conform_batch(ipca, spark.createDataFrame(records(rng, "ipca", MONTHS, "ipca", 0), BRONZE_SCHEMA), 0)
    conform_batch(rates, spark.createDataFrame(records(rng, "a", [MONTHS[3], MONTHS[4]], "f0", 0), BRONZE_SCHEMA), 0)
    run_mart_incremental(spark, mart)
    conform_batch(rates, spark.createDataFrame(records(rng, "a", [MONTHS[3]], "f1", 1), BRONZE_SCHEMA), 1)
    real = jobs.upsert

    def dying(spark, source, target, *args, **named):
        if target == mart.state_table:
            raise KeyboardInterrupt
        return real(spark, source, target, *args, **named)

    changes = spark.createDataFrame([("a", MONTHS[3], "nominal")], "series_name string, reference_month date, side string")
    monkeypatch.setattr(jobs, "upsert", dying)
    with pytest.raises(KeyboardInterrupt):
        refresh_gold_by_state(mart, changes)
    monkeypatch.setattr(jobs, "upsert", real)
    run_mart_incremental(spark, mart)
    expected = build_mart(spark, mart)
    assert content_fingerprint(gold_view(spark, mart)).first() == content_fingerprint(expected).first()
    state = {(r.source_file, r.reference_month) for r in read_table(spark, mart.state_table).collect()}
    assert state == {("f1", MONTHS[3]), ("f0", MONTHS[4])}


def test_merged_state_gives_the_rates_themselves(spark):
    rng = random.Random(6)
    rows = [(rng.choice("ab"), rng.choice("xyz"), d, rng.choice([None, -100.0, -250.0, 0.05, 1.5, 0.33333333])) for d in days_of(rng, 400)]
    rows += [(s, "w", m, 0.1) for s in "ab" for m in MONTHS]
    daily = spark.createDataFrame(rows, "k string, part string, reference_date date, rate double")
    for kind in ("double", "decimal(18,8)"):
        typed = daily.withColumn("rate", F.col("rate").cast(kind))
        state = monthly_state(typed, "rate", keys=["k", "part"])
        got, expected = merged_rates(state, ["k"]), monthly_rates(typed, "rate", keys=["k"])
        assert [f.dataType for f in got.schema] == [f.dataType for f in expected.schema]
        rounded = lambda df: sorted((r[0], r[1], r[2] and round(float(r[2]), 7), r[3] and round(r[3], 7), r[4]) for r in df.collect())
        assert str(rounded(got)) == str(rounded(expected))


def test_null_keys_are_refused(spark, tmp_path):
    rng = random.Random(3)
    rates, ipca = SELIC.located(str(tmp_path)), IPCA.located(str(tmp_path))
    mart = MartSpec(
        nominal=rates, reference=ipca, gold=str(tmp_path / "gold"), keys=("half",),
        key_columns=(("half", "if(day(reference_date) <= 15, 1, null)"),),
    )
    conform_batch(rates, spark.createDataFrame(records(rng, "a", [dt.date(2020, 1, 20)], "f", 0), BRONZE_SCHEMA), 0)
    conform_batch(ipca, spark.createDataFrame(records(rng, "ipca", MONTHS, "ipca", 0), BRONZE_SCHEMA), 0)
    with pytest.raises(Exception, match="may not be null"):
        run_mart_incremental(spark, replace(mart))
