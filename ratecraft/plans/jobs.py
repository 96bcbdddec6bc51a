"""Layer jobs: Bronze ingest, Silver conform, Gold mart, and all three in order.

Each layer stages its result once under the checkpoint root, validates the
staged copy, and only then upserts it. Staging means the plan is computed
once (not once per check), and a lost executor recomputes from staged files
instead of from the raw landing. The staging folders are deleted once the
upserts have committed.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from contextlib import ExitStack
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, StringType, StructField, StructType

from ratecraft.functions.parsing import (
    PARTITION_COLUMNS,
    SERIES_BUCKET,
    month_of,
    partition_column,
    partition_value,
    series_bucket,
)
from ratecraft.operators.conform import broken_rule, conform, latest_records, record_order, typed_series
from ratecraft.operators.mart import MONTH_KEY, merged_rates, monthly_mart, monthly_rates, monthly_reference, monthly_state
from ratecraft.operators.quality import any_null, validate
from ratecraft.operators.upsert import staged, stamp, upsert
from ratecraft.sources.raw import BRONZE_SCHEMA, read_bronze, read_bronze_stream
from ratecraft.sources.tables import read_table, try_read_table
from ratecraft.session import ensure_dir, path_exists, remove_path
from ratecraft.specs import WINDOW_MONTHS, YEAR, RuleSet, SeriesSpec, gold_rules, silver_rules
from ratecraft.streaming.contract import run_ingest_with_contract
from ratecraft.streaming.ingest import await_all, run_ingest, run_streams

PARTITION_COLUMN = PARTITION_COLUMNS[YEAR]  # the default partition column


@dataclass(frozen=True)
class MartSpec:
    """The Gold mart: which daily series against which monthly series, and where."""

    nominal: SeriesSpec
    reference: SeriesSpec
    gold: str
    keys: tuple[str, ...] = ("series_name",)
    months: int = WINDOW_MONTHS
    nominal_name: str | None = None
    reference_name: str | None = None
    partition_grain: str = YEAR  # YEAR or MONTH of reference_month
    checkpoint: str | None = None  # stream checkpoint of the incremental Gold job; see gold_checkpoint
    reader: str = "gold"  # whose change logs the incremental Gold job reads; one mart each
    # keys that aren't columns of the nominal Silver table: (name, SQL expression over it)
    key_columns: tuple[tuple[str, str], ...] = ()
    state: str | None = None  # monthly state of a mart by other keys than the series; see state_table

    @property
    def by_series(self) -> bool:
        """Whether the mart is keyed by the series, or has no key: then Silver itself is read for a refresh."""
        return tuple(self.keys) in ((), ("series_name",)) and not self.key_columns

    @property
    def state_table(self) -> str:
        """``state``, or a table beside Gold."""
        return self.state or f"{self.gold}_state"

    @property
    def gold_checkpoint(self) -> str | None:
        """``checkpoint``, or a folder beside the nominal series' Silver checkpoint."""
        own = self.nominal.silver_checkpoint
        return self.checkpoint or (own and f"{own}_gold")

    @property
    def names(self) -> tuple[str, str]:
        return (self.nominal_name or self.nominal.name, self.reference_name or self.reference.name)


def silver_partitions(spec: SeriesSpec) -> dict[str, Column]:
    """Partition columns of a Silver table: by date and, with ``series_buckets``, by series."""
    out = {partition_column(spec.partition_grain): partition_value(spec.key_column, spec.partition_grain)}
    if spec.series_buckets:
        out[SERIES_BUCKET] = series_bucket(spec.series_buckets)
    return out


def silver_content(bronze: DataFrame, spec: SeriesSpec) -> DataFrame:
    """Conformed series plus its partition columns."""
    return conform(bronze, spec).withColumns(silver_partitions(spec))


def run_conform(spark: SparkSession, specs: Sequence[SeriesSpec]) -> dict[str, str]:
    """Silver job: conform every series, validate every series, then upsert each.

    Every validation runs before the first write, so one bad series blocks
    all of them. Each task conforms a bounded number of records (their count is
    in the footers of Bronze's files).
    """
    with ExitStack() as stack:
        content = {}
        for spec in specs:
            bronze = read_bronze(spark, spec)
            conformed = staged(spark, silver_content(bronze, spec), f"silver-{spec.name}", rows=bronze.count())
            content[spec.name] = stack.enter_context(conformed)
        for spec in specs:
            validate(content[spec.name], silver_rules(spec))
        return {
            spec.name: upsert(
                spark,
                stamp(content[spec.name], "silver_updated_at"),
                spec.silver,
                keys=spec.business_key,
                partition_by=tuple(silver_partitions(spec)),
                check_unique=False,  # validated above
                source_staged=True,
            )
            for spec in specs
        }


def quarantined(spark: SparkSession, spec: SeriesSpec) -> DataFrame:
    """Records that the incremental Silver job refused, as landed and as parsed:
    the typed columns, data_raw, valor_raw, refused (the rule), refused_at, batch_id."""
    bronze = spark.createDataFrame([], BRONZE_SCHEMA)
    schema = typed_series(bronze, spec, raw=True).schema.add("refused", "string").add("refused_at", "timestamp").add("batch_id", "long")
    if not path_exists(spark, spec.quarantine):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(spec.quarantine)


def conform_batch(spec: SeriesSpec, bronze: DataFrame, batch_id: int) -> int:
    """Conform and upsert one set of Bronze records of a series; the number refused.

    The row rules come first, record by record: a record that breaks one goes to
    the quarantine, and only valid records take part in the dedup, so a broken
    record never hides a valid one of its key. A later, valid record of a
    refused key is conformed like any other and repairs the series. A row of
    Silver is replaced only by one that isn't older (``record_order``); so Silver
    is the newest valid record of each key, however records are cut into batches
    and in whatever order batches come. A batch without records changes nothing.

    A batch may be done again: its quarantine folder (``batch_id=<n>``) is
    replaced, not added to, and the upsert is idempotent. Batch 0 means a new
    checkpoint, which reads Bronze from its beginning: it clears the quarantine.

    After the upsert has committed, the touched (series, month) pairs are
    appended to the series' change log, so Gold never sees a change before its
    data. A batch done again appends them twice, which is harmless.
    """
    spark = bronze.sparkSession
    typed = typed_series(bronze, spec, raw=True).withColumn("refused", broken_rule(spec))
    with staged(spark, typed, f"records-{spec.name}") as records:
        counts = records.agg(F.count_if(F.col("refused").isNull()).alias("good"), F.count("refused").alias("bad")).first()
        if batch_id == 0:
            remove_path(spark, spec.quarantine)
        if counts.bad:
            bad = records.filter("refused is not null").withColumn("refused_at", F.current_timestamp())
            bad.write.mode("overwrite").parquet(f"{spec.quarantine}/batch_id={batch_id}")
        if not counts.good:
            return counts.bad
        good = latest_records(records.filter("refused is null").drop("refused", "data_raw", "valor_raw"), spec)
        good = good.withColumns(silver_partitions(spec))
        with staged(spark, good, f"silver-{spec.name}", rows=counts.good + counts.bad) as content:
            validate(content, silver_rules(spec))
            upsert(
                spark,
                stamp(content, "silver_updated_at"),
                spec.silver,
                keys=spec.business_key,
                partition_by=tuple(silver_partitions(spec)),
                check_unique=False,  # validated above
                source_staged=True,
                newer_by=record_order(spec),
            )
            if spec.changes:
                touched = content.select("series_name", month_of(spec.key_column).alias(MONTH_KEY)).distinct().coalesce(1)
                for reader in spec.change_readers:
                    touched.write.mode("append").parquet(f"{spec.changes}/{reader}")
    return counts.bad


def run_conform_incremental(
    spark: SparkSession, specs: Sequence[SeriesSpec], fail_on_refused: bool = True
) -> dict[str, int]:
    """Silver job that reads only the Bronze records added since its last run.

    A file stream over each Bronze table (it lists the files Bronze's commit
    log holds, and its own checkpoint remembers which it has read) hands
    every new set of records to :func:`conform_batch`. Where every record is
    valid this equals the full recompute of :func:`run_conform`. The cost of a
    run follows the new data, not the history.

    Refused records don't hold up the others: they are quarantined, all
    batches are committed, and then the run fails with their number, or returns
    it by series name without ``fail_on_refused``. The next run goes on with
    later records; once a refused key's newest record is valid, Silver again
    equals the full recompute, which fails before that. A batch whose job fails
    isn't committed and is redone on the next run. Each series is gated on its own.
    """
    refused: dict[str, int] = {}

    def start(spec: SeriesSpec):
        if not (spec.bronze and spec.silver and spec.silver_checkpoint and spec.quarantine):
            raise ValueError(f"series {spec.name!r} has no bronze/silver/checkpoint/quarantine location")

        def batch(records: DataFrame, batch_id: int) -> None:
            refused[spec.name] = refused.get(spec.name, 0) + conform_batch(spec, records, batch_id)

        return (
            read_bronze_stream(spark, spec)
            .writeStream.foreachBatch(batch)
            .option("checkpointLocation", spec.silver_checkpoint)
            .trigger(availableNow=True)
            .start()
        )

    run_streams(specs, start)
    bad = {name: n for name, n in refused.items() if n}
    if bad and fail_on_refused:
        raise ValueError(f"Silver refused records, see the quarantine tables: {bad}")
    return bad


def build_mart(
    spark: SparkSession, mart: MartSpec, daily: DataFrame | None = None, monthly: DataFrame | None = None
) -> DataFrame:
    """Gold content from the two Silver tables (full recompute), or from the
    given selections of them."""
    nominal, reference = mart.names
    daily = read_table(spark, mart.nominal.silver) if daily is None else daily
    monthly = read_table(spark, mart.reference.silver) if monthly is None else monthly
    rates = monthly_rates(_keyed(mart, daily), mart.nominal.rate_column, keys=mart.keys, name=nominal)
    return _mart_of(mart, rates, monthly)


def _keyed(mart: MartSpec, daily: DataFrame) -> DataFrame:
    """The nominal Silver rows with the mart's own key columns."""
    return daily.withColumns({name: F.expr(sql) for name, sql in mart.key_columns})


def _mart_of(mart: MartSpec, rates: DataFrame, monthly: DataFrame) -> DataFrame:
    nominal, reference = mart.names
    return monthly_mart(
        rates,
        monthly_reference(monthly, mart.reference.rate_column, name=reference),
        keys=mart.keys,
        months=mart.months,
        nominal=nominal,
        reference=reference,
    )


def run_mart(spark: SparkSession, mart: MartSpec) -> str:
    """Gold job: build, stage, validate, upsert by (keys, month)."""
    nominal, reference = mart.names
    return _upsert_gold(spark, mart, build_mart(spark, mart), gold_rules(mart.keys, nominal, reference))


def _upsert_gold(
    spark: SparkSession, mart: MartSpec, content: DataFrame, rules: RuleSet, replaced: DataFrame | None = None
) -> str:
    """Stage Gold rows with their partition column, validate them, upsert them; rows of ``replaced``
    (Gold as it is, or a part of it) whose keys aren't among them go."""
    part = partition_column(mart.partition_grain)
    content = content.withColumn(part, partition_value(MONTH_KEY, mart.partition_grain))
    with ExitStack() as stack:
        gold = stack.enter_context(staged(spark, content, "gold"))
        validate(gold, rules)
        deleted = None
        if replaced is not None:
            keys = [*mart.keys, MONTH_KEY]
            deleted = stack.enter_context(staged(spark, replaced.select(*keys, part).join(gold, keys, "left_anti"), "gold-deleted"))
        return upsert(
            spark,
            stamp(gold, "gold_updated_at"),
            mart.gold,
            keys=[*mart.keys, MONTH_KEY],
            partition_by=(part,),
            check_unique=False,
            source_staged=True,
            deleted=deleted,
        )


CHANGES_SCHEMA = StructType(
    [StructField("series_name", StringType(), True), StructField(MONTH_KEY, DateType(), True)]
)


def _from_partition(spec: SeriesSpec, first: dt.date) -> Column:
    """Partitions holding dates from ``first`` on (prunes the scan)."""
    grain = spec.partition_grain
    return F.col(partition_column(grain)) >= partition_value(F.lit(first), grain)


def _in_partitions(grain: str, low: dt.date | None, high: dt.date | None) -> Column:
    """Partitions of the months from ``low`` to ``high`` (prunes the scan); none without them."""
    if low is None:
        return F.lit(False)
    first, last = (partition_value(d, grain) for d in (F.lit(low), F.last_day(F.lit(high))))
    return F.col(partition_column(grain)).between(first, last)


def _frame_bounds(mart: MartSpec, current: DataFrame, m0: DataFrame) -> DataFrame:
    """(keys, m0, start): the month of the ``months - 1``-th Gold row before ``m0``, or ``m0``."""
    keys, month = list(mart.keys), F.col(MONTH_KEY)
    earlier = current.select(*keys, MONTH_KEY).join(m0, keys).where(month < F.col("m0"))
    by_recency = Window.partitionBy(*keys).orderBy(month.desc())
    frame_start = (
        earlier.select(*keys, MONTH_KEY, F.row_number().over(by_recency).alias("_back"))
        .where(F.col("_back") < mart.months)
        .groupBy(*keys)
        .agg(F.min(month).alias("start"))
    )
    return m0.join(frame_start, keys, "left").select(*keys, "m0", F.coalesce("start", "m0").alias("start"))


def refresh_gold(mart: MartSpec, changes: DataFrame) -> str | None:
    """Recompute the Gold rows that a set of Silver changes can affect; upsert them.

    ``changes`` holds (series_name, reference_month, side), side being
    ``nominal`` or ``reference``. For each touched series, ``m0`` is its
    first changed month; a changed reference month moves ``m0`` for every
    series. Rows before ``m0`` keep their values. Rows from ``m0`` on are
    recomputed from Silver read from ``start``, the month of the
    ``months - 1``-th Gold row before ``m0``, so every 12-row frame is whole
    and built from unrounded monthly values, as in the full recompute.
    Without a Gold table yet, the whole mart is built. A mart by other keys goes
    by its monthly state (:func:`refresh_gold_by_state`).
    """
    spark = changes.sparkSession
    if not mart.by_series:
        return refresh_gold_by_state(mart, changes)
    current = try_read_table(spark, mart.gold)
    if current is None:
        return run_mart(spark, mart)
    if not mart.keys:
        return _refresh_single_series(spark, mart, current, changes)
    keys = list(mart.keys)
    side, month = F.col("side"), F.col(MONTH_KEY)
    m0 = changes.where(side == "nominal").groupBy(*keys).agg(F.min(month).alias("m0"))
    reference_m0 = changes.where(side == "reference").agg(F.min(month)).first()[0]  # one value
    if reference_m0 is not None:
        # every series in Silver, not only those in Gold; two columns of its scan at most
        every = read_table(spark, mart.nominal.silver).select(*keys).distinct()
        m0 = m0.unionByName(every.withColumn("m0", F.lit(reference_m0)))
        m0 = m0.groupBy(*keys).agg(F.min("m0").alias("m0"))
    bounds = _frame_bounds(mart, current, m0)
    with staged(spark, bounds, "gold-bounds") as bounds:  # read three times below
        lowest = bounds.agg(F.min("start")).first()[0]  # one value
        if lowest is None:
            return None
        daily = read_table(spark, mart.nominal.silver).where(_from_partition(mart.nominal, lowest))
        daily = daily.join(bounds.select(*keys, "start"), keys).where(
            month_of(mart.nominal.key_column) >= F.col("start")
        )
        monthly = read_table(spark, mart.reference.silver).where(_from_partition(mart.reference, lowest))
        monthly = monthly.where(month >= F.lit(lowest))
        content = build_mart(spark, mart, daily, monthly)
        content = (
            content.join(bounds.select(*keys, "m0"), keys)
            .where(month >= F.col("m0"))
            .select(content.columns)
        )
        return _upsert_gold(spark, mart, content, replace(gold_rules(mart.keys, *mart.names), not_empty=False))


def _refresh_single_series(
    spark: SparkSession, mart: MartSpec, current: DataFrame, changes: DataFrame
) -> str | None:
    """:func:`refresh_gold` for the unkeyed mart (all daily rows form one
    series): the bounds are single values, found by two small aggregates."""
    month = F.col(MONTH_KEY)
    m0 = changes.agg(F.min(month)).first()[0]  # one value over both sides
    if m0 is None:
        return None
    earlier = current.where(month < F.lit(m0)).orderBy(month.desc()).limit(mart.months - 1)
    start = earlier.agg(F.min(month)).first()[0] or m0  # one value
    daily = read_table(spark, mart.nominal.silver).where(_from_partition(mart.nominal, start))
    daily = daily.where(month_of(mart.nominal.key_column) >= F.lit(start))
    monthly = read_table(spark, mart.reference.silver).where(_from_partition(mart.reference, start))
    monthly = monthly.where(month >= F.lit(start))
    content = build_mart(spark, mart, daily, monthly).where(month >= F.lit(m0))
    return _upsert_gold(spark, mart, content, replace(gold_rules(mart.keys, *mart.names), not_empty=False))


def refresh_gold_by_state(mart: MartSpec, changes: DataFrame) -> str | None:
    """:func:`refresh_gold` for a mart by any keys, such as two columns or a part of the series' name.

    Beside Gold lies its monthly state: for each (series, keys, month) of the
    nominal series the counts and sums that merge to the monthly rates of any
    coarser keys. Silver is read only for the (series, month) pairs in
    ``changes``; their state is replaced, since a restated record may move from
    one group to another and a least factor can't be taken back. Groups that
    such a pair had or now has are recomputed from ``m0`` on, out of the state of
    their frames' months; Gold rows of groups that have vanished go. The result
    is that of a mart built anew from Silver.

    Gold is written first, the state last, so a refresh that is done again
    still finds the groups that had lost records. Keys may not be null; Gold
    and Silver are path tables.
    """
    spark, keys, month = changes.sparkSession, list(mart.keys), F.col(MONTH_KEY)
    part = partition_column(mart.partition_grain)
    pair = ["series_name", MONTH_KEY]
    own = ["series_name", *(k for k in keys if k != "series_name")]
    current, state = try_read_table(spark, mart.gold), try_read_table(spark, mart.state_table)
    rules = replace(gold_rules(mart.keys, *mart.names), not_empty=False)

    def state_of(daily: DataFrame) -> DataFrame:
        found = monthly_state(_keyed(mart, daily), mart.nominal.rate_column, mart.nominal.key_column, own)
        return found.withColumn(part, partition_value(MONTH_KEY, mart.partition_grain))

    def write_state(fresh: DataFrame, deleted: DataFrame | None) -> None:
        upsert(spark, fresh, mart.state_table, [*own, MONTH_KEY], (part,), check_unique=False, source_staged=True, deleted=deleted)

    def checked(fresh: DataFrame) -> DataFrame:
        if not fresh.where(any_null(own)).isEmpty():
            raise ValueError(f"mart keys {keys} may not be null")
        return fresh

    silver, monthly = read_table(spark, mart.nominal.silver), read_table(spark, mart.reference.silver)
    if current is None or state is None:
        with staged(spark, state_of(silver), "gold-state") as fresh:
            content = _mart_of(mart, merged_rates(checked(fresh), keys, mart.names[0]), monthly)
            done = _upsert_gold(spark, mart, content, rules, current)
            remove_path(spark, mart.state_table)
            write_state(fresh, None)
        return done

    with ExitStack() as stack:
        stage = lambda df, label: stack.enter_context(staged(spark, df, label))
        touched = stage(changes.where(F.col("side") == "nominal").select(*pair).distinct(), "gold-touched")
        span = touched.agg(F.min(month).alias("low"), F.max(month).alias("high")).first()  # two values
        reference_m0 = changes.where(F.col("side") == "reference").agg(F.min(month)).first()[0]  # one value
        if span.low is None and reference_m0 is None:
            return None
        within = lambda grain: _in_partitions(grain, span.low, span.high)
        daily = silver.where(within(mart.nominal.partition_grain))
        if mart.nominal.series_buckets:  # the touched series' buckets, known when the list is: prunes the others
            buckets = touched.select(series_bucket(mart.nominal.series_buckets).alias(SERIES_BUCKET)).distinct()
            daily = daily.join(buckets, SERIES_BUCKET, "left_semi")
        daily = daily.withColumn(MONTH_KEY, month_of(mart.nominal.key_column)).join(touched, pair, "left_semi")
        fresh = checked(stage(state_of(daily), "gold-state"))
        old = state.where(within(mart.partition_grain))
        old = stage(old.join(touched, pair, "left_semi"), "gold-state-old")
        m0 = fresh.select(*keys, MONTH_KEY).unionByName(old.select(*keys, MONTH_KEY)).withColumnRenamed(MONTH_KEY, "m0")
        if reference_m0 is not None:
            every = state.select(*keys).unionByName(fresh.select(*keys)).distinct()
            m0 = m0.unionByName(every.withColumn("m0", F.lit(reference_m0)))
        bounds = stage(_frame_bounds(mart, current, m0.groupBy(*keys).agg(F.min("m0").alias("m0"))), "gold-bounds")
        lowest = bounds.agg(F.min("start")).first()[0]  # one value
        later = F.col(part) >= partition_value(F.lit(lowest), mart.partition_grain)
        after = state.where(later).join(touched, pair, "left_anti").unionByName(fresh)
        after = after.join(bounds, keys).where(month >= F.col("start")).select(*own, MONTH_KEY, *STATE_COLUMNS)
        reference = monthly.where(_from_partition(mart.reference, lowest)).where(month >= F.lit(lowest))
        content = _mart_of(mart, merged_rates(after, keys, mart.names[0]), reference)
        content = content.join(bounds.select(*keys, "m0"), keys).where(month >= F.col("m0")).select(content.columns)
        replaced = current.where(later).join(bounds.select(*keys, "m0"), keys).where(month >= F.col("m0"))
        done = _upsert_gold(spark, mart, content, rules, replaced)
        gone = stage(old.select(*own, MONTH_KEY, part).join(fresh, [*own, MONTH_KEY], "left_anti"), "gold-state-gone")
        write_state(fresh, gone)
        return done


STATE_COLUMNS = ["observations", "rates", "rate_sum", "log_sum", "least_factor"]


def run_mart_incremental(spark: SparkSession, mart: MartSpec) -> None:
    """Gold job over the Silver change logs: only affected rows are recomputed.

    A file stream over both series' change logs (its checkpoint remembers
    what it read) hands each set of changes to :func:`refresh_gold`, for a
    mart by series, by any other keys, or without (one national series).
    """
    if not (mart.gold_checkpoint and mart.nominal.changes and mart.reference.changes):
        raise ValueError("incremental Gold needs a checkpoint and both change logs")
    streams = []
    for spec, side in ((mart.nominal, "nominal"), (mart.reference, "reference")):
        if mart.reader not in spec.change_readers:
            raise ValueError(f"series {spec.name!r} keeps no change log for {mart.reader!r}")
        log = f"{spec.changes}/{mart.reader}"
        ensure_dir(spark, log)
        # files are deleted once a later batch has committed: what is listed doesn't grow
        stream = spark.readStream.schema(CHANGES_SCHEMA).option("cleanSource", "delete").parquet(log)
        streams.append(stream.withColumn("side", F.lit(side)))
    query = (
        streams[0].unionByName(streams[1])
        .writeStream.foreachBatch(lambda batch, _id: refresh_gold(mart, batch))
        .option("checkpointLocation", mart.gold_checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    await_all([query])


def run_layers(
    spark: SparkSession,
    specs: Sequence[SeriesSpec],
    mart: MartSpec,
    incremental: bool = False,
    contract: bool = False,
) -> str:
    """Bronze, then Silver, then Gold; a failing layer stops the later ones.

    ``incremental`` conforms only the Bronze records added since the last run
    (:func:`run_conform_incremental`) and recomputes only the Gold rows they can
    affect (:func:`run_mart_incremental`, which says what it needs).
    ``contract`` judges the new files (:func:`run_ingest_with_contract`) and stops behind
    the ingest while broken ones haven't been accepted.
    """
    if contract:
        run_ingest_with_contract(spark, specs)
    else:
        run_ingest(spark, specs)
    if not incremental:
        run_conform(spark, specs)
        return run_mart(spark, mart)
    run_conform_incremental(spark, specs)
    run_mart_incremental(spark, mart)
    return "refreshed"


def gold_view(spark: SparkSession, mart: MartSpec) -> DataFrame:
    """The Gold table without load timestamps and partition helper."""
    return read_table(spark, mart.gold).drop("gold_updated_at", partition_column(mart.partition_grain))


__all__ = [
    "MartSpec",
    "PARTITION_COLUMN",
    "build_mart",
    "gold_view",
    "CHANGES_SCHEMA",
    "conform_batch",
    "quarantined",
    "refresh_gold",
    "refresh_gold_by_state",
    "run_mart_incremental",
    "run_conform",
    "run_conform_incremental",
    "run_layers",
    "run_mart",
    "silver_content",
    "silver_partitions",
]
