"""Series registry and rule sets.

A ``SeriesSpec`` describes one raw rate series: where its files land, where
its layers live, its grain and its allowed range. A ``RuleSet`` lists the
checks a layer must pass before it is written.
"""

from __future__ import annotations

from dataclasses import dataclass, replace

# ---------------------------------------------------------------------------
# These must equal the source pipeline's for equal results.
#   raw date pattern ............ dd/MM/yyyy
#   stored rate type ............ decimal(18,8)
#   rolling window .............. 12 monthly rows
#   output rounding ............. 8 decimal places
#   daily nominal rate range .... [-5, 10] percent per day   (series "selic")
#   monthly inflation range ..... [-20, 50] percent per month (series "ipca")
#   raw record fields ........... data, valor (strings; sources/raw.py RAW_SCHEMA)
#   Bronze columns .............. data_raw, valor_raw, series_name, source_file,
#                                 source_path, ingestion_timestamp, ingestion_date
#                                 (sources/raw.py BRONZE_SCHEMA, which adds source_modified_at)
# ---------------------------------------------------------------------------
RAW_DATE_PATTERN = "dd/MM/yyyy"
RATE_TYPE = "decimal(18,8)"
WINDOW_MONTHS = 12
OUTPUT_SCALE = 8

DAY = "day"
MONTH = "month"
YEAR = "year"


@dataclass(frozen=True)
class SeriesSpec:
    """One raw series and the locations of its layers.

    ``name`` is written as ``series_name``; with ``series_from_dir`` the name
    is taken from each file's parent folder instead (``<root>/<name>/f.json``
    or ``<root>/series=<name>/f.json``), so one stream ingests many series.
    """

    name: str
    grain: str  # DAY or MONTH
    rate_column: str
    rate_min: float
    rate_max: float
    landing: str | None = None
    bronze: str | None = None
    silver: str | None = None
    checkpoint: str | None = None
    silver_checkpoint: str | None = None
    # (series_name, reference_month) pairs touched by incremental Silver runs: one
    # folder for each of change_readers (a Gold job each), which deletes what it has read
    changes: str | None = None
    change_readers: tuple[str, ...] = ("gold",)
    # records that the incremental Silver job refused, with the rule they broke,
    # one folder a batch
    quarantine: str | None = None
    # log of the contracts of landed files, and the checkpoint of the stream that judges them
    contracts: str | None = None
    contract_checkpoint: str | None = None
    multi_line: bool = True
    series_from_dir: bool = False
    max_files_per_trigger: int | None = None
    # Optional: move landed files here once their batch has committed, so the
    # landing folder (listed on every run) stays small. Off by default: the
    # landing then keeps every file, as in the source pipeline.
    archive: str | None = None
    # Silver partition: YEAR, MONTH or DAY of the key date. An upsert rewrites
    # whole partitions, so a large daily series should use MONTH or DAY.
    partition_grain: str = YEAR
    # Second partition level of Silver: series are dealt to so many buckets by name,
    # and an upsert reads and rewrites only the buckets of its series. For tables of many series.
    series_buckets: int | None = None

    @property
    def key_column(self) -> str:
        return "reference_date" if self.grain == DAY else "reference_month"

    @property
    def business_key(self) -> list[str]:
        return ["series_name", self.key_column]

    def located(self, root: str) -> "SeriesSpec":
        """Derive landing, layer and checkpoint paths under one root."""
        root = root.rstrip("/")
        return replace(
            self,
            landing=self.landing or f"{root}/landing/{self.name}",
            bronze=self.bronze or f"{root}/bronze/{self.name}",
            silver=self.silver or f"{root}/silver/{self.name}",
            checkpoint=self.checkpoint or f"{root}/checkpoints/bronze_{self.name}",
            silver_checkpoint=self.silver_checkpoint or f"{root}/checkpoints/silver_{self.name}",
            changes=self.changes or f"{root}/changes/{self.name}",
            quarantine=self.quarantine or f"{root}/quarantine/{self.name}",
            contracts=self.contracts or f"{root}/contracts/{self.name}",
            contract_checkpoint=self.contract_checkpoint or f"{root}/checkpoints/contract_{self.name}",
        )


# The two series of the source pipeline (fixed values, see above).
SELIC = SeriesSpec(
    name="selic", grain=DAY, rate_column="selic_daily_pct", rate_min=-5, rate_max=10
)
IPCA = SeriesSpec(
    name="ipca", grain=MONTH, rate_column="ipca_monthly_pct", rate_min=-20, rate_max=50
)


@dataclass(frozen=True)
class RuleSet:
    """Checks for one dataset; every rule yields a violation count."""

    dataset: str
    not_empty: bool = True
    required: tuple[str, ...] = ()
    unique_key: tuple[str, ...] = ()
    ranges: tuple[tuple[str, float, float], ...] = ()
    positive: tuple[str, ...] = ()


def silver_rules(spec: SeriesSpec, dataset: str | None = None) -> RuleSet:
    """Rules of a conformed series: key and rate present, key unique, rate in range."""
    return RuleSet(
        dataset=dataset or f"silver_{spec.name}",
        required=(spec.key_column, spec.rate_column),
        unique_key=tuple(spec.business_key),
        ranges=((spec.rate_column, spec.rate_min, spec.rate_max),),
    )


def gold_rules(
    keys: tuple[str, ...] = (),
    nominal: str = "nominal",
    reference: str = "inflation",
    dataset: str = "gold_monthly",
) -> RuleSet:
    """Rules of the monthly mart; the rolling columns may be null."""
    return RuleSet(
        dataset=dataset,
        required=(
            "reference_month",
            f"{nominal}_daily_average_pct",
            f"{nominal}_monthly_effective_pct",
            f"{reference}_monthly_pct",
            "real_interest_monthly_pct",
        ),
        unique_key=tuple(keys) + ("reference_month",),
        positive=(f"{nominal}_observation_count",),
    )
