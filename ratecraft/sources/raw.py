"""Raw series files: schema, lineage columns, batch read and record contract."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (
    DateType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)

from ratecraft.functions.parsing import parse_date, parse_rate
from ratecraft.sources.tables import is_path
from ratecraft.specs import SeriesSpec

# Raw record: both fields are kept as strings; nothing is inferred.
RAW_SCHEMA = StructType(
    [
        StructField("data", StringType(), True),
        StructField("valor", StringType(), True),
    ]
)

BRONZE_SCHEMA = StructType(
    [
        StructField("data_raw", StringType(), True),
        StructField("valor_raw", StringType(), True),
        StructField("series_name", StringType(), True),
        StructField("source_file", StringType(), True),
        StructField("source_path", StringType(), True),
        StructField("source_modified_at", TimestampType(), True),
        StructField("ingestion_timestamp", TimestampType(), True),
        StructField("ingestion_date", DateType(), True),
    ]
)
BRONZE_COLUMNS = BRONZE_SCHEMA.fieldNames()


def landing_glob(spec: SeriesSpec, path: str | None = None) -> str:
    """The landing folder, or its series sub-folders when names come from folders."""
    base = (path or spec.landing).rstrip("/")
    return f"{base}/*" if spec.series_from_dir else base


def series_name_column(spec: SeriesSpec) -> Column:
    """Literal series name, or the parent folder of each file (``name`` or ``series=name``)."""
    if spec.series_from_dir:
        # parent folder = text between the last two '/', then after any '='
        parent = F.substring_index(F.substring_index(F.col("_metadata.file_path"), "/", -2), "/", 1)
        return F.substring_index(parent, "=", -1)
    return F.lit(spec.name)


def bronze_projection(spec: SeriesSpec) -> list[Column]:
    """Raw fields renamed, plus series name, file lineage and ingestion time.

    ``current_timestamp`` is fixed per query (per micro-batch in a stream), so
    all records of one batch share one ingestion time; the file's
    modification time and path are kept to order records within a batch.
    """
    return [
        F.col("data").alias("data_raw"),
        F.col("valor").alias("valor_raw"),
        series_name_column(spec).alias("series_name"),
        F.col("_metadata.file_name").alias("source_file"),
        F.col("_metadata.file_path").alias("source_path"),
        F.col("_metadata.file_modification_time").alias("source_modified_at"),
        F.current_timestamp().alias("ingestion_timestamp"),
        F.current_date().alias("ingestion_date"),
    ]


def read_raw(spark: SparkSession, spec: SeriesSpec, path: str | None = None) -> DataFrame:
    """Batch read of a landing folder with the fixed raw schema.

    A file that is not valid JSON yields one all-null record (PERMISSIVE
    mode); the contract below counts it.
    """
    return (
        spark.read.format("json")
        .schema(RAW_SCHEMA)
        .option("multiLine", spec.multi_line)
        .option("mode", "PERMISSIVE")
        .load(landing_glob(spec, path))
        .select(bronze_projection(spec))
    )


def read_bronze(spark: SparkSession, spec: SeriesSpec) -> DataFrame:
    """Bronze with its fixed schema: no footer inference, and a series whose
    landing held no file reads as empty (and fails the not-empty rule).
    A catalog table supplies its own schema."""
    if is_path(spec.bronze):
        return spark.read.schema(BRONZE_SCHEMA).parquet(spec.bronze)
    return spark.table(spec.bronze).select(BRONZE_COLUMNS)


def read_bronze_stream(spark: SparkSession, spec: SeriesSpec) -> DataFrame:
    """Bronze as a stream of the records appended since the reader's checkpoint."""
    if is_path(spec.bronze):
        return spark.readStream.schema(BRONZE_SCHEMA).parquet(spec.bronze)
    return spark.readStream.table(spec.bronze).select(BRONZE_COLUMNS)


def raw_contract(records: DataFrame, data_col: str = "data_raw", value_col: str = "valor_raw") -> DataFrame:
    """Landed-record contract in one pass: payload not empty, both fields present.

    Under a fixed schema a missing field and a null one look alike; both
    count as violations. Returns one row.
    """
    missing_data = F.col(data_col).isNull()
    missing_value = F.col(value_col).isNull()
    total = F.count(F.lit(1))
    violations = F.count_if(missing_data | missing_value)
    return records.agg(
        total.alias("total_records"),
        F.count_if(missing_data).alias("missing_data"),
        F.count_if(missing_value).alias("missing_valor"),
        violations.alias("invalid_records"),
        ((total > 0) & (violations == 0)).alias("contract_ok"),
    )


COUNTS = ["records", "missing_data", "missing_valor", "bad_data", "bad_valor", "repeated_keys"]
CONTRACT_SCHEMA = "source_file string, source_path string, " + ", ".join(f"{c} long" for c in COUNTS) + ", contract_ok boolean"


def _same_path(column: str) -> Column:
    """A file's URI without scheme, whatever number of slashes the reader prints."""
    return F.regexp_replace(column, r"^\w+:/*", "/")


def landed_files(spark: SparkSession, spec: SeriesSpec) -> DataFrame:
    """(source_path) of every file in the landing, files of no bytes too; their contents aren't read.

    The driver lists them, as the ingest's file source does."""
    found = spark.read.schema(RAW_SCHEMA).json(landing_glob(spec)).inputFiles()
    return spark.createDataFrame([(x,) for x in found], "source_path string")


def judged_files(records: DataFrame) -> DataFrame:
    """Contract of every file that ``records`` (Bronze rows) come from, before any deduplication.

    A file fails if it holds a record without a readable date and rate; repeated
    keys are counted only. Columns as in CONTRACT_SCHEMA. Counts are combined by
    file and key, then by file, so a file of many records isn't one task's.
    """
    date, rate = parse_date("data_raw"), parse_rate("valor_raw")
    typed = records.select("source_path", "series_name", "data_raw", "valor_raw", date.alias("_date"), rate.alias("_rate"))
    by_key = typed.groupBy("source_path", "series_name", "_date").agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(F.col("data_raw").isNull()).alias("missing_data"),
        F.count_if(F.col("valor_raw").isNull()).alias("missing_valor"),
        F.count_if(F.col("data_raw").isNotNull() & F.col("_date").isNull()).alias("bad_data"),
        F.count_if(F.col("valor_raw").isNotNull() & F.col("_rate").isNull()).alias("bad_valor"),
    )
    by_file = by_key.groupBy("source_path").agg(
        F.sum("n").alias("records"),
        *(F.sum(c).alias(c) for c in COUNTS[1:-1]),
        F.sum(F.when(F.col("_date").isNotNull(), F.col("n") - 1).otherwise(0)).alias("repeated_keys"),
    )
    broken = sum((F.col(c) for c in COUNTS[1:-1]), F.lit(0))
    name = F.substring_index("source_path", "/", -1).alias("source_file")
    return by_file.select(name, "source_path", *COUNTS, (broken == 0).alias("contract_ok"))


def without_records(listed: DataFrame, judged: DataFrame) -> DataFrame:
    """Contract of the listed files that no record came from: they fail."""
    key = _same_path("source_path").alias("_key")
    rest = listed.select("source_path", key).join(judged.select(key), "_key", "left_anti")
    name = F.substring_index("source_path", "/", -1).alias("source_file")
    return rest.select(name, "source_path", *(F.lit(0).cast("long").alias(c) for c in COUNTS), F.lit(False).alias("contract_ok"))


def file_contract(spark: SparkSession, spec: SeriesSpec) -> DataFrame:
    """Contract of every landed file, from the landing itself (an audit: it reads all of it).

    The ingest judges new files only, from the records it appended
    (``streaming.contract``). Columns as in CONTRACT_SCHEMA; a file without records
    (``[]``, or of no bytes) fails.
    """
    judged = judged_files(read_raw(spark, spec))
    return judged.unionByName(without_records(landed_files(spark, spec), judged))


def series_range(df: DataFrame, date_col: str, first: str, last: str) -> DataFrame:
    """Inclusive date-range selection, ``first <= d < last + 1 day``.

    Written as two comparisons against folded constants so that it reaches
    the parquet scan as pushed filters, and so that a timestamp column keeps
    the whole last day.
    """
    c = F.col(date_col)
    lo = F.lit(first).cast("date")
    hi = F.date_add(F.lit(last).cast("date"), 1)
    return df.where((c >= lo) & (c < hi))
