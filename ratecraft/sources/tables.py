"""Layer tables: a reference is either a storage path or a catalog table name.

A table at a path keeps its schema in a small file beside its data. Reading
needs no footer inference then, a table without rows reads as empty, and
partition values keep their types (a series named ``011`` stays text).
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from ratecraft.session import read_text, write_text

SCHEMA_FILE = "_schema.json"
#: Spark's conditions for "there is no table here": no such path, or no data file in it.
ABSENT = frozenset({"PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"})


def is_path(ref: str) -> bool:
    return "/" in ref or ":" in ref


def save_schema(spark: SparkSession, ref: str, schema: StructType) -> None:
    """Store the schema of a path table (readers ignore names that begin with ``_``)."""
    write_text(spark, f"{ref}/{SCHEMA_FILE}", schema.json())


def stored_schema(spark: SparkSession, ref: str) -> StructType | None:
    text = read_text(spark, f"{ref}/{SCHEMA_FILE}")
    return None if text is None else StructType.fromJson(_loads(text))


def _loads(text: str) -> dict:
    import json

    return json.loads(text)


def read_table(spark: SparkSession, ref: str) -> DataFrame:
    """Scan a layer; paths are read as parquet datasets, names from the catalog."""
    if not is_path(ref):
        return spark.table(ref)
    schema = stored_schema(spark, ref)
    return spark.read.schema(schema).parquet(ref) if schema else spark.read.parquet(ref)


def try_read_table(spark: SparkSession, ref: str) -> DataFrame | None:
    """The table, or None when there is none (a missing path, or a folder without
    data files and stored schema). Any other failure is raised: it must not
    pass for an absent table, which a writer would create anew."""
    if not is_path(ref):
        return spark.table(ref) if spark.catalog.tableExists(ref) else None
    try:
        return read_table(spark, ref)
    except AnalysisException as e:
        if e.getCondition() in ABSENT:
            return None
        raise


def table_exists(spark: SparkSession, ref: str) -> bool:
    """True when the table exists and has a schema."""
    return try_read_table(spark, ref) is not None


def read_driver_table(spark: SparkSession, base_dir: str, name: str) -> DataFrame:
    """One of the parquet tables of a test-data folder (``<dir>/<name>.parquet``)."""
    return spark.read.parquet(f"{base_dir.rstrip('/')}/{name}.parquet")
