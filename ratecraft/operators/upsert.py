"""Keyed upsert into a parquet table without a transactional table format.

``MERGE INTO`` is not available on plain parquet tables, so an upsert
rewrites only the partitions the source touches:

1. the target is partitioned by a value derived from the business key (for
   example the year of the date), so a key never changes partition and the
   touched partitions follow from the source alone. Their smallest and largest
   value become constants in the target's scan, and the list of touched values
   prunes what lies between at run time;
2. new content of those partitions = target rows whose key is not in the
   source (left anti join) + all source rows;
3. that content is written whole beside the target (``.<name>.pending-...``).
   A job that fails up to here leaves the target as it was;
4. a small commit note names the pending folder (written aside and renamed, so
   it is whole or absent); then each partition is swapped: the old folder is
   deleted and the new one renamed into its place. If the driver dies in
   between, the pending folder still holds every partition that wasn't swapped,
   and the next upsert of the target finishes the swap first (``recover``). An
   unpartitioned target is one such folder.

One writer at a time: a path target carries its writer's mark
(``.<name>.writer``, created only if absent) from the first read to the end of
the swap, and a second writer is refused. The mark of a writer that died is
taken over once it is LEASE_HOURS old, at once by the application that left it, or by
``take_over``; by rename, so that only one of several can.

A catalog table is replaced by ``insertInto`` from a staged copy (Spark
refuses to overwrite a table that the same job reads); should that fail, the
staged copy stays, and the error names it. Its writers aren't marked.

Matched keys update every column (with ``newer_by`` only if the source row isn't
older), unmatched keys are inserted, and nothing is deleted but keys that are
given as ``deleted``. Readers may see partitions change one after another at commit.
"""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Iterator, Sequence
from contextlib import ExitStack, contextmanager, nullcontext
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ratecraft.operators.quality import any_null, duplicate_keys
from ratecraft.session import (
    create_text,
    file_rows,
    forget_scratch,
    modified_at,
    move_path,
    names_below,
    path_exists,
    publish_text,
    read_text,
    remove_path,
    scans_by_rows,
    scratch_dir,
    session_conf,
    sub_folders,
)
from ratecraft.sources.tables import is_path, save_schema, try_read_table

#: A writer's mark of this age is left by a dead one; longer than any upsert takes.
LEASE_HOURS = 24.0
_HELD: set[str] = set()  # marks of this process


class TargetBusy(RuntimeError):
    """Another writer holds the target."""


OVERWRITE_MODE = "spark.sql.sources.partitionOverwriteMode"


@contextmanager
def staged(
    spark: SparkSession, df: DataFrame, label: str, keep_on_failure: bool = False, rows: int | None = None
) -> Iterator[DataFrame]:
    """``df`` written once to a fresh folder under the checkpoint root, read back.

    The folder is deleted when the block ends, so repeated runs do not
    accumulate staging output. Leave the block only after every job that
    reads the staged copy has committed. With ``keep_on_failure`` a failure in
    the block leaves the folder, and a note with its path on the error. ``rows``:
    how many ``df`` is computed from, if its scan's tasks are to be dealt by rows
    (see :func:`scans_by_rows`), as where they sort what they read.
    """
    path = scratch_dir(spark, label)
    with scans_by_rows(spark, rows) if rows is not None else nullcontext():
        df.write.options(**file_rows()).mode("overwrite").parquet(path)
    try:
        yield spark.read.schema(df.schema).parquet(path)
    except BaseException as e:
        if keep_on_failure:
            e.add_note(f"the content to write is kept in {path}")
            forget_scratch(path)
            raise
        remove_path(spark, path)
        raise
    remove_path(spark, path)


def _clustered(df: DataFrame, partition_by: Sequence[str]) -> DataFrame:
    """Rows clustered by partition: otherwise every task writes a file into every
    partition it holds. REBALANCE lets AQE split a skewed partition and merge small ones."""
    return df.hint("rebalance", *partition_by) if partition_by else df


def _write_path(df: DataFrame, path: str, partition_by: Sequence[str]) -> None:
    writer = _clustered(df, partition_by).write
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)


def _beside(target: str, suffix: str) -> str:
    parent, _, name = target.rstrip("/").rpartition("/")
    return f"{parent}/.{name}.{suffix}"


def _commit_file(target: str) -> str:
    return _beside(target, "commit")


def _pending(target: str) -> str:
    return _beside(target, f"pending-{uuid.uuid4().hex[:12]}")


def writer_mark(target: str) -> str:
    return _beside(target, "writer")


def take_over(spark: SparkSession, target: str) -> bool:
    """Remove the mark of a writer that is known to be dead; True if there was one and nobody else removed it."""
    aside = f"{writer_mark(target)}.{uuid.uuid4().hex[:12]}"
    if not path_exists(spark, writer_mark(target)):
        return False
    try:
        move_path(spark, writer_mark(target), aside)
    except Exception:  # another process was faster
        return False
    remove_path(spark, aside)
    return True


def _left_behind(spark: SparkSession, mark: str) -> bool:
    """Whether a mark is older than the lease, or of this application but not held by it."""
    text, at = read_text(spark, mark), modified_at(spark, mark)
    if text is None or at is None or time.time() - at > LEASE_HOURS * 3600:
        return True
    application, _, writer = text.partition(" ")
    return application == spark.sparkContext.applicationId and bool(writer) and writer not in _HELD


@contextmanager
def exclusive(spark: SparkSession, target: str) -> Iterator[None]:
    """Hold the target's writer mark for the block; TargetBusy if another writer does."""
    writer, mark = uuid.uuid4().hex, writer_mark(target)
    text = f"{spark.sparkContext.applicationId} {writer}"
    _HELD.add(writer)
    try:
        if not create_text(spark, mark, text):
            if not _left_behind(spark, mark):
                raise TargetBusy(f"{target} is being written by {read_text(spark, mark)!r}; see take_over()")
            take_over(spark, target)
            if not create_text(spark, mark, text):
                raise TargetBusy(f"{target} has just been taken by another writer")
        try:
            yield
        finally:
            if read_text(spark, mark) == text:
                remove_path(spark, mark)
    finally:
        _HELD.discard(writer)


def _swap(spark: SparkSession, pending: str, target: str, depth: int) -> None:
    """Move each pending partition folder into the target; may be run again at any point."""
    if not path_exists(spark, pending):
        return
    if depth == 0:
        remove_path(spark, target)
        move_path(spark, pending, target)
        return
    for name in sub_folders(spark, pending):
        _swap(spark, f"{pending}/{name}", f"{target}/{name}", depth - 1)


def _finish(spark: SparkSession, target: str) -> bool:
    """Finish a noted commit and delete what dead writers left; the caller holds the mark."""
    note, parent = read_text(spark, _commit_file(target)), target.rstrip("/").rpartition("/")[0]
    prefix = _beside(target, "pending-")
    try:
        commit = None if note is None else json.loads(note)
        pending = commit and commit["pending"]
    except (ValueError, KeyError, TypeError):
        commit = None  # cut short when it was written: no partition has been swapped yet
    if commit:
        if not pending.startswith(prefix):
            raise ValueError(f"{_commit_file(target)} names {pending!r}, no folder of {target}")
        _swap(spark, pending, target, int(commit["depth"]))
        for folder in commit.get("emptied", ()):
            remove_path(spark, f"{target}/{folder}")
    if note is not None:
        remove_path(spark, _commit_file(target))
    hidden = prefix.rpartition("/")[2]
    for name in names_below(spark, parent):
        if name.startswith(hidden):
            remove_path(spark, f"{parent}/{name}")
    return bool(commit)


def recover(spark: SparkSession, target: str) -> bool:
    """Finish a commit that a dead driver left half done; True if there was one."""
    if not path_exists(spark, _commit_file(target)):
        return False
    with exclusive(spark, target):
        return _finish(spark, target)


def _emptied(current: DataFrame, content: DataFrame, deleted: DataFrame, partition_by: Sequence[str]) -> list[str]:
    """Folders, below the target, of partitions that lost all their rows to ``deleted``."""
    by = list(partition_by)
    gone = deleted.select(*by).distinct().join(content.select(*by).distinct(), by, "left_anti")
    folder = F.regexp_extract(F.col("_metadata.file_path"), rf"/({by[0]}=.*)/[^/]*$", 1)
    rows = current.select(*by, folder.alias("_folder")).join(gone, by, "left_semi").select("_folder").distinct()
    return [unquote(r[0]) for r in rows.collect()]  # one row a partition


def _replace_path(
    spark: SparkSession,
    df: DataFrame,
    target: str,
    partition_by: Sequence[str],
    current: DataFrame | None = None,
    deleted: DataFrame | None = None,
) -> None:
    """Write ``df`` beside the target, then swap its partitions in (all of an unpartitioned target)."""
    pending, emptied = _pending(target), []
    try:
        _write_path(df, pending, partition_by)
        if not partition_by:
            save_schema(spark, pending, df.schema)
        elif deleted is not None:
            emptied = _emptied(current, spark.read.schema(df.schema).parquet(pending), deleted, partition_by)
    except BaseException:
        remove_path(spark, pending)
        raise
    publish_text(spark, _commit_file(target), json.dumps({"depth": len(partition_by), "pending": pending, "emptied": emptied}))
    _finish(spark, target)


def _touched(target: DataFrame, touching: DataFrame, partition_by: Sequence[str]) -> DataFrame:
    """The target's rows in the partitions that ``touching`` (cheap to scan) has rows for."""
    if not partition_by:
        return target
    # constants, two values a column: the scan lists only partitions between them, and as
    # a filter on the list they make Spark prune the others when the list is known
    bounds = touching.agg(*(f(c).alias(f"{f.__name__}_{c}") for c in partition_by for f in (F.min, F.max))).first()
    between = F.lit(True)
    for c in partition_by:
        low, high = bounds[f"min_{c}"], bounds[f"max_{c}"]
        if low is not None:
            between &= F.col(c).between(F.lit(low), F.lit(high))
    touched = touching.select(*partition_by).where(between).distinct()
    return target.where(between).join(touched, list(partition_by), "left_semi")


def not_older(
    target: DataFrame, source: DataFrame, keys: Sequence[str], newer_by: Sequence[str], partition_by: Sequence[str] = ()
) -> DataFrame:
    """Source rows whose key is new to the target, or whose ``newer_by`` values aren't below the target row's (nulls lowest)."""
    age = F.struct(*newer_by)
    known = _touched(target, source, partition_by).select(*keys, age.alias("_known"))
    fresh = source.join(known, list(keys), "left").where(F.col("_known").isNull() | (age >= F.col("_known")))
    return fresh.select(source.columns)


def merged_content(
    target: DataFrame,
    source: DataFrame,
    keys: Sequence[str],
    partition_by: Sequence[str] = (),
    deleted: DataFrame | None = None,
) -> DataFrame:
    """Rows of the touched partitions after the upsert, in the target's column order.

    ``source`` should be staged: it is scanned for the bounds of the touched
    partitions, their list, the keys and the rows. Joins on a column list put
    those columns first, so the target's order is restored at the end: written
    files must keep one layout, and ``insertInto`` matches columns by position.
    ``deleted`` holds keys, with their partition values, that go unless the
    source has them.
    """
    keys = list(keys)
    columns = target.columns
    source = source.select(columns)
    touching = [*keys, *(c for c in partition_by if c not in keys)]
    gone = source.select(*touching)
    if deleted is not None:
        gone = gone.unionByName(deleted.select(*touching))
    target = _touched(target, gone, partition_by)
    kept = target.join(gone.select(*keys), keys, "left_anti")
    return kept.select(columns).unionByName(source)


def upsert(
    spark: SparkSession,
    source: DataFrame,
    target: str,
    keys: Sequence[str],
    partition_by: Sequence[str] = (),
    check_unique: bool = True,
    source_staged: bool = False,
    newer_by: Sequence[str] = (),
    deleted: DataFrame | None = None,
) -> str:
    """Upsert ``source`` into ``target`` by ``keys``; returns ``created`` or ``merged``.

    A source with a repeated key is rejected (a MERGE would fail on it too;
    anti join + union would keep both rows), and so is one with a null partition
    value: all such rows share one folder, which a key's next value wouldn't touch.
    An empty source creates an empty, readable table, or changes nothing but
    ``deleted``. ``source_staged`` says that the source is cheap to scan several
    times; otherwise it is staged first. ``newer_by``: columns by which a matched
    row is updated only if the source's values aren't below the target's, so that
    sources may come in any order. ``deleted`` (staged too): keys to delete, with
    their partition values; a key that the source has stays.
    """
    with ExitStack() as stack:
        if not source_staged:
            source = stack.enter_context(staged(spark, source, "source"))
        if partition_by and not source.where(any_null(partition_by)).isEmpty():
            raise ValueError(f"upsert source has null partition values {list(partition_by)}")
        if check_unique and not duplicate_keys(source, keys).isEmpty():
            raise ValueError(f"upsert source has duplicate keys {list(keys)}")
        if is_path(target):
            stack.enter_context(exclusive(spark, target))
            _finish(spark, target)
        elif deleted is not None:
            raise ValueError("keys can be deleted from path tables only")
        current = try_read_table(spark, target)
        if current is None:
            if not is_path(target):
                writer = _clustered(source, partition_by).write.mode("errorifexists").format("parquet")
                (writer.partitionBy(*partition_by) if partition_by else writer).saveAsTable(target)
                return "created"
            data = [c for c in source.columns if c not in partition_by]
            save_schema(spark, target, source.select(*data, *partition_by).schema)
            _replace_path(spark, source, target, partition_by)
            return "created"
        if newer_by and not source.isEmpty():
            source = stack.enter_context(staged(spark, not_older(current, source, keys, newer_by, partition_by), "fresh"))
        if source.isEmpty() and (deleted is None or deleted.isEmpty()):
            return "merged"
        merged = merged_content(current, source, keys, partition_by, deleted)
        if is_path(target):
            _replace_path(spark, merged, target, partition_by, current, deleted)
            return "merged"
        # a catalog table may not be overwritten by a job that reads it
        with staged(spark, merged, "upsert", keep_on_failure=True) as content:
            content = _clustered(content, partition_by)
            # only the session setting makes insertInto replace just the touched partitions
            mode = "dynamic" if partition_by else "static"
            with session_conf(spark, OVERWRITE_MODE, mode):
                content.write.insertInto(target, overwrite=True)
        return "merged"


def stamp(df: DataFrame, column: str) -> DataFrame:
    """Add a load timestamp (kept out of content comparisons)."""
    return df.withColumn(column, F.current_timestamp())
