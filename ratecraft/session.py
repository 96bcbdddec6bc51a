"""Session defaults and the shared scratch folder.

Scratch output (upsert staging, stream landings built by the registered
queries) goes under the folder the cluster names in ``spark.checkpoint.dir``.
A session in one local process that has no such setting gets a temporary
folder; any other session without it is refused. Scratch folders are deleted
when the Python process ends.
"""

from __future__ import annotations

import atexit
import math
import re
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession

_CREATED: set[str] = set()  # scratch folders of this process
#: Rows of a file that a layer job writes, and (about) of a task that sorts what it reads.
ROWS_A_TASK = 500_000
SCAN_TASKS = "spark.sql.files.minPartitionNum"


def build_session(
    master: str | None = "local[8]",
    app_name: str = "ratecraft",
    shuffle_partitions: int | None = None,
    extra: dict[str, str] | None = None,
) -> SparkSession:
    """A session with AQE on and the UI off.

    On a cluster, pass ``master=None``. ``shuffle_partitions`` is set only if
    given; size it to the data (AQE coalesces small partitions and splits
    skewed ones at runtime).
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = {
        "spark.ui.enabled": "false",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        # No Python call-site capture around every DataFrame/Column call: it
        # costs five JVM round trips per call while building a plan and only
        # adds the Python line to error messages.
        "spark.python.sql.dataFrameDebugging.enabled": "false",
    }
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for key, value in conf.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


@contextmanager
def session_conf(spark: SparkSession, key: str, value: str) -> Iterator[None]:
    """A session setting for the jobs of a block."""
    previous = spark.conf.get(key, None)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        if previous is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, previous)


def row_tasks(rows: int) -> int:
    """Tasks for so many rows, ROWS_A_TASK each."""
    return max(1, math.ceil(rows / ROWS_A_TASK))


def file_rows() -> dict[str, int]:
    """Writer options of files that hold ROWS_A_TASK rows at most: what one task reads later isn't less than a file."""
    return {"maxRecordsPerFile": ROWS_A_TASK}


@contextmanager
def scans_by_rows(spark: SparkSession, rows: int) -> Iterator[None]:
    """The jobs of the block scan ``rows`` rows in tasks of about ROWS_A_TASK, if no file holds more.

    Spark deals files to scan tasks by their bytes and the cluster's cores. Bronze
    compresses to a few bytes a record (one path, one time a file), so by bytes a
    task's records, and the memory in which it sorts them, would grow with the table.
    """
    least = int(spark.conf.get(SCAN_TASKS, None) or spark.sparkContext.defaultParallelism)
    with session_conf(spark, SCAN_TASKS, str(max(least, row_tasks(rows)))):
        yield


def checkpoint_root(spark: SparkSession) -> str:
    """The shared checkpoint folder of the session.

    Reads ``spark.checkpoint.dir`` (or a directory already set on the
    context). Only a session whose executor is the driver's own process
    (master ``local`` or ``local[n]``) gets a temporary folder without one;
    elsewhere that is an error, since a machine-local folder is not visible
    to other executors.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current.rstrip("/")
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        if not re.fullmatch(r"local(\[[^\]]*\])?", sc.master):
            raise ValueError(
                "spark.checkpoint.dir is not set; scratch output needs a shared folder"
            )
        configured = tempfile.mkdtemp(prefix="ratecraft-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir().rstrip("/")


def scratch_dir(spark: SparkSession, label: str) -> str:
    """A fresh, unique folder below the checkpoint root, deleted when the process ends."""
    path = f"{checkpoint_root(spark)}/ratecraft/{label}-{uuid.uuid4().hex[:12]}"
    if not _CREATED:
        atexit.register(_remove_scratch, spark)
    _CREATED.add(path)
    return path


def forget_scratch(path: str) -> None:
    """Leave a scratch folder in place when the process ends."""
    _CREATED.discard(path)


def _remove_scratch(spark: SparkSession) -> None:
    for path in sorted(_CREATED):
        try:
            remove_path(spark, path)
        except Exception:  # the JVM is gone already: nothing can be deleted any more
            return
    _CREATED.clear()


def _file_system(spark: SparkSession, path: str):
    """(file system, path) through which the session reads and writes ``path``."""
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), target


def remove_path(spark: SparkSession, path: str) -> None:
    """Delete a folder through the Hadoop file system the session writes with."""
    fs, target = _file_system(spark, path)
    fs.delete(target, True)


def ensure_dir(spark: SparkSession, path: str) -> None:
    """Create a folder (and its parents) through the session's Hadoop file system."""
    fs, target = _file_system(spark, path)
    fs.mkdirs(target)


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, target = _file_system(spark, path)
    return fs.exists(target)


def move_path(spark: SparkSession, source: str, target: str) -> None:
    """Rename a folder; raises if the file system refuses."""
    fs, s = _file_system(spark, source)
    _, t = _file_system(spark, target)
    fs.mkdirs(t.getParent())
    if not fs.rename(s, t):
        raise OSError(f"cannot rename {source} to {target}")


def sub_folders(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders directly below a path that aren't hidden."""
    fs, target = _file_system(spark, path)
    found = [f.getPath().getName() for f in fs.listStatus(target) if f.isDirectory()]
    return sorted(n for n in found if not n.startswith(("_", ".")))


def names_below(spark: SparkSession, path: str) -> list[str]:
    """Names of everything directly below a folder, hidden names too; none if it isn't there."""
    fs, target = _file_system(spark, path)
    return sorted(f.getPath().getName() for f in fs.listStatus(target)) if fs.exists(target) else []


def _put(out, text: str) -> None:
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """Write a small file whole (overwritten if it exists)."""
    fs, target = _file_system(spark, path)
    _put(fs.create(target, True), text)


def publish_text(spark: SparkSession, path: str, text: str) -> None:
    """Write a small file that isn't there yet under another name, then rename it: readers see all of it or none."""
    aside = f"{path}.{uuid.uuid4().hex[:12]}.tmp"
    write_text(spark, aside, text)
    try:
        move_path(spark, aside, path)
    except BaseException:
        remove_path(spark, aside)
        raise


def create_text(spark: SparkSession, path: str, text: str) -> bool:
    """Create a small file; False, with nothing done, if there is one."""
    fs, target = _file_system(spark, path)
    try:
        out = fs.create(target, False)
    except Py4JJavaError as e:
        if "FileAlreadyExists" in e.java_exception.getClass().getName() or fs.exists(target):
            return False
        raise
    _put(out, text)
    return True


def modified_at(spark: SparkSession, path: str) -> float | None:
    """Modification time of a file in seconds, None if there is none."""
    fs, target = _file_system(spark, path)
    return fs.getFileStatus(target).getModificationTime() / 1000 if fs.exists(target) else None


def read_text(spark: SparkSession, path: str) -> str | None:
    """Contents of a small file, None if there is none."""
    fs, target = _file_system(spark, path)
    if not fs.exists(target):
        return None
    stream = fs.open(target)
    try:
        return bytes(spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toByteArray(stream)).decode()
    finally:
        stream.close()
