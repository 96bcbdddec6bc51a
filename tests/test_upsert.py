import importlib
import os
import random
import time
from concurrent.futures import ThreadPoolExecutor
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from ratecraft.operators import (
    TargetBusy,
    content_fingerprint,
    exclusive,
    merged_content,
    recover,
    staged,
    take_over,
    upsert,
    writer_mark,
)
from ratecraft.sources import read_table, try_read_table

SCHEMA = "k int, v double, part int"


def test_create_then_merge_updates_and_inserts(spark, tmp_path):
    target = str(tmp_path / "t")
    first = spark.createDataFrame([(1, 1.0, 2020), (2, 2.0, 2020), (3, 3.0, 2021)], SCHEMA)
    assert upsert(spark, first, target, ["k"], partition_by=("part",)) == "created"
    change = spark.createDataFrame([(2, 20.0, 2020), (4, 4.0, 2022)], SCHEMA)
    assert upsert(spark, change, target, ["k"], partition_by=("part",)) == "merged"
    got = sorted((r.k, r.v, r.part) for r in read_table(spark, target).collect())
    assert got == [(1, 1.0, 2020), (2, 20.0, 2020), (3, 3.0, 2021), (4, 4.0, 2022)]


def test_rerun_is_idempotent(spark, tmp_path):
    target = str(tmp_path / "t")
    rows = [(k, float(k), 2000 + k % 5) for k in range(200)]
    upsert(spark, spark.createDataFrame(rows, SCHEMA), target, ["k"], partition_by=("part",))
    change = spark.createDataFrame([(k, -float(k), 2000 + k % 5) for k in range(150, 260)], SCHEMA)
    upsert(spark, change, target, ["k"], partition_by=("part",))
    once = content_fingerprint(read_table(spark, target)).first()
    upsert(spark, change, target, ["k"], partition_by=("part",))
    assert content_fingerprint(read_table(spark, target)).first() == once
    assert once.rows == 260


def test_untouched_partitions_are_not_rewritten(spark, tmp_path):
    target = tmp_path / "t"
    rows = [(1, 1.0, 2020), (2, 2.0, 2021)]
    upsert(spark, spark.createDataFrame(rows, SCHEMA), str(target), ["k"], partition_by=("part",))
    before = {p.name: sorted(f.name for f in p.iterdir()) for p in target.glob("part=*")}
    upsert(spark, spark.createDataFrame([(2, 5.0, 2021)], SCHEMA), str(target), ["k"], partition_by=("part",))
    after = {p.name: sorted(f.name for f in p.iterdir()) for p in target.glob("part=*")}
    assert after["part=2020"] == before["part=2020"]
    assert after["part=2021"] != before["part=2021"]


def test_unpartitioned_target(spark, tmp_path):
    target = str(tmp_path / "t")
    upsert(spark, spark.createDataFrame([(1, 1.0, 0), (2, 2.0, 0)], SCHEMA), target, ["k"])
    upsert(spark, spark.createDataFrame([(2, 3.0, 0), (5, 5.0, 0)], SCHEMA), target, ["k"])
    got = sorted((r.k, r.v) for r in read_table(spark, target).collect())
    assert got == [(1, 1.0), (2, 3.0), (5, 5.0)]


def test_duplicate_source_key_is_rejected(spark, tmp_path):
    target = str(tmp_path / "t")
    dup = spark.createDataFrame([(1, 1.0, 2020), (1, 2.0, 2020)], SCHEMA)
    with pytest.raises(ValueError, match="duplicate"):
        upsert(spark, dup, target, ["k"], partition_by=("part",))


def test_rows_leaving_the_source_stay(spark, tmp_path):
    target = str(tmp_path / "t")
    upsert(spark, spark.createDataFrame([(1, 1.0, 2020), (2, 2.0, 2020)], SCHEMA), target, ["k"], ("part",))
    upsert(spark, spark.createDataFrame([(2, 9.0, 2020)], SCHEMA), target, ["k"], ("part",))
    assert read_table(spark, target).where(F.col("k") == 1).count() == 1


def test_merge_keeps_the_target_column_order(spark, tmp_path):
    # the key is not the leading column: a join on it must not reorder the written files
    target = str(tmp_path / "t")
    first = spark.createDataFrame([(1.0, "a", 2020), (2.0, "b", 2021)], "v double, k string, part int")
    upsert(spark, first, target, ["k"], partition_by=("part",))
    change = spark.createDataFrame([(3.0, "a", 2020)], "v double, k string, part int")
    upsert(spark, change, target, ["k"], partition_by=("part",))
    for folder in ("part=2020", "part=2021"):
        assert spark.read.parquet(f"{target}/{folder}").columns == ["v", "k"]


def test_catalog_table_target_upserts_only_touched_partitions(spark):
    name = "upsert_catalog_target"
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    first = spark.createDataFrame([(1.0, "a", 2020), (2.0, "b", 2021)], "v double, k string, part int")
    assert upsert(spark, first, name, ["k"], partition_by=("part",)) == "created"
    change = spark.createDataFrame([(3.0, "a", 2020), (4.0, "c", 2020)], "v double, k string, part int")
    assert upsert(spark, change, name, ["k"], partition_by=("part",)) == "merged"
    got = sorted((r.k, r.v, r.part) for r in spark.table(name).collect())
    assert got == [("a", 3.0, 2020), ("b", 2.0, 2021), ("c", 4.0, 2020)]
    spark.sql(f"DROP TABLE {name}")


def test_partitioned_write_makes_one_file_per_partition(spark, tmp_path):
    import glob

    target = str(tmp_path / "t")
    rows = [(i, float(i), 2000 + i % 5) for i in range(2000)]
    first = spark.createDataFrame(rows, SCHEMA).repartition(8)
    upsert(spark, first, target, ["k"], partition_by=("part",))
    change = spark.createDataFrame([(i, -1.0, 2000 + i % 5) for i in range(0, 2000, 7)], SCHEMA).repartition(8)
    upsert(spark, change, target, ["k"], partition_by=("part",))
    for year in range(2000, 2005):
        assert len(glob.glob(f"{target}/part={year}/*.parquet")) == 1
    assert read_table(spark, target).count() == 2000


@pytest.mark.parametrize("parts", [(), ("part",)])
def test_a_failed_write_leaves_the_target(spark, tmp_path, parts):
    target = str(tmp_path / "t")
    rows = [(k, float(k), 2000 + k % 3) for k in range(100)]
    upsert(spark, spark.createDataFrame(rows, SCHEMA), target, ["k"], parts)
    before = content_fingerprint(read_table(spark, target)).first()
    spark.conf.set("spark.sql.parquet.compression.codec", "brotli")
    try:
        with pytest.raises(Exception):
            upsert(spark, spark.createDataFrame([(1, 9.0, 2001)], SCHEMA), target, ["k"], parts, source_staged=True)
    finally:
        spark.conf.unset("spark.sql.parquet.compression.codec")
    assert content_fingerprint(read_table(spark, target)).first() == before
    assert [p.name for p in tmp_path.iterdir()] == ["t"]  # nothing half-written stays behind


@pytest.mark.parametrize("parts", [(), ("part",)])
@pytest.mark.parametrize("dies_at", [0, 1, 2])
def test_a_commit_cut_short_is_finished_by_the_next_upsert(spark, tmp_path, monkeypatch, parts, dies_at):
    module = importlib.import_module("ratecraft.operators.upsert")
    target = str(tmp_path / "t")
    rows = [(k, float(k), 2000 + k % 3) for k in range(30)]
    upsert(spark, spark.createDataFrame(rows, SCHEMA), target, ["k"], parts)
    calls, real = [], module.move_path

    def dying(*args):  # the driver dies just before the n-th rename, its old folder gone already
        calls.append(args)
        if len(calls) > dies_at:
            raise KeyboardInterrupt
        real(*args)

    change = [(k, -1.0, 2000 + k % 3) for k in range(3)]
    monkeypatch.setattr(module, "move_path", dying)
    if parts or not dies_at:
        with pytest.raises(KeyboardInterrupt):
            upsert(spark, spark.createDataFrame(change, SCHEMA), target, ["k"], parts)
        monkeypatch.setattr(module, "move_path", real)
        assert recover(spark, target) and not recover(spark, target)
        got = {r.k: r.v for r in read_table(spark, target).collect()}
        assert got == {k: -1.0 if k < 3 else float(k) for k in range(30)}


def test_only_a_missing_table_counts_as_absent(spark, tmp_path):
    assert try_read_table(spark, str(tmp_path / "none")) is None
    (tmp_path / "bad").mkdir()
    (tmp_path / "bad" / "part-0.parquet").write_text("no parquet at all")
    with pytest.raises(Exception):
        upsert(spark, spark.createDataFrame([(1, 1.0, 1)], SCHEMA), str(tmp_path / "bad"), ["k"])
    assert (tmp_path / "bad" / "part-0.parquet").read_text() == "no parquet at all"


@pytest.mark.parametrize("parts", [(), ("part",)])
def test_an_empty_first_load_reads_as_empty(spark, tmp_path, parts):
    target = str(tmp_path / "t")
    empty = spark.createDataFrame([], SCHEMA)
    assert upsert(spark, empty, target, ["k"], parts) == "created"
    assert read_table(spark, target).count() == 0
    assert upsert(spark, empty, target, ["k"], parts) == "merged"
    upsert(spark, spark.createDataFrame([(1, 1.0, 7)], SCHEMA), target, ["k"], parts)
    assert [tuple(r) for r in read_table(spark, target).select("k", "v", "part").collect()] == [(1, 1.0, 7)]


def test_partition_values_keep_their_types(spark, tmp_path):
    target = str(tmp_path / "t")
    upsert(spark, spark.createDataFrame([(1, "011")], "k int, series string"), target, ["k"], ("series",))
    assert [tuple(r) for r in read_table(spark, target).collect()] == [(1, "011")]


def test_a_staged_source_prunes_the_target(spark, tmp_path):
    target = str(tmp_path / "t")
    rows = [(k, 0.0, 2000 + k % 10) for k in range(100)]
    upsert(spark, spark.createDataFrame(rows, SCHEMA), target, ["k"], ("part",))
    with staged(spark, spark.createDataFrame([(3, 1.0, 2003), (5, 1.0, 2005)], SCHEMA), "test") as source:
        merged = merged_content(read_table(spark, target), source, ["k"], ("part",))
        plan = merged._jdf.queryExecution().explainString(
            spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
        )
        filters = next(x for x in plan.split("\n") if "PartitionFilters" in x and "dynamicpruning" in x)
        assert "2003" in filters and "2005" in filters
        assert merged.count() == 20


# -- one writer, whole notes, refused sources ---------------------------------


def _rows(spark, target):
    return sorted((r.k, r.v, r.part) for r in read_table(spark, target).collect())


def _mark(target, text, age_hours=0.0):
    mark = Path(writer_mark(target))
    mark.parent.mkdir(parents=True, exist_ok=True)
    mark.write_text(text)
    crc = mark.with_name(f".{mark.name}.crc")
    if crc.exists():
        crc.unlink()
    at = time.time() - age_hours * 3600
    os.utime(mark, (at, at))


def test_a_second_writer_is_refused_and_leaves_nothing(spark, tmp_path):
    target = str(tmp_path / "t")
    upsert(spark, spark.createDataFrame([(1, 1.0, 2020)], SCHEMA), target, ["k"], ("part",))
    with exclusive(spark, target):
        with pytest.raises(TargetBusy):
            upsert(spark, spark.createDataFrame([(1, 2.0, 2020)], SCHEMA), target, ["k"], ("part",))
        assert Path(writer_mark(target)).exists()  # the first writer's mark stays
    _mark(target, "another-application writer")
    with pytest.raises(TargetBusy, match="another-application"):
        upsert(spark, spark.createDataFrame([(1, 2.0, 2020)], SCHEMA), target, ["k"], ("part",))
    assert _rows(spark, target) == [(1, 1.0, 2020)]
    assert take_over(spark, target) and not take_over(spark, target)
    upsert(spark, spark.createDataFrame([(1, 2.0, 2020)], SCHEMA), target, ["k"], ("part",))
    assert _rows(spark, target) == [(1, 2.0, 2020)]
    assert [p.name for p in tmp_path.iterdir()] == ["t"]


@pytest.mark.parametrize(("text", "age"), [("another-application writer", 25.0), ("{own} dead-writer", 0.0)])
def test_the_mark_of_a_dead_writer_is_taken_over(spark, tmp_path, text, age):
    target = str(tmp_path / "t")
    _mark(target, text.format(own=spark.sparkContext.applicationId), age)
    upsert(spark, spark.createDataFrame([(1, 1.0, 2020)], SCHEMA), target, ["k"], ("part",))
    assert _rows(spark, target) == [(1, 1.0, 2020)]
    assert [p.name for p in tmp_path.iterdir()] == ["t"]


def test_of_two_writers_at_once_one_wins_whole(spark, tmp_path):
    target = str(tmp_path / "t")
    upsert(spark, spark.createDataFrame([(k, 0.0, 2020) for k in range(50)], SCHEMA), target, ["k"], ("part",))

    def write(v):
        try:
            upsert(spark, spark.createDataFrame([(k, v, 2020) for k in range(50)], SCHEMA), target, ["k"], ("part",))
            return v
        except TargetBusy:
            return None

    with ThreadPoolExecutor(4) as pool:
        done = {v for v in pool.map(write, [1.0, 2.0, 3.0, 4.0]) if v}
    assert done and len({v for _, v, _ in _rows(spark, target)}) == 1
    assert {v for _, v, _ in _rows(spark, target)} <= done


@pytest.mark.parametrize("note", ["", "1 /tmp/elsewhere", '{"depth": 1, "pen', "[]", "null"])
def test_a_note_cut_short_is_no_commit(spark, tmp_path, note):
    target, keep = str(tmp_path / "t"), tmp_path / "elsewhere"
    keep.mkdir()
    upsert(spark, spark.createDataFrame([(1, 1.0, 2020)], SCHEMA), target, ["k"], ("part",))
    orphan = tmp_path / ".t.pending-0123456789ab" / "part=2020"
    orphan.mkdir(parents=True)
    (tmp_path / ".t.commit").write_text(note)
    upsert(spark, spark.createDataFrame([(2, 2.0, 2021)], SCHEMA), target, ["k"], ("part",))
    assert _rows(spark, target) == [(1, 1.0, 2020), (2, 2.0, 2021)]
    assert sorted(p.name for p in tmp_path.iterdir()) == ["elsewhere", "t"]  # the orphan is gone, nothing else


def test_a_note_that_names_another_folder_is_refused(spark, tmp_path):
    target, other = str(tmp_path / "t"), tmp_path / "other"
    other.mkdir()
    upsert(spark, spark.createDataFrame([(1, 1.0, 2020)], SCHEMA), target, ["k"], ("part",))
    (tmp_path / ".t.commit").write_text(f'{{"depth": 0, "pending": "{other}"}}')
    with pytest.raises(ValueError, match="no folder of"):
        recover(spark, target)
    assert other.exists() and _rows(spark, target) == [(1, 1.0, 2020)]


def test_the_note_is_whole_or_absent(spark, tmp_path, monkeypatch):
    session = importlib.import_module("ratecraft.session")
    target = str(tmp_path / "t")
    upsert(spark, spark.createDataFrame([(1, 1.0, 2020)], SCHEMA), target, ["k"], ("part",))

    def dying(out, text):  # the driver dies between creating and closing the note
        out.close()
        raise KeyboardInterrupt

    real = session._put
    monkeypatch.setattr(session, "_put", lambda out, text: dying(out, text) if text.startswith("{") else real(out, text))
    with pytest.raises(KeyboardInterrupt):
        upsert(spark, spark.createDataFrame([(1, 2.0, 2020)], SCHEMA), target, ["k"], ("part",))
    monkeypatch.setattr(session, "_put", real)
    assert not (tmp_path / ".t.commit").exists() and not recover(spark, target)
    upsert(spark, spark.createDataFrame([(1, 3.0, 2020)], SCHEMA), target, ["k"], ("part",))
    assert _rows(spark, target) == [(1, 3.0, 2020)]


@pytest.mark.parametrize("exists", [False, True])
def test_null_partition_values_are_refused(spark, tmp_path, exists):
    target = str(tmp_path / "t")
    if exists:
        upsert(spark, spark.createDataFrame([(1, 1.0, 2020)], SCHEMA), target, ["k"], ("part",))
    with pytest.raises(ValueError, match="null partition"):
        upsert(spark, spark.createDataFrame([(2, 2.0, None)], SCHEMA), target, ["k"], ("part",))
    assert (try_read_table(spark, target) is not None) == exists


def test_sources_in_any_order_leave_the_newest(spark, tmp_path):
    rng = random.Random(4)
    batches = [[(k, float(v), 2020 + k % 2) for k in rng.sample(range(20), 12) for v in [rng.randrange(100)]] for _ in range(5)]
    results = set()
    for turn in range(3):
        target = str(tmp_path / f"t{turn}")
        for rows in rng.sample(batches, 5):
            upsert(spark, spark.createDataFrame(rows, SCHEMA), target, ["k"], ("part",), newer_by=["v"])
        results.add(tuple(_rows(spark, target)))
    best = {}
    for k, v, part in (r for rows in batches for r in rows):
        best[k] = max(best.get(k, (v, part)), (v, part))
    assert results == {tuple(sorted((k, v, part) for k, (v, part) in best.items()))}


def test_deleted_keys_go_and_empty_their_partitions(spark, tmp_path):
    target = str(tmp_path / "t")
    schema = "k int, v double, part string"
    upsert(spark, spark.createDataFrame([(1, 1.0, "a b"), (2, 2.0, "a b"), (3, 3.0, "c/d"), (4, 4.0, "e")], schema), target, ["k"], ("part",))
    gone = spark.createDataFrame([(2, "a b"), (3, "c/d"), (4, "e"), (9, "none")], "k int, part string")
    change = spark.createDataFrame([(4, 40.0, "e")], schema)
    upsert(spark, change, target, ["k"], ("part",), deleted=gone)
    assert _rows(spark, target) == [(1, 1.0, "a b"), (4, 40.0, "e")]  # a key of the source stays
    assert len(list(Path(target).glob("part=*"))) == 2
    upsert(spark, change.limit(0), target, ["k"], ("part",), deleted=gone)
    assert _rows(spark, target) == [(1, 1.0, "a b")]
