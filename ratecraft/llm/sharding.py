"""Sharding by sampled splitters; DataFrame operations only.

Rows have a total order (``key``, then a number given when the rows are
written). A sample of the rows, drawn in proportion to their bytes plus the mean
size of a row, gives quantile boundaries; every row finds its range among them
by binary search. Ranges with too many rows or bytes (a large group of copies, or
an uneven sample) are subdivided in the same way by a sample of their own, until
each fits one task. The exact sizes of the ranges, added up in order, and a
running sum inside each range then give every row the bytes and rows before it,
and so its shard: the shards are consecutive stretches of the order, cut where
an equal share of the bytes ends. The samples decide how the work is dealt, never
the result.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ratecraft.llm.common import Scratch

#: A range above either bound is subdivided; below, one task sorts it.
MAX_ROWS, MAX_BYTES = 1_000_000, 256 << 20
#: Ranges made of one: four times what its excess asks for, within these bounds.
FEWEST, MOST = 64, 1024
#: Sampled rows for each range to make.
SAMPLES = 32
#: Ranges whose boundaries are broadcast together (at most MOST each, tens of bytes a boundary).
BROADCAST_RANGES = 1024
LEVELS = 12
SHARDS = 8


def _search(limits: Column, key: Column) -> Column:
    """How many of the sorted ``limits`` are below ``key``, by binary search."""
    steps = F.array(*(F.lit(1 << k) for k in reversed(range(MOST.bit_length()))))
    return F.aggregate(
        steps, F.lit(0), lambda at, step: F.when(F.get(limits, at + step - 1) < key, at + step).otherwise(at)
    )


def _small(side: DataFrame, rows: int) -> DataFrame:
    """Broadcast a side of a checked number of rows, else join by shuffle."""
    return F.broadcast(side) if rows <= BROADCAST_RANGES else side.hint("merge")


def _splitters(rows: DataFrame, full: DataFrame, n: int) -> DataFrame:
    """(range, limits): quantile boundaries of a size-weighted sample of each range in ``full``."""
    share = (F.col("size") / F.col("bytes") + F.lit(1.0) / F.col("rows")) / 2
    uniform = F.pmod(F.xxhash64("key", F.lit(17)), F.lit(1 << 30)) / F.lit(float(1 << 30))
    sample = (
        rows.select("range", "size", "key")
        .join(_small(full, n), "range")
        .withColumn("drawn", F.floor(share * F.col("parts") * SAMPLES + uniform))
        .filter("drawn > 0")
        .select("range", "parts", "key", "drawn")
    )
    upto = F.sum("drawn").over(Window.partitionBy("range").orderBy("key"))
    total = F.sum("drawn").over(Window.partitionBy("range"))
    cut = sample.select("range", "parts", "key", "drawn", upto.alias("upto"), total.alias("total"))
    # a limit is the last key of its range; the very last row ends no range
    cut = cut.filter("upto * parts div total > (upto - drawn) * parts div total and upto < total")
    return cut.groupBy("range").agg(F.sort_array(F.collect_list("key")).alias("limits"))


def _whole(at: str, total: int, shards: int) -> Column:
    return F.expr(f"least({shards - 1}, {at} * {shards} div {max(1, 2 * total)})").cast("int")


def range_shards(
    rows: DataFrame,
    key: Sequence[Column],
    size: Column,
    shards: int = SHARDS,
    max_rows: int = MAX_ROWS,
    max_bytes: int = MAX_BYTES,
) -> DataFrame:
    """``rows`` with their columns, then shard (int, 0 to shards - 1) and slot (long).

    Shards are consecutive in the order of ``key`` (nulls first; rows with equal
    keys in the order in which they were read). A row goes to the shard that
    holds the middle of its bytes (``size``, positive), so a shard's total
    differs from an equal share by less than the two rows at its ends. Slots
    count each shard's rows from 0 without gaps, in that order. With fewer rows
    than shards, or rows larger than a share, some shards stay empty. An empty
    table gives an empty result. Columns named shard or slot are replaced.
    """
    scratch = Scratch(rows.sparkSession, "shards")
    data = F.struct(*(F.col(f"`{c}`") for c in rows.columns if c not in ("shard", "slot"))).alias("data")
    order = F.struct(*(k.alias(f"k{i}") for i, k in enumerate(key)), F.monotonically_increasing_id().alias("tie")).alias("key")
    # the first range is stored, not a constant of the plan: a join on it stays an equi-join
    found = scratch.write(rows.select(data, order, size.cast("long").alias("size"), F.lit("").alias("range")))
    kept, ranged = [found], found
    for level in range(LEVELS):
        need = F.greatest(F.col("rows") / max_rows, F.col("bytes") / max_bytes)
        ranges = ranged.groupBy("range").agg(F.count("*").alias("rows"), F.sum("size").alias("bytes"))
        ranges = scratch.write(ranges.withColumn("parts", F.least(F.lit(MOST), F.greatest(F.lit(FEWEST), 4 * F.ceil(need)))))
        full = ranges.filter((need > 1) & (F.col("rows") > 1)) if level else ranges
        if not (n := full.count()):
            break
        limits = scratch.write(_splitters(ranged, full, n))
        kept.append(limits)
        part = F.lpad(F.hex(_search(F.col("limits"), F.col("key"))), 3, "0")
        ranged = ranged.join(_small(limits, n), "range", "left").select(
            "data", "key", "size", F.concat("range", F.when(F.col("limits").isNull(), "").otherwise(part)).alias("range")
        )
    else:
        raise RuntimeError(f"ranges are still too large after {LEVELS} levels")

    total = ranges.agg(F.sum("bytes")).first()[0] or 0
    before = Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    at = scratch.write(
        ranges.select(
            "range", "rows", "bytes",
            F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("rows_before"),
            F.coalesce(F.sum("bytes").over(before), F.lit(0)).alias("bytes_before"),
        )
    )

    def placed(rows: DataFrame, at: DataFrame) -> DataFrame:
        inside = Window.partitionBy("range").orderBy("key")
        out = rows.withColumn("__row", F.row_number().over(inside)).withColumn("__upto", F.sum("size").over(inside))
        out = out.join(at.select("range", "rows_before", "bytes_before"), "range")
        out = out.withColumn("__middle", 2 * (F.col("bytes_before") + F.col("__upto")) - F.col("size"))
        return out.withColumn("shard", _whole("__middle", total, shards))

    # where shards begin: ranges that lie in one shard count as a whole, the others (one a cut at most) by row
    ends = at.withColumn("low", _whole("2 * bytes_before", total, shards)).withColumn("high", _whole("2 * (bytes_before + bytes)", total, shards))
    cut = ends.filter("low <> high")
    rows_cut = placed(ranged.select("key", "size", "range").join(F.broadcast(cut.select("range")), "range", "left_semi"), cut)
    counts = ends.filter("low = high").groupBy(F.col("low").alias("shard")).agg(F.sum("rows").alias("n"))
    counts = counts.unionByName(rows_cut.groupBy("shard").agg(F.count("*").alias("n"))).groupBy("shard").agg(F.sum("n").alias("n"))
    first = scratch.write(counts.select("shard", F.coalesce(F.sum("n").over(Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("__first")))
    scratch.keep(*kept, at, first)
    out = placed(ranged, at).join(F.broadcast(first), "shard")  # one row a shard
    return out.select("data.*", "shard", (F.col("rows_before") + F.col("__row") - 1 - F.col("__first")).alias("slot"))


def shard_documents(docs: DataFrame, shards: int = SHARDS, **bounds: int) -> DataFrame:
    """One row per document: its columns, size (UTF-8 bytes of the text plus 1), shard and slot.

    The key is the digest of the text, then the doc_id: equal texts stand next
    to each other, in one shard unless a boundary falls among them, and the
    order is the same on every run. A null text has no bytes (size 1); a null
    doc_id comes first among equal texts; repeated rows all stay. Columns named
    size, shard or slot are replaced; others stay.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    sized = docs.withColumn("size", (F.octet_length(text) + F.lit(1)).cast("long"))
    return range_shards(sized, [F.unhex(F.md5(text)), F.col("doc_id")], F.col("size"), shards, **bounds)


def write_shards(docs: DataFrame, path: str, shards: int = SHARDS) -> None:
    """Write the documents to ``path/shard=k``, the rows of each file in slot order."""
    out = shard_documents(docs, shards).sortWithinPartitions("shard", "slot")
    out.write.partitionBy("shard").parquet(path)
