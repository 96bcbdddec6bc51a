"""Shared helpers: scratch tables, bounded Bloom filters, whole columns of text as numpy arrays."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ratecraft.session import remove_path, scratch_dir

#: Bytes of text that one round of numpy work takes (longer texts are cut at a separator).
CHUNK_BYTES = 1 << 18
#: Rows that Spark hands to Python at a time; documents are long, so fewer than its default.
BATCH_ROWS = 1000
#: Bits of the largest Bloom filter that is sent to the executors (8 MB).
BLOOM_MAX_BITS = 1 << 26


def bounded_batches(df: DataFrame) -> DataFrame:
    """Lower the session's Arrow batch size to BATCH_ROWS, for jobs that hand whole texts to Python."""
    name, spark = "spark.sql.execution.arrow.maxRecordsPerBatch", df.sparkSession
    if int(spark.conf.get(name)) > BATCH_ROWS:
        spark.conf.set(name, BATCH_ROWS)
    return df


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


class Scratch:
    """Tables written below ``spark.checkpoint.dir``, which every executor sees.

    A written table cuts the lineage: a lost executor costs its running tasks
    only. ``drop`` deletes tables whose readers have been written themselves.
    """

    def __init__(self, spark: SparkSession, label: str):
        self.spark = spark
        self.root = scratch_dir(spark, label)
        self.count = 0
        self.paths: list[str] = []

    def write(self, df: DataFrame) -> DataFrame:
        """Write ``df`` once and return the scan of what was written."""
        self.count += 1
        path = f"{self.root}/t{self.count}"
        df.write.parquet(path)
        out = self.spark.read.schema(df.schema).parquet(path)
        out._scratch_path = path
        self.paths.append(path)
        return out

    def drop(self, *tables: DataFrame) -> None:
        for t in tables:
            remove_path(self.spark, t._scratch_path)
            self.paths.remove(t._scratch_path)

    def keep(self, *tables: DataFrame) -> None:
        """Delete all tables but these."""
        kept = [t._scratch_path for t in tables]
        for path in self.paths:
            if path not in kept:
                remove_path(self.spark, path)
        self.paths = kept


# -- hashing ---------------------------------------------------------------


def mix(x: np.ndarray) -> np.ndarray:
    """Finalise 64-bit values (splitmix64, a public fixed mixing function)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def constants(n: int, seed: int) -> np.ndarray:
    """n odd pseudo-random 64-bit constants that depend on the seed only."""
    return mix(np.arange(1, n + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(seed)) | np.uint64(1)


_BYTE_VALUES = constants(256, 11)
_BASE = int(constants(1, 12)[0])
_POWERS: dict[str, np.ndarray] = {}


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the hash base modulo 2^64, and of its inverse, for n bytes."""
    if len(_POWERS.get("up", ())) <= n:
        size = max(n + 1, CHUNK_BYTES + 1)
        for name, base in (("up", _BASE), ("down", pow(_BASE, -1, 1 << 64))):
            a = np.full(size, base, np.uint64)
            a[0] = 1
            _POWERS[name] = np.multiply.accumulate(a)
    return _POWERS["up"], _POWERS["down"]


def fold_table() -> np.ndarray:
    """Bytes with A-Z lower-cased, everything else as it is."""
    t = np.arange(256, dtype=np.uint8)
    t[65:91] += 32
    return t


def blank_table() -> np.ndarray:
    """True for ASCII white space: space and 0x09 to 0x0D."""
    t = np.zeros(256, bool)
    t[[0x20, *range(0x09, 0x0E)]] = True
    return t


def nonword_table() -> np.ndarray:
    """True for ASCII bytes that are neither letters nor digits."""
    t = np.zeros(256, bool)
    t[:128] = True
    t[[*range(48, 58), *range(65, 91), *range(97, 123)]] = False
    return t


def spans(sep: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs in which sep is False."""
    edge = np.flatnonzero(np.diff(np.concatenate(([True], sep, [True])).view(np.int8)))
    return edge[0::2], edge[1::2]


def rolling(data: np.ndarray) -> np.ndarray:
    """Prefix sums from which the hash of any span comes in constant time."""
    up, _ = powers(len(data))
    out = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_BYTE_VALUES[data] * up[: len(data)], out=out[1:])
    return out


def span_hash(prefix: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit hash of each span's bytes, wherever the span stands."""
    _, down = powers(len(prefix))
    return mix((prefix[end] - prefix[start]) * down[start] + (end - start).astype(np.uint64))


# -- text columns ----------------------------------------------------------


def raw_text(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of a string column and its n + 1 offsets; null is empty."""
    column = column.cast(pa.large_string()).fill_null("")
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, off, data = column.buffers()
    offsets = np.frombuffer(off, np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data, offsets


def groups_of(offsets: np.ndarray, limit: int = CHUNK_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of rows with about ``limit`` bytes each; a longer row stands alone."""
    i, n = 0, len(offsets) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + limit, "right")) - 1)
        yield i, min(j, n)
        i = min(j, n)


def pieces(data: np.ndarray, sep: np.ndarray, limit: int = CHUNK_BYTES) -> Iterator[np.ndarray]:
    """One long text cut behind separators into pieces of about ``limit`` bytes."""
    start = 0
    while len(data) - start > limit:
        cut = start + limit
        while cut < len(data):
            found = np.flatnonzero(sep[data[cut : cut + limit]])
            if len(found):
                cut += int(found[0]) + 1
                break
            cut += limit
        cut = min(cut, len(data))
        yield data[start:cut]
        start = cut
    yield data[start:]


def word_hashes(
    column: pa.Array, sep: np.ndarray, fold: np.ndarray, head: int = 0
) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray | None]]:
    """Hashes of the words of each text, many texts at a time.

    Yields (first row, word offsets by row, word hashes, hashes of each word's
    first ``head`` bytes). Memory is bounded by CHUNK_BYTES, or by eight bytes
    a word of the longest text.
    """
    data, offsets = raw_text(column)
    for i, j in groups_of(offsets):
        lo, hi = int(offsets[i]), int(offsets[j])
        parts, heads, counts = [], [], []
        cut = pieces(data[lo:hi], sep) if j - i == 1 else [data[lo:hi]]
        for part in cut:
            part = fold[part]
            gap = sep[part]
            inner = (offsets[i + 1 : j] - lo).astype(np.int64)
            start, end = spans(gap)
            if j - i > 1 and len(inner):  # a word never runs over the end of its text
                split = inner[(inner > 0) & (inner < len(part))]
                split = split[~gap[split - 1] & ~gap[split]]
                if len(split):
                    split = np.unique(split)
                    start = np.sort(np.concatenate((start, split)))
                    end = np.sort(np.concatenate((end, split)))
            prefix = rolling(part)
            parts.append(span_hash(prefix, start, end))
            if head:
                heads.append(span_hash(prefix, start, np.minimum(end, start + head)))
            if j - i > 1:
                counts = np.searchsorted(start, offsets[i : j + 1] - lo)
        words = np.concatenate(parts)
        if j - i == 1:
            counts = np.array([0, len(words)])
        yield i, counts, words, np.concatenate(heads) if head else None


# -- Bloom filters of bounded size -----------------------------------------


def bloom_bits(n: int) -> int:
    """A power of two near 16 bits a key, never above BLOOM_MAX_BITS."""
    return min(BLOOM_MAX_BITS, 1 << max(16, int(np.ceil(np.log2(16 * max(1, n))))))


def bloom_of(keys: DataFrame, column: str, n: int) -> np.ndarray:
    """Bloom filter (as 64-bit words) over a bigint column of n rows.

    The bits are set by an aggregation, so at most bits / 64 words reach the
    driver, whatever the number of keys; a fuller filter only lets more rows
    through to the exact join behind it.
    """
    bits = bloom_bits(n)
    k = F.col(column)
    probe = F.explode(F.array(*(F.pmod(F.shiftrightunsigned(k, s), F.lit(bits)) for s in (0, 21, 37))))
    words = (
        keys.select(probe.alias("bit"))
        .groupBy(F.shiftright("bit", 6).cast("int").alias("word"))
        .agg(F.bit_or(F.expr("shiftleft(1L, cast(bit & 63 as int))")).alias("bits"))
    )
    out = np.zeros(bits // 64, np.uint64)
    t = words.toArrow()
    out[t.column("word").to_numpy()] = t.column("bits").to_numpy().view(np.uint64)
    return out


def bloom_has(words: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Which int64 keys the filter may hold."""
    k = keys.view(np.uint64)
    n = np.uint64(len(words) * 64)
    out = np.ones(len(k), bool)
    for s in (0, 21, 37):
        # the signed remainder that Spark's pmod gives; bits is a power of two
        bit = (k >> np.uint64(s)) & (n - np.uint64(1))
        out &= (words[(bit >> np.uint64(6)).astype(np.int64)] >> (bit & np.uint64(63))) & np.uint64(1) == 1
    return out


def _filtered(bloom: np.ndarray, at: int, keep: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ids = b.column(at)
            held = bloom_has(bloom, ids.fill_null(0).to_numpy().astype(np.int64)) & ~np.asarray(ids.is_null())
            yield b.filter(pa.array(held == keep))

    return run


def drop_ids(rows: DataFrame, gone: DataFrame, column: str, n: int) -> DataFrame:
    """Rows whose bigint ``column`` isn't among the n of ``gone`` (one column of that name).

    A bounded Bloom filter lets the rows that can't be among them pass where
    they are read; only the others are shuffled for the exact anti join. Nulls stay.
    """
    if not n:
        return rows
    bloom, at = bloom_of(gone, column, n), rows.columns.index(column)
    rest = rows.mapInArrow(_filtered(bloom, at, False), rows.schema)
    asked = rows.mapInArrow(_filtered(bloom, at, True), rows.schema)
    return rest.unionByName(asked.join(gone.hint("merge"), column, "left_anti").select(rows.columns))
