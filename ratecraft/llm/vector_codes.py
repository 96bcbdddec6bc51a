"""Vector code compression: product codes by an exact integer Walsh-Hadamard search.

Vectors become integers and are cut into equal parts; each part position has a
codebook, refined by rounds of assignment and floored means. Parts and entries
are padded with zeros to a power of two and Walsh-Hadamard transformed, which is
all additions. The transform multiplies squared distances by its length exactly,
so the squared differences of coefficients, added up in sequency order, bound
the scaled distance from below; an entry whose sum exceeds the distance of an
entry already known in full is eliminated. Entries that tie are never eliminated,
so the lowest index among the nearest is found. All arithmetic is on integers.

A round is one pass over the vectors: a task adds up its own parts by entry and
emits one row an entry, so the codebooks (a fixed number of entries) are all
that reaches the driver.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ratecraft.llm.common import Scratch

PARTS, ENTRIES, ROUNDS, SCALE = 16, 64, 2, 256
#: Vectors that one step of numpy work takes.
STEP = 2048
#: Labels whose sums are broadcast; beyond, rows of a label are dealt to SALTS tasks.
BROADCAST_LABELS, SALTS = 200_000, 32


def integer_vector(embedding: Column, scale: int, bound: int) -> Column:
    """floor(scale * x) of each component; null for a null vector, null or non-finite components,
    and components whose integer is ``bound`` or more in size."""
    x = embedding.cast("array<double>")
    good = F.forall(x, lambda v: F.coalesce(~F.isnan(v) & (F.abs(v) < F.lit(float(bound) / scale)), F.lit(False)))
    return F.when(good, F.transform(x, lambda v: F.floor(v * F.lit(float(scale))).cast("int")))


def transform_length(n: int) -> int:
    return 1 << max(0, n - 1).bit_length()


def walsh(x: np.ndarray) -> np.ndarray:
    """Walsh-Hadamard transform of each row of int64, zero-padded, in sequency order."""
    n = transform_length(x.shape[1])
    x = np.pad(x, ((0, 0), (0, n - x.shape[1])))
    h = 1
    while h < n:
        y = x.reshape(len(x), n // (2 * h), 2, h)
        x = np.concatenate((y[:, :, :1] + y[:, :, 1:], y[:, :, :1] - y[:, :, 1:]), axis=2).reshape(len(x), n)
        h *= 2
    return x[:, sequency(n)]


def sequency(n: int) -> np.ndarray:
    """Natural (Hadamard) index of the function with k sign changes: bits of the Gray code of k, reversed."""
    k = np.arange(n)
    gray, out = k ^ (k >> 1), np.zeros(n, np.int64)
    for _ in range(n.bit_length() - 1):
        out = (out << 1) | (gray & 1)
        gray = gray >> 1
    return out


def nearest(parts: np.ndarray, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(index, squared distance) of the entry nearest to each part, ties to the lower index."""
    rows, n = len(parts), transform_length(parts.shape[1])
    p, e = walsh(parts), walsh(entries)
    # the first coefficient of all entries, then one entry in full: an upper bound
    apart = (p[:, :1] - e[None, :, 0]) ** 2
    guess = apart.argmin(axis=1)
    bound = ((p - e[guess]) ** 2).sum(axis=1)
    row, entry = np.nonzero(apart <= bound[:, None])
    total = apart[row, entry]
    for k in range(1, n):
        total = total + (p[row, k] - e[entry, k]) ** 2
        keep = total <= bound[row]
        row, entry, total = row[keep], entry[keep], total[keep]
    # pairs are sorted by row, then entry; each row keeps its nearest entries at least
    start = np.searchsorted(row, np.arange(rows))
    least = np.minimum.reduceat(total, start) if rows else total
    hit = np.flatnonzero(total == least[row])
    _, lowest = np.unique(row[hit], return_index=True)
    return entry[hit[lowest]], least // n


def _vectors(column: pa.Array, dim: int) -> np.ndarray:
    return np.asarray(column.flatten()).astype(np.int64).reshape(len(column), dim)


def _sums(books: np.ndarray):
    """Component sums and number of the parts nearest to each entry, one row an entry and task."""
    parts, entries, width = books.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, count = np.zeros(books.shape, np.int64), np.zeros((parts, entries), np.int64)
        for b in batches:
            v = _vectors(b.column(0), parts * width)
            for i in range(0, len(v), STEP):
                for p in range(parts):
                    own = v[i : i + STEP, p * width : (p + 1) * width]
                    code, _ = nearest(own, books[p])
                    np.add.at(total[p], code, own)
                    count[p] += np.bincount(code, minlength=entries)
        p, e = np.nonzero(count)
        if len(p):
            yield pa.RecordBatch.from_arrays(
                [pa.array(p, pa.int32()), pa.array(e, pa.int32()), pa.array(count[p, e]), pa.array(list(total[p, e]), pa.list_(pa.int64()))],
                ["part", "entry", "n", "total"],
            )

    return run


def _encoded(books: np.ndarray):
    parts, _, width = books.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            v = _vectors(b.column(1), parts * width)
            codes, error = np.zeros((len(v), parts), np.uint8), np.zeros(len(v), np.int64)
            for i in range(0, len(v), STEP):
                for p in range(parts):
                    codes[i : i + STEP, p], far = nearest(v[i : i + STEP, p * width : (p + 1) * width], books[p])
                    error[i : i + STEP] += far
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([c.tobytes() for c in codes], pa.binary()), pa.array(error)], ["row", "codes", "error"])

    return run


def usable(vectors: DataFrame, parts: int = PARTS, scale: int = SCALE, keep: tuple[str, ...] = ()) -> DataFrame:
    """(vec_id, label, v, *keep) of the rows that can be coded."""
    # (2 * bound * length) squared fits a long for any length up to that of the vector
    v = integer_vector(F.col("embedding"), scale, 1 << 26)
    rows = vectors.select("vec_id", "label", v.alias("v"), *keep).filter("v is not null")
    return rows.filter((F.size("v") > 0) & (F.size("v") % parts == 0))


def train(rows: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> np.ndarray:
    """Codebooks (parts, entries, width) of the vectors in ``v``, all of one length.

    They start from the smallest vec_ids; rows with equal ids in the order of
    their vectors, rows without id only if no others are left.
    """
    seeds = rows.orderBy(F.col("vec_id").asc_nulls_last(), "v").limit(entries).select("v").collect()
    first = np.array([r.v for r in seeds], np.int64)
    books = np.ascontiguousarray(first.reshape(len(first), parts, -1).transpose(1, 0, 2))
    width = books.shape[2]
    for _ in range(rounds):
        sums = rows.select("v").mapInArrow(_sums(books), "part int, entry int, n long, total array<long>")
        sums = sums.groupBy("part", "entry").agg(F.sum("n").alias("n"), *(F.sum(F.col("total")[i]).alias(f"t{i}") for i in range(width)))
        found = sums.toArrow()  # one row an entry
        if found.num_rows:
            at = (found.column("part").to_numpy(), found.column("entry").to_numpy())
            total = np.stack([found.column(f"t{i}").to_numpy() for i in range(width)], axis=1)
            books[at] = total // found.column("n").to_numpy()[:, None]
    return books


def codebooks_digest(books: np.ndarray) -> str:
    return hashlib.sha256(",".join(map(str, books.ravel().tolist())).encode()).hexdigest()


def compress_vectors(vectors: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, scale: int = SCALE) -> DataFrame:
    """One row per coded vector: vec_id, label, codes (binary, a byte a part), error, label_error, codebooks_sha256.

    error is the squared distance of the integer vector to its entries, summed
    over the parts; label_error sums it over the rows of equal label, null
    labels together. Rows have no code, and are left out, if the vector is null
    or empty, holds null or non-finite components or components whose integer is
    2^26 or more in size, has a length that the number of parts doesn't divide,
    or another length than the first coded row (by vec_id). A null vec_id keeps
    its row; repeated rows count each. Ties go to the lower index. With fewer
    rows than entries, codebooks are smaller. An empty table, or one without a
    usable row, gives an empty result; other columns are not read.
    """
    if entries > 256:
        raise ValueError("a code is one byte a part")
    scratch = Scratch(vectors.sparkSession, "codes")
    rows = scratch.write(usable(vectors, parts, scale).withColumn("row", F.monotonically_increasing_id()))
    first = rows.orderBy(F.col("vec_id").asc_nulls_last(), "v").limit(1).select(F.size("v").alias("n")).first()
    schema = "vec_id long, label int, codes binary, error long, label_error long, codebooks_sha256 string"
    if first is None:
        return vectors.sparkSession.createDataFrame([], schema)
    rows = rows.filter(F.size("v") == first.n)
    books = train(rows, parts, entries, rounds)
    coded = rows.select(F.struct("vec_id", "label").alias("row"), "v").mapInArrow(
        _encoded(books), f"row {rows.select(F.struct('vec_id', 'label').alias('r')).schema['r'].dataType.simpleString()}, codes binary, error long"
    )
    coded = scratch.write(coded.select("row.vec_id", "row.label", "codes", "error"))
    sums = scratch.write(coded.groupBy("label").agg(F.sum("error").alias("label_error")).withColumnRenamed("label", "__label"))
    scratch.keep(coded, sums)
    same = F.col("label").eqNullSafe(F.col("__label"))
    if sums.count() <= BROADCAST_LABELS:
        out = coded.join(F.broadcast(sums), same)
    else:
        salted = sums.withColumn("__salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        out = coded.withColumn("salt", F.pmod(F.xxhash64("vec_id", "codes"), F.lit(SALTS)).cast("int"))
        out = out.join(salted.hint("merge"), same & (F.col("salt") == F.col("__salt")))
    return out.select("vec_id", "label", "codes", "error", "label_error", F.lit(codebooks_digest(books)).alias("codebooks_sha256"))
