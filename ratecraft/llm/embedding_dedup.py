"""Embedding near-duplicates: cross-polytope hashing after fast Hadamard rotations.

Each of TABLES tables hashes a unit vector with CONCAT independent rotations
(three rounds of random signs and a fast Walsh-Hadamard transform); a rotation
hashes to the signed axis the vector is nearest to. Multiprobe: a vector also
enters the PROBES - 1 buckets reached by replacing axes by their runners-up at
the least loss. The parameters are fixed; two vectors at cosine 0.95 meet in a
table with probability 0.70 (64 dimensions), in none of ten with 6e-6.

Candidate pairs are verified by cosine in double precision; buckets become
components without listing their pairs (``components.link_buckets``). Inside
components, links are counted block by block: a task multiplies two blocks of
at most BLOCK vectors and emits one count a vector, so a large group costs its
arithmetic but neither a row per pair nor a task that holds the group.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ratecraft.llm.common import Scratch, mix
from ratecraft.llm.components import bucket_members, link_buckets

TABLES, CONCAT, PROBES = 10, 3, 4
COSINE = 0.95
BLOCK = 512


def hadamard(x: np.ndarray) -> np.ndarray:
    """Fast Walsh-Hadamard transform of each row (length a power of two)."""
    n, h = x.shape[1], 1
    while h < n:
        y = x.reshape(len(x), n // (2 * h), 2, h)
        x = np.concatenate((y[:, :, :1] + y[:, :, 1:], y[:, :, :1] - y[:, :, 1:]), axis=2).reshape(len(x), n)
        h *= 2
    return x


def bucket_keys(x: np.ndarray, seed: int = 7) -> np.ndarray:
    """(rows, TABLES * PROBES) int64 bucket keys of unit vectors."""
    size = 1 << max(1, int(np.ceil(np.log2(max(2, x.shape[1])))))
    x = np.pad(x, ((0, 0), (0, size - x.shape[1])))
    rng = np.random.default_rng([seed, size])
    flips = np.array(list(itertools.product((0, 1), repeat=CONCAT)), bool)
    out = []
    for table in range(TABLES):
        codes, gaps = [], []
        for _ in range(CONCAT):
            y = x
            for _ in range(3):
                y = hadamard(y * rng.choice((-1.0, 1.0), size)) / np.sqrt(size)
            two = np.argpartition(-np.abs(y), 1, axis=1)[:, :2]
            v = np.take_along_axis(y, two, 1)
            swap = np.abs(v[:, 0]) < np.abs(v[:, 1])
            two[swap], v[swap] = two[swap][:, ::-1], v[swap][:, ::-1]
            codes.append(two * 2 + (v < 0))
            gaps.append(np.abs(v[:, 0]) - np.abs(v[:, 1]))
        loss = np.stack([sum(g for g, f in zip(gaps, flip, strict=True) if f) + 0 * gaps[0] for flip in flips], axis=1)
        for probe in np.argsort(loss, axis=1, kind="stable")[:, :PROBES].T:
            key = np.full(len(x), table, np.uint64)
            for k in range(CONCAT):
                pick = np.where(flips[probe, k], codes[k][:, 1], codes[k][:, 0])
                key = mix(key * np.uint64(2 * size) + pick.astype(np.uint64) + np.uint64(1))
            out.append(key)
    return np.stack(out, axis=1).view(np.int64)


def _unit(column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(rows, unit vectors in double precision) by vector length."""
    column = column.cast(pa.list_(pa.float64()))
    flat = np.asarray(column.flatten().to_numpy(zero_copy_only=False), np.float64)
    length = np.asarray(column.value_lengths().fill_null(0))
    start = np.concatenate(([0], np.cumsum(length)[:-1]))
    for n in np.unique(length):
        rows = np.flatnonzero(length == n)
        x = flat[start[rows][:, None] + np.arange(n)]
        scale = np.abs(x).max(axis=1, keepdims=True)
        x = x / scale
        yield rows, x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def _hash(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        ids = np.asarray(b.column(0))
        for rows, x in _unit(b.column(1)):
            for i in range(0, len(rows), 4096):
                keys = bucket_keys(x[i : i + 4096])
                yield pa.RecordBatch.from_arrays(
                    [keys.ravel(), np.repeat(ids[rows[i : i + 4096]], keys.shape[1])], ["key", "id"]
                )


def _cosine(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return (a * b).sum(axis=1)


def _linked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (u, v, a, b) whose vectors reach the cosine."""
    for b in batches:
        good = np.zeros(b.num_rows, bool)
        left = {int(r): x for rows, m in _unit(b.column(2)) for r, x in zip(rows, m, strict=True)}
        for rows, y in _unit(b.column(3)):
            same = np.array([len(left[int(r)]) == y.shape[1] for r in rows], bool)
            if same.any():
                rows, y = rows[same], y[same]
                good[rows] = _cosine(np.stack([left[int(r)] for r in rows]), y) >= COSINE
        yield b.select([0, 1]).filter(pa.array(good))


def _block_links(key, left: pa.Table, right: pa.Table) -> pa.Table:
    """Links of two blocks of one component: for each vector, weights of its partners."""
    same = left.num_rows > 0 and right.num_rows > 0 and key[1].as_py() == key[2].as_py()
    out_id, out_n = [], []
    parts_l = [(rows, x) for rows, x in _unit(left.column("vector").combine_chunks())] if left.num_rows else []
    parts_r = [(rows, x) for rows, x in _unit(right.column("vector").combine_chunks())] if right.num_rows else []
    li, ri = np.asarray(left.column("id")), np.asarray(right.column("id"))
    lw, rw = np.asarray(left.column("weight")), np.asarray(right.column("weight"))
    for lrows, x in parts_l:
        for rrows, y in parts_r:
            if x.shape[1] != y.shape[1]:
                continue
            hit = (x @ y.T) >= COSINE
            if same:
                hit &= li[lrows][:, None] != ri[rrows][None, :]
            out_id.append(li[lrows])
            out_n.append(hit @ rw[rrows])
            if not same:
                out_id.append(ri[rrows])
                out_n.append(lw[lrows] @ hit)
    ids = np.concatenate(out_id) if out_id else np.zeros(0, np.int64)
    n = np.concatenate(out_n) if out_n else np.zeros(0, np.int64)
    return pa.table({"id": pa.array(ids, pa.int64()), "n": pa.array(n.astype(np.int64), pa.int64())})


def near_duplicates(vectors: DataFrame) -> DataFrame:
    """One row per vector: vec_id, n_links, component_id, kept.

    Two vectors link when their cosine in double precision is 0.95 or more and
    they share a bucket or a component. n_links counts the other rows linked
    directly, component_id is the smallest vec_id reachable, kept says whether
    that is the vector itself.

    Vectors that are null, empty, all zero, or hold null or non-finite
    components link with nothing (their own vec_id, kept). Vectors of unlike
    lengths never link. Equal vectors form one class, compared once. A null
    vec_id keeps its row. An empty table gives an empty result; other columns
    are not read.
    """
    spark = vectors.sparkSession
    scratch = Scratch(spark, "embedding")
    v = F.col("embedding").cast("array<double>")
    usable = F.coalesce(
        (F.size(v) > 0)
        & F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
        & F.exists(v, lambda x: x != 0),
        F.lit(False),
    )
    rows = vectors.select("vec_id", F.when(usable, v).alias("vector"))
    # -0.0 and 0.0 are one value; the class name covers every component
    plain = F.transform("vector", lambda x: x + F.lit(0.0))
    rows = rows.select("vec_id", plain.alias("vector"), F.when(F.col("vector").isNotNull(), F.xxhash64(plain)).alias("id"))
    classes = scratch.write(rows.select("vec_id", "id"))
    reps = scratch.write(
        rows.filter("id is not null").groupBy("id").agg(F.count("*").alias("weight"), F.first("vector").alias("vector"))
    )
    keys = reps.select("id", "vector").mapInArrow(_hash, "key long, id long").repartition("key")
    members = bucket_members(keys.withColumn("plan", F.lit(-1)), scratch)

    def verify(pairs: DataFrame) -> DataFrame:
        left = reps.select(F.col("id").alias("u"), F.col("vector").alias("a"))
        right = reps.select(F.col("id").alias("v"), F.col("vector").alias("b"))
        met = pairs.join(left, "u").join(right, "v").select("u", "v", "a", "b")
        return met.mapInArrow(_linked, "u long, v long")

    _, comps = link_buckets(members, reps.select("id"), lambda l, r: "true", verify, scratch)

    # blocks of each component, numbered inside it without a task that holds it:
    # rows are dealt to blocks by hash, their number follows from the component's size
    sizes = comps.groupBy("comp").agg(F.count("*").alias("size"))
    placed = (
        comps.withColumnRenamed("node", "id")
        .join(sizes, "comp")
        .withColumn("blocks", F.ceil(F.col("size") * 1.5 / BLOCK).cast("int"))
        .withColumn("block", F.pmod(F.xxhash64("id", F.lit(3)), F.col("blocks")).cast("int"))
        .join(reps, "id")
    )
    placed = scratch.write(placed.select("id", "comp", "blocks", "block", "weight", "vector"))
    to_left = F.explode(F.sequence(F.col("block"), F.col("blocks") - 1))
    left = placed.select("comp", F.col("block").alias("x"), to_left.alias("y"), "id", "weight", "vector")
    right = placed.select("comp", F.explode(F.sequence(F.lit(0), F.col("block"))).alias("x"), F.col("block").alias("y"), "id", "weight", "vector")
    keys = ["comp", "x", "y"]
    counts = (
        left.groupBy(*keys)
        .cogroup(right.groupBy(*keys))
        .applyInArrow(_block_links, "id long, n long")
        .groupBy("id")
        .agg(F.sum("n").alias("n"))
    )
    done = scratch.write(counts)
    named = (
        classes.join(comps.withColumnRenamed("node", "id"), "id", "left")
        .join(done, "id", "left")
        .join(reps.select("id", "weight"), "id", "left")
        .select("vec_id", F.coalesce("comp", "id").alias("comp"), F.coalesce(F.col("n") + F.col("weight") - 1, F.col("weight") - 1, F.lit(0)).alias("n_links"))
    )
    named = scratch.write(named)
    least = named.filter("comp is not null").groupBy("comp").agg(F.min("vec_id").alias("least"))
    component = F.when(F.col("comp").isNull(), F.col("vec_id")).otherwise(F.col("least"))
    return named.join(least, "comp", "left").select(
        "vec_id", "n_links", component.alias("component_id"), F.col("vec_id").eqNullSafe(component).alias("kept")
    )
