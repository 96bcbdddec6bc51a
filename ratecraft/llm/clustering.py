"""Centroid clustering of integer vectors, skipping scans by geometric drift bounds.

Lloyd rounds with one lower bound a vector, on its distance to every centroid
but its own. When centroids move, the bound must be loosened by the most that
any vector of the cluster can come nearer to another centroid. The vectors of a
cluster lie in a sphere (old centroid, largest distance). For a centroid that
moves from p to q, the vectors that come nearer by 2a lie within a hyperbola
with foci p and q, hence within its asymptotic cone around the line pq; in the
plane of that line and the sphere's centre, the cone that touches the sphere
gives the bound |pq| * cos(angle), which is below the full drift |pq| unless the
sphere reaches the axis behind the midpoint, and 0 if all of the sphere lies on
the other side. Distances to the own centroid are exact; a vector that is
nearer to it than its loosened bound keeps it, all others are scanned against
every centroid in integers. Bounds are floating point with a safety margin and
decide only what is scanned, so assignments are exact.

A round is one pass over the written state (vector, cluster, bound); sums,
counts and radii of the clusters come from one aggregate over it.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ratecraft.llm.common import Scratch
from ratecraft.llm.vector_codes import integer_vector

CENTROIDS, ROUNDS, SCALE, DIM, SEED = 16, 3, 64, 64, "1"
#: Relative slack of a floating-point bound; far above the rounding error of the sums.
MARGIN = 1e-9
STEP = 4096


def drift_bounds(old: np.ndarray, new: np.ndarray, radius: np.ndarray) -> np.ndarray:
    """For each cluster, the most by which a vector of its sphere comes nearer to another centroid.

    old, new: centroids; radius: largest distance of a cluster's vectors to its old centroid.
    """
    k = len(old)
    a, b = old.astype(np.float64), new.astype(np.float64)
    move = b - a
    drift = np.sqrt((move**2).sum(axis=1))
    out = np.zeros(k)
    for i in range(k):
        for j in range(k):
            if j == i or not drift[j]:
                continue
            to = a[i] - (a[j] + b[j]) / 2  # from the midpoint to the sphere's centre
            far = np.sqrt((to**2).sum())
            if radius[i] >= far * (1 - MARGIN):
                worst = drift[j]
            else:
                angle = np.arccos(np.clip((to @ move[j]) / (far * drift[j]), -1.0, 1.0)) - np.arcsin(radius[i] / far)
                worst = drift[j] * max(0.0, np.cos(max(0.0, angle)))
            out[i] = max(out[i], min(drift[j], worst + MARGIN * (drift[j] + far)))
    return out


def squared(v: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    """Exact squared distances of each vector to each centroid."""
    return np.stack([((v - c) ** 2).sum(axis=1) for c in centroids], axis=1)


def assign(v: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(cluster, squared distance, lower bound to the others) of each vector; ties to the smaller number."""
    d = squared(v, centroids)
    cluster = d.argmin(axis=1)
    own = d[np.arange(len(v)), cluster]
    if len(centroids) == 1:
        return cluster, own, np.full(len(v), np.inf)
    second = np.partition(d, 1, axis=1)[:, 1]
    return cluster, own, np.sqrt(second.astype(np.float64)) * (1 - MARGIN)


def _step(centroids: np.ndarray, loosen: np.ndarray | None):
    """One assignment: columns (vec_id, v, cluster, bound) to (vec_id, v, cluster, bound, distance, scanned)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            v = np.asarray(b.column(1).flatten()).astype(np.int64).reshape(b.num_rows, centroids.shape[1])
            cluster = np.zeros(len(v), np.int64)
            own, bound = np.zeros(len(v), np.int64), np.full(len(v), -np.inf)
            if loosen is not None:
                cluster = np.asarray(b.column(2)).astype(np.int64)
                bound = np.asarray(b.column(3)) - loosen[cluster]
                own = ((v - centroids[cluster]) ** 2).sum(axis=1)
            ambiguous = ~(np.sqrt(own.astype(np.float64)) * (1 + MARGIN) < bound)
            rows = np.flatnonzero(ambiguous)
            for i in range(0, len(rows), STEP):
                at = rows[i : i + STEP]
                cluster[at], own[at], bound[at] = assign(v[at], centroids)
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), pa.array(cluster, pa.int32()), pa.array(bound), pa.array(own), pa.array(ambiguous)],
                ["vec_id", "v", "cluster", "bound", "distance", "scanned"],
            )

    return run


def usable(vectors: DataFrame, scale: int = SCALE, dim: int = DIM) -> DataFrame:
    """(vec_id, v) of the vectors of the right length without null or non-finite components."""
    v = integer_vector(F.col("embedding"), scale, 1 << 26)
    return vectors.select("vec_id", v.alias("v")).filter(F.col("v").isNotNull() & (F.size("v") == dim))


def cluster_vectors(
    vectors: DataFrame, centroids: int = CENTROIDS, rounds: int = ROUNDS, scale: int = SCALE, dim: int = DIM, seed: str = SEED
) -> DataFrame:
    """One row per kept vector: vec_id, cluster, distance, scans, cluster_inertia, inertia, centroid (array of long).

    Centroids start as the kept vectors with the smallest SHA-256 of
    ``seed:vec_id`` (equal ids in the order of their vectors; null ids only if
    no others are left). After ``rounds`` of assignment and floored means the vectors
    are assigned once more; distance is squared, cluster_inertia and inertia are
    its sums. ``scans`` counts the assignments in which the vector was compared
    with every centroid. An empty cluster keeps its centroid.

    Left out: null vectors, other lengths than ``dim``, null or non-finite
    components, and components whose integer is 2^26 or more in size (distances
    would leave a long). A null vec_id keeps its row; repeated rows count each.
    With fewer vectors than centroids there are as many as vectors. An empty
    table gives an empty result; other columns are not read.
    """
    spark = vectors.sparkSession
    scratch = Scratch(spark, "clusters")
    rows = scratch.write(usable(vectors, scale, dim))
    name = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")), 256)
    seeds = rows.orderBy(name.asc_nulls_last(), "v").limit(centroids).select("v").collect()
    if not seeds:
        return spark.createDataFrame(
            [], "vec_id long, cluster int, distance long, scans int, cluster_inertia long, inertia long, centroid array<long>"
        )
    now = np.array([r.v for r in seeds], np.int64)
    kind = rows.schema["vec_id"].dataType.simpleString()
    state = rows.withColumns({"cluster": F.lit(0), "bound": F.lit(0.0), "scans": F.lit(0)})
    loosen = None
    for turn in range(rounds + 1):
        out = f"vec_id struct<id:{kind},scans:int>, v array<int>, cluster int, bound double, distance long, scanned boolean"
        done = state.select(F.struct(F.col("vec_id").alias("id"), "scans").alias("vec_id"), "v", "cluster", "bound").mapInArrow(_step(now, loosen), out)
        scans = F.col("vec_id.scans") + F.col("scanned").cast("int")
        last = state if turn else rows
        state = scratch.write(done.select(F.col("vec_id.id").alias("vec_id"), *([] if turn == rounds else ["v", "bound"]), "cluster", "distance", scans.alias("scans")))
        scratch.drop(last)
        sums = [] if turn == rounds else [F.sum(F.col("v")[i]).alias(f"s{i}") for i in range(dim)]
        found = state.groupBy("cluster").agg(F.count("*").alias("n"), F.sum("distance").alias("inertia"), F.max("distance").alias("most"), *sums).toArrow()
        at = found.column("cluster").to_numpy()
        if turn < rounds:
            radius = np.zeros(len(now))
            radius[at] = np.sqrt(found.column("most").to_numpy().astype(np.float64)) * (1 + MARGIN)
            nxt = now.copy()
            nxt[at] = np.stack([found.column(f"s{i}").to_numpy() for i in range(dim)], axis=1) // found.column("n").to_numpy()[:, None]
            loosen, now = drift_bounds(now, nxt, radius), nxt
    inertia = found.column("inertia").to_pylist()
    table = [(int(c), i, now[c].tolist()) for c, i in zip(at, inertia, strict=True)]
    totals = spark.createDataFrame(table, "cluster int, cluster_inertia long, centroid array<long>")
    out = state.join(F.broadcast(totals), "cluster")  # one row a centroid
    return out.select("vec_id", "cluster", "distance", "scans", "cluster_inertia", F.lit(sum(inertia)).cast("long").alias("inertia"), "centroid")


def centroid_digest(centroid: str = "centroid"):
    """SHA-256 of a centroid's components as decimal integers joined by commas."""
    return F.sha2(F.array_join(F.col(centroid).cast("array<string>"), ","), 256)
