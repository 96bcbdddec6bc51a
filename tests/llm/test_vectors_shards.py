"""Sharding, vector codes and centroid clustering against plain versions, on awkward tables."""

from __future__ import annotations

import hashlib
import itertools
import random
import zlib

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, IntegerType, LongType, StringType, StructField, StructType

from ratecraft.llm import clustering, vector_codes
from ratecraft.llm.clustering import assign, centroid_digest, cluster_vectors, drift_bounds
from ratecraft.llm.queries import ORACLES, QUERIES
from ratecraft.llm.sharding import range_shards, shard_documents, write_shards
from ratecraft.llm.vector_codes import codebooks_digest, compress_vectors, nearest, sequency, walsh
from tests.llm.conftest import DATA

SF = f"{DATA}/sf0.001"


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_queries_equal_their_sql(spark, name):
    got = QUERIES[name](spark, SF)
    con = duckdb.connect()
    for t in ("documents", "embeddings"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    res = con.execute(f"SELECT {', '.join(got.columns)} FROM ({ORACLES[name]})").fetchall()
    assert sorted(map(str, map(tuple, got.collect()))) == sorted(map(str, res)) and res


# -- sharding ----------------------------------------------------------------


def plain_shards(docs, shards):
    """Multiset of (doc_id, text, shard, slot)."""
    def key(d):
        i, t = d
        return (hashlib.md5((t or "").encode()).digest(), i is not None, i or 0)

    size = lambda t: len((t or "").encode()) + 1
    total, upto, out, slots = sum(size(t) for _, t in docs), 0, [], {}
    for i, t in sorted(docs, key=key):
        upto += size(t)
        s = min(shards - 1, (2 * upto - size(t)) * shards // (2 * total))
        out.append((i, size(t), s, slots.get(s, 0)))
        slots[s] = slots.get(s, 0) + 1
    return out


def shard_rows(df):
    return sorted(((r.doc_id, r.size, r.shard, r.slot) for r in df.collect()), key=str)


@pytest.mark.parametrize("bounds", [{}, {"max_rows": 20, "max_bytes": 5000}])
def test_shards_equal_plain_ones(make_docs, corpus, bounds):
    # a hot text, repeated rows, null ids, null and empty texts, a very long text
    hot = [(5000 + k, "the same text again") for k in range(200)]
    docs = corpus + hot + [(7, "repeated row")] * 90 + [(None, "no id")] * 3 + [(None, None)] * 40
    out = shard_documents(make_docs(docs), 8, **bounds)
    assert shard_rows(out) == sorted(plain_shards(docs, 8), key=str)
    # other columns stay; a column named size is replaced
    assert out.columns == [*[c for c in make_docs(docs[:1]).columns], "shard", "slot"]


def test_shards_are_near_equal_and_gapless(make_docs, corpus):
    docs = [(i, t) for i, t in corpus if len(t or "") < 5000]
    rows = shard_documents(make_docs(docs), 4, max_rows=10).collect()
    size = {s: sum(r.size for r in rows if r.shard == s) for s in range(4)}
    assert max(size.values()) - min(size.values()) <= 2 * max(r.size for r in rows)
    for s in range(4):
        assert sorted(r.slot for r in rows if r.shard == s) == list(range(sum(r.shard == s for r in rows)))


def test_shards_of_few_and_no_rows(make_docs):
    assert shard_documents(make_docs([])).collect() == []
    assert [(r.shard, r.slot) for r in shard_documents(make_docs([(1, "a")])).collect()] == [(4, 0)]
    assert [(r.shard, r.slot) for r in shard_documents(make_docs([(1, None), (1, None)]), 1).collect()] == [(0, 0), (0, 1)]


def test_any_key_and_written_shards(spark, make_docs, corpus, tmp_path):
    out = range_shards(make_docs(corpus), [-F.col("doc_id")], F.lit(1), 3)
    got = sorted((r.shard, r.slot, r.doc_id) for r in out.collect())
    assert [d for _, _, d in got] == sorted((i for i, _ in corpus), reverse=True)
    write_shards(make_docs(corpus), str(tmp_path / "out"), 4)
    back = spark.read.parquet(str(tmp_path / "out"))
    assert sorted((r.doc_id, r.text, r.shard, r.slot) for r in back.collect() if r.text) == sorted(
        (r.doc_id, r.text, r.shard, r.slot) for r in shard_documents(make_docs(corpus), 4).collect() if r.text
    )


def test_crc_and_sizes(spark):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    for r in QUERIES["op11_sharding"](spark, SF).collect():
        assert (r.size, r.text_crc32) == (len(docs[r.doc_id].encode()) + 1, zlib.crc32(docs[r.doc_id].encode()))


# -- vectors -----------------------------------------------------------------

VECTORS = StructType(
    [
        StructField("vec_id", LongType()),
        StructField("embedding", ArrayType(DoubleType())),
        StructField("label", IntegerType()),
        *(StructField(c, StringType()) for c in ("v", "row", "cluster", "distance", "codes", "error", "n", "id")),
    ]
)


@pytest.fixture(scope="module")
def awkward(spark):
    rng = random.Random(5)
    rows = [(k, [rng.choice((-1, -0.5, 0.0, 0.25, 1, 3)) + rng.random() * rng.choice((0, 1)) for _ in range(64)], rng.choice((None, 1, 2))) for k in range(150)]
    rows += [(1000 + k, list(rows[3][1]), 2) for k in range(60)]  # copies
    rows += [rows[4]] * 3 + [(None, list(rows[5][1]), None), (None, list(rows[6][1]), 1)]
    bad = [(2000, None, 1), (2001, [], 1), (2002, [1.0] * 10, 1), (2003, [float("nan")] * 64, 1), (2004, [float("inf")] + [0.0] * 63, None)]
    bad += [(2005, [None] + [0.0] * 63, 1), (2006, [1e300] * 64, 1), (-5, None, 1)]
    return rows, spark.createDataFrame([(*r, *"abcdefgh") for r in rows + bad], VECTORS)


def order(rows):
    return sorted(range(len(rows)), key=lambda i: (rows[i][0] is None, rows[i][0] or 0, [np.floor(256 * x) for x in rows[i][1]]))


def test_codes_equal_plain_ones(awkward):
    rows, table = awkward
    v = np.floor(256 * np.array([r[1] for r in rows])).astype(int).reshape(len(rows), 16, 4)
    books = v[order(rows)[:64]].transpose(1, 0, 2).copy()

    def near():
        d = ((v.transpose(1, 0, 2)[:, :, None] - books[:, None]) ** 2).sum(3)
        return d.argmin(2).T, d.min(2).sum(0)

    for _ in range(2):
        code, _ = near()
        for p, e in itertools.product(range(16), range(64)):
            own = v[code[:, p] == e, p]
            if len(own):
                books[p, e] = [int(s) // len(own) for s in own.sum(0)]
    code, error = near()
    labels = {x: sum(int(e) for e, r in zip(error, rows, strict=True) if r[2] == x) for x in (None, 1, 2)}
    expected = [(r[0], bytes(c.tolist()), int(e), labels[r[2]], codebooks_digest(books)) for r, c, e in zip(rows, code, error, strict=True)]
    got = [(r.vec_id, bytes(r.codes), r.error, r.label_error, r.codebooks_sha256) for r in compress_vectors(table).collect()]
    assert sorted(got, key=str) == sorted(expected, key=str)


def test_codes_with_many_labels(awkward, monkeypatch):
    _, table = awkward
    few = sorted(map(str, compress_vectors(table).collect()))
    monkeypatch.setattr(vector_codes, "BROADCAST_LABELS", 0)
    assert sorted(map(str, compress_vectors(table).collect())) == few


def test_empty_vector_tables(spark, awkward):
    _, table = awkward
    for t in (table.limit(0), table.filter("vec_id = 2000")):
        assert compress_vectors(t).collect() == [] and cluster_vectors(t).collect() == []
    few = table.filter("vec_id < 3 and vec_id >= 0")
    assert {r.error for r in compress_vectors(few).collect()} == {0}
    assert {r.distance for r in cluster_vectors(few).collect()} == {0}


def test_transform_is_exact_and_in_sequency_order():
    for n in (1, 2, 4, 16, 64):
        h = walsh(np.eye(n, dtype=np.int64)).T  # rows: functions in order
        assert [int((np.diff(f) != 0).sum()) for f in h] == list(range(n))
        assert (h @ h.T == n * np.eye(n, dtype=int)).all() and sorted(sequency(n)) == list(range(n))


def test_search_equals_scan_with_ties():
    rng = np.random.default_rng(3)
    for width, entries, spread in itertools.product((1, 3, 4, 5, 24), (1, 2, 64), (2, 1000, 1 << 26)):
        parts, books = rng.integers(-spread, spread, (300, width)), rng.integers(-spread, spread, (entries, width))
        books[entries // 2 :] = books[: entries - entries // 2]  # ties everywhere
        parts[:entries] = books
        d = ((parts[:, None].astype(object) - books[None].astype(object)) ** 2).sum(2)
        code, far = nearest(parts, books)
        assert far.tolist() == d.min(1).tolist() and code.tolist() == [r.tolist().index(min(r)) for r in d]


def plain_clusters(rows, k, rounds):
    v = np.floor(64 * np.array([r[1] for r in rows])).astype(int)
    ints = v.tolist()
    first = sorted(range(len(rows)), key=lambda i: (rows[i][0] is None, hashlib.sha256(f"1:{rows[i][0]}".encode()).hexdigest() if rows[i][0] is not None else "", ints[i]))
    c = v[first[:k]].copy()
    for turn in range(rounds + 1):
        d = ((v[:, None] - c[None]) ** 2).sum(2)
        own = d.argmin(1)
        if turn < rounds:
            for j in range(k):
                if (own == j).any():
                    c[j] = [int(s) // int((own == j).sum()) for s in v[own == j].sum(0)]
    return [(r[0], int(j), int(x)) for r, j, x in zip(rows, own, d.min(1), strict=True)], c


@pytest.mark.parametrize(("k", "rounds"), [(16, 3), (5, 12), (1, 2), (40, 0)])
def test_clusters_equal_plain_ones(awkward, k, rounds):
    rows, table = awkward
    expected, c = plain_clusters(rows, k, rounds)
    got = cluster_vectors(table, k, rounds).withColumn("digest", centroid_digest()).collect()
    assert sorted(((r.vec_id, r.cluster, r.distance) for r in got), key=str) == sorted(expected, key=str)
    for r in got:
        assert r.centroid == c[r.cluster].tolist() and r.inertia == sum(x for _, _, x in expected)
        assert r.cluster_inertia == sum(x for _, j, x in expected if j == r.cluster)
        assert r.digest == hashlib.sha256(",".join(map(str, r.centroid)).encode()).hexdigest()


def test_bounds_spare_scans_of_separated_groups(spark):
    rng = np.random.default_rng(1)
    centre = rng.normal(0, 4, (6, 64))
    rows = [(i, (centre[i % 6] + rng.normal(0, 0.3, 64)).tolist(), 0, *"abcdefgh") for i in range(600)]
    got = cluster_vectors(spark.createDataFrame(rows, VECTORS), 6, 6).collect()
    expected, _ = plain_clusters([r[:3] for r in rows], 6, 6)
    assert sorted((r.vec_id, r.cluster, r.distance) for r in got) == sorted(expected)
    assert sum(r.scans for r in got) < 0.7 * 7 * len(rows)


def test_drift_bound_holds_and_is_below_full_drift():
    rng = np.random.default_rng(2)
    tighter = 0
    for _ in range(300):
        n, k = int(rng.choice((2, 3, 8))), 4
        old = rng.integers(-100, 100, (k, n))
        new = old + rng.integers(-30, 30, (k, n))
        radius = rng.uniform(0, 60, k)
        bound = drift_bounds(old, new, radius)
        for i in range(k):
            x = rng.normal(size=(200, n))
            x = old[i] + x / np.linalg.norm(x, axis=1, keepdims=True) * radius[i] * rng.uniform(0, 1, (200, 1)) ** 0.2
            near = lambda c: np.linalg.norm(x[:, None] - np.delete(c, i, 0)[None], axis=2)  # noqa: B023, E731
            assert (near(old) - near(new)).max() <= bound[i] + 1e-9
            full = np.linalg.norm(np.delete(new - old, i, 0), axis=1).max()
            assert bound[i] <= full + 1e-6
            tighter += bound[i] < 0.9 * full
    assert tighter > 200


def test_scan_prefers_smaller_numbers():
    v = np.array([[0, 0], [2, 2]])
    cluster, own, bound = assign(v, np.array([[1, 1], [1, 1], [1, 1]]))
    assert cluster.tolist() == [0, 0] and own.tolist() == [2, 2] and (bound <= np.sqrt(2)).all()
    assert clustering.assign(v, np.array([[0, 1]]))[2].tolist() == [np.inf, np.inf]
