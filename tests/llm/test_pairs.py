"""The Jaccard join and embedding near-duplicates against all pairs."""

from __future__ import annotations

import itertools
import random

import numpy as np
import pytest

from ratecraft.llm import components, jaccard_join
from ratecraft.llm.components import connected_components
from ratecraft.llm.common import Scratch
from ratecraft.llm.embedding_dedup import near_duplicates
from ratecraft.llm.jaccard_join import jaccard_classes, keep_one
from tests.llm import brute


def test_jaccard_equals_all_pairs(spark, make_docs, corpus):
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard_classes(make_docs(corpus)).collect()}
    expected = brute.jaccard(corpus)
    assert got == expected
    assert sum(c != i for i, (_, c) in expected.items()) > 20  # the fixture has groups


@pytest.mark.parametrize("width", [0, 2, 32])
def test_texts_of_common_passages_equal_all_pairs(make_docs, monkeypatch, width):
    """A line common to all, texts made of common passages, and edited copies around the threshold."""
    monkeypatch.setattr(components, "HOT_BUCKET", min(width, 16))
    monkeypatch.setattr(components, "WIDE_BUCKET", width)
    rng = random.Random(9)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(4))
    passage = lambda n: " ".join(word() for _ in range(n))
    line, passages, base = passage(40), [passage(30) for _ in range(8)], passage(150).split()
    docs = [f"{line}\n{passage(rng.randint(5, 60))}" for _ in range(40)]
    docs += [" ".join([line, *rng.sample(passages, 4)]) for _ in range(40)]
    for _ in range(60):
        w = list(base)
        for _ in range(rng.randint(0, 9)):
            w[rng.randrange(len(w))] = word()
        docs.append(f"{line}\n{' '.join(w)}")
    docs = list(enumerate(docs))
    expected = brute.jaccard(docs)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard_classes(make_docs(docs)).collect()}
    assert got == expected
    assert 5 < len({c for _, c in expected.values()}) < 130


def test_rarest_shingles_keep_a_shared_one(spark):
    rng = np.random.default_rng(4)
    sets = []
    for k in range(120):
        old = sets[rng.integers(len(sets))][1] if sets and rng.random() < 0.7 else rng.integers(0, 200, int(rng.integers(1, 60))).tolist()
        sets.append((k, sorted({x for x in old if rng.random() > 0.1} | set(rng.integers(0, 200, int(rng.integers(0, 4))).tolist()) or {1})))
    held = {}
    for r in jaccard_join.rarest_shingles(spark.createDataFrame(sets, "id long, grams array<long>")).collect():
        held.setdefault(r.id, set()).add(r.key)
    near = 0
    for (a, x), (b, y) in itertools.combinations(sets, 2):
        if 100 * len({*x} & {*y}) >= 80 * len({*x} | {*y}):
            near += 1
            assert held.get(a, set()) & held.get(b, set())
    assert near > 20


def test_one_of_each_group_stays(make_docs, corpus):
    docs = make_docs([*corpus, corpus[0], corpus[1], (None, "a b c d e f g")])
    out = keep_one(docs)
    assert out.columns == docs.columns
    got = [r.doc_id for r in out.collect()]
    assert sorted(x for x in got if x is not None) == sorted(i for i, (_, c) in brute.jaccard(corpus).items() if c == i)
    assert got.count(None) == 1


def test_null_ids_and_repeated_rows(make_docs):
    rows = [(5, "a b c d e f"), (5, "a b c d e f"), (3, "a b c d e f"), (None, "a b c d e f"), (None, None), (9, None)]
    got = sorted((r.doc_id is None, r.doc_id, r.n_shingles, r.component_id) for r in jaccard_classes(make_docs(rows)).collect() if r.doc_id is not None)
    assert got == [(False, 3, 2, 3), (False, 5, 2, 3), (False, 5, 2, 3), (False, 9, 0, 9)]
    nulls = sorted((r.n_shingles, r.component_id) for r in jaccard_classes(make_docs(rows)).collect() if r.doc_id is None)
    assert nulls == [(0, None), (2, 3)]


@pytest.mark.parametrize("seed", range(4))
def test_similar_sets_share_a_key(seed):
    """The pigeonhole itself, for sizes of all bands and with the fewest segments."""
    rng = np.random.default_rng(seed)
    for _ in range(300):
        n = int(rng.choice([1, 2, 3, 4, 5, 6, 8, 9, 12, 20, 50, 200, 900]))
        a = np.unique(rng.integers(0, 2**64, n, dtype=np.uint64))
        if rng.random() < 0.3:  # all in few segments, so the second allocation is needed
            a = np.unique((a >> np.uint64(20)) | (rng.integers(0, 3, len(a), dtype=np.uint64) << np.uint64(62)))
        keep = a[rng.random(len(a)) > rng.choice([0, 0.05, 0.1, 0.2])]
        b = np.unique(np.concatenate((keep, rng.integers(0, 2**64, int(rng.integers(0, 1 + n // 8)), dtype=np.uint64))))
        both = len(np.intersect1d(a, b))
        if len(b) and 100 * both >= 80 * (len(a) + len(b) - both):
            (ka, pa), (kb, pb) = jaccard_join.segment_keys(a), jaccard_join.segment_keys(b)
            shared, ia, ib = np.intersect1d(ka, kb, return_indices=True)
            assert len(shared)
            for plans in (pa[ia], pb[ib]):  # more shared keys than can be spared, in the band of the larger set
                plans = plans[plans >= 0]
                groups = plans // jaccard_join.SPARE
                if len(groups):
                    counts = {g: ((groups == g).sum(), plans[groups == g][0] % jaccard_join.SPARE) for g in set(groups.tolist())}
                    assert any(c > spare for c, spare in counts.values())
            wide = [jaccard_join.parity_bitmap(x, jaccard_join.wide_bits(len(x))).tobytes() for x in (a, b)]
            short = [jaccard_join.parity_bitmap(x, 256).tobytes() for x in (a, b)]
            assert max(jaccard_join._differing(*wide), jaccard_join._differing(*short)) <= len(a) + len(b) - 2 * both


def test_connected_components(spark):
    rng = np.random.default_rng(1)
    links = [(int(a), int(b)) for a, b in rng.integers(0, 300, (220, 2))] + [(1000 + k, 1001 + k) for k in range(60)]
    edges = spark.createDataFrame(links, "u long, v long")
    got = {r.node: r.comp for r in connected_components(edges, Scratch(spark, "test")).collect()}
    expected = brute.components({x for e in links for x in e}, links)
    assert got == {i: c for i, c in expected.items() if any(i in e and e[0] != e[1] for e in links)}


def test_components_not_at_rest_are_an_error(spark):
    chain = spark.createDataFrame([(k, k + 1) for k in range(40)], "u long, v long")
    with pytest.raises(RuntimeError, match="at rest"):
        connected_components(chain, Scratch(spark, "test"), max_rounds=1)


def test_embeddings_equal_all_pairs(spark):
    rng = np.random.default_rng(4)
    rows, at = [], 0
    for size in (1, 1, 2, 3, 40, 700):  # groups of near copies, one larger than a block
        base = rng.normal(size=16)
        for _ in range(size):
            rows.append([float(x) for x in base + rng.normal(size=16) * 0.05])
    rows += [rows[5]] * 4 + [[0.0] * 16, None, [], [float("nan")] * 16, [1.0] * 15 + [None], [float("inf")] + [1.0] * 15, [1.0, 0.0], [1.0, -0.0], [1e-200] * 16, [1e200] * 16]
    rng.shuffle(order := np.arange(len(rows)))
    data = [(int(i), rows[k], 1, 2) for i, k in enumerate(order)]
    df = spark.createDataFrame(data, "vec_id long, embedding array<double>, id int, key int")
    got = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in near_duplicates(df).collect()}

    def usable(v):
        return v and all(x is not None and np.isfinite(x) for x in v) and any(v)

    vec = {i: np.array(v) / np.abs(v).max() for i, v, *_ in data if usable(v)}
    vec = {i: v / np.sqrt((v * v).sum()) for i, v in vec.items()}
    ids = list(vec)
    links = [(a, b) for k, a in enumerate(ids) for b in ids[:k] if len(vec[a]) == len(vec[b]) and vec[a] @ vec[b] >= 0.95]
    comp = brute.components([r[0] for r in data], links)
    n = dict.fromkeys(comp, 0)
    for a, b in links:
        n[a] += 1
        n[b] += 1
    assert got == {i: (n[i], comp[i], comp[i] == i) for i in comp}


def test_empty_tables(spark, make_docs):
    assert jaccard_classes(make_docs([])).count() == 0
    assert near_duplicates(spark.createDataFrame([], "vec_id long, embedding array<float>")).count() == 0
