"""Quality and toxicity: held-out accuracy, parts against brute force, edge cases."""

from __future__ import annotations

import zlib

import numpy as np
import pytest

from ratecraft.llm import quality, toxicity
from tests.llm import brute
from tests.llm.conftest import DATA

EDGES = [(1, None), (2, ""), (3, " \n"), (4, "word"), (5, "Ä ö " * 30000), (6, "word"), (6, "word"), (None, "word word"), (7, "\n\n\n"), (8, "x" * 3_000_000)]


@pytest.fixture(scope="module")
def tables(spark):
    return spark.read.parquet(f"{DATA}/sf0.1/documents.parquet"), spark.read.parquet(f"{DATA}/sf0.1/labels.parquet")


@pytest.mark.parametrize(("module", "label"), [(quality, "quality"), (toxicity, "toxic")])
def test_held_out_accuracy_and_edges(tables, make_docs, module, label):
    docs, labels = tables
    model = module.fit(docs, labels)
    out = module.score_documents(docs, labels, model)
    rows = out.join(labels.dropDuplicates(["doc_id"]), "doc_id").select("doc_id", "held_out", "score", "predicted", label).collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % module.FOLDS == module.HELD_OUT) for r in rows)
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in rows)
    held = [r for r in rows if r.held_out]
    for value in (0, 1):
        own = [r.predicted == value for r in held if r[label] == value]
        assert np.mean(own) >= 0.9, (label, value, np.mean(own), len(own))
    # edge cases: every row is scored, repeated rows alike
    got = module.score_documents(make_docs(EDGES), labels, model).collect()
    assert len(got) == len(EDGES) and all(0 <= r.score <= 1 for r in got)
    assert len({r.score for r in got if r.doc_id == 6}) == 1
    assert not any(r.held_out for r in got if r.doc_id is None)
    if label == "toxic":
        assert not any(r.predicted for r in got)
        assert toxicity.score_documents(make_docs([]), labels, model).count() == 0


@pytest.mark.parametrize("module", [quality, toxicity])
def test_no_labels(spark, make_docs, module):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    got = module.score_documents(make_docs(EDGES[:4]), none).collect()
    assert len(got) == 4 and all(r.score == pytest.approx(0.5) for r in got)
    nulls = spark.createDataFrame([(None, 1, 1), (1, None, None), (2, 5, 5)], none.schema)
    assert module.score_documents(make_docs(EDGES[:4]), nulls).count() == 4


def test_segments_equal_brute_force():
    rng = np.random.default_rng(0)
    for _ in range(200):  # continuous scores: no ties, one answer
        s = rng.normal(-0.2, 1, rng.integers(0, 40))
        assert [(a, b) for a, b, _ in toxicity.segments(s)] == brute.maximal_segments(list(s))
    assert toxicity.segments(np.full(5, -1.0)) == []


def test_model_tables_give_the_boosted_scores():
    rng = np.random.default_rng(1)
    x = rng.normal(size=(3000, 4))
    y = ((x[:, 0] > 0) ^ (x[:, 1] > 0)).astype(float)  # an interaction that no single feature shows
    m = quality.train(x, y)
    p = quality.predict(m, x)
    assert np.mean((p > 0.5) == y) > 0.9
    assert (1, 0) in m.pairs
