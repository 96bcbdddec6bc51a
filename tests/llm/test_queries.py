"""The registered queries over the smallest test tables, against plain versions."""

from __future__ import annotations

import hashlib
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from ratecraft.llm.queries import QUERIES
from tests.llm import brute
from tests.llm.conftest import DATA
from tests.llm.test_pipeline import brute_groups, holds
from tests.llm.test_text import boundary

SF = f"{DATA}/sf0.001"


@pytest.fixture(scope="module")
def documents(spark):
    return [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]


def run(spark, name):
    (found,) = (f for k, f in QUERIES.items() if k.startswith(f"{name}_"))
    return found(spark, SF).collect()


def test_op1(spark):
    rows = run(spark, "op1")
    assert len(rows) == spark.read.parquet(f"{SF}/pages.parquet").count()
    for r in rows:
        allow = [x for x in ("com/", "www.example.com/en/") if r.rule == x]
        assert r.verdict == ("allow" if allow else "block") or r.rule is None


def test_op2(spark, documents):
    t = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    expected = set()
    for i, x in documents:
        ids = t.encode(x, add_special_tokens=False).ids
        back = t.decode(ids, skip_special_tokens=False)
        expected.add((i, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(back.encode()).hexdigest()))
    assert {tuple(r) for r in run(spark, "op2")} == expected


@pytest.mark.parametrize(("name", "folds", "held"), [("op3", 5, 0), ("op4", 4, 2)])
def test_op3_op4(spark, documents, name, folds, held):
    rows = run(spark, name)
    assert sorted(r.doc_id for r in rows) == sorted(i for i, _ in documents)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % folds == held) for r in rows)
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in rows)


def test_op5(spark, documents):
    assert {r.doc_id: r.text for r in run(spark, "op5")} == brute.line_dedup(documents, boundary)


def test_op7(spark):
    rows = spark.read.parquet(f"{SF}/embeddings.parquet").collect()
    x = np.array([r.embedding for r in rows], float)
    x /= np.sqrt((x * x).sum(1, keepdims=True))
    links = [(rows[a].vec_id, rows[b].vec_id) for a, b in zip(*np.nonzero(np.triu(x @ x.T >= 0.95, 1)), strict=True)]
    comp = brute.components([r.vec_id for r in rows], links)
    n = {i: sum(i in e for e in links) for i in comp}
    assert {tuple(r) for r in run(spark, "op7")} == {(i, n[i], comp[i], comp[i] == i) for i in comp}


def test_op8(spark, documents):
    t = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    start, expected = 0, []
    for i, x in sorted(documents):
        ids = np.array([*t.encode(x, add_special_tokens=False).ids, 2], "<u4")
        expected.append((i, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    assert sorted(map(tuple, run(spark, "op8"))) == expected


def test_op9(spark, documents):
    bench = spark.read.parquet(f"{SF}/benchmark.parquet").collect()
    expected = {(i, b.item_id) for i, x in documents for b in bench if holds(x, b.text)}
    assert {(r.doc_id, r.item_id) for r in run(spark, "op9")} == expected and expected


def test_op10(spark, documents):
    groups = brute_groups(documents)
    expected = {(i, len(brute.shingles(x)), groups[i]) for i, x in documents}
    assert {tuple(r) for r in run(spark, "op10")} == expected
