"""The pipeline against its plain stages, and its registration."""

from __future__ import annotations

import hashlib

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

import __spark_entry__
import corpus_pipeline
from ratecraft.llm import toxicity
from tests.llm import brute
from tests.llm.conftest import DATA
from tests.llm.test_text import boundary


def holds(text, item):
    """Whether a text has 80 % of an item's five-word windows (no slots in either)."""
    import regex

    words = lambda t: regex.findall(r"[\p{L}\p{N}]+", (t or "").lower())
    grams = lambda w: {tuple(w[k : k + 5]) for k in range(len(w) - 4)}
    own = grams(words(item))
    return bool(own) and 100 * len(own & grams(words(text))) >= 80 * len(own)


def test_pipeline_equals_plain_stages(spark, make_docs, corpus, tmp_path):
    item = "the quick brown fox jumps over the lazy dog near a quiet river bank at dawn every single day"
    rows = [*corpus, (1000, f"before\n{item}\nafter"), (1001, "you idiot loser moron trash scum " * 3), (1002, item.replace("fox", "cat"))]
    docs = make_docs(rows)
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    # labels and texts to learn from: those of the test tables, under other ids
    learn = spark.read.parquet(f"{DATA}/sf0.01/documents.parquet").select((spark_col("doc_id") + 10_000).alias("doc_id"), "text", "lang", "source", "n_chars")
    extra = [c for c in docs.columns if c not in learn.columns]
    learn.selectExpr("*", *(f"cast(null as {docs.schema[c].dataType.simpleString()}) `{c}`" for c in extra)).select(docs.columns).write.mode("append").parquet(f"{tmp_path}/documents.parquet")
    spark.read.parquet(f"{DATA}/sf0.01/labels.parquet").selectExpr("doc_id + 10000 doc_id", "quality", "toxic").write.parquet(f"{tmp_path}/labels.parquet")

    got = {r.doc_id: (r.n_tokens, r.ids_sha256) for r in corpus_pipeline.run(spark, str(tmp_path)).collect()}

    every = spark.read.parquet(f"{tmp_path}/documents.parquet")
    scored = toxicity.score_documents(every, spark.read.parquet(f"{tmp_path}/labels.parquet"))
    toxic = {r.doc_id for r in scored.filter("predicted = 1").collect()}
    assert 1001 in toxic
    texts = [(r.doc_id, r.text) for r in every.collect() if r.doc_id not in toxic]
    deduped = brute.line_dedup(texts, boundary)
    before = dict(texts)
    texts = [(i, t) for i, t in deduped.items() if t == before[i] or t.replace("\n", " ").strip(" ")]
    texts = [(i, t) for i, t in texts if brute_groups(texts)[i] == i]
    bench = spark.read.parquet(f"{tmp_path}/benchmark.parquet").collect()
    texts = [(i, t) for i, t in texts if not any(holds(t, b.text) for b in bench)]
    t = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    expected = {}
    for i, x in texts:
        ids = t.encode(x or "", add_special_tokens=False).ids
        expected[i] = (len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest())
    assert got == expected
    assert 1000 not in got and 1001 not in got


def spark_col(name):
    from pyspark.sql import functions as F

    return F.col(name)


_GROUPS: dict[int, dict[int, int]] = {}


def brute_groups(texts):
    """Components by all pairs that share a shingle (computed once)."""
    if id(texts) not in _GROUPS:
        sets, index, links = {i: brute.shingles(t) for i, t in texts}, {}, set()
        for i, s in sets.items():
            for g in s:
                index.setdefault(g, []).append(i)
        for ids in index.values():
            links |= {(a, b) for k, a in enumerate(ids) for b in ids[:k]}
        links = [(a, b) for a, b in links if 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])]
        _GROUPS[id(texts)] = brute.components(sets, links)
    return _GROUPS[id(texts)]


def test_registration():
    names = list(__spark_entry__.queries())
    for n in range(1, 11):
        assert sum(x.startswith(f"op{n}_") for x in names) == 1
    assert "pipeline" in names
    assert [k for k, _ in corpus_pipeline.STAGES] == ["toxicity", "line_dedup", "jaccard_join", "decontamination", "bpe"]
