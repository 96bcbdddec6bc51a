from __future__ import annotations

import random

import pytest
from pyspark.sql.types import DoubleType, IntegerType, LongType, StringType, StructField, StructType

DATA = "/root/testdata"

DOC_SCHEMA = StructType(
    [
        StructField("doc_id", LongType()),
        StructField("text", StringType()),
        StructField("lang", StringType()),
        StructField("source", StringType()),
        StructField("n_chars", LongType()),
        # names that operators use themselves
        *(StructField(c, IntegerType()) for c in ("id", "key", "size", "hash", "label", "comp", "pos", "words", "n_removed")),
        StructField("score", DoubleType()),
    ]
)


@pytest.fixture(scope="session")
def make_docs(spark):
    def make(rows):
        """A documents table of (doc_id, text) pairs with extra, clashing columns."""
        return spark.createDataFrame([(i, t, "en", "s", len(t or ""), *[7] * 9, 0.5) for i, t in rows], DOC_SCHEMA)

    return make


@pytest.fixture(scope="session")
def corpus():
    """Documents of every kind that dedup meets: (doc_id, text)."""
    rng = random.Random(3)
    word = lambda: "".join(rng.choice("aeioust") for _ in range(rng.randint(2, 7)))
    line = lambda n: " ".join(word() for _ in range(n))
    text = lambda k: "\n".join(line(rng.randint(1, 14)) for _ in range(k))
    passage = [line(60), "\n".join(line(12) for _ in range(8)), "\n".join([line(20), line(55), line(9)])]
    common = line(9)
    docs = [None, "", " \t\n ", "One", "one", "ONE two", "a b c d", "a b c d e", "Ä b c d e f", "a\tb\nc\x0bd\x0ce\rf"]
    docs += [text(rng.randint(2, 12)) for _ in range(30)]
    docs += [f"{text(3)}\n{rng.choice(passage)}\n{text(3)}" for _ in range(15)]
    docs += [f"{common}\n{text(rng.randint(1, 5))}" for _ in range(30)]
    base = text(12)
    docs += [base] * 6
    for _ in range(40):  # copies with some words replaced: similarities around 0.8
        w = base.split(" ")
        for _ in range(rng.randint(0, 5)):
            w[rng.randrange(len(w))] = word()
        docs.append(" ".join(w))
    docs.append(text(4000))  # very long
    docs.append("x" * 70000 + " " + line(30))
    rng.shuffle(docs)
    return list(enumerate(docs))
