"""Toxicity by maximum-scoring segments of token log-odds, calibrated by extreme values.

1. Token counts, in documents, over the toxic and the clean training rows and,
   for tokens that stand out there, over the whole corpus (the informative part
   of the Dirichlet prior). Tokens
   are words (runs of letters, digits and non-ASCII bytes; A-Z lower-cased) and,
   as a back-off for words not seen in training, four-byte word beginnings.
2. Weight of a token: the log-odds of the two classes under the prior, brought
   towards zero by two standard deviations; a word scores the sum of its two
   tokens less DRIFT, so unrelated text drifts downwards.
3. All maximal scoring segments of a document in one linear scan (a stack of
   candidate segments with pointers to the last one that began lower).
4. Clean training rows that step 2 didn't see give the tail of segment scores
   (peaks over a threshold): K * n * exp(-rate * score) segments of at least
   that score are expected in n words of clean text. The best, second and third
   segments give Poisson p-values; the smallest one, corrected for the three
   looks, becomes a probability by its Bayes-factor bound and the prevalence.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ratecraft.llm.common import Scratch, bloom_has, bloom_of, bounded_batches, fold_table, nonword_table, word_hashes
from ratecraft.llm.labels import fold, training_labels

FOLDS, HELD_OUT = 4, 2
HEAD_BYTES = 4
PRIOR_TOKENS = 500.0  # weight of the corpus in the prior, in tokens
FLAT_PRIOR = 0.5
SHRINK = 2.0  # standard deviations
DRIFT = 0.3
TAIL_FROM = 1.0
#: Tokens of the largest weights that a model keeps (12 bytes each, sent to every task).
MODEL_TOKENS = 200_000
PREDICT = 0.3


@dataclass
class Model:
    keys: np.ndarray  # sorted token hashes
    weights: np.ndarray
    rate: float
    k: float
    prevalence: float


def document_tokens(column: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(row, word hashes, word-beginning hashes) of each text."""
    for first, offsets, words, heads in word_hashes(column, nonword_table(), fold_table(), HEAD_BYTES):
        heads = heads ^ np.uint64(0x5BD1E995)  # a word of four bytes and a beginning are two tokens
        for r in range(len(offsets) - 1):
            s = slice(offsets[r], offsets[r + 1])
            yield first + r, words[s], heads[s]


def _summed(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """Sums of count rows by token, for (tokens, (rows, counts)) pairs."""
    keys = np.concatenate([p[0] for p in parts])
    counts = np.concatenate([p[1] for p in parts])
    order = np.argsort(keys, kind="stable")
    keys, counts = keys[order], counts[order]
    start = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1])))
    return keys[start], np.add.reduceat(counts, start, axis=0)


def _counting(names: list[str], count, most: int = 250_000):
    """Sums rows of ``count(batch)`` by token within a task, as far as memory allows.

    count yields (tokens, (rows, columns) counts).
    """

    def batch(part):
        columns = (np.ascontiguousarray(part[1][:, k]) for k in range(len(names) - 1))
        return pa.RecordBatch.from_arrays([part[0].view(np.int64), *columns], names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, size = [], 0
        for b in batches:
            for tokens, counts in count(b):
                if not len(tokens):
                    continue
                parts.append((tokens, counts))
                size += len(tokens)
                if size > 2 * most:
                    parts = [_summed(parts)]
                    size = len(parts[0][0])
                    if size > most:
                        yield batch(parts.pop())
                        size = 0
        if parts:
            yield batch(_summed(parts))

    return run


def _labelled(b: pa.RecordBatch) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Documents of each class by token, of rows (label, text)."""
    labels = b.column(0).to_numpy()
    for row, words, heads in document_tokens(b.column(1)):
        own = np.unique(np.concatenate((words, heads)))
        yield own, np.broadcast_to(np.array([labels[row] == 1, labels[row] == 0], np.int64), (len(own), 2))


TOTAL = np.uint64(1)  # the token under which all of a task's tokens are counted


def _corpus(bloom: np.ndarray):
    """Documents by token, of rows (text), for tokens that the filter may hold."""

    def count(b: pa.RecordBatch) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        total = 0
        for _, words, heads in document_tokens(b.column(0)):
            own = np.unique(np.concatenate((words, heads)))
            total += len(own)
            own = own[bloom_has(bloom, own.view(np.int64))]
            yield own, np.ones((len(own), 1), np.int64)
        yield np.array([TOTAL]), np.array([[total]], np.int64)

    return count


def segments(scores: np.ndarray) -> list[tuple[int, int, float]]:
    """All maximal scoring segments (start, end, score), in order; linear time."""
    at = np.flatnonzero(scores > 0)
    if not len(at):
        return []
    total = np.concatenate(([0.0], np.cumsum(scores)))
    lows, highs, begins, ends, lower = [], [], [], [], []
    for i in at.tolist():
        low, high, begin = total[i], total[i + 1], i
        while True:
            j = len(lows) - 1
            while j >= 0 and lows[j] >= low:
                j = lower[j]
            if j < 0 or highs[j] >= high:
                break
            low, begin = lows[j], begins[j]  # joins what stands from segment j on
            del lows[j:], highs[j:], begins[j:], ends[j:], lower[j:]
        lows.append(low)
        highs.append(high)
        begins.append(begin)
        ends.append(i + 1)
        lower.append(j)
    return [(b, e, float(h - lo)) for b, e, h, lo in zip(begins, ends, highs, lows, strict=True)]


def word_scores(keys: np.ndarray, weights: np.ndarray, words: np.ndarray, heads: np.ndarray) -> np.ndarray:
    out = np.full(len(words), -DRIFT)
    if len(keys):
        for tokens in (words, heads):
            at = np.minimum(np.searchsorted(keys, tokens), len(keys) - 1)
            out += np.where(keys[at] == tokens, weights[at], 0.0)
    return out


def _tail(keys: np.ndarray, weights: np.ndarray):
    """One row a document: words, segments over TAIL_FROM, and their excess."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            n, over, excess = [], [], []
            for _, words, heads in document_tokens(b.column(0)):
                high = [s - TAIL_FROM for _, _, s in segments(word_scores(keys, weights, words, heads)) if s > TAIL_FROM]
                n.append(len(words))
                over.append(len(high))
                excess.append(float(sum(high)))
            yield pa.RecordBatch.from_arrays([pa.array(n, pa.int64()), pa.array(over, pa.int64()), pa.array(excess, pa.float64())], ["n", "over", "excess"])

    return run


def fit(docs: DataFrame, labels: DataFrame) -> Model:
    """Learn token weights and the clean tail; labels of the held-out fold are not read."""
    scratch = Scratch(bounded_batches(docs).sparkSession, "toxicity")
    sample = training_labels(labels, "toxic", FOLDS, HELD_OUT)
    sample = scratch.write(sample.withColumn("tail", F.pmod(F.xxhash64("doc_id", F.lit(5)), F.lit(4)) == 0))
    learn = F.broadcast(sample.filter("not tail or label = 1").select("doc_id", "label"))  # at most TRAINING_ROWS
    seen = docs.select("doc_id", "text").join(learn, "doc_id").select("label", "text")
    seen = seen.mapInArrow(_counting(["token", "toxic", "clean"], _labelled), "token long, toxic long, clean long")
    counts = scratch.write(seen.groupBy("token").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean")))
    n_toxic, n_clean = (float(x or 0) for x in counts.agg(F.sum("toxic"), F.sum("clean")).first())
    if not n_toxic or not n_clean:
        return Model(np.zeros(0, np.uint64), np.zeros(0), 1.0, 1.0, 0.5)

    def log_odds(alpha, rest):
        """(log-odds, their standard deviation) under a prior of alpha for the token, rest in all."""
        toxic, clean = F.col("toxic") + alpha, F.col("clean") + alpha
        odds = F.log(toxic / (F.lit(n_toxic + rest) - toxic)) - F.log(clean / (F.lit(n_clean + rest) - clean))
        return odds, F.sqrt(1 / toxic + 1 / clean)

    # the corpus is counted for tokens whose odds stand out under the flat prior alone; it shrinks the others to zero
    odds, spread = log_odds(F.lit(FLAT_PRIOR), FLAT_PRIOR)
    likely = scratch.write(counts.filter(F.abs(odds) > spread))
    bloom = bloom_of(likely, "token", likely.count())
    everywhere = docs.select("text").mapInArrow(_counting(["token", "n"], _corpus(bloom)), "token long, n long")
    everywhere = scratch.write(everywhere.groupBy("token").agg(F.sum("n").alias("n")))
    n_all = float(everywhere.filter(F.col("token") == int(TOTAL)).agg(F.sum("n")).first()[0] or 1)
    odds, spread = log_odds(F.lit(PRIOR_TOKENS) * F.coalesce("n", F.lit(0)) / F.lit(n_all) + F.lit(FLAT_PRIOR), PRIOR_TOKENS + FLAT_PRIOR)
    weight = F.signum(odds) * F.greatest(F.lit(0.0), F.abs(odds) - F.lit(SHRINK) * spread)
    kept = (
        likely.join(everywhere, "token", "left")
        .select("token", weight.alias("weight"))
        .filter("abs(weight) > 0.05")
        .orderBy(F.abs("weight").desc(), "token")
        .limit(MODEL_TOKENS)
        .toArrow()
    )
    keys = kept.column("token").to_numpy().view(np.uint64)
    order = np.argsort(keys)
    keys, weights = keys[order], kept.column("weight").to_numpy()[order]
    scratch.keep(sample)

    tail = F.broadcast(sample.filter("tail and label = 0").select("doc_id"))
    seen = docs.select("doc_id", "text").join(tail, "doc_id", "left_semi").select("text")
    got = seen.mapInArrow(_tail(keys, weights), "n long, over long, excess double").agg(F.sum("n"), F.sum("over"), F.sum("excess")).first()
    words, over, excess = (float(x or 0) for x in got)
    rate = (over + 1) / (excess + 1)  # one segment of unit excess more than was seen
    k = (over + 1) / (words + 1) * math.exp(rate * TAIL_FROM)
    share = sample.agg(F.avg("label")).first()[0]
    scratch.keep()
    return Model(keys, weights, rate, k, float(share))


def calibrated(found: list[tuple[int, int, float]], n: int, m: Model) -> float:
    """Probability that a text of n words with these segments is toxic."""
    best = sorted((s for _, _, s in found if s > TAIL_FROM), reverse=True)[:3]  # the tail begins there
    p = 1.0
    for r, s in enumerate(best, 1):
        e = m.k * n * math.exp(-min(700.0, m.rate * s))
        # probability of r segments or more when e are expected, safe for tiny e
        tail = -math.expm1(-e) if r == 1 else max(0.0, 1 - math.exp(-e) * sum(e**i / math.factorial(i) for i in range(r))) if e > 1e-3 else e**r / math.factorial(r)
        p = min(p, 3 * tail)
    p = max(p, 1e-300)
    bayes = -math.e * p * math.log(p) if p < 1 / math.e else 1.0
    return m.prevalence / (m.prevalence + (1 - m.prevalence) * bayes)


def _score(m: Model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("score", pa.float64())]))
        for b in batches:
            scores, passages = [], []
            for _, words, heads in document_tokens(b.column(1)):
                found = segments(word_scores(m.keys, m.weights, words, heads))
                scores.append(calibrated(found, len(words), m))
                high = [f for f in found if f[2] > TAIL_FROM and m.k * len(words) * math.exp(-min(700.0, m.rate * f[2])) < 0.05]
                passages.append([{"start": s, "end": e, "score": x} for s, e, x in high])
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(scores, pa.float64()), pa.array(passages, kind)], ["doc_id", "score", "passages"]
            )

    return run


def score_documents(docs: DataFrame, labels: DataFrame, model: Model | None = None) -> DataFrame:
    """Per document: doc_id, held_out, score, predicted, passages.

    passages are the significant toxic segments (word positions, score). A null
    or empty text has no segments and scores the prevalence at most, so 0 is
    predicted. A null doc_id is never held out. Repeated rows stay, an empty
    table gives an empty result; without training rows of both classes every
    score is 0.5. labels, lang, source and doc_id are no inputs of a score.
    """
    m = model or fit(docs, labels)
    out = bounded_batches(docs).select("doc_id", "text").mapInArrow(
        _score(m), "doc_id long, score double, passages array<struct<start:int,end:int,score:double>>"
    )
    held = F.coalesce(fold("doc_id", FOLDS) == HELD_OUT, F.lit(False))
    return out.select("doc_id", held.alias("held_out"), "score", (F.col("score") >= PREDICT).cast("int").alias("predicted"), "passages")


def _keep_clean(m: Model, at: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            good = np.ones(b.num_rows, bool)
            for row, words, heads in document_tokens(b.column(at)):
                found = segments(word_scores(m.keys, m.weights, words, heads))
                good[row] = calibrated(found, len(words), m) < PREDICT
            yield b.filter(pa.array(good))

    return run


def drop_toxic(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Documents that aren't predicted toxic, with all their columns; texts without words stay."""
    m = fit(docs, labels)
    if not len(m.keys):
        return docs
    return docs.mapInArrow(_keep_clean(m, docs.columns.index("text")), docs.schema)
