"""Quality by a generalised additive model with pairwise interactions.

Features are shares and counts of a text's bytes, words and lines. Each is cut
into bins at its training quantiles. Boosting visits the features in turn,
round after round: a shallow tree on one feature fits the log-loss gradient
summed by bin, and its leaf values are added to that feature's lookup table.
Then the pairs of features whose best 2 x 2 cut lowers the remaining loss most
get tables of their own, boosted the same way by cyclic passes. A score is a
sum of looked-up bins; it is computed for many documents by array additions.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ratecraft.llm.common import blank_table, bounded_batches, fold_table, groups_of, raw_text, word_hashes
from ratecraft.llm.labels import TRAINING_ROWS, fold, training_labels

FOLDS, HELD_OUT = 5, 0
PREDICT = 0.3
BINS = 32
ROUNDS, PAIR_ROUNDS, RATE = 60, 20, 0.2
PAIRS = 6
LEAST_ROWS = 5  # training rows of a tree's leaf
SMOOTH = 1.0

FEATURES = [
    "bytes", "upper", "digit", "blank", "line_end", "stop", "mark", "bar", "other",
    "words", "distinct", "top_word", "repeat", "word_bytes", "lines", "same_lines", "line_words",
]


def _byte_classes() -> np.ndarray:
    """Rows of 256 flags, one row a class of bytes (the features from upper to other)."""
    rows = {
        "upper": range(65, 91), "digit": range(48, 58), "blank": (32, 9), "line_end": (10, 13), "stop": b".,;:?'\"",
        "mark": b"!#$%&*+=@^~", "bar": b"|<>{}[]()/\\_", "other": range(128, 256),
    }
    out = np.zeros((len(rows), 256), bool)
    for i, r in enumerate(rows.values()):
        out[i, list(r)] = True
    return out


def features(column: pa.Array) -> np.ndarray:
    """(rows, features) of a text column; a null or empty text has zeros."""
    out = np.zeros((len(column), len(FEATURES)))
    classes = _byte_classes()
    data, offsets = raw_text(column)
    size = np.diff(offsets)
    out[:, 0] = np.log1p(size)
    for i, j in groups_of(offsets):
        lo, hi = offsets[i], offsets[j]
        rows = np.flatnonzero(size[i:j] > 0) + i
        if not len(rows):
            continue
        for at in range(lo, hi, 1 << 24) if j - i == 1 else [lo]:
            part = data[at : min(at + (1 << 24), hi)] if j - i == 1 else data[lo:hi]
            begin = (offsets[rows] - at).clip(0)
            for c, flags in enumerate(classes, 1):
                out[rows, c] += np.add.reduceat(flags[part], begin, dtype=np.int64)
    out[:, 1:9] /= np.maximum(size, 1)[:, None]
    newline = np.zeros(256, bool)
    newline[[10, 13]] = True
    for sep, base in ((blank_table(), 9), (newline, 14)):
        for first, off, h, _ in word_hashes(column, sep, fold_table()):
            for r in range(len(off) - 1):
                own = h[off[r] : off[r + 1]]
                n = len(own)
                if not n:
                    continue
                f = out[first + r]
                order = np.sort(own)
                new = np.flatnonzero(np.concatenate(([True], order[1:] != order[:-1], [True])))
                if base == 9:
                    f[9:14] = np.log1p(n), (len(new) - 1) / n, np.diff(new).max() / n, (own[1:] == own[:-1]).mean() if n > 1 else 0, size[first + r] / n
                else:
                    f[14:17] = np.log1p(n), 1 - (len(new) - 1) / n, np.expm1(f[9]) / n
    return out


@dataclass
class Model:
    start: float
    cuts: list[np.ndarray]
    tables: list[np.ndarray]
    pairs: list[tuple[int, int]]
    pair_tables: list[np.ndarray]


def _bin(x: np.ndarray, cuts: list[np.ndarray]) -> np.ndarray:
    return np.stack([np.searchsorted(c, x[:, j], "right") for j, c in enumerate(cuts)], axis=1)


def _shallow(g: np.ndarray, h: np.ndarray, n: np.ndarray, leaves: int = 3) -> np.ndarray:
    """Leaf values by bin of the best tree with so many leaves over ordered bins."""
    parts = [(0, len(g))]
    while len(parts) < leaves:
        best = (1e-9, None)
        for lo, hi in parts:
            cg, ch, cn = (np.cumsum(a[lo:hi]) for a in (g, h, n))
            if hi - lo < 2:
                continue
            gain = cg**2 / (ch + SMOOTH) + (cg[-1] - cg) ** 2 / (ch[-1] - ch + SMOOTH) - cg[-1] ** 2 / (ch[-1] + SMOOTH)
            gain[(cn < LEAST_ROWS) | (cn[-1] - cn < LEAST_ROWS)] = 0
            k = int(np.argmax(gain))
            if gain[k] > best[0]:
                best = (gain[k], (lo, lo + k + 1, hi))
        if best[1] is None:
            break
        lo, mid, hi = best[1]
        parts.remove((lo, hi))
        parts += [(lo, mid), (mid, hi)]
    out = np.zeros(len(g))
    for lo, hi in parts:
        out[lo:hi] = g[lo:hi].sum() / (h[lo:hi].sum() + SMOOTH)
    return out


def _best_quadrants(g: np.ndarray, h: np.ndarray) -> tuple[float, np.ndarray]:
    """Gain and values of the best cut of a 2-d table into four quadrants."""
    cg, ch = (a.cumsum(0).cumsum(1) for a in (g, h))

    def quarters(c):
        a = c[:-1, :-1]
        top, left, every = c[:-1, -1:], c[-1:, :-1], c[-1, -1]
        return a, top - a, left - a, every - top - left + a

    if min(g.shape) < 2:
        return 0.0, np.zeros_like(g)
    gain = sum(qg**2 / (qh + SMOOTH) for qg, qh in zip(quarters(cg), quarters(ch), strict=True))
    a, b = np.unravel_index(int(np.argmax(gain)), gain.shape)
    out = np.zeros_like(g)
    for rows, cols in ((slice(0, a + 1), slice(0, b + 1)), (slice(0, a + 1), slice(b + 1, None)), (slice(a + 1, None), slice(0, b + 1)), (slice(a + 1, None), slice(b + 1, None))):
        out[rows, cols] = g[rows, cols].sum() / (h[rows, cols].sum() + SMOOTH)
    return float(gain[a, b] - cg[-1, -1] ** 2 / (ch[-1, -1] + SMOOTH)), out


def train(x: np.ndarray, y: np.ndarray) -> Model:
    """Cyclic boosting of lookup tables on (rows, features) and 0/1 labels."""
    share = (y.sum() + 1) / (len(y) + 2)
    start = float(np.log(share / (1 - share)))
    cuts = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, BINS + 1)[1:-1])) if len(x) else np.zeros(0) for j in range(x.shape[1])]
    bins = _bin(x, cuts)
    tables = [np.zeros(len(c) + 1) for c in cuts]
    score = np.full(len(y), start)

    def slopes():
        p = 1 / (1 + np.exp(-score))
        return y - p, np.maximum(p * (1 - p), 1e-6)

    for _ in range(ROUNDS if 0 < y.sum() < len(y) else 0):
        for j, table in enumerate(tables):
            g, h = slopes()
            b, size = bins[:, j], len(table)
            step = RATE * _shallow(np.bincount(b, g, size), np.bincount(b, h, size), np.bincount(b, minlength=size))
            table += step
            score += step[b]
    pairs, pair_tables = [], []
    if 0 < y.sum() < len(y):
        g, h = slopes()

        def grid(i, j, v):
            shape = len(tables[i]), len(tables[j])
            return np.bincount(bins[:, i] * shape[1] + bins[:, j], v, shape[0] * shape[1]).reshape(shape)

        ranked = sorted(
            ((_best_quadrants(grid(i, j, g), grid(i, j, h))[0], i, j) for i in range(len(tables)) for j in range(i)), reverse=True
        )
        pairs = [(i, j) for gain, i, j in ranked[:PAIRS] if gain > 0]
        pair_tables = [np.zeros((len(tables[i]), len(tables[j]))) for i, j in pairs]
        for _ in range(PAIR_ROUNDS):
            for (i, j), table in zip(pairs, pair_tables, strict=True):
                g, h = slopes()
                step = RATE * _best_quadrants(grid(i, j, g), grid(i, j, h))[1]
                table += step
                score += step[bins[:, i], bins[:, j]]
    return Model(start, cuts, tables, pairs, pair_tables)


def predict(m: Model, x: np.ndarray) -> np.ndarray:
    """Probability of label 1: the sum of the bins' values, through the logistic function."""
    bins = _bin(x, m.cuts)
    s = np.full(len(x), m.start)
    for j, table in enumerate(m.tables):
        s += table[bins[:, j]]
    for (i, j), table in zip(m.pairs, m.pair_tables, strict=True):
        s += table[bins[:, i], bins[:, j]]
    return 1 / (1 + np.exp(-s))


def _features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        x = features(b.column(1))
        yield pa.RecordBatch.from_arrays([b.column(0), pa.array(list(x), pa.list_(pa.float64()))], ["label", "x"])


def fit(docs: DataFrame, labels: DataFrame) -> Model:
    """Train on at most TRAINING_ROWS labelled rows outside the held-out fold; only their features reach the driver."""
    sample = F.broadcast(training_labels(labels, "quality", FOLDS, HELD_OUT))
    rows = bounded_batches(docs).select("doc_id", "text").join(sample, "doc_id").select("label", "text")
    t = rows.mapInArrow(_features, "label int, x array<double>").limit(TRAINING_ROWS).toArrow()
    x = t.column("x").combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(-1, len(FEATURES))
    y = t.column("label").to_numpy().astype(float)
    order = np.lexsort((*x.T, y))  # the order in which rows arrive doesn't matter
    return train(x[order], y[order])


def _score(m: Model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(predict(m, features(b.column(1))))], ["doc_id", "score"])

    return run


def score_documents(docs: DataFrame, labels: DataFrame, model: Model | None = None) -> DataFrame:
    """Per document: doc_id, held_out, score, predicted.

    A null text counts as empty and is scored like any other. A null doc_id is
    never held out. Repeated rows stay and score alike; an empty table gives an
    empty result. Without training rows the score is 0.5, with rows of one
    class only it is near that class for every text. labels, lang, source,
    n_chars and doc_id are no inputs of a score.
    """
    m = model or fit(docs, labels)
    out = bounded_batches(docs).select("doc_id", "text").mapInArrow(_score(m), "doc_id long, score double")
    held = F.coalesce(fold("doc_id", FOLDS) == HELD_OUT, F.lit(False))
    return out.select("doc_id", held.alias("held_out"), "score", (F.col("score") >= PREDICT).cast("int").alias("predicted"))
