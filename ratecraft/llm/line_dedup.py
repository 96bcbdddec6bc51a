"""Line dedup by content-defined chunks of lines.

A rolling hash over each line and the one before it chooses the boundaries
between chunks (every second window on average), so a passage inserted above
moves no boundary below it; a line of PASSAGE_WORDS words or more is a chunk of
its own. Chunks whose hash occurs more than once in the corpus are compared
byte by byte, by grouping on their text. Of each repeated chunk the first
occurrence (smallest doc_id, then position) stays. Later ones go where a run of
neighbouring repeated chunks has PASSAGE_WORDS words or more; shorter repeated
lines (headings, greetings) stay.

The corpus is read three times. Hashes alone are shuffled first; chunk texts
only where a bounded Bloom filter of the repeated hashes lets them through,
and the texts of documents once, for the rewrite.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ratecraft.llm.common import Scratch, blank_table, bloom_has, bloom_of, bounded_batches, constants, groups_of, mix, raw_text, rolling, span_hash

PASSAGE_WORDS = 50


def chunk_table(column: pa.Array) -> Iterator[tuple[int, bytes, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """(row, text bytes, chunk starts, chunk ends, hashes, words) of every text that isn't empty.

    Bytes from a chunk's start to its end are its lines without the last line end.
    """
    one, two, three = constants(3, 31)
    blank = blank_table()
    data, offsets = raw_text(column)
    for i, j in groups_of(offsets):
        lo, hi = int(offsets[i]), int(offsets[j])
        part = data[lo:hi]
        if not len(part):
            continue
        prefix = rolling(part)
        gap = blank[part]
        starts_word = np.concatenate(([0], np.cumsum(~gap & np.concatenate(([True], gap[:-1])))))
        breaks = np.flatnonzero(part == 10)
        for r in range(i, j):
            a, b = int(offsets[r]) - lo, int(offsets[r + 1]) - lo
            if a == b:
                continue
            own = breaks[np.searchsorted(breaks, a) : np.searchsorted(breaks, b)]
            start = np.concatenate(([a], own + 1))
            end = np.concatenate((own, [b]))
            h = span_hash(prefix, start, end)
            # a text's first word may follow another text without white space between
            words = starts_word[end] - starts_word[start]
            if a and not gap[a] and not gap[a - 1]:
                words[0] += 1
            roll = mix(h * one + np.concatenate(([np.uint64(0)], h[:-1])) * two)
            long = words >= PASSAGE_WORDS
            cut = (roll[:-1] & np.uint64(1) == 0) | long[:-1] | long[1:]
            first = np.concatenate(([0], np.flatnonzero(cut) + 1))
            last = np.concatenate((first[1:], [len(h)])) - 1
            inside = np.arange(len(h)) - np.repeat(first, last - first + 1)
            value = np.add.reduceat(mix(h + inside.astype(np.uint64) * three), first)
            yield r, part[a:b].tobytes(), start[first] - a, end[last] - a, mix(value), np.add.reduceat(words, first)


def long_runs(flags: np.ndarray, words: np.ndarray) -> np.ndarray:
    """The flagged chunks whose run of neighbouring flagged chunks is a passage."""
    out = np.zeros(len(flags), bool)
    edge = np.flatnonzero(np.diff(np.concatenate(([False], flags, [False])).astype(np.int8)))
    for a, b in zip(edge[0::2], edge[1::2], strict=True):
        out[a:b] = words[a:b].sum() >= PASSAGE_WORDS
    return out


def _hashes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        got = [h for _, _, _, _, h, _ in chunk_table(b.column(0))]
        if got:
            yield pa.RecordBatch.from_arrays([np.concatenate(got).view(np.int64)], ["hash"])


def _candidates(bloom: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("doc_id", pa.int64()), ("pos", pa.int32()), ("hash", pa.int64()), ("chunk", pa.binary())])
        for b in batches:
            rows, size = [], 0
            for r, text, start, end, h, words in chunk_table(b.column(1)):
                doc = b.column(0)[r].as_py()
                h = h.view(np.int64)
                for k in np.flatnonzero(long_runs(bloom_has(bloom, h), words)):
                    rows.append((doc, int(k), int(h[k]), text[start[k] : end[k]]))
                    size += len(rows[-1][3])
                if size > 8 << 20:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), schema.types, strict=True)], schema=schema)
                    rows, size = [], 0
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), schema.types, strict=True)], schema=schema)

    return run


def _rewrite(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (doc_id, text, repeated positions) to (doc_id, text, chunks, chunks and words removed)."""
    for b in batches:
        texts, chunks, gone, lost = b.column(1).to_pylist(), [0] * b.num_rows, [0] * b.num_rows, [0] * b.num_rows
        marks = b.column(2)
        for r, text, start, end, h, words in chunk_table(b.column(1)):
            chunks[r] = len(h)
            if not marks[r].is_valid:
                continue
            flags = np.zeros(len(h), bool)
            at = np.asarray(marks[r].values)
            flags[at[at < len(h)]] = True
            flags = long_runs(flags, words)
            if flags.any():
                texts[r] = b"\n".join(text[s:e] for s, e, f in zip(start, end, flags, strict=True) if not f).decode()
                gone[r], lost[r] = int(flags.sum()), int(words[flags].sum())
        yield pa.RecordBatch.from_arrays(
            [b.column(0), pa.array(texts, pa.string()), *(pa.array(x, pa.int64()) for x in (chunks, gone, lost)), *b.columns[3:]],
            ["doc_id", "text", "n_chunks", "n_removed", "words_removed", *b.schema.names[3:]],
        )


def repeated_chunks(docs: DataFrame) -> DataFrame:
    """(doc_id, positions): the chunks of each document that stand elsewhere before; written."""
    scratch = Scratch(bounded_batches(docs).sparkSession, "lines")
    hashes = docs.select("text").mapInArrow(_hashes, "hash long")
    twice = scratch.write(hashes.groupBy("hash").count().filter("count > 1").select("hash"))
    bloom = bloom_of(twice, "hash", twice.count())
    found = docs.select("doc_id", "text").mapInArrow(_candidates(bloom), "doc_id long, pos int, hash long, chunk binary")
    found = scratch.write(found)
    # grouping on the bytes is the comparison; the minimum is combined before the shuffle
    first = found.groupBy("hash", "chunk").agg(F.min(F.struct("doc_id", "pos")).alias("first"), F.count("*").alias("n")).filter("n > 1").drop("n")
    later = found.join(first, ["hash", "chunk"]).filter("doc_id <> first.doc_id or pos <> first.pos or first.doc_id is null")
    later = later.filter("doc_id is not null").select("doc_id", "pos").distinct()
    out = scratch.write(later.groupBy("doc_id").agg(F.sort_array(F.collect_list("pos")).alias("positions")))
    scratch.keep(out)
    return out


def dedup_lines(docs: DataFrame) -> DataFrame:
    """Per document: doc_id, text without repeated passages, n_chunks, n_removed, words_removed, and other columns behind.

    Null texts stay null, empty ones empty; a text may become empty. Rows with a
    null doc_id are left as they are, but count as first occurrences. Repeated
    rows of one doc_id count as one document and are treated alike. Texts
    without a repeated passage come back byte for byte. An empty table gives an
    empty result. Extra columns keep their names; one named like an added
    column is left out.
    """
    positions = repeated_chunks(docs).select(F.col("doc_id").alias("__id"), F.col("positions").alias("__at"))
    added = ["n_chunks", "n_removed", "words_removed"]
    extra = [c for c in docs.columns if c not in ("doc_id", "text", *added)]
    # always by shuffle: the list grows with the corpus
    joined = docs.join(positions.hint("merge"), docs["doc_id"] == positions["__id"], "left").select("doc_id", "text", "__at", *extra)
    kinds = {f.name: f.dataType.simpleString() for f in docs.schema}
    schema = "doc_id long, text string, n_chunks long, n_removed long, words_removed long" + "".join(f", `{c}` {kinds[c]}" for c in extra)
    return joined.withColumn("doc_id", F.col("doc_id").cast("long")).mapInArrow(_rewrite, schema)


def drop_repeated_lines(docs: DataFrame) -> DataFrame:
    """Documents with their texts deduplicated and all their columns; n_chars follows the text.

    A document of which nothing but white space is left goes; one that held no
    more before stays.
    """
    names = docs.columns
    out = dedup_lines(docs).filter("n_removed = 0 or length(trim(replace(text, '\n', ' '))) > 0")
    if "n_chars" in names:
        out = out.withColumn("n_chars", F.when(F.col("n_removed") > 0, F.char_length("text")).otherwise(F.col("n_chars")).cast(docs.schema["n_chars"].dataType))
    return out.select(names)
