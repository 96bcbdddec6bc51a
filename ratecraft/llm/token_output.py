"""Token-ID output: Parquet list columns for selective reads of tokens and metadata.

Documents are range-partitioned by doc_id and sorted, tokenised where they
then are, and written by Spark's Parquet writer, one file a partition:

- ``ids``: list of int32, dictionary-encoded pages (a vocabulary is a small
  dictionary), falling back to plain when a row group's dictionary overflows;
- ``doc_id``, ``local_start``, ``n_tokens``: without a dictionary, so that the
  version-2 writer stores them delta-encoded;
- row groups and pages of set size, with page indexes (column and offset
  indexes, which the writer adds), so that a reader of some doc_ids or of the
  metadata alone skips the other pages and columns.

``local_start`` counts the ids before a document in its file. A manifest with
one row per file holds the ids before the file; both together give the global
start without a scan of the ids and without a task that sees all documents.
"""

from __future__ import annotations

import json
import math
import os
import re
import zlib
from collections.abc import Iterator
from itertools import chain, pairwise

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ratecraft.llm.bpe import SPACE, byte_symbols
from ratecraft.llm.common import Scratch, blank_table, bounded_batches, fold_table, groups_of, pieces, raw_text

END_ID = 2
ROW_GROUP_BYTES = 32 << 20
PAGE_BYTES = 256 << 10
#: Words and pieces of words, and their ids, that a task remembers; it starts anew beyond either.
CACHE_WORDS, CACHE_IDS = 700_000, 12_000_000
#: Bytes of a round (a longer text is cut behind white space), pieces of a text and words of a batch that the library gets at once.
ROUND_BYTES, CALL_PIECES, CALL_WORDS = 1 << 20, 256, 2000
#: Bytes of text for one file, and the least for which another one is worth its start.
PART_BYTES, SMALL_BYTES = 48 << 20, 1 << 20

DATA_SCHEMA = "doc_id long, local_start long, n_tokens long, ids array<int>, part int"

#: Kinds of bytes: white space, letters, digits, other printable ASCII, and all that makes a word an odd one.
BLANK, LETTER, DIGIT, OTHER, ODD = range(5)


def _kind_table() -> np.ndarray:
    t = np.full(256, ODD, np.uint8)
    t[33:127] = OTHER
    t[[*b"'<"]] = ODD  # contractions and added tokens begin there
    t[blank_table()] = BLANK
    t[48:58] = DIGIT
    t[[*range(65, 91), *range(97, 123)]] = LETTER
    return t


def _wide_blanks(size: int) -> np.ndarray:
    """White space (Unicode's property) of so many bytes of UTF-8, as big-endian numbers."""
    found = (c.encode() for c in map(chr, range(0x80, 0x3001)) if re.match(f"[{SPACE}]", c))
    return np.array([int.from_bytes(c, "big") for c in found if len(c) == size], np.int32)


KIND, LOWER, BLANK_BYTE, BLANK_2, BLANK_3 = _kind_table(), fold_table(), blank_table(), _wide_blanks(2), _wide_blanks(3)


def _kinds(part: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(kind of each byte of UTF-8, bytes with letters of ASCII and Latin-1 in lower case)."""
    kind, lower = KIND[part], LOWER[part]
    lead = np.flatnonzero(part >= 0xC2)
    if len(lead):
        ends = np.concatenate((part, np.zeros(2, np.uint8)))
        a, b = part[lead], ends[lead + 1]
        latin = (a == 0xC3) & (b >> 6 == 2) & (b != 0x97) & (b != 0xB7)  # all but the signs of times and division
        at, b = lead[latin], b[latin]
        kind[at] = kind[at + 1] = LETTER
        lower[at + 1] = b + np.uint8(32) * (b < 0x9F)
        for size, first, last, blanks in ((2, 0xC2, 0xC2, BLANK_2), (3, 0xE1, 0xE3, BLANK_3)):
            at = lead[(a >= first) & (a <= last)]
            code = np.zeros(len(at), np.int32)
            for k in range(size):
                code = code << 8 | ends[at + k]
            at = at[np.isin(code, blanks)]
            for k in range(size):
                kind[at + k] = BLANK
    return kind, lower


def _cut(part: np.ndarray, bounds: np.ndarray, plain: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Pieces of the words of texts that stand one after another between the bounds.

    Returns the bytes of all pieces, their n + 1 offsets, which are odd words,
    and how many pieces each text has. A word without odd bytes is cut into runs
    of letters, single digits and runs of the rest, in lower case; an odd word,
    or any word unless ``plain``, is one piece as it stands.
    """
    kind, lower = _kinds(part)
    keep = kind != BLANK
    first = np.ones(len(part), bool)  # bytes at which a word begins
    np.logical_not(keep[:-1], out=first[1:])
    first[bounds[bounds < len(part)]] = True
    first, kind, body = first[keep], kind[keep], lower[keep]
    begin = np.flatnonzero(first)
    odd = np.full(len(begin), not plain)
    odd[np.searchsorted(begin, np.flatnonzero(kind == ODD), "right") - 1] = True
    if odd.any():
        whole = np.repeat(odd, np.diff(begin, append=len(body)))
        kind[whole], body[whole] = ODD, part[keep][whole]
    first |= kind == DIGIT
    first[1:] |= kind[1:] != kind[:-1]
    begin = np.flatnonzero(first)
    kept = np.fromiter((np.count_nonzero(keep[i:j]) for i, j in pairwise(bounds.tolist())), np.int64, len(bounds) - 1)
    by_text = np.diff(np.searchsorted(begin, np.concatenate(([0], np.cumsum(kept)))))
    return body, np.append(begin, len(body)).astype(np.int32), kind[begin] == ODD, by_text


class _Numbers(dict):
    """Numbers words as they are first asked for, and lists the new ones."""

    def __init__(self):
        super().__init__()
        self.new: list[bytes] = []

    def __missing__(self, word: bytes) -> int:
        self[word] = number = len(self)
        self.new.append(word)
        return number


def _room(a: np.ndarray, used: int, more: int) -> np.ndarray:
    """The array, or a copy of at least twice its size if it has no room for more."""
    if used + more <= len(a):
        return a
    out = np.empty(max(2 * len(a), used + more), a.dtype)
    out[:used] = a[:used]
    return out


class _Ids:
    """Ids of numbered texts, one after another in one array with room to grow."""

    def __init__(self):
        self.flat, self.start, self.n = np.empty(1 << 16, np.int32), np.empty(1 << 14, np.int64), np.empty(1 << 14, np.int64)
        self.size = self.texts = 0

    def add(self, flat: np.ndarray, n: np.ndarray) -> None:
        i, j = self.size, self.texts
        self.flat = _room(self.flat, i, len(flat))
        self.start, self.n = _room(self.start, j, len(n)), _room(self.n, j, len(n))
        self.flat[i : i + len(flat)], self.n[j : j + len(n)] = flat, n
        self.start[j : j + len(n)] = i + np.cumsum(n) - n
        self.size, self.texts = i + len(flat), j + len(n)

    def of(self, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids of these texts in a row, how many each has)."""
        n = self.n[numbers]
        before = np.cumsum(n) - n
        return self.flat[np.repeat(self.start[numbers] - before, n) + np.arange(int(n.sum()))], n


def _per(n: np.ndarray, group: np.ndarray) -> np.ndarray:
    """Sums of n over consecutive groups of the given lengths."""
    return np.diff(np.concatenate(([0], np.cumsum(n)))[np.concatenate(([0], np.cumsum(group)))])


def _numbers(known: _Numbers, texts) -> np.ndarray:
    return np.fromiter(map(known.__getitem__, texts), np.int64)


class WordEncoder:
    """Ids of texts whose tokenizer drops white space: each distinct piece of a word is encoded once while it is remembered.

    The tokenizer's normaliser turns runs of white space into one space, which
    its pre-tokenizer drops, so no token, composition or lower-casing spans it.
    Words of printable ASCII and Latin-1 letters, which its pattern splits into
    letters, single digits and the rest, go to its model as lower-case pieces in
    the model's byte alphabet, many a call; others (and words with an apostrophe or an angle
    bracket, where contractions and added tokens begin) pass through the whole tokenizer one by
    one. A tokenizer file with another normaliser or pattern gets every word that way.

    The texts of a round are cut as one array of bytes, and its pieces are
    dictionary-encoded, so only the round's distinct pieces are looked up.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer, pre_tokenizers

        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # one thread a task: cores and memory are Spark's to deal
        self.tokenizer, self.model = Tokenizer.from_file(path), Tokenizer.from_file(path)
        for t in (self.tokenizer, self.model):
            t.no_padding()
            t.no_truncation()
        self.model.normalizer, self.model.pre_tokenizer = None, pre_tokenizers.WhitespaceSplit()
        added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        spec = json.loads(self.tokenizer.to_str())
        self.plain = all("<" in x for x in added) and _splits_plainly(spec) and _marks_ends(spec["model"])
        if self.plain:
            ids, suffix = spec["model"]["vocab"], spec["model"]["end_of_word_suffix"]
            self.ends = np.zeros(max(ids.values()) + 1, bool)  # ids that end a piece
            self.ends[[i for x, i in ids.items() if x.endswith(suffix)]] = True
            self.alphabet = np.array([ord(c) for c in byte_symbols()], "<u4")
            self.alphabet[32] = 32  # between pieces
        self._forget()

    def _forget(self) -> None:
        self.known, self.ids = _Numbers(), _Ids()

    def _learn_pieces(self, new: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all pieces, ids by piece) from the model."""
        raw = [np.frombuffer(b" ".join(new[k : k + CALL_PIECES]), np.uint8) for k in range(0, len(new), CALL_PIECES)]
        joined = [self.alphabet[x].tobytes().decode("utf-32-le") for x in raw]
        ids: list[int] = []
        for k in range(0, len(joined), 16):
            for e in self.model.encode_batch_fast(joined[k : k + 16], add_special_tokens=False):
                ids += e.ids
        flat = np.array(ids, np.int32)
        return flat, np.diff(np.flatnonzero(self.ends[flat]), prepend=-1)

    def _learn_words(self, new: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all words, ids by word) from the whole tokenizer."""
        ids: list[list[int]] = []
        for k in range(0, len(new), CALL_WORDS):
            words = [w.decode() for w in new[k : k + CALL_WORDS]]
            ids += [e.ids for e in self.tokenizer.encode_batch_fast(words, add_special_tokens=False)]
        return np.fromiter(chain.from_iterable(ids), np.int32), np.fromiter(map(len, ids), np.int64, len(ids))

    def _round(self, part: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts between the bounds, ids by text)."""
        if len(self.known) > CACHE_WORDS or self.ids.size > CACHE_IDS:
            self._forget()
        body, offsets, odd, by_text = _cut(part, bounds, self.plain)
        column = pa.Array.from_buffers(pa.binary(), len(odd), [None, pa.py_buffer(offsets), pa.py_buffer(body)]).dictionary_encode()
        at, words = column.indices.to_numpy(), column.dictionary.to_numpy(zero_copy_only=False)
        odd_words = np.zeros(len(words), bool)
        odd_words[at[odd]] = True
        numbers = np.zeros(len(words), np.int64)
        for some, learn in ((~odd_words, self._learn_pieces), (odd_words, self._learn_words)):
            numbers[some] = _numbers(self.known, words[some].tolist())
            if self.known.new:
                new, self.known.new = self.known.new, []
                self.ids.add(*learn(new))
        flat, n = self.ids.of(numbers[at])
        return flat, _per(n, by_text)

    def rounds(self, texts: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
        """Rows from and to, the ids of their texts and how many each has, for about ROUND_BYTES at a time."""
        data, offsets = raw_text(texts)
        for i, j in groups_of(offsets, ROUND_BYTES):
            part, bounds = data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i]
            if j - i > 1 or len(part) <= ROUND_BYTES:
                yield i, j, *self._round(part, bounds)
            else:
                flat, n = zip(*(self._round(x, np.array([0, len(x)])) for x in pieces(part, BLANK_BYTE, ROUND_BYTES)), strict=True)
                yield i, j, np.concatenate(flat), np.sum(n, axis=0)

    def encode(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts, ids by text)."""
        done = list(self.rounds(pa.array(texts, pa.string())))
        flat, n = ([x[k] for x in done] for k in (2, 3))
        return np.concatenate([np.zeros(0, np.int32), *flat]), np.concatenate([np.zeros(0, np.int64), *n])

    def encode_many(self, texts: list[str | None]) -> list[bytes]:
        """Ids of each text as little-endian 32-bit integers."""
        flat, n = self.encode(texts)
        return [x.astype("<u4").tobytes() for x in np.split(flat, np.cumsum(n)[:-1])] if len(n) else []


def _splits_plainly(tokenizer: dict) -> bool:
    """Whether a tokenizer lower-cases and splits printable ASCII into letters, single digits and the rest."""
    normal = [n["type"] for n in (tokenizer["normalizer"] or {}).get("normalizers", [])]
    steps = (tokenizer["pre_tokenizer"] or {}).get("pretokenizers", [])
    if normal != ["NFC", "Replace", "Lowercase"] or [p["type"] for p in steps] != ["Split", "ByteLevel"]:
        return False
    pattern = steps[0]["pattern"].get("Regex", "")
    whole = steps[0]["invert"] and steps[0]["behavior"] == "Removed" and not steps[1]["add_prefix_space"] and not steps[1]["use_regex"]
    return whole and [x for x in pattern.split("|") if not x.startswith("'")] == [r"[\p{L}]+", r"[\p{N}]", r"[^\s\p{L}\p{N}]+"]


def _marks_ends(model: dict) -> bool:
    """Whether a BPE model's last token of a piece, and no other, has a suffix that no plain piece can hold."""
    suffix, vocab = model.get("end_of_word_suffix"), model.get("vocab", {})
    whole = model["type"] == "BPE" and not model["dropout"] and not model["continuing_subword_prefix"] and not model["ignore_merges"]
    return whole and "<" in (suffix or "") and all(x in vocab and x + suffix in vocab for x in byte_symbols())


def _tokenise(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, start = WordEncoder(path), 0
        for b in batches:
            for lo, hi, flat, n in encoder.rounds(b.column(1)):
                flat = np.insert(flat, np.cumsum(n), END_ID)
                n = n + 1
                before = start + np.cumsum(n) - n
                start += int(n.sum())
                offsets = np.concatenate(([0], np.cumsum(n))).astype(np.int32)
                ids = pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat.astype(np.int32)))
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).slice(lo, hi - lo), pa.array(before), pa.array(n), ids, b.column(2).slice(lo, hi - lo)],
                    ["doc_id", "local_start", "n_tokens", "ids", "part"],
                )

    return run


def _partitions(docs: DataFrame) -> int:
    """One for every PART_BYTES of text, more on an idle cluster as far as there are SMALL_BYTES for each."""
    total = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    cores = docs.sparkSession.sparkContext.defaultParallelism
    return max(1, math.ceil(total / PART_BYTES), min(cores, math.ceil(total / SMALL_BYTES)))


def write_token_files(docs: DataFrame, vocabulary_path: str, path: str) -> None:
    """Write documents' ids below ``path``: data files under data, the manifest under manifest.

    Rows are in ascending doc_id order, nulls first; rows of one doc_id in the
    order of a digest of their texts, so starts are the same on every run, and
    equal rows, which are dealt to several files if they are many, in no order. A null or empty
    text has the end id alone. An empty table writes readable, empty files.
    """
    spark = docs.sparkSession
    order = [F.col("doc_id").asc_nulls_first(), F.col("digest").asc(), F.col("tie").asc()]
    ordered = (
        bounded_batches(docs)
        .select("doc_id", "text", F.xxhash64("text").alias("digest"), F.monotonically_increasing_id().alias("tie"))
        .repartitionByRange(_partitions(docs), *order)
        .sortWithinPartitions(*order)
        .select("doc_id", "text", F.spark_partition_id().alias("part"))
    )
    writer = ordered.mapInArrow(_tokenise(vocabulary_path), DATA_SCHEMA).write
    options = {
        "compression": "zstd",
        "parquet.writer.version": "PARQUET_2_0",
        "parquet.block.size": ROW_GROUP_BYTES,
        "parquet.page.size": PAGE_BYTES,
        "parquet.enable.dictionary": "true",
        **{f"parquet.enable.dictionary#{c}": "false" for c in ("doc_id", "local_start", "n_tokens")},
    }
    writer.options(**options).parquet(f"{path}/data")
    data = spark.read.schema(DATA_SCHEMA).parquet(f"{path}/data")
    totals = data.groupBy("part").agg(F.sum("n_tokens").alias("tokens"), F.count("*").alias("documents"))
    # one row per file: as many as the writing job had partitions, never more rows with more documents in each
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    manifest = totals.withColumn("start", F.coalesce(F.sum("tokens").over(before), F.lit(0)))
    manifest.coalesce(1).write.parquet(f"{path}/manifest")


def read_token_files(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start (ids before the document in all files), n_tokens, ids; unused columns are not read."""
    data = spark.read.schema(DATA_SCHEMA).parquet(f"{path}/data")
    manifest = spark.read.schema("part int, start long").parquet(f"{path}/manifest")
    joined = data.join(manifest, "part")
    return joined.select("doc_id", (F.col("start") + F.col("local_start")).alias("start"), "n_tokens", "ids")


def _checksums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        ids = b.column(3)
        flat = np.asarray(ids.values, np.int32).astype("<u4").view(np.uint8)
        off = np.asarray(ids.offsets, np.int64) * 4
        crc = [zlib.crc32(flat[off[i] : off[i + 1]]) for i in range(b.num_rows)]
        yield pa.RecordBatch.from_arrays([*b.columns[:3], pa.array(crc, pa.int64())], ["doc_id", "start", "n_tokens", "ids_crc32"])


def token_digest(docs: DataFrame, vocabulary_path: str) -> DataFrame:
    """Write token files for the documents, read them back: doc_id, start, n_tokens, ids_crc32.

    One row per input row. Nulls, empty texts, repeated rows and empty tables as
    ``write_token_files`` says; other columns are not read.
    """
    path = f"{Scratch(docs.sparkSession, 'tokens').root}/files"
    write_token_files(docs, vocabulary_path, path)
    back = read_token_files(docs.sparkSession, path)
    return back.mapInArrow(_checksums, "doc_id long, start long, n_tokens long, ids_crc32 long")
