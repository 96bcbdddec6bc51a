"""Byte-level BPE: encoding by a segment tree over adjacent-pair ranks, and decoding.

A text is cut in front of every space that a non-space follows. There the
pre-tokenizer's pattern always ends a token, whatever stands around, so the
pieces are independent: each distinct piece is pre-tokenised and merged once a
task and its ids are reused (a dictionary of bounded size).

Merging one pre-token: the leaves of a segment tree hold the rank of each
adjacent pair, inner nodes the smaller of their children (the left one on
ties), so the root is the leftmost lowest-rank merge. A merge changes two
neighbouring pairs and removes one, each a logarithmic point update, until the
root is infinite. ``merge_tree`` does this for one long token; ``merge_many``
holds the trees of many short tokens as rows of one array and takes one merge
of every row at a time.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from ratecraft.llm.common import bounded_batches

#: Fixed values of the public byte-level BPE format: the pre-tokenizer's pattern,
#: with white space spelt out (Unicode property White_Space), and the bytes that
#: stand for themselves in vocabulary files.
SPACE = r"\t\n\x0b\x0c\r \x85\xa0  -     　"
PATTERN = rf"'s|'t|'re|'ve|'m|'ll|'d| ?\p{{L}}+| ?\p{{N}}+| ?[^{SPACE}\p{{L}}\p{{N}}]+|[{SPACE}]+(?![^{SPACE}])|[{SPACE}]+"
PRINTED = [(33, 126), (161, 172), (174, 255)]

#: Distinct pieces that a task remembers before it starts afresh.
CACHE_PIECES = 250_000
#: Longer pieces are encoded anew each time, so the cache has bounded bytes.
LONG_PIECE = 256
#: Tokens of up to so many bytes are merged many at a time.
SHORT_TOKEN = 64
#: Texts of up to so many characters in all are encoded together.
ROUND_CHARS = 2_000_000
NEVER = 1 << 60


def byte_symbols() -> list[str]:
    """The character that stands for each byte in a byte-level vocabulary."""
    printed = {b for lo, hi in PRINTED for b in range(lo, hi + 1)}
    out, extra = [], 256
    for b in range(256):
        out.append(chr(b) if b in printed else chr(extra))
        extra += b not in printed
    return out


class Vocabulary:
    """Merge ranks by id pair, token bytes by id and added tokens of a tokenizer file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model, symbols = spec["model"], byte_symbols()
        ids = model["vocab"]
        back = {s: bytes([b]) for b, s in enumerate(symbols)}
        size = max([*ids.values(), *(t["id"] for t in spec["added_tokens"])]) + 1
        self.token_bytes = [b""] * size
        for s, i in ids.items():
            self.token_bytes[i] = b"".join(back.get(c, c.encode()) for c in s)
        self.added = {t["content"]: t["id"] for t in spec["added_tokens"]}
        for s, i in self.added.items():
            self.token_bytes[i] = s.encode()
        self.byte_ids = [ids[s] for s in symbols]
        self.merges: dict[tuple[int, int], tuple[int, int]] = {}
        for rank, pair in enumerate(model["merges"]):
            a, b = pair if isinstance(pair, list) else pair.split(" ")
            self.merges[ids[a], ids[b]] = (rank, ids[a + b])
        # the same as arrays, by pair: (left id << 20 | right id) in order, rank, merged id
        pairs = np.array([(a << 20) | b for a, b in self.merges] + [1 << 62], np.int64)
        order = np.argsort(pairs)
        values = np.array([*self.merges.values(), (0, 0)], np.int64)[order]
        self.pair_keys, self.pair_ranks, self.pair_ids = pairs[order], values[:, 0], values[:, 1]

    def look_up(self, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(found, rank, merged id) of pairs of ids."""
        key = (a.astype(np.int64) << 20) | b
        at = np.searchsorted(self.pair_keys, key)
        return self.pair_keys[at] == key, self.pair_ranks[at], self.pair_ids[at]


def merge_tree(symbols: list[int], merges: dict[tuple[int, int], tuple[int, int]]) -> list[int]:
    """Merge the leftmost lowest-rank pair until no pair is left that has a rank."""
    n = len(symbols)
    if n < 2:
        return symbols
    symbols = list(symbols)
    size = 1
    while size < n - 1:
        size *= 2
    # a node holds rank * size + position, so the minimum is the leftmost lowest rank
    tree = [NEVER] * (2 * size)
    for i in range(n - 1):
        found = merges.get((symbols[i], symbols[i + 1]))
        if found is not None:
            tree[size + i] = found[0] * size + i
    for node in range(size - 1, 0, -1):
        a, b = tree[2 * node], tree[2 * node + 1]
        tree[node] = a if a < b else b
    after = list(range(1, n + 1))
    before = list(range(-1, n - 1))

    def put(at: int, value: int) -> None:
        node = size + at
        tree[node] = value
        node >>= 1
        while node:
            a, b = tree[2 * node], tree[2 * node + 1]
            low = a if a < b else b
            if tree[node] == low:
                return
            tree[node] = low
            node >>= 1

    def rank_of(at: int, right: int) -> int:
        found = merges.get((symbols[at], symbols[right]))
        return NEVER if found is None else found[0] * size + at

    while tree[1] < NEVER:
        i = tree[1] % size
        j = after[i]
        symbols[i] = merges[symbols[i], symbols[j]][1]
        symbols[j] = -1
        after[i] = k = after[j]
        if j < n - 1:
            put(j, NEVER)
        if k < n:
            before[k] = i
            put(i, rank_of(i, k))
        else:
            put(i, NEVER)
        if before[i] >= 0:
            put(before[i], rank_of(before[i], i))
    return [s for s in symbols if s >= 0]


def merge_many(words: list[bytes], v: Vocabulary) -> list[bytes]:
    """Ids (little-endian 32 bits) of each token of at most SHORT_TOKEN bytes."""
    out: list[bytes] = [b""] * len(words)
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    of_byte = np.array(v.byte_ids, np.int64)
    for size in (1, 2, 4, 8, 16, 32, 64):
        # words of size / 2 + 1 < length - 1 <= size have trees with size leaves
        rows = np.flatnonzero((lengths - 1 <= size) & (lengths - 1 > size // 2)) if size > 1 else np.flatnonzero(lengths <= 2)
        for at in range(0, len(rows), 20_000):
            some = rows[at : at + 20_000]
            ids, counts = _merge_rows([words[i] for i in some], lengths[some], size, of_byte, v)
            raw, end = ids.astype("<u4").tobytes(), 0
            for i, n in zip(some.tolist(), (4 * counts).tolist(), strict=True):
                out[i] = raw[end : end + n]
                end += n
    return out


def _merge_rows(words, lengths, size, of_byte, v):
    """One tree with ``size`` leaves a row; a merge of every unfinished row at a time."""
    n, width = len(words), size + 2
    column = np.arange(width)
    symbols = np.full((n, width), -1, np.int64)
    symbols[column[None, :] < lengths[:, None]] = of_byte[np.frombuffer(b"".join(words), np.uint8)]
    tree = np.full((n, 2 * size), NEVER, np.int64)
    merged = np.zeros((n, size), np.int64)
    inside = column[None, :size] + 1 < lengths[:, None]
    a, b = symbols[:, :size][inside], symbols[:, 1 : size + 1][inside]
    found, rank, new = v.look_up(a, b)
    tree[:, size:][inside] = np.where(found, rank * size + np.broadcast_to(column[:size], inside.shape)[inside], NEVER)
    merged[inside] = new
    level = size // 2
    while level:
        tree[:, level : 2 * level] = np.minimum(tree[:, 2 * level : 4 * level : 2], tree[:, 2 * level + 1 : 4 * level : 2])
        level //= 2
    after = np.broadcast_to(column + 1, (n, width)).copy()
    before = np.broadcast_to(column - 1, (n, width)).copy()
    live = np.flatnonzero(tree[:, 1] < NEVER)

    def put(r, leaf, value):
        node = size + leaf
        tree[r, node] = value
        node >>= 1
        while size > 1 and node[0]:  # all leaves are equally deep
            tree[r, node] = np.minimum(tree[r, 2 * node], tree[r, 2 * node + 1])
            node >>= 1

    def renew(r, left, right):
        found, rank, new = v.look_up(symbols[r, left], symbols[r, right])
        merged[r, left] = new
        put(r, left, np.where(found, rank * size + left, NEVER))

    while len(live):
        r = live
        i = tree[r, 1] % size
        j = after[r, i]
        k = after[r, j]
        symbols[r, i] = merged[r, i]
        symbols[r, j] = -1
        after[r, i] = k
        before[r, k] = i
        has = j < size
        if has.any():
            put(r[has], j[has], NEVER)
        ends = k >= lengths[r]
        if ends.any():
            put(r[ends], i[ends], NEVER)
        if not ends.all():
            renew(r[~ends], i[~ends], k[~ends])
        p = before[r, i]
        has = p >= 0
        if has.any():
            renew(r[has], p[has], i[has])
        live = live[tree[live, 1] < NEVER]
    kept = symbols >= 0
    return symbols[kept], kept.sum(axis=1)


class Encoder:
    """Texts to little-endian 32-bit ids, and ids to text."""

    def __init__(self, vocabulary: Vocabulary):
        self.v = vocabulary
        self.pattern = regex.compile(PATTERN)
        self.cut = regex.compile(rf" (?=[^{SPACE}])")
        self.after_space = regex.compile(rf" (?=[{SPACE}]|\Z)")
        self.added = regex.compile("|".join(map(regex.escape, sorted(vocabulary.added, key=len, reverse=True)))) if vocabulary.added else None
        self.pieces: dict[str, bytes] = {}

    def tokens(self, texts: list[str]) -> list[bytes]:
        """Ids of each text, without a look at what stands around it."""
        found = [[t.encode() for t in self.pattern.findall(x)] for x in texts]
        short = list({t for ts in found for t in ts if len(t) <= SHORT_TOKEN})
        known = dict(zip(short, merge_many(short, self.v), strict=True))
        v = self.v
        for ts in found:
            for t in ts:
                if t not in known:
                    known[t] = np.array(merge_tree([v.byte_ids[b] for b in t], v.merges), "<u4").tobytes()
        return [b"".join([known[t] for t in ts]) for ts in found]

    def parts(self, text: str) -> list[str]:
        """The text cut in front of spaces that start a piece; their space is left out."""
        return self.cut.split(text) if self.after_space.search(text) else text.split(" ")

    def plain(self, texts: list[str]) -> list[bytes]:
        """Ids of texts without added tokens."""
        cut = [self.parts(x) for x in texts]
        # the first part has no space in front, so it isn't shared with the others
        heads = self.tokens([x[0] for x in cut])
        known = self.pieces
        new = {p for x in cut for p in x[1:] if p not in known}
        if new:
            if len(known) + len(new) > CACHE_PIECES:
                known.clear()
                new = {p for x in cut for p in x[1:]}
            new = list(new)
            fresh = dict(zip(new, self.tokens([" " + p for p in new]), strict=True))
            known.update(fresh)
        out = [head + b"".join([known[p] for p in x[1:]]) for head, x in zip(heads, cut, strict=True)]
        if new:
            for p in new:
                if len(p) > LONG_PIECE:
                    del known[p]
        return out

    def encode_many(self, texts: list[str | None]) -> list[bytes]:
        """Ids of each text, added tokens found first."""
        flat, plan = [], []
        for text in texts:
            own: list[bytes | int] = []
            at = 0
            for m in self.added.finditer(text or "") if self.added else ():
                own += [len(flat), np.array([self.v.added[m[0]]], "<u4").tobytes()]
                flat.append(text[at : m.start()])
                at = m.end()
            own.append(len(flat))
            flat.append((text or "")[at:])
            plan.append(own)
        ids, at, chars = [], 0, 0
        for end, x in enumerate(flat, 1):
            chars += len(x)
            if chars >= ROUND_CHARS or end == len(flat):
                ids += self.plain(flat[at:end])
                at, chars = end, 0
        return [b"".join([x if isinstance(x, bytes) else ids[x] for x in own]) for own in plan]

    def encode(self, text: str | None) -> bytes:
        return self.encode_many([text])[0]

    def decode(self, ids: np.ndarray) -> str:
        table = self.v.token_bytes
        return b"".join([table[i] for i in ids.tolist()]).decode("utf-8", "replace")


def _encoded(path: str, with_text: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(Vocabulary(path))
        for b in batches:
            n, sha, back, ids, texts = [], [], [], [], []
            for raw in encoder.encode_many(b.column(1).to_pylist()):
                array = np.frombuffer(raw, "<u4")
                text = encoder.decode(array)
                n.append(len(array))
                sha.append(hashlib.sha256(raw).hexdigest())
                back.append(hashlib.sha256(text.encode()).hexdigest())
                if with_text:
                    ids.append(array.astype(np.int32))
                    texts.append(text)
            columns = [b.column(0), pa.array(n, pa.int64()), pa.array(sha, pa.string()), pa.array(back, pa.string())]
            names = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
            if with_text:
                columns += [pa.array(ids, pa.list_(pa.int32())), pa.array(texts, pa.string())]
                names += ["ids", "decoded"]
            yield pa.RecordBatch.from_arrays(columns, names)

    return run


def encode_documents(docs: DataFrame, vocabulary_path: str, with_text: bool = False) -> DataFrame:
    """Per document: doc_id, n_tokens, ids_sha256, decoded_sha256; with_text adds ids and decoded.

    The digest is of the ids as little-endian unsigned 32-bit integers, and of
    the text decoded from them, in UTF-8. Null and empty texts have no ids and
    decode to the empty text. Every input row gives a row (null doc_ids and
    repeated rows too); an empty table gives an empty result; other columns
    are not read. No shuffle: documents are encoded where they are read.
    """
    schema = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
    if with_text:
        schema += ", ids array<int>, decoded string"
    return bounded_batches(docs).select("doc_id", "text").mapInArrow(_encoded(vocabulary_path, with_text), schema)
