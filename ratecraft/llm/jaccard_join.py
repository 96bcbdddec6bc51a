"""N-gram Jaccard join by a partition of the shingle universe (pigeonhole).

A document's set is its distinct word n-grams, as 64-bit hashes. Set sizes fall
into bands of ratio 1.25. Within a band, two similar sets differ in at most H
shingles; the universe is cut into m > H segments by hash, so at least m - H
segments of the two sets are equal. The cost model (``scheme``) chooses m so
that, empty segments left out (they would be shared by whole bands), a set
still has H + 1 segments: then one equal, non-empty segment exists and an exact
index on (band, segment, subset) finds the pair. A set with too few non-empty
segments gets a second allocation: all its segments, also with one shingle
deleted, which bears one difference a segment; should even that not reach H + 1,
its single shingles are indexed. Allocation by cost: two similar sets share more
keys than a set has segments beyond H + 1, so a set leaves that many of its
hottest buckets (a common line's, say) without losing a partner. Sets that still
stand in wide buckets are partitioned again among themselves, down to single
shingles, of which each keeps the rarest fifth (and one more). Every pair that reaches the threshold shares a
key, so the join is exact; candidates pass a size bound and parity bitmaps, a
short one and one as long as the set (all necessary conditions), and are
verified on the whole sets.

Copies with the same set form one class, named by a 64-bit digest; classes
take part, not copies (about n^2 / 2^65 accidental class merges are expected,
below one for 10^9 documents).
"""

from __future__ import annotations

import math
from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ratecraft.llm.common import (
    Scratch,
    blank_table,
    bloom_has,
    bloom_of,
    bounded_batches,
    constants,
    drop_ids,
    fold_table,
    mix,
    word_hashes,
)
from ratecraft.llm.components import SPARE, bucket_members, link_buckets

WORDS = 5
THRESHOLD = 80  # percent
RATIO = 1.25  # 100 / THRESHOLD: a partner is at most one band away
BITMAP_LONGS = 4


_SCHEMES: dict[int, tuple[int, int]] = {}


def scheme(band: int) -> tuple[int, int]:
    """(segments m, non-empty segments needed H + 1) of a band.

    More segments mean more keys and, as segments get smaller, more chance
    matches; fewer mean more sets that need the deletion neighbourhood. m is
    the least that leaves the smallest sets of the band (80 % of its lower
    edge) four standard deviations above H + 1.
    """
    if band in _SCHEMES:
        return _SCHEMES[band]
    largest = math.ceil(RATIO ** (band + 1)) - 1
    need = 2 * largest * (100 - THRESHOLD) // (100 + THRESHOLD) + 1
    low = max(1.0, RATIO**band * THRESHOLD / 100)
    m = need + 2
    while m < 2 * need and m - (empty := m * math.exp(-low / m)) - 4 * math.sqrt(empty) < need:
        m += 1
    _SCHEMES[band] = m, need
    return m, need


_EDGES = [RATIO**k for k in range(1, 100)]


def band_of(size: int) -> int:
    return bisect_right(_EDGES, size)


def segment_keys(hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Index keys of one set (distinct hashes, sorted), for its own band and the next, and their plans.

    A plan holds the band and how many non-empty segments the set has beyond
    those needed (see components.bucket_members).
    """
    band = band_of(len(hashes))
    out: list[tuple[np.ndarray, int]] = []
    high, mixed = hashes >> np.uint64(32), mix(hashes)
    for b in (band, band + 1):
        m, need = scheme(b)
        segment = (high * np.uint64(m)) >> np.uint64(32)
        # hashes are sorted, so segments are runs; a subset's value is a sum of mixed hashes
        start = np.flatnonzero(np.concatenate(([True], segment[1:] != segment[:-1])))
        at = segment[start]
        value = np.add.reduceat(mixed, start)
        enough = len(at) >= need
        out.append((mix(value + (at + np.uint64(b << 40)) * np.uint64(0x9E3779B97F4A7C15)), b * SPARE + len(at) - need if enough else -1))
        if enough:
            continue
        # second allocation: every segment (empty ones too), whole and with one deletion
        whole = np.zeros(m, np.uint64)
        whole[at.astype(np.int64)] = value
        there = mix(np.arange(m, dtype=np.uint64) + np.uint64(b << 40) + np.uint64(1 << 60))
        out.append((mix(whole + there), -1))
        seg = segment.astype(np.int64)
        out.append((mix(whole[seg] - mixed + there[seg]), -1))
        if 2 * len(at) < need:
            out.append((mix(hashes + np.uint64(3 << 60) + np.uint64(b)), -1))
    return np.concatenate([k for k, _ in out]), np.concatenate([np.full(len(k), p, np.int64) for k, p in out])


def shingle_sets(column: pa.Array, words: int = WORDS) -> Iterator[tuple[int, np.ndarray]]:
    """(row, sorted distinct shingle hashes) of every text."""
    sep, fold = blank_table(), fold_table()
    c = constants(words, 21)
    for first, offsets, h, _ in word_hashes(column, sep, fold):
        n = max(0, len(h) - words + 1)
        full = np.zeros(n, np.uint64)
        for k in range(words):
            full = mix(full + h[k : k + n] * c[k])
        for r in range(len(offsets) - 1):
            lo, hi = int(offsets[r]), int(offsets[r + 1])
            if hi - lo >= words:
                one = np.sort(full[lo : hi - words + 1])
                yield first + r, one[np.concatenate(([True], one[1:] != one[:-1]))]
            elif hi > lo:
                one = np.full(1, hi - lo, np.uint64)
                for k in range(hi - lo):
                    one = mix(one + h[lo + k : lo + k + 1] * c[k])
                yield first + r, one
            else:
                yield first + r, np.zeros(0, np.uint64)


def digest(s: np.ndarray) -> int:
    """Signed 64-bit name of a set."""
    x = np.add.reduce(mix(s ^ np.uint64(0x5851F42D4C957F2D))) + np.uint64(len(s))
    return int(mix(np.array([x], np.uint64)).view(np.int64)[0])


def parity_bitmap(s: np.ndarray, bits: int) -> np.ndarray:
    """Bit i is the parity of the shingles hashed to i (bits is a power of two).

    Two sets' bitmaps differ in at most |A xor B| bits.
    """
    bit = np.bincount((mix(s) & np.uint64(bits - 1)).astype(np.int64), minlength=bits) & 1
    return np.packbits(bit.astype(np.uint8))


def wide_bits(size: int) -> int:
    """Bits of the wide bitmap: about one a shingle, so unrelated sets differ far beyond the threshold."""
    return 1 << max(9, int(size - 1).bit_length())


def _differing(a: bytes, b: bytes) -> int:
    """Differing bits of two wide bitmaps, the longer one folded to the shorter one's length."""
    x, y = (np.frombuffer(v, np.uint8) for v in (a, b))
    if len(x) < len(y):
        x, y = y, x
    x = np.bitwise_xor.reduce(x.reshape(-1, len(y)), axis=0)
    return int(np.unpackbits(x ^ y).sum())


def _near_enough(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs (u, v, size_u, size_v, wide_u, wide_v) whose wide bitmaps allow the threshold."""
    for b in batches:
        su, sv = b.column(2).to_numpy(), b.column(3).to_numpy()
        apart = [_differing(x, y) for x, y in zip(b.column(4).to_pylist(), b.column(5).to_pylist(), strict=True)]
        good = (100 + THRESHOLD) * np.array(apart, np.int64) <= (100 - THRESHOLD) * (su + sv)
        yield b.select([0, 1]).filter(pa.array(good))


def _classes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        sizes, names, bits, wide = [], [], [], []
        for _, s in shingle_sets(b.column(1)):
            sizes.append(len(s))
            names.append(digest(s) if len(s) else None)
            bits.append(parity_bitmap(s, BITMAP_LONGS * 64).view(np.int64))
            wide.append(parity_bitmap(s, wide_bits(len(s))).tobytes())
        yield pa.RecordBatch.from_arrays(
            [b.column(0), pa.array(sizes, pa.int64()), pa.array(names, pa.int64()), pa.array(bits, pa.list_(pa.int64())), pa.array(wide, pa.binary())],
            ["doc_id", "size", "id", "bits", "wide"],
        )


def _keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def batch(rows):
        return pa.RecordBatch.from_arrays([np.concatenate(c) for c in zip(*rows, strict=True)], ["key", "id", "plan"])

    seen: set[int] = set()  # a class is sent once by each task
    for b in batches:
        rows, n = [], 0
        for _, s in shingle_sets(b.column(0)):
            if not len(s) or (name := digest(s)) in seen:
                continue
            seen.add(name)
            keys, plan = segment_keys(s)
            rows.append((keys.view(np.int64), np.full(len(keys), name, np.int64), plan))
            n += len(keys)
            if n > 100_000:
                yield batch(rows)
                rows, n = [], 0
        if rows:
            yield batch(rows)


def _needed_sets(bloom: np.ndarray):
    """(id, grams) of the documents that the filter may hold; the others aren't shingled."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for b in batches:
            docs = b.column(0).fill_null(0).to_numpy()
            b = b.filter(pa.array(bloom_has(bloom, docs) | np.asarray(b.column(0).is_null())))
            names, sets, n = [], [], 0
            for _, s in shingle_sets(b.column(1)):
                if not len(s) or (name := digest(s)) in seen:
                    continue
                seen.add(name)
                names.append(name)
                sets.append(s.view(np.int64))
                n += len(s)
                if n > 200_000:
                    yield pa.RecordBatch.from_arrays([pa.array(names, pa.int64()), pa.array(sets, pa.list_(pa.int64()))], ["id", "grams"])
                    names, sets, n = [], [], 0
            if names:
                yield pa.RecordBatch.from_arrays([pa.array(names, pa.int64()), pa.array(sets, pa.list_(pa.int64()))], ["id", "grams"])

    return run


def _plausible(l: str, r: str) -> str:
    """Sizes within the threshold, and not more differing parity bits than it allows."""
    apart = " + ".join(f"bit_count({l}_bits[{k}] ^ {r}_bits[{k}])" for k in range(BITMAP_LONGS))
    return (
        f"100 * least({l}_size, {r}_size) >= {THRESHOLD} * greatest({l}_size, {r}_size) and "
        f"{100 + THRESHOLD} * ({apart}) <= {100 - THRESHOLD} * ({l}_size + {r}_size)"
    )


def rarest_shingles(sets: DataFrame) -> DataFrame:
    """Buckets (key, id) of single shingles, the finest partition of the universe, for sets (id, grams).

    A set of n shares ceil(0.8 n) shingles or more with any partner, so it can
    leave its ceil(0.8 n) - 1 most frequent ones (by the number of these sets that hold them,
    then hash) and still meets each partner in the rarest that both hold.
    """
    spare = F.floor((F.col("n") * THRESHOLD + 99) / 100) - 1
    grams = sets.select("id", F.size("grams").alias("n"), F.explode("grams").alias("key"))
    often = grams.groupBy("key").agg(F.count("*").alias("often"))
    frequent = F.row_number().over(Window.partitionBy("id").orderBy(F.desc("often"), "key"))
    ranked = grams.join(often, "key").withColumn("rank", frequent)
    return ranked.filter((F.col("rank") > spare) & (F.col("often") > 1)).select("key", "id")


def jaccard_classes(docs: DataFrame, scratch: Scratch | None = None) -> DataFrame:
    """One row per document: doc_id, n_shingles, class_id, component_id.

    Documents link when 100 * |A & B| >= 80 * |A | B| on their distinct 5-word
    shingles (words are runs without ASCII white space, A-Z lower-cased; fewer
    than five words are one shingle). component_id is the smallest doc_id
    reachable by links. class_id is equal for documents with the same set.

    Null, empty and white-space texts have no shingles, class_id null and their
    own doc_id as component_id. A null doc_id keeps its row and takes the
    smallest doc_id of its component, null if there is none. Repeated rows stay
    and share a class. An empty table gives an empty result; other columns are
    not read.
    """
    scratch = scratch or Scratch(docs.sparkSession, "jaccard")
    docs = bounded_batches(docs)
    texts = docs.select("text")
    classes = scratch.write(
        docs.select("doc_id", "text").mapInArrow(_classes, "doc_id long, size long, id long, bits array<long>, wide binary")
    )
    members = bucket_members(texts.mapInArrow(_keys, "key long, id long, plan long").repartition("key"), scratch)
    traits = (
        classes.filter("id is not null")
        .join(members.select("id").distinct(), "id", "left_semi")
        .groupBy("id")
        .agg(F.first("size").alias("size"), F.first("bits").alias("bits"), F.first("wide").alias("wide"), F.min("doc_id").alias("doc_id"))
    )
    traits = scratch.write(traits)

    def grams_of(ids: DataFrame) -> DataFrame:
        """(id, grams) of the classes in ``ids`` (at least; several rows of a class are equal), written."""
        named = scratch.write(ids.join(traits.select("id", "doc_id"), "id"))
        bloom = bloom_of(named.filter("doc_id is not null"), "doc_id", named.count())
        sets = scratch.write(docs.select("doc_id", "text").mapInArrow(_needed_sets(bloom), "id long, grams array<long>"))
        scratch.drop(named)
        return sets

    def linked(pairs: DataFrame, sets: DataFrame) -> DataFrame:
        left = sets.select(F.col("id").alias("u"), F.col("grams").alias("a"))
        right = sets.select(F.col("id").alias("v"), F.col("grams").alias("b"))
        both = F.size(F.array_intersect("a", "b"))
        met = pairs.join(left, "u").join(right, "v").withColumn("both", both)
        # a class that several tasks sent gives its pairs more than once; links are a set
        return met.filter(f"100 * both >= {THRESHOLD} * (size(a) + size(b) - both)").select("u", "v")

    def near(pairs: DataFrame) -> DataFrame:
        sketch = lambda c: traits.select(F.col("id").alias(c), F.col("size").alias(f"size_{c}"), F.col("wide").alias(f"wide_{c}"))
        both = pairs.join(sketch("u"), "u").join(sketch("v"), "v").select("u", "v", "size_u", "size_v", "wide_u", "wide_v")
        return scratch.write(both.mapInArrow(_near_enough, "u long, v long"))

    def verify(pairs: DataFrame) -> DataFrame:
        pairs = near(pairs)
        if pairs.isEmpty():
            return pairs
        sets = grams_of(pairs.select(F.explode(F.array("u", "v")).alias("id")).distinct())
        out = scratch.write(linked(pairs, sets))
        scratch.drop(sets)
        return out

    def refine(ids: DataFrame):
        sets = grams_of(ids)
        sets = scratch.write(sets.join(ids, "id", "left_semi").dropDuplicates(["id"]))
        return scratch.write(rarest_shingles(sets)), lambda pairs: linked(near(pairs), sets)

    _, comps = link_buckets(members, traits.drop("doc_id", "wide"), _plausible, verify, scratch, refine)
    scratch.keep(classes, comps)
    named = classes.select("doc_id", "size", "id").join(comps.withColumnRenamed("node", "id"), "id", "left")
    named = named.select("doc_id", "size", "id", F.coalesce("comp", "id").alias("comp"))
    least = named.filter("comp is not null").groupBy("comp").agg(F.min("doc_id").alias("least"))
    return named.join(least, "comp", "left").select(
        "doc_id",
        F.col("size").alias("n_shingles"),
        F.col("id").alias("class_id"),
        F.when(F.col("comp").isNull(), F.col("doc_id")).otherwise(F.col("least")).alias("component_id"),
    )


def keep_one(docs: DataFrame) -> DataFrame:
    """Documents with one of each near-duplicate group: the smallest doc_id stays.

    Columns and types as given. Documents without text or with a null doc_id
    stay; repeated rows (same doc_id and text) count as copies, one stays.
    """
    scratch = Scratch(docs.sparkSession, "jaccard")
    groups = scratch.write(jaccard_classes(docs, scratch))
    scratch.keep(groups)
    gone = scratch.write(groups.filter("doc_id <> component_id").select("doc_id").distinct())
    kept = drop_ids(docs, gone, "doc_id", gone.count())
    if groups.groupBy("doc_id", "class_id").count().filter("count > 1").isEmpty():
        return kept  # no repeated rows: the sort by text isn't needed
    return kept.dropDuplicates(["doc_id", "text"])
