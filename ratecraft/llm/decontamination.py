"""Benchmark decontamination by template windows, in DataFrame operations only.

Texts are canonicalised into templates: numbers become ``0``, units behind a
number ``µ`` and names ``¤`` (a capitalised word inside a sentence: behind a
lower-case letter, comma or semicolon and white space); the rest is lower-cased
words. Windows of five template words are hashed and joined with the windows
of the benchmark items. A document contains an item when it holds 80 % or more
of the item's distinct windows, each by its template, by its wide template (in which
every capitalised word is a name: word problems begin most sentences with one), or by
its plain lower-cased words: copies in other letter case show no names. Where these windows have slots (placeholders),
the values are compared: each value of the item must stand for one value
throughout an occurrence, as in a question whose names and numbers were
replaced; a jumble of other values is no copy. An occurrence is what lies
nearest one offset (document position less item position), so lists of numbers
meet themselves place by place, and an item is found beside variants of it.
Values of windows that equal the item's always count.

Every document's windows meet the benchmark in one hash join. The benchmark's
windows are broadcast up to BROADCAST_WINDOWS (16 bytes each), else both sides
are shuffled by hash; the counts behind the join are combined before the shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ratecraft.llm.common import Scratch

WORDS = 5
SHARE = 80  # percent of an item's windows
SLOT_SHARE = 80  # percent of slot values that are used consistently
BROADCAST_WINDOWS = 2_000_000
BROADCAST_DOCUMENTS = 1_000_000

#: Units of measure that count as such behind a number.
UNITS = "mm|cm|km|m|mi|miles?|ft|feet|inch(?:es)?|yards?|mg|kg|g|lbs?|pounds?|oz|tons?|ml|l|lit(?:er|re)s?|gallons?|s|sec(?:ond)?s?|min(?:ute)?s?|h|hours?|days?|weeks?|months?|years?|km/h|mph|%|percent|dollars?|euros?|cents?|usd|eur|degrees?|°c|°f|watts?|kwh|volts?"


#: Where a name's mark is put: inside a sentence, or before any capitalised word.
INSIDE, ANYWHERE = (r"([\p{Ll},;][\s\p{Z}]+)(?=\p{Lu})", "$1¤"), (r"(?=\p{Lu})(?<![\p{L}\p{N}])", "¤")


def _plain_numbers(text: Column) -> Column:
    """Text without marks in which numbers are single runs of digits."""
    for mark in "¤µ":
        text = F.replace(text, F.lit(mark), F.lit(" "))
    return F.regexp_replace(text, r"(?<=\d)[.,](?=\d)", "")


def _marked(text: Column, names: tuple[str, str] = INSIDE) -> Column:
    """Of a text with plain numbers: lower-cased text in which names begin with ¤ and units with µ."""
    t = F.lower(F.regexp_replace(text, *names))
    return F.regexp_replace(t, rf"(\d) ?({UNITS})(?![\p{{L}}\p{{N}}])", "$1 µ")


def _words(text: Column) -> Column:
    """Words of a text as an array, without empty ones at its ends."""
    return F.filter(F.split(text, r"[^\p{L}\p{N}¤µ]+"), lambda w: w != "")


def template_words(marked: Column) -> Column:
    """Words of a marked text's template: slots are 0, µ and ¤."""
    t = F.regexp_replace(marked, r"\d+", "0")
    return _words(F.regexp_replace(t, r"¤[\p{L}\p{N}]+", "¤"))


def plain_words(marked: Column) -> Column:
    """The same words, lower-cased, with the values of names and numbers in place (ann, 12)."""
    return _words(F.replace(marked, F.lit("¤"), F.lit("")))


def _hashes(words: Column) -> Column:
    """Of a column of words: hash of the window that begins at each word; a text of fewer words has none."""
    n = F.size(words) - (WORDS - 1)
    at = [lambda w, i, k=k: F.get(words, i + k) for k in range(1, WORDS)]
    full = F.transform(words, lambda w, i: F.xxhash64(w, *(f(w, i) for f in at)))
    return F.when(n > 0, F.slice(full, 1, F.greatest(n, F.lit(1)))).otherwise(F.array().cast("array<bigint>"))


def _window_rows(rows: DataFrame, name: str) -> DataFrame:
    """(name, hash) of the windows of ``words``, hashes as in :func:`_hashes`, which a lambda computes:
    rows of neighbouring words are hashed by compiled code."""
    words, n = F.col("words"), F.size("words")
    next_words = [F.slice(words, k + 1, n).alias(f"w{k}") for k in range(1, WORDS)]
    neighbours = rows.select(name, F.inline(F.arrays_zip(words.alias("w0"), *next_words)))
    # the text's last words have fewer neighbours
    return neighbours.filter(f"w{WORDS - 1} is not null").select(name, F.xxhash64(*(f"w{k}" for k in range(WORDS))).alias("hash"))


def item_windows(benchmark: DataFrame) -> DataFrame:
    """(item_id, at, size, hash, wide, plain, slots) of each window.

    hash is the template's, wide the wide template's, plain that of the plain words; slots are (place in
    the window, value), size is the item's words.
    """
    rows = _three_forms(benchmark.filter("item_id is not null"), "item_id")
    return rows.select("item_id", "at", F.size("w").alias("size"), "h.hash", "h.wide", "h.plain", _slots("at").alias("slots"))


def _three_forms(rows: DataFrame, *names: str) -> DataFrame:
    """(names, w, v, at, h): each window's place and its hashes by template, wide template and plain words."""
    rows = rows.select(*names, _plain_numbers(F.col("text")).alias("t"))
    rows = rows.select(*names, _marked(F.col("t")).alias("m"), _marked(F.col("t"), ANYWHERE).alias("a"))
    rows = rows.select(*names, template_words(F.col("m")).alias("w"), template_words(F.col("a")).alias("u"), plain_words(F.col("m")).alias("v"))
    forms = F.arrays_zip(_hashes(F.col("w")).alias("hash"), _hashes(F.col("u")).alias("wide"), _hashes(F.col("v")).alias("plain"))
    return rows.select(*names, "w", "v", F.posexplode(forms).alias("at", "h"))


def _slots(at: str) -> Column:
    """(place, value) of the slots in the window that begins at a word, in order, words left out."""
    kinds = F.slice("w", F.col(at) + 1, WORDS)
    values = F.slice("v", F.col(at) + 1, WORDS)
    both = F.transform(F.arrays_zip(kinds.alias("k"), values.alias("x")), lambda z, i: F.struct(i.alias("k"), z["k"].alias("kind"), z["x"].alias("x")))
    slot = F.filter(both, lambda z: z["kind"].isin("0", "¤") | z["kind"].rlike(r"^\d|^0"))
    return F.transform(slot, lambda z: F.struct(z["k"].alias("k"), z["x"].alias("x")))


def contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """One row per document and benchmark item in it: doc_id, item_id, share, slots, consistent.

    share is the part of the item's distinct windows that the document holds,
    0.8 or more. slots counts the item's slot values seen, consistent those
    that stand for one value (of the document, or of the best occurrence in
    it) or stand unchanged in a window; items are reported when 80 % of
    them are (or there are none). Items of fewer than five words are too short
    to show a leak. Null and empty texts have no windows. Rows with a null
    doc_id or item_id can't be named and are left out; rows that share a doc_id
    count as one document. Empty tables give an empty result; other columns are
    not read.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark, "decontamination")
    items = scratch.write(item_windows(benchmark))
    # a distinct window is a template; its template, wide template or any of its plain forms shows it
    sizes = items.groupBy("item_id").agg(F.count_distinct("hash").alias("windows"))
    distinct = items.select("item_id", F.col("hash").alias("window"), F.explode(F.array("hash", "wide", "plain")).alias("hash")).distinct()
    small = distinct.count() <= BROADCAST_WINDOWS

    named = docs.filter("doc_id is not null").select("doc_id", "text")
    # texts and words are columns of their own, computed once however often they are used
    texts = named.select("doc_id", _plain_numbers(F.col("text")).alias("t"))
    words = texts.select("doc_id", _marked(F.col("t")).alias("m"), _marked(F.col("t"), ANYWHERE).alias("a"))
    # without names and numbers the plain words are the template's
    plain = F.when(F.col("m").rlike(r"[¤\d]"), plain_words(F.col("m")))
    none = F.array().cast("array<string>")
    words = words.select(
        "doc_id",
        template_words(F.col("m")).alias("w"),
        F.coalesce(F.when(F.col("a") != F.col("m"), template_words(F.col("a"))), none).alias("u"),
        F.coalesce(plain, none).alias("v"),
    )
    forms = words.select("doc_id", F.explode(F.array("w", "u", "v")).alias("words")).filter(F.size("words") >= WORDS)
    windows = _window_rows(forms, "doc_id")
    met = windows.join(F.broadcast(distinct) if small else distinct, "hash")
    found = (
        met.select("doc_id", "item_id", "window")
        .distinct()
        .groupBy("doc_id", "item_id")
        .agg(F.count("*").alias("held"))
        .join(F.broadcast(sizes) if small else sizes, "item_id")
        .filter(f"100 * held >= {SHARE} * windows")
        .select("doc_id", "item_id", (F.col("held") / F.col("windows")).alias("share"))
    )
    found = scratch.write(found)

    # slots: only documents that hold an item with slots are read again
    slotted = items.filter("size(slots) > 0").select("item_id", F.col("at").alias("item_at"), "size", F.explode(F.array_distinct(F.array("hash", "wide", "plain"))).alias("hash"), "slots")
    pairs = scratch.write(found.join(slotted.select("item_id").distinct(), "item_id", "left_semi").select("doc_id", "item_id"))
    again = pairs.select("doc_id").distinct()
    if again.count() <= BROADCAST_DOCUMENTS:
        again = F.broadcast(again)
    rows = named.join(again, "doc_id", "left_semi").select("doc_id", F.xxhash64("text").alias("copy"), "text")
    rows = _three_forms(rows, "doc_id", "copy")
    rows = rows.select("doc_id", "copy", "v", "at", F.explode(F.array_distinct(F.array("h.hash", "h.wide", "h.plain"))).alias("hash"))
    rows = rows.select("doc_id", "copy", "at", "hash", F.slice("v", F.col("at") + 1, WORDS).alias("given"))
    same = F.forall("slots", lambda z: F.get("given", z["k"]) == z["x"])
    filled = F.transform("slots", lambda z: F.struct((F.col("item_at") + z["k"]).alias("place"), z["x"].alias("asked"), F.get("given", z["k"]).alias("given")))
    values = (
        rows.join(slotted, "hash")
        .join(pairs, ["doc_id", "item_id"], "left_semi")
        .select("doc_id", "item_id", "copy", (F.col("at") - F.col("item_at")).alias("offset"), "size", same.alias("same"), F.explode(filled).alias("s"))
        .groupBy("doc_id", "item_id", "copy", "offset", "size", "s.place", "s.asked", "s.given")
        .agg(F.max("same").alias("same"))
    )
    values = scratch.write(values)
    one = (F.min("given") == F.max("given")) | F.max("same")
    whole = (
        values.groupBy("doc_id", "item_id", "asked")
        .agg(one.alias("one"))
        .groupBy("doc_id", "item_id")
        .agg(F.count("*").alias("slots"), F.count_if("one").alias("consistent"))
    )
    whole = scratch.write(whole)
    # the others by occurrence: around each offset, every slot takes the value that lies nearest
    unclear = values.join(whole.filter(f"100 * consistent < {SLOT_SHARE} * slots").select("doc_id", "item_id"), ["doc_id", "item_id"], "left_semi")
    # offsets meet anchors of their own or a neighbouring stretch of an item's size, not all of the document's
    stretch = F.floor(F.col("offset") / F.col("size")).alias("stretch")
    unclear = unclear.select("*", stretch)
    near = F.explode(F.array(*(F.col("stretch") + k for k in (-1, 0, 1)))).alias("stretch")
    anchors = unclear.select("doc_id", "item_id", "copy", F.col("offset").alias("anchor"), "stretch").distinct()
    anchors = anchors.select("doc_id", "item_id", "copy", "anchor", near)
    away = F.abs(F.col("offset") - F.col("anchor"))
    best = (
        unclear.join(anchors, ["doc_id", "item_id", "copy", "stretch"])
        .filter(away <= F.col("size"))
        .groupBy("doc_id", "item_id", "copy", "anchor", "place", "asked")
        .agg(F.min(F.struct(away.alias("away"), "offset", "given", "same")).alias("s"))
        .select("doc_id", "item_id", "copy", "anchor", "asked", "s.given", "s.same")
        .groupBy("doc_id", "item_id", "copy", "anchor", "asked")
        .agg(one.alias("one"))
        .groupBy("doc_id", "item_id", "copy", "anchor")
        .agg(F.count_if("one").alias("best"))
        .groupBy("doc_id", "item_id")
        .agg(F.max("best").alias("best"))
    )
    values = whole.join(best, ["doc_id", "item_id"], "left").select("doc_id", "item_id", "slots", F.greatest("consistent", "best").alias("consistent"))
    out = found.join(values, ["doc_id", "item_id"], "left").select(
        "doc_id", "item_id", "share", F.coalesce("slots", F.lit(0)).alias("slots"), F.coalesce("consistent", F.lit(0)).alias("consistent")
    )
    return out.filter(f"100 * consistent >= {SLOT_SHARE} * slots")


def drop_contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Documents that hold no benchmark item, with all their columns; rows with a null doc_id stay."""
    gone = Scratch(docs.sparkSession, "decontamination").write(contaminated(docs, benchmark).select(F.col("doc_id").alias("__gone")).distinct())
    return docs.join(gone, docs["doc_id"] == gone["__gone"], "left_anti").select(docs.columns)
