"""URL filters: host rules, and association rules mined by FP-growth; DataFrame operations only.

Urls become sets of typed tokens (host labels and their parts, top-level
domain, path segments, query keys). Spark's FP-growth mines the frequent token
sets of labelled pages together with their label (tokens that always stand
together count as one item); a set that implies the label with enough support
and confidence becomes a rule, of whatever length. Pruning keeps a rule only if
it is more confident than every rule on a subset of its tokens and blocks more
often than the label's share. Rules match by an inverted index: each is filed
under its rarest token, a page looks up its own tokens there, and the
rule's other tokens are then checked.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from functools import reduce

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ratecraft.llm.common import Scratch
from ratecraft.llm.html_extract import host_of

#: (verdict, host, path) of the fixed rule list.
HOST_RULES = [
    ("allow", "com", "/"),
    ("block", "example.com", "/en/"),
    ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"),
    ("block", "net", "/fr/"),
]

MIN_SUPPORT = 0.002  # of the labelled pages, and at least MIN_PAGES pages with the label
MIN_PAGES = 5
MIN_CONFIDENCE = 0.6
MIN_LIFT = 1.5
BLOCK = "label:block"


def path_of(url: str) -> Column:
    """Path of a url column: behind the host up to ? # or the end; empty without ://."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def url_tokens(host: Column, path: Column, url: Column) -> Column:
    """Distinct typed tokens of a url; runs of digits are one token each place."""
    number = lambda x: F.regexp_replace(x, r"\d+", "0")
    labels = F.split(host, r"\.")
    typed = lambda kind, xs: F.transform(F.filter(xs, lambda x: x != ""), lambda x: F.concat(F.lit(f"{kind}:"), number(x)))
    top = F.when(host != "", F.array(F.concat(F.lit("top:"), F.element_at(labels, -1)))).otherwise(F.array())
    query = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)\?([^#]*)", 1)
    keys = F.transform(F.split(query, "&"), lambda x: F.substring_index(x, "=", 1))
    return F.array_distinct(
        F.concat(typed("host", labels), typed("part", F.split(host, r"[.\-]")), top, typed("path", F.split(path, "/")), typed("key", keys))
    )


def host_verdict(host: Column, path: Column, rules: Sequence[tuple[str, str, str]] = HOST_RULES) -> Column:
    """struct(rule, verdict) of the longest rule that fits, null if none does.

    A rule fits its host and the host's subdomains when the path starts with
    the rule's. The rules are a parameter list: constants of the plan.
    """
    out = F.lit(None).cast("struct<rule:string,verdict:string>")
    for verdict, rule_host, rule_path in sorted(rules, key=lambda r: len(r[1] + r[2])):
        fits = ((host == rule_host) | host.endswith(f".{rule_host}")) & path.startswith(rule_path)
        out = F.when(fits, F.struct(F.lit(rule_host + rule_path).alias("rule"), F.lit(verdict).alias("verdict"))).otherwise(out)
    return out


def token_classes(rows: DataFrame, least: int) -> DataFrame:
    """(token, class, others): tokens of at least ``least`` rows, those that stand in the same rows as one class.

    rows: (row, tokens). A class is named by its first token and lists all of
    them. Sets of rows are compared by their sizes and two 64-bit sums.
    """
    each = rows.select("row", F.explode("tokens").alias("token"))
    hashes = [F.sum(F.xxhash64("row", F.lit(k)).cast("decimal(20,0)")) for k in (1, 2)]
    where = each.groupBy("token").agg(F.count("*").alias("n"), *(h.alias(f"h{k}") for k, h in enumerate(hashes))).filter(F.col("n") >= least)
    same = where.groupBy("n", "h0", "h1").agg(F.sort_array(F.collect_list("token")).alias("others"))
    return same.select(F.explode("others").alias("token"), F.col("others")[0].alias("class"), "others")


def mine_rules(pages: DataFrame, labels: DataFrame) -> DataFrame:
    """(rule_id, tokens, support, confidence) of the token sets that imply the block label.

    tokens is a list of lists: a url must have a token of each. Those of one
    list stand on the same labelled pages, so they make equal rules; they are one item
    in the mining, which would else list all their subsets. Rules may be of any
    length. A labelled page (labels.doc_id = page_id) is to be blocked if it is
    toxic or of low quality. No labelled pages give no rules.
    """
    scratch = Scratch(pages.sparkSession, "url-rules")
    bad = labels.filter("doc_id is not null").groupBy("doc_id").agg(F.max(F.coalesce(F.expr("toxic = 1 or quality = 0"), F.lit(False)).cast("int")).alias("bad"))
    rows = pages.join(bad.withColumnRenamed("doc_id", "page_id"), "page_id").filter("bad = 1 or size(tokens) > 0")
    rows = scratch.write(rows.select(F.monotonically_increasing_id().alias("row"), "tokens", "bad"))
    total, blocked = rows.agg(F.count("*"), F.count_if(F.col("bad") == 1)).first()
    schema = "rule_id long, tokens array<array<string>>, support double, confidence double"
    if not total or not blocked:
        return pages.sparkSession.createDataFrame([], schema)
    # tokens that are too rare to be in a rule don't enter the mining
    support = max(MIN_SUPPORT, MIN_PAGES / total)
    classes = scratch.write(token_classes(rows, max(1, math.floor(support * total))))
    named = rows.select("row", F.explode("tokens").alias("token")).join(classes.select("token", "class"), "token")
    named = named.groupBy("row").agg(F.collect_set("class").alias("items"))
    label = F.when(F.col("bad") == 1, F.array(F.lit(BLOCK))).otherwise(F.array())
    items = rows.join(named, "row", "left").select(F.concat(F.coalesce("items", F.array()), label).alias("items"))
    items = scratch.write(items.filter("size(items) > 0"))
    model = FPGrowth(itemsCol="items", minSupport=min(1.0, support), minConfidence=MIN_CONFIDENCE).fit(items)
    sets = scratch.write(model.freqItemsets.select(F.array_sort("items").alias("items"), "freq"))
    with_label = sets.filter(F.array_contains("items", BLOCK)).select(F.array_remove("items", BLOCK).alias("items"), F.col("freq").alias("hits")).filter("size(items) > 0")
    found = scratch.write(with_label.join(sets, "items").select("items", F.size("items").alias("n"), "hits", (F.col("hits") / F.col("freq")).alias("confidence")))
    # pruning: a subset of the tokens that is as confident makes a rule superfluous. Every subset of a
    # frequent set is frequent, so the best of all subsets passes from length to length
    longest = found.agg(F.max("n")).first()[0] or 0
    level = scratch.write(found.filter("n = 1").withColumn("best", F.lit(0.0)))
    levels = [level]
    for n in range(2, longest + 1):
        less = F.explode(F.transform("items", lambda x: F.array_remove("items", x))).alias("less")
        parts = found.filter(F.col("n") == n).select("items", less).withColumnsRenamed({"items": "whole", "less": "items"})
        best = parts.join(level.select("items", F.greatest("confidence", "best").alias("had")), "items").groupBy("whole").agg(F.max("had").alias("best"))
        level = scratch.write(found.filter(F.col("n") == n).join(best.withColumnRenamed("whole", "items"), "items").select(levels[0].columns))
        levels.append(level)
    rules = reduce(DataFrame.unionByName, levels).filter(
        (F.col("confidence") > F.col("best")) & (F.col("confidence") >= max(MIN_CONFIDENCE, min(1.0, MIN_LIFT * blocked / total)))
    )
    rules = rules.select(F.xxhash64("items").alias("rule_id"), "items", (F.col("hits") / total).alias("support"), "confidence")
    whole = rules.select("rule_id", F.posexplode("items").alias("at", "token")).join(classes.select("token", "others"), "token")
    whole = whole.groupBy("rule_id").agg(F.transform(F.array_sort(F.collect_list(F.struct("at", "others"))), lambda x: x["others"]).alias("tokens"))
    out = scratch.write(rules.join(whole, "rule_id").select("rule_id", "tokens", "support", "confidence"))
    scratch.keep(out)
    return out


def match_rules(pages: DataFrame, rules: DataFrame) -> DataFrame:
    """(tokens, confidence) of the token lists that a rule fits: the most confident one.

    pages: (tokens). The index files a rule under the rarest of its items (each
    token of it), so a token that most urls share files no rule that has a rarer one.
    """
    items = rules.select("rule_id", F.explode("tokens").alias("item"))
    uses = items.groupBy("item").agg(F.count("*").alias("uses"))
    rarest = items.join(uses, "item").groupBy("rule_id").agg(F.min(F.struct("uses", "item"))["item"].alias("item"))
    index = rules.join(rarest, "rule_id").select(F.explode("item").alias("token"), F.col("tokens").alias("asked"), "confidence")
    urls = pages.select("tokens").distinct()
    return (
        urls.select("tokens", F.explode("tokens").alias("token"))
        .join(index, "token")
        .filter(F.forall("asked", lambda item: F.arrays_overlap(item, F.col("tokens"))))
        .groupBy("tokens")
        .agg(F.max("confidence").alias("confidence"))
    )


def judge_urls(pages: DataFrame, labels: DataFrame, host_rules: Sequence[tuple[str, str, str]] = HOST_RULES) -> DataFrame:
    """Per page: page_id, host, path, rule, verdict, confidence.

    The longest host rule that fits decides; without one, an association rule
    that fits blocks, and other pages are allowed. A null url, or one without
    ://, has an empty host and path, no tokens and is allowed. Each url is judged
    by itself, whatever the page_id, which may be null or repeated. Repeated rows
    stay; an empty table gives an empty result; other columns are not read.
    """
    rows = pages.select("page_id", "url", host_of("url").alias("host"), path_of("url").alias("path"))
    rows = rows.select(
        "page_id", "host", "path", host_verdict(F.col("host"), F.col("path"), host_rules).alias("fixed"),
        F.array_sort(url_tokens(F.col("host"), F.col("path"), F.col("url"))).alias("tokens"),
    )
    rules = mine_rules(rows.select("page_id", "tokens"), labels)
    matched = match_rules(rows.filter("fixed is null"), rules)
    return rows.join(matched, "tokens", "left").select(
        "page_id", "host", "path", F.col("fixed.rule").alias("rule"),
        F.coalesce("fixed.verdict", F.when(F.col("confidence").isNotNull(), F.lit("block")).otherwise(F.lit("allow"))).alias("verdict"),
        F.when(F.col("fixed").isNull(), F.col("confidence")).alias("confidence"),
    )
