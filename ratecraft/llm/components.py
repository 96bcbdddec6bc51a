"""Candidate buckets to links to connected components, without all pairs of a bucket.

``link_buckets`` turns members (key, id) of buckets into verified links that
connect whatever the buckets' verified pairs connect:

1. star: each member of a bucket is checked against the bucket's hub;
2. components of the links found so far;
3. cross: what is left are pairs of one bucket in different components. Each
   member outside the bucket's largest component is checked against the
   members of other components. That is done in buckets of at most WIDE_BUCKET
   members; the members of wider ones are dealt anew to finer buckets by
   ``refine``, where partners meet too, and checked there.

A group of near copies becomes one component in step 1, so its pairs are never
produced; no pair that could connect two components is left out.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ratecraft.llm.common import Scratch


def connected_components(edges: DataFrame, scratch: Scratch, max_rounds: int = 40) -> DataFrame:
    """(node, comp) for every node of ``edges`` (u, v): comp is the smallest node reachable.

    Large-star and small-star rounds, each a partially aggregated minimum and
    a join; the edges of each round are written, and the rounds end when the
    edge set stands still; more than ``max_rounds`` are an error. No edges give an
    empty table.
    """
    # every edge as (larger, smaller)
    now = scratch.write(
        edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).filter("u <> v").distinct()
    )
    seen = None
    for _ in range(max_rounds):
        mark = now.agg(F.count("*").alias("n"), F.bit_xor(F.xxhash64("u", "v")).alias("x")).first()
        if seen == tuple(mark) or not mark["n"]:
            break
        seen = tuple(mark)
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.join(low, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.filter("u <> v").distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (
            large.join(least, "u")
            .select(F.explode(F.array(F.struct("u", F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("e"))
            .select("e.u", "e.v")
            .filter("u <> v")
            .distinct()
        )
        nxt = scratch.write(small)
        scratch.drop(now)
        now = nxt
    else:
        raise RuntimeError(f"components aren't at rest after {max_rounds} rounds")
    # at rest every edge points at its component's smallest node
    roots = now.select(F.col("v").alias("node"), F.col("v").alias("comp"))
    return now.select(F.col("u").alias("node"), F.col("v").alias("comp")).unionByName(roots).distinct()


#: A bucket of more ids is hot: ids that can do without it leave it (see bucket_members).
HOT_BUCKET = 16
#: Pairs are formed in buckets of up to so many ids; the ids of wider ones are refined.
WIDE_BUCKET = 32
#: spare counts are packed below this base: plan = group * SPARE + spare.
SPARE = 1 << 20


def bucket_members(rows: DataFrame, scratch: Scratch) -> DataFrame:
    """(key, id, hub) of the keys that two ids or more share, written.

    rows: (key, id, plan), dealt by key. plan = group * SPARE + spare says that
    the id shares more than ``spare`` of its keys of this group with every
    partner; -1 if it can't spare any. An id leaves its ``spare`` hottest buckets
    of the group (by size, then key), as far as they are hot. Partners still meet: the
    coldest key they share is among the hottest ``spare`` of neither, since all
    keys that they share, more than that, are as hot or hotter.

    The hub is the member with the most company over all its buckets (then the
    largest id): in a group of edited copies, the text they were made from.
    """
    w = Window.partitionBy("key")
    met = rows.select("key", "id", "plan", F.min("id").over(w).alias("low"), F.max("id").over(w).alias("high"), F.count("*").over(w).alias("n"))
    met = scratch.write(met.filter("low <> high").select("key", "id", "plan", "low", "n").distinct())
    # most buckets hold two ids: nothing to choose there
    pairs = met.filter("n = 2").select("key", "id", F.col("low").alias("hub"))
    company = met.groupBy("id").agg(F.sum("n").alias("company"))
    cold = met.filter(f"n > 2 and (n <= {HOT_BUCKET} or plan < 0)")
    hottest = F.row_number().over(Window.partitionBy("id", "plan").orderBy(F.desc("n"), "key"))
    hot = met.filter(f"n > {HOT_BUCKET} and plan >= 0").withColumn("rank", hottest).filter(f"rank > plan % {SPARE}")
    stay = cold.unionByName(hot.select(cold.columns)).join(company, "id").select("key", "id", "company")
    lead = F.max(F.struct("company", "id")).over(w)["id"].alias("hub")
    out = stay.select("key", "id", lead, F.min("id").over(w).alias("low"), F.max("id").over(w).alias("high"))
    out = scratch.write(out.filter("low <> high").select("key", "id", "hub").distinct().unionByName(pairs))
    scratch.drop(met)
    return out


def link_buckets(
    members: DataFrame,
    traits: DataFrame,
    plausible: Callable[[str, str], str],
    verify: Callable[[DataFrame], DataFrame],
    scratch: Scratch,
    refine: Callable[[DataFrame], tuple[DataFrame, Callable[[DataFrame], DataFrame]]] | None = None,
) -> tuple[DataFrame, DataFrame]:
    """Links (u, v) that connect each component, and its members (node, comp).

    members: (key, id, hub), written. traits: one row per id with what
    ``plausible`` reads, a necessary condition in SQL over the columns of two
    sides. verify: keeps the pairs (u, v) that are linked indeed. refine: given
    some ids, finer buckets (key, id) in which any two linked ones of them meet,
    and a verify for their pairs; without it all buckets are treated as narrow.
    """
    names = [c for c in traits.columns if c != "id"]
    side = lambda s: traits.select(F.col("id").alias(f"{s}_id"), *(F.col(c).alias(f"{s}_{c}") for c in names))
    condition = plausible("l", "r")

    star = members.filter("id <> hub").select(F.least("hub", "id").alias("l_id"), F.greatest("hub", "id").alias("r_id")).distinct()
    star = star.join(side("l"), "l_id").join(side("r"), "r_id").filter(condition)
    star = scratch.write(star.select(F.col("l_id").alias("u"), F.col("r_id").alias("v")))
    links = scratch.write(verify(star))
    comps = scratch.write(connected_components(links, scratch))
    cols = ["id", "comp", "lead", *names]

    def placed(members: DataFrame) -> DataFrame:
        """Members of buckets that hold several components, with the bucket's largest one and its width."""
        wk, wc = Window.partitionBy("key"), Window.partitionBy("key", "comp")
        return (
            members.select("key", "id")
            .join(comps.withColumnRenamed("node", "id"), "id", "left")
            .withColumn("comp", F.coalesce("comp", "id"))
            .withColumn("size", F.count("*").over(wc))
            .withColumn("lead", F.max(F.struct("size", "comp")).over(wk)["comp"])
            .withColumn("least", F.min("comp").over(wk))
            .withColumn("most", F.max("comp").over(wk))
            .withColumn("width", F.count("*").over(wk))
            .filter("least <> most")
            .select("key", "id", "comp", "lead", "width")
        )

    def crossed(rows: DataFrame) -> DataFrame:
        """Plausible pairs of one bucket in different components that weren't checked yet."""
        left = rows.filter("comp <> lead").select("key", *(F.col(c).alias(f"l_{c}") for c in cols))
        right = rows.select("key", *(F.col(c).alias(f"r_{c}") for c in cols))
        cross = (
            left.join(right, "key")
            .filter("l_comp <> r_comp and (r_comp = r_lead or l_id < r_id)")
            .filter(condition)
            .select(F.least("l_id", "r_id").alias("u"), F.greatest("l_id", "r_id").alias("v"))
            .distinct()
        )
        return scratch.write(cross.join(star, ["u", "v"], "left_anti"))

    found = scratch.write(placed(members).join(traits, "id"))
    narrow = found if refine is None else found.filter(f"width <= {WIDE_BUCKET}")
    more = scratch.write(verify(crossed(narrow)))
    if refine is not None:
        wide = scratch.write(found.filter(f"width > {WIDE_BUCKET}").select("id").distinct())
        if not wide.isEmpty():
            finer, verify_finer = refine(wide)
            found_finer = scratch.write(placed(finer).join(traits, "id"))
            more = scratch.write(more.unionByName(verify_finer(crossed(found_finer))).distinct())
            scratch.drop(found_finer)
    scratch.drop(found)
    if more.isEmpty():
        return links, comps
    both = links.unionByName(more)
    comps2 = scratch.write(connected_components(both, scratch))
    return both, comps2
