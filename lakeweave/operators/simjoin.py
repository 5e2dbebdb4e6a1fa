"""Exact set-similarity join by prefix filtering, and the groups it links.

Two sets whose Jaccard similarity is at least t share an item among the first
``n - ceil(t * n) + 1`` items of each, whatever order the items are taken in. Taken rarest
first, that prefix of a set which is like no other holds only items of its own,
so it has no bucket at all. What shares a bucket must also be alike in size,
and is confirmed on the full sets: no similarity is estimated and no pair lost.

Equal sets are one node. Links inside a bucket are found without listing its
pairs: members are first compared with the bucket's least one, and then only
members that are still in different components are compared. Of these buckets the
largest component is dealt into cells, and the others meet it cell by cell.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from lakeweave.session import checkpoint_root

#: Members of a bucket that one cell holds, about.
CELL = 512
#: Rows of a table that is broadcast after being counted.
BROADCAST = 200_000
#: Ids of rows whose set another row holds too, of which more are joined by shuffle.
COPIES = 1_000_000


def small(df: DataFrame, rows: int = BROADCAST) -> DataFrame:
    """``df`` marked for broadcast if it was counted to hold at most ``rows`` rows."""
    return F.broadcast(df) if df.limit(rows + 1).count() <= rows else df


def components(edges: DataFrame) -> DataFrame:
    """Connected components of an edge list ``(src, dst)``; returns ``(node,
    component)`` with the least node as the label.

    Alternates two steps until no edge changes: every larger neighbour of a
    node moves to the least of its neighbourhood, then a node and its smaller
    neighbours move to the least of these. Edges only ever point to smaller
    nodes, so a hot node gathers no list. Each round is a ``checkpoint()``."""
    checkpoint_root(edges.sparkSession)
    e = (edges.where(F.col("src") != F.col("dst"))
         .select(F.greatest("src", "dst").alias("v"), F.least("src", "dst").alias("m")).distinct().checkpoint())
    seen = None
    while True:
        state = e.agg(F.count(F.lit(1)), F.sum(F.xxhash64("v", "m").cast("decimal(20,0)"))).first()
        if state == seen:
            break
        seen = state
        both = e.select(F.col("v").alias("u"), F.col("m").alias("w")).unionByName(e.select(F.col("m").alias("u"), F.col("v").alias("w")))
        least = both.groupBy("u").agg(F.min("w").alias("low")).select("u", F.least("u", "low").alias("low"))
        large = both.where("w > u").join(least, "u").select(F.col("w").alias("v"), F.col("low").alias("m")).distinct()
        least = large.groupBy("v").agg(F.min("m").alias("low"))
        e = (large.join(least, "v").select(F.col("m").alias("v"), F.col("low").alias("m")).where("v <> m")
             .unionByName(least.select("v", F.col("low").alias("m"))).distinct().checkpoint())
    return e.select(F.col("v").alias("node"), F.col("m").alias("component")).unionByName(
        e.select(F.col("m").alias("node"), F.col("m").alias("component")).distinct())


def prefixes(sets: DataFrame, percent: int) -> DataFrame:
    """(node, n, prefix): the items of each set's prefix that other sets hold
    too, for sets (node, n, items). Sets without such an item are left out."""
    # moved by item once, for the count and for the join with it
    single = sets.select("node", F.explode("items").alias("item")).where(F.col("item").isNotNull()).repartition("item")
    count = single.groupBy("item").agg(F.count(F.lit(1)).cast("int").alias("c"), F.min("node").alias("low"), F.max("node").alias("high")).where("low < high")
    shared = (single.join(count.select("item", "c"), "item").groupBy("node")
              .agg(F.sort_array(F.collect_list(F.struct("c", "item"))).alias("shared"))
              .join(sets.select("node", "n"), "node"))
    # items of its own come first in every set, then the shared ones
    size = F.col("n") - F.floor((F.col("n") * percent + 99) / 100) + 1
    own = F.col("n") - F.size("shared")
    rows = shared.withColumn("take", (size - own).cast("int")).where("take > 0")
    return rows.select("node", "n", F.transform(F.slice("shared", F.lit(1), F.col("take")), lambda x: x["item"]).alias("prefix"))


def sizes_allow(a: Column, b: Column, percent: int) -> Column:
    return (F.least(a, b) * 100 >= F.greatest(a, b) * percent)


def confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose full sets are similar enough, as (src, dst)."""
    pairs = pairs.checkpoint()
    wanted = pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct()
    mine = sets.join(small(wanted.checkpoint()), "node", "left_semi")
    both = (pairs.join(mine.select(F.col("node").alias("a"), F.col("items").alias("x")), "a")
            .join(mine.select(F.col("node").alias("b"), F.col("items").alias("y")), "b"))
    common = F.size(F.array_intersect("x", "y"))
    return (both.withColumn("common", common)
            .where(F.col("common") * 100 >= (F.size("x") + F.size("y") - F.col("common")) * percent)
            .select(F.col("b").alias("src"), F.col("a").alias("dst")))


def ordered(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def across(lab: DataFrame, heads: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) of one bucket and different components, for members ``lab``
    (bucket, node, n, prefix, component) of the buckets that hold more than one. Pairs with a bucket's head were
    compared before; of the buckets that two sets share, only the least gives the pair."""
    per = lab.groupBy("bucket", "component").agg(F.count(F.lit(1)).alias("k"))
    split = (per.groupBy("bucket").agg(F.sum("k").alias("all"), F.max(F.struct("k", "component")).alias("most"), F.count(F.lit(1)).alias("parts"))
             .where("parts > 1").select("bucket", F.col("most.component").alias("main"), F.ceil(F.col("all") / CELL).cast("int").alias("cells")))
    rows = lab.join(split, "bucket").join(heads, ["bucket", "node"], "left_anti")
    rows = rows.withColumn("cell", F.pmod(F.xxhash64("node", "bucket"), F.col("cells")).cast("int"))
    rows = rows.select("bucket", "cell", "cells", "main", "node", "n", "prefix", "component").checkpoint()
    few = rows.where(F.col("component") != F.col("main")).withColumn("cell", F.explode(F.sequence(F.lit(0), F.col("cells") - 1)))
    x, y = few.alias("x"), rows.alias("y")
    of = lambda side, c: F.col(f"{side}.{c}")
    met = x.join(y, (of("x", "bucket") == of("y", "bucket")) & (of("x", "cell") == of("y", "cell")))
    # two members outside the main component meet from both sides: one is enough
    met = met.where((of("x", "component") != of("y", "component"))
                    & ((of("y", "component") == of("y", "main")) | (of("x", "node") < of("y", "node")))
                    & sizes_allow(of("x", "n"), of("y", "n"), percent))
    met = met.where(F.array_min(F.array_intersect(of("x", "prefix"), of("y", "prefix"))) == of("x", "bucket"))
    return ordered(met.select(of("x", "node").alias("a"), of("y", "node").alias("b")))


def linked_sets(sets: DataFrame, percent: int) -> DataFrame:
    """(node, component) of every set that is similar to another, ``sets``:
    (node, n, items), items without repeats and unequal sets."""
    pre = prefixes(sets, percent).checkpoint()
    members = pre.select(F.explode("prefix").alias("bucket"), "node", "n")
    heads = members.groupBy("bucket").agg(F.min(F.struct("n", "node")).alias("h"), F.count(F.lit(1)).alias("k")).where("k > 1")
    heads = heads.select("bucket", F.col("h.node").alias("head"), F.col("h.n").alias("head_n"), "k").checkpoint()
    near = members.join(heads, "bucket").where((F.col("node") != F.col("head")) & sizes_allow(F.col("n"), F.col("head_n"), percent))
    first = confirmed(ordered(near.select(F.col("head").alias("a"), F.col("node").alias("b"))), sets, percent).checkpoint()
    comp = components(first)
    # a bucket of two has been compared
    lab = (members.join(heads.where("k > 2").select("bucket"), "bucket").join(comp, "node", "left")
           .join(pre.select("node", "prefix"), "node").withColumn("component", F.coalesce("component", "node")))
    rest = across(lab, heads.select("bucket", F.col("head").alias("node")), percent)
    return components(first.unionByName(confirmed(rest, sets, percent)))


def similar_groups(rows: DataFrame, percent: int) -> DataFrame:
    """(id, component): ids linked to another by sets of ``percent`` Jaccard
    similarity or more, with the least id of their group; ``rows``: (id,
    items), items without repeats. Empty and NULL sets, and rows without an id,
    are linked with nothing; sets that share an id are one document's."""
    checkpoint_root(rows.sparkSession)
    kept = rows.select("id", F.array_sort("items").alias("items"))
    kept = kept.select("id", *(F.xxhash64(F.lit(s), "items").alias(f"key{s}") for s in (1, 2)), F.monotonically_increasing_id().alias("node"),
                       F.size("items").alias("n"), "items").checkpoint()
    # past the checkpoint: a filter on the items would compute them once more
    kept = kept.where(F.col("id").isNotNull() & (F.col("n") > 0))
    # equal sets go by the least row: the items themselves are not moved for that
    rows = kept.select("id", "key1", "key2", "node")
    rows = rows.join(rows.groupBy("key1", "key2").agg(F.min("node").alias("least")), ["key1", "key2"]).select("id", "node", "least").checkpoint()
    copies = small(rows.where("node <> least").select("node"), COPIES)
    sets = kept.select("node", "n", "items").join(copies, "node", "left_anti")
    of_id = rows.select("id", F.col("least").alias("node")).distinct().checkpoint()
    links = linked_sets(sets, percent).select(F.col("node").alias("src"), F.col("component").alias("dst"))
    # the sets of one id hang together
    least = of_id.groupBy("id").agg(F.min("node").alias("dst"), F.count(F.lit(1)).alias("k")).where("k > 1")
    comp = components(links.unionByName(of_id.join(least, "id").select(F.col("node").alias("src"), "dst")))
    named = of_id.join(comp, "node", "left").select("id", F.coalesce("component", "node").alias("c")).distinct().checkpoint()
    group = named.groupBy("c").agg(F.min("id").alias("component"), F.count(F.lit(1)).alias("k")).where("k > 1").select("c", "component")
    return named.join(group, "c").select("id", "component")
