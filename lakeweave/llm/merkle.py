"""Merkle manifest of a table of documents: leaf, subroot, root and proofs.

A leaf is the digest of a document's fields. The leaves of a source, in the
order of doc_id, are numbered by a range partitioning: a row's number is its
place in its partition plus the rows of its source in the partitions before, so
no source is ever sorted in one task. Each level is a slot pivot: node ``p``
belongs to slot ``p mod 3`` of parent ``p div 3``, conditional aggregates spread
the children of a parent into ``FANOUT`` columns, and hashing the concatenated
columns gives the parent. Leaving out a node's own slot column gives its siblings. Levels
are written tables, each a third of the one below.

Proofs go down again from the root: a node's path is its step, the siblings
around a mark in its own place, then its parent's path. Folding a leaf up its
path replaces the mark by the digest so far and hashes.

Defined cases: a NULL field is ``-``; rows without a doc_id come first, rows
that share one are ordered by leaf, and equal rows are leaves of their own; a
row without a doc_id is never tampered with; an empty table gives no rows;
further columns are ignored.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from lakeweave.llm.common import cut, small, table

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
FANOUT = 3
SLOTS = [f"c{i}" for i in range(FANOUT)]
#: A step's own place, and the end of a step; neither is a hexadecimal digit.
OWN, END = "*", ";"
#: Rows of a partition table that is broadcast; larger ones join by shuffle.
BROADCAST = 100_000


def field(value: Column) -> Column:
    """A field as bytes that no other field's end can be taken for."""
    s = value.cast("string")
    return F.when(s.isNull(), "-").otherwise(F.concat(F.octet_length(s).cast("string"), F.lit(":"), s))


def leaf(columns: dict[str, Column]) -> Column:
    return F.sha2(F.concat(*(field(columns[c]) for c in FIELDS)), 256)


def leaves(docs: DataFrame) -> DataFrame:
    """(row, doc_id, source, leaf, tampered): digests before and after
    the line ends of every row of even CRC are deleted."""
    own = {c: F.col(c) for c in FIELDS}
    hit = (F.crc32(F.col("doc_id").cast("string").cast("binary")) % 2 == 0) & F.contains("text", F.lit("\n"))
    bare = F.regexp_replace("text", "\n", "")
    rows = docs.select(*FIELDS).withColumn("leaf", leaf(own))
    # a row that stays as it is is not hashed again
    rows = rows.withColumn("tampered", F.when(hit, leaf({**own, "text": bare})).otherwise(F.col("leaf")))
    return rows.select(F.monotonically_increasing_id().alias("row"), "doc_id", "source", "leaf", "tampered")


def numbered(rows: DataFrame, group: str, order: list[str]) -> DataFrame:
    """``rows`` with ``pos``, the number from 0 of each within its ``group``.
    The order must leave no ties."""
    place = cut(rows.repartitionByRange(group, *order).sortWithinPartitions(group, *order).withColumn("at", F.monotonically_increasing_id()), "merkle-order")
    part = F.shiftright("at", 33)
    per = place.groupBy(F.col(group).alias("g"), part.alias("part")).agg(F.min("at").alias("first"), F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("g").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    per = cut(per.select("g", "part", (F.coalesce(F.sum("n").over(before), F.lit(0)) - F.col("first")).alias("shift")), "merkle-parts")
    both = place.join(small(per, BROADCAST), place[group].eqNullSafe(per["g"]) & (part == per["part"]))
    return both.select(*(place[c] for c in rows.columns), (place["at"] + per["shift"]).alias("pos"))


def pivoted(nodes: DataFrame) -> DataFrame:
    """(tree, pos, c0.., h): the parents of ``nodes`` (tree, pos, h)."""
    slot = F.pmod("pos", F.lit(FANOUT))
    spread = [F.max(F.when(slot == i, F.col("h"))).alias(c) for i, c in enumerate(SLOTS)]
    up = nodes.groupBy("tree", F.expr(f"pos div {FANOUT}").alias("pos")).agg(*spread)
    return up.withColumn("h", F.sha2(F.concat_ws("", *SLOTS), 256))


def step(pos: Column) -> Column:
    """The siblings around the mark, from a parent's slot columns."""
    mine = lambda i: F.concat_ws("", *(F.lit(OWN) if k == i else F.col(c) for k, c in enumerate(SLOTS)), F.lit(END))
    slot = F.pmod(pos, F.lit(FANOUT))
    return reduce(lambda out, i: out.when(slot == i, mine(i)), range(1, FANOUT), F.when(slot == 0, mine(0)))


def levels(nodes: DataFrame) -> tuple[list[DataFrame], DataFrame]:
    """The pivots of all levels from below, and (tree, h): the roots. ``nodes``:
    (tree, pos, h), each tree's numbers from 0. A tree of one node has no level."""
    size = nodes.groupBy("tree").agg((F.max("pos") + 1).alias("n"))
    most = size.agg(F.max("n")).first()[0] or 0
    roots = nodes.join(size.where("n = 1"), nodes["tree"].eqNullSafe(size["tree"]), "left_semi").select("tree", "h")
    level = nodes.join(size.where("n > 1"), nodes["tree"].eqNullSafe(size["tree"]), "left_semi")
    out = []
    while most > 1:
        out.append(cut(pivoted(level), "merkle-level"))
        most = -(-most // FANOUT)
        # a parent of number 0 that is alone in its tree is a root
        size = out[-1].groupBy("tree").agg((F.max("pos") + 1).alias("n"))
        roots = roots.unionByName(out[-1].join(size.where("n = 1"), out[-1]["tree"].eqNullSafe(size["tree"]), "left_semi").select("tree", "h"))
        level = out[-1].join(size.where("n > 1"), out[-1]["tree"].eqNullSafe(size["tree"]), "left_semi").select("tree", "pos", "h")
    return out, roots


def paths(pivots: list[DataFrame]) -> DataFrame | None:
    """(tree, pos, c0.., path): the lowest level's parents with the steps above them."""
    below = None
    for k, own in reversed(list(enumerate(pivots))):
        own = own.drop("h")
        if below is None:
            below = own.withColumn("path", F.lit(""))
        else:
            up = below.select(F.col("tree").alias("t"), F.col("pos").alias("p"), *SLOTS, "path")
            slots = own.select("tree", "pos", *(F.col(c).alias(f"own_{c}") for c in SLOTS))
            below = slots.join(up, slots["tree"].eqNullSafe(up["t"]) & (F.expr(f"pos div {FANOUT}") == up["p"]), "left")
            below = below.select("tree", "pos", *(F.col(f"own_{c}").alias(c) for c in SLOTS),
                                 F.coalesce(F.concat(step(F.col("pos")), F.col("path")), F.lit("")).alias("path"))
        if k:
            below = cut(below, "merkle-paths")
    return below


def with_path(nodes: DataFrame, pivots: list[DataFrame], name: str) -> DataFrame:
    """``nodes`` (tree, pos, ...) with the path of each to its tree's root."""
    up = paths(pivots)
    if up is None:
        return nodes.withColumn(name, F.lit(""))
    up = up.select(F.col("tree").alias("t"), F.col("pos").alias("p"), *SLOTS, "path")
    both = nodes.join(up, nodes["tree"].eqNullSafe(up["t"]) & (F.expr(f"pos div {FANOUT}") == up["p"]), "left")
    return both.select(*nodes.columns, F.coalesce(F.concat(step(F.col("pos")), F.col("path")), F.lit("")).alias(name))


def folded(digest: Column, path: Column) -> Column:
    """The root that a digest and the steps of a path lead to."""
    steps = F.filter(F.split(path, END), lambda s: s != "")
    return F.aggregate(steps, digest, lambda h, s: F.sha2(F.replace(s, F.lit(OWN), h), 256))


def manifest(docs: DataFrame) -> DataFrame:
    """One row per document: leaf, subroot, root, path and the tampered digest."""
    rows = numbered(cut(leaves(docs), "merkle-leaves"), "source", ["doc_id", "leaf", "row"])
    rows = cut(rows.select("doc_id", F.col("source").alias("tree"), "pos", "leaf", "tampered"), "merkle-rows")
    pivots, subroots = levels(rows.select("tree", "pos", F.col("leaf").alias("h")))
    tops = cut(numbered(cut(subroots.select(F.lit("").alias("all"), F.col("tree").alias("source"), "h"), "merkle-subroots"), "all", ["source"]), "merkle-tops")
    top_pivots, root = levels(tops.select(F.col("all").alias("tree"), "pos", "h"))
    above = with_path(tops.select(F.col("all").alias("tree"), "pos", "source", F.col("h").alias("subroot")), top_pivots, "above")
    # one root, or none of an empty table
    top = root.select("h").first()
    above = cut(above.select(F.col("source").alias("s"), "subroot", "above", F.lit(top[0] if top else None).cast("string").alias("root")), "merkle-above")
    rows = with_path(rows, pivots, "below")
    both = rows.join(small(above, BROADCAST), rows["tree"].eqNullSafe(above["s"]))
    return both.select("doc_id", F.col("tree").alias("source"), "pos", "leaf", "tampered", "subroot", "root", F.concat("below", "above").alias("path"))


def report(docs: DataFrame) -> DataFrame:
    """Per document its digests, its proof's digest, and whether the row as it
    is after tampering still leads to the root."""
    rows = manifest(docs).withColumn("folded_root", folded(F.col("tampered"), F.col("path")))
    return rows.select("doc_id", "leaf", "subroot", "root", F.sha2(F.translate("path", OWN + END, ""), 256).alias("proof_sha256"),
                       "folded_root", (F.col("folded_root") == F.col("root")).alias("verified"))


def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return report(table(spark, sf_dir, "documents"))


_FIELD = "coalesce(strlen({0}::varchar)::varchar || ':' || {0}::varchar, '-')"
_LEAF = "sha256(" + " || ".join(_FIELD.format(c) for c in FIELDS) + ")"
_CHANGED = _LEAF.replace("text::", "replace(text, chr(10), '')::")
#: The levels of the sources' trees, then the same for the tree of their subroots.
_TREE = """{0}(tree, lvl, pos, h, n) AS (
  SELECT tree, 0, pos, h, count(*) OVER (PARTITION BY tree) FROM {1}
  UNION ALL
  SELECT tree, lvl + 1, pos // 3, sha256(string_agg(h, '' ORDER BY pos)), (max(n) + 2) // 3 FROM {0} WHERE n > 1 GROUP BY tree, lvl, pos // 3),
{0}_step AS (
  SELECT a.tree, a.lvl, a.pos, coalesce(string_agg(b.h, '' ORDER BY b.pos) FILTER (b.pos < a.pos), '') AS l,
         coalesce(string_agg(b.h, '' ORDER BY b.pos) FILTER (b.pos > a.pos), '') AS r
  FROM {0} a JOIN {0} b ON a.tree = b.tree AND a.lvl = b.lvl AND a.pos // 3 = b.pos // 3 WHERE a.n > 1 GROUP BY a.tree, a.lvl, a.pos),
"""
_CRC = """crc(i, c) AS (
  SELECT i::ubigint, i::ubigint FROM range(256) x(i)),
crc_table AS (
  SELECT i, list_reduce([c, 0, 0, 0, 0, 0, 0, 0, 0], lambda a, b: CASE WHEN a % 2 = 1 THEN xor(a // 2, 3988292384::ubigint) ELSE a // 2 END) AS v FROM crc),
crc_list AS (SELECT list(v ORDER BY i) AS t FROM crc_table),
"""
_ORACLE = "WITH RECURSIVE " + _CRC + """docs AS (
  SELECT doc_id, coalesce('s' || source, 'n') AS tree, """ + _LEAF + """ AS leaf,
         CASE WHEN xor(list_reduce(list_prepend(4294967295::ubigint, list_transform(string_split(doc_id::varchar, ''), lambda d: ascii(d)::ubigint)),
                 lambda a, b: xor(a // 256, t[(xor(a, b) % 256)::bigint + 1])), 4294967295::ubigint) % 2 = 0 THEN """ + _CHANGED + " ELSE " + _LEAF + """ END AS changed
  FROM documents, crc_list),
leaf_rows AS (SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos, leaf AS h FROM docs),
""" + _TREE.format("low", "leaf_rows") + """
subroots AS (SELECT '' AS tree, tree AS source, h, row_number() OVER (ORDER BY tree) - 1 AS pos FROM low WHERE n = 1),
""" + _TREE.format("high", "subroots") + """
fold(tree, pos, doc_id, leaf, lvl, place, h, proof) AS (
  SELECT tree, pos, doc_id, leaf, 0, pos, changed, '' FROM leaf_rows
  UNION ALL
  SELECT f.tree, f.pos, f.doc_id, f.leaf, f.lvl + 1, f.place // 3, sha256(s.l || f.h || s.r), f.proof || s.l || s.r
  FROM fold f JOIN low_step s ON s.tree = f.tree AND s.lvl = f.lvl AND s.pos = f.place),
sub AS (SELECT f.*, s.pos AS spos, s.h AS subroot FROM (SELECT *, row_number() OVER (PARTITION BY tree, pos ORDER BY lvl DESC) AS last FROM fold) f
        JOIN subroots s ON s.source = f.tree WHERE f.last = 1),
rise(tree, pos, doc_id, leaf, subroot, lvl, place, h, proof) AS (
  SELECT tree, pos, doc_id, leaf, subroot, 0, spos, h, proof FROM sub
  UNION ALL
  SELECT f.tree, f.pos, f.doc_id, f.leaf, f.subroot, f.lvl + 1, f.place // 3, sha256(s.l || f.h || s.r), f.proof || s.l || s.r
  FROM rise f JOIN high_step s ON s.lvl = f.lvl AND s.pos = f.place)
SELECT doc_id, leaf, subroot, root, sha256(proof) AS proof_sha256, f.h AS folded_root, f.h = root AS verified
FROM (SELECT *, row_number() OVER (PARTITION BY tree, pos ORDER BY lvl DESC) AS last FROM rise) f, (SELECT h AS root FROM high WHERE n = 1) WHERE f.last = 1
"""

QUERIES = {"op12_merkle_manifest": op12_merkle_manifest}
ORACLE = {"op12_merkle_manifest": _ORACLE}
