"""Audit of how five text filters interact in every order of application.

Each document is reduced to a mask of the filters that it fails, and documents to mask
cells: counts by part, mask and labels. A recursive common table expression
starts with the empty prefix of each mask and extends prefixes by the letters
not yet used, carrying the bits of the filters applied; each level of the
recursion gives that step's outcome for a mask. The outcomes are joined with
the cells on the mask, so the work after the one scan of the texts does not
grow with the documents. 32 masks times 325 prefixes are a fixed number of rows.

The identity filter needs the least doc_id of each text. Only a digest, the
mask and the labels of a document are shuffled; the first row of a text is an
aggregate, so copies of one text meet before the shuffle, and failing copies
are counted as all minus first ones.

Defined cases: a NULL text is empty; a NULL source is the empty part; a row
without a doc_id is no copy and makes no other row one; rows that share a
doc_id are copies only of texts of smaller ones; a document is good (toxic) if
any of its labels says so, and neither without labels; an empty table gives no
rows; further columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from lakeweave.llm.common import cut, table

LETTERS = "ABCDE"
#: Fewest words; distinct words, and capitals, in per cent; marks.
MIN_WORDS, DISTINCT, CAPITALS, MARKS = 50, 65, 5, "#$%&*|"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
#: Bit of the identity filter, which needs other documents.
COPY = 1 << LETTERS.index("E")


def own_mask(text: Column) -> Column:
    """Bits of the filters that a text fails by itself."""
    words = F.filter(F.split(text, "[\\x20\\x09-\\x0D]+"), lambda w: w != "")
    few = F.size(words) < MIN_WORDS
    same = F.size(F.array_distinct(words)) * 100 < F.size(words) * DISTINCT
    chars = F.length(text)
    loud = (chars - F.length(F.translate(text, UPPER, ""))) * 100 > chars * CAPITALS
    marked = F.translate(text, MARKS, "") != text
    return sum((F.when(test, 1 << i).otherwise(0) for i, test in enumerate((few, same, loud, marked))), F.lit(0))


def cells(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(part, mask, good, toxic, n): documents by what they fail and what they are."""
    text = F.coalesce("text", F.lit(""))
    flat = docs.select("doc_id", F.coalesce("source", F.lit("")).alias("part"), own_mask(text).alias("mask"), F.unhex(F.sha2(text, 256)).alias("digest"))
    told = labels.groupBy(F.col("doc_id").alias("d")).agg(F.max("quality").alias("q"), F.max("toxic").alias("t"))
    flag = lambda c: F.coalesce(F.col(c) == 1, F.lit(False))
    rows = flat.join(told, flat["doc_id"] == told["d"], "left").select("doc_id", "digest", "part", "mask", flag("q").alias("good"), flag("t").alias("toxic"))
    rows = cut(rows, "audit-rows")
    kind = ["part", "mask", "good", "toxic"]

    # equal rows of one document meet in one place; of each text the least doc_id's rows are the first ones
    known = rows.where(F.col("doc_id").isNotNull()).repartition("digest", "doc_id")
    per = (known.groupBy("digest", "doc_id", *kind).agg(F.count(F.lit(1)).alias("n"))
           .groupBy("digest", "doc_id").agg(F.collect_list(F.struct(*kind, "n")).alias("rows")))
    first = per.groupBy("digest").agg(F.min(F.struct("doc_id", "rows")).alias("least")).select(F.explode("least.rows").alias("r")).select("r.*")
    alone = rows.where(F.col("doc_id").isNull()).groupBy(*kind).agg(F.count(F.lit(1)).alias("n"))
    passing = first.groupBy(*kind).agg(F.sum("n").alias("n")).unionByName(alone)
    every = rows.groupBy(*kind).agg(F.count(F.lit(1)).alias("n"))
    copies = every.unionByName(passing.withColumn("n", -F.col("n"))).withColumn("mask", F.col("mask").bitwiseOR(F.lit(COPY)))
    return passing.unionByName(copies).groupBy(*kind).agg(F.sum("n").alias("n")).where("n > 0")


#: Every mask through every order: a level of the recursion is a step, and the
#: bits say what becomes of a document with that mask.
WALK = f"""
WITH RECURSIVE walk(mask, prefix, applied, step, letter, bit) AS (
  SELECT m, cast('' AS string), 0, 0, cast('' AS string), 0 FROM (SELECT explode(sequence(0, {(1 << len(LETTERS)) - 1})) AS m)
  UNION ALL
  SELECT w.mask, concat(w.prefix, f.letter), w.applied | w.bit, w.step + 1, f.letter, f.bit
  FROM walk w JOIN (SELECT substring('{LETTERS}', i + 1, 1) AS letter, shiftleft(1, i) AS bit FROM (SELECT explode(sequence(0, {len(LETTERS) - 1})) AS i)) f
    ON ((w.applied | w.bit) & f.bit) = 0
  WHERE w.step < {len(LETTERS)})
SELECT mask AS m, prefix, step, letter, (mask & (applied | bit)) = 0 AS stays, (mask & bit) <> 0 AND (mask & applied) = 0 AS goes,
       (mask & bit) <> 0 AND (mask & applied) <> 0 AS again, mask = bit AS lonely
FROM walk WHERE step > 0"""


def audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per part, order of the filters and step: see ``report``."""
    spark = docs.sparkSession
    found = cells(docs, labels)
    walk = F.broadcast(spark.sql(WALK))
    count = lambda *tests: F.sum(F.when(_all(tests), F.col("n")).otherwise(0))
    met = found.join(walk, found["mask"] == walk["m"]).groupBy("part", "prefix", "letter").agg(
        count("stays").alias("kept"), count("goes").alias("removed"), count("again").alias("redundant"), count("lonely").alias("unique_fails"),
        count("goes", "good").alias("good_lost"), count("goes", "toxic").alias("toxic_lost"))
    orders = spark.sql(WALK).where((F.col("step") == len(LETTERS)) & (F.col("m") == 0)).select(F.col("prefix").alias("filter_order"))
    steps = (orders.select("filter_order", F.explode(F.sequence(F.lit(1), F.lit(len(LETTERS)))).alias("step"))
             .withColumn("so_far", F.expr("substring(filter_order, 1, step)")))
    rows = met.join(F.broadcast(steps), met["prefix"] == steps["so_far"])
    by_letter = Window.partitionBy("part", "letter")
    return rows.withColumn("shapley", F.sum("removed").over(by_letter)).drop("prefix", "so_far")


def _all(tests) -> Column:
    out = F.lit(True)
    for t in tests:
        out = out & F.col(t)
    return out


def report(docs: DataFrame, labels: DataFrame) -> DataFrame:
    measures = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")
    return audit(docs, labels).select("part", "filter_order", F.col("step").cast("int").alias("step"), *(F.col(m).cast("bigint").alias(m) for m in measures))


def op11_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


_ORACLE = r"""
WITH RECURSIVE texts AS (
  SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS body, list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda w: w <> '') AS words FROM documents),
firsts AS (SELECT body AS b, min(doc_id) AS least FROM texts GROUP BY 1),
told AS (SELECT doc_id AS d, max(quality) AS q, max(toxic) AS t FROM labels GROUP BY 1),
fails AS (
  SELECT part, coalesce(q = 1, false) AS good, coalesce(t = 1, false) AS toxic,
         {'A': len(words) < 50, 'B': 100 * len(list_distinct(words)) < 65 * len(words),
          'C': 100 * (length(body) - length(regexp_replace(body, '[A-Z]', '', 'g'))) > 5 * length(body),
          'D': regexp_matches(body, '[#$%&*|]'), 'E': coalesce(doc_id > least, false)} AS f
  FROM texts JOIN firsts ON b = body LEFT JOIN told ON d = doc_id),
bits AS (SELECT part, good, toxic, f.A::int + 2 * f.B::int + 4 * f.C::int + 8 * f.D::int + 16 * f.E::int AS mask, count(*) AS n FROM fails GROUP BY ALL),
orders(p) AS (
  SELECT '' UNION ALL SELECT p || l FROM orders, (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS l) WHERE strpos(p, l) = 0),
steps AS (
  SELECT p AS filter_order, step, substr(p, step, 1) AS letter, (1 << (ascii(substr(p, step, 1)) - 65)) AS bit,
         list_sum(list_transform(range(1, step), lambda k: 1 << (ascii(substr(p, k, 1)) - 65))) AS before
  FROM orders, (SELECT unnest(range(1, 6))::int AS step) WHERE length(p) = 5),
met AS (
  SELECT part, filter_order, step, letter,
         coalesce(sum(n) FILTER (mask & (coalesce(before, 0)::int | bit) = 0), 0) AS kept,
         coalesce(sum(n) FILTER (mask & bit <> 0 AND mask & coalesce(before, 0)::int = 0), 0) AS removed,
         coalesce(sum(n) FILTER (mask & bit <> 0 AND mask & coalesce(before, 0)::int <> 0), 0) AS redundant,
         coalesce(sum(n) FILTER (mask = bit), 0) AS unique_fails,
         coalesce(sum(n) FILTER (mask & bit <> 0 AND mask & coalesce(before, 0)::int = 0 AND good), 0) AS good_lost,
         coalesce(sum(n) FILTER (mask & bit <> 0 AND mask & coalesce(before, 0)::int = 0 AND toxic), 0) AS toxic_lost
  FROM bits, steps GROUP BY part, filter_order, step, letter)
SELECT part, filter_order, step, kept::bigint AS kept, removed::bigint AS removed, redundant::bigint AS redundant, unique_fails::bigint AS unique_fails,
       good_lost::bigint AS good_lost, toxic_lost::bigint AS toxic_lost, (sum(removed) OVER (PARTITION BY part, letter))::bigint AS shapley
FROM met"""

QUERIES = {"op11_filter_audit": op11_filter_audit}
ORACLE = {"op11_filter_audit": _ORACLE}
