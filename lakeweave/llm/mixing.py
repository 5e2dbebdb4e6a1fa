"""Mixing sources to target weights by hierarchical budgets.

The tree is domain, language, source. A budget of tokens runs from the root
down: at every node the children share it by weight, none beyond what its
documents can give in ``MAX_EPOCHS`` epochs, and what one cannot take goes to
its siblings by their weights (the shares are the water level at which the
budget is used up). A node whose children are all full passes the shortage up,
for its own capacity is what its parent shares by: siblings come before
ancestors. Each leaf then takes its budget as whole epochs plus a prefix of
tokens in a seeded order; the last document of the prefix is the last that
fits whole.

The order of an epoch is the MD5 of seed, epoch and id. A leaf's prefix is
found without sorting the leaf: hash buckets of the leaf are summed, the
bucket in which the prefix ends is found from the sums, and only that bucket's
documents are ranked. Buckets grow in number with the leaf.

Defined cases: NULL language or source is its own child; a source no domain
claims is in domain ``other``; a NULL or empty text has 0 tokens and goes with
the prefix it falls in; rows that repeat an id are taken together; NULL ids
count as the id 'null'; an empty table gives no rows; weights of children that
aren't there are shared by those that are; input columns named ``domain``,
``n_tokens`` or ``epoch`` are replaced, names starting with ``_m_`` reserved.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from lakeweave.llm.common import cut, ship, small, table

#: Production targets: whole-number weights; a node not listed weighs DEFAULT.
DOMAINS = {"web": ("src0", "src1", "src2", "src3", "src4", "src5", "src6", "src7", "src8", "src9"),
           "books": ("src10", "src11", "src12", "src13"), "code": ("src14", "src15", "src16"), "news": ("src17", "src18", "src19")}
WEIGHTS = {"domain": {"web": 40, "books": 30, "code": 15, "news": 15}, "lang": {"en": 60, "de": 15, "fr": 15, "es": 10}, "source": {"src0": 2}}
DEFAULT = 1
MAX_EPOCHS = 2
#: The mix holds this share of all tokens, in per cent.
SHARE = 60
SEED = 17
#: Documents of a leaf for each of its hash buckets, about.
PER_BUCKET = 256
LEVELS = ("domain", "lang", "source")


def tokens(text: Column) -> Column:
    """Words between white space."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^ \t-\r]+")), F.lit(0)).cast("bigint")


def domain_of(source: Column, domains: Mapping[str, tuple[str, ...]] = DOMAINS) -> Column:
    out = F.lit("other")
    for name, sources in domains.items():
        out = F.when(source.isin(*sources), name).otherwise(out)
    return out


def weight_of(name: Column, weights: Mapping[str, int]) -> Column:
    out = F.lit(DEFAULT)
    for key, w in weights.items():
        out = F.when(name == key, w).otherwise(out)
    return out.cast("bigint")


def shared(nodes: DataFrame, level: str, above: list[str]) -> DataFrame:
    """Give each row of ``nodes`` (one per child; ``cap``, ``w`` and the
    parent's ``budget``) its share: children ordered by capacity per weight
    fill up one after another while the level of the rest stands above them."""
    big = lambda c: F.col(c).cast("decimal(38,0)")
    # capacity per weight as a whole number, so that ties and order are exact
    order = [F.expr("cast(cap as decimal(20,0)) * 1000000 div w"), F.col(level)]
    w = Window.partitionBy(*above) if above else Window.partitionBy(F.lit(0))
    before = w.orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    after = w.orderBy(*order).rowsBetween(Window.currentRow, Window.unboundedFollowing)
    n = (nodes.withColumn("_before", F.coalesce(F.sum("cap").over(before), F.lit(0)).cast("bigint"))
         .withColumn("_after", F.sum("w").over(after)))
    # full, if its part of what the fuller ones leave is at least its capacity
    n = n.withColumn("_full", big("cap") * big("_after").cast("decimal(18,0)") <= (F.col("budget") - F.col("_before")).cast("decimal(20,0)") * big("w").cast("decimal(18,0)"))
    n = (n.withColumn("_left", F.col("budget") - F.coalesce(F.sum(F.when(F.col("_full"), F.col("cap"))).over(w), F.lit(0)))
         .withColumn("_rest", F.sum(F.when(~F.col("_full"), F.col("w"))).over(w)))
    part = F.expr("(cast(_left as decimal(20,0)) * cast(w as decimal(18,0))) div cast(_rest as decimal(20,0))")
    return n.withColumn("budget", F.when(F.col("_full"), F.col("cap")).otherwise(part).cast("bigint")).drop("_before", "_after", "_full", "_left", "_rest")


def budgets(leaves: DataFrame, weights: Mapping[str, Mapping[str, int]], total: int, epochs: int) -> DataFrame:
    """Leaves (domain, lang, source, n, size) with ``budget`` tokens each."""
    out = leaves.withColumn("cap0", F.col("size") * epochs)
    above: list[str] = []
    level_rows = out.withColumn("budget", F.lit(total).cast("bigint"))
    for level in LEVELS:
        here = [*above, level]
        nodes = level_rows.groupBy(*here).agg(F.sum("cap0").cast("bigint").alias("cap"), F.max("budget").alias("budget"))
        nodes = shared(nodes.withColumn("w", weight_of(F.col(level), weights.get(level, {}))), level, above)
        keep = nodes.select(*[F.col(c).alias(f"_k_{c}") for c in here], F.col("budget").alias("_b"))
        on = [F.col(c).eqNullSafe(F.col(f"_k_{c}")) for c in here]
        level_rows = level_rows.join(keep, on).withColumn("budget", F.col("_b")).drop("_b", *[f"_k_{c}" for c in here])
        above = here
    return level_rows.drop("cap0")


def mix(docs: DataFrame, weights: Mapping[str, Mapping[str, int]] | None = None, domains: Mapping[str, tuple[str, ...]] = DOMAINS,
        share: int = SHARE, epochs: int = MAX_EPOCHS, seed: int = SEED) -> DataFrame:
    """The documents of the mix, one row for each epoch that takes them:
    ``docs`` plus ``domain``, ``n_tokens`` and ``epoch`` (from 0)."""
    ship(docs.sparkSession)
    weights = WEIGHTS if weights is None else weights
    key = F.coalesce(F.col("doc_id").cast("string"), F.lit("null"))
    rank = lambda e: F.md5(F.concat_ws(":", F.lit(str(seed)), e.cast("string"), F.col("id")))
    one = docs.select(key.alias("id"), domain_of(F.col("source"), domains).alias("domain"), "lang", "source", tokens(F.col("text")).alias("n_tokens"))
    # ids, leaves and lengths only: the texts are read once more, by those that are taken
    lengths = cut(one.groupBy("id", *LEVELS).agg(F.sum("n_tokens").cast("bigint").alias("n_tokens")), "mix-lengths")
    leaves = lengths.groupBy(*LEVELS).agg(F.count(F.lit(1)).alias("n"), F.sum("n_tokens").cast("bigint").alias("size"))
    leaves = cut(leaves, "mix-leaves")
    total = (leaves.agg(F.sum("size")).first()[0] or 0) * share // 100
    got = budgets(leaves, weights, total, epochs).withColumn("leaf", F.md5(F.concat_ws(":", *[F.coalesce(F.col(c), F.lit("\x00")) for c in LEVELS])))
    plan = cut(got.select("leaf", *LEVELS, "size", "budget", F.expr("if(size = 0, 0, budget div size)").cast("int").alias("full"),
                          F.expr("if(size = 0, 0, budget % size)").cast("bigint").alias("part"),
                          F.greatest(F.lit(1), F.ceil(F.log2(F.greatest(F.lit(1), F.col("n") / PER_BUCKET)))).cast("int").alias("bits")), "mix-plan")
    few = small(plan.select("leaf", "full", "part", "bits", *[F.col(c).alias(f"_k_{c}") for c in LEVELS]), 100_000)
    on = [F.col(c).eqNullSafe(F.col(f"_k_{c}")) for c in LEVELS]
    d = (lengths.join(few, on).select("id", "leaf", "domain", "lang", "source", "n_tokens", "full", "part", "bits")
         .withColumn("at", rank(F.col("full")))
         .withColumn("bucket", F.expr("shiftright(cast(conv(substr(at, 1, 8), 16, 10) as bigint), 32 - least(bits, 31))")))
    d = cut(d, "mix-order")
    sums = d.groupBy("leaf", "bucket", "part").agg(F.sum("n_tokens").cast("bigint").alias("s"))
    run = Window.partitionBy("leaf").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    upto = sums.withColumn("before", F.coalesce(F.sum("s").over(run), F.lit(0)).cast("bigint"))
    upto = upto.where(F.col("part") > 0).select(F.col("leaf").alias("_l"), F.col("bucket").alias("_b"), "before",
                       (F.col("before") + F.col("s") <= F.col("part")).alias("inside"), (F.col("before") <= F.col("part")).alias("reached"))
    d = d.join(upto.where("inside or reached"), (F.col("leaf") == F.col("_l")) & (F.col("bucket") == F.col("_b")), "left")
    # the bucket in which the prefix ends is ranked by itself
    edge = d.where(F.col("reached") & ~F.col("inside"))
    w = Window.partitionBy("leaf").orderBy("at", "id").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    edge = edge.withColumn("upto", F.col("before") + F.sum("n_tokens").over(w)).where(F.col("upto") <= F.col("part"))
    last = d.where(F.col("inside")).select("id", *LEVELS, "full").unionByName(edge.select("id", *LEVELS, "full"))
    whole = d.where(F.col("full") > 0).select("id", *LEVELS, F.explode(F.sequence(F.lit(0), F.col("full") - 1)).alias("epoch"))
    taken = whole.unionByName(last.withColumnRenamed("full", "epoch"))
    taken = taken.select(*[F.col(c).alias(f"_m_{c}") for c in ("id", *LEVELS, "epoch")])
    texts = docs.withColumn("_m_key", key).withColumn("domain", domain_of(F.col("source"), domains)).withColumn("n_tokens", tokens(F.col("text")))
    on = [F.col("_m_key") == F.col("_m_id"), *[F.col(c).eqNullSafe(F.col(f"_m_{c}")) for c in LEVELS]]
    return texts.join(taken, on).withColumn("epoch", F.col("_m_epoch")).drop("_m_key", *[f"_m_{c}" for c in ("id", *LEVELS, "epoch")])


def op4_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(table(spark, sf_dir, "documents")).select("doc_id", "domain", "lang", "source", "n_tokens", "epoch")


def _cases(column: str, values: Mapping, default) -> str:
    quoted = lambda v: f"'{v}'" if isinstance(v, str) else v
    return "CASE " + " ".join(f"WHEN {column} = '{k}' THEN {quoted(v)}" for k, v in values.items()) + f" ELSE {quoted(default)} END"


def _level_sql(name: str, level: str, above: list[str], prev: str) -> str:
    """DuckDB CTEs that share the parents' budgets among the children of a level."""
    here, part = ", ".join([*above, level]), f"PARTITION BY {', '.join(above)}" if above else ""
    order = f"{part} ORDER BY CAST(cap AS HUGEINT) * 1000000 // w, {level} NULLS FIRST"
    on = " AND ".join(f"p.{c} IS NOT DISTINCT FROM n.{c}" for c in [*above, level])
    return f"""
{name}1 AS (SELECT {here}, CAST(sum(cap0) AS BIGINT) AS cap, max(budget) AS budget, {_cases(level, WEIGHTS.get(level, {}), DEFAULT)} AS w FROM {prev} GROUP BY {here}),
{name}2 AS (SELECT *, coalesce(sum(cap) OVER ({order} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS bef,
                   sum(w) OVER ({order} ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS aft FROM {name}1),
{name}3 AS (SELECT *, CAST(cap AS HUGEINT) * aft <= CAST(budget - bef AS HUGEINT) * w AS isfull FROM {name}2),
{name}4 AS (SELECT *, budget - coalesce(sum(cap) FILTER (isfull) OVER ({part}), 0) AS lef, sum(w) FILTER (NOT isfull) OVER ({part}) AS rest FROM {name}3),
{name} AS (SELECT p.* REPLACE (CAST(CASE WHEN n.isfull THEN n.cap ELSE CAST(n.lef AS HUGEINT) * n.w // n.rest END AS BIGINT) AS budget)
           FROM {prev} p JOIN {name}4 n ON {on})"""


def _oracle() -> str:
    domain = _cases("source", {s: d for d, ss in DOMAINS.items() for s in ss}, "other")
    return f"""
WITH o AS (SELECT doc_id, {domain} AS domain, lang, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^ \\t-\\r]+')) AS BIGINT) AS n_tokens FROM documents),
leaf AS (SELECT domain, lang, source, CAST(sum(n_tokens) AS BIGINT) AS size, CAST(sum(n_tokens) AS BIGINT) * {MAX_EPOCHS} AS cap0,
                CAST((SELECT sum(n_tokens) FROM o) AS BIGINT) * {SHARE} // 100 AS budget FROM o GROUP BY domain, lang, source),
{_level_sql('a', 'domain', [], 'leaf')},
{_level_sql('b', 'lang', ['domain'], 'a')},
{_level_sql('c', 'source', ['domain', 'lang'], 'b')},
q AS (SELECT *, CASE WHEN size = 0 THEN 0 ELSE budget // size END AS f, CASE WHEN size = 0 THEN 0 ELSE budget % size END AS part FROM c),
d AS (SELECT o.*, f, part, sum(n_tokens) OVER (PARTITION BY o.domain, o.lang, o.source
             ORDER BY md5('{SEED}:' || f || ':' || doc_id), CAST(doc_id AS VARCHAR) ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS upto
      FROM o JOIN q ON o.domain = q.domain AND o.lang IS NOT DISTINCT FROM q.lang AND o.source IS NOT DISTINCT FROM q.source)
SELECT doc_id, domain, lang, source, n_tokens, CAST(epoch AS INTEGER) AS epoch FROM (
  SELECT *, unnest(range(0, f)) AS epoch FROM d
  UNION ALL SELECT *, f AS epoch FROM d WHERE upto <= part AND part > 0)"""


QUERIES = {"op4_mix_sources": op4_mix_sources}
ORACLE = {"op4_mix_sources": _oracle()}
