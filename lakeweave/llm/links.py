"""URL verdicts: filter rules first, link-graph propagation for the rest.

A rule (host, path) fits its host and all subdomains where the url's path
starts with the rule's; the longest rule wins. A url that no rule fits gets
its host's verdict: trust starts at the hosts of allowed pages and runs along
host edges, distrust starts at the hosts of blocked pages and runs against
them, both as personalised PageRank; a host is blocked where its distrust is
above its trust and above half the mean distrust of all hosts.

Host edges are the absolute hyperlinks found in the pages, plus an edge each
way between a host and its nearest parent domain that also occurs. Ranks are
whole numbers of ``MASS`` units, so no order of summing changes a verdict.

Defined cases: a NULL url, or one without ``://``, has empty host and path and
is allowed; NULL html has no links; repeated pages each keep their row (and
weigh as many pages); a host without trust and distrust is allowed; no pages
give no rows; further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from lakeweave.llm.common import cut, small, table

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: (verdict, host, path)
RULES = (("allow", "com", "/"), ("block", "example.com", "/en/"), ("allow", "www.example.com", "/en/"),
         ("block", "net", "/es/"), ("block", "net", "/fr/"))
MAX_RULES = 500
MASS = 10**15
#: Per cent of a host's rank that moves on along its edges.
DAMPING = 85
#: Rounds between written cuts; the change in millionths of all mass at which rounds end.
ROUNDS, SETTLED = 6, 1


def after_scheme(url: Column) -> Column:
    at = F.instr(url, "://")
    return F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")


def host_of(url: Column) -> Column:
    rest = F.coalesce(after_scheme(url), F.lit(""))
    return F.translate(F.regexp_extract(rest, r"^[^/?#]*", 0), UPPER, LOWER)


def path_of(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(after_scheme(url), F.lit("")), r"^[^/?#]*([^?#]*)", 1)


def rule_of(host: Column, path: Column, rules: Sequence[tuple[str, str, str]]) -> Column:
    """Struct (rule, verdict) of the longest rule that fits, else NULL."""
    if len(rules) > MAX_RULES:
        raise ValueError(f"more than {MAX_RULES} rules")
    found = F.lit(None).cast("struct<rule:string,verdict:string>")
    for verdict, h, p in sorted(rules, key=lambda r: (len(r[1] + r[2]), r)):
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(p)
        found = F.when(fits, F.struct(F.lit(h + p).alias("rule"), F.lit(verdict).alias("verdict"))).otherwise(found)
    return found


def judged(pages: DataFrame, rules: Sequence[tuple[str, str, str]] = RULES) -> DataFrame:
    parts = pages.select("page_id", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
    return parts.withColumn("r", rule_of(F.col("host"), F.col("path"), rules)).select("page_id", "host", "path", "r.rule", "r.verdict")


def host_edges(pages: DataFrame, hosts: DataFrame) -> DataFrame:
    """Distinct (src, dst) between different hosts of ``hosts``."""
    url = F.explode(F.regexp_extract_all("html", F.lit(r"(?i)\bhref\s*=\s*[\"']?((?:https?:)?//[^\s\"'>]+)"), F.lit(1)))
    out = (pages.where(F.col("html").contains("//")).select(host_of(F.col("url")).alias("src"), url.alias("to"))
           .select("src", host_of(F.when(F.col("to").startswith("//"), F.concat(F.lit("http:"), "to")).otherwise(F.col("to"))).alias("dst"))
           .where((F.col("src") != F.col("dst")) & (F.col("src") != "") & (F.col("dst") != "")).distinct())
    known = hosts.select(F.col("host").alias("dst"))
    out = out.join(small(known, 200_000), "dst", "left_semi").select("src", "dst")
    # every proper suffix of a host, longest first; the first that is a host is its parent
    labels = hosts.where(F.col("host") != "").select("host", F.split("host", r"\.").alias("l"))
    above = labels.select("host", F.posexplode(F.transform(
        F.slice("l", 2, F.size("l")), lambda _, i: F.array_join(F.slice("l", i + F.lit(2), F.size("l")), "."))).alias("k", "dst"))
    parent = (above.join(small(known, 200_000), "dst", "left_semi").groupBy("host").agg(F.min(F.struct("k", "dst")).alias("p"))
              .select(F.col("host").alias("src"), F.col("p.dst").alias("dst")))
    return out.unionByName(parent).unionByName(parent.select(F.col("dst").alias("src"), F.col("src").alias("dst"))).distinct()


def propagate(edges: DataFrame, seeds: DataFrame, damping: int = DAMPING) -> DataFrame:
    """Personalised PageRank of trust along ``edges`` (src, dst) and of
    distrust against them, from ``seeds`` (host, t0, d0: units of MASS).
    Returns (host, t, d). Mass at hosts without edges stays there no longer
    than a round. Ends when a round moves under
    ``SETTLED`` millionths of all mass."""
    forth = edges.join(edges.groupBy("src").agg(F.count(F.lit(1)).alias("n")), "src").select("src", "dst", "n", F.lit(True).alias("trust"))
    back = edges.join(edges.groupBy("dst").agg(F.count(F.lit(1)).alias("n")), "dst").select(
        F.col("dst").alias("src"), F.col("src").alias("dst"), "n", F.lit(False).alias("trust"))
    moves = cut(forth.unionByName(back), "host-moves")
    rank = seeds.select("host", F.col("t0").alias("t"), F.col("d0").alias("d"))
    whole = seeds.agg(F.sum("t0") + F.sum("d0")).first()[0] or 0
    if moves.limit(1).count() == 0 or not whole:
        return rank
    share = lambda c: F.expr(f"({c} * {damping}L) div (n * 100L)")
    while True:
        for _ in range(ROUNDS):
            last = rank
            got = (moves.join(rank.withColumnRenamed("host", "src"), "src")
                   .groupBy(F.col("dst").alias("host")).agg(F.sum(F.when(F.col("trust"), share("t"))).alias("t1"),
                                                            F.sum(F.when(~F.col("trust"), share("d"))).alias("d1")))
            rank = seeds.join(got, "host", "left").select(
                "host", (F.expr(f"(t0 * {100 - damping}L) div 100L") + F.coalesce("t1", F.lit(0))).alias("t"),
                (F.expr(f"(d0 * {100 - damping}L) div 100L") + F.coalesce("d1", F.lit(0))).alias("d"))
        both = cut(rank.join(last.select("host", F.col("t").alias("t9"), F.col("d").alias("d9")), "host"), "host-rank")
        rank = both.select("host", "t", "d")
        moved = both.agg(F.sum(F.abs(F.col("t") - F.col("t9")) + F.abs(F.col("d") - F.col("d9")))).first()[0]
        if moved * 1_000_000 <= SETTLED * whole:
            return rank


def verdicts(pages: DataFrame, rules: Sequence[tuple[str, str, str]] = RULES, damping: int = DAMPING) -> DataFrame:
    """(page_id, host, path, rule, verdict, trust, distrust) of every page."""
    pages = pages.select("page_id", "url", "html")
    known = judged(pages, rules)
    per = cut(known.groupBy("host").agg(F.count(F.lit(1)).alias("n"), F.count(F.when(F.col("verdict") == "allow", 1)).alias("a"),
                                        F.count(F.when(F.col("verdict") == "block", 1)).alias("b")), "hosts")
    # a host seeds with the share of its pages that rules allow or block, in thousandths
    part = per.select("host", F.expr("a * 1000 div n").alias("a"), F.expr("b * 1000 div n").alias("b"))
    all_a, all_b, hosts = part.agg(F.sum("a"), F.sum("b"), F.count(F.lit(1))).first()
    seeds = part.select("host", F.expr(f"a * ({MASS}L div {max(1, all_a or 0)}L)").alias("t0"),
                        F.expr(f"b * ({MASS}L div {max(1, all_b or 0)}L)").alias("d0"))
    rank = propagate(host_edges(pages, per.select("host")), seeds, damping)
    all_d = rank.agg(F.sum("d")).first()[0] or 0
    own = rank.select("host", F.col("t").alias("trust"), F.col("d").alias("distrust"),
                      F.when((F.col("d") > F.col("t")) & (F.col("d").cast("decimal(38,0)") * (2 * hosts) > F.lit(all_d)) & (F.col("host") != ""), "block")
                      .otherwise("allow").alias("own"))
    return (known.join(small(own, 200_000), "host", "left")
            .select("page_id", "host", "path", "rule", F.coalesce("verdict", "own").alias("verdict"), "trust", "distrust"))


def op10_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return verdicts(table(spark, sf_dir, "pages"))


QUERIES = {"op10_url_filter": op10_url_filter}
ORACLE: dict[str, str] = {}
