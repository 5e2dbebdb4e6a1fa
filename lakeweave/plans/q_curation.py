"""Registered curation queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from lakeweave.operators import curation as C
from lakeweave.plans.catalog import register, table
from lakeweave.plans.q_tables import customer_versions
from lakeweave.session import shared_dir
from lakeweave.sources.tables import VersionedTable

_LICENSE_CASE = " ".join(
    f"CASE WHEN regexp_matches(text, '{p}') THEN '{t}' END," for p, t in C.LICENSE_RULES).rstrip(",")
_TAGS_SQL = f"list_sort(list_filter([{_LICENSE_CASE}], lambda x: x IS NOT NULL))"
_ALLOWED_SQL = "[" + ", ".join(f"'{a}'" for a in C.PERMISSIVE) + "]"


@register("curation_near_dups", r"""WITH RECURSIVE w AS (
  SELECT doc_id, list_filter(string_split_regex(lower(regexp_replace(text, '[^\p{L}\p{N} \t\n\x0B\f\r]', ' ', 'g')), '[ \t\n\x0B\f\r]+'), lambda x: x <> '') AS w
  FROM documents WHERE doc_id IS NOT NULL),
s AS (SELECT DISTINCT doc_id, array_to_string(w[i:i + 4], ' ') AS g
      FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 3, 2))) AS i FROM w WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM s a JOIN s b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY a.doc_id, b.doc_id),
e AS (SELECT p.a, p.b FROM p JOIN n x ON x.doc_id = p.a JOIN n y ON y.doc_id = p.b WHERE 100 * c >= 80 * (x.n + y.n - c)),
r(doc_id, reach) AS (SELECT a, b FROM e UNION SELECT e.a, r.reach FROM r JOIN e ON e.b = r.doc_id)
SELECT doc_id, least(doc_id, min(reach)) AS component, doc_id > min(reach) AS is_duplicate FROM r GROUP BY doc_id""")
def q_near_dups(spark, sf):
    """Groups of documents by exact Jaccard similarity of word 5-grams."""
    return C.near_dups(table(spark, sf, "documents"), "doc_id", "text")


@register("curation_exact_dups", """WITH d AS (SELECT doc_id, sha256(text) AS digest FROM documents),
g AS (SELECT digest, min(doc_id) AS keep_id, count(*) AS copies FROM d GROUP BY digest HAVING count(*) > 1)
SELECT d.doc_id, g.keep_id, g.copies, d.doc_id <> g.keep_id AS is_duplicate FROM d JOIN g USING (digest)""")
def q_exact_dups(spark, sf):
    """N1 (exact part): documents sharing a text digest."""
    return C.exact_dups(table(spark, sf, "documents"), "doc_id", "text")


@register("curation_license_filter", f"""SELECT doc_id, source, {_TAGS_SQL} AS license_tags FROM documents
WHERE len(list_filter({_TAGS_SQL}, lambda x: NOT list_contains({_ALLOWED_SQL}, x))) = 0""")
def q_license_filter(spark, sf):
    """Documents whose license tags are all permissive."""
    return C.license_filter(table(spark, sf, "documents"), "text").select("doc_id", "source", "license_tags")


@register("curation_provenance", f"""WITH t AS (SELECT source, {_TAGS_SQL} AS tags FROM documents),
k AS (SELECT source, tags, len(list_filter(tags, lambda x: NOT list_contains({_ALLOWED_SQL}, x))) = 0 AS kept FROM t),
e AS (SELECT source, kept, CASE WHEN len(tags) = 0 THEN 'none' ELSE unnest(CASE WHEN len(tags) = 0 THEN ['none'] ELSE tags END) END AS license FROM k)
SELECT source, license, count(*) FILTER (WHERE kept) AS docs_kept, count(*) FILTER (WHERE NOT kept) AS docs_dropped
FROM e GROUP BY source, license""")
def q_provenance(spark, sf):
    """Provenance per source and license tag."""
    return C.provenance(table(spark, sf, "documents"), "text")


@register("curation_revert_shard", """SELECT * FROM documents
WHERE doc_id NOT IN (SELECT doc_id FROM labels WHERE toxic = 1)""")
def q_revert(spark, sf):
    """Documents flagged toxic are reverted out as a new version."""
    t = VersionedTable(spark, shared_dir(spark, "docs"))
    t.overwrite(table(spark, sf, "documents"))
    C.revert_shard(t, table(spark, sf, "labels").where(F.col("toxic") == 1), "doc_id")
    return t.read()


@register("curation_scd2", """SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority,
       o_orderdate AS valid_from,
       lead(o_orderdate) OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS valid_to,
       lead(o_orderdate) OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) IS NULL AS is_current
FROM orders""")
def q_scd2(spark, sf):
    """Type-2 history of each customer's orders."""
    return C.scd2(table(spark, sf, "orders"), "o_custkey", "o_orderdate", "o_orderkey")


@register("curation_scd2_spliced", """SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority,
       o_orderdate AS valid_from,
       lead(o_orderdate) OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS valid_to,
       lead(o_orderdate) OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) IS NULL AS is_current
FROM orders""")
def q_scd2_spliced(spark, sf):
    """The history built from two batches, the second of which holds the
    older orders and some in between; equals the history built at once."""
    o = table(spark, sf, "orders")
    t = VersionedTable(spark, shared_dir(spark, "scd2_spliced"))
    later = (F.col("o_orderdate") >= F.lit("1995-06-01").cast("date")) & ~F.col("o_orderpriority").startswith("3")
    C.splice_scd2(t, o.where(later), "o_custkey", "o_orderdate", "o_orderkey")
    C.splice_scd2(t, o.where(~later), "o_custkey", "o_orderdate", "o_orderkey")
    return t.read()


@register("curation_age_tier", """SELECT CASE WHEN a <= 7 THEN 'hot' WHEN a <= 90 THEN 'warm'
                 WHEN a <= 365 THEN 'cold' ELSE 'archive' END AS tier, count(*) AS n_rows
FROM (SELECT date_diff('day', CAST(o_orderdate AS DATE), (SELECT CAST(max(o_orderdate) AS DATE) FROM orders)) AS a
      FROM orders) GROUP BY 1""")
def q_age_tier(spark, sf):
    """Orders per storage tier, ages relative to the newest order."""
    o = table(spark, sf, "orders")
    as_of = o.agg(F.max("o_orderdate")).collect()[0][0].date().isoformat()   # zone-free literal
    return C.age_tier(o, "o_orderdate", as_of).groupBy("tier").agg(F.count(F.lit(1)).alias("n_rows"))


@register("curation_audited_read", """WITH v0 AS (SELECT c_custkey AS customer_id, 'opened' AS status,
  CAST(c_custkey % 997 AS INTEGER) AS score FROM customer)
SELECT * FROM v0""")
def q_audited_read(spark, sf):
    """A read of version 0 that leaves a row in the audit table."""
    t = customer_versions(spark, sf)
    audit = VersionedTable(spark, shared_dir(spark, "audit"))
    return C.audited_read(t, "analyst", audit, version=0)


@register("curation_embeddings_as_of", "SELECT vec_id, embedding, label FROM embeddings")
def q_embeddings(spark, sf):
    """Embeddings re-computed as version 1; version 0 still reads the original vectors."""
    t = VersionedTable(spark, shared_dir(spark, "embeddings"))
    e = table(spark, sf, "embeddings")
    t.overwrite(e)
    t.overwrite(C.normalize_embeddings(t.read(0)))
    return t.as_of(0)


@register("curation_audit_rows", """SELECT 'analyst' AS who, 0 AS version, count(*) AS n_rows FROM customer
UNION ALL SELECT 'auditor', 1, count(*) FROM customer""")
def q_audit_rows(spark, sf):
    """What the audit table says of two reads, with the rows each version holds."""
    t = customer_versions(spark, sf)
    audit = VersionedTable(spark, shared_dir(spark, "audit_rows"))
    for who, v in (("analyst", 0), ("auditor", 1)):
        C.audited_read(t, who, audit, version=v)
    sizes = [t.as_of(v).agg(F.lit(v).alias("version"), F.count(F.lit(1)).alias("n_rows")) for v in (0, 1)]
    return audit.read().join(sizes[0].unionByName(sizes[1]), "version").select("who", "version", "n_rows")


@register("curation_embeddings_v1", """SELECT vec_id, label, list_transform(embedding, lambda x:
  CAST(round(1000 * CAST(x AS DOUBLE) / sqrt(list_sum(list_transform(embedding, lambda y: CAST(y AS DOUBLE) * CAST(y AS DOUBLE))))) AS INTEGER)) AS embedding
FROM embeddings""")
def q_embeddings_v1(spark, sf):
    """The re-computed vectors of version 1, in thousandths."""
    t = VersionedTable(spark, shared_dir(spark, "embeddings_v1"))
    t.overwrite(table(spark, sf, "embeddings"))
    t.overwrite(C.normalize_embeddings(t.read(0)))
    return t.as_of(1).select("vec_id", "label", F.transform("embedding", lambda x: F.round(1000 * x.cast("double")).cast("int")).alias("embedding"))
