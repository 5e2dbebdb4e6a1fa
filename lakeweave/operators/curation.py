"""Named curation topics as ordinary Spark jobs."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from lakeweave.operators.simjoin import components, similar_groups, small  # noqa: F401
from lakeweave.session import checkpoint_root
from lakeweave.sources.tables import VersionedTable

# ---------------------------------------------------------------- N1 ---------


def words(text: Column) -> Column:
    """Lower-cased words of a whole text (letters and digits)."""
    return F.filter(F.split(F.lower(F.regexp_replace(text, r"[^\p{L}\p{N}\s]", " ")), r"\s+"),
                    lambda w: w != "")


def shingle_hashes(w: Column, n: int = 5) -> Column:
    """Distinct 64-bit hashes of the ``n``-grams of an array of word hashes
    (texts shorter than ``n`` words hash as one shingle). Pass a *column*, not an
    expression: the lambda would re-evaluate it per n-gram."""
    grams = F.when(F.size(w) < n, F.array(F.xxhash64(w))).otherwise(
        F.transform(F.sequence(F.lit(1), F.size(w) - (n - 1)), lambda i: F.xxhash64(F.slice(w, i, n))))
    return F.array_distinct(grams)


def near_dups(df: DataFrame, id_col: str, text_col: str, ngram: int = 5, percent: int = 80) -> DataFrame:
    """Groups of documents whose sets of word ``ngram``-grams have a Jaccard
    similarity of ``percent`` per cent or more, by an exact prefix-filter join
    over whole texts (see ``simjoin``). Returns ``(id, component,
    is_duplicate)`` for documents in a group of two or more; the component's
    least id is the one kept. Texts without words are like nothing."""
    w = df.select(F.col(id_col).alias("id"), F.transform(words(F.col(text_col)), lambda x: F.xxhash64(x)).alias("_w"))
    items = F.when(F.size("_w") > 0, shingle_hashes(F.col("_w"), ngram))
    groups = similar_groups(w.select("id", items.alias("items")), percent)
    return groups.select(F.col("id").alias(id_col), "component", (F.col("id") != F.col("component")).alias("is_duplicate"))


def exact_dups(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Exact copies: rows sharing a text digest, with the least id kept."""
    d = df.select(id_col, F.sha2(F.col(text_col), 256).alias("digest"))
    g = d.groupBy("digest").agg(F.min(id_col).alias("keep_id"), F.count(F.lit(1)).alias("copies"))
    return (d.join(g.where(F.col("copies") > 1), "digest")
            .select(id_col, "keep_id", "copies", (F.col(id_col) != F.col("keep_id")).alias("is_duplicate")))


# ---------------------------------------------------------------- N2 ---------

# License lines found in the documents and the tag each maps to;
# permissive tags pass the filter.
LICENSE_RULES = [
    (r"Apache License, Version 2\.0", "apache-2.0"),
    (r"MIT License", "mit"),
    (r"GNU General Public License, version 3", "gpl-3.0"),
    (r"CC BY-NC 4\.0", "cc-by-nc-4.0"),
]
PERMISSIVE = ["apache-2.0", "mit"]


def license_tags(text: Column) -> Column:
    """Distinct license tags named anywhere in a text."""
    tags = [F.when(text.rlike(p), F.lit(t)) for p, t in LICENSE_RULES]
    return F.array_sort(F.filter(F.array(*tags), lambda x: x.isNotNull()))


def license_filter(df: DataFrame, text_col: str, allowed: Sequence[str] = PERMISSIVE) -> DataFrame:
    """Keep documents whose license tags are all allowed (untagged pass)."""
    allowed_arr = F.array(*[F.lit(a) for a in allowed])
    tagged = df.withColumn("license_tags", license_tags(F.col(text_col)))
    return tagged.where(F.size(F.array_except("license_tags", allowed_arr)) == 0)


def provenance(df: DataFrame, text_col: str, source_col: str = "source",
               allowed: Sequence[str] = PERMISSIVE) -> DataFrame:
    """Per source and license tag, documents kept and dropped."""
    allowed_arr = F.array(*[F.lit(a) for a in allowed])
    t = df.select(source_col, license_tags(F.col(text_col)).alias("tags"))
    t = t.withColumn("kept", F.size(F.array_except("tags", allowed_arr)) == 0)
    t = t.select(source_col, "kept", F.explode_outer("tags").alias("license"))
    return (t.groupBy(source_col, F.coalesce("license", F.lit("none")).alias("license"))
            .agg(F.count(F.when(F.col("kept"), 1)).alias("docs_kept"),
                 F.count(F.when(~F.col("kept"), 1)).alias("docs_dropped")))


# ---------------------------------------------------------------- N3 ---------


def revert_shard(table: VersionedTable, bad_ids: DataFrame, key: str) -> int:
    """Remove rows whose ``key`` is in ``bad_ids`` as a new version; only
    files holding such rows are rewritten (anti join)."""
    bad = bad_ids.select(key).distinct()
    cur = table.commit_info()
    schema = table.schema()
    rows = table._read_batches(cur["batches"], schema, with_file=True)
    keep, touched = table.split_live(cur["batches"], table.files_where(rows.join(bad, key, "left_semi")))
    if not touched:
        return table.latest_version()
    kept = table._read_batches(touched, schema).join(bad, key, "left_anti")
    return table.replace_entries(kept, keep, "REVERT", extra_metrics={"numFilesRewritten": len(touched)})


# ---------------------------------------------------------------- N4 ---------


def scd2(changes: DataFrame, key: str, ts: str, tiebreak: str, bucket: str = "month") -> DataFrame:
    """Type-2 history from change rows: ``valid_from``, ``valid_to`` (the
    next change of the key) and ``is_current``.

    ``lead`` runs per (key, time bucket), so a key with a third of all rows is
    still spread over many tasks; the last row of a bucket takes the first
    time of the key's next bucket, found by a second ``lead`` over one row per
    (key, bucket). Rows without a key or a time have no place in a history:
    they are kept, never current and without an end.
    """
    placed = F.col(key).isNotNull() & F.col(ts).isNotNull()
    b = F.date_trunc(bucket, F.col(ts))
    c = changes.where(placed).withColumn("_b", b)
    w_in = Window.partitionBy(key, "_b").orderBy(ts, tiebreak)
    c = c.withColumn("_next", F.lead(ts).over(w_in))
    firsts = c.groupBy(key, "_b").agg(F.min(ts).alias("_first"))
    w_b = Window.partitionBy(key).orderBy("_b")
    firsts = firsts.withColumn("_next_bucket", F.lead("_first").over(w_b)).drop("_first")
    out = c.join(firsts, [key, "_b"]).withColumn("valid_to", F.coalesce("_next", "_next_bucket"))
    out = out.select(*changes.columns, F.col(ts).alias("valid_from"), "valid_to",
                     F.col("valid_to").isNull().alias("is_current"))
    loose = changes.where(~placed)
    return out.unionByName(loose.select(*changes.columns, F.col(ts).alias("valid_from"), F.lit(None).cast(changes.schema[ts].dataType).alias("valid_to"),
                                        F.lit(False).alias("is_current")))


def splice_scd2(table: VersionedTable, changes: DataFrame, key: str, ts: str, tiebreak: str) -> int:
    """Put a batch of changes, of any age, into a stored type-2 history.

    A change closes the row before it and ends where the next row of its key
    begins, so only the two neighbours of each new row are touched. Stored rows of other
    keys are not read past their key column, and of the batch's keys only the
    neighbours are rewritten: the merge updates the closed rows and inserts the
    new ones. A change that the history holds already (same key, time and
    tiebreak) replaces it."""
    placed = F.col(key).isNotNull() & F.col(ts).isNotNull()
    own = [c for c in changes.columns]
    if not table.exists():
        return table.overwrite(scd2(changes, key, ts, tiebreak))
    checkpoint_root(changes.sparkSession)
    new = changes.where(placed).dropDuplicates([key, ts, tiebreak]).checkpoint()
    loose = changes.where(~placed)
    keys = small(new.select(key).distinct())
    old = table.read().where(placed).join(keys, key, "left_semi")
    ids = [key, ts, tiebreak]
    # the batch's rows among the places of its keys' stored rows
    both = (old.select(*ids, F.lit(True).alias("_old")).join(new.select(*ids), ids, "left_anti")
            .unionByName(new.select(*ids, F.lit(False).alias("_old"))))
    b = F.date_trunc("month", F.col(ts))
    both = both.withColumn("_b", b)
    inner = Window.partitionBy(key, "_b").orderBy(ts, tiebreak)
    both = both.select("*", F.lead(ts).over(inner).alias("_next"), F.lead("_old").over(inner).alias("_next_old"))
    per = both.groupBy(key, "_b").agg(F.min(F.struct(ts, tiebreak, "_old")).alias("_f"))
    per = per.select(key, "_b", F.lead(F.struct(F.col(f"_f.{ts}").alias("t"), F.col("_f._old").alias("o"))).over(Window.partitionBy(key).orderBy("_b")).alias("_after"))
    both = both.join(per, [key, "_b"]).select(*ids, "_old", F.coalesce("_next", "_after.t").alias("valid_to"), F.coalesce("_next_old", "_after.o").alias("_next_old"))
    # stored rows change only where a new row follows them
    spans = both.where(~F.col("_old") | (F.col("_next_old") == F.lit(False))).checkpoint()
    end = lambda df: df.select(*own, F.col(ts).alias("valid_from"), "valid_to", F.col("valid_to").isNull().alias("is_current"))
    closed = end(old.select(*own).join(spans.where("_old").select(*ids, "valid_to"), ids))
    added = end(new.join(spans.where(~F.col("_old")).select(*ids, "valid_to"), ids))
    version = table.merge(closed.unionByName(added), ids)
    if not loose.isEmpty():
        version = table.append(loose.select(*own, F.col(ts).alias("valid_from"), F.lit(None).cast(changes.schema[ts].dataType).alias("valid_to"), F.lit(False).alias("is_current")))
    return version


# ---------------------------------------------------------------- N5 ---------

# Age-tier limits in days (hot / warm / cold, older = archive).
AGE_TIERS = [(7, "hot"), (90, "warm"), (365, "cold")]


def age_tier(df: DataFrame, ts: str, as_of) -> DataFrame:
    """Storage tier by age in days relative to ``as_of``."""
    age = F.datediff(F.lit(as_of).cast("date") if not isinstance(as_of, Column) else as_of.cast("date"),
                     F.col(ts).cast("date"))
    tier = None
    for days, name in AGE_TIERS:
        tier = F.when(age <= days, F.lit(name)) if tier is None else tier.when(age <= days, F.lit(name))
    return df.withColumn("age_days", age).withColumn("tier", tier.otherwise(F.lit("archive")))


# ---------------------------------------------------------------- N6 ---------


def audited_read(table: VersionedTable, who: str, audit: VersionedTable, version: int | None = None) -> DataFrame:
    """Read a table and append who read which version to ``audit``."""
    from datetime import datetime, timezone
    v = table.latest_version() if version is None else version
    row = table.spark.createDataFrame(
        [(datetime.now(timezone.utc).replace(tzinfo=None), who, table.root, v)],
        "ts timestamp, who string, table_root string, version int")
    if audit.exists():
        audit.append(row)
    else:
        audit.overwrite(row)
    return table.read(v)


# ---------------------------------------------------------------- N7 ---------


def normalize_embeddings(df: DataFrame, col: str = "embedding") -> DataFrame:
    """A re-embedding step for N7: L2-normalized vectors (a new model version)."""
    norm = F.sqrt(F.aggregate(F.col(col), F.lit(0.0), lambda acc, x: acc + x.cast("double") * x))
    return df.withColumn(col, F.transform(F.col(col), lambda x: (x / norm).cast("float")))
