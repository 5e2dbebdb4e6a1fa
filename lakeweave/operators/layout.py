"""Physical-layout jobs on versioned tables.

Compaction, clustering and file statistics are ordinary DataFrame jobs whose
output becomes a new version. File lists and per-file statistics are metadata
(one row per file); they are the only things brought to the driver.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from lakeweave.sources.tables import VersionedTable

DEFAULT_TARGET_BYTES = 128 << 20
#: Distinct values drawn to find the split points of a string column.
STRING_SAMPLE = 20_000
#: Tasks that write one file each, at most; with more files a task writes several
#: and takes about ``TASK_BYTES``.
MOST_TASKS = 200
TASK_BYTES = 32 << 20


def small_file_append(table: VersionedTable, df: DataFrame, n_files: int = 200) -> int:
    """L1: the small-file workload: ``df`` appended as ``n_files`` files."""
    return table.append(df.repartition(n_files))


def _files(table: VersionedTable, version: int | None = None):
    """Per-batch (files, bytes) of a version: file listing only, no data read."""
    rows = table.files(version).groupBy("batch").agg(
        F.count(F.lit(1)).alias("files"), F.sum("size_bytes").alias("bytes")).collect()
    return {r["batch"]: (int(r["files"]), int(r["bytes"])) for r in rows}


def compact(table: VersionedTable, target_bytes: int = DEFAULT_TARGET_BYTES,
            min_file_ratio: float = 0.5) -> dict:
    """Rewrite small files into files of about ``target_bytes``.

    Every live file below ``min_file_ratio * target`` is taken, whichever
    batch it is in; large files stay where they are. An unpartitioned rewrite
    uses ``coalesce(n)``: each output task reads a run of input files and
    writes one file, so compaction needs no shuffle. For a partitioned table
    the writer's rebalance is the one shuffle, and ``maxRecordsPerFile`` caps
    the files.
    """
    entry = F.regexp_extract("file_path", r"/data/batch=(.*)$", 1)
    files = table.files().select(entry.alias("entry"), "size_bytes").cache()
    total = files.count()
    small = files.where(F.col("size_bytes") < target_bytes * min_file_ratio)
    rows = small.collect()          # metadata: one row per small file
    files.unpersist()
    n_out = max(1, math.ceil(sum(r["size_bytes"] for r in rows) / target_bytes))
    if len(rows) <= n_out:
        return {"numFilesRemoved": 0, "numFilesAdded": 0, "totalConsideredFiles": total, "version": table.latest_version()}
    keep, touched = table.split_live(table.commit_info()["batches"], {r["entry"] for r in rows})
    df = table._read_batches(touched, table.schema())
    per_file = None
    if table.commit_info()["partition_by"]:
        per_file = max(1, math.ceil(df.count() / n_out))
    else:
        df = df.coalesce(n_out)
    v = table.replace_entries(df, keep, "OPTIMIZE", max_records_per_file=per_file, params={"targetBytes": target_bytes},
                              extra_metrics={"numFilesRemoved": len(rows), "totalConsideredFiles": total})
    added = table.commit_info(v)["metrics"]["numFiles"]
    return {"numFilesRemoved": len(rows), "numFilesAdded": int(added), "totalConsideredFiles": total, "version": v}


def orderable(c: Column, dtype: str) -> Column:
    """The column as a number in the same order; strings stay as they are."""
    if dtype == "string":
        return c
    if dtype == "date":
        return F.unix_date(c).cast("long")
    if dtype.startswith("timestamp"):
        return F.unix_micros(c.cast("timestamp")).cast("long")
    if dtype in ("double", "float") or dtype.startswith("decimal"):
        return c.cast("double")
    return c.cast("long")


def split_points(df: DataFrame, cols: Sequence[str], buckets: int, rel_error: float) -> list[list]:
    """Up to ``buckets - 1`` split points of each column. Numbers take them
    from ``approxQuantile`` (a bounded sketch). Whole strings take them from a
    uniform draw of about ``STRING_SAMPLE`` rows; a draw only places the
    points, every row is then put between them."""
    dtypes = dict(df.dtypes)
    probs = [i / buckets for i in range(1, buckets)]
    numbers = [c for c in cols if dtypes[c] != "string"]
    found = {}
    if numbers:
        keyed = df.select(*[orderable(F.col(c), dtypes[c]).alias(f"_k{i}") for i, c in enumerate(numbers)])
        got = keyed.approxQuantile([f"_k{i}" for i in range(len(numbers))], probs, rel_error)
        found = {c: sorted({float(v) for v in q}) for c, q in zip(numbers, got)}
    texts = [c for c in cols if dtypes[c] == "string"]
    if texts:
        share = min(1.0, 2 * STRING_SAMPLE / max(1, df.count()))
        drawn = df.select(*texts).sample(share, seed=1).limit(4 * STRING_SAMPLE).collect()
        for c in texts:
            values = sorted(r[c] for r in drawn if r[c] is not None)
            found[c] = sorted({values[int(p * len(values))] for p in probs}) if values else []
    return [found[c] for c in cols]


def with_buckets(df: DataFrame, cols: Sequence[str], splits: Sequence[Sequence]) -> DataFrame:
    """``df`` plus ``_zb0``, ``_zb1``, ...: how many of a column's sorted split
    points are at or below its value (NULL: 0). A binary search over the points as one array, a
    column a step, so the expression grows with the logarithm of their number."""
    dtypes = dict(df.dtypes)
    out = df.select("*", *[orderable(F.col(c), dtypes[c]).alias(f"_zk{i}") for i, c in enumerate(cols)],
                    *[F.lit(0).alias(f"_zb{i}") for i in range(len(cols))])
    arrays = [F.array(*[F.lit(v) for v in points]) for points in splits]
    for step in (1 << k for k in reversed(range(max(len(points) for points in splits).bit_length()))):
        moves = {}
        for i, points in enumerate(splits):
            if step <= len(points):
                at = F.col(f"_zb{i}")
                beyond = (at + step <= len(points)) & (F.col(f"_zk{i}") >= F.get(arrays[i], at + (step - 1)))
                moves[f"_zb{i}"] = at + F.when(beyond, step).otherwise(0)
        out = out.withColumns(moves)
    return out.drop(*[f"_zk{i}" for i in range(len(cols))])


def with_z_value(df: DataFrame, cols: Sequence[str], bits: int = 8, rel_error: float = 0.001,
                 out: str = "_z") -> DataFrame:
    """``df`` plus an interleaved-bit (Morton) value of per-column quantile buckets.

    Each column is mapped to ``2**bits`` buckets (see :func:`split_points`;
    only the split points reach the driver), then the bucket bits are
    interleaved so rows close in every column get close z-values. Buckets are
    materialized as columns first so the interleaving refers to them instead
    of repeating the bucket expression per bit (which would bloat generated
    code).
    """
    staged = with_buckets(df, cols, split_points(df, cols, 1 << bits, rel_error))
    n = len(cols)
    terms = [F.shiftleft(F.shiftright(F.col(f"_zb{j}"), b).bitwiseAND(F.lit(1)).cast("long"), b * n + j)
             for b in range(bits) for j in range(n)]
    z = reduce(lambda a, b: a.bitwiseOR(b), terms)
    return staged.withColumn(out, z).drop(*[f"_zb{j}" for j in range(n)])


def rewrite_tasks(n_files: int, size: int) -> int:
    """Tasks that write ``n_files`` files of ``size`` bytes in all: one a file up
    to ``MOST_TASKS``, then as many, or what ``TASK_BYTES`` gives. The driver
    hears from tasks, not from files, and range bounds are drawn per task."""
    return n_files if n_files <= MOST_TASKS else min(n_files, max(MOST_TASKS, math.ceil(size / TASK_BYTES)))


def zorder(table: VersionedTable, cols: Sequence[str], target_bytes: int = DEFAULT_TARGET_BYTES) -> dict:
    """Cluster the table by ``cols`` into files of about ``target_bytes``.

    One column: range-partition on it and sort within partitions. Several
    columns: range-partition and sort on the z-value. The partition columns
    of the table come first, so a directory's files don't overlap in the
    clustering key either. The range partitioner samples the key, so file
    counts are close to, not exactly, the target. Of very many files a task
    writes several, each a run of its sorted rows (see :func:`rewrite_tasks`).
    """
    cols = list(cols)
    per_batch = _files(table)
    size = sum(b for _, b in per_batch.values())
    files_before = sum(n for n, _ in per_batch.values())
    n_out = max(1, math.ceil(size / target_bytes))
    pcols = list(table.commit_info()["partition_by"])
    df = table.read()
    if len(cols) > 1:
        # a few buckets a file in each column, so the files have edges to choose from
        bits = min(10, max(4, math.ceil(math.log2(n_out + 1) / len(cols)) + 3))
        df = with_z_value(df, cols, bits)
    by = [*pcols, cols[0] if len(cols) == 1 else "_z"]
    n_tasks = rewrite_tasks(n_out, size)
    per_file = math.ceil(table.read().count() / n_out) if n_tasks < n_out else None
    out = df.repartitionByRange(n_tasks, *by).sortWithinPartitions(*by).drop("_z")
    v = table.replace_batches(out, list(per_batch), "OPTIMIZE", max_records_per_file=per_file,
                              params={"zOrderBy": ",".join(cols), "targetBytes": target_bytes},
                              extra_metrics={"numFilesRemoved": files_before,
                                             "totalConsideredFiles": files_before},
                              stats_cols=cols, laid_out=True)
    added = int(table.commit_info(v)["metrics"]["numFiles"])
    return {"numFilesRemoved": files_before, "numFilesAdded": added,
            "totalConsideredFiles": files_before, "version": v}


def file_stats(table: VersionedTable, cols: Sequence[str], version: int | None = None) -> DataFrame:
    """L4: per data file: rows, min, max and NULL count of ``cols``.

    Batches written with statistics for these columns (z-order and
    compaction store them for their clustering columns) are answered from
    the stored rows, one per file; only the other batches are scanned, by a
    column-pruned aggregate.
    """
    cols = list(cols)
    c = table.commit_info(version)
    schema = table.schema(c["version"])
    stored = [b for b in c["batches"] if "/" not in b and set(cols) <= set(table.stats_columns(b))]
    missing = [b for b in c["batches"] if b not in stored]
    want = ["file_path", "batch", "num_records"] + [f"{k}_{x}" for x in cols for k in ("min", "max", "nulls")]
    parts = []
    if stored:
        parts.append(table.spark.read.option("basePath", f"{table.root}/_stats")
                     .parquet(*[table.stats_path(b) for b in stored]).select(*want))
    if missing or not parts:
        parts.append(table.scan_file_stats(missing, cols, schema).select(*want))
    return reduce(lambda a, b: a.unionByName(b), parts)


def covering(stats: DataFrame, equals: dict) -> DataFrame:
    """Files whose ``[min, max]`` can contain every ``col = value``."""
    cond = reduce(lambda a, b: a & b, [
        F.coalesce((F.col(f"min_{c}") <= F.lit(v)) & (F.col(f"max_{c}") >= F.lit(v)), F.lit(False))
        for c, v in equals.items()])
    return stats.where(cond)


def pruned_read(table: VersionedTable, equals: dict, version: int | None = None) -> DataFrame:
    """Read only files whose stored statistics can match, then apply the
    predicate.

    Whatever statistics a batch has for the predicate's columns are used; a
    batch without any is read with the predicate pushed down to its row
    groups. No data is scanned to find the files: their list is metadata (at
    most one row per file).
    """
    c = table.commit_info(version)
    schema = table.schema(c["version"])
    pred = reduce(lambda a, b: a & b, [F.col(k) == F.lit(v) for k, v in equals.items()])
    groups: dict[tuple, list[str]] = {}
    for e in c["batches"]:
        groups.setdefault(tuple(k for k in equals if k in table.stats_columns(e)), []).append(e)
    entries = groups.pop((), [])
    for known, batches in groups.items():
        stats = (table.spark.read.option("basePath", f"{table.root}/_stats")
                 .parquet(*[table.stats_path(b) for b in batches]))
        entries += [r[0] for r in covering(stats, {k: equals[k] for k in known})
                    .select(F.regexp_extract("file_path", r"/data/batch=(.*)$", 1)).collect()]
    return table._read_batches(sorted(entries), schema).where(pred)


def pruning_report(table: VersionedTable, equals: dict, stats: DataFrame | None = None,
                   version: int | None = None) -> DataFrame:
    """Files in total, files that cover the point, pruned ratio files/max(hits,1)."""
    stats = file_stats(table, list(equals), version) if stats is None else stats
    cond = reduce(lambda a, b: a & b, [
        F.coalesce((F.col(f"min_{c}") <= F.lit(v)) & (F.col(f"max_{c}") >= F.lit(v)), F.lit(False))
        for c, v in equals.items()])
    return (stats.agg(F.count(F.lit(1)).alias("files"), F.sum(F.when(cond, 1).otherwise(0)).alias("hits"))
            .select("files", F.coalesce("hits", F.lit(0)).alias("hits"),
                    (F.col("files") / F.greatest(F.coalesce("hits", F.lit(0)), F.lit(1))).alias("pruned_ratio")))


def reduction_ratio(files_before: int, files_after: int) -> float:
    """How many times fewer files."""
    return files_before / max(files_after, 1)


def health(table: VersionedTable, max_avg_file_bytes: int = 64 * 1024 * 1024) -> DataFrame:
    """Per version: files, bytes, average file size, and whether files grew
    faster than rows since the previous version (from commit metrics)."""
    from pyspark.sql import Window as W
    h = table.history().select(
        "version", "operation",
        F.col("operationMetrics")["numFiles"].cast("long").alias("files_written"),
        F.col("operationMetrics")["numOutputRows"].cast("long").alias("rows_written"),
        F.col("operationMetrics")["numBytes"].cast("long").alias("bytes_written"))
    # One row per version: the window is over metadata, not data.
    w = W.orderBy("version")
    return (h.where(F.col("files_written").isNotNull())
            .withColumn("avg_file_bytes", F.col("bytes_written") / F.greatest(F.col("files_written"), F.lit(1)))
            .withColumn("files_per_krow", F.col("files_written") * 1000.0 / F.greatest(F.col("rows_written"), F.lit(1)))
            .withColumn("prev_files_per_krow", F.lag("files_per_krow").over(w))
            .select("version", "operation", "files_written", "rows_written", "avg_file_bytes",
                    (F.col("avg_file_bytes") < max_avg_file_bytes).alias("small_files"),
                    F.coalesce(F.col("files_per_krow") > F.col("prev_files_per_krow"), F.lit(False))
                    .alias("files_outpace_rows")))


def layout_columns(df: DataFrame, ts: str, tenant: str, n_buckets: int = 16) -> DataFrame:
    """``event_date``, ``hour`` and a hashed tenant ``bucket`` for
    ``partitionBy("event_date", "hour", "bucket")``. The bucket bounds the
    directory count per hour whatever the number of tenants."""
    return df.select("*", F.to_date(F.col(ts)).alias("event_date"), F.hour(F.col(ts)).alias("hour"),
                     F.pmod(F.xxhash64(F.col(tenant)), F.lit(n_buckets)).cast("int").alias("bucket"))
