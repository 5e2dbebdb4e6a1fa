"""Versioned Parquet tables.

A table at ``root`` is

* ``root/data/batch=b<version>_<attempt>/``: one immutable batch of Parquet
  files per write, written by the ordinary Parquet writer (optionally
  ``partitionBy``), under a name no other attempt uses;
* ``root/_commits/version=<n>/``: one row per version with the commit time,
  operation, the list of live batches, the schema, partition columns and
  metrics.

A version is the list of batches its commit names, so time travel, restore
and history are metadata operations; only merge, overwrite and layout
rewrites write data. Reads hand the batch directories and the commit's schema
to ``spark.read.parquet``, so column pruning, filter and partition pushdown
stay Spark's own. A finished version is never overwritten: a second writer
racing for it fails. What a dead writer leaves (a batch without a commit, a
commit folder without ``_SUCCESS``) is in nobody's way. One writer at a time; this is not a transaction log with conflict resolution.
"""

from __future__ import annotations

import json
import uuid
from datetime import datetime, timezone
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, Row, SparkSession, functions as F, types as T

from lakeweave.session import checkpoint_root

COMMIT_SCHEMA = T.StructType([
    T.StructField("ts", T.TimestampType()),
    T.StructField("operation", T.StringType()),
    T.StructField("batches", T.ArrayType(T.StringType())),
    T.StructField("partition_by", T.ArrayType(T.StringType())),
    T.StructField("schema_json", T.StringType()),
    T.StructField("metrics", T.MapType(T.StringType(), T.StringType())),
    T.StructField("params", T.MapType(T.StringType(), T.StringType())),
])

BATCH_COL = "_batch"
FILE_COL = "_file"


class SchemaMismatch(ValueError):
    """Raised before any data is written when a write does not fit the table schema."""


class MergeConflict(ValueError):
    """Raised when several source rows share one merge key."""


# Safe widenings accepted on append/merge without schema_mode.
_WIDEN = {
    (T.ByteType, T.ShortType), (T.ByteType, T.IntegerType), (T.ByteType, T.LongType),
    (T.ShortType, T.IntegerType), (T.ShortType, T.LongType), (T.IntegerType, T.LongType),
    (T.FloatType, T.DoubleType), (T.IntegerType, T.DoubleType), (T.DateType, T.TimestampType),
}


def _widenable(src: T.DataType, dst: T.DataType) -> bool:
    return src == dst or (type(src), type(dst)) in _WIDEN or isinstance(src, T.NullType)


def conform(df: DataFrame, schema: T.StructType, schema_mode: str | None) -> tuple[DataFrame, T.StructType]:
    """V1/V2: check ``df`` against ``schema``; return the frame cast to the
    table types and the (possibly merged) table schema.

    Without ``schema_mode`` a new column or a non-widening type change is
    rejected; with ``schema_mode='merge'`` new columns are added as nullable
    (old rows read NULL), type changes are still rejected.
    """
    tf = {f.name: f for f in schema.fields}
    new_fields = []
    casts = []
    for f in df.schema.fields:
        if f.name not in tf:
            if schema_mode != "merge":
                raise SchemaMismatch(f"column {f.name!r} is not in the table schema; "
                                     "pass schema_mode='merge' to add it")
            new_fields.append(T.StructField(f.name, f.dataType, True))
            casts.append(F.col(f.name))
        else:
            want = tf[f.name].dataType
            if not _widenable(f.dataType, want):
                raise SchemaMismatch(f"column {f.name!r} has type {f.dataType.simpleString()}, "
                                     f"table has {want.simpleString()}")
            casts.append(F.col(f.name) if f.dataType == want else F.col(f.name).cast(want).alias(f.name))
    merged = T.StructType(list(schema.fields) + new_fields)
    return df.select(*casts), merged


def row_digest(df: DataFrame, seed: int) -> Column:
    """64 bits that tell a row's values apart, NULLs and their places included."""
    parts = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, (T.ArrayType, T.MapType, T.StructType)):
            parts.append(F.to_json(F.struct(c), {"ignoreNullFields": "false"}))
        else:
            parts += [c, c.isNull()]
    return F.xxhash64(F.lit(seed), *parts)


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether ``path`` exists, asked of the path's Hadoop file system."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return bool(p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p))


def decoded(path: Column) -> Column:
    """A file path as listings give it: ``_metadata.file_path`` is URL-encoded
    (a plus sign stands for itself there)."""
    return F.url_decode(F.replace(path, F.lit("+"), F.lit("%2B")))


def entry_batch(entry: str) -> str:
    """Batch id of a live entry: ``b<version>_<attempt>``, or that and ``/<file path>``."""
    return entry.split("/", 1)[0]


class VersionedTable:
    """A versioned table at ``root`` (any Hadoop-compatible URL).

    A version's live list holds whole batches (``b<version>_<attempt>``) or,
    after a file-level rewrite, single files of a batch (``b<version>_<attempt>/
    <relative path>``, decoded); both resolve under ``data/batch=``.
    """

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")
        self._cache: dict[int, Row] = {}

    # -- layout ------------------------------------------------------------
    @property
    def data_dir(self) -> str:
        return f"{self.root}/data"

    @property
    def commits_dir(self) -> str:
        return f"{self.root}/_commits"

    def batch_path(self, batch: str) -> str:
        return f"{self.data_dir}/batch={batch}"

    # -- commit log ----------------------------------------------------------
    def _committed_versions(self) -> list[int]:
        """Versions whose commit finished (``_SUCCESS`` present), from a
        directory listing on the driver."""
        jvm = self.spark.sparkContext._jvm
        p = jvm.org.apache.hadoop.fs.Path(self.commits_dir)
        fs = p.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())
        if not fs.exists(p):
            return []
        out = []
        for st in fs.listStatus(p):
            name = st.getPath().getName()
            if not name.startswith("version="):
                continue
            v = int(name.split("=", 1)[1])
            if v in self._cache or fs.exists(jvm.org.apache.hadoop.fs.Path(st.getPath(), "_SUCCESS")):
                out.append(v)
        return sorted(out)

    def _commit_frame(self, versions: list[int]) -> DataFrame:
        schema = T.StructType(list(COMMIT_SCHEMA.fields) + [T.StructField("version", T.IntegerType())])
        return (self.spark.read.schema(schema).option("basePath", self.commits_dir)
                .parquet(*[f"{self.commits_dir}/version={v}" for v in versions]))

    def commits(self) -> list:
        """All commit rows, oldest first (metadata: one row per version).

        Commit rows are cached per table object; only versions this object
        has not seen (written by another writer) are read, in one job.
        """
        versions = self._committed_versions()
        missing = [v for v in versions if v not in self._cache]
        if missing:
            for r in self._commit_frame(missing).collect():
                self._cache[r["version"]] = r
        return [self._cache[v] for v in versions if v in self._cache]

    def exists(self) -> bool:
        return bool(self.commits())

    def _commit_at(self, version: int | None):
        cs = self.commits()
        if not cs:
            raise FileNotFoundError(f"no table at {self.root}")
        if version is None:
            return cs[-1]
        for c in cs:
            if c["version"] == version:
                return c
        raise ValueError(f"version {version} does not exist (latest is {cs[-1]['version']})")

    def latest_version(self) -> int:
        return self._commit_at(None)["version"]

    def schema(self, version: int | None = None) -> T.StructType:
        return T.StructType.fromJson(json.loads(self._commit_at(version)["schema_json"]))

    def _publish(self, version: int, operation: str, batches: list[str], partition_by: list[str],
                 schema: T.StructType, metrics: dict | None = None, params: dict | None = None) -> int:
        row = (datetime.now(timezone.utc).replace(tzinfo=None), operation, list(batches), list(partition_by),
               schema.json(), {k: str(v) for k, v in (metrics or {}).items()},
               {k: str(v) for k, v in (params or {}).items()})
        path = f"{self.commits_dir}/version={version}"
        # A folder without _SUCCESS is what a writer that died left: replace it.
        dead = path_exists(self.spark, path) and not path_exists(self.spark, f"{path}/_SUCCESS")
        (self.spark.createDataFrame([row], COMMIT_SCHEMA).coalesce(1)
         .write.mode("overwrite" if dead else "errorifexists").parquet(path))
        names = COMMIT_SCHEMA.fieldNames() + ["version"]
        self._cache[version] = Row(**dict(zip(names, list(row) + [version])))
        return version

    # -- reads ---------------------------------------------------------------
    def _read_batches(self, batches: list[str], schema: T.StructType, with_batch: bool = False,
                      with_file: bool = False) -> DataFrame:
        if not batches:
            out = self.spark.createDataFrame([], schema)
            if with_batch:
                out = out.withColumn(BATCH_COL, F.lit(None).cast("string"))
            return out.withColumn(FILE_COL, F.lit(None).cast("string")) if with_file else out
        # basePath = data/: Spark discovers ``batch`` and any partition
        # directories below it as one consistent layout across batches.
        full = T.StructType(list(schema.fields) + [T.StructField("batch", T.StringType())])
        df = (self.spark.read.schema(full).option("basePath", self.data_dir)
              .parquet(*[self.batch_path(b) for b in batches]))
        cols = [F.col(c) for c in schema.fieldNames()]
        if with_batch:
            cols.append(F.col("batch").alias(BATCH_COL))
        if with_file:
            cols.append(decoded(F.col("_metadata.file_path")).alias(FILE_COL))
        return df.select(*cols)

    def read_with_files(self, version: int | None = None) -> DataFrame:
        """The table plus ``_file`` (the data file each row lives in) and ``_batch``."""
        c = self._commit_at(version)
        return self._read_batches(c["batches"], T.StructType.fromJson(json.loads(c["schema_json"])),
                                  with_batch=True, with_file=True)

    def commit_info(self, version: int | None = None):
        """The commit row of a version (metadata)."""
        return self._commit_at(version)

    def read(self, version: int | None = None) -> DataFrame:
        """The table (at ``version``) with that version's schema."""
        c = self._commit_at(version)
        return self._read_batches(c["batches"], T.StructType.fromJson(json.loads(c["schema_json"])))

    as_of = read

    def create_view(self, name: str, version: int | None = None) -> None:
        """Expose a version as a temp view for ``spark.sql``."""
        self.read(version).createOrReplaceTempView(name)

    def files(self, version: int | None = None) -> DataFrame:
        """Data files of a version with their sizes: ``(batch, file_path, size_bytes)``."""
        c = self._commit_at(version)
        if not c["batches"]:
            return self.spark.createDataFrame([], "batch string, file_path string, size_bytes long")
        df = self.spark.read.format("binaryFile").option("recursiveFileLookup", "true") \
            .option("pathGlobFilter", "*.parquet").load([self.batch_path(b) for b in c["batches"]])
        return df.select(F.regexp_extract("path", r"/batch=(b[0-9]+_[0-9a-f]+)/", 1).alias("batch"),
                         F.col("path").alias("file_path"), F.col("length").alias("size_bytes"))

    # -- per-file statistics ----------------------------------------------------
    def stats_path(self, batch: str) -> str:
        return f"{self.root}/_stats/batch={batch}"

    def scan_file_stats(self, batches: list[str], cols: list[str], schema: T.StructType | None = None) -> DataFrame:
        """Per data file: rows, min, max and NULL count of ``cols``, by one
        column-pruned aggregate over the given batches."""
        schema = schema or self.schema()
        df = self._read_batches(batches, schema, with_batch=True, with_file=True).select(FILE_COL, BATCH_COL, *cols)
        aggs = [F.count(F.lit(1)).alias("num_records")]
        for c in cols:
            aggs += [F.min(c).alias(f"min_{c}"), F.max(c).alias(f"max_{c}"),
                     F.count(F.when(F.col(c).isNull(), 1)).alias(f"nulls_{c}")]
        return df.groupBy(F.col(FILE_COL).alias("file_path"), F.col(BATCH_COL).alias("batch")).agg(*aggs)

    def _write_stats(self, batch: str, cols: list[str], schema: T.StructType) -> None:
        """Store file statistics of a just-written batch (reads only that batch)."""
        (self.scan_file_stats([batch], cols, schema).coalesce(1)
         .write.mode("overwrite").parquet(self.stats_path(batch)))

    def live(self, batch_ids, version: int | None = None) -> list[str]:
        """Live entries of a version that belong to the given batch ids."""
        ids = set(batch_ids)
        return [e for e in self._commit_at(version)["batches"] if entry_batch(e) in ids]

    def _key_range_candidates(self, entries: list[str], src: DataFrame, keys: list[str]) -> list[str]:
        """Entries that may hold a source key: for batches with stored
        statistics on a single key column, only files whose [min, max]
        overlaps the source's key range (one aggregate over the source, one
        read of the stored per-file rows); other entries are all candidates."""
        if len(keys) != 1:
            return list(entries)
        k = keys[0]
        stored = [e for e in entries if "/" not in e and k in self.stats_columns(e)]
        if not stored:
            return list(entries)
        lo, hi = src.agg(F.min(k), F.max(k)).collect()[0]
        rest = [e for e in entries if e not in stored]
        if lo is None:
            return rest
        st = (self.spark.read.option("basePath", f"{self.root}/_stats")
              .parquet(*[self.stats_path(b) for b in stored])
              .where((F.col(f"max_{k}") >= F.lit(lo)) & (F.col(f"min_{k}") <= F.lit(hi))))
        rel = F.regexp_extract(F.col("file_path"), r"/data/batch=(.*)$", 1)
        return rest + sorted(r[0] for r in st.select(rel).collect())

    def split_live(self, entries: list[str], files: set[str]) -> tuple[list[str], list[str]]:
        """Split live entries into (kept, touched) given touched file entries:
        a whole batch with some touched files is opened up into its files."""
        by_batch: dict[str, set] = {}
        for f in files:
            by_batch.setdefault(entry_batch(f), set()).add(f)
        keep: list[str] = []
        touched: list[str] = []
        for e in entries:
            hit = by_batch.get(entry_batch(e))
            if not hit:
                keep.append(e)
            elif "/" in e:
                (touched if e in hit else keep).append(e)
            else:
                for f in self.batch_files(e):
                    (touched if f in hit else keep).append(f)
        lost = files - set(touched)
        if lost:
            raise RuntimeError(f"files with matched rows are not live: {sorted(lost)[:3]}")
        return keep, touched

    def files_where(self, df: DataFrame) -> set[str]:
        """Distinct live file entries of the rows of ``df`` (read with ``with_file``)."""
        rel = F.regexp_extract(F.col(FILE_COL), r"/data/batch=(.*)$", 1)
        return {r[0] for r in df.select(rel).distinct().collect()}

    def replace_entries(self, df: DataFrame, keep: list[str], operation: str, params: dict | None = None,
                        extra_metrics: dict | None = None, max_records_per_file: int | None = None) -> int:
        """Publish ``keep`` plus ``df`` written as one new batch."""
        cur = self._commit_at(None)
        version = cur["version"] + 1
        pb = list(cur["partition_by"])
        batch, m = self._write_batch(df, version, pb, max_records_per_file)
        m.update(self._batch_metrics([batch]))
        m.update(extra_metrics or {})
        return self._publish(version, operation, keep + [batch], pb,
                             T.StructType.fromJson(json.loads(cur["schema_json"])), m, params)

    def batch_files(self, batch: str) -> list[str]:
        """Data files of a batch as entries ``b<version>/<relative path>`` (driver listing)."""
        jvm = self.spark.sparkContext._jvm
        conf = self.spark.sparkContext._jsc.hadoopConfiguration()
        p = jvm.org.apache.hadoop.fs.Path(self.batch_path(batch))
        it = p.getFileSystem(conf).listFiles(p, True)
        out = []
        while it.hasNext():
            path = it.next().getPath().toString()
            if path.endswith(".parquet"):
                out.append(batch + "/" + path.split(f"/batch={batch}/", 1)[1])
        return out

    def stats_columns(self, batch: str) -> list[str]:
        """Columns with stored statistics for ``batch`` (from the commit that wrote it)."""
        if "/" in batch:
            return []          # a single live file of a batch: stored rows cover dead files too
        try:
            c = self._commit_at(int(batch[1:].split("_")[0]))
        except ValueError:
            return []
        cols = (c["metrics"] or {}).get("statsColumns")
        return cols.split(",") if cols else []

    # -- writes --------------------------------------------------------------
    def _write_batch(self, df: DataFrame, version: int, partition_by: list[str],
                     max_records_per_file: int | None = None, laid_out: bool = False) -> tuple[str, dict]:
        # A name of its own for every attempt: what a dead writer left behind
        # is never in the way of the next one.
        batch = f"b{version:08d}_{uuid.uuid4().hex[:12]}"
        obs = Observation(f"w{version}")
        if partition_by and not laid_out:
            # Rebalance on the partition columns: each directory is written by
            # few tasks (not every task into every directory), and AQE splits
            # a hot directory's rows across tasks and merges tiny ones.
            df = df.hint("rebalance", *partition_by)
        w = df.observe(obs, F.count(F.lit(1)).alias("rows")).write.mode("errorifexists")
        if partition_by:
            w = w.partitionBy(*partition_by)
        if max_records_per_file:
            w = w.option("maxRecordsPerFile", int(max_records_per_file))
        w.parquet(self.batch_path(batch))
        rows = obs.get.get("rows", 0)
        return batch, {"numOutputRows": rows}

    def _batch_metrics(self, batches: list[str]) -> dict:
        """Files and bytes of batches, summed up by the file system (no data
        read, and no call for each file). Beside the data files the writer
        leaves an empty ``_SUCCESS`` at most."""
        jvm = self.spark.sparkContext._jvm
        conf = self.spark.sparkContext._jsc.hadoopConfiguration()
        n = size = 0
        for b in batches:
            p = jvm.org.apache.hadoop.fs.Path(self.batch_path(b))
            fs = p.getFileSystem(conf)
            held = fs.getContentSummary(p)
            n += held.getFileCount() - int(fs.exists(jvm.org.apache.hadoop.fs.Path(p, "_SUCCESS")))
            size += held.getLength()
        return {"numFiles": n, "numBytes": size}

    def overwrite(self, df: DataFrame, schema_mode: str | None = None, partition_by: list[str] | None = None,
                  operation: str = "WRITE", max_records_per_file: int | None = None,
                  params: dict | None = None) -> int:
        """Replace the table's contents with ``df`` as a new version.

        On an existing table the schema must match unless
        ``schema_mode='overwrite'`` (replace) or ``'merge'`` (add columns).
        """
        cs = self.commits()
        version = cs[-1]["version"] + 1 if cs else 0
        if cs and schema_mode != "overwrite":
            df, schema = conform(df, T.StructType.fromJson(json.loads(cs[-1]["schema_json"])), schema_mode)
        else:
            schema = df.schema
        if partition_by is None:
            partition_by = list(cs[-1]["partition_by"]) if cs and schema_mode != "overwrite" else []
        batch, m = self._write_batch(df, version, partition_by, max_records_per_file)
        m.update(self._batch_metrics([batch]))
        return self._publish(version, operation, [batch], partition_by, schema,
                             m, dict(params or {}, mode="Overwrite"))

    def append(self, df: DataFrame, schema_mode: str | None = None,
               max_records_per_file: int | None = None, params: dict | None = None,
               stats_cols: list[str] | None = None) -> int:
        """S3/V1/V2: add ``df`` as a new batch; the schema is checked first."""
        cs = self.commits()
        if not cs:
            return self.overwrite(df, operation="WRITE", max_records_per_file=max_records_per_file, params=params)
        cur = cs[-1]
        df, schema = conform(df, T.StructType.fromJson(json.loads(cur["schema_json"])), schema_mode)
        version = cur["version"] + 1
        batch, m = self._write_batch(df, version, list(cur["partition_by"]), max_records_per_file)
        if stats_cols:
            self._write_stats(batch, list(stats_cols), schema)
            m["statsColumns"] = ",".join(stats_cols)
        m.update(self._batch_metrics([batch]))
        return self._publish(version, "WRITE", list(cur["batches"]) + [batch], list(cur["partition_by"]),
                             schema, m, dict(params or {}, mode="Append"))

    def replace_batches(self, df: DataFrame, drop_batches: list[str], operation: str,
                        partition_by: list[str] | None = None, max_records_per_file: int | None = None,
                        params: dict | None = None, extra_metrics: dict | None = None,
                        stats_cols: list[str] | None = None, laid_out: bool = False) -> int:
        """Write ``df`` as one new batch that takes the place of ``drop_batches``
        (``laid_out``: in the partitions the caller gave it)."""
        cur = self._commit_at(None)
        version = cur["version"] + 1
        pb = list(cur["partition_by"]) if partition_by is None else partition_by
        keep = [b for b in cur["batches"] if entry_batch(b) not in set(drop_batches)]
        if pb != list(cur["partition_by"]) and keep:
            raise ValueError("a layout change must rewrite every batch")
        batch, m = self._write_batch(df, version, pb, max_records_per_file, laid_out)
        schema = T.StructType.fromJson(json.loads(cur["schema_json"]))
        if stats_cols:
            self._write_stats(batch, list(stats_cols), schema)
            m["statsColumns"] = ",".join(stats_cols)
        m.update(self._batch_metrics([batch]))
        m["numBatchesRemoved"] = len(drop_batches)
        m.update(extra_metrics or {})
        return self._publish(version, operation, keep + [batch], pb, schema, m, params)

    def merge(self, source: DataFrame, on: str | list[str], schema_mode: str | None = None,
              scope=None, when_newer: str | list[str] | None = None, when_older: str | list[str] | None = None,
              params: dict | None = None, check_unique: bool = True) -> int:
        """Upsert. Matched target rows are replaced by the source row,
        unmatched source rows are inserted; NULL keys never match.

        Only batches that contain a matched key are rewritten: a semi-join of
        the target's key columns with the source keys yields the touched
        files, which are joined with the source into a new batch. Untouched
        files stay in place. Several source rows with one key
        are refused, as in a SQL MERGE.

        ``scope`` (a predicate on target columns, e.g. the dates of the
        incoming rows) limits which target rows can match, so a partitioned
        target is pruned instead of scanned. ``when_newer`` names columns: a
        matched row is replaced only when the source's are greater, compared
        in that order (late, older source rows leave the target as is);
        ``when_older`` replaces only when they are smaller (keep the earliest).
        """
        keys = [on] if isinstance(on, str) else list(on)
        cur = self._commit_at(None)
        schema = T.StructType.fromJson(json.loads(cur["schema_json"]))
        src, merged_schema = conform(source, schema, schema_mode)
        missing = [c for c in merged_schema.fieldNames() if c not in src.columns]
        src = src.select(*src.columns, *[F.lit(None).cast(merged_schema[c].dataType).alias(c) for c in missing])
        # Read several times below, so evaluated once: what picks the files is
        # what is merged, also if the source isn't deterministic.
        checkpoint_root(self.spark)
        src = src.checkpoint()
        nonnull = reduce(lambda x, y: x & y, [F.col(k).isNotNull() for k in keys])
        # NULL keys never match, so only non-NULL keys can conflict.
        dup = (src.where(nonnull).groupBy(*keys).count().where("count > 1").limit(1).collect()
               if check_unique else [])
        if dup:
            raise MergeConflict(f"several source rows share the key {dup[0].asDict()}")
        candidates = self._key_range_candidates(cur["batches"], src.where(nonnull), keys)
        target = self._read_batches(candidates, schema, with_file=True)
        scope_col = None
        if scope is not None:
            scope_col = F.expr(scope) if isinstance(scope, str) else scope
            target = target.where(scope_col)
        # Files holding a matched key: at most one row per file reaches the driver.
        touched_files = self.files_where(target.join(src.where(nonnull).select(*keys), keys, "left_semi"))
        keep, touched = self.split_live(cur["batches"], touched_files)
        old = self._read_batches(touched, schema)
        for c in merged_schema.fieldNames():
            if c not in old.columns:
                old = old.withColumn(c, F.lit(None).cast(merged_schema[c].dataType))
        # Rows that can't match (a NULL key, outside the scope) are copied past
        # the join. The source's keys are unique, so a left outer join keeps
        # the others as they are and AQE can split a hot key or broadcast a
        # small source; a full outer join would allow neither.
        fits = nonnull if scope_col is None else nonnull & F.coalesce(scope_col, F.lit(False))
        s = src.where(nonnull).withColumn("_s", F.lit(True)).alias("s")
        j = old.where(fits).alias("t").join(s, [F.col(f"t.{k}") == F.col(f"s.{k}") for k in keys], "left")
        take_src = F.col("s._s").isNotNull()
        order = lambda side, cols: F.struct(*[F.col(f"{side}.{c}") for c in ([cols] if isinstance(cols, str) else cols)])
        if when_newer:
            take_src = take_src & (order("s", when_newer) > order("t", when_newer))
        if when_older:
            take_src = take_src & (order("s", when_older) < order("t", when_older))
        names = merged_schema.fieldNames()
        flags = lambda m, i: (F.lit(m).alias("_m"), F.lit(i).alias("_i"))
        out = j.select(*[F.when(take_src, F.col(f"s.{c}")).otherwise(F.col(f"t.{c}")).alias(c) for c in names],
                       F.coalesce(take_src, F.lit(False)).alias("_m"), F.lit(False).alias("_i"))
        out = out.unionByName(old.where(~fits).select(*names, *flags(False, False)))
        out = out.unionByName(src.join(old.where(fits).select(*keys), keys, "left_anti").select(*names, *flags(False, True)))
        obs = Observation(f"merge{cur['version'] + 1}")
        out = out.observe(obs, F.sum(F.col("_m").cast("long")).alias("updated"),
                          F.sum(F.col("_i").cast("long")).alias("inserted"),
                          F.sum((~F.col("_m") & ~F.col("_i")).cast("long")).alias("copied"))
        out = out.drop("_m", "_i")
        version = cur["version"] + 1
        batch, m = self._write_batch(out, version, list(cur["partition_by"]))
        res = obs.get
        m.update(self._batch_metrics([batch]))
        m.update({"numTargetRowsUpdated": res.get("updated") or 0,
                  "numTargetRowsInserted": res.get("inserted") or 0,
                  "numTargetRowsCopied": res.get("copied") or 0,
                  "numTargetFilesRewritten": len(touched),
                  "numTargetEntriesScanned": len(candidates)})
        return self._publish(version, "MERGE", keep + [batch], list(cur["partition_by"]), merged_schema, m,
                             dict(params or {}, predicate=" AND ".join(f"t.{k} = s.{k}" for k in keys)))

    def restore(self, version: int) -> int:
        """V7: make ``version`` current again as a *new* version; history is kept."""
        old = self._commit_at(version)
        cur = self._commit_at(None)
        return self._publish(cur["version"] + 1, "RESTORE", list(old["batches"]), list(old["partition_by"]),
                             T.StructType.fromJson(json.loads(old["schema_json"])),
                             {"restoredVersion": version}, {"version": version})

    def delete_where(self, condition, operation: str = "DELETE") -> int:
        """Remove rows matching ``condition``: only files holding such rows are rewritten."""
        cur = self._commit_at(None)
        schema = T.StructType.fromJson(json.loads(cur["schema_json"]))
        cond = F.expr(condition) if isinstance(condition, str) else condition
        tgt = self._read_batches(cur["batches"], schema, with_file=True)
        keep, touched = self.split_live(cur["batches"], self.files_where(tgt.where(cond)))
        if not touched:
            return cur["version"]
        kept = self._read_batches(touched, schema).where(~F.coalesce(cond, F.lit(False)))
        return self.replace_entries(kept, keep, operation, params={"predicate": str(condition)},
                                    extra_metrics={"numFilesRewritten": len(touched)})

    # -- metadata views -----------------------------------------------------
    def history(self) -> DataFrame:
        """V4: version, timestamp, operation, metrics, parameters; newest first."""
        return (self._commit_frame([c["version"] for c in self.commits()])
                .select("version", F.col("ts").alias("timestamp"), "operation",
                        F.col("metrics").alias("operationMetrics"),
                        F.col("params").alias("operationParameters"))
                .orderBy(F.col("version").desc()))

    def detail(self, version: int | None = None) -> DataFrame:
        """V9: file count and bytes of a version (files listed, not read)."""
        c = self._commit_at(version)
        f = self.files(c["version"])
        return f.agg(F.lit(self.root).alias("location"), F.lit(c["version"]).alias("version"),
                     F.count(F.lit(1)).alias("numFiles"),
                     F.coalesce(F.sum("size_bytes"), F.lit(0)).cast("long").alias("sizeInBytes"),
                     F.lit(len(c["batches"])).alias("numBatches"),
                     F.array(*[F.lit(p) for p in c["partition_by"]]).cast("array<string>").alias("partitionColumns"))

    def changes(self, start: int, end: int, key: str | list[str] | None = None) -> DataFrame:
        """Rows that differ between two versions, with ``_change_type``.

        Batches live in both versions hold the same rows in both, so they
        cancel: only batches unique to either side are read. Without a key,
        rows are ``delete`` / ``insert`` (bag difference).
        With a key, a removed row whose key also gained a row is an
        ``update_preimage`` and the gained row an ``update_postimage``;
        this is decided per key from counts, never by pairing rows.
        """
        a, b = self._commit_at(start), self._commit_at(end)
        sa, sb = (T.StructType.fromJson(json.loads(x["schema_json"])) for x in (a, b))
        cols = sb.fieldNames() + [c for c in sa.fieldNames() if c not in sb.fieldNames()]

        def expand(entries, other):
            # A batch kept whole on one side and split into files on the other
            # is compared file by file, so its untouched files cancel too.
            split = {entry_batch(e) for e in other if "/" in e}
            out = []
            for e in entries:
                out.extend(self.batch_files(e) if "/" not in e and e in split else [e])
            return out

        ea, eb = expand(a["batches"], b["batches"]), expand(b["batches"], a["batches"])
        shared = set(ea) & set(eb)

        def side(entries, s):
            df = self._read_batches([x for x in entries if x not in shared], s)
            for name in cols:
                if name not in df.columns:
                    df = df.withColumn(name, F.lit(None).cast((sb if name in sb.fieldNames() else sa)[name].dataType))
            return df.select(*cols)

        # +1 for a row gained, -1 for a row lost, summed over equal rows. Two
        # 64-bit digests stand for a row, so wide rows are not shuffled to be
        # found unchanged; rows that differ are fetched by their digests.
        both = side(eb, sb).withColumn("_n", F.lit(1)).unionByName(side(ea, sa).withColumn("_n", F.lit(-1)))
        both = both.select("*", *(row_digest(both.drop("_n"), i).alias(f"_d{i}") for i in (1, 2)))
        checkpoint_root(self.spark)
        differ = both.groupBy("_d1", "_d2").agg(F.sum("_n").alias("_n")).where("_n <> 0").checkpoint()
        found = both.drop("_n").join(differ, ["_d1", "_d2"]).dropDuplicates(["_d1", "_d2"])
        net = found.drop("_d1", "_d2")
        kind = F.when(F.col("_n") > 0, "insert").otherwise("delete")
        if key is not None:
            keys = [key] if isinstance(key, str) else list(key)
            per = net.groupBy(*keys).agg((F.max("_n") > 0).alias("_up"), (F.min("_n") < 0).alias("_down"))
            # NULL keys find no partner, so their rows stay plain inserts and deletes
            net = net.join(per.where("_up AND _down").select(*keys, F.lit(True).alias("_both")), keys, "left")
            kind = F.when(F.col("_both"), F.when(F.col("_n") > 0, "update_postimage").otherwise("update_preimage")).otherwise(kind)
        return net.select(*cols, kind.alias("_change_type"), F.explode(F.array_repeat(F.lit(0), F.abs("_n").cast("int"))).alias("_k")).drop("_k")


def table_path(root: str, layer: str, name: str) -> str:
    """``root/layer/name`` (layers: bronze, silver, gold, scratch)."""
    return f"{root.rstrip('/')}/{layer}/{name}"


def reset(table: VersionedTable, schema: T.StructType | None = None) -> int | None:
    """Idempotent reset = an empty overwrite commit (history is kept)."""
    if not table.exists():
        return None
    schema = schema or table.schema()
    return table.overwrite(table.spark.createDataFrame([], schema), schema_mode="overwrite", operation="RESET")


__all__ = ["VersionedTable", "SchemaMismatch", "MergeConflict", "conform", "table_path", "reset"]
