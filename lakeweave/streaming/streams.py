"""Streaming Bronze -> Silver -> windowed Gold (ST1-ST6).

Sources are ``readStream`` (a file source here; a Kafka source is the same
code with ``format("kafka")``). Sinks go through ``foreachBatch`` into
versioned tables; each commit records the query's id and the micro-batch id,
so a replayed micro-batch (after a driver restart) is recognised and skipped:
the sink is idempotent and the query is exactly-once end to end. A query with
a checkpoint of its own counts its micro-batches apart. Streaming state lives in
the checkpoint under the shared folder, so a lost executor or driver resumes.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from lakeweave.functions import sketches
from lakeweave.functions.pricing import cost_usd, price_maps
from lakeweave.operators.layout import compact
from lakeweave.plans.medallion import SILVER_ORDER, build_silver, quarantine as build_quarantine
from lakeweave.session import checkpoint_root, shared_dir
from lakeweave.sources.tables import VersionedTable
from lakeweave.streaming import key_filters

BRONZE_SCHEMA = T.StructType([
    T.StructField("request_id", T.StringType()),
    T.StructField("ts", T.TimestampNTZType()),
    T.StructField("raw_json", T.StringType()),
])

#: Rows of a landed file, about, and different keys that it holds at least, about.
ROWS_PER_FILE, KEYS_PER_FILE = 250_000, 100


def write_time_ordered_files(df: DataFrame, path: str, n_chunks: int, ts: str = "ts", key: str | None = None,
                             rows_per_file: int = ROWS_PER_FILE) -> int:
    """Land ``df`` as ``n_chunks`` appends covering consecutive time ranges,
    oldest first (the file source orders files by modification time), like a
    landing zone filled over time. Chunk bounds come from ``approxQuantile``.
    With ``key`` a chunk of over ``rows_per_file`` rows is several files, each
    written by a task, with all of a key's rows of the chunk in one. Returns
    the files of a chunk: read it back with that ``maxFilesPerTrigger``."""
    micros = F.unix_micros(F.col(ts).cast("timestamp"))
    # Computed once and written to the shared folder: the quantile pass and
    # every chunk read back the columns and row groups that they need.
    rows = shared_dir(df.sparkSession, "landing_rows")
    df.withColumn("_us", micros).write.parquet(rows)
    keyed = df.sparkSession.read.parquet(rows)
    # A relative error keeps the quantile summary bounded; chunks are about even.
    bounds = sorted({int(b) for b in keyed.approxQuantile("_us", [i / n_chunks for i in range(1, n_chunks)], 0.001)})
    edges = [None, *bounds, None]
    files = 1
    if key:
        at = reduce(lambda a, b: a + b, [F.when(F.col("_us") >= b, 1).otherwise(0) for b in bounds], F.lit(0))
        per = keyed.groupBy(at.alias("at")).agg(F.count(F.lit(1)).alias("n"), F.approx_count_distinct(key).alias("keys"))
        most, least = per.agg(F.max("n"), F.min("keys")).first()
        # many keys to a file: none of a chunk's files stays empty and so unwritten
        files = max(1, min(-(-(most or 0) // rows_per_file), (least or 0) // KEYS_PER_FILE))
    for lo, hi in zip(edges[:-1], edges[1:]):
        cond = F.lit(True)
        if lo is not None:
            cond = cond & (F.col("_us") >= F.lit(lo))
        if hi is not None:
            cond = cond & (F.col("_us") < F.lit(hi))
        if lo is None:  # rows without a time land first
            cond = cond | F.col("_us").isNull()
        chunk = keyed.where(cond)
        chunk = (chunk.repartition(files, key) if files > 1 else chunk.repartition(1)).sortWithinPartitions("_us")
        chunk.drop("_us").write.mode("append").parquet(path)
    return files


def bronze_stream(spark: SparkSession, path: str, files_per_trigger: int = 1,
                  schema: T.StructType = BRONZE_SCHEMA) -> DataFrame:
    """Bronze rows as a stream (file source; schema declared, not inferred)."""
    return (spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger)
            .parquet(path))


def kafka_bronze_stream(spark: SparkSession, servers: str, topic: str, **options) -> DataFrame:
    """Bronze rows from a Kafka topic keyed by request_id (message key =
    request_id, value = raw JSON, Kafka timestamp = ``ts``). Needs the Kafka
    connector on the classpath; no broker is available in the tests."""
    r = (spark.readStream.format("kafka").option("kafka.bootstrap.servers", servers)
         .option("subscribe", topic).options(**options).load())
    return r.select(F.col("key").cast("string").alias("request_id"),
                    F.col("timestamp").cast("timestamp_ntz").alias("ts"),
                    F.col("value").cast("string").alias("raw_json"))


def _epoch_ntz() -> Column:
    return F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")


def ntz_to_instant(c: Column) -> Column:
    """TIMESTAMP_NTZ wall time read as UTC -> TIMESTAMP, whatever the session zone."""
    return F.timestamp_micros(F.timestamp_diff("MICROSECOND", _epoch_ntz(), c))


def instant_to_ntz(c: Column) -> Column:
    """TIMESTAMP -> its UTC wall time as TIMESTAMP_NTZ, whatever the session zone."""
    return F.timestamp_add("MICROSECOND", F.unix_micros(c), _epoch_ntz())


def _event_time(df: DataFrame, ts: str = "ts") -> DataFrame:
    """Watermarks need TIMESTAMP; the NTZ column stays for output."""
    return df.withColumn("_et", ntz_to_instant(F.col(ts)))


def running_query(batch: DataFrame) -> str:
    """Id of the streaming query whose ``foreachBatch`` this runs in (it is
    kept in the checkpoint, so a restart has the same id); else empty."""
    return batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId") or ""


def last_batch_id(table: VersionedTable, query_id: str) -> int:
    """Highest micro-batch id that query committed to ``table`` (-1 if none)."""
    ids = [int(c["params"]["streamBatchId"]) for c in table.commits()
           if c["params"] and "streamBatchId" in c["params"] and c["params"].get("streamQueryId", "") == query_id]
    return max(ids) if ids else -1


def idempotent(table: VersionedTable, write: Callable[[DataFrame, dict], None]):
    """ST4: a ``foreachBatch`` function that skips micro-batches its query
    already committed. Batch ids count from 0 in every checkpoint, so they
    tell micro-batches apart only together with the query's id; ``write``
    gets both as commit parameters. ``query_id`` is for replays outside a
    running query."""
    def run(batch: DataFrame, batch_id: int, query_id: str | None = None) -> None:
        query_id = running_query(batch) if query_id is None else query_id
        if batch_id <= last_batch_id(table, query_id):
            return
        # The sink reads the micro-batch more than once (checks, joins, write):
        # keep it for the duration of this call instead of re-running the
        # micro-batch plan (and its state reads) each time.
        batch = batch.persist()
        try:
            if not batch.isEmpty():
                write(batch, {"streamBatchId": batch_id, "streamQueryId": query_id})
        finally:
            batch.unpersist()
    return run


def silver_sink(silver: VersionedTable, late_days: int | None = None, filters: bool = True):
    """ST1 sink: each micro-batch is parsed, validated and deduplicated, then
    merged into Silver keeping per request_id the row that the batch build
    would keep (earliest ``ts``, ties by the other columns). A repeat may come
    at any distance. With ``filters``, each write leaves Bloom filters of its
    request_ids by date, and only dates that may hold one of the batch's are
    searched; without, or where an older write left none, all of Silver is (its
    request_id column). Where the source bounds how far apart repeats are,
    ``late_days`` limits the search to the dates around the batch's."""
    def write(batch: DataFrame, params: dict) -> None:
        s = build_silver(batch)
        if filters:
            # read for the filters, the dates and the merge
            checkpoint_root(s.sparkSession)
            s = s.checkpoint()
        dates = key_filters.may_hold(silver, s, "request_id") if filters and silver.exists() else None
        if filters:
            params = {**params, "keyFilter": key_filters.write(silver, s, "date", "request_id")}
        if not silver.exists():
            silver.overwrite(s, partition_by=["date"], params=params)
            return
        scope = None
        if dates is not None:
            params["datesSearched"] = len(dates)
            # rows without a date are in no filter
            scope = F.col("date").isin([F.lit(d) for d in dates]) | F.col("date").isNull() if dates else F.col("date").isNull()
        elif late_days is not None:
            lo, hi = s.agg(F.min("date"), F.max("date")).collect()[0]
            if lo is not None:
                scope = f"date BETWEEN date_sub(DATE'{lo}', {late_days}) AND date_add(DATE'{hi}', {late_days})"
        silver.merge(s, "request_id", scope=scope, when_older=SILVER_ORDER, params=params)
    return idempotent(silver, write)


def quarantine_sink(rejects: VersionedTable):
    """S15 sink: each micro-batch's rejected rows, appended in directories by
    reason."""
    def write(batch: DataFrame, params: dict) -> None:
        q = build_quarantine(batch)
        if rejects.exists():
            rejects.append(q, params=params)
        else:
            rejects.overwrite(q, partition_by=["reason"], params=params)
    return idempotent(rejects, write)


def stream_silver(bronze: DataFrame, silver: VersionedTable, checkpoint: str, trigger: dict | None = None):
    """ST1: start the Bronze stream -> Silver table query."""
    w = bronze.writeStream.foreachBatch(silver_sink(silver)).option("checkpointLocation", checkpoint)
    return w.trigger(**(trigger or {"availableNow": True})).start()


def window_metrics(stream: DataFrame, duration: str = "5 minutes", delay: str = "10 minutes",
                   prices: dict | None = None, digits: int = 6, exact: bool = False) -> DataFrame:
    """ST2: tumbling-window metrics per model (calls, errors, tokens, p50/p95
    latency, cost) over a Silver-shaped stream, with a watermark. Run it in
    update mode into :func:`upsert_sink`: every trigger emits the windows it
    changed, the sink keeps the latest value per window. The state of a window
    holds a sketch of its latencies, of bounded size and exact for short windows
    (see ``sketches``); ``exact`` keeps a count of every latency instead."""
    c_in, c_out = price_maps(prices)
    s = _event_time(stream).withWatermark("_et", delay)
    agg = s.groupBy(F.window("_et", duration).alias("w"), "model").agg(
        F.count(F.lit(1)).alias("calls"),
        F.sum(F.when(F.col("status") != "ok", 1).otherwise(0)).cast("long").alias("errors"),
        F.sum("prompt_tokens").alias("prompt_tokens"),
        F.sum("completion_tokens").alias("completion_tokens"),
        (F.percentile("latency_ms", F.array(F.lit(0.5), F.lit(0.95))) if exact else sketches.sketch("latency_ms")).alias("_q"))
    p50, p95 = F.col("_q")[0], F.col("_q")[1]
    if not exact:
        agg = agg.withColumn("_n", F.kll_sketch_get_n_bigint("_q")).withColumn("_q", sketches.grid(F.col("_q")))
        p50, p95 = (sketches.quantile(F.col("_q"), F.col("_n"), q) for q in (0.5, 0.95))
    return agg.select(
        instant_to_ntz(F.col("w.start")).alias("window_start"), "model", "calls", "errors",
        "prompt_tokens", "completion_tokens",
        F.round(p50, digits).alias("p50_latency_ms"),
        F.round(p95, digits).alias("p95_latency_ms"),
        F.round(cost_usd(F.col("prompt_tokens"), F.col("completion_tokens"),
                         c_in[F.col("model")], c_out[F.col("model")]), digits).alias("cost_usd"))


def stream_dedup(stream: DataFrame, key: str | list[str], delay: str = "10 minutes") -> DataFrame:
    """ST3: drop repeats of ``key`` seen within the watermark delay; the state
    is bounded by the delay, not by the stream's history."""
    keys = [key] if isinstance(key, str) else list(key)
    return _event_time(stream).withWatermark("_et", delay).dropDuplicatesWithinWatermark(keys).drop("_et")


def upsert_sink(table: VersionedTable, key: list[str], partition_by: list[str] | None = None,
                keys_unique: bool = False):
    """ST4: ``foreachBatch`` sink that upserts each micro-batch on ``key``;
    replays of a committed micro-batch are skipped. ``keys_unique=True``
    (e.g. the output of a streaming aggregation on ``key``) skips the
    duplicate-key check."""
    def write(batch: DataFrame, params: dict) -> None:
        if not table.exists():
            table.overwrite(batch, partition_by=partition_by or [], params=params)
            return
        scope = None
        # Partition columns that are part of the key: rows can only match in
        # the directories of the batch's own values.
        if partition_by and set(partition_by) <= set(key):
            lo_hi = batch.agg(*[f(c).alias(f"{f.__name__}_{c}") for c in partition_by for f in (F.min, F.max)]).collect()[0]
            if all(v is not None for v in lo_hi):
                scope = reduce(lambda a, b: a & b, [F.col(c).between(F.lit(lo_hi[f"min_{c}"]), F.lit(lo_hi[f"max_{c}"])) for c in partition_by])
        table.merge(batch, key, scope=scope, params=params, check_unique=not keys_unique)
    return idempotent(table, write)


def append_sink(table: VersionedTable, compact_every: int | None = None, target_bytes: int | None = None):
    """ST4/ST5: append each micro-batch once; compact every ``compact_every`` batches."""
    def write(batch: DataFrame, params: dict) -> None:
        batch_id = params["streamBatchId"]
        if not table.exists():
            table.overwrite(batch, params=params)
        else:
            table.append(batch, params=params)
        if compact_every and (batch_id + 1) % compact_every == 0:
            if target_bytes:
                compact(table, target_bytes)
            else:
                compact(table)
    return idempotent(table, write)


def merge_latest(table: VersionedTable, src: DataFrame, key: str | list[str], order: list[str],
                 params: dict | None = None) -> int:
    """ST6: late rows update a key only if they are newer.

    The newest source row per key is an aggregate (``max`` of a struct led by
    ``order``), combined map-side, so a hot key never gathers in one task.
    The table carries the ordering struct in ``_order`` and the merge
    replaces a row only when the incoming ``_order`` is greater.
    """
    keys = [key] if isinstance(key, str) else list(key)
    rest = [c for c in src.columns if c not in keys]
    latest = (src.groupBy(*keys).agg(F.max(F.struct(F.struct(*order).alias("_order"), *rest)).alias("_m"))
              .select(*keys, *[F.col(f"_m.{c}").alias(c) for c in rest], F.col("_m._order").alias("_order")))
    if not table.exists():
        return table.overwrite(latest, params=params)
    return table.merge(latest, keys, when_newer="_order", params=params)


def run_to_end(query) -> None:
    """Wait for an ``availableNow`` query; surface its failure."""
    query.awaitTermination()
    if query.exception() is not None:
        raise RuntimeError(str(query.exception()))
