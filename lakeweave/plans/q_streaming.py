"""Registered streaming queries (ST1-ST6): each runs a Structured Streaming
query to the end (``availableNow``) over files landed from the driver's
tables and returns the batch read of its sink, which must equal the batch
answer."""

from __future__ import annotations

from pyspark.sql import functions as F

from lakeweave.functions.pricing import DEFAULT_PRICES
from lakeweave.plans import medallion as M
from lakeweave.plans.catalog import register, table
from lakeweave.plans.q_medallion import SQL_BRONZE, _bronze, _prices_sql
from lakeweave.session import shared_dir
from lakeweave.sources.tables import VersionedTable
from lakeweave.streaming import streams as S

# Landing parameters: Bronze arrives in 6 time-ordered chunks, one per
# micro-batch; watermark delay 10 minutes (retries arrive within seconds).
N_CHUNKS = 6
DELAY = "10 minutes"
_BUILT: dict = {}


def _landing(spark, sf, what: str):
    """(path, files of a micro-batch)"""
    key = (spark.sparkContext.applicationId, sf, what)
    if key not in _BUILT:
        path = shared_dir(spark, f"landing_{what}")
        b = _bronze(spark, sf)
        _BUILT[key] = path, S.write_time_ordered_files(b if what == "bronze" else M.build_silver(b), path, N_CHUNKS, key="request_id")
    return _BUILT[key]


def _silver_via_stream(spark, sf):
    key = (spark.sparkContext.applicationId, sf, "stream_silver")
    if key not in _BUILT:
        src = S.bronze_stream(spark, *_landing(spark, sf, "bronze"))
        silver = VersionedTable(spark, shared_dir(spark, "stream_silver"))
        S.run_to_end(S.stream_silver(src, silver, shared_dir(spark, "ckpt_silver")))
        _BUILT[key] = silver
    return _BUILT[key]


@register("stream_silver", f"WITH {SQL_BRONZE.strip()}\nSELECT * FROM silver")
def q_stream_silver(spark, sf):
    """ST1: Bronze stream -> Silver via foreachBatch merge; equals batch Silver."""
    return _silver_via_stream(spark, sf).read().select(*M.SILVER_COLUMNS)


@register("stream_replay", f"WITH {SQL_BRONZE.strip()}\nSELECT * FROM silver")
def q_stream_replay(spark, sf):
    """ST4: replaying already-committed micro-batches changes nothing."""
    silver = _silver_via_stream(spark, sf)
    before = silver.latest_version()
    sink = S.silver_sink(silver)
    # Replay micro-batches 0 and 1 of the same query (here fed the whole
    # Bronze: any content must be ignored for a micro-batch it committed).
    query_id = silver.commit_info(0)["params"]["streamQueryId"]
    sink(_bronze(spark, sf), 0, query_id)
    sink(_bronze(spark, sf), 1, query_id)
    if silver.latest_version() != before:
        raise AssertionError("a replayed micro-batch was committed twice")
    return silver.read().select(*M.SILVER_COLUMNS)


@register("stream_window_5m", f"""WITH {SQL_BRONZE.strip()},
{_prices_sql(DEFAULT_PRICES)}
SELECT time_bucket(INTERVAL 5 MINUTE, s.ts) AS window_start, s.model, count(*) AS calls,
       CAST(sum(CASE WHEN s.status <> 'ok' THEN 1 ELSE 0 END) AS BIGINT) AS errors,
       CAST(sum(s.prompt_tokens) AS BIGINT) AS prompt_tokens,
       CAST(sum(s.completion_tokens) AS BIGINT) AS completion_tokens,
       round(quantile_cont(s.latency_ms, 0.5), 6) AS p50_latency_ms,
       round(quantile_cont(s.latency_ms, 0.95), 6) AS p95_latency_ms,
       round(CAST(sum(s.prompt_tokens) AS BIGINT) * p.c_in / 1000000.0
             + CAST(sum(s.completion_tokens) AS BIGINT) * p.c_out / 1000000.0, 6) AS cost_usd
FROM silver s LEFT JOIN prices p USING (model)
GROUP BY 1, 2, p.c_in, p.c_out""")
def q_stream_window(spark, sf):
    """ST2: 5-minute tumbling windows with a watermark, update mode, upserted per trigger."""
    schema = M.build_silver(_bronze(spark, sf)).schema
    path, files = _landing(spark, sf, "silver")
    src = (spark.readStream.schema(schema).option("maxFilesPerTrigger", files)
           .parquet(path).select(*M.SILVER_COLUMNS))
    out = VersionedTable(spark, shared_dir(spark, "stream_windows"))
    windows = S.window_metrics(src, "5 minutes", DELAY).withColumn("window_date", F.to_date("window_start"))
    q = (windows.writeStream.outputMode("update")
         .foreachBatch(S.upsert_sink(out, ["window_date", "window_start", "model"], ["window_date"], keys_unique=True))
         .option("checkpointLocation", shared_dir(spark, "ckpt_windows"))
         .trigger(availableNow=True).start())
    S.run_to_end(q)
    return out.read().drop("window_date")


@register("silver_quarantine_sink", f"WITH {SQL_BRONZE.strip()}\nSELECT request_id, ts, reason FROM classified WHERE reason IS NOT NULL")
def q_quarantine_sink(spark, sf):
    """Rejected rows of the Bronze stream, landed in directories by reason."""
    out = VersionedTable(spark, shared_dir(spark, "stream_rejects"))
    q = (S.bronze_stream(spark, *_landing(spark, sf, "bronze")).writeStream.foreachBatch(S.quarantine_sink(out))
         .option("checkpointLocation", shared_dir(spark, "ckpt_rejects")).trigger(availableNow=True).start())
    S.run_to_end(q)
    return out.read().select("request_id", "ts", "reason")


@register("stream_two_checkpoints", f"WITH {SQL_BRONZE.strip()}\nSELECT request_id, ts FROM bronze UNION ALL SELECT request_id, ts FROM bronze")
def q_two_checkpoints(spark, sf):
    """ST4: a second query with a checkpoint of its own appends all its rows:
    its micro-batch ids start at 0 again."""
    out = VersionedTable(spark, shared_dir(spark, "stream_twice"))
    for n in range(2):
        q = (S.bronze_stream(spark, *_landing(spark, sf, "bronze")).writeStream.foreachBatch(S.append_sink(out))
             .option("checkpointLocation", shared_dir(spark, f"ckpt_twice{n}")).trigger(availableNow=True).start())
        S.run_to_end(q)
    return out.read().select("request_id", "ts")


@register("stream_dedup", f"""WITH {SQL_BRONZE.strip()}
SELECT request_id, min(ts) AS ts, arg_min(raw_json IS NULL, ts) AS no_payload FROM bronze GROUP BY request_id""")
def q_stream_dedup(spark, sf):
    """ST3: stateful dedup on request_id within the watermark. The landing's
    files are in the order of time, so the row kept is a request's earliest."""
    src = S.bronze_stream(spark, *_landing(spark, sf, "bronze"))
    out = VersionedTable(spark, shared_dir(spark, "stream_dedup"))
    q = (S.stream_dedup(src, "request_id", DELAY).writeStream.foreachBatch(S.append_sink(out))
         .option("checkpointLocation", shared_dir(spark, "ckpt_dedup")).trigger(availableNow=True).start())
    S.run_to_end(q)
    return out.read().select("request_id", "ts", F.col("raw_json").isNull().alias("no_payload"))


@register("stream_compacted", f"WITH {SQL_BRONZE.strip()}\nSELECT request_id, ts, raw_json IS NULL AS no_payload FROM bronze")
def q_stream_compacted(spark, sf):
    """ST5: micro-batches appended, then compacted every 3 batches; rows preserved."""
    src = S.bronze_stream(spark, *_landing(spark, sf, "bronze"))
    out = VersionedTable(spark, shared_dir(spark, "stream_raw"))
    q = (src.writeStream.foreachBatch(S.append_sink(out, compact_every=3))
         .option("checkpointLocation", shared_dir(spark, "ckpt_raw")).trigger(availableNow=True).start())
    S.run_to_end(q)
    done = [c for c in out.commits() if c["operation"] == "OPTIMIZE"]
    if not done or any(int(c["metrics"]["numFiles"]) >= int(c["metrics"]["numFilesRemoved"]) for c in done):
        raise AssertionError("the sink was not compacted into fewer files")
    return out.read().select("request_id", "ts", F.col("raw_json").isNull().alias("no_payload"))


@register("late_latest", """SELECT o_custkey, o_orderkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority
FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS rn
      FROM orders) WHERE rn = 1""")
def q_late_latest(spark, sf):
    """ST6: order changes arrive in two batches (the second holds older rows
    too); a key is updated only by a newer row."""
    o = table(spark, sf, "orders")
    t = VersionedTable(spark, shared_dir(spark, "latest_order"))
    first = F.coalesce(F.col("o_orderpriority").isin("1-URGENT", "2-HIGH"), F.lit(False))
    order = ["o_orderdate", "o_orderkey"]
    S.merge_latest(t, o.where(first), "o_custkey", order)
    S.merge_latest(t, o.where(~first), "o_custkey", order)
    return t.read().drop("_order")
