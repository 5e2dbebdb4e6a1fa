"""Bronze landing (M1) and synthetic Bronze.

Bronze rows are ``request_id string, ts timestamp, raw_json string``, stored
untouched. Two producers exist:

* :func:`bronze_from_events` derives a Bronze table from the driver's
  ``events`` table in one scan: every event yields its call, some yield a
  retry (same ``request_id``, later) and some a bad copy (same
  ``request_id``, one second *earlier*, so "filter first, then dedup" is
  exercised).
* :func:`synth_bronze` generates a Bronze table from ``spark.range`` with the
  reference generator's distributions, entirely on executors.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from lakeweave.functions.payload import record_to_json

# Fixed values of the fixture derived from `events`:
#   one event in RETRY_EVERY gets a retry 3 s later (about the reference's 5%);
#   event_id % BAD_EVERY in BAD_KINDS gets one bad copy 1 s earlier.
RETRY_EVERY = 20
RETRY_DELAY_S = 3
RETRY_EXTRA_LATENCY_MS = 1000
BAD_EVERY = 50
BAD_KINDS = {7: "malformed_json", 17: "missing_model", 27: "type_mismatch", 37: "null_payload"}
N_MODELS = 3


def _payload(model: Column, user: Column, k: Column, latency: Column, status: Column) -> Column:
    return record_to_json(model.alias("model"), user.alias("user_id"),
                          F.struct(k.alias("input"), (k * 2).alias("output")).alias("usage"),
                          latency.alias("latency_ms"), status.alias("status"))


def bronze_from_events(events: DataFrame) -> DataFrame:
    """Bronze rows derived from ``events`` (one scan, one generator, no union)."""
    # taken out of the event once, not in every record that uses it
    events = events.select(
        F.col("event_id").alias("eid"), F.concat(F.lit("req-"), F.col("event_id").cast("string")).alias("rid"), "ts",
        F.concat(F.lit("m"), (F.col("user_id") % N_MODELS).cast("string")).alias("model"),
        F.concat(F.lit("u_"), F.col("user_id").cast("string")).alias("user"),
        F.get_json_object("props", "$.k").try_cast("int").alias("k"), F.floor(F.col("value") * 10).cast("int").alias("latency"),
        F.when(F.col("event_type") == "error", F.lit("error")).otherwise(F.lit("ok")).alias("status"))
    eid, rid, ts, model, user, k, latency, status = (F.col(c) for c in events.columns)

    call = F.struct(rid.alias("request_id"), ts.alias("ts"),
                    _payload(model, user, k, latency, status).alias("raw_json"))
    retry = F.when(eid % RETRY_EVERY == 0, F.struct(
        rid.alias("request_id"), (ts + F.expr(f"INTERVAL {RETRY_DELAY_S} SECONDS")).alias("ts"),
        _payload(model, user, k, latency + RETRY_EXTRA_LATENCY_MS, F.lit("rate_limited")).alias("raw_json")))
    res = eid % BAD_EVERY
    bad_text = (F.when(res == 7, F.concat(F.lit('{"model": "'), model, F.lit('", "usage": {')))
                .when(res == 17, record_to_json(user.alias("user_id"), status.alias("status")))
                .when(res == 27, record_to_json(model.alias("model"), F.struct(
                    k.alias("input"), F.struct(k.alias("n")).alias("output")).alias("usage"))))
    bad = F.when(res.isin(*BAD_KINDS), F.struct(
        rid.alias("request_id"), (ts - F.expr("INTERVAL 1 SECONDS")).alias("ts"),
        bad_text.alias("raw_json")))
    rows = F.filter(F.array(call, retry, bad), lambda r: r.isNotNull())
    return events.select(F.inline(rows))


# Fixed values of the synthetic generator (the reference generator's mix):
# model weights 6:3:1, status weights 95:3:2, latency profile (base, jitter) ms,
# ~5% retries that reuse an id from the previous 1024 rows, 7 UTC days.
SYNTH_MODELS = [("m1", 6, 1100, 350), ("m0", 3, 450, 150), ("m2", 1, 2400, 700)]
SYNTH_STATUS = [("ok", 95), ("rate_limited", 3), ("error", 2)]
SYNTH_DUP_RATE = 0.05
SYNTH_DUP_WINDOW = 1024
SYNTH_DAYS = 7
SYNTH_START = "2026-04-01 00:00:00"


def _weighted(u: Column, choices: list[tuple]) -> Column:
    total = float(sum(c[1] for c in choices))
    expr, acc = None, 0.0
    for c in choices:
        acc += c[1] / total
        expr = F.when(u < acc, F.lit(c[0])) if expr is None else expr.when(u < acc, F.lit(c[0]))
    return expr.otherwise(F.lit(choices[-1][0]))


def synth_bronze(spark: SparkSession, n: int, seed: int = 42, partitions: int | None = None) -> DataFrame:
    """``n`` synthetic Bronze rows, generated on executors.

    Randomness is a hash of (seed, row id, stream), so the output does not
    depend on the partitioning. A retry reuses the id of an earlier row at an
    offset of 1..1024, like a client retrying a recent request.
    """
    rng = spark.range(0, n, numPartitions=partitions) if partitions else spark.range(0, n)
    i = F.col("id")

    def u(stream: int) -> Column:  # uniform [0, 1) from a 64-bit hash
        return (F.pmod(F.xxhash64(F.lit(seed), i, F.lit(stream)), F.lit(1 << 53)).cast("double")
                / float(1 << 53))

    span = SYNTH_DAYS * 24 * 3600
    ts = F.to_timestamp_ntz(F.lit(SYNTH_START)) + F.make_dt_interval(
        secs=F.floor(i * F.lit(span) / F.lit(n)).cast("decimal(18,6)"))
    model = _weighted(u(1), [(m, w) for m, w, _, _ in SYNTH_MODELS])
    base = F.lit(0.0)
    jitter = F.lit(0.0)
    for m, _, b, j in SYNTH_MODELS:
        base = F.when(model == m, F.lit(float(b))).otherwise(base)
        jitter = F.when(model == m, F.lit(float(j))).otherwise(jitter)
    pt = (F.floor(u(2) * 3951) + 50).cast("int")
    ct = (F.floor(u(3) * 1981) + 20).cast("int")
    # Box-Muller normal from two uniforms, floored at 50 ms.
    gauss = F.sqrt(-2.0 * F.log(F.greatest(u(4), F.lit(1e-12)))) * F.cos(2.0 * 3.141592653589793 * u(5))
    latency = F.greatest(F.lit(50), F.floor(base / 800.0 * ct + gauss * jitter).cast("int"))
    status = _weighted(u(6), SYNTH_STATUS)
    offset = (F.floor(u(8) * SYNTH_DUP_WINDOW) + 1).cast("long")
    is_retry = (u(7) < SYNTH_DUP_RATE) & (i >= offset)
    src = F.when(is_retry, i - offset).otherwise(i)
    rid = F.concat(F.lit("r-"), F.lower(F.hex(F.xxhash64(F.lit(seed), src, F.lit(99)))))
    user = F.concat(F.lit("u_"), (F.floor(u(9) * 5000) + 1).cast("int").cast("string"))
    raw = record_to_json(model.alias("model"), user.alias("user_id"),
                         F.struct(pt.alias("input"), ct.alias("output")).alias("usage"),
                         latency.alias("latency_ms"), status.alias("status"))
    return rng.select(rid.alias("request_id"), ts.alias("ts"), raw.alias("raw_json"))
