"""Bronze -> Silver -> Gold (M1-M7).

Silver: parse, validate, quarantine, dedupe on request_id, project nine typed
columns, partition by date. Gold: per (date, model) latency quantiles, token
sums, error rate and cost.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from lakeweave.functions import sketches
from lakeweave.functions.payload import PAYLOAD_SCHEMA, parse_payload, reject_reason
from lakeweave.functions.pricing import cost_usd
from lakeweave.operators.dedup import first_per_key

SILVER_COLUMNS = ["request_id", "ts", "date", "model", "user_id", "prompt_tokens",
                  "completion_tokens", "latency_ms", "status"]

# Which of several rows of a request Silver keeps: the least in this order.
SILVER_ORDER = ["ts", "model", "user_id", "prompt_tokens", "completion_tokens", "latency_ms", "status"]


def land_bronze(df: DataFrame, table, batches: int = 1) -> int:
    """M1: land raw rows ``request_id, ts, raw_json`` untouched, as an append
    (the first landing creates the table)."""
    raw = df.select("request_id", "ts", "raw_json")
    return table.append(raw) if table.exists() else table.overwrite(raw)


def peek(df: DataFrame, n: int = 5) -> DataFrame:
    """The first ``n`` rows, for a look at raw data."""
    return df.limit(n)


def classify(bronze: DataFrame, schema=PAYLOAD_SCHEMA) -> DataFrame:
    """Bronze plus the parsed payload ``_p`` and a ``reason`` (NULL = valid)."""
    return (bronze.withColumn("_p", parse_payload("raw_json", schema))
                  .withColumn("reason", reject_reason("raw_json", "_p")))


def quarantine(bronze: DataFrame, schema=PAYLOAD_SCHEMA) -> DataFrame:
    """Rejected Bronze rows with the reason they were rejected."""
    return (classify(bronze, schema).where(F.col("reason").isNotNull())
            .select("request_id", "ts", "raw_json", "reason"))


def build_silver(bronze: DataFrame, schema=PAYLOAD_SCHEMA) -> DataFrame:
    """M2: valid rows only (filter first), then the earliest row per request_id.

    Ties on ``ts`` are broken by the typed columns, so the choice is
    deterministic and the raw text (most of a row) stays out of the shuffle.
    Dates come from the timestamp as stored (no session-zone shift for
    TIMESTAMP_NTZ input).
    """
    valid = classify(bronze, schema).where(F.col("reason").isNull())
    typed = valid.select(
        "request_id", "ts",
        F.col("_p.model").alias("model"),
        F.col("_p.user_id").alias("user_id"),
        F.col("_p.usage.input").alias("prompt_tokens"),
        F.col("_p.usage.output").alias("completion_tokens"),
        F.col("_p.latency_ms").alias("latency_ms"),
        F.col("_p.status").alias("status"),
    )
    first = first_per_key(typed, "request_id", SILVER_ORDER)
    return first.select(*[F.to_date("ts").alias("date") if c == "date" else F.col(c)
                          for c in SILVER_COLUMNS])


def daily_metrics(silver: DataFrame, exact: bool = True) -> DataFrame:
    """Gold aggregates before pricing.

    Both quantiles come from one aggregate over one value->count map per group
    (``percentile(x, array(p50, p95))``), which is partial-aggregated
    map-side, so a hot (date, model) group costs map memory proportional to
    its distinct latencies, not its rows.
    """
    q = (F.percentile("latency_ms", F.array(F.lit(0.5), F.lit(0.95))) if exact
         else F.percentile_approx("latency_ms", F.array(F.lit(0.5), F.lit(0.95))).cast("array<double>"))
    return (silver.groupBy("date", "model").agg(
        q.alias("_q"),
        F.sum("prompt_tokens").alias("total_prompt_tokens"),
        F.sum("completion_tokens").alias("total_completion_tokens"),
        F.avg(F.when(F.col("status") != "ok", F.lit(1.0)).otherwise(F.lit(0.0))).alias("error_rate"),
    ).select("date", "model",
             F.col("_q")[0].alias("p50_latency_ms"), F.col("_q")[1].alias("p95_latency_ms"),
             "total_prompt_tokens", "total_completion_tokens", "error_rate"))


def hourly_latencies(silver: DataFrame) -> DataFrame:
    """A latency sketch for each date, hour and model."""
    return silver.groupBy("date", F.hour("ts").alias("hour"), "model").agg(sketches.sketch("latency_ms").alias("latencies"))


def daily_latencies(hourly: DataFrame) -> DataFrame:
    """The sketches of the hours merged to days, and their quantiles. No
    hour's rows are read again."""
    day = hourly.groupBy("date", "model").agg(sketches.merged("latencies").alias("latencies"))
    day = day.select("date", "model", "latencies", F.kll_sketch_get_n_bigint("latencies").alias("calls"), sketches.grid(F.col("latencies")).alias("_g"))
    return day.select("date", "model", "calls", "latencies",
                      *(sketches.quantile(F.col("_g"), F.col("calls"), q).alias(f"{p}_latency_ms") for p, q in (("p50", 0.5), ("p95", 0.95))))


def rank_errors(silver: DataFrame, daily: DataFrame) -> DataFrame:
    """How far the daily quantiles are, in rank, from the exact ones: 0 if
    the quantile lies between the shares of calls below it and up to it."""
    est = daily.select(F.col("date").alias("d"), F.col("model").alias("m"), F.col("p50_latency_ms").alias("p50"), F.col("p95_latency_ms").alias("p95"))
    rows = silver.where(F.col("latency_ms").isNotNull()).join(est, (F.col("date") == F.col("d")) & (F.col("model") == F.col("m")))
    share = lambda test: F.avg(F.when(test, 1.0).otherwise(0.0))
    per = rows.groupBy("date", "model").agg(F.count(F.lit(1)).alias("calls"), *(share(F.col("latency_ms") < F.col(p)).alias(f"{p}_below") for p in ("p50", "p95")),
                                            *(share(F.col("latency_ms") <= F.col(p)).alias(f"{p}_upto") for p in ("p50", "p95")))
    off = lambda p, q: F.greatest(F.col(f"{p}_below") - q, q - F.col(f"{p}_upto"), F.lit(0.0)).alias(f"{p}_error")
    return per.select("date", "model", "calls", off("p50", F.lit(0.5)), off("p95", F.lit(0.95)))


GOLD_COLUMNS = ["date", "model", "p50_latency_ms", "p95_latency_ms", "total_prompt_tokens",
                "total_completion_tokens", "error_rate", "cost_usd"]


def build_gold(silver: DataFrame, prices: DataFrame, exact: bool = True, how: str = "left",
               digits: int | None = 6) -> DataFrame:
    """M3: Gold per (date, model), priced after aggregation.

    A short price table is broadcast by Spark's own size check; a long one is
    joined by shuffle. ``how='left'``
    keeps unpriced models with NULL cost; ``how='inner'`` drops them.
    """
    return priced(daily_metrics(silver, exact), prices, how, digits)


def priced(metrics: DataFrame, prices: DataFrame, how: str = "left", digits: int | None = 6) -> DataFrame:
    """M3: daily metrics with their cost, in the columns of Gold."""
    g = metrics.join(prices, "model", how)
    out = g.withColumn("cost_usd", cost_usd(F.col("total_prompt_tokens"), F.col("total_completion_tokens"),
                                            F.col("c_in"), F.col("c_out")))
    cols = []
    for c in GOLD_COLUMNS:
        col = F.col(c)
        if digits is not None and c in ("p50_latency_ms", "p95_latency_ms", "error_rate", "cost_usd"):
            col = F.round(col, digits).alias(c)
        cols.append(col)
    return out.select(*cols)


def gold_contract(gold: DataFrame, min_dates: int = 7, n_models: int = 3) -> DataFrame:
    """One global summary row plus pass/fail flags."""
    s = gold.agg(
        F.countDistinct("date").alias("dates"),
        F.countDistinct("model").alias("models"),
        F.count(F.lit(1)).alias("rows"),
        F.countDistinct("date", "model").alias("pairs"),
        F.min("cost_usd").alias("min_cost_usd"),
        F.max("error_rate").alias("max_error_rate"),
    )
    return s.select(
        "*",
        (F.col("dates") >= min_dates).alias("ok_dates"),
        (F.col("models") == n_models).alias("ok_models"),
        (F.col("rows") == F.col("pairs")).alias("ok_one_row_per_pair"),
        F.coalesce(F.col("min_cost_usd") > 0, F.lit(False)).alias("ok_cost"),
    )


def dedup_yield(bronze: DataFrame, silver: DataFrame) -> DataFrame:
    """M5: Bronze and Silver counts and the number of rows dedup dropped."""
    # One union and one global aggregate: both counts in a single job, no join.
    tagged = (bronze.select(F.lit(1).alias("_b"), F.lit(0).alias("_s"))
              .unionByName(silver.select(F.lit(0).alias("_b"), F.lit(1).alias("_s"))))
    out = tagged.agg(F.sum("_b").cast("long").alias("bronze_rows"), F.sum("_s").cast("long").alias("silver_rows"))
    return out.select("bronze_rows", "silver_rows",
                      (F.col("bronze_rows") - F.col("silver_rows")).alias("dropped_rows"),
                      (F.col("silver_rows") < F.col("bronze_rows")).alias("ok_dedup"))


def request_cost(silver: DataFrame, prices: DataFrame, how: str = "inner", digits: int = 6) -> DataFrame:
    """M6: per-request cost rounded to ``digits``."""
    j = silver.join(prices, "model", how)
    return j.select("request_id", "date", "model", "prompt_tokens", "completion_tokens",
                    F.round(cost_usd(F.col("prompt_tokens"), F.col("completion_tokens"),
                                     F.col("c_in"), F.col("c_out")), digits).alias("cost_usd"))


def tenant_daily_cost(silver: DataFrame, prices: DataFrame, digits: int = 6) -> DataFrame:
    """M7: cost and calls per (date, tenant); tenants are ``user_id``s."""
    j = silver.join(prices, "model", "left")
    c = cost_usd(F.col("prompt_tokens"), F.col("completion_tokens"), F.col("c_in"), F.col("c_out"))
    return (j.groupBy("date", F.col("user_id").alias("tenant_id"))
             .agg(F.count(F.lit(1)).alias("calls"),
                  F.round(F.sum(c), digits).alias("cost_usd")))


def model_error_rates(silver: DataFrame, digits: int = 6) -> DataFrame:
    """M7: calls, errors and error rate per model, as a further Gold table."""
    return (silver.groupBy("model").agg(
        F.count(F.lit(1)).alias("calls"),
        F.sum(F.when(F.col("status") != "ok", 1).otherwise(0)).alias("errors"))
        .withColumn("error_rate", F.round(F.col("errors") / F.col("calls"), digits)))
