"""Registered medallion queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from lakeweave.functions import sketches
from lakeweave.functions.pricing import DEFAULT_PRICES, price_table
from lakeweave.plans import medallion as M
from lakeweave.plans.catalog import register, table
from lakeweave.session import shared_dir
from lakeweave.sources.bronze import bronze_from_events
from lakeweave.sources.tables import VersionedTable


def _bronze(spark, sf):
    return bronze_from_events(table(spark, sf, "events"))


# --- oracle building blocks (DuckDB SQL) ------------------------------------

SQL_BRONZE = """
ev AS (
  SELECT event_id, ts,
         'req-' || CAST(event_id AS VARCHAR) AS request_id,
         'm' || CAST(user_id % 3 AS VARCHAR) AS model,
         'u_' || CAST(user_id AS VARCHAR) AS user_id,
         TRY_CAST(json_extract_string(props, '$.k') AS INTEGER) AS k,
         CAST(floor(value * 10) AS INTEGER) AS latency_ms,
         CASE WHEN event_type = 'error' THEN 'error' ELSE 'ok' END AS status
  FROM events
),
bronze AS (
  SELECT request_id, ts,
         CAST(json_object('model', model, 'user_id', user_id,
                          'usage', json_object('input', k, 'output', 2 * k),
                          'latency_ms', latency_ms, 'status', status) AS VARCHAR) AS raw_json
  FROM ev
  UNION ALL
  SELECT request_id, ts + INTERVAL 3 SECOND,
         CAST(json_object('model', model, 'user_id', user_id,
                          'usage', json_object('input', k, 'output', 2 * k),
                          'latency_ms', latency_ms + 1000, 'status', 'rate_limited') AS VARCHAR)
  FROM ev WHERE event_id % 20 = 0
  UNION ALL
  SELECT request_id, ts - INTERVAL 1 SECOND,
         CASE event_id % 50
           WHEN 7 THEN '{"model": "' || model || '", "usage": {'
           WHEN 17 THEN CAST(json_object('user_id', user_id, 'status', status) AS VARCHAR)
           WHEN 27 THEN CAST(json_object('model', model, 'usage',
                              json_object('input', k, 'output', json_object('n', k))) AS VARCHAR)
         END
  FROM ev WHERE event_id % 50 IN (7, 17, 27, 37)
),
classified AS (
  SELECT request_id, ts, raw_json,
    CASE WHEN raw_json IS NULL OR trim(raw_json) = '' THEN 'null_payload'
         WHEN NOT json_valid(raw_json) THEN 'malformed_json'
         WHEN json_type(raw_json) <> 'OBJECT' THEN 'malformed_json'
         WHEN json_type(raw_json, '$.usage.input') NOT IN ('BIGINT', 'UBIGINT')
           OR json_type(raw_json, '$.usage.output') NOT IN ('BIGINT', 'UBIGINT')
           OR json_type(raw_json, '$.latency_ms') NOT IN ('BIGINT', 'UBIGINT') THEN 'type_mismatch'
         WHEN json_extract_string(raw_json, '$.model') IS NULL THEN 'missing_model'
    END AS reason
  FROM bronze
),
typed AS (
  SELECT request_id, ts, raw_json ->> '$.model' AS model, raw_json ->> '$.user_id' AS user_id,
         CAST(raw_json -> '$.usage.input' AS INTEGER) AS prompt_tokens,
         CAST(raw_json -> '$.usage.output' AS INTEGER) AS completion_tokens,
         CAST(raw_json -> '$.latency_ms' AS INTEGER) AS latency_ms, raw_json ->> '$.status' AS status
  FROM classified WHERE reason IS NULL
),
silver AS (
  SELECT request_id, ts, CAST(ts AS DATE) AS date, * EXCLUDE (request_id, ts) FROM typed
  QUALIFY row_number() OVER (PARTITION BY request_id ORDER BY ts NULLS FIRST, model NULLS FIRST, user_id NULLS FIRST,
    prompt_tokens NULLS FIRST, completion_tokens NULLS FIRST, latency_ms NULLS FIRST, status NULLS FIRST) = 1
)"""


def _prices_sql(prices: dict) -> str:
    rows = ", ".join(f"('{m}', CAST({ci} AS DOUBLE), CAST({co} AS DOUBLE))" for m, (ci, co) in prices.items())
    return f"prices(model, c_in, c_out) AS (VALUES {rows})"


def _gold_sql(prices: dict, how: str = "LEFT") -> str:
    """Each (date, model) is summed up first and priced afterwards."""
    return f"""WITH {SQL_BRONZE.strip()},
{_prices_sql(prices)},
per AS (
  SELECT date, model, quantile_cont(latency_ms, [0.5, 0.95]) AS q, CAST(sum(prompt_tokens) AS BIGINT) AS n_in,
         CAST(sum(completion_tokens) AS BIGINT) AS n_out, count(*) AS calls, count(*) FILTER (status <> 'ok') AS failed
  FROM silver GROUP BY ALL)
SELECT date, model, round(q[1], 6) AS p50_latency_ms, round(q[2], 6) AS p95_latency_ms, n_in AS total_prompt_tokens,
       n_out AS total_completion_tokens, round(CAST(failed AS DOUBLE) / calls, 6) AS error_rate,
       round((n_in * c_in + n_out * c_out) / 1000000.0, 6) AS cost_usd
FROM per {how} JOIN prices USING (model)"""


PARTIAL_PRICES = {m: v for m, v in DEFAULT_PRICES.items() if m != "m2"}


@register("bronze_peek_counts", f"""WITH {SQL_BRONZE.strip()}
SELECT count(*) AS bronze_rows, count(DISTINCT request_id) AS distinct_request_ids,
       count(raw_json) AS non_null_payloads
FROM bronze""")
def q_bronze_peek_counts(spark, sf):
    """Row count and distinct ids of the Bronze landing."""
    b = _bronze(spark, sf)
    return b.agg(F.count(F.lit(1)).alias("bronze_rows"),
                 F.countDistinct("request_id").alias("distinct_request_ids"),
                 F.count("raw_json").alias("non_null_payloads"))


@register("silver_dedup", f"""WITH {SQL_BRONZE.strip()}
SELECT * FROM silver""")
def q_silver_dedup(spark, sf):
    """M2: Silver rows (filter, parse, dedupe, project)."""
    return M.build_silver(_bronze(spark, sf))


@register("silver_quarantine_counts", f"""WITH {SQL_BRONZE.strip()}
SELECT reason, count(*) AS n_rows FROM classified WHERE reason IS NOT NULL GROUP BY reason""")
def q_silver_quarantine_counts(spark, sf):
    """Quarantined rows per reason."""
    return (M.quarantine(_bronze(spark, sf)).groupBy("reason")
            .agg(F.count(F.lit(1)).alias("n_rows")))


@register("silver_yield", f"""WITH {SQL_BRONZE.strip()}
SELECT b.n AS bronze_rows, s.n AS silver_rows, b.n - s.n AS dropped_rows, s.n < b.n AS ok_dedup
FROM (SELECT count(*) AS n FROM bronze) b, (SELECT count(*) AS n FROM silver) s""")
def q_silver_yield(spark, sf):
    """M5: dedup yield."""
    b = _bronze(spark, sf)
    return M.dedup_yield(b, M.build_silver(b))


@register("gold_daily_metrics", _gold_sql(DEFAULT_PRICES))
def q_gold_daily_metrics(spark, sf):
    """M3: Gold per (date, model) with exact quantiles."""
    return M.build_gold(M.build_silver(_bronze(spark, sf)), price_table(spark))


@register("gold_unpriced_left", _gold_sql(PARTIAL_PRICES, "LEFT"))
def q_gold_unpriced_left(spark, sf):
    """J2/§3.5-5: an unpriced model keeps its row with NULL cost."""
    return M.build_gold(M.build_silver(_bronze(spark, sf)), price_table(spark, PARTIAL_PRICES), how="left")


@register("gold_priced_inner", _gold_sql(PARTIAL_PRICES, "INNER"))
def q_gold_priced_inner(spark, sf):
    """Inner join drops the unpriced model."""
    return M.build_gold(M.build_silver(_bronze(spark, sf)), price_table(spark, PARTIAL_PRICES), how="inner")


@register("gold_contract", f"""WITH gold AS ({_gold_sql(DEFAULT_PRICES)})
SELECT count(DISTINCT date) AS dates, count(DISTINCT model) AS models, count(*) AS rows,
       count(DISTINCT (date, model)) AS pairs, min(cost_usd) AS min_cost_usd,
       max(error_rate) AS max_error_rate,
       count(DISTINCT date) >= 7 AS ok_dates, count(DISTINCT model) = 3 AS ok_models,
       count(*) = count(DISTINCT (date, model)) AS ok_one_row_per_pair,
       coalesce(min(cost_usd) > 0, false) AS ok_cost
FROM gold""")
def q_gold_contract(spark, sf):
    """The Gold contract."""
    return M.gold_contract(M.build_gold(M.build_silver(_bronze(spark, sf)), price_table(spark)))


@register("gold_approx_quantiles")
def q_gold_approx(spark, sf):
    """Approximate quantiles (no exact oracle: DuckDB's sketch differs)."""
    return M.build_gold(M.build_silver(_bronze(spark, sf)), price_table(spark), exact=False)


@register("gold_sketch_quantiles", f"""WITH {SQL_BRONZE.strip()}
SELECT date, model, count(latency_ms) AS calls, true AS p50_in_bound, true AS p95_in_bound FROM silver GROUP BY date, model""")
def q_gold_sketches(spark, sf):
    """Hourly latency sketches, kept as a table and merged to days; their
    quantiles are within the sketch's rank error of the exact ones."""
    silver = M.build_silver(_bronze(spark, sf))
    hours = VersionedTable(spark, shared_dir(spark, "latency_hours"))
    hours.overwrite(M.hourly_latencies(silver))
    bad = M.rank_errors(silver, M.daily_latencies(hours.read()))
    return bad.select("date", "model", "calls", *((F.col(f"{p}_error") <= sketches.RANK_ERROR).alias(f"{p}_in_bound") for p in ("p50", "p95")))


@register("request_cost", f"""WITH {SQL_BRONZE.strip()},
{_prices_sql(DEFAULT_PRICES)}
SELECT s.request_id, s.date, s.model, s.prompt_tokens, s.completion_tokens,
       round(s.prompt_tokens * p.c_in / 1000000.0 + s.completion_tokens * p.c_out / 1000000.0, 6) AS cost_usd
FROM silver s JOIN prices p USING (model)""")
def q_request_cost(spark, sf):
    """M6: per-request cost rounded to 6 places."""
    return M.request_cost(M.build_silver(_bronze(spark, sf)), price_table(spark))


@register("tenant_daily_cost", f"""WITH {SQL_BRONZE.strip()},
{_prices_sql(DEFAULT_PRICES)}
SELECT s.date, s.user_id AS tenant_id, count(*) AS calls,
       round(sum(s.prompt_tokens * p.c_in / 1000000.0 + s.completion_tokens * p.c_out / 1000000.0), 6) AS cost_usd
FROM silver s LEFT JOIN prices p USING (model)
GROUP BY s.date, s.user_id""")
def q_tenant_daily_cost(spark, sf):
    """M7: tenant daily cost."""
    return M.tenant_daily_cost(M.build_silver(_bronze(spark, sf)), price_table(spark))


@register("bronze_peek")
def q_bronze_peek(spark, sf):
    """A five-row peek at Bronze (a limit is the feature: rows-only check)."""
    return M.peek(_bronze(spark, sf), 5)


@register("bronze_landing", f"""WITH {SQL_BRONZE.strip()}
SELECT request_id, ts, raw_json IS NULL AS no_payload FROM bronze""")
def q_bronze_landing(spark, sf):
    """M1/S3: Bronze landed untouched in three appends (one per ten-day span)."""
    from lakeweave.session import shared_dir
    from lakeweave.sources.tables import VersionedTable
    b = _bronze(spark, sf)
    t = VersionedTable(spark, shared_dir(spark, "bronze"))
    day = F.dayofmonth("ts")
    for cond in (day <= 10, (day > 10) & (day <= 20), day > 20):
        M.land_bronze(b.where(cond), t)
    return t.read().select("request_id", "ts", F.col("raw_json").isNull().alias("no_payload"))


@register("gold_model_error_rates", f"""WITH {SQL_BRONZE.strip()}
SELECT model, count(*) AS calls, CAST(sum(CASE WHEN status <> 'ok' THEN 1 ELSE 0 END) AS BIGINT) AS errors,
       round(sum(CASE WHEN status <> 'ok' THEN 1 ELSE 0 END) / count(*), 6) AS error_rate
FROM silver GROUP BY model""")
def q_model_error_rates(spark, sf):
    """M7: per-model error rates as a further Gold table."""
    return M.model_error_rates(M.build_silver(_bronze(spark, sf))).select(
        "model", "calls", F.col("errors").cast("long").alias("errors"), "error_rate")


@register("silver_any_per_key_count", f"""WITH {SQL_BRONZE.strip()}
SELECT count(DISTINCT request_id) AS n_rows FROM classified WHERE reason IS NULL""")
def q_any_per_key(spark, sf):
    """Any one valid row per request_id (``dropDuplicates``); its count is deterministic."""
    from lakeweave.operators.dedup import any_per_key
    valid = M.classify(_bronze(spark, sf)).where(F.col("reason").isNull()).select("request_id", "ts", "raw_json")
    return any_per_key(valid, "request_id").agg(F.count(F.lit(1)).alias("n_rows"))


@register("distinct_rows", "SELECT DISTINCT o_custkey, o_orderstatus, o_orderpriority FROM orders")
def q_distinct_rows(spark, sf):
    """Distinct rows of a projection."""
    from lakeweave.operators.dedup import distinct_rows
    return distinct_rows(table(spark, sf, "orders"), ["o_custkey", "o_orderstatus", "o_orderpriority"])


@register("orders_by_price", """SELECT o_orderkey, o_totalprice, row_number() OVER (ORDER BY o_totalprice DESC, o_orderkey) AS rank FROM orders""")
def q_orders_by_price(spark, sf):
    """O1: all orders in a total order, with their ranks."""
    from lakeweave.operators.ranking import ranked
    return ranked(table(spark, sf, "orders").select("o_orderkey", "o_totalprice"), [F.col("o_totalprice").desc(), F.col("o_orderkey")])


@register("bronze_peek_in_bronze", "SELECT least(5, count(*)) AS n_rows FROM events")
def q_peek_in_bronze(spark, sf):
    """The peeked rows are rows of Bronze."""
    b = _bronze(spark, sf)
    p = M.peek(b, 5).select(F.xxhash64("request_id", "ts", "raw_json").alias("h"))
    return p.join(b.select(F.xxhash64("request_id", "ts", "raw_json").alias("h")), "h", "left_semi").agg(F.count(F.lit(1)).alias("n_rows"))
