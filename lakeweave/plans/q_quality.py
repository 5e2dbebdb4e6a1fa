"""Registered data-quality, retention and incremental queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from lakeweave.functions.pricing import DEFAULT_PRICES, price_table
from lakeweave.operators import quality as Q, retention as R
from lakeweave.plans import medallion as M
from lakeweave.plans.catalog import register, table
from lakeweave.plans.incremental import apply_delta, rebuild_gold, start_state
from lakeweave.plans.q_medallion import SQL_BRONZE, _bronze, _gold_sql
from lakeweave.session import shared_dir
from lakeweave.sources.tables import VersionedTable

KNOWN_PAYLOAD_KEYS = ["model", "usage", "latency_ms", "status"]
# Declared for the gate: an id that the key pattern would hold.
GATE_HARMLESS = ["user_id"]


@register("quality_expectations", f"""WITH {SQL_BRONZE.strip()}
SELECT * FROM (VALUES
  ('silver_rows', CAST((SELECT count(*) FROM silver) AS DOUBLE), (SELECT count(*) FROM silver) > 0),
  ('null_models', CAST((SELECT count(*) FROM silver WHERE model IS NULL) AS DOUBLE),
                  (SELECT count(*) FROM silver WHERE model IS NULL) = 0),
  ('min_latency_ms', CAST((SELECT min(latency_ms) FROM silver) AS DOUBLE), (SELECT min(latency_ms) FROM silver) >= 0),
  ('distinct_dates', CAST((SELECT count(DISTINCT date) FROM silver) AS DOUBLE),
                     (SELECT count(DISTINCT date) FROM silver) >= 7)
) AS t(name, observed, ok)""")
def q_expectations(spark, sf):
    """Q1: an expectation table over Silver (one pass)."""
    s = M.build_silver(_bronze(spark, sf))
    return Q.expect(s, {
        "silver_rows": (F.count(F.lit(1)), lambda x: x > 0),
        "null_models": (F.count(F.when(F.col("model").isNull(), 1)), lambda x: x == 0),
        "min_latency_ms": (F.min("latency_ms"), lambda x: x >= 0),
        "distinct_dates": (F.countDistinct("date"), lambda x: x >= 7),
    })


@register("quality_new_keys", f"""WITH {SQL_BRONZE.strip()},
keys AS (SELECT unnest(json_keys(raw_json)) AS key FROM bronze
         WHERE raw_json IS NOT NULL AND json_valid(raw_json) AND json_type(raw_json) = 'OBJECT')
SELECT key, count(*) AS n_rows,
       regexp_matches(key, '{Q.PII_KEY_PATTERN}') AS pii_suspect
FROM keys WHERE key NOT IN ({", ".join(f"'{k}'" for k in KNOWN_PAYLOAD_KEYS)}) GROUP BY key""")
def q_new_keys(spark, sf):
    """Q3: payload keys outside the declared schema; PII-looking ones fail closed."""
    return Q.new_keys(_bronze(spark, sf), "raw_json", KNOWN_PAYLOAD_KEYS)


@register("quality_duplicate_rate", f"""WITH {SQL_BRONZE.strip()}
SELECT count(*) AS rows, count(DISTINCT request_id) AS distinct_keys,
       round(1.0 - count(DISTINCT request_id) / greatest(count(*), 1), 6) AS duplicate_rate
FROM bronze""")
def q_duplicate_rate(spark, sf):
    """Q4: duplicate rate of request ids in Bronze."""
    return Q.duplicate_rate(_bronze(spark, sf), "request_id")


@register("quality_cost_anomaly", f"""WITH gold AS ({_gold_sql(DEFAULT_PRICES)}),
g AS (SELECT date, model, cost_usd, total_prompt_tokens + total_completion_tokens AS tokens,
             lag(cost_usd) OVER (PARTITION BY model ORDER BY date) AS prev_cost,
             lag(total_prompt_tokens + total_completion_tokens) OVER (PARTITION BY model ORDER BY date) AS prev_tokens
      FROM gold)
SELECT date, model, round(cost_usd / prev_cost, 6) AS cost_growth,
       round(CAST(tokens AS DOUBLE) / prev_tokens, 6) AS token_growth,
       coalesce(cost_usd / prev_cost > (CAST(tokens AS DOUBLE) / prev_tokens) * 2.0, false) AS anomaly
FROM g""")
def q_cost_anomaly(spark, sf):
    """Q5: cost growth against token growth per model, day over day."""
    gold = M.build_gold(M.build_silver(_bronze(spark, sf)), price_table(spark))
    return Q.cost_anomaly(gold, 2.0)


@register("retention_payload", f"""WITH {SQL_BRONZE.strip()},
holds AS (SELECT DISTINCT 'req-' || CAST(event_id AS VARCHAR) AS request_id FROM events WHERE event_type = 'purchase'),
newest AS (SELECT max(ts) AS t FROM events)
SELECT b.request_id, b.ts,
       CASE WHEN b.ts < (SELECT t FROM newest) - INTERVAL 7 DAY AND h.request_id IS NULL THEN NULL
            ELSE b.raw_json END IS NOT NULL AS has_payload,
       CASE WHEN json_valid(b.raw_json) THEN json_extract_string(b.raw_json, '$.status') END AS status
FROM bronze b LEFT JOIN holds h ON b.request_id = h.request_id""")
def q_retention_payload(spark, sf):
    """Payloads older than 7 days are dropped unless under legal hold
    (here: requests of purchase events)."""
    ev = table(spark, sf, "events")
    b = _bronze(spark, sf)
    holds = ev.where(F.col("event_type") == "purchase").select(
        F.concat(F.lit("req-"), F.col("event_id").cast("string")).alias("request_id"))
    as_of = ev.agg(F.max("ts")).collect()[0][0]
    # An NTZ literal from its ISO text: no process or session time zone involved.
    # JSON text is formatted differently by each engine: compare presence and
    # a field read before expiry instead of the text.
    b = b.withColumn("status", F.get_json_object("raw_json", "$.status"))
    out = R.expire_payload(b, "ts", as_of.isoformat(sep=" "), 7, ["raw_json"], holds, "request_id")
    return out.select("request_id", "ts", F.col("raw_json").isNotNull().alias("has_payload"), "status")


@register("retention_rows", """SELECT event_id, ts, user_id, event_type, value, props FROM events
WHERE ts >= (SELECT max(ts) FROM events) - INTERVAL 30 DAY + INTERVAL 23 DAY""")
def q_retention_rows(spark, sf):
    """R2: rows older than 7 days before the newest row expire as a new version."""
    ev = table(spark, sf, "events")
    t = VersionedTable(spark, shared_dir(spark, "events_retention"))
    t.overwrite(ev)
    as_of = ev.agg(F.max("ts")).collect()[0][0]
    R.expire_rows(t, "ts", as_of.isoformat(sep=" "), 7)
    return t.read()


# Late Silver arrivals: rows of the last days, and the evening rows of the
# three days before, land after Gold was first built.
SPLIT_DATE = "2024-01-21"


@register("gold_incremental_rebuild", _gold_sql(DEFAULT_PRICES))
def q_incremental(spark, sf):
    """Gold rebuilt only for the dates a Silver append touched; equals a full rebuild."""
    silver_all = M.build_silver(_bronze(spark, sf))
    split = F.lit(SPLIT_DATE).cast("date")
    late = F.coalesce((F.col("date") >= split) | ((F.col("date") >= F.date_sub(split, 3)) & (F.hour("ts") >= 12)), F.lit(False))
    s = VersionedTable(spark, shared_dir(spark, "silver"))
    s.overwrite(silver_all.where(~late), partition_by=["date"])
    prices = price_table(spark)
    g = VersionedTable(spark, shared_dir(spark, "gold"))
    g.overwrite(M.build_gold(s.read(0), prices), partition_by=["date"])
    s.append(silver_all.where(late))
    rebuild_gold(g, s, 0, 1, prices)
    return g.read()


@register("gold_incremental_delta", _gold_sql(DEFAULT_PRICES).replace("FROM silver", "FROM silver WHERE user_id <> 'u_7' AND NOT (date = DATE '2024-01-10' AND model = 'm1')"))
def q_incremental_delta(spark, sf):
    """Gold kept by partial aggregates through late arrivals and two
    deletions (a user's calls; all calls of a model on a date); equals a full rebuild."""
    silver = VersionedTable(spark, shared_dir(spark, "silver_delta"))
    split = F.lit(SPLIT_DATE).cast("date")
    rows = VersionedTable(spark, shared_dir(spark, "silver_all"))
    rows.overwrite(M.build_silver(_bronze(spark, sf)))
    late = F.coalesce((F.col("date") >= split) | ((F.col("date") >= F.date_sub(split, 3)) & (F.hour("ts") >= 12)), F.lit(False))
    silver.overwrite(rows.read().where(~late), partition_by=["date"])
    state, gold = (VersionedTable(spark, shared_dir(spark, n)) for n in ("gold_partials", "gold_delta"))
    prices = price_table(spark)
    start_state(state, gold, silver, 0, prices)
    silver.append(rows.read().where(late))
    apply_delta(state, gold, silver, 0, 1, prices)
    silver.delete_where("user_id = 'u_7' OR (date = DATE'2024-01-10' AND model = 'm1')")
    apply_delta(state, gold, silver, 1, 2, prices)
    return gold.read()


@register("quality_duplicate_alert", f"""WITH {SQL_BRONZE.strip()},
r AS (SELECT count(*) AS rows, count(DISTINCT request_id) AS distinct_keys,
             round(1.0 - count(DISTINCT request_id) / greatest(count(*), 1), 6) AS duplicate_rate FROM bronze)
SELECT *, duplicate_rate > 0.05 * 1.5 AS alert FROM r""")
def q_duplicate_alert(spark, sf):
    """Q4: the duplicate rate of Bronze against a baseline of 5 % and half as much again."""
    return Q.duplicate_alert(_bronze(spark, sf), "request_id", 0.05, 0.5)


@register("quality_duplicate_trend", f"""WITH {SQL_BRONZE.strip()},
b AS (SELECT CAST(ts AS DATE) AS date, request_id FROM bronze UNION ALL SELECT CAST(ts AS DATE), 'u-' || CAST(user_id AS VARCHAR) FROM events),
d AS (SELECT date, count(*) AS rows, count(DISTINCT request_id) AS keys FROM b GROUP BY date),
p AS (SELECT d.date, count(*) AS past_rows, count(DISTINCT b.request_id) AS past FROM d JOIN b ON b.date >= d.date - 7 AND b.date < d.date GROUP BY d.date),
s AS (SELECT t.date, count(DISTINCT t.request_id) AS seen FROM b t JOIN b o ON o.request_id = t.request_id AND o.date >= t.date - 7 AND o.date < t.date GROUP BY t.date),
r AS (SELECT d.date, rows, keys AS distinct_keys, round(1.0 - keys / rows, 6) AS duplicate_rate, round(1.0 - past / past_rows, 6) AS baseline,
             CAST(coalesce(seen, 0) AS BIGINT) AS seen_before FROM d LEFT JOIN p ON p.date = d.date LEFT JOIN s ON s.date = d.date)
SELECT *, coalesce(duplicate_rate > baseline * 1.5, false) AS alert FROM r""")
def q_duplicate_trend(spark, sf):
    """Q4: each day's duplicate rate of request and user keys against the week
    before, from one stored theta sketch a day."""
    b = _bronze(spark, sf).select(F.to_date("ts").alias("day"), "request_id")
    users = table(spark, sf, "events").select(F.to_date("ts").alias("day"), F.concat(F.lit("u-"), F.col("user_id").cast("string")).alias("request_id"))
    days = VersionedTable(spark, shared_dir(spark, "key_sketches"))
    days.overwrite(Q.key_sketches(b.unionByName(users), "day", "request_id"))
    return Q.duplicate_trend(days.read())


@register("quality_gated_landing", f"""WITH {SQL_BRONZE.strip()}
SELECT request_id, ts, 'landed' AS state, NULL AS reason FROM bronze
UNION ALL SELECT 'req-' || CAST(event_id AS VARCHAR), ts, 'held', 'new keys: contact_email' FROM events""")
def q_gated_landing(spark, sf):
    """Q3: a load with a new key that looks personal is held whole; Bronze lands."""
    land, held = (VersionedTable(spark, shared_dir(spark, n)) for n in ("gate_land", "gate_held"))
    Q.gated_landing(_bronze(spark, sf), "raw_json", KNOWN_PAYLOAD_KEYS + GATE_HARMLESS, land, held)
    risky = table(spark, sf, "events").select(F.concat(F.lit("req-"), F.col("event_id").cast("string")).alias("request_id"), "ts",
                                              F.to_json(F.struct(F.lit("m").alias("model"), F.lit("x").alias("contact_email"))).alias("raw_json"))
    Q.gated_landing(risky, "raw_json", KNOWN_PAYLOAD_KEYS + GATE_HARMLESS, land, held)
    return (land.read().select("request_id", "ts", F.lit("landed").alias("state"), F.lit(None).cast("string").alias("reason"))
            .unionByName(held.read().select("request_id", "ts", F.lit("held").alias("state"), "reason")))


def _nested_load(spark, sf):
    """A load whose usage object and tool list grew: one payload per event."""
    ev = table(spark, sf, "events")
    usage = F.struct(F.col("user_id").alias("input"), F.when(F.col("event_type") == "purchase", F.lit("a@b.example")).alias("email"))
    tools = F.array(*(F.struct(kind.alias("kind"), F.lit(phone).cast("int").alias("home phone")) for kind, phone in ((F.col("event_type"), None), (F.lit("t"), 1))))
    return ev.select(F.concat(F.lit("req-"), F.col("event_id").cast("string")).alias("request_id"), "ts",
                     F.to_json(F.struct(F.lit("m").alias("model"), usage.alias("usage"), tools.alias("tools"))).alias("raw_json"))


KNOWN_PATHS = ["model", "usage.input", "usage.output", "latency_ms", "status"]


@register("quality_new_paths", f"""WITH {SQL_BRONZE.strip()},
paths AS (SELECT replace(replace(t.fullkey, '$.', ''), '$', '') AS path FROM bronze, json_tree(raw_json) AS t
          WHERE raw_json IS NOT NULL AND json_valid(raw_json) AND t.type NOT IN ('OBJECT', 'ARRAY')
          UNION ALL SELECT unnest(['model', 'usage.input', 'tools[].kind', 'tools[].kind', 'tools[].''home phone''']) FROM events
          UNION ALL SELECT 'usage.email' FROM events WHERE event_type = 'purchase')
SELECT path, count(*) AS n_values, regexp_matches(path, '{Q.PII_KEY_PATTERN}') AS pii_suspect
FROM paths WHERE path NOT IN ({", ".join(f"'{k}'" for k in KNOWN_PATHS)}) GROUP BY path""")
def q_new_paths(spark, sf):
    """Q3: undeclared key paths of any depth, in Bronze and a load that drifted."""
    load = _bronze(spark, sf).select("raw_json").unionByName(_nested_load(spark, sf).select("raw_json"))
    return Q.new_paths(load, "raw_json", KNOWN_PATHS)


@register("quality_gated_nested", f"""WITH {SQL_BRONZE.strip()}
SELECT request_id, ts, 'landed' AS state, NULL AS reason FROM bronze
UNION ALL SELECT 'req-' || CAST(event_id AS VARCHAR), ts, 'held', 'new keys: tools[].''home phone'', usage.email' FROM events""")
def q_gated_nested(spark, sf):
    """Q3: a load with personal keys below the top level is held whole; Bronze lands."""
    land, held = (VersionedTable(spark, shared_dir(spark, n)) for n in ("nested_land", "nested_held"))
    for load in (_bronze(spark, sf), _nested_load(spark, sf)):
        Q.gated_landing(load, "raw_json", KNOWN_PATHS + GATE_HARMLESS, land, held)
    return (land.read().select("request_id", "ts", F.lit("landed").alias("state"), F.lit(None).cast("string").alias("reason"))
            .unionByName(held.read().select("request_id", "ts", F.lit("held").alias("state"), "reason")))
