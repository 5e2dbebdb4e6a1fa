import datetime as dt

from pyspark.sql import functions as F

from lakeweave.functions.pricing import price_table
from lakeweave.plans import medallion as M
from lakeweave.sources.bronze import bronze_from_events, synth_bronze
from tests.conftest import SF

T0 = dt.datetime(2024, 1, 1, 10, 0, 0)


def bronze(spark, rows):
    return spark.createDataFrame(rows, "request_id string, ts timestamp_ntz, raw_json string")


def payload(model="m0", inp=10, out=20, lat=100, status="ok"):
    import json
    return json.dumps({"model": model, "user_id": "u_1", "usage": {"input": inp, "output": out},
                       "latency_ms": lat, "status": status})


def test_quarantine_reasons(spark):
    b = bronze(spark, [
        ("a", T0, "{bad"), ("b", T0, None), ("c", T0, ""), ("d", T0, "[1, 2]"),
        ("e", T0, '{"model": "m0", "usage": {"input": 1, "output": {"x": 1}}}'),
        ("f", T0, '{"status": "ok"}'), ("g", T0, payload()),
    ])
    got = {r["request_id"]: r["reason"] for r in M.quarantine(b).collect()}
    assert got == {"a": "malformed_json", "b": "null_payload", "c": "null_payload", "d": "malformed_json",
                   "e": "type_mismatch", "f": "missing_model"}
    assert [r["request_id"] for r in M.build_silver(b).collect()] == ["g"]


def test_filter_first_then_earliest(spark):
    later = T0 + dt.timedelta(seconds=3)
    b = bronze(spark, [
        ("r1", T0 - dt.timedelta(seconds=1), "{bad"),       # bad earliest copy must not discard r1
        ("r1", T0, payload(lat=100)), ("r1", later, payload(lat=999)),
        ("r2", T0, payload(lat=7, status="b")), ("r2", T0, payload(lat=5, status="a")),  # tie on ts
    ])
    s = {r["request_id"]: r for r in M.build_silver(b).collect()}
    assert s["r1"]["latency_ms"] == 100
    # tie broken by raw_json: the lexicographically smaller payload wins
    assert s["r2"]["latency_ms"] == min(
        [(payload(lat=7, status="b"), 7), (payload(lat=5, status="a"), 5)])[1]
    assert set(s["r1"].asDict()) == set(M.SILVER_COLUMNS)


def test_gold_exact_quantiles_error_rate_and_cost(spark):
    rows = [(f"r{i}", T0, payload("m0", 1000, 2000, lat, st))
            for i, (lat, st) in enumerate([(100, "ok"), (200, "error"), (300, None), (400, "ok")])]
    rows.append(("x", T0, payload("zz", 5, 5, 50, "ok")))
    silver = M.build_silver(bronze(spark, rows))
    g = {r["model"]: r for r in M.build_gold(silver, price_table(spark)).collect()}
    assert g["m0"]["p50_latency_ms"] == 250.0
    assert abs(g["m0"]["p95_latency_ms"] - 385.0) < 1e-9
    assert g["m0"]["error_rate"] == 0.25            # NULL status is not an error
    assert g["m0"]["cost_usd"] == round(4000 * 0.8 / 1e6 + 8000 * 4.0 / 1e6, 6)
    assert g["zz"]["cost_usd"] is None               # unpriced model kept with NULL cost
    inner = M.build_gold(silver, price_table(spark), how="inner").collect()
    assert {r["model"] for r in inner} == {"m0"}


def test_dates_ignore_session_zone(spark):
    b = bronze(spark, [("r", dt.datetime(2024, 1, 1, 23, 30), payload())])
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "Asia/Ho_Chi_Minh")
        d = M.build_silver(b).collect()[0]["date"]
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
    assert d == dt.date(2024, 1, 1)


def test_fixture_counts(spark):
    ev = spark.read.parquet(f"{SF}/events.parquet")
    b = bronze_from_events(ev)
    n = ev.count()
    retries = ev.where(F.col("event_id") % 20 == 0).count()
    bad = ev.where((F.col("event_id") % 50).isin(7, 17, 27, 37)).count()
    assert b.count() == n + retries + bad
    assert M.build_silver(b).count() == n
    assert M.quarantine(b).count() == bad
    y = M.dedup_yield(b, M.build_silver(b)).collect()[0]
    assert y["ok_dedup"] and y["dropped_rows"] == retries + bad


def test_empty_input(spark):
    b = bronze(spark, [])
    assert M.build_silver(b).count() == 0
    assert M.build_gold(M.build_silver(b), price_table(spark)).count() == 0


def test_synth_bronze_shape_and_determinism(spark):
    a = synth_bronze(spark, 20000, seed=1, partitions=3)
    b = synth_bronze(spark, 20000, seed=1, partitions=7)
    assert sorted(a.collect()) == sorted(b.collect())     # independent of partitioning
    s = a.agg(F.count(F.lit(1)).alias("n"), F.countDistinct("request_id").alias("d"),
              F.countDistinct(F.to_date("ts")).alias("days")).collect()[0]
    assert s["n"] == 20000 and s["days"] == 7
    assert 0.03 < 1 - s["d"] / s["n"] < 0.07                # about 5% retries
    silver = M.build_silver(a)
    share = {r["model"]: r["count"] / silver.count() for r in silver.groupBy("model").count().collect()}
    assert abs(share["m1"] - 0.6) < 0.03 and abs(share["m2"] - 0.1) < 0.03
    assert silver.agg(F.min("latency_ms")).collect()[0][0] >= 50
