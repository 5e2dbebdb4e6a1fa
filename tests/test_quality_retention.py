import datetime as dt

from pyspark.sql import functions as F

from lakeweave.operators import quality as Q, retention as R


def test_expect_and_duplicate_rate(spark):
    df = spark.createDataFrame([(1,), (1,), (2,), (None,)], "k long")
    e = {r["name"]: (r["observed"], r["ok"]) for r in Q.expect(df, {
        "rows": (F.count(F.lit(1)), lambda x: x == 4),
        "nulls": (F.count(F.when(F.col("k").isNull(), 1)), lambda x: x == 0)}).collect()}
    assert e == {"rows": (4.0, True), "nulls": (1.0, False)}
    d = Q.duplicate_rate(df, "k").collect()[0]
    assert d["rows"] == 4 and d["distinct_keys"] == 2 and d["duplicate_rate"] == 0.5


def test_new_keys_fail_closed(spark):
    df = spark.createDataFrame([('{"model": "m", "email": "x"}',), ('{"model": "m", "extra": 1}',), ("{bad",)],
                               "raw string")
    got = {r["key"]: r["pii_suspect"] for r in Q.new_keys(df, "raw", ["model"]).collect()}
    assert got == {"email": True, "extra": False}


def test_cost_anomaly(spark):
    g = spark.createDataFrame([
        (dt.date(2024, 1, 1), "m", 1.0, 100, 0), (dt.date(2024, 1, 2), "m", 5.0, 110, 0),
        (dt.date(2024, 1, 3), "m", 5.5, 120, 0)],
        "date date, model string, cost_usd double, total_prompt_tokens long, total_completion_tokens long")
    a = [r["anomaly"] for r in Q.cost_anomaly(g, 2.0).orderBy("date").collect()]
    assert a == [False, True, False]


def test_expire_payload_with_holds(spark):
    t = dt.datetime(2024, 1, 31)
    df = spark.createDataFrame([("a", t - dt.timedelta(days=10), "p"), ("b", t - dt.timedelta(days=10), "p"),
                                ("c", t - dt.timedelta(days=1), "p")], "k string, ts timestamp_ntz, payload string")
    holds = spark.createDataFrame([("b",)], "k string")
    got = {r["k"]: r["payload"] for r in R.expire_payload(df, "ts", F.lit(t), 7, ["payload"], holds, "k").collect()}
    assert got == {"a": None, "b": "p", "c": "p"}


def test_expire_rows_new_version(spark, fresh):
    t = fresh()
    now = dt.datetime(2024, 1, 31)
    t.overwrite(spark.createDataFrame([(1, now - dt.timedelta(days=40)), (2, now)], "id long, ts timestamp_ntz"))
    R.expire_rows(t, "ts", F.lit(now), 30)
    assert [r["id"] for r in t.read().collect()] == [2] and t.read(0).count() == 2


def test_a_load_with_a_personal_key_is_held_whole(spark, fresh):
    land, held = fresh("land"), fresh("held")
    good = spark.createDataFrame([("r1", '{"model": "m"}'), ("r2", None)], "id string, raw string")
    bad = spark.createDataFrame([("r3", '{"model": "m"}'), ("r4", '{"model": "m", "home_address": 1}')], "id string, raw string")
    assert Q.gated_landing(good, "raw", ["model"], land, held) and not held.exists()
    assert not Q.gated_landing(bad, "raw", ["model"], land, held)
    assert land.read().count() == 2 and {r["reason"] for r in held.read().collect()} == {"new keys: home_address"} and held.read().count() == 2


def test_duplicate_alert_against_a_baseline(spark):
    df = spark.createDataFrame([(i % 8,) for i in range(10)], "k long")
    assert [Q.duplicate_alert(df, "k", base).first()["alert"] for base in (0.1, 0.2)] == [True, False]


def test_ranks_of_a_total_order(spark):
    from lakeweave.operators.ranking import ranked
    rows = [(i * 7919 % 500, i) for i in range(500)] + [(3, 1000 + i) for i in range(50)]
    got = {r["i"]: r["rank"] for r in ranked(spark.createDataFrame(rows, "v long, i long").repartition(7), [F.col("v"), F.col("i")]).collect()}
    assert [got[i] for _, i in sorted(rows)] == list(range(1, 551))
