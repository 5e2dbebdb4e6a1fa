"""Deltas: partial aggregates, spliced histories, the change feed by digest."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from lakeweave.functions.pricing import price_table
from lakeweave.operators import curation as C
from lakeweave.plans import incremental as I, medallion as M


def silver_rows(rng, n, dates):
    return [(f"r{rng.random()}", dt.datetime(2024, 1, 1 + d, rng.randrange(24)), dt.date(2024, 1, 1 + d), rng.choice(("m0", "m1")), "u",
             rng.choice((None, 5, 7)), rng.randrange(9), rng.choice((None, 10, 20, 30, 40)), rng.choice(("ok", "error")))
            for d in (rng.randrange(dates) for _ in range(n))]


SILVER = "request_id string, ts timestamp_ntz, date date, model string, user_id string, prompt_tokens int, completion_tokens int, latency_ms int, status string"


def same(a, b):
    key = lambda df: sorted((tuple(r) for r in df.collect()), key=repr)
    return key(a) == key(b)


def test_partials_follow_appends_deletes_and_updates(spark, fresh):
    rng = random.Random(3)
    silver, state, gold = fresh("s"), fresh("st"), fresh("g")
    prices = price_table(spark)
    frame = lambda n, dates: spark.createDataFrame(silver_rows(rng, n, dates), SILVER)
    silver.overwrite(frame(80, 5), partition_by=["date"])
    I.start_state(state, gold, silver, 0, prices)
    steps = [lambda: silver.append(frame(30, 9)), lambda: silver.delete_where("date = DATE'2024-01-02'"),
             lambda: silver.delete_where("latency_ms = 20 OR latency_ms IS NULL"), lambda: silver.append(frame(5, 2)),
             lambda: silver.merge(silver.read().where("status = 'ok'").withColumn("status", F.lit("error")).limit(20), "request_id")]
    for step in steps:
        v = silver.latest_version()
        step()
        I.apply_delta(state, gold, silver, v, silver.latest_version(), prices)
        assert same(gold.read().select(*M.GOLD_COLUMNS), M.build_gold(silver.read(), prices))
    assert I.apply_delta(state, gold, silver, silver.latest_version(), silver.latest_version(), prices) is None


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_spliced_history_equals_one_shot(spark, fresh, seed):
    rng = random.Random(seed)
    rows = [(rng.choice((1, 2, 3, None)), rng.choice((None, *(dt.datetime(2024, rng.randrange(1, 13), rng.randrange(1, 28)) for _ in range(6)))), i, rng.choice("ab")) for i in range(60)]
    kind = "k long, ts timestamp, n long, v string"
    t = fresh("h")
    cuts = sorted(rng.sample(range(1, 60), 3))
    rng.shuffle(rows)
    for a, b in zip([0, *cuts], [*cuts, 60]):
        C.splice_scd2(t, spark.createDataFrame(rows[a:b], kind), "k", "ts", "n")
    assert same(t.read(), C.scd2(spark.createDataFrame(rows, kind), "k", "ts", "n"))


def test_a_splice_rewrites_only_the_row_before(spark, fresh):
    t = fresh("h")
    kind = "k long, ts date, n long, v string"
    t.overwrite(C.scd2(spark.createDataFrame([(k, dt.date(2024, m, 1), m, "old") for k in range(20) for m in (1, 4, 9)], kind), "k", "ts", "n"))
    C.splice_scd2(t, spark.createDataFrame([(5, dt.date(2024, 6, 1), 6, "late"), (77, dt.date(2024, 6, 1), 6, "new"), (5, dt.date(2024, 9, 1), 9, "again")], kind), "k", "ts", "n")
    m = t.commit_info()["metrics"]
    assert (int(m["numTargetRowsUpdated"]), int(m["numTargetRowsInserted"])) == (2, 2)
    got = {(r.ts.month, r.v, r.valid_to.month if r.valid_to else None, r.is_current) for r in t.read().where("k = 5").collect()}
    assert got == {(1, "old", 4, False), (4, "old", 6, False), (6, "late", 9, False), (9, "again", None, True)}


def test_changes_tell_nulls_and_nested_values_apart(spark, fresh):
    t = fresh("c")
    kind = "id int, a string, b string, xs array<int>, m map<string,int>, s struct<p:int,q:int>"
    t.overwrite(spark.createDataFrame([(1, None, "x", [None, 1], {"k": 1}, (None, 1)), (2, "x", None, [1, None], {"k": None}, (1, None)), (3, "z", "z", None, None, None)], kind))
    t.overwrite(spark.createDataFrame([(1, "x", None, [1, None], {"k": 1}, (None, 1)), (2, "x", None, [1, None], {"k": None}, (1, None)), (3, "z", "z", [], None, None),
                                       (3, "z", "z", [], None, None)], kind))
    got = sorted((r.id, r._change_type) for r in t.changes(0, 1, "id").collect())
    assert got == [(1, "update_postimage"), (1, "update_preimage"), (3, "update_postimage"), (3, "update_postimage"), (3, "update_preimage")]


def test_unchanged_wide_rows_are_not_shuffled(spark, fresh):
    t = fresh("w")
    rows = spark.range(50).select("id", F.expr("repeat('wide', 100)").alias("body"))
    t.overwrite(rows)
    t.overwrite(rows.where("id <> 7"))
    assert [r.id for r in t.changes(0, 1).collect()] == [7]
    plan = t.changes(0, 1)._jdf.queryExecution().executedPlan().toString()
    assert "partial_sum" not in plan  # counted by digest, before the checkpoint
