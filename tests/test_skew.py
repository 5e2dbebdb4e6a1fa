"""Hot keys: one key holding a third of all rows must still give whole,
correct results, and the plans must combine map-side before shuffling."""

from pyspark.sql import functions as F

from lakeweave.operators import curation as C
from lakeweave.operators.dedup import first_per_key
from lakeweave.streaming.streams import merge_latest


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_first_per_key_hot_key(spark):
    n = 30000
    df = spark.range(n).select(
        F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.col("id").cast("string")).alias("k"),
        (F.lit(n) - F.col("id")).alias("ts"), F.col("id").alias("v"))
    out = first_per_key(df, "k", ["ts"])
    rows = {r["k"]: r for r in out.collect()}
    assert len(rows) == 1 + (n - n // 3)
    assert rows["hot"]["ts"] == n - (n - 3) and rows["hot"]["v"] == n - 3   # least ts = largest id
    plan = _plan(out)
    assert plan.count("SortAggregate") >= 2 or plan.count("HashAggregate") >= 2   # partial + final


def test_merge_latest_hot_key(spark, fresh):
    t = fresh()
    src = spark.range(9000).select((F.col("id") % 3 == 0).cast("int").alias("k"), F.col("id").alias("ts"))
    merge_latest(t, src, "k", ["ts"])
    assert sorted((r["k"], r["ts"]) for r in t.read().collect()) == [(0, 8999), (1, 8997)]


def test_near_dups_hot_bucket(spark):
    base = "the same boilerplate paragraph repeated across many documents in one shard " * 3
    docs = spark.range(300).select(
        F.col("id").alias("doc_id"),
        F.when(F.col("id") % 3 == 0, F.lit(base)).otherwise(
            F.concat(F.lit("unique text number "), F.col("id").cast("string"),
                     F.lit(" with words "), F.sha2(F.col("id").cast("string"), 256))).alias("text"))
    got = {r["doc_id"]: r["component"] for r in C.near_dups(docs, "doc_id", "text").collect()}
    hot = [i for i in range(300) if i % 3 == 0]
    assert all(got[i] == 0 for i in hot)                     # one component, least id kept
    assert not any(i in got for i in range(300) if i % 3 != 0)
