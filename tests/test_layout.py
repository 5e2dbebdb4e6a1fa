from pyspark.sql import functions as F

from lakeweave.operators import layout as L
from tests.conftest import SF


def _bag(df):
    return sorted(tuple(r) for r in df.collect())


def test_compact_zorder_prune(spark, fresh):
    li = spark.read.parquet(f"{SF}/lineitem.parquet")
    t = fresh("li")
    L.small_file_append(t, li, 40)
    assert t.detail().collect()[0]["numFiles"] == 40
    c = L.compact(t, 16 * 1024)
    assert c["numFilesRemoved"] == 40 and c["numFilesAdded"] < 40
    assert _bag(t.read()) == _bag(li)
    z = L.zorder(t, ["l_partkey", "l_returnflag"], 8 * 1024)   # numeric + string column
    assert z["numFilesAdded"] > 1
    assert _bag(t.read()) == _bag(li)
    key = li.agg(F.max("l_partkey")).collect()[0][0] // 2
    point = {"l_partkey": key, "l_returnflag": "R"}
    assert _bag(L.pruned_read(t, point)) == _bag(li.where((F.col("l_partkey") == key) & (F.col("l_returnflag") == "R")))
    rep_before = L.pruning_report(t, {"l_partkey": key}, version=0).collect()[0]
    rep_after = L.pruning_report(t, {"l_partkey": key}).collect()[0]
    assert rep_after["hits"] <= rep_after["files"]
    assert rep_after["hits"] / rep_after["files"] < rep_before["hits"] / rep_before["files"]
    stats = L.file_stats(t, ["l_partkey"])
    assert stats.agg(F.sum("num_records")).collect()[0][0] == li.count()
    # the clustered batch answers from stored statistics, not a data scan
    assert stats.inputFiles() and all("/_stats/" in f for f in stats.inputFiles())
    h = L.health(t).collect()
    assert len(h) == 3


def test_single_column_cluster_is_sorted_ranges(spark, fresh):
    t = fresh("one")
    t.overwrite(spark.range(0, 5000).select((F.col("id") * 7919 % 5000).alias("x")).repartition(10))
    L.zorder(t, ["x"], 4 * 1024)
    s = L.file_stats(t, ["x"]).orderBy("min_x").collect()
    assert all(a["max_x"] < b["min_x"] for a, b in zip(s, s[1:]))     # disjoint ranges


def test_layout_columns_bucket_bounds(spark):
    ev = spark.read.parquet(f"{SF}/events.parquet")
    out = L.layout_columns(ev, "ts", "user_id", 4)
    b = {r["bucket"] for r in out.select("bucket").distinct().collect()}
    assert b <= {0, 1, 2, 3}
    assert out.where(F.col("hour") != F.hour("ts")).count() == 0


def test_compact_partitioned_table(spark, fresh):
    ev = spark.read.parquet(f"{SF}/events.parquet").withColumn("d", F.to_date("ts"))
    t = fresh("part")
    t.overwrite(ev.limit(0), partition_by=["d"])
    for i in range(3):                              # each append adds a file per date directory
        t.append(ev.where(F.col("event_id") % 3 == i))
    before = t.detail().collect()[0]["numFiles"]
    res = L.compact(t, 64 * 1024)
    after = t.detail().collect()[0]["numFiles"]
    assert res["numFilesRemoved"] > 0 and after < before
    assert _bag(t.read()) == _bag(ev)
    assert t.read().where(F.col("d") == F.lit("2024-01-02").cast("date")).count() == \
        ev.where(F.col("d") == F.lit("2024-01-02").cast("date")).count()


def test_compact_takes_small_files_of_all_batches(spark, fresh):
    t = fresh("many")
    t.overwrite(spark.range(200_000).select("id", F.sha2(F.col("id").cast("string"), 256).alias("h")).coalesce(1))  # one large file
    for i in range(12):
        t.append(spark.range(i * 10, i * 10 + 10).select("id", F.lit("x").alias("h")).coalesce(1))
    res = L.compact(t, 1 << 20)
    assert (res["numFilesRemoved"], res["numFilesAdded"], res["totalConsideredFiles"]) == (12, 1, 13)
    assert t.read().count() == 200_120 and t.detail().collect()[0]["numFiles"] == 2
    assert L.compact(t, 1 << 20)["numFilesRemoved"] == 0          # one small file is not rewritten over and over


def test_zorder_by_long_prefixed_strings(spark, fresh):
    t = fresh("strings")
    t.overwrite(spark.range(8000).select(F.format_string("customer-%07d", F.col("id") * 7919 % 8000).alias("name"), (F.col("id") % 90).alias("n")).repartition(8))
    L.zorder(t, ["name", "n"], 4 * 1024)
    r = L.pruning_report(t, {"name": "customer-0004321"}).collect()[0]
    assert r["files"] >= 8 and r["hits"] <= 0.7 * r["files"]      # all of them by a prefix


def test_zorder_inside_partitions(spark, fresh):
    t = fresh("parts")
    t.overwrite(spark.range(6000).select((F.col("id") % 3).alias("d"), (F.col("id") * 7919 % 6000).alias("x")), partition_by=["d"])
    L.zorder(t, ["x"], 2 * 1024)
    s = t.read_with_files().groupBy("d", "_file").agg(F.min("x").alias("lo"), F.max("x").alias("hi")).orderBy("d", "lo").collect()
    assert len(s) > 6 and all(a["hi"] < b["lo"] for a, b in zip(s, s[1:]) if a["d"] == b["d"])


def test_pruned_read_scans_no_data_for_its_file_list(spark, fresh):
    t = fresh("probe")
    t.overwrite(spark.range(4000).select(F.col("id").alias("a"), (F.col("id") % 7).alias("b")).repartition(4))
    L.zorder(t, ["a"], 4 * 1024)
    t.append(spark.createDataFrame([(17, 3)], "a long, b long").coalesce(1))   # no statistics
    df = L.pruned_read(t, {"a": 17, "b": 3})
    assert sorted(map(tuple, df.collect())) == [(17, 3), (17, 3)]
    assert len(df.inputFiles()) == 2 and "Aggregate" not in df._jdf.queryExecution().executedPlan().toString()
    assert L.pruned_read(t, {"a": -1}).count() == 0


def test_scenario_without_small_files(spark, tmp_path, monkeypatch):
    """Files that are no smaller than the target are not compacted, so there is no version of it."""
    from lakeweave.plans import q_layout as Q
    rows = spark.range(3000).select((F.col("id") % 750).alias("l_orderkey"), (F.col("id") * 7919 % 500).alias("l_partkey"), (F.col("id") % 11).alias("l_suppkey"),
                                    F.when(F.col("id") % 2 == 0, "R").otherwise("N").alias("l_returnflag"))
    rows.coalesce(1).write.parquet(f"{tmp_path}/lineitem.parquet")
    monkeypatch.setattr(Q, "TARGET_BYTES", 1024)
    assert Q.lineitem_layout(spark, str(tmp_path))[1]["numFilesRemoved"] == 0
    for q in (Q.q_small_files, Q.q_compact, Q.q_zorder):
        assert _bag(q(spark, str(tmp_path))) == _bag(rows)
    assert [r["version"] for r in Q.q_pruning_report(spark, str(tmp_path)).orderBy("version").collect()] == [0, 1]


def test_tasks_write_several_files(spark, fresh, monkeypatch):
    """More files than tasks: the files stay as many and hold ranges that do not overlap."""
    assert [L.rewrite_tasks(n, n << 16) for n in (1, 200, 60_000, 600_000)] == [1, 200, 200, 1172]
    monkeypatch.setattr(L, "MOST_TASKS", 4)
    t = fresh("wide")
    t.overwrite(spark.range(40_000).select((F.col("id") * 7919 % 40_000).alias("x"), F.sha2(F.col("id").cast("string"), 256).alias("h")).repartition(4))
    size = t.detail().collect()[0]["sizeInBytes"]
    z = L.zorder(t, ["x"], size // 40)
    s = L.file_stats(t, ["x"]).orderBy("min_x").collect()
    assert 40 <= z["numFilesAdded"] <= 50 and len(s) == z["numFilesAdded"]
    assert all(a["max_x"] < b["min_x"] for a, b in zip(s, s[1:])) and sum(r["num_records"] for r in s) == 40_000
    tasks = t.read_with_files().select(F.regexp_extract("_file", r"part-(\d+)", 1)).distinct().count()
    assert tasks == 4


def test_buckets_by_binary_search(spark):
    """The bucket of a value is the number of split points at or below it."""
    points = [float(x) for x in range(0, 900, 3)]
    df = spark.createDataFrame([(float(x) / 2, f"k{x:04d}") for x in range(-9, 2000, 7)] + [(None, None), (float("nan"), "")], "a double, b string")
    texts = [f"k{x:04d}" for x in range(0, 1500, 100)]
    got = L.with_buckets(df, ["a", "b"], [points, texts]).collect()
    count = lambda v, ps: 0 if v is None else len(ps) if v != v else sum(p <= v for p in ps)
    assert [(r["_zb0"], r["_zb1"]) for r in got] == [(count(r["a"], points), count(r["b"], texts)) for r in got]
    assert {(r["_zb0"], r["_zb1"]) for r in L.with_buckets(df, ["a", "b"], [[], []]).collect()} == {(0, 0)}
