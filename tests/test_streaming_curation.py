import datetime as dt

from pyspark.sql import functions as F

from lakeweave.operators import curation as C
from lakeweave.plans import medallion as M
from lakeweave.session import shared_dir
from lakeweave.sources.bronze import bronze_from_events
from lakeweave.streaming import key_filters, streams as S
from tests.conftest import SF


def test_stream_silver_equals_batch_and_replay_is_noop(spark, fresh):
    b = bronze_from_events(spark.read.parquet(f"{SF}/events.parquet"))
    land = shared_dir(spark, "land")
    S.write_time_ordered_files(b, land, 3)
    silver = fresh("silver")
    S.run_to_end(S.stream_silver(S.bronze_stream(spark, land), silver, shared_dir(spark, "ck")))
    batch = M.build_silver(b)
    assert sorted(silver.read().select(*M.SILVER_COLUMNS).collect()) == sorted(batch.collect())
    v = silver.latest_version()
    query_id = silver.commit_info(0)["params"]["streamQueryId"]
    assert query_id
    S.silver_sink(silver)(b, 0, query_id)            # replay of micro-batch 0
    assert silver.latest_version() == v


def test_a_second_checkpoint_loses_no_row(spark, fresh):
    land, out = shared_dir(spark, "land2"), fresh("twice")
    b = bronze_from_events(spark.read.parquet(f"{SF}/events.parquet"))
    S.write_time_ordered_files(b, land, 3)
    for n in range(2):
        S.run_to_end(S.bronze_stream(spark, land).writeStream.foreachBatch(S.append_sink(out))
                     .option("checkpointLocation", shared_dir(spark, "ck2")).trigger(availableNow=True).start())
        assert out.read().count() == (n + 1) * b.count()


def test_large_chunks_land_in_files_by_key(spark, fresh):
    """Each file of a chunk holds its keys' rows of that chunk, and a micro-batch takes a chunk."""
    b = bronze_from_events(spark.read.parquet(f"{SF}/events.parquet"))
    land, out = shared_dir(spark, "land_keys"), fresh("by_key")
    files = S.write_time_ordered_files(b, land, 3, key="request_id", rows_per_file=150)
    rows = spark.read.parquet(land).select("request_id", "ts", F.col("_metadata.file_path").alias("f"), F.col("_metadata.file_modification_time").alias("at"))
    named = [r.f for r in rows.groupBy("f").agg(F.min("at").alias("at")).orderBy("at").collect()]
    assert files > 1 and len(named) == 3 * files
    chunk = {f: i // files for i, f in enumerate(named)}
    seen, held = {}, [[], [], []]
    for r in rows.collect():
        seen.setdefault((r.request_id, chunk[r.f]), set()).add(r.f)
        held[chunk[r.f]].append(r.ts)
    assert all(len(v) == 1 for v in seen.values())
    assert max(held[0]) < min(held[1]) and max(held[1]) < min(held[2])
    S.run_to_end(S.bronze_stream(spark, land, files).writeStream.foreachBatch(S.append_sink(out))
                 .option("checkpointLocation", shared_dir(spark, "ck_keys")).trigger(availableNow=True).start())
    assert len(out.commits()) == 3 and sorted(out.read().select(*b.columns).collect(), key=str) == sorted(b.collect(), key=str)


def test_a_single_key_lands_one_file_a_chunk(spark):
    """Files of a chunk that no key falls to would not be written: a chunk is one file then."""
    b = bronze_from_events(spark.read.parquet(f"{SF}/events.parquet")).withColumn("request_id", F.lit("r"))
    land = shared_dir(spark, "land_one")
    assert S.write_time_ordered_files(b, land, 3, key="request_id", rows_per_file=50) == 1
    assert spark.read.parquet(land).select("_metadata.file_path").distinct().count() == 3


def _bronze(spark, rows):
    body = '{"model": "m1", "user_id": "u", "usage": {"input": 1, "output": 1}, "latency_ms": %d, "status": "ok"}'
    return spark.createDataFrame([(r, ts, body % n) for r, ts, n in rows], "request_id string, ts timestamp_ntz, raw_json string")


def test_late_retries_and_tied_times_equal_batch(spark, fresh):
    """A repeat ten days on, an earlier row that comes late, and tied times."""
    at = lambda d: dt.datetime(2024, 1, d)
    parts = [[("a", at(11), 5), ("b", at(11), 9), ("c", at(11), 1)], [("a", at(1), 7), ("b", at(11), 1), ("c", at(11), 4), ("a", at(21), 2)]]
    silver = fresh("late")
    for i, rows in enumerate(parts):
        S.silver_sink(silver)(_bronze(spark, rows), i, "q")
    want = M.build_silver(_bronze(spark, parts[0] + parts[1])).collect()
    assert sorted(silver.read().select(*M.SILVER_COLUMNS).collect()) == sorted(want) and len(want) == 3
    rejects = fresh("rejects")
    bad = spark.createDataFrame([("x", at(1), "{"), ("y", at(1), None)], "request_id string, ts timestamp_ntz, raw_json string")
    S.quarantine_sink(rejects)(bad.unionByName(_bronze(spark, parts[0])), 0, "q")
    assert rejects.read().count() == 2 and rejects.commit_info()["partition_by"] == ["reason"]


def test_components_of_a_long_path(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(200)] + [(900, 901)], "src long, dst long")
    got = {r["node"]: r["component"] for r in C.components(edges).collect()}
    assert {got[i] for i in range(201)} == {0} and got[901] == 900


def test_scd2_keeps_rows_without_key_or_time(spark):
    rows = spark.createDataFrame([(1, dt.datetime(2024, 1, 1), 1), (None, dt.datetime(2024, 1, 1), 2), (1, None, 3)], "k long, ts timestamp, n long")
    got = {r["n"]: (r["valid_to"], r["is_current"]) for r in C.scd2(rows, "k", "ts", "n").collect()}
    assert got == {1: (None, True), 2: (None, False), 3: (None, False)}


def test_a_like_pair_beside_many_unlike_documents(spark):
    """Lower ids that share a bucket but are less alike don't hide a pair."""
    import random
    rng = random.Random(4)
    base = [f"w{i}" for i in range(120)]
    rows = [(i, " ".join(base[:70] + [f"x{i}_{j}" for j in range(50)])) for i in range(200)]
    rows += [(900, " ".join(base)), (901, " ".join(base[:-3] + ["y1", "y2", "y3"]))]
    rng.shuffle(rows)
    got = {r["id"]: r["component"] for r in C.near_dups(spark.createDataFrame(rows, "id long, text string"), "id", "text").collect()}
    assert got.get(901) == got.get(900) == 900


def test_merge_latest_ignores_older_rows(spark, fresh):
    t = fresh()
    d = dt.date
    S.merge_latest(t, spark.createDataFrame([(1, d(2024, 1, 5), "new")], "k long, ts date, v string"), "k", ["ts"])
    S.merge_latest(t, spark.createDataFrame([(1, d(2024, 1, 1), "old"), (2, d(2024, 1, 1), "x")],
                                            "k long, ts date, v string"), "k", ["ts"])
    assert sorted((r["k"], r["v"]) for r in t.read().collect()) == [(1, "new"), (2, "x")]


def test_scd2_matches_python(spark):
    o = spark.read.parquet(f"{SF}/orders.parquet")
    got = {r["o_orderkey"]: r["valid_to"] for r in C.scd2(o, "o_custkey", "o_orderdate", "o_orderkey").collect()}
    rows = sorted(o.select("o_custkey", "o_orderdate", "o_orderkey").collect())
    for a, b in zip(rows, rows[1:] + [None]):
        want = b["o_orderdate"] if b is not None and b["o_custkey"] == a["o_custkey"] else None
        assert got[a["o_orderkey"]] == want


def test_near_dups_against_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    got = {r["doc_id"]: r["component"] for r in C.near_dups(docs, "doc_id", "text").collect()}
    # brute force: exact Jaccard on the same word 5-gram sets; near-identical pairs must share a group
    import re
    sets = {}
    for r in docs.collect():
        w = [x for x in re.split(r"\s+", re.sub(r"[^\w\s]|_", " ", r["text"].lower())) if x]
        sets[r["doc_id"]] = {" ".join(w[i:i + 5]) for i in range(max(1, len(w) - 4))} if len(w) >= 5 else {" ".join(w)}
    ids = sorted(sets)
    for i, a in enumerate(ids):
        for b in ids[i + 1:]:
            j = len(sets[a] & sets[b]) / max(1, len(sets[a] | sets[b]))
            if j >= 0.9:
                assert a in got and b in got and got[a] == got[b], (a, b, j)
    # components are labelled by their least member
    assert all(c <= d for d, c in got.items())


def test_license_and_revert(spark, fresh):
    docs = spark.createDataFrame([(1, "x. Released under the MIT License."), (2, "Licensed under CC BY-NC 4.0."),
                                  (3, "plain")], "doc_id long, text string")
    assert sorted(r["doc_id"] for r in C.license_filter(docs, "text").collect()) == [1, 3]
    t = fresh()
    t.overwrite(docs)
    C.revert_shard(t, spark.createDataFrame([(2,)], "doc_id long"), "doc_id")
    assert sorted(r["doc_id"] for r in t.read().collect()) == [1, 3] and t.read(0).count() == 3


def test_age_tier(spark):
    df = spark.createDataFrame([(dt.date(2024, 1, 30),), (dt.date(2023, 12, 1),), (dt.date(2022, 1, 1),)], "d date")
    got = [r["tier"] for r in C.age_tier(df, "d", "2024-01-31").collect()]
    assert got == ["hot", "warm", "archive"]
    assert F is not None


def test_event_time_ignores_session_zone(spark):
    df = spark.createDataFrame([(dt.datetime(2024, 1, 15, 2, 30),)], "ts timestamp_ntz")
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "Australia/Sydney")
        r = df.select(S.instant_to_ntz(S.ntz_to_instant(F.col("ts"))).alias("x"),
                      F.unix_micros(S.ntz_to_instant(F.col("ts"))).alias("us")).collect()[0]
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
    assert r["x"] == dt.datetime(2024, 1, 15, 2, 30)
    assert r["us"] == int(dt.datetime(2024, 1, 15, 2, 30, tzinfo=dt.timezone.utc).timestamp() * 1_000_000)


def test_key_filters_shuffle_keys_not_bits(spark):
    """A key is dealt to its block as one row; its bits are made there, and no repeat, hot date or NULL is lost."""
    rows = spark.range(4000).select(F.when(F.col("id") % 97 == 0, None).otherwise(F.col("id") % 3000).cast("string").alias("k"),
                                    F.when(F.col("id") % 89 == 0, None).otherwise(F.date_add(F.lit("2024-01-01").cast("date"), (F.col("id") % 2).cast("int"))).alias("d"))
    f = key_filters.built(rows, "d", "k")
    want = [(r["d"], r["k"], r["bits"]) for r in rows.where("k IS NOT NULL AND d IS NOT NULL").select("d", "k", key_filters.bits_of(F.col("k")).alias("bits")).collect()]
    keyed = rows.where("k IS NOT NULL AND d IS NOT NULL").distinct()
    held = keyed.join(f, keyed["d"] == f["date"]).where(key_filters.block_of(F.col("k"), F.col("blocks")) == F.col("block"))
    held = held.where(F.forall(key_filters.bits_of(F.col("k")), lambda p: F.getbit(F.col("words")[(p / 64).cast("int")], p % 64) == 1))
    assert held.count() == len({(d, k) for d, k, _ in want}) > 2900
    bits = {}
    for d, k, b in want:
        bits.setdefault(d, set()).update((k, x) for x in b)
    per = {r["date"]: r["n"] for r in f.groupBy("date").agg(F.sum(F.aggregate("words", F.lit(0).cast("bigint"), lambda a, w: a + F.bit_count(w))).alias("n")).collect()}
    assert all(per[d] <= len(bits[d]) for d in bits)
    plan = f._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(date" in plan and not any("hashpartitioning" in line and " at#" in line for line in plan.splitlines())
