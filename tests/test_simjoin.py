"""Exact set-similarity groups, nested key paths, key filters and sketches."""

import datetime as dt
import random
import re

import pytest
from pyspark.sql import functions as F

from lakeweave.functions import sketches
from lakeweave.operators import quality as Q, simjoin
from lakeweave.streaming import key_filters, streams as S


def brute_groups(sets, percent):
    parent = {i: i for i in sets}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i
    for a in sets:
        for b in sets:
            if a < b and sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
                parent[max(root(a), root(b))] = min(root(a), root(b))
    groups = {i: root(i) for i in sets}
    sizes = {}
    for r in groups.values():
        sizes[r] = sizes.get(r, 0) + 1
    return {i: r for i, r in groups.items() if sizes[r] > 1}


@pytest.mark.parametrize("percent,seed,cell", [(80, 1, 512), (80, 2, 3), (60, 3, 3), (95, 4, 512), (100, 5, 3)])
def test_groups_equal_brute_force(spark, monkeypatch, percent, seed, cell):
    monkeypatch.setattr(simjoin, "CELL", cell)
    rng = random.Random(seed)
    sets, at = {}, 0
    for _ in range(14):  # families of sets that drift apart, over a few common items
        base = set(rng.sample(range(40), 4)) | {rng.randrange(1000, 9000) for _ in range(rng.choice((1, 4, 9, 30)))}
        for _ in range(rng.choice((1, 2, 5, 9))):
            sets[at] = set(base)
            at += 1
            for _ in range(rng.choice((0, 1, 1, 3))):
                base = (base - {rng.choice(sorted(base))}) | {rng.randrange(1000, 9000)}
    sets[at], sets[at + 1] = set(), set()
    rows = [(i, sorted(s)) for i, s in sets.items()] + [(None, sorted(sets[0])), (at + 2, None)]
    rng.shuffle(rows)
    got = simjoin.similar_groups(spark.createDataFrame(rows, "id bigint, items array<bigint>").repartition(3), percent).collect()
    assert {r.id: r.component for r in got} == brute_groups(sets, percent) and len(got) == len({r.id for r in got})


def test_groups_of_copies_of_nothing_and_of_one_id(spark):
    kind = "id bigint, items array<bigint>"
    assert simjoin.similar_groups(spark.createDataFrame([], kind), 80).collect() == []
    rows = [(i, [1, 2, 3]) for i in range(50)] + [(7, [100, 101]), (90, [100, 101])] + [(91, [5]), (91, [5])]
    got = {r.id: r.component for r in simjoin.similar_groups(spark.createDataFrame(rows, kind), 80).collect()}
    assert got == {**{i: 0 for i in range(50)}, 90: 0}  # document 7 holds both sets; 91 twice is one document


def test_a_set_like_no_other_has_no_bucket(spark):
    rows = [(i, 20, list(range(100 * i, 100 * i + 18)) + [1_000_000, 1_000_001]) for i in range(30)]
    assert simjoin.prefixes(spark.createDataFrame(rows, "node bigint, n int, items array<bigint>"), 80).collect() == []


def test_paths_of_any_depth(spark):
    rows = ['{"model":"m","usage":{"input":1,"email":"a@b"},"tools":[{"phone":1},{"phone":2,"x":[[3],[]]}]}', "{bad", None, "7",
            '[1,{"a":null}]', '{"a.b":{"c d":1},"e":{}}', '{"mail":1,"mail":2}', "", '"text"']
    got = {}
    for r in Q.key_paths(spark.createDataFrame([(r,) for r in rows], "raw string"), "raw").collect():
        got[r.path] = got.get(r.path, 0) + 1
    # keys that occur twice in one object are no variant: their names come from the text
    assert got.pop("mail") >= 1
    assert sorted(p for p, n in got.items() for _ in range(n)) == sorted(["model", "usage.input", "usage.email", "tools[].phone", "tools[].phone", "tools[].x[][]", "tools[].x[]",
                          "[]", "[].a", "'a.b'.'c d'", "e"])
    empty = spark.createDataFrame([], "raw string")
    assert Q.new_paths(empty, "raw", []).collect() == []


def test_a_nested_personal_key_holds_the_load(spark, fresh):
    land, held = fresh("land"), fresh("held")
    known = ["model", "usage.input"]
    fine = spark.createDataFrame([('{"model":"m","usage":{"input":1}}',), ("{broken",)], "raw string")
    drift = spark.createDataFrame([('{"model":"m","usage":{"input":1,"more":[{"Home-Address":"x"}]}}',)], "raw string")
    assert Q.gated_landing(fine, "raw", known, land, held) and not Q.gated_landing(drift, "raw", known, land, held)
    assert land.read().count() == 2 and held.read().first()["reason"] == "new keys: usage.more[].Home-Address"


def bronze(spark, rows):
    body = '{"model":"m","user_id":"u","usage":{"input":%d,"output":2},"latency_ms":5,"status":"ok"}'
    return spark.createDataFrame([(k, ts, body % n) for k, ts, n in rows], "request_id string, ts timestamp_ntz, raw_json string")


def test_a_retry_ten_days_later_opens_one_date(spark, fresh):
    silver = fresh("silver")
    sink = S.silver_sink(silver)
    day = lambda d, h=0: dt.datetime(2024, 1, d, h)
    for d in range(1, 13):
        sink(bronze(spark, [(f"r{d}-{i}", day(d, i), i) for i in range(20)]), d, "q")
    assert silver.commit_info()["params"]["datesSearched"] == "0"
    sink(bronze(spark, [("r2-3", day(12, 23), 99), ("new", day(12, 22), 1)]), 13, "q")
    assert silver.commit_info()["params"]["datesSearched"] == "1"
    got = {r.request_id: (r.date, r.prompt_tokens) for r in silver.read().collect()}
    assert got["r2-3"] == (dt.date(2024, 1, 2), 3) and len(got) == 241 == silver.read().count()
    # an earlier row that comes late moves its request to its own date, which is then the one that opens
    sink(bronze(spark, [("r9-1", day(3, 1), 7)]), 14, "q")
    sink(bronze(spark, [("r9-1", day(11, 1), 8)]), 15, "q")
    got = {r.request_id: (r.date, r.prompt_tokens) for r in silver.read().collect()}
    assert got["r9-1"] == (dt.date(2024, 1, 3), 7) and len(got) == 241


def test_false_positives_change_nothing_and_unfiltered_writes_are_searched(spark, fresh, monkeypatch):
    silver = fresh("silver")
    rows = [(f"r{i}", dt.datetime(2024, 1, 1 + i % 5), i) for i in range(40)]
    with monkeypatch.context() as m:
        m.setattr(key_filters, "HASHES", 1)
        m.setattr(key_filters, "BITS", 1 << 6)
        m.setattr(key_filters, "WORDS", 1)
        S.silver_sink(silver)(bronze(spark, rows), 0, "q")
        assert len(key_filters.may_hold(silver, bronze(spark, [(f"no{i}", rows[0][1], 0) for i in range(99)]), "request_id")) == 5
        S.silver_sink(silver)(bronze(spark, [("r3", dt.datetime(2024, 2, 1), 0), ("x", dt.datetime(2024, 2, 1), 0)]), 1, "q")
    assert silver.read().count() == 41
    S.silver_sink(silver, filters=False)(bronze(spark, [("late", dt.datetime(2024, 3, 1), 0)]), 2, "q")
    assert key_filters.may_hold(silver, bronze(spark, rows[:1]), "request_id") is None
    S.silver_sink(silver)(bronze(spark, [("late", dt.datetime(2024, 3, 9), 0)]), 3, "q")
    assert silver.read().count() == 42


def test_filters_miss_no_key_and_few_others(spark, fresh):
    t = fresh("t")
    rows = spark.range(30_000).select(F.col("id").cast("string").alias("k"), (F.lit(dt.date(2024, 1, 1)) + (F.col("id") % 3).cast("int")).alias("d"))
    t.overwrite(rows, params={"keyFilter": key_filters.write(t, rows, "d", "k")})
    own = rows.where("d = DATE'2024-01-02'")
    assert key_filters.may_hold(t, own, "k") == [dt.date(2024, 1, 2)]
    assert key_filters.may_hold(t, spark.range(10**6, 10**6 + 20_000).select(F.col("id").cast("string").alias("k")), "k") == []


@pytest.mark.parametrize("n", [1, 2, 3, 10, 301, 800])
def test_small_sketches_are_exact_and_merge(spark, n):
    rng = random.Random(n)
    values = [rng.randrange(500) for _ in range(n)]
    rows = spark.createDataFrame([(i % 3, v) for i, v in enumerate(values)] + [(0, None)], "part int, v bigint")
    parts = rows.groupBy("part").agg(sketches.sketch("v").alias("s"))
    whole = parts.agg(sketches.merged("s").alias("s")).select(F.kll_sketch_get_n_bigint("s").alias("n"), sketches.grid(F.col("s")).alias("g"))
    got = whole.select(*(sketches.quantile(F.col("g"), F.col("n"), q) for q in (0.5, 0.95))).first()
    want = rows.agg(F.percentile("v", F.array(F.lit(0.5), F.lit(0.95)))).first()[0]
    assert [round(x, 9) for x in got] == [round(x, 9) for x in want]


def test_large_sketches_are_bounded_and_near(spark):
    rows = spark.range(200_000).select((F.xxhash64("id") % 100_000).alias("v"))
    s = rows.agg(sketches.sketch("v").alias("s")).select("s", F.kll_sketch_get_n_bigint("s").alias("n"), sketches.grid(F.col("s")).alias("g"))
    size, p95 = s.select(F.octet_length("s"), sketches.quantile(F.col("g"), F.col("n"), 0.95)).first()
    rank = rows.agg(F.avg(F.when(F.col("v") <= p95, 1.0).otherwise(0.0))).first()[0]
    assert size < 40_000 and abs(rank - 0.95) <= sketches.RANK_ERROR
    nothing = rows.limit(0).agg(sketches.sketch("v").alias("s")).select(F.kll_sketch_get_n_bigint("s").alias("n"), sketches.grid(F.col("s")).alias("g"))
    assert nothing.select(sketches.quantile(F.col("g"), F.col("n"), 0.5)).first()[0] is None


def test_items_are_moved_once(spark):
    """The count of an item and the join with it read one exchange."""
    sets = spark.createDataFrame([(n, 6, [n, n + 1, n + 2, 1000 + n, 2000 + n, 3000 + n]) for n in range(40)], "node bigint, n int, items array<bigint>")
    pre = simjoin.prefixes(sets.checkpoint(), 80)
    by_item = re.findall(r"Exchange hashpartitioning\(item#\d+L, \d+\), (\w+)", pre._jdf.queryExecution().executedPlan().toString())
    assert set(by_item) == {"REPARTITION_BY_COL"}
    # three of six items are a set's own, and its prefix has two
    assert not pre.collect()


def test_copies_beyond_a_broadcast(spark, monkeypatch):
    rows = spark.createDataFrame([(n, [n % 4 * 10 + k for k in range(6)] if n % 5 else None) for n in range(60)], "id bigint, items array<bigint>")
    want = sorted(map(tuple, simjoin.similar_groups(rows, 80).collect()))
    monkeypatch.setattr(simjoin, "COPIES", 3)
    assert sorted(map(tuple, simjoin.similar_groups(rows, 80).collect())) == want and len(want) == 48
