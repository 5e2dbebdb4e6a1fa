"""Top-k search, url verdicts, mixing, and the pipeline."""

import random
from collections import Counter, defaultdict

import numpy as np
import pytest
from llm_rows import docs, plain
from pyspark.sql import functions as F

from lakeweave.llm import links, mixing, topk

SF = "/root/testdata/sf0.001"


def vectors(spark, rows):
    return spark.createDataFrame(rows, "vec_id bigint, embedding array<float>, label int")


@pytest.mark.parametrize("scale,k,shard", [(64, 20, 100), (64, 3, 8192), (2 * 10**8, 4, 50), (10**12, 4, 50)])
def test_top_k_equals_brute_force(spark, scale, k, shard):
    rng = np.random.default_rng(3)
    x = (rng.normal(size=(300, 16)) * 0.2).astype(np.float32)
    x[10] = x[20] = x[30]
    rows = [(i, v.tolist(), 0) for i, v in enumerate(x)]
    rows += [(1000, None, 0), (1020, [1.0, None], 0), (1040, [float("nan")] * 16, 0), (1060, [float("inf")] * 16, 0), (None, [1.0] * 16, 0), (1080, [], 0), (1100, [0.5] * 3, 0)]
    got = topk.top_k(vectors(spark, rows), lambda i: i % 20 == 0, k=k, scale=scale, shard=shard).collect()
    ints = {i: [int(np.floor(scale * float(np.float32(c)))) for c in v] for i, v, _ in rows[:300]} | {1080: [], 1100: [scale // 2] * 3}
    want = []
    for q in (i for i in ints if i % 20 == 0):
        most = (1 << 63) - 1
        scores = sorted((max(-most, min(most, -sum(a * b for a, b in zip(ints[q], v)))), i) for i, v in ints.items() if i != q)
        want += [(q, r + 1, i, -s) for r, (s, i) in enumerate(scores[:k])]
    assert sorted(map(tuple, got)) == sorted(want)


def test_top_k_edges(spark):
    few = vectors(spark, [(0, [1.0, 0.0], 0), (1, [1.0, 0.0], 0), (2, [0.5, 0.5], 0), (2, [0.5, 0.5], 0), (20, [1.0], 0)]).withColumn("score", F.lit("x")).withColumn("v", F.lit(1))
    got = sorted(map(tuple, topk.top_k(few, lambda i: i % 20 == 0).collect()))
    assert got == [(0, 1, 1, 4096), (0, 2, 20, 4096), (0, 3, 2, 2048), (20, 1, 0, 4096), (20, 2, 1, 4096), (20, 3, 2, 2048)]
    assert topk.top_k(few.limit(0), lambda i: i % 20 == 0).collect() == []


def split_url(url):
    rest = url.split("://", 1)[1] if url and "://" in url else ""
    host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in rest.split("/")[0].split("?")[0].split("#")[0])
    tail = rest[len(host):].split("?")[0].split("#")[0]
    return host, tail


def page_rows():
    urls = ["http://A.example.com/en/1?x=/es/#y", "https://www.example.com/en/", "http://b.net/es/2", "http://b.net", "http://b.net?/es/", "ftp://x.org/es/", "no scheme", None, "", "://", "http:///en/",
            "http://notexample.com/en/x", "http://net/es/", "http://c.net/fr/", "http://deep.c.net/fr/x", "http://good.com/", "http://spam.org/a", "http://friend.org/", "http://good.com/", "http://ok.org/x#/es/"]
    page = {15: '<a href="http://friend.org/x">f</a> <A HREF=//ok.org>o</a> <a href="/rel">r</a>', 16: "<a href='http://c.net/fr/1'>c</a> <a href='http://b.net/'>b</a>", 13: None}
    return [(i, u, page.get(i, "<p>none</p>")) for i, u in enumerate(urls)]


def pages(spark, rows=None):
    return spark.createDataFrame(page_rows() if rows is None else rows, "page_id bigint, url string, html string")


def test_url_rules(spark):
    got = {r.page_id: r for r in links.verdicts(pages(spark).withColumn("host", F.lit(1)).withColumn("n", F.lit(2))).collect()}
    for i, u, _ in page_rows():
        host, path = split_url(u)
        fits = [(h + p, v) for v, h, p in links.RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
        rule, verdict = max(fits, key=lambda x: len(x[0])) if fits else (None, None)
        assert (got[i].host, got[i].path, got[i].rule) == (host, path, rule) and (verdict is None or got[i].verdict == verdict)
        assert got[i].verdict in ("allow", "block")
    # no rule: a page that links to blocked hosts is blocked, what a trusted one links to is not
    assert got[16].verdict == "block" and got[17].verdict == "allow" and got[19].verdict == "allow" and got[6].verdict == "allow"
    assert links.verdicts(pages(spark, [])).collect() == []
    assert len(links.verdicts(pages(spark, [(1, None, None)] * 3)).collect()) == 3


def test_propagation_equals_brute_force(spark):
    rng = random.Random(7)
    hosts = [f"h{i}" for i in range(30)]
    edges = sorted({(rng.choice(hosts), rng.choice(hosts)) for _ in range(80)})
    edges = [e for e in edges if e[0] != e[1]]
    t0 = {h: (links.MASS // 3 if h in hosts[:3] else 0) for h in hosts}
    d0 = {h: (links.MASS // 2 if h in hosts[5:7] else 0) for h in hosts}
    seeds = spark.createDataFrame([(h, t0[h], d0[h]) for h in hosts], "host string, t0 bigint, d0 bigint")
    got = {r.host: (r.t, r.d) for r in links.propagate(spark.createDataFrame(edges, "src string, dst string"), seeds).collect()}
    out, into = Counter(a for a, _ in edges), Counter(b for _, b in edges)
    t, d, rounds, whole = dict(t0), dict(d0), 0, sum(t0.values()) + sum(d0.values())
    while True:
        nt, nd = {h: t0[h] * 15 // 100 for h in hosts}, {h: d0[h] * 15 // 100 for h in hosts}
        for a, b in edges:
            nt[b] += t[a] * 85 // (out[a] * 100)
            nd[a] += d[b] * 85 // (into[b] * 100)
        moved = sum(abs(nt[h] - t[h]) + abs(nd[h] - d[h]) for h in hosts)
        t, d, rounds = nt, nd, rounds + 1
        if rounds % links.ROUNDS == 0 and moved * 1_000_000 <= links.SETTLED * whole:
            break
    assert got == {h: (t[h], d[h]) for h in hosts}


def test_subdomains_share_an_edge(spark):
    hosts = spark.createDataFrame([("a.b.com",), ("b.com",), ("x.y.a.b.com",), ("com.org",)], "host string")
    got = {tuple(r) for r in links.host_edges(pages(spark, []), hosts).collect()}
    assert got == {("a.b.com", "b.com"), ("b.com", "a.b.com"), ("x.y.a.b.com", "a.b.com"), ("a.b.com", "x.y.a.b.com")}


def water(children, budget):
    """Shares of children {name: (cap, weight)} by repeated filling."""
    got, left, rest = {}, budget, dict(children)
    while rest:
        total = sum(w for _, w in rest.values())
        full = {c: cap for c, (cap, w) in rest.items() if cap * total <= left * w}
        if not full:
            return got | {c: left * w // total for c, (_, w) in rest.items()}
        got |= full
        left -= sum(full.values())
        rest = {c: x for c, x in rest.items() if c not in full}
    return got


@pytest.mark.parametrize("share", [5, 60, 150, 250])
def test_budgets_go_to_siblings_before_ancestors(spark, share):
    rng = random.Random(share)
    rows = [(d, l, s, 1, rng.choice([0, 3, 50, 1000])) for d in ("web", "books", "zz") for l in ("en", "de", None) for s in ("src0", "src1", "q") if rng.random() < 0.8]
    leaves = spark.createDataFrame(rows, "domain string, lang string, source string, n bigint, size bigint")
    total = sum(r[4] for r in rows) * share // 100
    got = {(r.domain, r.lang, r.source): r.budget for r in mixing.budgets(leaves, mixing.WEIGHTS, total, 2).collect()}
    w = lambda level, x: mixing.WEIGHTS[level].get(x, 1)
    cap = lambda keep: sum(2 * r[4] for r in rows if keep(r))
    want = {}
    for d, b in water({d: (cap(lambda r: r[0] == d), w("domain", d)) for d in {r[0] for r in rows}}, total).items():
        for l, c in water({l: (cap(lambda r: r[:2] == (d, l)), w("lang", l)) for l in {r[1] for r in rows if r[0] == d}}, b).items():
            for s, e in water({r[2]: (2 * r[4], w("source", r[2])) for r in rows if r[:2] == (d, l)}, c).items():
                want[d, l, s] = e
    assert got == want


def test_mix_takes_prefixes_of_seeded_epochs(spark):
    rng = random.Random(2)
    rows = [(i, plain(rng, rng.randrange(0, 40)) or None, rng.choice(["en", "de", None]), rng.choice(["src0", "src0", "src0", "src12", "odd", None]), 0) for i in range(800)]
    source = docs(spark, rows).withColumn("id", F.lit("x")).withColumn("leaf", F.lit(1))
    out = mixing.mix(source)
    assert out.columns == [*source.columns, "domain", "n_tokens", "epoch"]
    got = out.collect()
    size = {r[0]: len((r[1] or "").split()) for r in rows}
    assert all(r.n_tokens == size[r.doc_id] and r.text == rows[r.doc_id][1] for r in got)
    total = sum(size.values()) * mixing.SHARE // 100
    assert total - sum(r.n_tokens for r in got) < 40 * 15
    leaves = defaultdict(list)
    for r in rows:
        leaves[r[2], r[3]].append(r[0])
    taken = Counter((r.doc_id, r.epoch) for r in got)
    assert set(taken.values()) == {1}
    import hashlib
    for ids in leaves.values():
        last = max((e for (i, e) in taken if i in ids), default=0)
        order = sorted(ids, key=lambda i: (hashlib.md5(f"{mixing.SEED}:{last}:{i}".encode()).hexdigest(), str(i)))
        flags = [(i, last) in taken for i in order]
        assert flags == sorted(flags, reverse=True)
        assert all((i, e) in taken for i in ids for e in range(last))


def test_mix_edges(spark):
    got = mixing.mix(docs(spark), share=100).collect()
    assert {r.domain for r in got} <= {"web", "other"} and any(r.doc_id is None for r in got)
    assert mixing.mix(docs(spark, [])).collect() == [] and mixing.mix(docs(spark, [(1, None, None, None, None)] * 2)).collect() is not None


def test_pipeline_stages_keep_the_columns(spark):
    import corpus_pipeline
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["quality", "line_dedup", "near_dups", "decontaminate", "mix"]
    source = spark.read.parquet(f"{SF}/documents.parquet")
    docs_now, ids = source, {r.doc_id for r in source.select("doc_id").collect()}
    from lakeweave.llm.common import cut
    for name, stage in corpus_pipeline.STAGES:
        docs_now = cut(stage(spark, docs_now, SF), name)
        if name != "mix":
            assert docs_now.columns == source.columns
        left = {r.doc_id for r in docs_now.select("doc_id").collect()}
        assert left <= ids and len(left) > 0.5 * len(ids)
        ids = left
    ran = corpus_pipeline.run(spark, SF)
    assert sorted(map(str, ran.collect())) == sorted(map(str, docs_now.collect()))


def test_pipeline_stages_take_edge_rows(spark):
    import corpus_pipeline
    for rows in ([], None):
        d = docs(spark, rows)
        for _, stage in corpus_pipeline.STAGES:
            d = stage(spark, d, SF)
            d = spark.createDataFrame(d.collect(), d.schema)
