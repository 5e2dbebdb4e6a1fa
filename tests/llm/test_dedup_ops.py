"""Near-duplicates, fuzzy lines and repeated byte strings against brute force."""

import hashlib
import random
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest
from llm_rows import docs, plain, words
from pyspark.sql import functions as F

from lakeweave.llm import common, line_dedup, linking, near_dups, suffix_dedup


def found(pairs):
    """Least member of each class of the relation given as pairs."""
    up = {}

    def top(x):
        while up.setdefault(x, x) != x:
            x = up[x]
        return x
    for a, b in pairs:
        a, b = sorted((top(a), top(b)))
        up[b] = a
    return lambda x: top(x)


def mixed(seed, n=60):
    """Texts, their near copies at many distances, short and empty ones."""
    rng = random.Random(seed)
    texts = []
    for _ in range(n // 6):
        w = words(rng, rng.randrange(5, 90))
        texts.append(" ".join(w))
        for k in (0, 1, 2, 4, 8):
            v = list(w)
            for _ in range(k):
                v[rng.randrange(len(v))] = words(rng, 1)[0]
            texts.append(("  ".join(v) if k % 2 else "\n".join(v)).upper() if k == 2 else " ".join(v))
    texts += ["", None, "x", "X", "x y", "x  y", "x y z", " \t"]
    rng.shuffle(texts)
    return [(i, t, "en", "s", 0) for i, t in enumerate(texts)]


def shingles(t, k):
    w = (t or "").encode().lower().split()
    return {tuple(w[i:i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else {tuple(w)} if w else set()


@pytest.mark.parametrize("k", [4, 5])
def test_near_dups_equal_brute_force(spark, k):
    rows = mixed(k)
    sets = {d: shingles(t, k) for d, t, *_ in rows}
    same = lambda a, b: bool(a) and bool(b) and 100 * len(a & b) >= 80 * len(a | b)
    top = found((a, b) for a in sets for b in sets if a < b and same(sets[a], sets[b]))
    got = near_dups.groups(docs(spark, rows).repartition(5), words=k).collect()
    assert len(got) == len(rows)
    assert {(r.doc_id, r.n_shingles, r.component_id, r.kept) for r in got} == {(d, len(s), top(d), top(d) == d) for d, s in sets.items()}


def test_near_dup_chain_around_a_crowded_hub(spark):
    """The least of a bucket isn't near the others, which are near each other."""
    rng = random.Random(3)
    w = words(rng, 100)
    rows = [(0, " ".join(w[:50] + words(rng, 50)), "en", "s", 0)]
    rows += [(i, " ".join(w[:99 - i % 4] + [f"z{i}"]), "en", "s", 0) for i in range(1, 40)]
    got = {r.doc_id: r.component_id for r in near_dups.groups(docs(spark, rows), words=4).collect()}
    assert got[0] == 0 and {got[i] for i in range(1, 40)} == {1}


def test_near_dup_edges(spark):
    got = near_dups.groups(docs(spark)).collect()
    by = defaultdict(list)
    for r in got:
        by[r.doc_id].append(r)
    assert len(got) == 13 and {r.component_id for i in (1, 6, 9) for r in by[i]} == {1}
    assert by[None][0].kept and by[None][0].component_id is None and by[3][0].n_shingles == by[2][0].n_shingles == by[4][0].n_shingles == 0
    extra = docs(spark).withColumn("node", F.lit(1)).withColumn("bucket", F.lit("x")).withColumn("component_id", F.lit(None).cast("int"))
    kept = near_dups.keep_one(extra)
    assert kept.columns == extra.columns and sorted(r.doc_id or -1 for r in kept.collect()) == [-1, 1, 2, 3, 4, 5, 7, 8, 10, 11]
    assert near_dups.groups(docs(spark).limit(0)).collect() == []


def test_components_of_a_path_and_a_star(spark):
    edges = [(i, i + 1) for i in range(200)] + [(1000, 1000 + i) for i in range(1, 300)] + [(5000, 5000), (7001, 7000), (7000, 7001)]
    random.Random(1).shuffle(edges)
    got = {r.node: r.component for r in linking.components(spark.createDataFrame(edges, "src bigint, dst bigint")).collect()}
    assert {got[i] for i in range(201)} == {0} and {got[1000 + i] for i in range(300)} == {1000} and got[7001] == 7000 and 5000 not in got


def test_residual_cells_compare_across_components(spark, monkeypatch):
    """With cells of two rows, one bucket of many components loses no link."""
    monkeypatch.setattr(linking, "CELL", 2)
    rng = random.Random(8)
    values = [rng.randrange(256) for _ in range(60)]
    nodes = spark.createDataFrame([(i, bytes([v])) for i, v in enumerate(values)], "node bigint, payload binary")
    near = lambda a, b: 3 - np.abs(a[:, 0].astype(int) - b[:, 0].astype(int))
    got = {r.node: r.component for r in linking.linked(nodes, nodes.select(F.lit(1).alias("bucket"), "node"), near, lambda p: p).collect()}
    top = found((i, j) for i in range(60) for j in range(i) if abs(values[i] - values[j]) <= 3)
    assert {i: got.get(i, i) for i in range(60)} == {i: top(i) for i in range(60)}


@pytest.mark.parametrize("confirms", [False, True])
def test_cells_list_no_pair_twice_and_no_unlike_ones(spark, monkeypatch, confirms):
    """A bucket of unlike near rows: each two are compared in one cell; if the cell confirms, only links that join leave it."""
    monkeypatch.setattr(linking, "CELL", 8)
    monkeypatch.setattr(linking, "TOGETHER", 16)
    given, plain = [], linking.across

    def watched(cells, close, *more):
        out = plain(cells, close, *more).cache()
        given.extend((*sorted((r.a, r.b)), *r[2:]) for r in out.collect())
        return out
    monkeypatch.setattr(linking, "across", watched)
    n, part = 60, lambda i: i % 30 if i % 2 else i  # odd ones are linked in pairs, of all that are near
    nodes = spark.createDataFrame([(i, bytes([part(i)]), str(part(i)) if i != 7 else None) for i in range(n)], "node bigint, payload binary, text string")
    near = lambda a, b: np.zeros(len(a), int)

    def sure(text, payload, i, j):
        text = text.to_pylist()
        return np.array([-1 if None in (text[x], text[y]) else int(text[x] == text[y]) for x, y in zip(i.tolist(), j.tolist())], int)
    confirm = lambda p: p.where("least(a, b) % 2 = 1 and abs(a - b) = 30")
    members = nodes.select(F.lit(1).alias("bucket"), "node")
    got = linking.linked(nodes.select("node", "payload"), members, near, confirm, *((lambda ids: nodes.join(ids, "node"), near, sure) if confirms else ()))
    assert {r.node: r.component for r in got.collect()} == {i: i % 30 for i in range(n) if i % 2}
    pairs = [x[:2] for x in given]
    assert len(pairs) == len(set(pairs))
    if confirms:
        known = [x for x in given if x[2]]
        assert len(known) <= 15 and all(7 in x[:2] for x in given if not x[2])
    else:
        assert len(pairs) > 1000


def test_forests_of_all_cells_grow_together():
    """Prim's edges for each cell, in as many steps as the largest has members."""
    rng = np.random.default_rng(5)
    size = rng.integers(1, 25, 300)
    cell = np.repeat(np.arange(300) * 7, size)
    data = rng.integers(0, 60, (len(cell), 1)).astype(np.uint8)
    calls = []

    def near(a, b):
        calls.append(len(a))
        apart = np.abs(a[:, 0].astype(int) - b[:, 0].astype(int))
        return np.where(apart <= 4, 4 - apart, -1)
    got = sorted(zip(*(x.tolist() for x in linking.forest(cell, data, near))))
    assert len(calls) == size.max() - 1
    want = []
    for at, n in zip(np.cumsum(size) - size, size):
        mine, best, parent, inside, v = data[at:at + n], [-1] * n, [0] * n, set(), 0
        for _ in range(n - 1):
            inside.add(v)
            for k, w in enumerate(near(np.repeat(mine[v:v + 1], n, 0), mine).tolist()):
                if k not in inside and w > best[k]:
                    best[k], parent[k] = w, v
            v = max((k for k in range(n) if k not in inside), key=lambda k: (best[k], -k))
            if best[v] >= 0:
                want.append((int(at) + parent[v], int(at) + v))
    assert got == sorted(want) and linking.forest(cell[:0], data[:0], near)[0].tolist() == []


def line_rows():
    rng = random.Random(11)
    pool = [" ".join(words(rng, rng.randrange(2, 30))) for _ in range(30)]
    rows = []
    for d in range(40):
        lines = []
        for _ in range(rng.randrange(0, 8)):
            w = rng.choice(pool).split()
            if rng.random() < 0.5:
                w[rng.randrange(len(w))] += rng.choice(["x", "", "!!", "7"])
            lines.append(rng.choice([" ".join(w), " ".join(w).upper() + ".", "  ".join(w), ""]))
        rows.append((d, "\n".join(lines), "en", "s", 0))
    return rows


def edit(a, b):
    prev = list(range(len(b) + 1))
    for i, c in enumerate(a, 1):
        cur = [i]
        for j, e in enumerate(b, 1):
            cur.append(min(prev[j] + 1, cur[-1] + 1, prev[j - 1] + (c != e)))
        prev = cur
    return prev[-1]


def test_line_dedup_equals_brute_force(spark):
    rows, places = line_rows(), []
    for d, t, *_ in rows:
        data = np.frombuffer(t.encode(), np.uint8)
        lines = line_dedup.Lines(data, np.array([0, len(data)]))
        for i, line in enumerate(t.split("\n")):
            norm = lines.normalised(i)
            assert norm.split() == "".join(c if c.isalnum() else " " for c in line.lower()).translate(str.maketrans("123456789", "0" * 9)).split()
            places.append((d, line, norm or None))
    keys = sorted({n for *_, n in places if n})
    links = [(a, b) for a in keys for b in keys if a < b and edit(a, b) * 100 <= 20 * max(len(a), len(b))]
    assert links
    top, used, kept = found(links), set(), defaultdict(list)
    for d, line, norm in places:
        if norm is None or top(norm) not in used:
            kept[d].append(line)
            used.add(top(norm) if norm else None)
    out, _, gone = line_dedup.rebuilt(docs(spark, rows).repartition(3))
    got = {r.doc_id: r for r in out.collect()}
    for d, t, *_ in rows:
        assert got[d].text == "\n".join(kept[d]) and got[d][gone] == len(t.split("\n")) - len(kept[d])


def test_line_dedup_edges(spark):
    source = docs(spark).withColumn("h", F.lit(3)).withColumn("doc", F.lit("d")).withColumn("cuts", F.array(F.lit(1))).withColumn("_cuts", F.lit(1)).withColumn("gone", F.lit(1)).withColumn("lines", F.lit(1))
    out = line_dedup.keep_first(source)
    assert out.columns == source.columns
    by = defaultdict(list)
    for r in out.collect():
        by[r.doc_id].append(r.text)
    whole = {r[0]: r[1] for r in docs(spark).collect()}
    assert by[1] == [whole[1]] and 6 not in by and 9 not in by and by[2] == [None] and by[3] == [""] and by[4] == [whole[4]] and by[7] == [whole[7]]
    # a shared doc_id is one document: both rows keep what the document keeps
    two, _, gone = line_dedup.rebuilt(docs(spark, [(6, "one line that has words\nx", "e", "s", 1)] * 2))
    assert [r[gone] for r in two.collect()] == [0, 0]
    assert line_dedup.report(docs(spark).limit(0)).collect() == []


def test_simhash_of_runs_of_any_length():
    rng = np.random.default_rng(1)
    words = rng.integers(0, 1 << 63, 3000, dtype=np.uint64)
    first = np.array([0, 1, 255, 600, 610, 2999])
    got = line_dedup.simhashes(words, first).view(np.uint64)
    for i, (a, b) in enumerate(zip(first, [*first[1:], 3000])):
        bits = np.unpackbits(words[a:b].view(np.uint8).reshape(-1, 8), axis=1)
        assert np.packbits(bits.sum(0) * 2 > b - a).view(np.uint64)[0] == got[i]


def brute_bytes(rows):
    first, out = set(), {}
    for d, t, *_ in sorted(rows):
        b = (t or "").encode()
        gone = bytearray(len(b))
        for p in range(len(b) - 99):
            if b[p:p + 100] in first:
                gone[p:p + 100] = b"\1" * 100
            first.add(b[p:p + 100])
        spans = sum(1 for i, x in enumerate(gone) if x and (i == 0 or not gone[i - 1]))
        out[d] = (len(b), sum(gone), spans, hashlib.sha256(bytes(x for x, g in zip(b, gone) if not g)).hexdigest())
    return out


def byte_rows():
    rng = random.Random(21)
    passages = [plain(rng, rng.randrange(15, 60)) for _ in range(6)]
    rows = []
    for d in range(50):
        part = [rng.choice([rng.choice(passages), plain(rng, 10), "ab" * 90, "é" * 70, rng.choice(passages)[7:], rng.choice(passages).replace("a", "ä", 1)])
                for _ in range(rng.randrange(0, 5))]
        rows.append((d * 7 % 50, "".join(part), "en", "s", 0))
    return rows + [(100, None, "en", "s", 0), (101, "x" * 99, "en", "s", 0), (102, "x" * 100, "en", "s", 0), (103, "x" * 101, "en", "s", 0)]


@pytest.mark.parametrize("classes,size", [(20_000, 1 << 19), (2, 1 << 19), (20_000, 700), (2, 500)])
def test_repeated_bytes_equal_brute_force(spark, monkeypatch, classes, size):
    """Also with crowded grams dealt by window, and with texts cut into pieces."""
    monkeypatch.setattr(suffix_dedup, "CLASSES", classes)
    monkeypatch.setattr(suffix_dedup, "SLICE", size)
    rows = byte_rows()
    # the slice size is a module value that the tasks read: run them in this process
    if size != 1 << 19:
        ids, texts = [r[0] for r in rows], [r[1] for r in rows]
        import pyarrow as pa
        batch = pa.RecordBatch.from_arrays([pa.array(ids), pa.array(texts)], names=["doc", "text"])

        class Here:
            def mapInArrow(self, run, ddl):  # noqa: N802
                return [x for b in run([batch]) for x in b.to_pylist()]
        spans = Here()
        whole = suffix_dedup.samples(spans)
        assert whole and all(r["place"] < 0 or r["place"] >> 16 >= 0 for r in whole)
        windows = {(r["doc"], p) for r in whole if r["place"] >= 0 for p in range((r["place"] >> 16) - (r["place"] >> 8 & 255), (r["place"] >> 16) - (r["place"] & 255) + 1)}
        windows |= {(r["doc"], p) for r in whole if r["place"] < 0 for p in range(-r["place"] - 1, r["second"] - 99)}
        assert windows >= {(d, p) for d, t in zip(ids, texts) for p in range(len((t or "").encode()) - 99)}
        return
    got = {r.doc_id: tuple(r)[1:] for r in suffix_dedup.report(docs(spark, rows).repartition(4)).collect()}
    assert got == brute_bytes(rows)


def test_repeated_bytes_edges(spark):
    got = defaultdict(list)
    for r in suffix_dedup.report(docs(spark).withColumn("spans", F.lit(1)).withColumn("place", F.lit("x"))).collect():
        got[r.doc_id].append(r)
    assert got[1][0].n_removed == 0 and {r.n_removed for r in got[6]} == {got[6][0].n_bytes} and got[2][0].n_bytes == 0
    assert got[10][0].n_removed == 699 and got[10][0].n_spans == 1 and len(got[None]) == 1 and got[7][0].n_removed == 0
    assert suffix_dedup.report(docs(spark).limit(0)).collect() == []


def test_rows_without_an_id_of_their_own_lose_only_what_repeats(spark):
    rng = random.Random(8)
    x, u1, u2 = ("".join(rng.choice("abcdefghij ") for _ in range(n)) for n in (300, 150, 150))
    for again in (None, 2):
        rows = [(1, x, "e", "s", 1), (again, x + u1, "e", "s", 1), (again, u2, "e", "s", 1), (again, None, "e", "s", 1)]
        got = sorted((r.n_bytes, r.n_removed, r.n_spans) for r in suffix_dedup.report(docs(spark, rows).repartition(3)).collect() if r.doc_id == again)
        assert got == [(0, 0, 0), (150, 0, 0), (450, 300, 1)]
    # equal rows of one id: all but one lose their bytes
    got = suffix_dedup.report(docs(spark, [(5, x, "e", "s", 1)] * 3 + [(None, x, "e", "s", 1)] * 2)).collect()
    assert sorted(r.n_removed for r in got) == [0, 300, 300, 300, 300]


def test_unlike_windows_of_one_name_are_told_apart(monkeypatch):
    rng = random.Random(9)
    runs = ["".join(rng.choice("ab") for _ in range(130)).encode() for _ in range(6)]
    runs += [runs[0], runs[3][:110] + b"c" * 20]
    key, doc = np.zeros(len(runs), np.int64), np.arange(len(runs))
    place = suffix_dedup.packed(np.full(len(runs), 80), np.full(len(runs), 0), np.array([len(r) - 100 for r in runs]))
    want = [x.tolist() for x in suffix_dedup.adjacent(key, doc, place, runs)]
    few = suffix_dedup.names
    monkeypatch.setattr(suffix_dedup, "names", lambda *a: few(*a) % suffix_dedup.U64(3))
    assert [x.tolist() for x in suffix_dedup.adjacent(key, doc, place, runs)] == want == [[6, 7], [0, 0], [130, 110]]


def test_workers_get_bounded_batches(spark):
    """A few hundred long texts are several record batches, in and out."""
    own = docs(spark, [(i, f"{i} " + "word " * 20_000, "en", "s", 0) for i in range(120)]).coalesce(1)
    common.ship(spark)

    def sizes(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays([pa.array([b.nbytes])], names=["n"])

    assert max(r.n for r in own.select("text").mapInArrow(sizes, "n bigint").collect()) < 6 << 20


def test_signatures_do_not_depend_on_their_parts(monkeypatch):
    """The least upper half of a hash function's numbers, in parts of any size."""
    x = np.random.default_rng(3).integers(0, 1 << 63, 5_000, dtype=np.uint64)
    a, b = near_dups._A[:128, None], near_dups._B[:128, None]
    want = ((a * (x & np.uint64(0xFFFFFFFF))[None] + b) >> np.uint64(32)).min(1)
    for at_once in (7, 512, 10_000):
        monkeypatch.setattr(near_dups, "AT_ONCE", at_once)
        assert (near_dups.signature(x) == want).all()
