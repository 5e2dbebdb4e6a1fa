"""Quality, decontamination, token counts, personal data."""

import hashlib
import random
import re
from collections import defaultdict

import numpy as np
import pytest
from llm_rows import docs, plain, words
from pyspark.sql import functions as F

from lakeweave.llm import decontaminate, pii_boost, quality, token_counts

SF = "/root/testdata/sf0.01"


def lower(t):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or "")


def brute_hits(rows, items):
    norm = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower(t))
    windows = defaultdict(set)
    for item, t in items:
        w = norm(t)
        for i in range(max(1, len(w) - 9) if w else 0):
            windows[tuple(w[i:i + 10])].add("null" if item is None else str(item))
    out = []
    for d, t, *_ in rows:
        w, hit, ids = norm(t), set(), set()
        for k in {len(x) for x in windows}:
            for i in range(len(w) - k + 1):
                if tuple(w[i:i + k]) in windows:
                    hit |= set(range(i, i + k))
                    ids |= windows[tuple(w[i:i + k])]
        out.append((-1 if d is None else d, len(w), len(hit), len(ids), hashlib.sha256(",".join(sorted(ids)).encode()).hexdigest(), bool(hit)))
    return sorted(out)


@pytest.mark.parametrize("block_bytes", [1 << 23, 300])
def test_decontamination_equals_brute_force(spark, block_bytes):
    """In one pass, and dealt into several."""
    rng = random.Random(4)
    items = [(i, " ".join(words(rng, n, 9))) for i, n in enumerate((3, 10, 11, 40, 25, 60))] + [(None, "Only Five Words In This"), (8, None), (9, "--"), (1, "é ß"), (1, "é ß")]
    rows = []
    for d in range(60):
        parts = [" ".join(words(rng, rng.randrange(0, 30), 9)) for _ in range(3)]
        w = (rng.choice(items)[1] or "").split()
        cut = rng.randrange(0, len(w) + 1)
        rows.append((d, rng.choice([", ", "\n", " -- "]).join([parts[0], " ".join(w[cut // 2:]).upper(), parts[1], "ONLY five words,in this" if d % 7 == 0 else "", parts[2]]), "en", "s", 0))
    rows += [(90, None, "en", "s", 0), (91, "", "en", "s", 0), (91, "", "en", "s", 0), (None, "é ß é", "en", "s", 0)]
    bench = spark.createDataFrame(items, "item_id bigint, text string")
    got = decontaminate.report(docs(spark, rows), bench, block_bytes=block_bytes).collect()
    assert sorted((-1 if r[0] is None else r[0], *r[1:]) for r in got) == brute_hits(rows, items)
    source = docs(spark, rows).withColumn("item_id", F.lit(1)).withColumn("n_words", F.lit("x"))
    clean = decontaminate.clean(source, bench, block_bytes=block_bytes)
    assert clean.columns == source.columns and clean.count() == sum(not r.contaminated for r in got)
    assert not any(r.contaminated for r in decontaminate.report(docs(spark, rows), bench.limit(0)).collect())
    assert decontaminate.report(docs(spark, []), bench).collect() == []


def test_wu_manber_finds_overlaps_and_short_patterns():
    rng = random.Random(6)
    text = bytes(rng.choice(b"ab ") for _ in range(9000))
    for patterns in ([b" a ", b"b"], [b"abab", b"babab", b"aa b"], [text[i:i + rng.randrange(12, 40)] for i in range(0, 8000, 37)]):
        patterns = sorted(set(patterns))
        at, which = decontaminate.WuManber(patterns).search(np.frombuffer(text, np.uint8))
        want = {(i, k) for k, p in enumerate(patterns) for i in range(len(text)) if text.startswith(p, i)}
        assert set(zip(at.tolist(), which.tolist())) == want and len(at) == len(want)


def test_token_counts_equal_the_library(spark):
    public = pytest.importorskip("public_tokenizers")
    from tokenizers import Tokenizer
    path = str(public.path("word_bpe_49k.json"))
    own = Tokenizer.from_file(path)
    texts = ["It's DON'T we'll I'D 12345 a1b2", "<|endoftext|> x <|startoftext|>", "İstanbul ŉ ſ µ ª ²½ \x1c\x1d \x85 \xa0  x", "é İ 日本 한국 ١٢٣ \U0001f600!", "''s '''re #'s <|x", "x" * 5000, "Ünï Çødé", "word " * 2049, None, ""]
    rng = random.Random(9)
    texts += ["".join(chr(rng.choice([rng.randrange(32, 127), rng.randrange(0xa0, 0x180), rng.randrange(0x300, 0x2100), 32, 39])) for _ in range(80)) for _ in range(60)]
    rows = [(i, t, "en", "s", 0) for i, t in enumerate(texts)] + [(3, texts[3], "en", "s", 0), (None, "a b", "en", "s", 0)]
    got = token_counts.count_tokens(docs(spark, rows).repartition(3), path, entries=8).collect()
    want = [(d, len((t or "").encode()), n := len(own.encode(t or "", add_special_tokens=False).ids), n > 2048) for d, t, *_ in rows]
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, want))
    assert token_counts.count_tokens(docs(spark, []), path).collect() == []


def test_a_full_cache_changes_nothing(monkeypatch):
    public = pytest.importorskip("public_tokenizers")
    tok = token_counts.load(str(public.path("word_bpe_49k.json")))
    monkeypatch.setattr(token_counts, "CACHE", 3)
    lengths = token_counts.Lengths(tok, ["the"], np.array([1]))
    for text in ("the cat sat on the mat with reasonableness", "the unbelievably " + "x" * 100):
        parts = token_counts.split(text)
        assert lengths.total(parts, lengths.learn(parts)) == token_counts.encoded(tok, [text])[0]


def test_frequent_pre_tokens_come_from_all_documents(spark):
    rows = [(i, "common " * 5 + f"rare{i} " + ("late " * 9 if i > 90 else ""), "en", "s", 0) for i in range(100)]
    assert token_counts.frequent(docs(spark, rows).repartition(40), 3)[:2] == ["common", "late"] or "common" in token_counts.frequent(docs(spark, rows).repartition(40), 3)


def test_quality_learns_from_the_allowed_rows_only(spark):
    d = spark.read.parquet(f"{SF}/documents.parquet")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    rows = {r.doc_id: r for r in quality.score(d, labels).collect()}
    truth = {r.doc_id: r.quality for r in labels.collect()}
    held = [(rows[i].predicted, q) for i, q in truth.items() if rows[i].held_out]
    assert len(held) > 50 and sum(p == q for p, q in held) >= 0.95 * len(held)
    # flipping the held-out labels changes no score
    flipped = labels.withColumn("quality", F.when(F.crc32(F.col("doc_id").cast("string")) % 3 == 1, 1 - F.col("quality")).otherwise(F.col("quality")))
    again = {r.doc_id: r.score for r in quality.score(d, flipped).collect()}
    assert all(abs(again[i] - rows[i].score) < 1e-6 for i in rows)


def test_quality_edges(spark):
    labels = spark.createDataFrame([(1, 1, 0), (1, 1, 0), (7, 0, 0), (None, 1, 0), (8, None, 0), (99, 1, 0)], "doc_id bigint, quality int, toxic int")
    extra = docs(spark).withColumn("score", F.lit("kept")).withColumn("label", F.lit(1))
    got = quality.score(docs(spark), labels).collect()
    assert len(got) == 13 and all(0 <= r.score <= 1 for r in got)
    out = quality.keep_good(extra, labels)
    assert out.columns == extra.columns and {r.score for r in out.collect()} <= {"kept"}
    assert {r.score for r in quality.score(docs(spark), labels.limit(0)).collect()} == {0.5}
    assert quality.score(docs(spark, []), labels).collect() == []


PATTERNS = (("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"), ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
            ("card", r"[0-9]([\x20-]?[0-9])+"), ("phone", r"\+[0-9][\x20().0-9-]+[0-9]"))


def checked(kind, s):
    digits = [int(c) for c in s if c.isdigit()]
    if kind == "ip":
        return all(int(p) <= 255 for p in s.split("."))
    if kind == "card":
        return 13 <= len(digits) <= 19 and sum(d if i % 2 == 0 else sum(divmod(2 * d, 10)) for i, d in enumerate(reversed(digits))) % 10 == 0
    return kind == "email" or 9 <= len(digits) <= 15


def plain_spans(t):
    return [f"{k}:{m.start()}:{m.end()}" for k, p in PATTERNS for m in re.finditer(p, t) if checked(k, m[0])]


def personal_rows():
    rng = random.Random(14)
    parts = ["a.b@c.de", "a@b@c.d.e", "x@y", "@@a@b.c@d.e", "1.2.3.4", "1.2.3.4.5.6.7.8", "999.1.1.1", "0001.02.003.255", "4111 1111 1111 1111", "4111-1111-1111-1112", "4111111111111111",
             "+1 (443) 555-5793", "+49 30 1234567", "+1", "+12345678901234567", "12 34", "1" * 30, "é", "日本", "%+-@a-b.c", " ", " ", "\n", "x" * 50, "token=", "(", "[at]"]
    return [(i, "".join(rng.choice(parts) for _ in range(rng.randrange(0, 14))), "en", "s", 0) for i in range(300)] + [(900, None, "en", "s", 0), (900, None, "en", "s", 0), (None, "a@b.c", "en", "s", 0)]


def test_base_spans_follow_the_patterns(spark):
    rows = personal_rows()
    got = pii_boost.report(docs(spark, rows)).collect()
    assert len(got) == len(rows)
    texts = defaultdict(str, {d: t or "" for d, t, *_ in rows})
    for r in got:
        base = plain_spans(texts[r.doc_id])
        assert r.base_sha256 == hashlib.sha256(",".join(base).encode()).hexdigest() and set(base) <= set(filter(None, r.spans.split(",")))
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(s.startswith(k) for s in base) for k, _ in PATTERNS]
    assert pii_boost.report(docs(spark, [])).collect() == []


def test_long_runs_stay_linear():
    text = "a" * 200_000 + "@" + "1" * 200_000 + "@" + "+" * 1000
    assert pii_boost.base_spans(text) == [] and len(pii_boost.candidates(text)) >= 0


def test_boosted_trees_learn_and_calibrate():
    rng = np.random.default_rng(2)
    x = np.column_stack([rng.integers(0, 2, 3000), rng.normal(size=(3000, 4))]).astype(float)
    y = ((x[:, 1] > 0.3) & (x[:, 2] < 0.5)).astype(float)
    model = pii_boost.BoostedTrees(x, y, rng.random(3000) < 0.3)
    p = model.probability(x)
    assert ((p > 0.5) == (y == 1)).mean() > 0.97 and np.isfinite(model.cutoffs[:2]).all() and np.isinf(model.cutoffs[2:]).all()
    assert y[p >= model.cutoffs[0]].mean() > 0.9


def test_added_spans_and_redaction(spark):
    class Sure(pii_boost.BoostedTrees):
        def __init__(self):
            self.cutoffs = np.zeros(4)

        def probability(self, x):
            return np.ones(len(x))
    model = Sure()
    base, added = pii_boost.all_spans("mail a(at)b.com or c@d.org, card 4111 1111 1111 1112", model)
    assert base == [(0, 19, 26)] and (0, 5, 15) in added and not any(pii_boost.overlaps(a, base) for a in added)
    trained = pii_boost.BoostedTrees(np.zeros((0, 22)), np.zeros(0), np.zeros(0, bool))
    rows = docs(spark, [(1, "to c@d.org and 1.2.3.4!", "en", "s", 0), (2, None, "en", "s", 0), (3, "none", "en", "s", 0)]).withColumn("base", F.lit(7))
    out = pii_boost.redacted(rows, model=trained)
    assert out.columns == rows.columns and [r.text for r in out.orderBy("doc_id").collect()] == ["to [email] and [ip]!", None, "none"]
