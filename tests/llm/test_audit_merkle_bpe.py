"""Filter audit, Merkle manifest and byte-level BPE against plain Python."""

import hashlib
import random
import re
import zlib
from itertools import permutations

import numpy as np
import pytest
from llm_rows import SCHEMA, docs, edges, plain
from pyspark.sql import functions as F

from lakeweave.llm import bpe, filter_audit, merkle


def sha(s):
    return hashlib.sha256(s.encode()).hexdigest()


def crowded(df, names):
    """``df`` with further columns of the given names."""
    for n in names:
        df = df.withColumn(n, F.lit("x"))
    return df


# --- audit

def failures(rows, i):
    doc, text = rows[i][0], rows[i][1] or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    copy = doc is not None and any(r[0] is not None and r[0] < doc and (r[1] or "") == text for r in rows)
    return {"A": len(words) < 50, "B": 100 * len(set(words)) < 65 * len(words), "C": 100 * len(re.findall("[A-Z]", text)) > 5 * len(text),
            "D": bool(re.search(r"[#$%&*|]", text)), "E": copy}


def plain_audit(rows, labels):
    good = {d for d, q, _ in labels if q == 1}
    toxic = {d for d, _, t in labels if t == 1}
    out = {}
    for part in {r[3] or "" for r in rows}:
        mine = [(failures(rows, i), r[0]) for i, r in enumerate(rows) if (r[3] or "") == part]
        share = dict.fromkeys("ABCDE", 0)
        for order in permutations("ABCDE"):
            left = list(range(len(mine)))
            for k, letter in enumerate(order):
                gone = [i for i in left if mine[i][0][letter]]
                again = [i for i, (f, _) in enumerate(mine) if f[letter] and i not in left]
                left = [i for i in left if i not in gone]
                lonely = sum(f[letter] and sum(f.values()) == 1 for f, _ in mine)
                out[part, "".join(order), k + 1] = [len(left), len(gone), len(again), lonely, sum(mine[i][1] in good for i in gone), sum(mine[i][1] in toxic for i in gone)]
                share[letter] += len(gone)
        for order in permutations("ABCDE"):
            for k, letter in enumerate(order):
                out[part, "".join(order), k + 1].append(share[letter])
    return out


def audit_rows():
    rng = random.Random(4)
    rows = edges()
    for i in range(100, 160):
        text = plain(rng, rng.choice((20, 60, 120))) if i % 3 else "same words " * 40
        rows.append((i, text + rng.choice(("", "", " #1", " SHOUTED WORDS OF THIS TEXT")), "en", rng.choice(("a", "b", None, "")), 1))
    return rows


def test_audit_equals_brute_force(spark):
    rows = audit_rows()
    labels = [(i, i % 2, i % 3 == 0) for i in range(1, 150)] + [(101, 1, 0), (101, 0, 1), (102, None, None), (None, 1, 1), (9999, 1, 1)]
    told = crowded(spark.createDataFrame([(d, None if q is None else int(q), None if t is None else int(t)) for d, q, t in labels], "doc_id bigint, quality int, toxic int"), ["text", "n"])
    got = filter_audit.report(crowded(docs(spark, rows), ["mask", "part", "digest", "n", "good", "rows", "m"]), told).collect()
    want = plain_audit(rows, [(d, q, int(bool(t))) for d, q, t in labels if d is not None])
    assert {(r.part, r.filter_order, r.step): list(r)[3:] for r in got} == want and len(got) == len(want)


def test_audit_of_nothing_and_of_no_labels(spark):
    none = spark.createDataFrame([], "doc_id bigint, quality int, toxic int")
    assert filter_audit.report(docs(spark, []), none).collect() == []
    one = filter_audit.report(docs(spark, [(None, None, None, None, None)] * 3), none).collect()
    assert len(one) == 600 and all(r.part == "" and r.good_lost == r.toxic_lost == 0 for r in one)
    assert all(r.removed == (3 if r.filter_order[r.step - 1] == "A" else 0) for r in one)


# --- manifest

def leaf_of(r):
    return sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in (r[0], r[3], r[2], r[4], r[1])))


def tree(hashes):
    """(root, the steps (left, right) of each leaf)."""
    steps, at = [[] for _ in hashes], list(range(len(hashes)))
    while len(hashes) > 1:
        for i, a in enumerate(at):
            run = a - a % 3
            steps[i].append(("".join(hashes[run:a]), "".join(hashes[a + 1:run + 3])))
        hashes, at = [sha("".join(hashes[i:i + 3])) for i in range(0, len(hashes), 3)], [a // 3 for a in at]
    return hashes[0], steps


def plain_manifest(rows):
    by = {}
    for r in rows:
        by.setdefault(r[3], []).append(r)
    order = sorted(by, key=lambda s: (s is not None, (s or "").encode()))
    trees = {}
    for s in order:
        by[s].sort(key=lambda r: (r[0] is not None, r[0] or 0, leaf_of(r)))
        trees[s] = tree([leaf_of(r) for r in by[s]])
    root, above = tree([trees[s][0] for s in order])
    out = []
    for s, up in zip(order, above):
        for r, low in zip(by[s], trees[s][1]):
            text = r[1]
            if text is not None and r[0] is not None and zlib.crc32(str(r[0]).encode()) % 2 == 0:
                text = text.replace("\n", "")
            h = leaf_of((r[0], text, *r[2:]))
            for left, right in low + up:
                h = sha(left + h + right)
            out.append((r[0], leaf_of(r), trees[s][0], root, sha("".join(a + b for a, b in low + up)), h, h == root))
    return out


def by_value(rows):
    return sorted(map(tuple, rows), key=repr)


@pytest.mark.parametrize("many", [0, 1, 2, 3, 4, 9, 10, 28, 82])
def test_manifest_of_a_source_of_each_size(spark, many):
    rows = [(i * 7 % 97, f"text {i}\nof two lines", "en", "one", i) for i in range(many)]
    assert by_value(merkle.report(docs(spark, rows)).collect()) == by_value(plain_manifest(rows)) if many else merkle.report(docs(spark, rows)).collect() == []


def test_manifest_equals_brute_force(spark):
    rows = edges() + audit_rows() + [(None, "a\nb", None, None, None)] * 4 + [(1, "a\nb", None, "é", 2), (1, "a\nc", None, "z", 2), (4, None, None, "", None)]
    df = crowded(docs(spark, rows).repartition(5), ["row", "at", "pos", "tree", "h", "path", "leaf", "root"])
    got = merkle.report(df).collect()
    assert by_value(got) == by_value(plain_manifest(rows)) and {r.verified for r in got} == {True, False}


def test_ranks_split_a_hot_source(spark):
    rows = spark.range(20_000).select((F.col("id") * 7919 % 20_011).alias("k"), F.lit("hot").alias("g"))
    got = merkle.numbered(rows, "g", ["k"]).orderBy("k").select("pos").collect()
    assert [r.pos for r in got] == list(range(20_000))


# --- byte-level BPE

@pytest.fixture(scope="module")
def vocabulary():
    import public_tokenizers
    return str(public_tokenizers.path("byte_bpe_50k.tiktoken")), public_tokenizers.PATTERN


def bpe_texts():
    rng = random.Random(6)
    odd = "  \n\n\t x's 12 3½ ІІІ 日本語。「か」 naïve x　y 'll !'s  \r\n ünï \U0001f600՘ \x00\x1c"
    mixed = "".join(rng.choice((odd, plain(rng, 9), " ", "\n", "word" * 9, "!!!", "7" * 11)) for _ in range(300))
    return [odd, mixed, "x" * 5000, " " * 3000, "ab " * 1500 + "\n" * 2000 + "c", plain(rng, 3000), "日" * 4000, "'" * 99 + "ll" * 99]


@pytest.mark.parametrize("chunk,overlap", [(bpe.CHUNK, bpe.OVERLAP), (200, 40), (64, 16)])
def test_ids_equal_the_library_and_decode(spark, vocabulary, chunk, overlap):
    path, pattern = vocabulary
    library = bpe.codec(path, pattern)
    rows = edges() + [(500 + i, t, "en", "s", 0) for i, t in enumerate(bpe_texts())]
    df = crowded(docs(spark, rows), ["ids", "key", "piece", "chunk", "start", "decoded"])
    got = bpe.report(df, path, pattern, chunk, overlap).collect()
    want = []
    for d, t, *_ in rows:
        ids = library.encode_ordinary(t or "")
        want.append((d, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), sha(t or "")))
    assert by_value(got) == by_value(want)
    assert bpe.report(docs(spark, []), path, pattern, chunk, overlap).collect() == []


def test_chunks_meet_and_pieces_are_the_text(spark, vocabulary):
    text = bpe_texts()[5]
    rows = spark.createDataFrame([(1, 9, text), (2, 9, "x" * 3000)], "key bigint, doc_id bigint, text string")
    parts = bpe.split(bpe.chunks(rows, 500, 100), vocabulary[1], 500, 100)
    pieces = bpe.stitched(parts, 500).orderBy("key", "piece").collect()
    assert "".join(p.text for p in pieces if p.key == 1) == text and sum(p.key == 1 for p in pieces) == -(-(len(text) - 100) // 500)
    assert [(p.piece, p.text) for p in pieces if p.key == 2] == [(1, "x" * 3000)]


def test_a_million_blanks(vocabulary):
    library = bpe.codec(*vocabulary)
    half = bpe.BLANKS
    for text in ("a b" + " " * (half + 3) + "c", "a" + "\n" * half + " c" + " " * half, " " * half):
        assert bpe.ids_of(library, text).tolist() == library.encode_ordinary(text)
    assert library.decode_bytes(bpe.ids_of(library, " " * 1_500_000 + "x").tolist()) == b" " * 1_500_000 + b"x"
