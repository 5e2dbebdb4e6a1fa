"""Benchmark decontamination by Wu-Manber multi-pattern search.

Texts and items are normalised to lower-case words joined by one blank. Every
window of ten consecutive item words (a shorter item is one window) is a
pattern. A shift table over eight-byte blocks moves a cursor past positions
where no pattern can end; a block that ends some pattern's prefix opens the
bucket of that block, and the bucket's patterns are compared byte by byte.

The patterns of one pass are a broadcast of at most ``block_bytes`` of item
text. A larger benchmark is dealt into several passes by item, each adding its
hits to those found before, so no pass holds more than the bound.

Defined cases: NULL or empty texts have no words and no hits; items without
words match nothing; a NULL item_id is listed as ``null``; repeated items
count once; repeated documents and NULL doc_ids each keep their row; an empty
benchmark contaminates nothing; a document may carry any further columns.
"""

from __future__ import annotations

import hashlib
import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from lakeweave.llm.common import LOWER, byte_view, cut, free, slices, table, word_runs

WINDOW = 10
BLOCK = 8
#: Bytes of item text whose windows one pass broadcasts.
BLOCK_BYTES = 8 << 20
LANE = 2048

#: ASCII letters and digits, and every byte of a non-ASCII character.
WORD = np.zeros(256, bool)
WORD[[*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True
_K = np.uint64(0x9E3779B97F4A7C15)


def normalised(data: np.ndarray, offsets: np.ndarray):
    """(stream, place of each word in it, words before each text). Each text
    is a zero byte, a blank, and its words with a blank after each."""
    low = LOWER[data]
    starts, ends, first = word_runs(WORD[low], offsets)
    size = ends - starts
    texts, words = len(offsets) - 1, len(starts)
    begin = np.concatenate(([0], np.cumsum(size)))
    text_of = np.repeat(np.arange(texts), np.diff(first))
    place = begin[:-1] + np.arange(words) + 2 * (text_of + 1)
    stream = np.full(int(begin[-1]) + words + 2 * texts, 0x20, np.uint8)
    stream[begin[first[:-1]] + first[:-1] + 2 * np.arange(texts)] = 0
    step = np.arange(int(begin[-1]))
    stream[step + np.repeat(place - begin[:-1], size)] = low[step + np.repeat(starts - begin[:-1], size)]
    return stream, place, first


class WuManber:
    """Patterns of one shortest length class, searched together."""

    def __init__(self, patterns: list[bytes], table_bits: int = 21):
        self.patterns = patterns
        self.m = m = min(map(len, patterns))
        self.b = b = min(BLOCK, m)
        self.mask = np.uint64((1 << (8 * b)) - 1) if b < 8 else np.uint64(0xFFFFFFFFFFFFFFFF)
        self.move = np.uint64(64 - table_bits)
        self.size = np.array([len(p) for p in patterns])
        flat = np.frombuffer(b"".join(p[:m] for p in patterns), np.uint8).reshape(len(patterns), m)
        padded = np.zeros((len(patterns), m + 8), np.uint8)
        padded[:, :m] = flat
        self.shift = np.full(1 << table_bits, m - b + 1, np.int32)
        for j in range(m - b + 1):
            h = self.hashed(np.ascontiguousarray(padded[:, j:j + 8]).view("<u8").ravel())
            np.minimum.at(self.shift, h, m - b - j)
        last = h.astype(np.int64)
        self.order = np.argsort(last, kind="stable")
        self.bucket = last[self.order]
        self.head = np.ascontiguousarray(padded[:, :8]).view("<u8").ravel() & self.mask

    def hashed(self, x: np.ndarray) -> np.ndarray:
        x = (x & self.mask) * _K
        return ((x ^ (x >> np.uint64(29))) * _K) >> self.move

    def search(self, stream: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(positions, pattern numbers) of all occurrences. All lanes of the
        stream advance together, each by its own shift."""
        n = len(stream) - self.m + 1
        none = np.zeros(0, np.int64)
        if n <= 0:
            return none, none
        raw = np.concatenate((stream, np.zeros(8, np.uint8)))
        eight = np.ndarray((len(stream) + 1,), "<u8", raw.data, strides=(1,))
        cursor = np.arange(0, n, LANE)
        stop = np.minimum(cursor + LANE, n)
        found = []
        while len(cursor):
            h = self.hashed(eight[cursor + (self.m - self.b)])
            step = self.shift[h]
            hit = step == 0
            if hit.any():
                found.append((cursor[hit], h[hit].astype(np.int64)))
            cursor = cursor + np.maximum(step, 1)
            live = cursor < stop
            if not live.all():
                cursor, stop = cursor[live], stop[live]
        if not found:
            return none, none
        at, block = (np.concatenate(x) for x in zip(*found))
        lo, hi = np.searchsorted(self.bucket, block, "left"), np.searchsorted(self.bucket, block, "right")
        many = hi - lo
        at = np.repeat(at, many)
        which = self.order[np.arange(len(at)) + np.repeat(lo - (np.cumsum(many) - many), many)]
        same = (eight[at] & self.mask) == self.head[which]
        at, which = at[same], which[same]
        text = stream.tobytes()
        sure = np.fromiter((text.startswith(self.patterns[w], p) for p, w in zip(at.tolist(), which.tolist())), bool, len(at))
        return at[sure], which[sure]


class Benchmark:
    """The windows of some items, as searchers by length class."""

    def __init__(self, items: list[tuple[str, str]], window: int = WINDOW):
        owners: dict[bytes, set[str]] = {}
        self.words: dict[bytes, int] = {}
        for item, text in items:
            data = np.frombuffer(text.encode(), np.uint8)
            stream, _, _ = normalised(data, np.array([0, len(data)]))
            words = stream.tobytes()[2:].split()
            for i in range(max(1, len(words) - window + 1) if words else 0):
                part = words[i:i + window]
                p = b" " + b" ".join(part) + b" "
                owners.setdefault(p, set()).add(item)
                self.words[p] = len(part)
        self.owners = owners
        #: Full windows together; shorter ones apart, for they would shorten every shift.
        classes = [[p for p in owners if self.words[p] == window], [p for p in owners if self.words[p] < window]]
        self.searchers = [WuManber(x) for x in classes if x]

    def hits(self, data: np.ndarray, offsets: np.ndarray):
        """(words of each text, hit flag of each word, items of each text)."""
        stream, place, first = normalised(data, offsets)
        edge = np.zeros(len(place) + 1, np.int64)
        items: dict[int, set[str]] = {}
        for s in self.searchers:
            at, which = s.search(stream)
            if not len(at):
                continue
            word = np.searchsorted(place, at + 1)
            span = np.array([self.words[p] for p in s.patterns])[which]
            np.add.at(edge, word, 1)
            np.add.at(edge, word + span, -1)
            text_of = np.searchsorted(first, word, "right") - 1
            for t, w in set(zip(text_of.tolist(), which.tolist())):
                items.setdefault(t, set()).update(self.owners[s.patterns[w]])
        return np.diff(first), np.cumsum(edge[:-1]) > 0, first, items


_READY: dict[str, Benchmark] = {}


def ready(key: str, items: list[tuple[str, str]], window: int) -> Benchmark:
    """The searchers of a broadcast, built once in each worker process."""
    if key not in _READY:
        _READY.clear()
        _READY[key] = Benchmark(items, window)
    return _READY[key]


def scan(docs: DataFrame, items: list[tuple[str, str]], text_col: str, window: int, names: list[str]) -> DataFrame:
    """``docs`` with the columns ``names``: number of words, packed flags of
    hit words and ids of items found, brought up to date for these items."""
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast((uuid.uuid4().hex, items))
    words, hit, found_name = names
    again = hit in docs.columns
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema)
    if not again:
        schema += f", `{words}` bigint, `{hit}` binary, `{found_name}` array<string>"

    def run(batches):
        bench = ready(*shared.value, window)
        for b in batches:
            texts = b.column(b.schema.get_field_index(text_col))
            data, offs = byte_view(texts)
            counts, packed, found = [], [], []
            for i, j in slices(offs):
                n, flags, first, items_of = bench.hits(data[offs[i]:offs[j]], offs[i:j + 1] - offs[i])
                counts.extend(n.tolist())
                some = np.add.reduceat(np.append(flags, False), first[:-1]) * (n > 0) if len(n) else n
                for k in range(j - i):
                    packed.append(np.packbits(flags[first[k]:first[k + 1]]).tobytes() if some[k] else b"")
                    found.append(sorted(items_of.get(k, ())))
            if again:
                before = b.column(b.schema.get_field_index(hit)).to_pylist()
                listed = b.column(b.schema.get_field_index(found_name)).to_pylist()
                packed = [(int.from_bytes(x) | int.from_bytes(y)).to_bytes(max(len(x), len(y))) if x and y else x or y
                          for x, y in zip(before, packed)]
                found = [sorted({*x, *y}) for x, y in zip(listed, found)]
                cols = [b.column(i) for i, name in enumerate(b.schema.names) if name not in (hit, found_name)]
            else:
                cols = [*b.columns, pa.array(counts, pa.int64())]
            yield pa.RecordBatch.from_arrays([*cols, pa.array(packed, pa.binary()), pa.array(found, pa.list_(pa.string()))],
                                             names=[*(n for n in b.schema.names if n not in (hit, found_name)),
                                                    *([] if again else [words]), hit, found_name])

    return docs.mapInArrow(run, schema)


def find(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", window: int = WINDOW,
         block_bytes: int = BLOCK_BYTES) -> tuple[DataFrame, list[str]]:
    """``docs`` with three more columns, and their names: number of words,
    packed word flags (empty: none hit) and the sorted ids of the items whose
    windows occur."""
    taken = {c.lower() for c in docs.columns}
    names = [free(n, taken) for n in ("n_words", "hits", "items")]
    items = benchmark.select(F.coalesce(F.col("item_id").cast("string"), F.lit("null")).alias("item"),
                             F.coalesce(F.col("text"), F.lit("")).alias("text"))
    total = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    passes = max(1, -(-total // block_bytes))
    out = docs
    for p in range(passes):
        part = items if passes == 1 else items.where(F.pmod(F.xxhash64("item", "text"), F.lit(passes)) == p)
        out = scan(out, [tuple(r) for r in part.toLocalIterator()], text_col, window, names)
        if p < passes - 1:
            out = cut(out, "decontaminate")
    return out, names


def report(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """Per document: words, words hit, items found and their digest."""
    found, names = find(docs.select("doc_id", "text"), benchmark, **options)
    schema = "doc_id bigint, n_words bigint, n_hit bigint, n_items bigint, items_sha256 string, contaminated boolean"

    def digest(batches):
        for b in batches:
            hits = [int.from_bytes(x).bit_count() for x in b.column(2).to_pylist()]
            items = b.column(3).to_pylist()
            yield pa.RecordBatch.from_arrays([
                b.column(0), b.column(1), pa.array(hits, pa.int64()), pa.array([len(x) for x in items], pa.int64()),
                pa.array([hashlib.sha256(",".join(x).encode()).hexdigest() for x in items]),
                pa.array([h > 0 for h in hits])], names=[x.split()[0] for x in schema.split(", ")])

    return found.select("doc_id", *names).mapInArrow(digest, schema)


def clean(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """``docs`` without the documents that hold a benchmark window."""
    found, names = find(docs, benchmark, **options)
    return found.where(F.octet_length(names[1]) == 0).drop(*names)


def op5_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


QUERIES = {"op5_decontaminate": op5_decontaminate}

ORACLE = {"op5_decontaminate": r"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (
  SELECT CAST(item_id AS VARCHAR) AS item,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
bk AS (SELECT item, w, least(len(w), 10) AS k FROM b WHERE len(w) > 0),
bw AS (SELECT DISTINCT item, k, array_to_string(w[i:i + k - 1], ' ') AS g
       FROM (SELECT item, k, w, unnest(range(1, len(w) - k + 2)) AS i FROM bk)),
dk AS (SELECT doc_id, w, k FROM d, (SELECT DISTINCT k FROM bk) WHERE len(w) >= k),
dw AS (SELECT doc_id, k, i, array_to_string(w[i:i + k - 1], ' ') AS g
       FROM (SELECT doc_id, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM dk)),
m AS (SELECT doc_id, i, dw.k, item FROM dw JOIN bw ON dw.k = bw.k AND dw.g = bw.g),
h AS (SELECT doc_id, count(DISTINCT p) AS n_hit
      FROM (SELECT doc_id, unnest(range(i, i + k)) AS p FROM (SELECT DISTINCT doc_id, i, k FROM m)) GROUP BY doc_id),
t AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
      FROM (SELECT DISTINCT doc_id, item FROM m) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(items, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN h USING (doc_id) LEFT JOIN t USING (doc_id)"""}
