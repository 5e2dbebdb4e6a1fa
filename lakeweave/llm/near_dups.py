"""Near-duplicate documents by MinHash banding.

A document's set is its distinct word shingles, hashed to 64 bits. ``BANDS`` x
``ROWS`` minima of universal (multiply-add-shift) hash functions are banded: a
pair at the threshold of 0.8 shares no band with probability (1 - 0.8^4)^32,
5 in 100 million. Documents of equal sets are one node. Bucket members are
compared by a byte of each minimum first, then by the full sets of the words
themselves; links make components (see ``linking``).

Defined cases: a NULL text, or one without words, has no set and is linked with
nothing; rows that share a doc_id are one node; a NULL doc_id forms no link and
is kept; equal sets under several ids belong to the smallest; an empty table
gives no rows; further columns are kept by ``keep_one`` and ignored otherwise.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from lakeweave.llm.common import LOWER, SPACE, U64, byte_view, cut, mix, run_hashes, ship, slices, small, table, word_runs
from lakeweave.llm.linking import linked

BANDS, ROWS = 32, 4
#: Of the BANDS * ROWS signature bytes, a pair is compared in full from this
#: many equal ones on; at a similarity of 0.8, 102 are expected (deviation 4.5).
AGREE = 82
#: Minima, and equal ones, of the longer signatures that tell apart the members
#: of a bucket that ended in different components (410 expected, deviation 9).
MORE, MORE_AGREE = 512, 369
#: Shares of a union, in per cent, from which two documents are linked.
SIMILAR = 80
#: Bytes of text whose shingles are computed at once in a task, and shingles whose hash functions are.
PART_BYTES, AT_ONCE = 1 << 18, 512

_SEED = np.random.default_rng(8271)
_A = _SEED.integers(1, 1 << 63, BANDS * ROWS + MORE, dtype=np.uint64) * U64(2) + U64(1)
_B = _SEED.integers(0, 1 << 63, BANDS * ROWS + MORE, dtype=np.uint64) * U64(2)
#: Hash functions of the banded, and of the longer signatures.
BANDED, LONGER = slice(0, BANDS * ROWS), slice(BANDS * ROWS, None)
_C = _SEED.integers(1, 1 << 63, 64, dtype=np.uint64) * U64(2) + U64(1)


def shingle_hashes(data: np.ndarray, offsets: np.ndarray, words: int):
    """(hashes, first of each text): one hash for each run of ``words`` words,
    or one for all words of a text that has fewer."""
    low = LOWER[data]
    starts, ends, first = word_runs(~SPACE[low], offsets)
    h = run_hashes(low, starts, ends)
    n = np.diff(first)
    many = np.where(n >= words, n - words + 1, np.minimum(n, 1))
    out_first = np.concatenate(([0], np.cumsum(many)))
    at = np.arange(int(out_first[-1])) + np.repeat(first[:-1] - out_first[:-1], many)
    length = np.repeat(np.minimum(n, words), many)
    total = length.astype(U64) * _C[63]
    padded = np.concatenate((h, np.zeros(words, U64)))
    for k in range(words):
        total += np.where(k < length, padded[at + k] * _C[k % 63] ^ (padded[at + k] >> U64(7 + k % 31)), U64(0))
    return mix(total), out_first


def signature(shingles: np.ndarray, which: slice = BANDED) -> np.ndarray:
    """Minima of the hash functions over the low 32 bits of the shingles."""
    x, a, b = shingles & U64(0xFFFFFFFF), _A[which, None], _B[which, None]
    best = np.full(len(a), 0xFFFFFFFFFFFFFFFF, U64)
    for i in range(0, len(x), AT_ONCE):
        part = a * x[None, i:i + AT_ONCE]
        part += b
        np.minimum(best, part.min(1), out=best)
    return best >> U64(32)  # the least number has the least upper half


def signed(docs: DataFrame, text_col: str = "text", words: int = 4) -> DataFrame:
    """(doc_id, n_shingles, d1, d2, payload, buckets) of every document."""
    def run(batches):
        for b in batches:
            data, offs = byte_view(b.column(1))
            for i, j in slices(offs, PART_BYTES):
                rows: list[tuple] = []
                h, first = shingle_hashes(data[offs[i]:offs[j]], offs[i:j + 1] - offs[i], words)
                for k in range(j - i):
                    u = np.unique(h[first[k]:first[k + 1]])
                    if not len(u):
                        rows.append((0, 0, 0, b"", []))
                        continue
                    s = signature(u)
                    band = s.reshape(BANDS, ROWS)
                    key = np.arange(BANDS, dtype=U64) * _C[0]
                    for r in range(ROWS):
                        key = mix(key ^ (band[:, r] + _C[r + 1]))
                    digest = (mix(u).sum(), mix(u ^ _C[2]).sum())
                    rows.append((len(u), *(int(np.int64(d)) for d in np.array(digest, U64).view(np.int64)), mix(s).astype(np.uint8).tobytes(), key.view(np.int64)))
                kinds = (pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.list_(pa.int64()))
                yield pa.RecordBatch.from_arrays([b.column(0).slice(i, j - i), *(pa.array(list(c), t) for c, t in zip(zip(*rows), kinds))],
                                                 names=["doc_id", "n_shingles", "d1", "d2", "payload", "buckets"])

    return docs.select("doc_id", text_col).mapInArrow(run, "doc_id bigint, n_shingles bigint, d1 bigint, d2 bigint, payload binary, buckets array<bigint>")


def alike(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    same = (a == b).sum(1)
    return np.where(same >= AGREE, same, -1)


def longer(nodes: DataFrame, docs: DataFrame, text_col: str, words: int) -> DataFrame:
    """(node, payload): signatures of ``MORE`` minima of the given documents."""
    def run(batches):
        for b in batches:
            data, offs = byte_view(b.column(1))
            out = []
            for i, j in slices(offs, PART_BYTES):
                h, first = shingle_hashes(data[offs[i]:offs[j]], offs[i:j + 1] - offs[i], words)
                out += [mix(signature(h[first[k]:first[k + 1]], LONGER)).astype(np.uint8).tobytes() for k in range(j - i)]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(out, pa.binary())], names=["node", "payload"])

    ids = small(cut(nodes, "contested-ids"), 200_000)
    return (docs.select(F.col("doc_id").alias("node"), text_col).join(ids, "node", "left_semi")
            .mapInArrow(run, "node bigint, payload binary")
            # rows that share an id: any of their signatures, but always the same one
            .groupBy("node").agg(F.min("payload").alias("payload")))


def alike_for_sure(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    same = (a == b).sum(1)
    return np.where(same >= MORE_AGREE, same, -1)


def word_set(text: str, words: int) -> set:
    w = text.encode().lower().split()
    return set(zip(*(w[k:] for k in range(words)))) if len(w) >= words else {tuple(w)} if w else set()


def similar(pairs: DataFrame, docs: DataFrame, text_col: str, words: int) -> DataFrame:
    """The pairs (a, b) whose full word sets share ``SIMILAR`` per cent."""
    pairs = cut(pairs, "candidates")
    ids = pairs.select(F.col("a").alias("doc_id")).unionByName(pairs.select(F.col("b").alias("doc_id"))).distinct()
    texts = docs.select("doc_id", F.col(text_col).alias("t")).join(small(cut(ids, "candidate-ids"), 200_000), "doc_id", "left_semi")
    # ends up sorted by a, which many pairs share
    both = (pairs.join(texts.select(F.col("doc_id").alias("b"), F.col("t").alias("tb")), "b")
            .join(texts.select(F.col("doc_id").alias("a"), F.col("t").alias("ta")), "a").select("a", "b", "ta", "tb"))

    def check(batches):
        last, mine = None, set()
        for b in batches:
            ok = []
            for ta, tb in zip(b.column(2), b.column(3)):
                if (ta := ta.as_py()) != last:
                    last, mine = ta, word_set(ta or "", words)
                other = word_set(tb.as_py() or "", words)
                same = len(mine & other)
                ok.append(same > 0 and 100 * same >= SIMILAR * (len(mine) + len(other) - same))
            yield pa.RecordBatch.from_arrays([b.column(0).filter(pa.array(ok, pa.bool_())), b.column(1).filter(pa.array(ok, pa.bool_()))], names=["a", "b"])

    return both.mapInArrow(check, "a bigint, b bigint").distinct()


def groups(docs: DataFrame, text_col: str = "text", words: int = 4) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) of every document."""
    ship(docs.sparkSession)
    docs = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col(text_col).alias(text_col))
    base = cut(signed(docs, text_col, words), "signatures")
    real = base.where("n_shingles > 0 and doc_id is not null")
    sets = cut(real.groupBy("d1", "d2").agg(F.min("doc_id").alias("node")), "sets")
    full = real.join(sets, (real.d1 == sets.d1) & (real.d2 == sets.d2) & (real.doc_id == sets.node)).select("node", real.d1, real.d2, "payload", "buckets")
    full = full.dropDuplicates(["d1", "d2"])
    members = full.select(F.explode("buckets").alias("bucket"), "node").distinct()
    comp = linked(full.select("node", "payload"), members, alike, lambda pairs: similar(pairs, docs, text_col, words),
                  lambda ids: longer(ids, docs, text_col, words), alike_for_sure)
    # a set's component, and a document's through its set; a repeated id joins its sets
    owner = real.select("doc_id", "d1", "d2").join(sets, ["d1", "d2"]).select("doc_id", "node").distinct()
    comp = cut(owner.join(comp, "node", "left").select("doc_id", F.coalesce("component", "node").alias("component_id"))
               .groupBy("doc_id").agg(F.min("component_id").alias("component_id")), "near-dups")
    return (base.select("doc_id", "n_shingles").join(comp, "doc_id", "left")
            .select("doc_id", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id"))
            .withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True))))


def keep_one(docs: DataFrame, text_col: str = "text", words: int = 5) -> DataFrame:
    """``docs`` with one document of each component, the smallest doc_id."""
    gone = groups(docs, text_col, words).where(~F.col("kept")).select(F.col("doc_id").alias("gone")).distinct()
    return docs.join(gone, docs["doc_id"] == gone["gone"], "left_anti")


def op2_near_dups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return groups(table(spark, sf_dir, "documents"))


QUERIES = {"op2_near_dups": op2_near_dups}

ORACLE = {"op2_near_dups": r"""
WITH RECURSIVE d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
  FROM documents),
s AS (SELECT DISTINCT doc_id, CASE WHEN len(w) < 4 THEN array_to_string(w, ' ') ELSE array_to_string(w[i:i + 3], ' ') END AS g
      FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 2, 2))) AS i FROM d WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM s a JOIN s b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY a.doc_id, b.doc_id),
e AS (SELECT p.a, p.b FROM p JOIN n x ON x.doc_id = p.a JOIN n y ON y.doc_id = p.b WHERE 100 * c >= 80 * (x.n + y.n - c)),
r(doc_id, reach) AS (SELECT doc_id, doc_id FROM d UNION SELECT e.a, r.reach FROM r JOIN e ON e.b = r.doc_id),
k AS (SELECT doc_id, min(reach) AS component_id FROM r GROUP BY doc_id)
SELECT d.doc_id, CAST(coalesce(n.n, 0) AS BIGINT) AS n_shingles, component_id, d.doc_id = component_id AS kept
FROM d JOIN k USING (doc_id) LEFT JOIN n USING (doc_id)"""}
