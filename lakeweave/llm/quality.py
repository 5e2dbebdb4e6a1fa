"""Quality classifier: nearest-neighbour voting over latent-semantic vectors.

A text's terms are its trigrams of byte classes (letters, digits, marks,
symbols, line ends, ...), weighted by log frequency and inverse document
frequency, beside shares of repeated words, repeated lines, capitals and marks.
A truncated SVD, fitted on the labelled texts drawn as neighbours, turns terms
into latent vectors. At most ``NEIGHBOURS`` labelled vectors are broadcast;
every document's cosine with each of them is an exact product, computed in
blocks, and the ``K`` nearest vote by powers of their similarity.

Only labels of rows whose crc32(doc_id as text) mod 3 is not 1 are learnt
from. Ids, languages, sources and labels are never part of a vector.

Defined cases: a NULL text counts as empty; an empty text has no neighbours and
scores the labels' prior; without labels every score is 0.5 (kept); a labelled
id that occurs twice is one neighbour, and its labels are averaged; NULL labels
and NULL ids are not learnt from; a NULL doc_id is not held out; repeated rows
each keep their row; an empty table gives no rows; input columns named
``held_out``, ``score`` or ``predicted`` are replaced.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from lakeweave.llm.common import SPACE, byte_view, free, run_hashes, ship, slices, table, word_runs

#: Bound on the labelled rows that are fitted on and broadcast (half for each label).
NEIGHBOURS = 4096
DIMENSIONS = 48
K = 15
POWER = 8
#: Weight of the shares beside the trigrams.
SHARES = 1.0

#: Bytes and texts whose features are computed at once in a task.
PART_BYTES, PART_TEXTS = 1 << 18, 256

_N = 12


def _classes() -> np.ndarray:
    c = np.full(256, 11, np.uint8)
    for k, chars in enumerate((" \t", "\n\r", "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789", ".", ",;:", "!?",
                               "#$%&*@^~+=<>", "|", "\"'()[]{}-_/\\")):
        c[list(chars.encode())] = k
    c[0x80:] = 2  # letters beyond ASCII
    return c


CLASS = _classes()


def parts(offsets: np.ndarray) -> Iterator[tuple[int, int]]:
    """Row ranges of bounded bytes and texts: trigram counts take memory by both."""
    for i, j in slices(offsets, PART_BYTES):
        for k in range(i, j, PART_TEXTS):
            yield k, min(j, k + PART_TEXTS)


def features(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(trigram counts, shares) of each text."""
    n = len(offsets) - 1
    size = np.diff(offsets)
    text_of = np.repeat(np.arange(n), size)
    c = CLASS[data].astype(np.int64)
    if len(c) > 2:
        code = (c[:-2] * _N + c[1:-1]) * _N + c[2:]
        whole = text_of[:-2] == text_of[2:]
        grams = np.bincount((text_of[:-2] * _N**3 + code)[whole], minlength=n * _N**3).reshape(n, _N**3)
    else:
        grams = np.zeros((n, _N**3), np.int64)
    per = lambda flags: np.bincount(text_of[flags], minlength=n)
    letters = per((c == 2) | (c == 3)) + 1.0
    shares = [per(c == 3) / letters, per((c >= 7) & (c <= 9)) / np.maximum(1, size)]
    for is_part in (~SPACE[data], data != 10):
        starts, ends, first = word_runs(is_part, offsets)
        h = run_hashes(data, starts, ends)
        many, of = np.maximum(1, np.diff(first)), np.repeat(np.arange(n), np.diff(first))
        again = (h[1:] == h[:-1]) & (of[1:] == of[:-1]) if len(h) else np.zeros(0, bool)
        shares.append(np.bincount(of[1:][again], minlength=n) / many)
        order = np.lexsort((h, of))
        twin = (h[order][1:] == h[order][:-1]) & (of[order][1:] == of[order][:-1]) if len(h) else np.zeros(0, bool)
        shares.append(np.bincount(of[order][1:][twin], minlength=n) / many)
    return grams, np.stack(shares, 1).astype(np.float32)


class LatentVoter:
    """Latent vectors of labelled texts, and the vote of the nearest."""

    def __init__(self, grams: np.ndarray, shares: np.ndarray, labels: np.ndarray, dims: int, k: int):
        self.labels, self.k = labels.astype(np.float32), k
        self.prior = float(labels.mean()) if len(labels) else 0.5
        seen = (grams > 0).sum(0)
        self.idf = np.where(seen > 0, np.log((1 + len(grams)) / (1 + seen)) + 1, 0).astype(np.float32)
        terms = self.terms(grams, shares)
        if len(terms):
            values, vectors = np.linalg.eigh(terms.T @ terms)
            self.basis = np.ascontiguousarray(vectors[:, np.argsort(-values)[:dims]].astype(np.float32))
            self.known = self.latent(terms)

    def terms(self, grams: np.ndarray, shares: np.ndarray) -> np.ndarray:
        x = np.log1p(grams).astype(np.float32) * self.idf
        size = np.linalg.norm(x, axis=1, keepdims=True)
        x = np.divide(x, size, out=np.zeros_like(x), where=size > 0)
        return np.concatenate((x, np.where(size > 0, SHARES * shares, 0).astype(np.float32)), axis=1)

    def latent(self, terms: np.ndarray) -> np.ndarray:
        z = terms @ self.basis
        size = np.linalg.norm(z, axis=1, keepdims=True)
        return np.divide(z, size, out=np.zeros_like(z), where=size > 0)

    def score(self, grams: np.ndarray, shares: np.ndarray) -> np.ndarray:
        if not len(self.labels):
            return np.full(len(grams), 0.5)
        # in double precision and rounded: a text's score does not depend on those it is computed with
        near = np.round(self.latent(self.terms(grams, shares).astype(np.float64)) @ self.known.T.astype(np.float64), 9)
        k = min(self.k, near.shape[1])
        best = np.argpartition(near, -k, axis=1)[:, -k:] if k < near.shape[1] else np.tile(np.arange(k), (len(near), 1))
        weight = np.maximum(np.take_along_axis(near, best, 1), 0).astype(np.float64) ** POWER
        votes = (weight * self.labels[best]).sum(1)
        return np.clip((votes + 1e-3 * self.prior) / (weight.sum(1) + 1e-3), 0, 1)


def neighbours(labels: DataFrame, most: int = NEIGHBOURS) -> DataFrame:
    """(doc_id, label) drawn by hash from the rows that may be learnt from,
    at most half of ``most`` for each label."""
    y = (labels.where(F.col("doc_id").isNotNull() & F.col("quality").isNotNull()).where(F.crc32(F.col("doc_id").cast("string")) % 3 != 1)
         .groupBy("doc_id").agg((F.avg("quality") >= 0.5).cast("int").alias("label")))
    half = lambda v: y.where(F.col("label") == v).orderBy(F.xxhash64("doc_id"), "doc_id").limit(most // 2)
    return half(0).unionByName(half(1))


def fit(docs: DataFrame, labels: DataFrame, most: int = NEIGHBOURS, dims: int = DIMENSIONS, k: int = K) -> LatentVoter:
    """Fit on the bounded draw; only its term counts come to the driver."""
    def count(batches):
        for b in batches:
            data, offs = byte_view(b.column(2))
            for i, j in parts(offs):
                grams, shares = features(data[offs[i]:offs[j]], offs[i:j + 1] - offs[i])
                grams = np.minimum(grams, 65535).astype(np.uint16)
                yield pa.RecordBatch.from_arrays([b.column(0).slice(i, j - i), b.column(1).slice(i, j - i),
                                                  pa.array([g.tobytes() for g in grams], pa.binary()),
                                                  pa.array([s.tobytes() for s in shares], pa.binary())], names=["doc_id", "label", "g", "s"])

    drawn = docs.select("doc_id", "text").join(F.broadcast(neighbours(labels, most)), "doc_id").select("doc_id", "label", "text")
    rows = drawn.mapInArrow(count, "doc_id bigint, label int, g binary, s binary")
    # of rows that share an id, always the same one
    rows = rows.groupBy("doc_id").agg(F.min(F.struct("label", "g", "s")).alias("r")).select("doc_id", "r.*").orderBy("doc_id").collect()
    grams = np.frombuffer(b"".join(r.g for r in rows), np.uint16).reshape(len(rows), _N**3)
    shares = np.frombuffer(b"".join(r.s for r in rows), np.float32).reshape(len(rows), -1 if rows else 6)
    return LatentVoter(grams, shares, np.array([r.label for r in rows], np.int32), dims, k)


def voted(docs: DataFrame, labels: DataFrame, name: str, text_col: str = "text", **options) -> DataFrame:
    """``docs`` with the score column ``name``."""
    ship(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(fit(docs, labels, **options))
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema) + f", `{name}` double"

    def vote(batches):
        voter = shared.value
        for b in batches:
            data, offs = byte_view(b.column(b.schema.get_field_index(text_col)))
            scores = [voter.score(*features(data[offs[i]:offs[j]], offs[i:j + 1] - offs[i])) for i, j in parts(offs)]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(np.concatenate(scores) if scores else np.zeros(0))], names=[*b.schema.names, name])

    return docs.mapInArrow(vote, schema)


def score(docs: DataFrame, labels: DataFrame, **options) -> DataFrame:
    """``docs`` with ``held_out``, ``score`` (0 to 1) and ``predicted``."""
    return (voted(docs.drop("held_out", "score", "predicted"), labels, "score", **options)
            .withColumn("predicted", (F.col("score") >= 0.5).cast("int"))
            .withColumn("held_out", F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 3 == 1, F.lit(False))))


def keep_good(docs: DataFrame, labels: DataFrame, **options) -> DataFrame:
    """The documents predicted good, with the columns they came with."""
    name = free("score", {c.lower() for c in docs.columns})
    return voted(docs, labels, name, **options).where(F.col(name) >= 0.5).drop(name)


def op1_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return score(docs, table(spark, sf_dir, "labels")).select("doc_id", "held_out", "score", "predicted")


QUERIES = {"op1_quality": op1_quality}
ORACLE: dict[str, str] = {}
