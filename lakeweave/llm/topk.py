"""Exact top-k inner-product search over an impact-ordered index.

A component is a posting: its impact is its quantised magnitude, and the
postings of a shard lie in segments of equal impact tier, largest first. A
block of queries scores the segments tier by tier. After a tier, what a vector
can still gain or lose is at most the product of the norms of its unscored
part and of the query, which gives every vector a lower and an upper bound;
scoring stops early only when the bounds prove all but a few vectors out of
the top k. Those few are rescored exactly, ties going to the smaller id.

Vectors and queries are dealt into shards and blocks of bounded size, so no
task holds more than one shard and one block, and only k rows a query leave
each of them.

Defined cases: a vector that is NULL, or holds NULL or non-finite components,
or has a NULL id, takes no part; vectors of fewer dimensions count as padded
with zeros; fewer than k candidates give fewer rows; rows that repeat a vec_id
are the same vector to themselves (no query finds its own id), and the best
score of an id counts; scores beyond bigint saturate; further columns are
ignored.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from lakeweave.llm.common import table

#: Vectors in a shard and queries in a block, about.
SHARD, BLOCK = 8192, 1024
TIERS = 4
#: Exact rescoring starts once this share of a shard, or less, may be in the top k.
FEW = 0.02


def quantised(vectors: DataFrame, scale: int = 64) -> DataFrame:
    """(vec_id, v array<bigint>) of the vectors that take part."""
    x = F.col("embedding")
    fine = F.coalesce(F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) != float("inf"))), F.lit(False))
    return (vectors.select(F.col("vec_id").cast("bigint").alias("vec_id"), "embedding").where(F.col("vec_id").isNotNull() & fine)
            .select("vec_id", F.transform(x, lambda c: F.floor(F.lit(float(scale)) * c.cast("double"))).alias("v")))


def matrix(column, width: int) -> np.ndarray:
    """Rows of an Arrow list column as int64, padded to ``width`` with zeros."""
    a = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    sizes = np.diff(a.offsets.to_numpy())
    out = np.zeros((len(a), width), np.int64)
    out[np.arange(width) < sizes[:, None]] = a.flatten().to_numpy()
    return out


class ImpactIndex:
    """The posting segments of one shard, by impact tier."""

    def __init__(self, ids: np.ndarray, x: np.ndarray, tiers: int = TIERS):
        order = np.argsort(ids, kind="stable")
        self.ids, self.x = ids[order], x[order]
        size = np.abs(self.x)
        edges = np.unique(np.quantile(size, np.linspace(0, 1, tiers + 1)[1:-1], method="higher")) if size.size else []
        self.bounds = [*sorted((int(e) for e in edges), reverse=True), 0]
        #: repeated ids take room in a shard's list, so it is longer by that factor
        self.repeats = int(np.unique(ids, return_counts=True)[1].max()) if len(ids) else 1

    def top(self, qids: np.ndarray, q: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(row of q, vec_id, score) of each query's best k in this shard."""
        x, keep = self.x, k * self.repeats
        most = float(np.abs(q).max(initial=0)) * float(np.abs(x).max(initial=0)) * max(1, x.shape[1])
        kind = np.float32 if most < 2**24 else np.float64 if most < 2**53 else object
        if kind is object:
            return self._rescored(qids, q.astype(object), np.ones((len(q), len(x)), bool), keep)
        weights, total = q.astype(kind), np.zeros((len(q), len(x)), kind)
        norm = np.sqrt((q.astype(np.float64) ** 2).sum(1))
        left, alive = np.abs(x), None
        for bound in self.bounds:
            now = left >= bound if bound else np.ones_like(left, bool)
            segment = np.where(now & (left > 0), x, 0)
            total += weights @ segment.T.astype(kind)
            left = np.where(now, 0, left)
            slack = np.sqrt((left.astype(np.float64) ** 2).sum(1)) * (1 + 1e-9) + 1e-6
            reach = norm[:, None] * slack[None, :] if left.any() else 0.0
            low = total - reach
            low[qids[:, None] == self.ids[None, :]] = -np.inf
            if len(x) > keep:
                kth = np.partition(low, len(x) - keep - 1, axis=1)[:, len(x) - keep - 1:].min(1)
                alive = total + reach >= kth[:, None]
            else:
                alive = np.ones(total.shape, bool)
            if not left.any() or alive.mean() <= max(FEW, 2 * keep / len(x)):
                break
        return self._rescored(qids, q, alive, keep)

    def _rescored(self, qids, q, alive, keep):
        rows, ids, scores = [], [], []
        for i in range(len(q)):
            member = np.flatnonzero(alive[i] & (self.ids != qids[i]))
            exact = self.x[member] @ q[i]
            if exact.dtype == object:
                exact = np.clip(exact, -(1 << 63) + 1, (1 << 63) - 1).astype(np.int64)
            best = np.lexsort((self.ids[member], -exact))[:keep]
            rows.append(np.full(len(best), i))
            ids.append(self.ids[member[best]])
            scores.append(exact[best])
        return np.concatenate(rows), np.concatenate(ids), np.concatenate(scores)


def top_k(vectors: DataFrame, is_query: Callable, k: int = 20, scale: int = 64, shard: int = SHARD, block: int = BLOCK) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` best inner products of each
    query (the rows where ``is_query(vec_id)``) among all other vectors."""
    v = quantised(vectors, scale)
    n, width, asked = v.agg(F.count(F.lit(1)), F.max(F.size("v")), F.count(F.when(is_query(F.col("vec_id")), 1))).first()
    width = max(1, width or 0)
    shards = max(1, -(-n // shard))
    blocks = max(1, -(-asked // block))
    deal = lambda many, seed: F.pmod(F.xxhash64("vec_id", F.lit(seed)), F.lit(many)).cast("int")
    each = lambda many: F.explode(F.sequence(F.lit(0), F.lit(many - 1)))
    left = v.select(deal(shards, 1).alias("s"), each(blocks).alias("b"), "vec_id", "v")
    right = v.where(is_query(F.col("vec_id"))).select(each(shards).alias("s"), deal(blocks, 2).alias("b"), "vec_id", "v")

    def run(vecs: pa.Table, queries: pa.Table) -> pa.Table:
        schema = pa.schema([("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.int64())])
        if not vecs.num_rows or not queries.num_rows:
            return schema.empty_table()
        index = ImpactIndex(vecs.column("vec_id").to_numpy(), matrix(vecs.column("v"), width))
        qids = queries.column("vec_id").to_numpy()
        row, ids, score = index.top(qids, matrix(queries.column("v"), width), k)
        return pa.Table.from_arrays([pa.array(qids[row]), pa.array(ids), pa.array(score.astype(np.int64))], schema=schema)

    found = (left.groupBy("s", "b").cogroup(right.groupBy("s", "b"))
             .applyInArrow(run, "query_id bigint, vec_id bigint, score bigint"))
    best = found.repartition("query_id").groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))


def op8_topk_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_k(table(spark, sf_dir, "embeddings"), lambda i: i % 20 == 0)


QUERIES = {"op8_topk_search": op8_topk_search}

ORACLE = {"op8_topk_search": """
WITH v AS (
  SELECT CAST(vec_id AS BIGINT) AS vec_id, list_transform(embedding, lambda x: floor(64 * CAST(x AS DOUBLE))) AS e FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.e, c.e) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id % 20 = 0 AND q.vec_id <> c.vec_id),
r AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 20"""}
