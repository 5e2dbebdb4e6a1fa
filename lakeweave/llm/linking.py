"""Links between nodes that share a bucket, and their connected components.

``components`` alternates large-star and small-star until the edges stay the
same. ``linked`` finds the components of "shares a bucket and is confirmed"
without listing a bucket's pairs. Members are dealt into cells of bounded size;
the edges of each cell's maximum spanning forest by closeness are confirmed.
Where that leaves one bucket's members in more than one component, only members
of different components are compared, again in cells, so every pair that shares
a bucket is either compared or already connected.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from lakeweave.llm.common import Runs, cut

#: Members of one side of a cell, about.
CELL = 512
#: Bytes of cells whose spanning forests grow together.
RUN_BYTES = 1 << 22

#: Closeness of the rows of two payload matrices; negative: they can't be linked.
Close = Callable[[np.ndarray, np.ndarray], np.ndarray]
#: Of texts, payloads and the pairs of rows i, j of both: 1 where they are linked, 0 where not, -1 where that isn't known.
Sure = Callable[[pa.Array, np.ndarray, np.ndarray, np.ndarray], np.ndarray]
#: Pairs of a task that are confirmed at once, at least.
TOGETHER = 4096


def components(edges: DataFrame) -> DataFrame:
    """(node, component): the least node reachable over ``edges`` (src, dst),
    for every node that has an edge to another."""
    e = cut(edges.where(F.col("src") != F.col("dst")).select(F.greatest("src", "dst").alias("v"), F.least("src", "dst").alias("m")).distinct(), "edges")
    seen = None
    while True:
        state = e.agg(F.count(F.lit(1)), F.sum(F.xxhash64("v", "m").cast("decimal(20,0)"))).first()
        if state == seen:
            break
        seen = state
        # large star: every larger neighbour moves to the least of the neighbourhood
        both = e.select(F.col("v").alias("u"), F.col("m").alias("w")).unionByName(e.select(F.col("m").alias("u"), F.col("v").alias("w")))
        least = both.groupBy("u").agg(F.min("w").alias("least")).select("u", F.least("u", "least").alias("least"))
        large = both.where("w > u").join(least, "u").select(F.col("w").alias("v"), F.col("least").alias("m")).distinct()
        # small star: a node and its smaller neighbours move to the least of these
        least = large.groupBy("v").agg(F.min("m").alias("least"))
        down = large.join(least, "v")
        e = cut(down.select(F.col("m").alias("v"), F.col("least").alias("m")).where("v <> m")
                .unionByName(least.select("v", F.col("least").alias("m"))).distinct(), "edges")
    return e.select(F.col("v").alias("node"), F.col("m").alias("component")).unionByName(
        e.select(F.col("m").alias("node"), F.col("m").alias("component")).distinct())


def payloads(column) -> np.ndarray:
    """Rows of an Arrow column of equally long binaries."""
    a = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    offs = np.frombuffer(a.buffers()[1], np.int32)[a.offset:a.offset + len(a) + 1]
    return np.frombuffer(a.buffers()[2], np.uint8)[offs[0]:offs[-1]].reshape(len(a), -1) if len(a) else np.zeros((0, 1), np.uint8)


def spanning(cells: DataFrame, close: Close) -> DataFrame:
    """The edges of a maximum spanning forest over each cell's members (cell,
    node, payload), weighted by closeness: at most one edge a member."""
    def run(batches):
        for t in gathered(Runs(batches, "cell")):
            cell, node, data = t.column("cell").to_numpy(), t.column("node").combine_chunks(), payloads(t.column("payload"))
            ends = forest(cell, data, close)
            yield pa.RecordBatch.from_arrays([node.take(pa.array(k)) for k in ends], names=["a", "b"])

    kind = cells.schema["node"].dataType.simpleString()
    return cells.repartition("cell").sortWithinPartitions("cell").mapInArrow(run, f"a {kind}, b {kind}")


def gathered(tables: Iterable[pa.Table]) -> Iterator[pa.Table]:
    """The tables, several of them as one of about ``RUN_BYTES``."""
    some = []
    for t in tables:
        some.append(t)
        if sum(x.nbytes for x in some) >= RUN_BYTES:
            yield pa.concat_tables(some)
            some = []
    if some:
        yield pa.concat_tables(some)


def forest(cell: np.ndarray, data: np.ndarray, close: Close) -> tuple[np.ndarray, np.ndarray]:
    """Ends of the edges of a maximum spanning forest of each cell; ``cell`` is
    sorted. All cells grow by a member a step, the larger ones for longer."""
    first = np.flatnonzero(np.concatenate(([True], cell[1:] != cell[:-1]))) if len(cell) else np.zeros(0, np.int64)
    size = np.diff(np.concatenate((first, [len(cell)])))
    order = np.argsort(-size, kind="stable")
    size, first = size[order], first[order]
    lead = np.cumsum(size) - size
    rows = np.arange(len(cell)) - np.repeat(lead - first, size)
    data = data[rows]
    # a member's place in its cell, so that of equally near ones the first is taken
    place = np.arange(len(cell)) - np.repeat(lead, size)
    best, parent = np.full(len(cell), -1), np.zeros(len(cell), np.int64)
    v, a, b = lead.copy(), [], []
    for step in range(1, int(size[0]) if len(size) else 0):
        cells = int(np.searchsorted(-size, -step, "left"))  # those of more members than steps
        n = int(lead[cells - 1] + size[cells - 1])
        best[v[:cells]] = -2  # in the forest
        at = np.repeat(v[:cells], size[:cells])
        w = close(data[at], data[:n])
        nearer = np.flatnonzero((best[:n] > -2) & (w > best[:n]))
        best[nearer], parent[nearer] = w[nearer], at[nearer]
        top = np.maximum.reduceat(((best[:n] + 2) << 32) - place[:n], lead[:cells])
        v[:cells] = lead[:cells] + (-top & 0xFFFFFFFF)
        new = v[:cells][best[v[:cells]] >= 0]
        a.append(parent[new])
        b.append(new)
    return tuple(rows[np.concatenate([np.zeros(0, np.int64), *x])] for x in (a, b))


def across(cells: DataFrame, close: Close, sure: Sure | None = None) -> DataFrame:
    """Near pairs of different components within each cell of ``cells`` (cell,
    side, bucket, node, component, homes, payload). Two rows of one side are
    not compared (-1 is no side), and of the buckets (``homes``) that a pair
    shares only the least gives it. With ``sure`` the cells also have ``text``:
    pairs are confirmed here, and of those that are linked (sure: true) only the
    ones that join two components of their cell are given, fewer than it has
    members, beside those that are not known (sure: false)."""
    def run(batches):
        for t in Runs(batches, "cell"):
            cell, side = (t.column(c).to_numpy() for c in ("cell", "side"))
            comp = parts(cell, t.column("component").to_numpy())
            node, data = t.column("node").combine_chunks(), payloads(t.column("payload"))
            text = t.column("text").combine_chunks() if sure else None
            bucket, homes = t.column("bucket").to_numpy(), [frozenset(x) for x in t.column("homes").to_pylist()]
            left, lag, wait, waiting = np.arange(len(cell)), 1, [], 0
            while True:
                left = left[left < len(cell) - lag]
                left = left[cell[left] == cell[left + lag]]
                if len(left):
                    i = left[(comp[left] != comp[left + lag]) & ((side[left] != side[left + lag]) | (side[left] < 0))]
                    i = i[close(data[i], data[i + lag]) >= 0]
                    i = i[[min(homes[k] & homes[k + lag]) == bucket[k] for k in i.tolist()]] if len(i) else i
                    if sure is None and len(i):
                        yield pa.RecordBatch.from_arrays([node.take(pa.array(i)), node.take(pa.array(i + lag))], names=["a", "b"])
                    elif len(i):
                        wait.append((i, i + lag))
                        waiting += len(i)
                if waiting >= TOGETHER or waiting and not len(left):
                    i, j = (np.concatenate(x) for x in zip(*wait))
                    wait, waiting = [], 0
                    apart = comp[i] != comp[j]
                    i, j = i[apart], j[apart]
                    said = sure(text, data, i, j)
                    comp, new = joining(comp, i, j, np.flatnonzero(said > 0))
                    new = np.concatenate((new, np.flatnonzero(said < 0)))
                    yield pa.RecordBatch.from_arrays([node.take(pa.array(i[new])), node.take(pa.array(j[new])), pa.array(said[new] > 0)],
                                                     names=["a", "b", "sure"])
                if not len(left):
                    break
                lag += 1

    kind = cells.schema["node"].dataType.simpleString()
    return cells.repartition("cell").sortWithinPartitions("cell").mapInArrow(run, f"a {kind}, b {kind}" + (", sure boolean" if sure else ""))


def parts(cell: np.ndarray, component: np.ndarray) -> np.ndarray:
    """Numbers from 0 of the components of each cell; ``cell`` is sorted."""
    order = np.lexsort((component, cell))
    c, k = cell[order], component[order]
    out = np.empty(len(cell), np.int64)
    out[order] = np.cumsum(np.concatenate(([False], (c[1:] != c[:-1]) | (k[1:] != k[:-1])))) if len(cell) else 0
    return out


def joining(comp: np.ndarray, i: np.ndarray, j: np.ndarray, linked: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The components after the links i[k]-j[k], k of ``linked``, and those k that joined two."""
    up, new = np.arange(int(comp.max()) + 1), []

    def top(x):
        while up[x] != x:
            up[x] = x = up[up[x]]
        return x
    for k, x, y in zip(linked.tolist(), comp[i[linked]].tolist(), comp[j[linked]].tolist()):
        x, y = top(x), top(y)
        if x != y:
            up[max(x, y)] = min(x, y)
            new.append(k)
    while (up != up[up]).any():
        up = up[up]
    return up[comp], np.array(new, np.int64)


def linked(nodes: DataFrame, members: DataFrame, close: Close, confirm: Callable[[DataFrame], DataFrame],
           refine: Callable[[DataFrame], DataFrame] | None = None, closer: Close | None = None, sure: Sure | None = None,
           prepare: Callable[[DataFrame], None] | None = None) -> DataFrame:
    """(node, component) of all nodes linked to another. ``nodes``: (node,
    payload), one row each; ``members``: (bucket, node); ``confirm``: those of
    the pairs (a, b) that are linked. ``refine`` may give the nodes of the
    second comparison a longer payload, which ``closer`` compares, or (node,
    payload, text), of which ``sure`` confirms pairs where they are compared:
    unlike members of large buckets are then never listed as pairs. ``prepare``
    is first called with the nodes that share a bucket."""
    # shuffled once: counted with the same columns as they are met by
    members = members.repartition("bucket")
    shared = members.groupBy("bucket").agg(F.count("node").alias("n")).where("n > 1")
    m = cut(members.join(shared, "bucket").select("bucket", "node", "n"), "members")
    if prepare:
        prepare(m.select("node").distinct())
    ordered = lambda pairs: pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    part = F.pmod(F.xxhash64("node", "bucket"), F.ceil(F.col("n") / CELL))
    cells = m.select(F.xxhash64("bucket", part).alias("cell"), "node").join(nodes.select("node", "payload"), "node")
    tried = cut(ordered(spanning(cells.select("cell", "node", "payload"), close)), "pairs")
    comp = cut(components(confirm(tried).select(F.col("b").alias("src"), F.col("a").alias("dst"))), "components")

    # buckets whose members are not in one component (a pair alone has been compared)
    lab = m.where("n > 2").join(comp, "node", "left").select("bucket", "node", F.coalesce("component", "node").alias("component"))
    per = lab.groupBy("bucket", "component").agg(F.count(F.lit(1)).alias("k"))
    split = (per.groupBy("bucket").agg(F.sum("k").alias("n"), F.max(F.struct("k", "component")).alias("most"), F.count(F.lit(1)).alias("parts"))
             .where("parts > 1").select("bucket", F.col("most.component").alias("most"), F.ceil((F.col("n") - F.col("most.k")) / CELL).cast("int").alias("few"),
                                        F.ceil(F.col("most.k") / CELL).cast("int").alias("many")))
    rows = lab.join(split, "bucket").select("bucket", "node", "component", (F.col("component") == F.col("most")).alias("main"), "few", "many")
    rows = rows.withColumn("at", F.pmod(F.xxhash64("node", "bucket"), F.when(F.col("main"), F.col("many")).otherwise(F.col("few"))).cast("int"))
    upto = lambda c: F.sequence(F.lit(0), F.col(c) - 1)
    with_main = lambda i, j: F.xxhash64("bucket", F.lit(0), i, j)
    with_few = lambda i, j: F.xxhash64("bucket", F.lit(1), F.least(i, j), F.greatest(i, j))
    # a pair meets in one cell alone: on two sides of it, or, if of one part of the few, beside the first part of the main
    at = lambda cell, side: F.struct(cell.alias("cell"), side.cast("int").alias("side"))
    cells = F.when(F.col("main"), F.transform(upto("few"), lambda i: at(with_main(i, F.col("at")), F.lit(0)))).otherwise(
        F.concat(F.transform(upto("many"), lambda j: at(with_main(F.col("at"), j), F.when(j == 0, -1).otherwise(1))),
                 F.transform(F.filter(upto("few"), lambda j: j != F.col("at")), lambda j: at(with_few(F.col("at"), j), F.col("at")))))
    rows = cut(rows.select(cells.alias("cells"), "bucket", "node", "component"), "contested")
    homes = rows.groupBy("node").agg(F.collect_set("bucket").alias("homes"))
    longer = nodes.select("node", "payload") if refine is None else refine(rows.select("node").distinct())
    cells = (rows.select(F.explode("cells").alias("c"), "bucket", "node", "component").select("c.cell", "c.side", "bucket", "node", "component")
             .join(homes.join(longer, "node"), "node"))
    rest = across(cells, closer or close, sure)
    if sure:
        rest = cut(rest, "crossings")
        known, rest = rest.where("sure").select("a", "b"), rest.where("not sure")
    second = confirm(ordered(rest).join(tried, ["a", "b"], "left_anti"))
    second = (second.unionByName(known) if sure else second).select(F.col("b").alias("src"), F.col("a").alias("dst"))
    return components(comp.select(F.col("node").alias("src"), F.col("component").alias("dst")).unionByName(second))
