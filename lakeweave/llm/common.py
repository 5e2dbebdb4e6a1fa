"""Helpers shared by the training-data operators: written cuts of lineage,
Arrow text columns as numpy byte views, and vectorised word hashing."""

from __future__ import annotations

import os
import tempfile
import zipfile
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, functions as F

from lakeweave.session import shared_dir

#: Bytes of text handled at once inside a task (one longer text is one slice).
SLICE_BYTES = 1 << 21

#: Session setting, and bytes of a record batch between Spark and its Python workers: both
#: sides of a task hold some of them, Spark's default allows 64 MB each.
BATCH_SETTING, BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch", "4m"

U64 = np.uint64


_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Let Python workers import this package where neither PYTHONPATH nor
    the working directory leads to it: Spark sends it along as a zip. Batches
    for the workers get a size, unless the session has set one."""
    import lakeweave
    if BATCH_SETTING not in spark.conf.getAll:
        spark.conf.set(BATCH_SETTING, BATCH_BYTES)
    package = Path(lakeweave.__file__).resolve().parent
    root, app = package.parent, spark.sparkContext.applicationId
    known = [Path.cwd(), *(Path(x) for x in os.environ.get("PYTHONPATH", "").split(os.pathsep) if x)]
    if app in _SHIPPED or root in [p.resolve() for p in known]:
        return
    _SHIPPED.add(app)
    path = os.path.join(tempfile.mkdtemp(prefix="lakeweave-zip-"), "lakeweave.zip")
    with zipfile.ZipFile(path, "w") as z:
        for f in sorted(package.rglob("*.py")):
            z.write(f, f.relative_to(root))
    spark.sparkContext.addPyFile(path)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def cut(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: the lineage ends
    here, and a lost executor costs a re-read instead of a re-run."""
    ship(df.sparkSession)
    path = shared_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def small(df: DataFrame, rows: int) -> DataFrame:
    """``df`` marked for broadcast if it was counted to hold at most ``rows``
    rows; larger tables are returned as they are and join by shuffle."""
    return F.broadcast(df) if df.limit(rows + 1).count() <= rows else df


def free(name: str, taken: set[str]) -> str:
    """``name``, with underscores before it until none of ``taken`` (lower-case) is like it."""
    while name.lower() in taken:
        name = "_" + name
    return name


def as_text(column) -> pa.Array:
    """An Arrow text column with nulls as empty texts, in one chunk."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return pc.fill_null(column, "") if column.null_count else column


def byte_view(column) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of an Arrow text column; nulls are empty."""
    a = as_text(column)
    kind = np.int64 if pa.types.is_large_string(a.type) else np.int32
    bufs = a.buffers()
    offs = np.frombuffer(bufs[1], kind)[a.offset:a.offset + len(a) + 1].astype(np.int64) if len(a) else np.zeros(1, np.int64)
    data = np.frombuffer(bufs[2], np.uint8)[offs[0]:offs[-1]] if bufs[2] is not None else np.zeros(0, np.uint8)
    return data, offs - offs[0]


def slices(offsets: np.ndarray, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges of at most ``limit`` bytes each (one row at least)."""
    i, n = 0, len(offsets) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + limit, "right")) - 1)
        yield i, min(j, n)
        i = min(j, n)


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (the published splitmix64 constants)."""
    x = (x ^ (x >> U64(30))) * U64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U64(27))) * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True

#: Random value of (position in word modulo 64, byte); a word's hash is the sum.
_TABULATION = np.random.default_rng(20240229).integers(0, 1 << 63, 64 * 256, dtype=np.uint64) * U64(2) + U64(1)
_STEP = U64(0x9E3779B97F4A7C15)


def word_runs(is_word: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of maximal runs of word bytes that don't cross text
    boundaries, and the number of runs that start before each text."""
    n = len(is_word)
    if n == 0:
        z = np.zeros(0, np.int64)
        return z, z, np.zeros(len(offsets), np.int64)
    first = np.zeros(n + 1, bool)
    first[offsets] = True
    prev = np.empty(n, bool)
    prev[0] = False
    prev[1:] = is_word[:-1]
    starts = np.flatnonzero(is_word & (~prev | first[:n]))
    nxt = np.empty(n, bool)
    nxt[-1] = False
    nxt[:-1] = is_word[1:]
    ends = np.flatnonzero(is_word & (~nxt | first[1:])) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def run_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of the byte runs ``data[starts[i]:ends[i]]`` (none empty)."""
    if len(starts) == 0:
        return np.zeros(0, U64)
    size = ends - starts
    begin = np.concatenate(([0], np.cumsum(size)[:-1]))
    many = int(size.sum())
    # places in narrow types: this is most of what a task's text work moves
    kind = np.int32 if max(many, len(data)) < 1 << 31 else np.int64
    at = np.arange(many, dtype=kind)
    pos = at - np.repeat(begin.astype(kind), size)
    chars = data if many == len(data) else data[at + np.repeat((starts - begin).astype(kind), size)]
    value = _TABULATION[(pos & 63).astype(np.uint16) << np.uint16(8) | chars]
    if int(size.max()) > 64:
        far = np.flatnonzero(pos >= 64)
        value[far] *= mix((pos[far] >> 6).astype(U64) * _STEP) | U64(1)
    return mix(np.add.reduceat(value, begin) + size.astype(U64) * _STEP)


class Runs:
    """Regroups a stream of record batches sorted by a key into batches that
    hold whole groups (the last group waits for the next batch)."""

    def __init__(self, batches, key: str):
        self.batches, self.key = batches, key

    def __iter__(self) -> Iterator[pa.Table]:
        rest = None
        for b in self.batches:
            t = pa.Table.from_batches([b])
            if rest is not None:
                t = pa.concat_tables([rest, t])
            if t.num_rows == 0:
                continue
            keys = t.column(self.key).to_numpy()
            change = np.flatnonzero(keys[1:] != keys[:-1])
            if len(change) == 0:
                rest = t
                continue
            at = int(change[-1]) + 1
            rest = t.slice(at)
            yield t.slice(0, at).combine_chunks()
        if rest is not None and rest.num_rows:
            yield rest.combine_chunks()
