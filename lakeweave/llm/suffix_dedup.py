"""Removal of repeated byte strings by a difference-cover suffix method.

Only the first ``LENGTH`` bytes of suffixes matter, so suffixes are sorted by
that prefix and equal prefixes are removed but for the first in the order of
(doc_id, position). The steps follow a difference-cover algorithm, with
a cover taken from the content (a string synchronising set) instead of fixed
residues: of every window of ``LENGTH`` bytes, the position of its least
``GRAM``-gram, rightmost if several, is in the cover. Equal windows have that
position in the same place, as fixed residues give for some shift, but there is
one in about 40 positions instead of two in three. Suffixes are not put in
their lexical order and names are hashes, not ranks: as only prefixes of one
length are compared, two levels of names and equality of bytes suffice.

1. Sample: each cover position stands for the run of windows it is taken from,
   as a triple: the bytes before it, its gram, the bytes after it. The gram's
   hash is its first name, the hash of the whole triple its second.
2. Sort the sampled triples by first name; where that is unique the windows are
   unique and drop out (most of the text).
3. The second level of names: equal second names are equal runs, of which all but the
   first are removed whole, without looking at single windows.
4. Merge the remaining suffixes: of first names that keep several second names,
   the first run of each is unrolled into its windows, these are sorted with
   their gram's other windows, and adjacent prefixes are compared byte by byte.
   A gram with over ``CLASSES`` different runs is dealt out by window instead
   (128-bit names), so no task holds an unbounded group.

Windows that repeat within one slice of a task are combined before the shuffle.

Defined cases: NULL and empty texts, and texts shorter than ``LENGTH`` bytes,
lose nothing; every row is a document: rows that share a doc_id follow each
other in the order of their texts' digests, rows without one come after all others in that
order; an empty table gives no rows; further columns are ignored.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from lakeweave.llm.common import U64, byte_view, cut, mix, ship, slices, table
from lakeweave.llm.merkle import numbered

LENGTH = 100
GRAM = 20
#: Grams in a window.
WIDTH = LENGTH - GRAM + 1
SLICE = 1 << 19
CLASSES = 20_000
LAST = (1 << 63) - 1

_LOW = U64((1 << 20) - 1)  # room for a position in a piece
_RNG = np.random.default_rng(99991)
_BYTE = _RNG.integers(0, 1 << 63, 256, dtype=np.uint64) * U64(2) + U64(1)
_K = _RNG.integers(0, 1 << 63, 8, dtype=np.uint64) * U64(2) + U64(1)
_R = U64(0x5851F42D4C957F2D)
_N = SLICE + LENGTH + 8


def _powers(r: int) -> np.ndarray:
    out = np.ones(_N, U64)
    out[1:] = U64(r)
    return np.multiply.accumulate(out)


_POW = _powers(int(_R))
_INV = _powers(pow(int(_R), -1, 1 << 64))


def prefix_sums(data: np.ndarray, salt: int = 0) -> np.ndarray:
    """Sums from which the name of any stretch of ``data`` follows."""
    out = np.zeros(len(data) + 1, U64)
    np.cumsum((_BYTE if not salt else mix(_BYTE + U64(salt)))[data] * _POW[:len(data)], out=out[1:])
    return out


def names(sums: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    return mix((sums[end] - sums[start]) * _INV[start])


def grams(data: np.ndarray) -> np.ndarray:
    """A hash of the ``GRAM`` bytes from each position on."""
    raw = np.concatenate((data, np.zeros(8, np.uint8)))
    eight = np.ndarray((len(data) + 1,), "<u8", raw.data, strides=(1,))
    n = len(data) - GRAM + 1
    return mix(eight[:n] * _K[0] ^ mix(eight[8:n + 8] * _K[1]) + eight[GRAM - 8:n + GRAM - 8] * _K[2])


def sampled(data: np.ndarray, offsets: np.ndarray):
    """Cover positions of a piece: (text, position, first window, last window,
    first name, second name), positions in the piece."""
    none = np.zeros(0, np.int64)
    if len(data) < LENGTH:
        return none, none, none, none, none.astype(U64), none.astype(U64)
    h = grams(data)
    # the least gram of a window with its place; a larger place is a smaller value
    least = (h & ~_LOW) | (_LOW - np.arange(len(h), dtype=U64))
    step = 1
    while step * 2 <= WIDTH:
        least = np.minimum(least[:-step], least[step:])
        step *= 2
    least = np.minimum(least[:len(least) - (WIDTH - step)], least[WIDTH - step:])
    place = (_LOW - (least & _LOW)).astype(np.int64)
    inside = np.zeros(len(place) + 1, np.int32)
    whole = np.flatnonzero(np.diff(offsets) >= LENGTH)
    inside[offsets[whole]] += 1
    inside[offsets[whole + 1] - LENGTH + 1] -= 1
    inside = np.cumsum(inside[:-1]) > 0
    new = np.concatenate(([True], (place[1:] != place[:-1]) | ~inside[:-1]))
    lo = np.flatnonzero(inside & new)
    last = np.concatenate((inside[1:] & ~new[1:], [False]))
    hi = np.flatnonzero(inside & ~last)
    pos = place[lo]
    second = names(prefix_sums(data), lo, hi + LENGTH)
    second = mix(second ^ ((pos - lo).astype(U64) << U64(32)) ^ (hi - lo).astype(U64) * _K[3])
    return np.searchsorted(offsets, lo, "right") - 1, pos, lo, hi, h[pos], second


def packed(pos: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
    """Position, and how far before it the first and last windows start."""
    return pos << 16 | (pos - lo) << 8 | (pos - hi)


def unpacked(place: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    pos = place >> 16
    return pos, pos - ((place >> 8) & 255), pos - (place & 255)


def joined_spans(doc: np.ndarray, a: np.ndarray, b: np.ndarray):
    """Spans of the same document that touch, as one; sorted by (doc, a) before."""
    if not len(doc):
        return doc, a, b
    order = np.lexsort((a, doc))
    doc, a, b = doc[order], a[order], b[order]
    _, group = np.unique(doc, return_inverse=True)
    reach = np.maximum.accumulate(b + group * (int(b.max()) + 1)) - group * (int(b.max()) + 1)
    new = np.concatenate(([True], (doc[1:] != doc[:-1]) | (a[1:] > reach[:-1])))
    at = np.flatnonzero(new)
    return doc[at], a[at], np.maximum.reduceat(b, at)


_ROW = pa.schema([("first", pa.int64()), ("second", pa.int64()), ("doc", pa.int64()), ("place", pa.int64())])
_ROW_DDL = "first bigint, second bigint, doc bigint, place bigint"


def samples(docs: DataFrame) -> DataFrame:
    """Sampled triples of all texts. Runs that repeat an earlier one of their
    slice come as spans: ``place`` is minus the start less one, ``second`` the
    end, and ``first`` scatters them."""
    def rows(ids, data, offs, base):
        text, pos, lo, hi, first, second = sampled(data, offs)
        doc = ids[text]
        pos, lo, hi = (x - offs[text] + base for x in (pos, lo, hi))
        order = np.lexsort((pos, doc, second, first))
        f, s, d, p, lo, hi = (x[order] for x in (first, second, doc, pos, lo, hi))
        head = np.concatenate(([True], (f[1:] != f[:-1]) | (s[1:] != s[:-1]))) if len(f) else np.zeros(0, bool)
        lead = np.flatnonzero(head)[np.cumsum(head) - 1] if len(f) else np.zeros(0, np.int64)
        rep = (d == d[lead]) & (p == p[lead])
        yield pa.RecordBatch.from_arrays([pa.array(x) for x in (f[rep].view(np.int64), s[rep].view(np.int64), d[rep], packed(p[rep], lo[rep], hi[rep]))], schema=_ROW)
        d, a, b = joined_spans(d[~rep], lo[~rep], hi[~rep] + LENGTH)
        if len(d):
            scatter = mix(d.astype(U64) * _K[4] ^ a.astype(U64)).view(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in (scatter, b, d, -a - 1)], schema=_ROW)

    def run(batches):
        for batch in batches:
            ids = batch.column(0).to_numpy()
            data, offs = byte_view(batch.column(1))
            for i, j in slices(offs, SLICE):
                piece, cuts = data[offs[i]:offs[j]], offs[i:j + 1] - offs[i]
                if len(piece) <= SLICE:
                    yield from rows(ids[i:j], piece, cuts, 0)
                    continue
                # one long text: pieces that share LENGTH - 1 bytes
                for at in range(0, len(piece) - LENGTH + 1, SLICE - LENGTH):
                    part = piece[at:at + SLICE - 1]
                    yield from rows(ids[i:j], part, np.array([0, len(part)]), at)

    return docs.mapInArrow(run, _ROW_DDL)


def repeated(rows: DataFrame) -> DataFrame:
    """The rows whose first name occurs again, and all spans: one sort."""
    def run(batches):
        held, again = None, False  # the last row, and whether its name came before it
        for b in batches:
            if not b.num_rows:
                continue
            t = pa.Table.from_batches([b]) if held is None else pa.concat_tables([held, pa.Table.from_batches([b])])
            first, place = t.column("first").to_numpy(), t.column("place").to_numpy()
            same = first[1:] == first[:-1]
            keep = np.concatenate(([again], same)) | np.concatenate((same, [False])) | (place < 0)
            held, again = t.slice(t.num_rows - 1), bool(same[-1]) if len(same) else again
            yield from t.slice(0, t.num_rows - 1).filter(pa.array(keep[:-1])).to_batches()
        if held is not None and (again or held.column("place")[0].as_py() < 0):
            yield from held.to_batches()

    return rows.repartition("first").sortWithinPartitions("first").mapInArrow(run, _ROW_DDL)


_WINDOWS = pa.schema([("key", pa.int64()), ("doc", pa.int64()), ("place", pa.int64()), ("content", pa.binary())])


def unrolled(texts: DataFrame) -> DataFrame:
    """(key, doc, place, content) of the runs to be told apart: their bytes
    under their gram's name, or, for crowded grams, each window's second name
    under its first."""
    def run(batches):
        for b in batches:
            ids = b.column(0).to_numpy()
            for row in range(b.num_rows):
                data = np.frombuffer((b.column(1)[row].as_py() or "").encode(), np.uint8)
                runs = b.column(2)[row].as_py()
                place = np.array([r["place"] for r in runs], np.int64)
                first = np.array([r["first"] for r in runs], np.int64)
                crowded = np.array([r["crowded"] for r in runs], bool)
                pos, lo, hi = unpacked(place)
                fits = hi + LENGTH <= len(data)
                calm = np.flatnonzero(fits & ~crowded)
                if len(calm):
                    yield pa.RecordBatch.from_arrays([pa.array(first[calm]), pa.array(np.full(len(calm), ids[row])), pa.array(place[calm]),
                                                      pa.array([data[x:y].tobytes() for x, y in zip(lo[calm], hi[calm] + LENGTH)], pa.binary())], schema=_WINDOWS)
                for i in np.flatnonzero(fits & crowded).tolist():
                    part = data[lo[i]:hi[i] + LENGTH]
                    start = np.arange(hi[i] - lo[i] + 1)
                    one, two = (names(prefix_sums(part, salt), start, start + LENGTH) for salt in (1, 2))
                    at = start + lo[i]
                    key = mix(one ^ U64(first[i].view(U64)) ^ (pos[i] - at).astype(U64)).view(np.int64)
                    yield pa.RecordBatch.from_arrays([pa.array(key), pa.array(np.full(len(at), ids[row])), pa.array(packed(np.full(len(at), pos[i]), at, at)),
                                                      pa.array([x.tobytes() for x in two], pa.binary())], schema=_WINDOWS)

    return texts.mapInArrow(run, "key bigint, doc bigint, place bigint, content binary")


def adjacent(key: np.ndarray, doc: np.ndarray, place: np.ndarray, content: list[bytes]):
    """Spans of windows that occur earlier among the runs of their key."""
    pos, lo, hi = unpacked(place)
    many = hi - lo + 1
    begin = np.concatenate(([0], np.cumsum([len(c) for c in content])))
    data = np.frombuffer(b"".join(content), np.uint8)
    run = np.repeat(np.arange(len(key)), many)
    shift = np.arange(len(run)) - np.repeat(np.cumsum(many) - many, many)
    start = begin[run] + shift
    name = np.zeros(len(run), U64)
    for i in range(0, len(key), 1024):  # powers reach over so many bytes
        j = min(len(key), i + 1024)
        here = slice(int(np.searchsorted(run, i)), int(np.searchsorted(run, j)))
        name[here] = names(prefix_sums(data[begin[i]:begin[j]]), start[here] - begin[i], start[here] - begin[i] + LENGTH)
    window = lo[run] + shift
    offset = pos[run] - window
    name = mix(name ^ key[run].view(U64) ^ offset.astype(U64) * _K[5])
    views = np.lib.stride_tricks.sliding_window_view(data, LENGTH)
    while True:
        order = np.lexsort((window, doc[run], name))
        n, d, w, at = name[order], doc[run][order], window[order], start[order]
        same = np.concatenate(([False], n[1:] == n[:-1]))
        twins = np.flatnonzero(same)
        unlike = [t[~(views[at[t]] == views[at[t - 1]]).all(axis=1)] for t in np.split(twins, range(1 << 16, len(twins), 1 << 16))]
        shared = np.unique(n[np.concatenate(unlike)]) if unlike else n[:0]
        if not len(shared):
            break
        for one in shared:  # unlike windows of one name: their bytes give them others
            rows = np.flatnonzero(name == one)
            _, which = np.unique(views[start[rows]], axis=0, return_inverse=True)
            name[rows] = mix(one ^ mix(which.ravel().astype(U64) + U64(1)))
    lead = np.flatnonzero(~same)[np.cumsum(~same) - 1] if len(n) else at
    gone = (d != d[lead]) | (w != w[lead])
    return joined_spans(d[gone], w[gone], w[gone] + LENGTH)


def merged(windows: DataFrame) -> DataFrame:
    """Spans (doc, a, b) that occur earlier, of sorted and compared windows."""
    schema = pa.schema([("doc", pa.int64()), ("a", pa.int64()), ("b", pa.int64())])

    def run(batches):
        rest, lead = None, None  # an unfinished key's runs; key, content and place of a crowded window's first
        for batch in batches:
            t = pa.Table.from_batches([batch])
            if rest is not None:
                t = pa.concat_tables([rest, t])
            if not t.num_rows:
                continue
            key, doc, place = (t.column(c).to_numpy() for c in ("key", "doc", "place"))
            content = t.column("content").to_pylist()
            single = np.array([len(c) == 8 for c in content], bool)
            out = []
            for i in np.flatnonzero(single).tolist():  # sorted by doc and place within a name
                mine = (key[i], content[i])
                if lead is None or lead[0] != mine:
                    lead = (mine, doc[i], place[i] >> 16, int(place[i] & 255))
                elif (doc[i], place[i] >> 16, int(place[i] & 255)) != lead[1:]:
                    p = int((place[i] >> 16) - (place[i] & 255))
                    out.append((doc[i], p, p + LENGTH))
            runs = np.flatnonzero(~single)
            done = runs[key[runs] != key[-1]] if len(runs) else runs
            rest = t.take(pa.array(runs[key[runs] == key[-1]])) if len(done) < len(runs) else None
            spans = [np.array(x, np.int64) for x in zip(*out)] if out else [np.zeros(0, np.int64)] * 3
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in joined_spans(*spans)], schema=schema)
            if len(done):
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in adjacent(key[done], doc[done], place[done], [content[i] for i in done])], schema=schema)
        if rest is not None and rest.num_rows:
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in adjacent(*(rest.column(c).to_numpy() for c in ("key", "doc", "place")),
                                                                            rest.column("content").to_pylist())], schema=schema)

    # window starts rise with doc and place as far as a crowded window's order needs
    return (windows.repartition("key").sortWithinPartitions("key", "content_size", "content_name", "doc", "start")
            .select("key", "doc", "place", "content").mapInArrow(run, "doc bigint, a bigint, b bigint"))


def keyed(docs: DataFrame, text_col: str) -> DataFrame:
    """(doc, doc_id, text): a number of its own for each row, in the order of
    doc_id. The doc_id serves where no two rows share one."""
    texts = docs.select(F.coalesce("doc_id", F.lit(LAST)).cast("bigint").alias("doc"), "doc_id", F.col(text_col).alias("text"))
    if not texts.groupBy("doc").agg(F.count(F.lit(1)).alias("n")).where("n > 1").limit(1).collect():
        return texts
    # ids are shared: rows are numbered once and for all, in a written table
    rows = cut(texts.withColumn("row", F.monotonically_increasing_id()), "numbered-texts")
    order = rows.select(F.lit("").alias("all"), F.col("doc_id").isNull().alias("none"), "doc", F.sha2(F.coalesce("text", F.lit("")), 256).alias("digest"), "row")
    place = cut(numbered(order, "all", ["none", "doc", "digest", "row"]).select("row", "pos"), "text-numbers")
    return rows.join(place, "row").select(F.col("pos").alias("doc"), "doc_id", "text")


def spans(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """(doc, doc_id, text, spans): each document with its repeated byte spans (a, b)."""
    ship(docs.sparkSession)
    texts = keyed(docs, text_col)
    rows = cut(repeated(samples(texts.select("doc", "text"))), "repeated-names")
    runs = rows.where("place >= 0")
    classes = cut(runs.groupBy("first", "second").agg(F.min(F.struct("doc", "place")).alias("f")).select("first", "second", "f.*"), "name-classes")
    crowd = classes.groupBy("first").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    open_runs = (classes.join(crowd, "first").groupBy("doc")
                 .agg(F.collect_list(F.struct("first", "place", (F.col("n") > CLASSES).alias("crowded"))).alias("runs")))
    open_runs = cut(open_runs, "open-runs")
    # equal runs, all but the first of them
    lead = classes.select("first", "second", F.col("doc").alias("d0"), F.col("place").alias("p0"))
    equal = runs.join(lead, ["first", "second"]).where("doc <> d0 or place <> p0").select(
        "doc", F.expr("shiftright(place, 16) - (shiftright(place, 8) & 255)").alias("a"), F.expr(f"shiftright(place, 16) - (place & 255) + {LENGTH}").alias("b"))
    near = rows.where("place < 0").select("doc", F.expr("-place - 1").alias("a"), F.col("second").alias("b"))
    # one shuffle of the texts serves both joins
    windows = unrolled(texts.select("doc", "text").join(open_runs, "doc").select("doc", "text", "runs"))
    start = F.expr("shiftright(place, 16) - (place & 255)")
    windows = windows.select("*", F.octet_length("content").alias("content_size"), F.when(F.octet_length("content") == 8, F.col("content")).alias("content_name"), start.alias("start"))
    found = equal.unionByName(near).unionByName(merged(windows))
    per = found.groupBy("doc").agg(F.collect_list(F.struct("a", "b")).alias("spans"))
    return texts.join(per, "doc", "left").select("doc", "doc_id", "text", "spans")


def report(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """Per document: bytes, bytes and spans removed, digest of the rest."""
    schema = "doc_id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string"

    def run(batches):
        for b in batches:
            data, offs = byte_view(b.column(1))
            whole = memoryview(data)
            listed = b.column(2)
            gone, many, digest = [], [], []
            for i in range(b.num_rows):
                text = whole[offs[i]:offs[i + 1]]
                found = listed[i].values
                a, z = (found.field(k).to_numpy() for k in (0, 1)) if found is not None else (offs[:0], offs[:0])
                _, a, z = joined_spans(np.zeros(len(a), np.int64), a, z)
                sha, at = hashlib.sha256(), 0
                for x, y in zip(a.tolist(), z.tolist()):
                    sha.update(text[at:x])
                    at = y
                sha.update(text[at:])
                gone.append(int((z - a).sum()))
                many.append(len(a))
                digest.append(sha.hexdigest())
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(np.diff(offs)), pa.array(gone, pa.int64()), pa.array(many, pa.int64()), pa.array(digest, pa.string())],
                                             names=[x.split()[0] for x in schema.split(", ")])

    rows = spans(docs, text_col).select(F.col("doc_id").cast("bigint").alias("doc_id"), "text", "spans")
    return rows.mapInArrow(run, schema)


def op3_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return report(table(spark, sf_dir, "documents"))


QUERIES = {"op3_suffix_dedup": op3_suffix_dedup}
ORACLE: dict[str, str] = {}
