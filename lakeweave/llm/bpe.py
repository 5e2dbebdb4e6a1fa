"""Byte-level BPE encoding by overlapping chunks, and decoding.

A text of at most ``CHUNK`` characters is one piece. A longer one is cut into
chunks that overlap by ``OVERLAP`` characters and are dealt out over the tasks.
Each chunk is split into pre-tokens by itself. Its first pre-tokens may be wrong, as it
may begin inside one, but a match of the pattern depends on nothing before it:
from the first boundary on that a chunk shares with its predecessor, both give the
same pre-tokens. There the two are stitched, and the pieces between the
stitches are encoded each by itself. Only boundaries between a character that
is no white space and an ASCII blank count: those split under every version of
Unicode's letter tables, and a piece that ends there is split as inside its text.
Chunks without such a boundary in their overlap are joined into one piece.

Decoding concatenates the bytes of the ids.

Defined cases: NULL and empty texts have no ids and decode to no bytes; rows
that share a doc_id and rows without one are each encoded; an empty table gives
no rows; further columns are ignored.
"""

from __future__ import annotations

import base64
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from lakeweave.llm.common import as_text, byte_view, cut, slices, table

#: Characters of a chunk, and those it shares with the next one.
CHUNK, OVERLAP = 1 << 15, 1 << 10
#: Characters that a match may look at beyond its end.
AHEAD = 4
#: Blanks in a row that are not left to the library's pattern.
BLANKS = 500_000


@lru_cache(maxsize=4)
def ranks(path: str) -> dict[bytes, int]:
    """Token bytes to ids from a file of base64 token and rank on each line."""
    with open(path, "rb") as f:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, filter(bytes.strip, f))}


@lru_cache(maxsize=4)
def codec(path: str, pattern: str):
    """The tokenizer of a rank file, once per worker process."""
    import tiktoken
    return tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks(path), special_tokens={})


@lru_cache(maxsize=4)
def token_bytes(path: str) -> dict[int, bytes]:
    return {rank: token for token, rank in ranks(path).items()}


def boundaries(text: str, pattern: str, last: bool) -> np.ndarray:
    """Ends of the text's pre-tokens where no white space meets an ASCII blank;
    without ``last``, only those that text after this one can't change."""
    import regex
    upto = len(text) if last else len(text) - AHEAD
    ends = (m.end() for m in regex.finditer(pattern, text))
    return np.array([e for e in ends if e <= upto and e < len(text) and text[e] in " \t\n\r" and not text[e - 1].isspace()], np.int64)


def ids_of(bpe, text: str) -> np.ndarray:
    """The library's ids of a text. It has no room for a run of a million blanks: such
    a run is a pre-token up to its last blank, or its end where the text ends."""
    if len(text) < BLANKS:
        return bpe.encode_to_numpy(text, disallowed_special=())
    import regex
    parts, at = [], 0
    for m in regex.finditer(rf"\s{{{BLANKS},}}", text):
        end = m.end() - (m.end() < len(text))
        parts += [bpe.encode_to_numpy(text[at:m.start()], disallowed_special=()), np.array(bpe._encode_single_piece(text[m.start():end]), np.uint32)]
        at = end
    return np.concatenate([*parts, bpe.encode_to_numpy(text[at:], disallowed_special=())])


def _arrow(b: pa.RecordBatch, i: int, j: int, columns: list[str]) -> list[pa.Array]:
    return [b.column(b.schema.get_field_index(c)).slice(i, j - i) for c in columns]


def chunks(texts: DataFrame, chunk: int, overlap: int) -> DataFrame:
    """(key, doc_id, chunk, start, last, text) of each text (key, doc_id, text)."""
    def run(batches):
        for b in batches:
            for k in range(b.num_rows):
                text = b.column(2)[k].as_py()
                starts = list(range(0, max(len(text) - overlap, 1), chunk))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([b.column(c)[k].as_py()] * len(starts), pa.int64()) for c in (0, 1)]
                    + [pa.array(np.arange(len(starts))), pa.array(np.array(starts)), pa.array([s == starts[-1] for s in starts]),
                       pa.array([text[s:] if s == starts[-1] else text[s:s + chunk + overlap] for s in starts], pa.string())],
                    names=["key", "doc_id", "chunk", "start", "last", "text"])

    return texts.select("key", "doc_id", "text").mapInArrow(run, "key bigint, doc_id bigint, chunk bigint, start bigint, last boolean, text string")


def split(parts: DataFrame, pattern: str, chunk: int, overlap: int) -> DataFrame:
    """Chunks with the boundaries in the overlaps with their neighbours, as
    places in the whole text: ``head`` before and ``tail`` after."""
    keep = ["key", "doc_id", "chunk", "start", "last", "text"]

    def run(batches):
        for b in batches:
            texts = as_text(b.column(5))
            _, offs = byte_view(texts)
            for i, j in slices(offs):
                heads, tails = [], []
                for text, start, last in zip(texts.slice(i, j - i).to_pylist(), b.column(3).slice(i, j - i).to_pylist(), b.column(4).slice(i, j - i).to_pylist()):
                    at = boundaries(text, pattern, last)
                    heads.append((at[at < overlap] + start).tolist())
                    tails.append([] if last else (at[at >= chunk] + start).tolist())
                lists = [pa.array(x, pa.list_(pa.int64())) for x in (heads, tails)]
                yield pa.RecordBatch.from_arrays([*_arrow(b, i, j, keep), *lists], names=[*keep, "head", "tail"])

    kinds = "key bigint, doc_id bigint, chunk bigint, start bigint, last boolean, text string"
    return parts.select(*keep).mapInArrow(run, kinds + ", head array<bigint>, tail array<bigint>")


def stitched(parts: DataFrame, chunk: int) -> DataFrame:
    """(key, doc_id, piece, text): the split chunks, cut where their boundaries
    meet; chunks that don't meet are one piece."""
    of_text = Window.partitionBy("key").orderBy("chunk")
    meet = parts.select("key", "chunk", "start", "last", F.array_min(F.array_intersect("tail", F.lead("head").over(of_text))).alias("to"))
    meet = meet.withColumn("from", F.lag("to").over(of_text))
    first: Column = (F.col("chunk") == 0) | F.col("from").isNotNull()
    meet = meet.select("key", "chunk", "last", F.sum(first.cast("int")).over(of_text).alias("piece"),
                       (first & (F.col("last") | F.col("to").isNotNull())).alias("alone"),
                       (F.coalesce("from", "start") - F.col("start")).alias("skip"),
                       (F.coalesce("to", F.col("start") + chunk) - F.coalesce("from", "start")).alias("size"))
    rows = parts.select("key", "doc_id", "chunk", "text").join(meet, ["key", "chunk"])
    size = F.when(F.col("last"), F.length("text")).otherwise(F.col("size")).cast("int")
    rows = rows.withColumn("text", F.col("text").substr((F.col("skip") + 1).cast("int"), size))
    apart = rows.where(~F.col("alone")).groupBy("key", "piece").agg(
        F.first("doc_id").alias("doc_id"), F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("chunk", "text"))), lambda x: x["text"]), "").alias("text"))
    return rows.where("alone").select("key", "doc_id", "piece", "text").unionByName(apart)


def encoded(pieces: DataFrame, path: str, pattern: str) -> DataFrame:
    """``pieces`` with ``ids`` (little-endian unsigned 32-bit) for ``text``."""
    keep = [c for c in pieces.columns if c != "text"]

    def run(batches):
        bpe = codec(path, pattern)
        for b in batches:
            texts = as_text(b.column(b.schema.get_field_index("text")))
            _, offs = byte_view(texts)
            for i, j in slices(offs):
                ids = [np.asarray(ids_of(bpe, t), "<u4").tobytes() for t in texts.slice(i, j - i).to_pylist()]
                yield pa.RecordBatch.from_arrays([*_arrow(b, i, j, keep), pa.array(ids, pa.binary())], names=[*keep, "ids"])

    kinds = ", ".join(f"{c} {pieces.schema[c].dataType.simpleString()}" for c in keep)
    return pieces.mapInArrow(run, f"{kinds}, ids binary")


def joined(pieces: DataFrame) -> DataFrame:
    """(doc_id, ids): the encoded pieces of each text, put together in order."""
    def run(batches):
        key, doc, ids = None, None, []

        def row():
            return pa.RecordBatch.from_arrays([pa.array([doc], pa.int64()), pa.array([b"".join(ids)], pa.binary())], names=["doc_id", "ids"])

        for b in batches:
            for k, d, part in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2)):
                if k != key and key is not None:
                    yield row()
                    ids = []
                key, doc = k, d
                ids.append(part.as_py())
        if key is not None:
            yield row()

    return (pieces.repartition("key").sortWithinPartitions("key", "piece").select("key", "doc_id", "ids")
            .mapInArrow(run, "doc_id bigint, ids binary"))


def encode(docs: DataFrame, path: str, pattern: str, chunk: int = CHUNK, overlap: int = OVERLAP) -> DataFrame:
    """(doc_id, ids) of every row of ``docs`` (doc_id, text) by the rank file at
    ``path`` (the same place on every node) and the pre-token pattern."""
    docs = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    short = encoded(docs.where(F.length("text") <= chunk), path, pattern)
    long = docs.where(F.length("text") > chunk).withColumn("key", F.monotonically_increasing_id())
    parts = cut(split(chunks(long, chunk, overlap).repartition("key", "chunk"), pattern, chunk, overlap), "bpe-chunks")
    return short.unionByName(joined(encoded(stitched(parts, chunk), path, pattern)))


def decode(rows: DataFrame, path: str) -> DataFrame:
    """``rows`` with ``decoded``, the bytes of ``ids``."""
    keep = rows.columns

    def run(batches):
        of = token_bytes(path)
        for b in batches:
            ids = b.column(b.schema.get_field_index("ids"))
            offs = np.frombuffer(ids.buffers()[1], np.int32)[ids.offset:ids.offset + len(ids) + 1].astype(np.int64)
            for i, j in slices(offs):
                out = [b"".join(map(of.__getitem__, np.frombuffer(x.as_py(), "<u4").tolist())) for x in ids.slice(i, j - i)]
                yield pa.RecordBatch.from_arrays([*_arrow(b, i, j, keep), pa.array(out, pa.binary())], names=[*keep, "decoded"])

    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema)
    return rows.mapInArrow(run, f"{kinds}, decoded binary")


def report(docs: DataFrame, path: str, pattern: str, chunk: int = CHUNK, overlap: int = OVERLAP) -> DataFrame:
    """Per document: number of ids, and digests of the ids and of what they decode to."""
    rows = decode(encode(docs, path, pattern, chunk, overlap), path)
    return rows.select("doc_id", (F.octet_length("ids") / 4).cast("bigint").alias("n_tokens"),
                       F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


def op13_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers
    return report(table(spark, sf_dir, "documents"), str(public_tokenizers.path("byte_bpe_50k.tiktoken")), public_tokenizers.PATTERN)


QUERIES = {"op13_byte_bpe": op13_byte_bpe}
ORACLE: dict[str, str] = {}
