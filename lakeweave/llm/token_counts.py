"""Token counts by a two-tier lookup of pre-token lengths.

A text's token count is the sum of its pre-tokens' counts, and a pre-token's
count depends on nothing around it. Tier one is a broadcast table of the
corpus's most frequent pre-tokens; tier two is each worker's cache of the
pre-tokens it has met, filled by encoding a slice's misses in one call. No
pre-token is ever shuffled.

The frequent pre-tokens come from all documents: each task keeps a bounded
summary (counts of its heaviest pre-tokens) and the summaries are merged in a
tree of tasks, ``SUMMARY`` entries each. They decide speed only; a length is
the same whichever tier gives it.

The split is done here for texts whose characters are all below U+0180, where
letter, number, space and case classes are fixed; any other text, and any that
may hold a special token, is encoded whole by the tokenizer library.

Defined cases: NULL and empty texts have 0 bytes and 0 tokens; repeated rows
and NULL doc_ids each keep their row; an empty table gives no rows; further
columns are ignored.
"""

from __future__ import annotations

import os
import re
import unicodedata
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from lakeweave.llm.common import as_text, byte_view, slices, table

#: Entries of a task's summary, of a merged summary and of the broadcast table.
SUMMARY = 1 << 14
#: Entries of a worker's cache; a full cache is emptied.
CACHE = 1 << 18
LIMIT = 2048
#: Longer pre-tokens are encoded each time instead of being cached.
LONG = 64


def _class(test) -> str:
    return "".join(re.escape(chr(c)) for c in range(0x180) if test(unicodedata.category(chr(c))))


_LETTER = _class(lambda k: k[0] == "L")
_NUMBER = _class(lambda k: k[0] == "N")
_SPACE = "\t-\r \x85\xa0"
#: Pre-token pattern of the vocabulary (fixed values), its classes written out below U+0180.
SPLIT = re.compile(rf"'s|'t|'re|'ve|'m|'ll|'d|[{_LETTER}]+|[{_NUMBER}]|[^{_SPACE}{_LETTER}{_NUMBER}]+")
#: Characters outside the fixed classes, U+0130 (its lower case is two characters), or a special token's start.
UNSAFE = re.compile("[^\x00-įı-ſ]|<\\|")


def split(text: str) -> list[str] | None:
    """Pre-tokens of a text, or None where the library has to split it."""
    return None if UNSAFE.search(text) else SPLIT.findall(text.lower())


def heaviest(counts: Counter, n: int) -> Counter:
    return Counter(dict(counts.most_common(n)))


def _pack(counts: Counter) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(list(counts), pa.string()), pa.array(list(counts.values()), pa.int64())],
                                      names=["w", "c"])


def _packed(counts: Counter) -> pa.RecordBatch:
    """One row: a summary as one Arrow stream."""
    sink = pa.BufferOutputStream()
    batch = _pack(counts)
    with pa.ipc.new_stream(sink, batch.schema) as w:
        w.write_batch(batch)
    return pa.RecordBatch.from_arrays([pa.array([sink.getvalue().to_pybytes()], pa.binary())], names=["summary"])


def _unpacked(blob: bytes) -> Counter:
    t = pa.ipc.open_stream(blob).read_all()
    return Counter(dict(zip(t.column(0).to_pylist(), t.column(1).to_pylist())))


def frequent(docs: DataFrame, entries: int = SUMMARY, fan: int = 32) -> list[str]:
    """The heaviest pre-tokens of all texts, by mergeable bounded summaries."""
    def count(batches):
        counts: Counter = Counter()
        for b in batches:
            texts = as_text(b.column(0))
            _, offs = byte_view(texts)
            for i, j in slices(offs):
                for t in texts.slice(i, j - i).to_pylist():
                    counts.update(split(t) or ())
                if len(counts) > 16 * entries:
                    counts = heaviest(counts, 8 * entries)
        yield _packed(heaviest(counts, entries))

    def merge(batches):
        counts: Counter = Counter()
        for b in batches:
            for blob in b.column(0).to_pylist():
                counts.update(_unpacked(blob))
                if len(counts) > 16 * entries:
                    counts = heaviest(counts, 8 * entries)
        yield _packed(heaviest(counts, entries))

    parts = docs.select("text").mapInArrow(count, "summary binary")
    n = docs.rdd.getNumPartitions()
    while n > 1:
        n = -(-n // fan)
        parts = parts.repartition(n).mapInArrow(merge, "summary binary")
    total: Counter = Counter()
    for row in parts.toLocalIterator():
        total.update(_unpacked(row[0]))
    return [w for w, _ in total.most_common(entries) if len(w) <= LONG]


class Lengths(dict):
    """Pre-token to token count: the broadcast tier, with a bounded cache."""

    def __init__(self, tokenizer, words: list[str], sizes: np.ndarray):
        super().__init__(zip(words, sizes.tolist()))
        self.tokenizer, self.words, self.sizes = tokenizer, words, sizes

    def learn(self, tokens: list[str]) -> dict[str, int]:
        """Counts of the tokens that neither tier holds; the short ones stay."""
        new = [t for t in set(tokens) if t not in self]
        if not new:
            return {}
        got = dict(zip(new, encoded(self.tokenizer, new)))
        if len(self) + len(got) > len(self.words) + CACHE:
            self.clear()
            self.update(zip(self.words, self.sizes.tolist()))
        self.update((t, n) for t, n in got.items() if len(t) <= LONG)
        return got

    def total(self, tokens: list[str], new: dict[str, int]) -> int:
        try:
            return sum(map(self.__getitem__, tokens))
        except KeyError:
            return sum(self[t] if t in self else new[t] if t in new else encoded(self.tokenizer, [t])[0] for t in tokens)


def encoded(tokenizer, texts: list[str]) -> list[int]:
    return [len(e.ids) for e in tokenizer.encode_batch_fast(texts, add_special_tokens=False)]


def load(path: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer
    t = Tokenizer.from_file(path)
    t.no_truncation()
    t.no_padding()
    return t


def count_tokens(docs: DataFrame, path: str, limit: int = LIMIT, entries: int = SUMMARY) -> DataFrame:
    """Bytes and tokens of every text by the tokenizer file at ``path`` (the
    same place on every node); ``over_limit`` marks more than ``limit`` tokens."""
    words = frequent(docs, entries)
    sizes = np.array(encoded(load(path), words), np.uint16)
    shared = docs.sparkSession.sparkContext.broadcast(("\n".join(words), sizes))
    schema = "doc_id bigint, n_bytes bigint, n_tokens bigint, over_limit boolean"

    def run(batches):
        tokenizer = load(path)
        text, sizes = shared.value
        lengths = Lengths(tokenizer, text.split("\n") if text else [], sizes)
        for b in batches:
            texts = as_text(b.column(1))
            _, offs = byte_view(texts)
            counts: list[int] = []
            for i, j in slices(offs):
                rows = texts.slice(i, j - i).to_pylist()
                parts = [split(t) for t in rows]
                new = lengths.learn([t for p in parts if p for t in p])
                whole = iter(encoded(tokenizer, [t for t, p in zip(rows, parts) if p is None]))
                counts.extend(next(whole) if p is None else lengths.total(p, new) for p in parts)
            n = np.array(counts, np.int64)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(np.diff(offs)), pa.array(n), pa.array(n > limit)],
                                             names=["doc_id", "n_bytes", "n_tokens", "over_limit"])

    return docs.select(F.col("doc_id"), F.col("text")).mapInArrow(run, schema)


def op6_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers
    return count_tokens(table(spark, sf_dir, "documents"), str(public_tokenizers.path("word_bpe_49k.json")))


QUERIES = {"op6_token_counts": op6_token_counts}
ORACLE: dict[str, str] = {}
