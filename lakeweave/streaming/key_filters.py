"""Bloom filters of a table's keys, one per date and write (ST1).

A repeat may arrive days after its first row. To find that row without reading the keys of
every date, each write leaves a Bloom filter of the keys it adds to each date:
a power of two of ``BITS``-bit blocks, about ``PER_BLOCK`` keys to a block. A
key's bits all lie in one block, so looking keys up is a join on the block.
Filters are tables under the table's root, written before the commit that they
belong to: a write that dies leaves a filter of keys that are not there, which
opens a date too many and changes nothing.

At 44 bits a key a key is taken to be in a date that lacks it about once in
10^9 (``HASHES`` bits each), so a large batch opens hardly any date in vain.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, functions as F

from lakeweave.sources.tables import VersionedTable, path_exists

BITS, PER_BLOCK, HASHES = 1 << 15, 745, 30
WORDS = BITS // 64
#: Commits that add no key to a date (what they write was there).
ADD_NOTHING = {"OPTIMIZE", "DELETE", "RETENTION", "REVERT", "RESET"}


def folder(table: VersionedTable) -> str:
    return f"{table.root}/_key_filters"


def block_of(key: Column, blocks: Column) -> Column:
    return F.pmod(F.xxhash64(key, F.lit(-1)), blocks)


def bits_of(key: Column) -> Column:
    """The places of a key's bits, four from each of several hashes."""
    hashed = lambda i: F.xxhash64(key, (i / 4).cast("int"))
    return F.transform(F.sequence(F.lit(0), F.lit(HASHES - 1)),
                       lambda i: F.pmod(F.call_function("shiftrightunsigned", hashed(i), (i % 4 * 16).cast("int")), F.lit(BITS)).cast("int"))


def built(rows: DataFrame, date: str, key: str) -> DataFrame:
    """(date, blocks, block, words): the filters of ``rows``' keys by date."""
    keys = rows.where(F.col(key).isNotNull() & F.col(date).isNotNull()).select(F.col(date).alias("date"), F.col(key).alias("key"))
    per = keys.groupBy("date").agg(F.pow(F.lit(2), F.ceil(F.log2(F.greatest(F.count(F.lit(1)) / PER_BLOCK, F.lit(1.0))))).cast("bigint").alias("blocks"))
    # dealt by block as keys: the bits, many a key, are made and put together where they end up
    dealt = keys.join(per, "date").select("date", "blocks", block_of(F.col("key"), F.col("blocks")).alias("block"), "key").repartition("date", "blocks", "block")
    one = dealt.select("date", "blocks", "block", F.explode(bits_of(F.col("key"))).alias("bit"))
    word = one.groupBy("date", "blocks", "block", (F.col("bit") / 64).cast("int").alias("at")).agg(
        F.bit_or(F.expr("shiftleft(1L, bit % 64)")).alias("word"))
    full = word.groupBy("date", "blocks", "block").agg(F.map_from_entries(F.collect_list(F.struct("at", "word"))).alias("m"))
    words = F.transform(F.sequence(F.lit(0), F.lit(WORDS - 1)), lambda i: F.coalesce(F.col("m")[i], F.lit(0).cast("bigint")))
    return full.select("date", "blocks", "block", words.alias("words"))


def write(table: VersionedTable, rows: DataFrame, date: str, key: str) -> str:
    """Leave the filters of ``rows`` beside ``table``; the name goes into the
    commit's parameters (``keyFilter``)."""
    name = uuid.uuid4().hex
    built(rows, date, key).write.parquet(f"{folder(table)}/write={name}")
    return name


def covered(table: VersionedTable) -> bool:
    """Whether every commit that added keys left filters."""
    return all(c["operation"] in ADD_NOTHING or "keyFilter" in (c["params"] or {}) for c in table.commits())


def may_hold(table: VersionedTable, rows: DataFrame, key: str) -> list | None:
    """The dates that may hold one of ``rows``' keys, or None where the filters
    don't tell. Dates only come to the driver: one for each day at most."""
    if not covered(table) or not path_exists(table.spark, folder(table)):
        return None
    filters = table.spark.read.parquet(folder(table)).select("date", "blocks", "block", "words")
    sizes = [r[0] for r in filters.select("blocks").distinct().collect()]  # powers of two
    if not sizes:
        return []
    keys = rows.where(F.col(key).isNotNull()).select(F.col(key).alias("key"))
    keys = keys.select("key", F.explode(F.array(*[F.lit(s).cast("bigint") for s in sizes])).alias("blocks"))
    keys = keys.select("blocks", block_of(F.col("key"), F.col("blocks")).alias("block"), bits_of(F.col("key")).alias("bits"))
    hit = keys.join(filters, ["blocks", "block"]).where(
        F.forall("bits", lambda p: F.getbit(F.col("words")[(p / 64).cast("int")], p % 64) == 1))
    return [r[0] for r in hit.select("date").distinct().collect()]
