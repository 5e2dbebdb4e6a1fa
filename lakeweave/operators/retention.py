"""Retention."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from lakeweave.sources.tables import VersionedTable


def cutoff(as_of: Column | str, days: int) -> Column:
    """Start of the retained window: ``as_of - days``."""
    a = F.lit(as_of) if isinstance(as_of, str) else as_of
    return a.cast("timestamp_ntz") - F.make_dt_interval(days=F.lit(days))


def expire_payload(df: DataFrame, ts: str, as_of, days: int, cols: Sequence[str],
                   holds: DataFrame | None = None, key: str | None = None) -> DataFrame:
    """NULL the payload ``cols`` of rows older than ``days`` unless their
    ``key`` is under legal hold. Holds are joined by key (a left join with a
    presence marker on distinct held keys), so their size does not matter."""
    old = F.col(ts) < cutoff(as_of, days)
    out = df
    if holds is not None:
        h = holds.select(key).distinct().withColumn("_held", F.lit(True))
        out = out.join(h, key, "left")
        old = old & F.col("_held").isNull()
    out = out.select(*[F.when(old, F.lit(None).cast(dict(df.dtypes)[c])).otherwise(F.col(c)).alias(c)
                       if c in cols else F.col(c) for c in df.columns])
    return out


def expire_rows(table: VersionedTable, date_col: str, as_of, days: int) -> int:
    """R2: drop rows older than ``days`` as a new version; only batches that
    hold such rows are rewritten (others stay untouched)."""
    return table.delete_where(F.col(date_col).cast("timestamp_ntz") < cutoff(as_of, days), "RETENTION")
