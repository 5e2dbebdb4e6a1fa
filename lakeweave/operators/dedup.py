"""Deduplication.

``first_per_key`` keeps, per key, the row that sorts first by ``order``. It is
written as an aggregate of ``min(struct(order..., rest...))`` instead of a
``row_number()`` window: the aggregate combines map-side before the shuffle,
so a key that holds a third of all rows is reduced inside each map task
instead of landing whole in one reducer, and no sort of the full input is
needed.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F


def _as_list(x: str | Sequence[str]) -> list[str]:
    return [x] if isinstance(x, str) else list(x)


def first_per_key(df: DataFrame, key: str | Sequence[str], order: str | Sequence[str]) -> DataFrame:
    """One row per key, the first by ``order`` ascending (NULLs first).

    When ``order`` does not make rows unique, the remaining columns break the
    tie, so the result is still deterministic.
    """
    keys = _as_list(key)
    order = _as_list(order)
    rest = [c for c in df.columns if c not in keys and c not in order]
    packed = [F.col(c) for c in order + rest]
    out = df.groupBy(*keys).agg(F.min(F.struct(*packed)).alias("_first"))
    return out.select(*[F.col(c) if c in keys else F.col(f"_first.{c}").alias(c) for c in df.columns])


def any_per_key(df: DataFrame, key: str | Sequence[str]) -> DataFrame:
    """One arbitrary row per key (``dropDuplicates``)."""
    return df.dropDuplicates(_as_list(key))


def distinct_rows(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """Distinct rows of a projection."""
    return (df.select(*cols) if cols else df).distinct()
