"""Mergeable quantile sketches of integer columns (A9, ST2).

A KLL sketch takes a few kilobytes whatever it has seen, and sketches of parts
merge into the sketch of the whole. It holds every value as long as there are
no more than about ``k``; its quantiles are then exact ones.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

#: Sketch parameter, ranks that quantiles are read from, and the rank error that these
#: are checked against: the published bound of one quantile (2.296 / k ** 0.9021) doubled, and a rank's width.
K = 800
RANKS = 1024
RANK_ERROR = 2 * 2.296 / K ** 0.9021 + 1 / RANKS


def sketch(column: str | Column, k: int = K) -> Column:
    return F.kll_sketch_agg_bigint(column, k)


def merged(column: str | Column, k: int = K) -> Column:
    return F.kll_merge_agg_bigint(column, k)


def grid(of: Column) -> Column:
    """A sketch's values at evenly spaced ranks; ranks have to be literals."""
    return F.when(F.kll_sketch_get_n_bigint(of) > 0, F.kll_sketch_get_quantile_bigint(of, F.array(*[F.lit((j + 0.5) / RANKS) for j in range(RANKS)])))


def quantile(values: Column, n: Column, q: float) -> Column:
    """The ``q`` quantile of the ``n`` values behind a grid, interpolated between
    its two nearest values: the exact one, if the sketch holds every value and
    the grid each rank. NULL for a sketch of nothing."""
    at = (n - 1) * F.lit(q)
    low = F.floor(at)
    value = lambda i: values[F.floor((i + 0.5) / n * RANKS).cast("int")].cast("double")
    return value(low) + (at - low) * (value(F.ceil(at)) - value(low))
