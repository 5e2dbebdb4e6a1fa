"""Incremental Gold maintenance (V12): recompute only the dates a Silver
change touched (``rebuild_gold``), or add the changed rows to stored partial
aggregates (``apply_delta``).

The expensive input is Silver; it is read only for the affected dates
(partition pruning on its ``date`` directories). The affected-date list is
bounded by the calendar span of the change (one entry per day), so it is
collected and inlined as a literal filter, which guarantees pruning.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from lakeweave.plans.medallion import build_gold, priced
from lakeweave.session import checkpoint_root
from lakeweave.sources.tables import VersionedTable


def affected_dates(silver: VersionedTable, start: int, end: int, date_col: str = "date") -> list:
    """Distinct dates of rows that changed between two Silver versions."""
    return [r[0] for r in silver.changes(start, end).select(date_col).distinct().collect()]


def rebuild_gold(gold: VersionedTable, silver: VersionedTable, start: int, end: int,
                 prices: DataFrame, exact: bool = True) -> int | None:
    """Replace the Gold rows of affected dates with a recomputation from Silver
    at version ``end``. Returns the new Gold version (None: nothing changed)."""
    dates = affected_dates(silver, start, end)
    if not dates:
        return None
    fresh = build_gold(silver.read(end).where(F.col("date").isin(*[F.lit(d) for d in dates])), prices, exact=exact)
    return replace_dates(gold, fresh, dates)


def replace_dates(gold: VersionedTable, fresh: DataFrame, dates: list) -> int:
    """Put ``fresh`` in the place of the rows of ``dates``: only files that hold
    such rows (whole directories, if the table is partitioned by date) are
    rewritten."""
    lit_dates = [F.lit(d) for d in dates]
    g = gold.read_with_files().where(F.col("date").isin(*lit_dates))
    keep, touched = gold.split_live(gold.commit_info()["batches"], gold.files_where(g))
    kept = gold._read_batches(touched, gold.schema()).where(~F.col("date").isin(*lit_dates))
    return gold.replace_entries(kept.unionByName(fresh), keep, "REBUILD", params={"dates": len(dates)})


#: What a partial aggregate is of: calls with one latency (-1: none) of a date and model.
STATE_KEYS = ["date", "model", "latency"]
TOKENS = ["prompt_tokens", "completion_tokens"]
STATE_SUMS = ["calls", "errors", *TOKENS, *(f"{c}_known" for c in TOKENS)]


def partials(rows: DataFrame, sign: Column | None = None) -> DataFrame:
    """Counts and sums of Silver rows by date, model and latency. They add up:
    with a ``sign`` of -1 rows are taken back. (Silver rows have a date and a
    model: others are in quarantine.)"""
    sign = F.lit(1) if sign is None else sign
    one = lambda c: F.sum(sign * F.coalesce(c, F.lit(0))).cast("bigint")
    failed = F.when(F.col("status") != "ok", 1).otherwise(0)
    return rows.groupBy("date", "model", F.coalesce("latency_ms", F.lit(-1)).alias("latency")).agg(
        one(F.lit(1)).alias("calls"), one(failed).alias("errors"), *(one(F.col(c)).alias(c) for c in TOKENS),
        *(one(F.col(c).isNotNull().cast("int")).alias(f"{c}_known") for c in TOKENS))


def metrics_of(state: DataFrame) -> DataFrame:
    """The daily metrics that the rows behind partial aggregates have. The
    quantiles are exact: a latency counts as often as it has calls."""
    some = F.when(F.col("latency") >= 0, F.col("latency"))
    q = F.percentile(some, F.array(F.lit(0.5), F.lit(0.95)), F.when(F.col("latency") >= 0, F.col("calls")).otherwise(0))
    total = lambda c: F.sum(c).cast("bigint")
    return (state.where("calls > 0").groupBy("date", "model")
            .agg(q.alias("_q"), *(F.when(F.sum(f"{c}_known") > 0, total(c)).alias(f"total_{c}") for c in TOKENS),
                 (total("errors") / total("calls")).alias("error_rate"))
            .select("date", "model", F.col("_q")[0].alias("p50_latency_ms"), F.col("_q")[1].alias("p95_latency_ms"),
                    "total_prompt_tokens", "total_completion_tokens", "error_rate"))


def start_state(state: VersionedTable, gold: VersionedTable, silver: VersionedTable, version: int, prices: DataFrame) -> None:
    """The partial aggregates of a Silver version, and Gold from them."""
    state.overwrite(partials(silver.read(version)), partition_by=["date"])
    gold.overwrite(priced(metrics_of(state.read()), prices), partition_by=["date"])


def apply_delta(state: VersionedTable, gold: VersionedTable, silver: VersionedTable, start: int, end: int, prices: DataFrame) -> int | None:
    """Bring Gold from Silver version ``start`` to ``end`` by the changed
    rows alone: inserted rows are added to the partial aggregates, deleted ones
    taken back, and the Gold rows of their dates are made from the aggregates.
    No other row of Silver is read. Returns the new Gold version (None: nothing
    changed)."""
    checkpoint_root(silver.spark)
    gained = F.col("_change_type").isin("insert", "update_postimage")
    delta = partials(silver.changes(start, end), F.when(gained, 1).otherwise(-1)).checkpoint()
    dates = [r[0] for r in delta.select("date").distinct().collect()]
    if not dates:
        return None
    here = F.col("date").isin(*[F.lit(d) for d in dates])
    old = state.read().where(here).join(delta.select(*STATE_KEYS), STATE_KEYS, "left_semi")
    new = old.unionByName(delta).groupBy(*STATE_KEYS).agg(*(F.sum(c).alias(c) for c in STATE_SUMS))
    # aggregates of no calls stay, as zeros
    state.merge(new, STATE_KEYS, scope=here)
    return replace_dates(gold, priced(metrics_of(state.read().where(here)), prices), dates)
