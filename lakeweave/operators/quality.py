"""Data-quality operators (Q1-Q6).

Checks are aggregates computed in one pass; the result is a small
expectation table (name, observed, ok), never the data itself.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

Check = tuple[Column, Callable[[Column], Column]]

# Key names that look like personal data. A new payload key
# matching one of these fails closed (it must be declared before landing).
PII_KEY_PATTERN = r"(?i)(e-?mail|phone|mobile|name|address|ssn|passport|birth|user|ip_?addr)"


def expect(df: DataFrame, checks: dict[str, Check]) -> DataFrame:
    """Q1: ``checks`` maps a name to (aggregate, predicate on its value).

    All aggregates run in a single job; the one-row result is unpivoted into
    ``(name, observed, ok)``.
    """
    names = list(checks)
    aggs = [checks[n][0].cast("double").alias(f"_o{i}") for i, n in enumerate(names)]
    oks = [checks[n][1](F.col(f"_o{i}")).alias(f"_k{i}") for i, n in enumerate(names)]
    row = df.agg(*aggs).select("*", *oks)
    pairs = [F.struct(F.lit(n).alias("name"), F.col(f"_o{i}").alias("observed"),
                      F.coalesce(F.col(f"_k{i}"), F.lit(False)).alias("ok")) for i, n in enumerate(names)]
    return row.select(F.inline(F.array(*pairs)))


def new_keys(df: DataFrame, col: str, known: Sequence[str]) -> DataFrame:
    """Q3: top-level JSON keys not in ``known``, with row counts and a
    ``pii_suspect`` flag; a suspect key should fail the load.

    ``known`` is a declared key list, filtered by value.
    """
    keys = (df.select(F.explode(F.json_object_keys(F.col(col))).alias("key"))
            .groupBy("key").agg(F.count(F.lit(1)).alias("n_rows")))
    return (keys.where(~F.col("key").isin(*known))
            .withColumn("pii_suspect", F.col("key").rlike(PII_KEY_PATTERN)))


def _nesting(v: Column) -> Column:
    """How deep a variant's objects and arrays are nested (0: a scalar)."""
    marks = F.regexp_replace(F.regexp_replace(F.schema_of_variant(v), "`[^`]*`", ""), "[^<>]", "")
    empty = F.struct(F.lit(0).alias("now"), F.lit(0).alias("most"))

    def step(a, c):
        now = a["now"] + F.when(c == "<", 1).when(c == ">", -1).otherwise(0)
        return F.struct(now.alias("now"), F.greatest(a["most"], now).alias("most"))
    return F.aggregate(F.split(marks, ""), empty, step, lambda a: a["most"])


def key_paths(df: DataFrame, col: str) -> DataFrame:
    """Q3: one row ``path`` per scalar (or empty object or array) of each row's
    JSON: ``usage.input``, ``tools[].name``; keys other than letters, digits,
    ``_`` and ``-`` are quoted. One pass finds how deep the JSON goes, another
    opens that many levels of it as variants, each scalar once. JSON that
    variants refuse (repeated keys) gives its top-level keys; NULL and
    malformed texts have none."""
    rows = df.select(F.try_parse_json(F.col(col)).alias("value"), F.col(col).alias("raw"))
    depth = rows.agg(F.max(_nesting(F.col("value")))).first()[0] or 0
    flat = rows.select("value", F.explode_outer(F.when(F.col("value").isNull(), F.json_object_keys("raw"))).alias("path"))
    tvf = df.sparkSession.tvf
    for _ in range(depth):
        each = flat.select(F.col("value").alias("parent"), "path").lateralJoin(tvf.variant_explode_outer(F.col("parent").outer()))
        key = F.when(F.col("key").rlike("^[A-Za-z0-9_-]+$"), F.col("key")).otherwise(F.concat(F.lit("'"), F.col("key"), F.lit("'")))
        # no position: a scalar, an empty object or array, or no variant at all
        path = (F.when(F.col("pos").isNull(), F.col("path")).when(F.col("key").isNull(), F.concat(F.coalesce("path", F.lit("")), F.lit("[]")))
                .otherwise(F.concat_ws(".", "path", key)))
        flat = each.select("value", path.alias("path"))
    return flat.where(F.col("path").isNotNull()).select("path")


def new_paths(df: DataFrame, col: str, known: Sequence[str]) -> DataFrame:
    """Q3: paths of JSON scalars at any depth that are not in ``known``, with
    how many there are; a path with a key that looks personal is a suspect."""
    return (key_paths(df, col).groupBy("path").agg(F.count(F.lit(1)).alias("n_values"))
            .where(~F.col("path").isin(*known)).withColumn("pii_suspect", F.col("path").rlike(PII_KEY_PATTERN)))


def gated_landing(df: DataFrame, col: str, known: Sequence[str], table, held) -> bool:
    """Q3: land a load, unless its JSON holds a new key, at any depth, that looks
    personal: then the whole load goes to ``held`` with the reason and ``table``
    gets nothing. Returns whether it landed."""
    suspects = [r["path"] for r in new_paths(df, col, known).where("pii_suspect").select("path").orderBy("path").limit(20).collect()]
    to, rows = (table, df) if not suspects else (held, df.withColumn("reason", F.lit("new keys: " + ", ".join(suspects))))
    to.append(rows) if to.exists() else to.overwrite(rows)
    return not suspects


def duplicate_rate(df: DataFrame, key: str | Sequence[str], digits: int = 6) -> DataFrame:
    """Q4: rows, distinct keys and 1 - distinct/rows."""
    keys = [key] if isinstance(key, str) else list(key)
    s = df.agg(F.count(F.lit(1)).alias("rows"), F.countDistinct(*keys).alias("distinct_keys"))
    return s.withColumn("duplicate_rate",
                        F.round(F.lit(1.0) - F.col("distinct_keys") / F.greatest(F.col("rows"), F.lit(1)), digits))


def duplicate_alert(df: DataFrame, key: str | Sequence[str], baseline: float, tolerance: float = 0.5) -> DataFrame:
    """Q4: flag when the duplicate rate exceeds ``baseline * (1 + tolerance)``."""
    return duplicate_rate(df, key).withColumn(
        "alert", F.col("duplicate_rate") > F.lit(baseline * (1 + tolerance)))


def key_sketches(df: DataFrame, date: str, key: str, log_size: int = 16) -> DataFrame:
    """Q4: per date its rows and a theta sketch of its keys: a bounded stand-in
    that later days are compared with, exact up to ``2 ** log_size`` keys."""
    return df.groupBy(F.col(date).alias("date")).agg(F.count(F.lit(1)).alias("rows"), F.theta_sketch_agg(key, F.lit(log_size)).alias("keys"))


def duplicate_trend(sketches: DataFrame, days: int = 7, tolerance: float = 0.5, digits: int = 6, log_size: int = 16) -> DataFrame:
    """Q4: each date's duplicate rate, that of the ``days`` before it (the
    stored baseline: NULL without any), how many of its keys these had
    already, and whether the rate is over the baseline by ``tolerance``. Only
    the sketches of :func:`key_sketches` are read, one row a date; each goes to
    the days that it is a baseline of."""
    rate = lambda keys, n: F.round(F.lit(1.0) - F.greatest(keys, F.lit(0)) / n, digits)
    ahead = sketches.select(F.explode(F.sequence(F.lit(1), F.lit(days))).alias("ago"), "date", "rows", "keys")
    before = (ahead.groupBy(F.date_add("date", F.col("ago")).alias("date"))
              .agg(F.sum("rows").alias("past_rows"), F.theta_union_agg("keys", F.lit(log_size)).alias("past")))
    day, past = F.theta_sketch_estimate("keys"), F.theta_sketch_estimate("past")
    both = F.theta_sketch_estimate(F.theta_union("keys", "past", F.lit(log_size)))
    out = sketches.join(before, "date", "left").select(
        "date", "rows", day.alias("distinct_keys"), rate(day, F.col("rows")).alias("duplicate_rate"),
        F.when(F.col("past").isNotNull(), rate(past, F.col("past_rows"))).alias("baseline"),
        F.when(F.col("past").isNotNull(), day + past - both).otherwise(0).cast("bigint").alias("seen_before"))
    return out.withColumn("alert", F.coalesce(F.col("duplicate_rate") > F.col("baseline") * F.lit(1 + tolerance), F.lit(False)))


def cost_anomaly(gold: DataFrame, factor: float = 2.0, digits: int = 6) -> DataFrame:
    """Q5: per model and date, day-over-day growth of cost vs. token volume.

    A row is anomalous when cost grew more than ``factor`` times faster than
    tokens. The window partitions by model over Gold (one row per date and
    model), so each partition holds one row per date.
    """
    w = Window.partitionBy("model").orderBy("date")
    tokens = F.col("total_prompt_tokens") + F.col("total_completion_tokens")
    g = gold.select("date", "model", "cost_usd", tokens.alias("tokens"))
    g = g.withColumn("prev_cost", F.lag("cost_usd").over(w)).withColumn("prev_tokens", F.lag("tokens").over(w))
    cost_growth = F.col("cost_usd") / F.col("prev_cost")
    token_growth = F.col("tokens") / F.col("prev_tokens")
    return g.select(
        "date", "model",
        F.round(cost_growth, digits).alias("cost_growth"),
        F.round(token_growth, digits).alias("token_growth"),
        F.coalesce(cost_growth > token_growth * F.lit(factor), F.lit(False)).alias("anomaly"))
