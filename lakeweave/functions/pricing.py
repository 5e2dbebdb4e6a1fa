"""Token prices per model.

The price table is a literal of a handful of rows: its size is bounded by the
number of models a deployment prices, never by the data, so broadcasting it is
always safe.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

# USD per one million tokens (input, output) for the three
# fixture models, the same three price points the reference's cost table uses.
DEFAULT_PRICES = {
    "m0": (0.80, 4.00),
    "m1": (3.00, 15.00),
    "m2": (15.00, 75.00),
}

PRICE_SCHEMA = "model string, c_in double, c_out double"


def price_table(spark: SparkSession, prices: dict | None = None) -> DataFrame:
    """Prices as a DataFrame ``(model, c_in, c_out)``."""
    prices = DEFAULT_PRICES if prices is None else prices
    rows = [(m, float(ci), float(co)) for m, (ci, co) in prices.items()]
    return spark.createDataFrame(rows, PRICE_SCHEMA)


def price_maps(prices: dict | None = None) -> tuple[Column, Column]:
    """Literal ``model -> price`` maps; a missing key yields NULL."""
    prices = DEFAULT_PRICES if prices is None else prices
    c_in = F.create_map(*[x for m, (ci, _) in prices.items() for x in (F.lit(m), F.lit(float(ci)))])
    c_out = F.create_map(*[x for m, (_, co) in prices.items() for x in (F.lit(m), F.lit(float(co)))])
    return c_in, c_out


def cost_usd(prompt_tokens: Column, completion_tokens: Column, c_in: Column, c_out: Column) -> Column:
    """Weighted cost: tokens_in * c_in / 1e6 + tokens_out * c_out / 1e6 (A10)."""
    return (prompt_tokens * c_in / F.lit(1_000_000.0)) + (completion_tokens * c_out / F.lit(1_000_000.0))
