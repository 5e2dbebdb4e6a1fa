"""The LLM-call JSON payload: schema, parsing and validation."""

from __future__ import annotations

from pyspark.sql import Column, functions as F, types as T

CORRUPT_COL = "_corrupt"

USAGE_SCHEMA = T.StructType([
    T.StructField("input", T.IntegerType()),
    T.StructField("output", T.IntegerType()),
])

PAYLOAD_SCHEMA = T.StructType([
    T.StructField("model", T.StringType()),
    T.StructField("user_id", T.StringType()),
    T.StructField("usage", USAGE_SCHEMA),
    T.StructField("latency_ms", T.IntegerType()),
    T.StructField("status", T.StringType()),
])


def with_corrupt(schema: T.StructType) -> T.StructType:
    """Schema plus a string field that receives records that do not fit."""
    return T.StructType(list(schema.fields) + [T.StructField(CORRUPT_COL, T.StringType())])


def parse_payload(raw: Column | str, schema: T.StructType = PAYLOAD_SCHEMA) -> Column:
    """JSON text -> struct (F3). Records that do not fit the schema keep their
    text in ``_corrupt`` instead of silently turning into NULL fields."""
    raw = F.col(raw) if isinstance(raw, str) else raw
    return F.from_json(raw, with_corrupt(schema), {"columnNameOfCorruptRecord": CORRUPT_COL,
                                                   "mode": "PERMISSIVE"})


def reject_reason(raw: Column | str, parsed: Column | str) -> Column:
    """Why a Bronze row cannot enter Silver, or NULL when it can (Q2, Q6).

    Order matters: an empty payload is not "malformed", and a type mismatch is
    only reported for text that is a JSON object.
    """
    raw = F.col(raw) if isinstance(raw, str) else raw
    p = F.col(parsed) if isinstance(parsed, str) else parsed
    return (F.when(raw.isNull() | (F.trim(raw) == ""), F.lit("null_payload"))
            .when(F.json_object_keys(raw).isNull(), F.lit("malformed_json"))
            .when(p[CORRUPT_COL].isNotNull(), F.lit("type_mismatch"))
            .when(p["model"].isNull(), F.lit("missing_model")))


def record_to_json(*cols: Column | str) -> Column:
    """Record -> JSON text."""
    return F.to_json(F.struct(*cols))
