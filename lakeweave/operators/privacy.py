"""Privacy operators on DataFrames."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from lakeweave.functions.pii import (EMAIL_PATTERN, PHONE_PATTERN, PHONE_PATTERN_SAFE, leaks, matches,
                                     pass_struct, token_count)
from lakeweave.session import checkpoint_root


def pii_matches(df: DataFrame, col: str) -> DataFrame:
    """E-mail and phone matches of ``col`` as two array columns."""
    return df.withColumn("emails", matches(F.col(col), EMAIL_PATTERN)) \
             .withColumn("phones", matches(F.col(col), PHONE_PATTERN))


def redact_columns(df: DataFrame, cols: Sequence[str], key: bytes, safe: bool = False,
                   keep_found: bool = True) -> DataFrame:
    """Replace each named text column by its redacted form; collect the
    (token, kind, value) triples in ``_pii`` and count distinct tokens."""
    out = df
    found = []
    phone = PHONE_PATTERN_SAFE if safe else PHONE_PATTERN
    for c in cols:
        # Each pass is its own column, so the phone pass reads the e-mail
        # pass's result instead of re-evaluating it per use.
        e, p = f"_e_{c}", f"_p_{c}"
        out = out.withColumn(e, pass_struct(F.col(c), EMAIL_PATTERN, "email", key))
        out = out.withColumn(p, pass_struct(F.col(f"{e}.text"), phone, "phone", key))
        found.append(F.coalesce(F.concat(F.col(f"{e}.found"), F.col(f"{p}.found")), F.array()))
        out = out.withColumn(c, F.col(f"{p}.text"))
    out = out.withColumn("_pii", F.concat(*found) if len(found) > 1 else found[0])
    out = out.withColumn("pii_token_count", token_count(F.col("_pii")))
    out = out.drop(*[f"_e_{c}" for c in cols], *[f"_p_{c}" for c in cols])
    return out if keep_found else out.drop("_pii")


def vault_rows(redacted: DataFrame) -> DataFrame:
    """T4: token -> plaintext rows, one per token; kept in a separate table.

    Several spellings of a value share a token; the least one is kept. The
    aggregate combines map-side, so a value repeated across a third of all
    records is reduced before the shuffle.
    """
    return (redacted.select(F.explode("_pii").alias("p")).groupBy(F.col("p.token").alias("token"))
            .agg(F.min("p.kind").alias("kind"), F.min("p.value").alias("value")))


def leak_check(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Rows whose text still looks like personal data (expected 0)."""
    cond = None
    for c in cols:
        x = F.coalesce(leaks(F.col(c)), F.lit(False))
        cond = x if cond is None else (cond | x)
    return df.agg(F.count(F.lit(1)).alias("rows_checked"),
                  F.count(F.when(cond, 1)).alias("rows_leaking"))


def land_bronze(df: DataFrame, table, redact_cols: Sequence[str] = (), key: bytes | None = None,
                safe: bool = False, vault=None) -> int:
    """Land rows in Bronze with the named text columns tokenized, so no
    readable table holds the plaintext; the vault rows are merged on their
    token into ``vault`` (a separate table) when given. ``safe=True`` leaves
    digits inside words and numbers alone, which :func:`leak_check` reports."""
    if redact_cols:
        if key is None:
            raise ValueError("tokenizing columns needs a key")
        red = redact_columns(df, list(redact_cols), key, safe)
        if vault is not None:
            # redacted once: the vault and the landing read it back
            checkpoint_root(red.sparkSession)
            red = red.checkpoint()
            rows = vault_rows(red)
            vault.merge(rows, "token", when_older="value") if vault.exists() else vault.overwrite(rows)
        df = red.drop("_pii")
    return table.append(df) if table.exists() else table.overwrite(df)
