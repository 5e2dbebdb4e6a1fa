"""Registered privacy queries over ``documents`` and ``conversations``."""

from __future__ import annotations

from pyspark.sql import functions as F

from lakeweave.functions.pii import DEMO_KEY, EMAIL_PATTERN, PHONE_PATTERN, TOKEN_HEX_CHARS, hmac_pads
from lakeweave.operators import privacy as P
from lakeweave.plans.catalog import register, table


def _duck_token(kind: str, v: str) -> str:
    ipad, opad = hmac_pads(DEMO_KEY)
    norm = f"regexp_replace(lower({v}), '\\s+', '', 'g')"
    inner = f"sha256(unhex('{ipad}') || encode({norm}))"
    return f"('tok_{kind}_' || substr(sha256(unhex('{opad}') || unhex({inner})), 1, {TOKEN_HEX_CHARS}))"


def _duck_redact(src: str, key: str, text: str) -> str:
    """CTEs ending in ``red(<key>, redacted, em, pm)`` for the two-pass redaction."""
    return f"""
p1 AS (SELECT {key}, regexp_split_to_array({text}, '{EMAIL_PATTERN}') AS ep,
              regexp_extract_all({text}, '{EMAIL_PATTERN}') AS em FROM {src}),
r1 AS (SELECT {key}, em, array_to_string(list_transform(range(1, len(ep) + 1),
              lambda i: ep[i] || coalesce({_duck_token('email', 'em[i]')}, '')), '') AS t1 FROM p1),
p2 AS (SELECT *, regexp_split_to_array(t1, '{PHONE_PATTERN}') AS pp,
              regexp_extract_all(t1, '{PHONE_PATTERN}') AS pm FROM r1),
red AS (SELECT {key}, em, pm, array_to_string(list_transform(range(1, len(pp) + 1),
              lambda i: pp[i] || coalesce({_duck_token('phone', 'pm[i]')}, '')), '') AS redacted FROM p2)"""


def _duck_tokens_sql() -> str:
    return f"""
tok AS (
  SELECT doc_id, {_duck_token('email', 'v')} AS token, 'email' AS kind, v AS value FROM (
    SELECT doc_id, unnest(em) AS v FROM red)
  UNION ALL
  SELECT doc_id, {_duck_token('phone', 'v')}, 'phone', v FROM (SELECT doc_id, unnest(pm) AS v FROM red))"""


@register("pii_detect_counts", f"""SELECT doc_id,
  len(regexp_extract_all(text, '{EMAIL_PATTERN}')) AS n_emails,
  len(regexp_extract_all(text, '{PHONE_PATTERN}')) AS n_phones
FROM documents
WHERE len(regexp_extract_all(text, '{EMAIL_PATTERN}')) > 0 OR len(regexp_extract_all(text, '{PHONE_PATTERN}')) > 0""")
def q_detect(spark, sf):
    """Documents holding e-mails or phone numbers, with match counts."""
    d = P.pii_matches(table(spark, sf, "documents"), "text")
    return (d.select("doc_id", F.size("emails").alias("n_emails"), F.size("phones").alias("n_phones"))
            .where((F.col("n_emails") > 0) | (F.col("n_phones") > 0)))


@register("pii_redact", f"""WITH {_duck_redact('documents', 'doc_id', 'text').strip()},
{_duck_tokens_sql().strip()}
SELECT r.doc_id, r.redacted AS text, coalesce(t.n, 0) AS pii_token_count
FROM red r LEFT JOIN (SELECT doc_id, count(DISTINCT token) AS n FROM tok GROUP BY doc_id) t USING (doc_id)""")
def q_redact(spark, sf):
    """Every document redacted (whole texts) with its distinct-token count."""
    r = P.redact_columns(table(spark, sf, "documents").select("doc_id", "text"), ["text"], DEMO_KEY, keep_found=False)
    return r.select("doc_id", "text", F.col("pii_token_count").cast("long").alias("pii_token_count"))


@register("pii_vault", f"""WITH {_duck_redact('documents', 'doc_id', 'text').strip()},
{_duck_tokens_sql().strip()}
SELECT token, min(kind) AS kind, min(value) AS value FROM tok GROUP BY token""")
def q_vault(spark, sf):
    """T4: the token vault (token -> kind, plaintext), one row per token.

    Several spellings of one value share a token; the vault keeps the least
    spelling so the table is deterministic.
    """
    r = P.redact_columns(table(spark, sf, "documents").select("doc_id", "text"), ["text"], DEMO_KEY)
    return P.vault_rows(r)


@register("pii_leak_check", f"""WITH {_duck_redact('documents', 'doc_id', 'text').strip()},
both_forms AS (SELECT redacted AS t FROM red UNION ALL SELECT text FROM documents),
rest AS (SELECT regexp_replace(t, 'tok_(email|phone)_[0-9a-f]{{1,24}}', '#', 'g') AS t FROM both_forms)
SELECT count(*) AS rows_checked,
       count(*) FILTER (regexp_matches(t, '{EMAIL_PATTERN}') OR regexp_matches(t, '{PHONE_PATTERN}')) AS rows_leaking FROM rest""")
def q_leak(spark, sf):
    """The redacted documents and, as known leaks, the same documents as they were."""
    d = table(spark, sf, "documents").select("doc_id", "text")
    r = P.redact_columns(d, ["text"], DEMO_KEY, keep_found=False)
    return P.leak_check(r.select("text").unionAll(d.select("text")), ["text"])


@register("pii_vault_landed_twice", f"""WITH {_duck_redact('documents', 'doc_id', 'text').strip()},
{_duck_tokens_sql().strip()}
SELECT token, min(value) AS value FROM tok GROUP BY token""")
def q_vault_twice(spark, sf):
    """T4: documents landed twice leave one vault row a token."""
    from lakeweave.session import shared_dir
    from lakeweave.sources.tables import VersionedTable
    land = VersionedTable(spark, shared_dir(spark, "docs_bronze"))
    vault = VersionedTable(spark, shared_dir(spark, "docs_vault"))
    d = table(spark, sf, "documents").select("doc_id", "text")
    P.land_bronze(d, land, ["text"], DEMO_KEY, vault=vault)
    P.land_bronze(d, land, ["text"], DEMO_KEY, vault=vault)
    return vault.read().select("token", "value")


@register("pii_conversations_redact", f"""WITH {_duck_redact('conversations', 'conv_id, turn', 'text').strip()}
SELECT conv_id, turn, redacted AS text FROM red""")
def q_conv_redact(spark, sf):
    """Conversation turns (prompts and responses) tokenized before landing."""
    r = P.redact_columns(table(spark, sf, "conversations").select("conv_id", "turn", "text"), ["text"], DEMO_KEY,
                         keep_found=False)
    return r.select("conv_id", "turn", "text")


@register("pii_tokenized_landing", f"""WITH {_duck_redact('conversations', 'conv_id, turn, role', 'text').strip()}
SELECT conv_id, turn, role, redacted AS text FROM red""")
def q_tokenized_landing(spark, sf):
    """Conversation turns land already tokenized (reference-exact mode);
    the vault goes to a separate table."""
    from lakeweave.session import shared_dir
    from lakeweave.sources.tables import VersionedTable
    land = VersionedTable(spark, shared_dir(spark, "conv_bronze"))
    vault = VersionedTable(spark, shared_dir(spark, "conv_vault"))
    P.land_bronze(table(spark, sf, "conversations").select("conv_id", "turn", "role", "text"), land,
                  redact_cols=["text"], key=DEMO_KEY, vault=vault)
    return land.read().select("conv_id", "turn", "role", "text")
