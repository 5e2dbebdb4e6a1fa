"""Personal-data detection and deterministic tokenization.

Everything here is a Catalyst expression: HMAC-SHA256 is assembled from
``sha2`` and ``unhex`` with the key's inner/outer pads precomputed once on the
driver, and "replace each match by a function of the match" is
``split`` + ``regexp_extract_all`` + ``zip_with``. No Python worker runs.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, functions as F

# Fixed values that must equal the reference for identical tokens:
# the e-mail and Vietnamese phone patterns (the e-mail one case-insensitive),
# the token format tok_<kind>_<first 24 hex of HMAC-SHA256>, and the demo key
# used by its proof of concept (a real deployment passes its own key).
EMAIL_PATTERN = r"(?i)\b[A-Z0-9._%+-]+@[A-Z0-9.-]+\.[A-Z]{2,}\b"
PHONE_PATTERN = r"(?:\+?84|0)[\s.-]?\d{2,3}[\s.-]?\d{3}[\s.-]?\d{3,4}\b"
TOKEN_HEX_CHARS = 24
DEMO_KEY = b"demo-key-store-this-in-kms"

# Safe mode: a phone number may not start inside a word or a number, so
# digits inside tokens, ids and longer numbers are left alone.
PHONE_PATTERN_SAFE = r"(?<![\w+])" + PHONE_PATTERN

KINDS = {"email": EMAIL_PATTERN, "phone": PHONE_PATTERN}


def hmac_pads(key: bytes) -> tuple[str, str]:
    """Hex of (K xor ipad, K xor opad) for HMAC-SHA256 (block size 64)."""
    if len(key) > 64:
        key = hashlib.sha256(key).digest()
    k = key.ljust(64, b"\0")
    return bytes(b ^ 0x36 for b in k).hex(), bytes(b ^ 0x5C for b in k).hex()


def normalize(value: Column) -> Column:
    """lower-case, all whitespace removed (strip is implied)."""
    return F.regexp_replace(F.lower(value), r"\s+", "")


def hmac_sha256_hex(message: Column, key: bytes) -> Column:
    """hex HMAC-SHA256 of the UTF-8 bytes of ``message``."""
    ipad, opad = hmac_pads(key)
    inner = F.sha2(F.concat(F.unhex(F.lit(ipad)), F.encode(message, "UTF-8")), 256)
    return F.sha2(F.concat(F.unhex(F.lit(opad)), F.unhex(inner)), 256)


def token(kind: str, value: Column, key: bytes) -> Column:
    """``tok_<kind>_<24 hex>`` of the normalized value."""
    return F.concat(F.lit(f"tok_{kind}_"),
                    F.substring(hmac_sha256_hex(normalize(value), key), 1, TOKEN_HEX_CHARS))


def matches(text: Column, pattern: str) -> Column:
    """All non-overlapping matches, left to right."""
    return F.regexp_extract_all(text, F.lit(pattern), 0)


def replace_pass(text: Column, pattern: str, kind: str, key: bytes) -> tuple[Column, Column, Column]:
    """every match of ``pattern`` replaced by its token.

    Returns (new text, tokens, matched values). ``split(..., -1)`` yields one
    more piece than there are matches; ``zip_with`` pads the token array with
    a NULL for the last piece.
    """
    pieces = F.split(text, pattern, -1)
    found = matches(text, pattern)
    toks = F.transform(found, lambda m: token(kind, m, key))
    joined = F.array_join(F.zip_with(pieces, toks, lambda p, t: F.concat(p, F.coalesce(t, F.lit("")))), "")
    return joined, toks, found


def redact(text: Column, key: bytes, safe: bool = False) -> Column:
    """E-mail pass, then phone pass over its output.

    Returns ``struct(text, found array<struct<token, kind, value>>)``. With
    ``safe=True`` the phone pattern cannot start inside a word or number, so
    it never re-tokenizes digits of an e-mail token or of a JSON number.
    """
    t1, tok_e, val_e = replace_pass(text, EMAIL_PATTERN, "email", key)
    t2, tok_p, val_p = replace_pass(t1, PHONE_PATTERN_SAFE if safe else PHONE_PATTERN, "phone", key)
    pairs_e = F.transform(F.arrays_zip(tok_e.alias("token"), val_e.alias("value")),
                          lambda r: F.struct(r["token"].alias("token"), F.lit("email").alias("kind"),
                                             r["value"].alias("value")))
    pairs_p = F.transform(F.arrays_zip(tok_p.alias("token"), val_p.alias("value")),
                          lambda r: F.struct(r["token"].alias("token"), F.lit("phone").alias("kind"),
                                             r["value"].alias("value")))
    return F.struct(t2.alias("text"), F.concat(pairs_e, pairs_p).alias("found"))


FOUND_TYPE = "array<struct<token:string,kind:string,value:string>>"


def pass_struct(text: Column, pattern: str, kind: str, key: bytes) -> Column:
    """One redaction pass as ``struct(text, found)``. Texts with no match
    (most of them) are returned as they are after a single regex scan; only
    texts that match are split, tokenized and rebuilt. ``text`` should be a
    column reference: it is used several times."""
    t2, toks, vals = replace_pass(text, pattern, kind, key)
    found = F.transform(F.arrays_zip(toks.alias("token"), vals.alias("value")),
                        lambda r: F.struct(r["token"].alias("token"), F.lit(kind).alias("kind"),
                                           r["value"].alias("value")))
    return (F.when(text.rlike(pattern), F.struct(t2.alias("text"), found.alias("found")))
            .otherwise(F.struct(text.alias("text"), F.array().cast(FOUND_TYPE).alias("found"))))


def token_count(found: Column) -> Column:
    """T5: number of distinct tokens produced for one record."""
    return F.size(F.array_distinct(F.transform(found, lambda r: r["token"])))


TOKEN_PATTERN = r"tok_(?:email|phone)_[0-9a-f]{1,24}"


def leaks(text: Column) -> Column:
    """Whether a text holds an e-mail or phone outside its tokens, by the
    full patterns, whichever pattern the redaction went by."""
    rest = F.regexp_replace(text, TOKEN_PATTERN, "#")
    return rest.rlike(EMAIL_PATTERN) | rest.rlike(PHONE_PATTERN)
