"""Small tables for the training-data operators, edge cases included."""

import random

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def words(rng, n, size=400):
    return [f"{rng.choice('bcdfgklmnprst')}{rng.choice('aeiou')}{rng.choice('bcdfgklmnprst')}{rng.randrange(size)}" for _ in range(n)]


def plain(rng, n):
    """Sentences over a few lines."""
    w = words(rng, n)
    return "\n".join(" ".join(w[i:i + 12]).capitalize() + "." for i in range(0, n, 12))


def edges():
    """(doc_id, text, lang, source, n_chars): nulls, empties, repeats, a long text."""
    rng = random.Random(5)
    long = plain(rng, 4000)
    base = plain(rng, 120)
    return [(1, base, "en", "src0", len(base)), (2, None, None, None, None), (3, "", "en", "src1", 0), (4, " \n\t ", "en", "src1", 4),
            (5, "one", "de", "src2", 3), (6, base, "en", "src0", len(base)), (6, base, "en", "src0", len(base)),
            (7, long, "fr", "src3", len(long)), (8, "ünï çødé ßtraße 日本語 " * 10, "es", "src99", None), (None, "no id at all, five words", "en", "src0", 24),
            (9, base.upper(), "en", "src0", len(base)), (10, "a" * 700, "en", "src4", 700), (11, "ab\x00c\x1cd e  f", "en", "src4", 9)]


def docs(spark, rows=None):
    return spark.createDataFrame(edges() if rows is None else rows, SCHEMA)
