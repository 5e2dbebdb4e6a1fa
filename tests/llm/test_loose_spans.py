"""Trees trained on loosened base spans add obfuscated spans."""

import random

import numpy as np
from llm_rows import docs, words

from lakeweave.llm import pii_boost


def personal(rng):
    card = [rng.randrange(10) for _ in range(15)]
    card = next(s for s in ("".join(map(str, [*card, c])) for c in range(10)) if pii_boost.luhn(s))
    return [f"{words(rng, 1)[0]}.{words(rng, 1)[0]}@{words(rng, 1)[0]}.com", ".".join(str(rng.randrange(1, 256)) for _ in range(4)), card,
            f"+{rng.randrange(10, 99)} ({rng.randrange(100, 999)}) {rng.randrange(100, 999)}-{rng.randrange(1000, 9999)}"]


def test_a_trained_model_adds_obfuscated_spans_only(spark):
    rng = random.Random(31)
    said = lambda: " ".join(words(rng, 5)).translate(str.maketrans("", "", "0123456789"))
    # one document in eight holds a span of one kind: 12 of each, too few for a threshold of its own
    rows = [(i, f"{said()} {personal(rng)[i // 8 % 4] if i % 8 == 0 else rng.randrange(10**8, 10**9)} {said()} {rng.randrange(1900, 2100)} {said()}", "en", "s", 0) for i in range(384)]
    model = pii_boost.train(docs(spark, rows))
    assert np.isfinite(model.cutoffs[:2]).all()
    for form, kind in (("jane.roe (at) mail (dot) com", 0), ("jane[at]mail[dot]com", 0), ("10[.]20[.]30[.]40", 1), ("10(.)20(.)30(.)40", 1)):
        text = f"{said()} {form} {said()}"
        base, added = pii_boost.all_spans(text, model)
        assert base == [] and [(k, text[a:b]) for k, a, b in added] == [(kind, form)]
    plain = [pii_boost.all_spans(f"{said()} {rng.randrange(10**8, 10**9)} {said()} {rng.randrange(1900, 2100)}", model)[1] for _ in range(200)]
    assert sum(map(bool, plain)) <= 10


def test_a_thin_kind_takes_the_pooled_threshold():
    rng = np.random.default_rng(3)
    x = np.column_stack([np.repeat([0, 2], [900, 24]), rng.normal(size=924)]).astype(float)
    y = (x[:, 1] > 0).astype(float)
    model = pii_boost.BoostedTrees(x, y, np.arange(924) % 3 == 0)
    assert np.isfinite(model.cutoffs[[0, 2]]).all() and np.isinf(model.cutoffs[[1, 3]]).all()


def test_ordinary_numbers_stay(spark):
    """Numbers that are nobody's, in the contexts that personal data is in."""
    rng = random.Random(41)
    said = lambda: " ".join(words(rng, 5)).translate(str.maketrans("", "", "0123456789"))
    rows = [(i, f"{said()} {personal(rng)[i % 4]} {said()}", "en", "s", 0) for i in range(600)]
    model = pii_boost.train(docs(spark, rows))
    assert np.isfinite(model.cutoffs).all()
    plain = ["2024-01-15", "12.05.2023", "ISBN 978-3-16-148410-0", "order 20240115123456", "pages 120-125 130-140", "1234567890", "3.14159265358", "1 200 300 400",
             "1000 2000 3000", "2024-01-15 10:30:00", "31/12/1999", "4006381333931", "1998-2003", "seats @ 12.50", "12 345 678", "v 1.20.300"]
    marked = {form: sum(bool(pii_boost.all_spans(f"{said()} {form} {said()}", model)[1]) for _ in range(40)) for form in plain}
    assert sum(marked.values()) <= 0.05 * 40 * len(plain), marked
    loose = {"jane.roe (at) mail (dot) com": 0, "jane[at]mail[dot]com": 0, "10[.]20[.]30[.]40": 1, "4111.1111.1111.1111": 2, "0049 (301) 234-5678": 3}
    for form, kind in loose.items():
        got = [pii_boost.all_spans(f"{said()} {form} {said()}", model)[1] for _ in range(40)]
        assert sum(len(g) == 1 and g[0][0] == kind for g in got) >= 36, form
