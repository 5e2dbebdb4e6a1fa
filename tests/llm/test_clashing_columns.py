"""Every operator that keeps its input's columns, with names that its own could clash with."""

import numpy as np
import pytest
from llm_rows import docs, edges
from pyspark.sql import functions as F

from lakeweave.llm import bpe, decontaminate, filter_audit, line_dedup, merkle, near_dups, pii_boost, quality, suffix_dedup, token_counts

NAMES = ["score", "_score", "label", "g", "s", "h", "doc", "cuts", "lines", "gone", "_gone", "hits", "_hits", "items", "n_words", "_n_words", "node", "gone_id",
         "_n_gone", "_l_cuts", "payload", "bucket", "component", "kept", "key", "piece", "ids", "row", "at", "pos", "tree", "path", "mask", "part", "digest", "n", "kind",
         "base", "added", "spans", "place", "domain", "n_tokens", "epoch", "_q_score"]


def wide(spark):
    return docs(spark, edges()).select("*", *(F.lit(i).alias(n) for i, n in enumerate(NAMES)))


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame([(i, i % 2, 0) for i in range(1, 12)], "doc_id bigint, quality int, toxic int")


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_filters_keep_their_input(spark, labels):
    bench = spark.createDataFrame([("a", "nothing of it occurs anywhere here at all today")], "item_id string, text string")
    own = docs(spark, edges())
    for run in (lambda d: quality.keep_good(d, labels), line_dedup.keep_first, near_dups.keep_one, lambda d: decontaminate.clean(d, bench),
                lambda d: decontaminate.clean(d, bench, block_bytes=8)):
        got, plain = run(wide(spark)), run(own)
        assert got.columns == [*own.columns, *NAMES]
        assert rows(got.select(own.columns)) == rows(plain)


def test_reports_ignore_further_columns(spark, labels):
    import public_tokenizers
    path, pattern = str(public_tokenizers.path("byte_bpe_50k.tiktoken")), public_tokenizers.PATTERN
    bench = spark.createDataFrame([("a", "no id at all, five words")], "item_id string, text string")
    model = pii_boost.train(docs(spark, edges()).limit(0))
    for run in (lambda d: decontaminate.report(d, bench), near_dups.groups, suffix_dedup.report, line_dedup.report, merkle.report,
                lambda d: filter_audit.report(d, labels), lambda d: bpe.report(d, path, pattern),
                lambda d: token_counts.count_tokens(d, str(public_tokenizers.path("word_bpe_49k.json"))),
                lambda d: pii_boost.spans(d, model=model).select("doc_id", "base", "added")):
        assert rows(run(wide(spark))) == rows(run(docs(spark, edges())))


def test_shared_ids_give_one_model(spark, labels):
    """Rows that share a labelled id: which one teaches does not depend on their order."""
    own = docs(spark, [*edges(), *((3, f"other text {i} " * 9, "en", "s", 1) for i in range(5))])
    a, b = (rows(quality.score(d.select("doc_id", "text"), labels).select("doc_id", "score")) for d in (own, own.orderBy(F.desc("text")).repartition(3)))
    assert [x[0] for x in a] == [x[0] for x in b] and [round(x[1], 9) for x in a] == [round(x[1], 9) for x in b]


def test_features_are_taken_in_bounded_parts():
    """Ten thousand short texts, and long ones: no part is over its texts or bytes."""
    sizes = np.array([3] * 10_000 + [100_000] * 7 + [900_000, 0, 5])
    offsets = np.concatenate(([0], np.cumsum(sizes)))
    ranges = list(quality.parts(offsets))
    assert [i for i, _ in ranges] == [0, *(j for _, j in ranges[:-1])] and ranges[-1][1] == len(sizes)
    assert all(j - i <= quality.PART_TEXTS and (offsets[j] - offsets[i] <= quality.PART_BYTES or j == i + 1) for i, j in ranges)


def test_a_score_does_not_depend_on_its_batch():
    rng = np.random.default_rng(5)
    data = rng.integers(32, 126, 40_000).astype(np.uint8)
    grams, shares = quality.features(data, np.arange(0, 40_001, 400))
    voter = quality.LatentVoter(grams, shares, rng.integers(0, 2, 100), 48, 15)
    alone = np.concatenate([voter.score(grams[k:k + 1], shares[k:k + 1]) for k in range(100)])
    assert np.abs(alone - voter.score(grams, shares)).max() < 1e-12
