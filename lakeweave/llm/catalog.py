"""Queries of the training-data operators and their DuckDB oracle SQL."""

from __future__ import annotations

from importlib import import_module

MODULES = ("decontaminate", "token_counts", "topk", "links", "mixing", "quality", "pii_boost", "near_dups", "line_dedup", "suffix_dedup", "filter_audit", "merkle", "bpe")


def load() -> tuple[dict, dict]:
    """(queries, oracle SQL): each module's QUERIES and ORACLE, and the pipeline."""
    queries: dict = {}
    oracle: dict = {}
    for name in MODULES:
        m = import_module(f"lakeweave.llm.{name}")
        queries.update(m.QUERIES)
        oracle.update(m.ORACLE)
    pipeline = import_module("corpus_pipeline")
    queries["pipeline"] = pipeline.run
    if pipeline.ORACLE_SQL is not None:
        oracle["pipeline"] = pipeline.ORACLE_SQL
    return queries, oracle
