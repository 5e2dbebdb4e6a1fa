"""The corpus pipeline over ``documents``.

Quality, line dedup, near-duplicates, benchmark decontamination, mixing: each
stage gets what its predecessor kept, written as Parquet and read again, and
all but the last return the columns of ``documents``.

* ``quality`` drops documents the classifier rejects (score under 0.5).
* ``line_dedup`` keeps one occurrence of each group of like lines; a document
  that loses all its words goes; ``n_chars`` follows the text.
* ``near_dups`` keeps the smallest doc_id of each group (5 words, 0.8).
* ``decontaminate`` drops documents that hold a benchmark window.
* ``mix`` returns the mix: a row for each epoch that takes a document, with
  ``domain``, ``n_tokens`` and ``epoch``.

An empty table, or one that a stage empties, passes through; NULLs and clashing
columns are handled as each operator states.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from lakeweave.llm import decontaminate, line_dedup, mixing, near_dups, quality
from lakeweave.llm.common import cut, table


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality.keep_good(docs, table(spark, sf_dir, "labels"))


def line_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    out = line_dedup.keep_first(docs)
    return out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else out


def near_dup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return near_dups.keep_one(docs)


def decontaminate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark"))


def mix_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mix(docs)


STAGES = [("quality", quality_stage), ("line_dedup", line_stage), ("near_dups", near_dup_stage),
          ("decontaminate", decontaminate_stage), ("mix", mix_stage)]

#: Nearest neighbours and edit distances can't be written as one SQL query over
#: these tables; the stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = cut(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
