"""The corpus pipeline: ``documents`` through five operators, each stage's rows written and read again.

1. quality rules: documents outside the adaptive limits go
2. n-gram Jaccard join: of each group of near duplicates the smallest doc_id stays
3. PII: personal data is replaced by its kind in brackets
4. mixing: documents appear as often as the mix takes them
5. packing: the mix as sequences of tokens
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from sluice.llm import jaccard_join, mixing, packing, pii, quality_rules
from sluice.llm.common import documents, stage


def _quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality_rules.filter_documents(docs)


def _near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return jaccard_join.deduplicate(docs, n=5, t=0.8)


def _private(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pii.redact(docs)


def _mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mixed_documents(docs)


def _pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack_documents(docs)


STAGES = [("quality rules", _quality), ("n-gram Jaccard join", _near_duplicates), ("personal data", _private),
          ("mixing", _mix), ("best-fit packing", _pack)]

#: The tagger and the tokenizer have no SQL form; tests hold run() against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for name, step in STAGES:
        docs = stage(step(spark, docs, sf_dir), f"pipeline-{name.replace(' ', '-')}")
    return docs
