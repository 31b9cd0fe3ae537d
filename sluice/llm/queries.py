"""Registered queries of this package and, where SQL can express one, its DuckDB SQL."""

from __future__ import annotations

from sluice.llm import (fill_in_middle, importance, jaccard_join, mixing, neighbours, packing, pii, quality_rules, sharding, suffix_dedup,
                        token_counts, token_files, warc)
from sluice.llm.common import documents

QUERIES = {
    "op1_neighbours": lambda spark, sf: neighbours.nearest(spark.read.parquet(f"{sf}/embeddings.parquet")),
    "op2_packing": lambda spark, sf: packing.pack_documents(documents(spark, sf)),
    "op3_suffix_dedup": lambda spark, sf: suffix_dedup.repeated_passages(documents(spark, sf)),
    "op4_mixing": lambda spark, sf: mixing.mixing_digest(documents(spark, sf)),
    "op5_pii": lambda spark, sf: pii.find(documents(spark, sf)),
    "op6_warc": lambda spark, sf: warc.warc_digest(spark.read.parquet(f"{sf}/pages.parquet")),
    "op7_quality_rules": lambda spark, sf: quality_rules.quality_digest(documents(spark, sf)),
    "op8_token_files": lambda spark, sf: token_files.token_digest(documents(spark, sf)),
    "op9_jaccard_join": lambda spark, sf: jaccard_join.near_duplicates(documents(spark, sf), n=4, t=0.85),
    "op10_sharding": lambda spark, sf: sharding.shard_documents(documents(spark, sf)),
    "op11_fill_in_middle": lambda spark, sf: fill_in_middle.fim_digest(documents(spark, sf)),
    "op12_importance": lambda spark, sf: importance.importance_digest(documents(spark, sf), spark.read.parquet(f"{sf}/benchmark.parquet")),
    "op13_token_counts": lambda spark, sf: token_counts.count_digest(documents(spark, sf)),
}
ORACLE = {
    "op11_fill_in_middle": fill_in_middle.FIM_SQL,
    "op12_importance": importance.IMPORTANCE_SQL,
}
