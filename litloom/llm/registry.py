"""The subpackage's queries, over whole tables, and their DuckDB SQL where SQL can say it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from litloom.llm import assembly, credentials, hnsw, jaccard, lm, merkle, mix, oracles, pack, pipeline, quality, resample, shard, substring, suffix


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


QUERIES = {
    "op1_substring_dedup": lambda spark, sf_dir: substring.substring_digest(_table(spark, sf_dir, "documents")),
    "op2_quality_rules": lambda spark, sf_dir: quality.quality_digest(_table(spark, sf_dir, "documents")),
    "op3_pack": lambda spark, sf_dir: pack.pack_digest(_table(spark, sf_dir, "documents")),
    "op4_shard": lambda spark, sf_dir: shard.shard_digest(_table(spark, sf_dir, "documents")),
    "op5_resample": lambda spark, sf_dir: resample.resample_digest(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels")),
    "op6_jaccard_join": lambda spark, sf_dir: jaccard.jaccard_digest(_table(spark, sf_dir, "documents")),
    "op7_embedding_dedup": lambda spark, sf_dir: hnsw.near_vectors(_table(spark, sf_dir, "embeddings")),
    "op8_suffix_dedup": lambda spark, sf_dir: suffix.suffix_digest(_table(spark, sf_dir, "documents")),
    "op9_lm_score": lambda spark, sf_dir: lm.score_documents(_table(spark, sf_dir, "documents")),
    "op10_mix": lambda spark, sf_dir: mix.mix_digest(_table(spark, sf_dir, "documents")),
    "op11_sale_assembly": lambda spark, sf_dir: assembly.assembled_sales(_table(spark, sf_dir, "sales"), _table(spark, sf_dir, "sale_lines")),
    "op12_secret_scan": lambda spark, sf_dir: credentials.secrets_digest(_table(spark, sf_dir, "documents")),
    "op13_merkle_manifest": lambda spark, sf_dir: merkle.merkle_digest(_table(spark, sf_dir, "documents")),
    "quality_base_counts": lambda spark, sf_dir: quality.quality_digest(_table(spark, sf_dir, "documents")).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"),
    "pipeline": pipeline.run,
}

ORACLE_SQL = {
    "op1_substring_dedup": substring.ORACLE_SQL,
    "op4_shard": oracles.SHARDS,
    "op6_jaccard_join": oracles.SIMILAR,
    "op7_embedding_dedup": oracles.NEAR_VECTORS,
    "op8_suffix_dedup": oracles.REPEATED_BYTES,
    "op13_merkle_manifest": oracles.MERKLE,
    "quality_base_counts": oracles.QUALITY_BASE,
}
