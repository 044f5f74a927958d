"""The registered queries of the training-data operators, each over its whole table, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tickwise.llm import (chat, decontaminate, hnsw, html_template, importance, langid, merkle, mixing, pii, quality, secrets, superminhash,
                          token_records)
from tickwise.llm.common import table


def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op2_benchmark_containment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op3_chat_snapshots(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.render(table(spark, sf_dir, "conversations"))


def op4_html_templates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_template.extract(table(spark, sf_dir, "pages"))


def op5_embedding_hnsw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hnsw.near_duplicates(table(spark, sf_dir, "embeddings"))


def op6_pii_bootstrap(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.report(table(spark, sf_dir, "documents"))


def op7_linked_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.report(table(spark, sf_dir, "documents"))


def op8_language_hypervectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.identify(table(spark, sf_dir, "documents"))


def op9_systematic_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


def op10_superminhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return superminhash.duplicates(table(spark, sf_dir, "documents"))


def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.manifest(table(spark, sf_dir, "documents"))


def op12_token_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    from public_tokenizers import path  # only this query needs the package

    folder = token_records.write(table(spark, sf_dir, "documents"), path("byte_bpe_50k.json"))
    return token_records.digests(spark, folder)


def op13_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return importance.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {f.__name__: f for f in (
    op1_quality_rules, op2_benchmark_containment, op3_chat_snapshots, op4_html_templates, op5_embedding_hnsw,
    op6_pii_bootstrap, op7_linked_secrets, op8_language_hypervectors, op9_systematic_mix, op10_superminhash, op11_merkle_manifest, op12_token_records, op13_importance_resampling)}

SQL: dict[str, str] = {
    "op2_benchmark_containment": decontaminate.DECON_SQL,
    "op3_chat_snapshots": chat.CHAT_SQL,
    "op5_embedding_hnsw": hnsw.EMBED_SQL,
    "op9_systematic_mix": mixing.MIX_SQL,
    "op10_superminhash": superminhash.NEAR_SQL,
    "op11_merkle_manifest": merkle.MERKLE_SQL,
    "op13_importance_resampling": importance.IMPORTANCE_SQL,
}
