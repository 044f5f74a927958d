"""A corpus pipeline over ``documents`` from the training-data operators.

Quality classifier (rejected documents go) -> MinHash near-dedup (one document
of each group stays) -> benchmark decontamination (contaminated documents go)
-> PII (spans become [KIND]) -> mixing sources to target weights (documents
are emitted as often as the mix takes them, numbered by ``copy_no``).

Every stage works on all its predecessor kept and every stage but the last
returns the columns of ``documents``.  Null texts, ties, repeated rows and
empty tables follow the operators' own definitions.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tickwise.llm import decontaminate, mixing, pii, quality, superminhash
from tickwise.llm.common import stage, table


def accept_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality.accept(docs, table(spark, sf_dir, "labels"))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return superminhash.keep_one(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark"))


def redact_pii(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pii.redact(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.emit(docs, mixing.mix(docs))


STAGES = [
    ("quality", accept_quality),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("pii", redact_pii),
    ("mixing", mix_sources),
]

#: The fitted classifier and the iterated pattern graph have no SQL form; tests hold run() against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, step in STAGES[:-1]:
        docs = stage(step(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
