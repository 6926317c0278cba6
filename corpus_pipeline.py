"""The corpus pipeline: five stages over ``documents``, each written as Parquet and read again.

quality classifier (rejected documents go) -> quality rules (rejected
documents go) -> SimHash near-duplicates (one document of a group stays) ->
secret scans (secret values are replaced in the texts) -> best-fit packing
(one row per piece: its sequence and place).

A stage takes (spark, docs, sf_dir) and works on all rows of ``docs``.  All
but the last return the columns of ``docs``, extra ones included.  Null and
empty texts have no words, so the classifier or the rules reject them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from pomelo.llm import outlier_rules, packing, quality_mil, secret_dfa, simhash
from pomelo.llm.common import prepare, table
from pomelo.session import scratch_path


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    prepare(spark)
    return quality_mil.keep_good(docs, table(spark, sf_dir, "labels"))


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return outlier_rules.keep_usual(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    prepare(spark)
    return simhash.one_per_component(docs)


def secret_scans(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    prepare(spark)
    return secret_dfa.without_secrets(docs)


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    prepare(spark)
    return packing.packed(docs)


STAGES = [
    ("quality classifier", quality_classifier),
    ("quality rules", quality_rules),
    ("near-duplicates", near_duplicates),
    ("secret scans", secret_scans),
    ("best-fit packing", best_fit_packing),
]

# Fits, fingerprints, automaton and tokenizer have no SQL form; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; the last one's rows."""
    docs = table(spark, sf_dir, "documents")
    for i, (_, stage) in enumerate(STAGES):
        out = stage(spark, docs, sf_dir)
        if i + 1 == len(STAGES):
            return out
        path = scratch_path(spark, f"pipeline-{i}")
        out.write.parquet(path)
        docs = spark.read.parquet(path)
