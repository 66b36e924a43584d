"""The training-data pipeline: quality rules, quality classifier, near-dedup, secret scan, packing.

``run`` applies the stages to ``documents``; each stage reads what its predecessor wrote.  The rules and
the classifier drop documents, of each near-duplicate group the first stays, secrets are masked in the
texts, and packing returns the pieces of the windows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from voxloom.llm import neardup, packing, quality, rules, secrets
from voxloom.llm.common import prepared, saved
from voxloom.llm.queries import pieces


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 6: documents that the weighed votes of the rules reject go."""
    prepared(spark)
    return rules.keep_good(docs)


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 4: learnt on the labelled documents of the corpus, low scores go."""
    prepared(spark)
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return quality.keep_good(docs, labels, train_on=spark.read.parquet(f"{sf_dir}/documents.parquet"))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 5 on five-word shingles at similarity 0.8: one document of each group stays."""
    prepared(spark)
    return neardup.keep_one(docs, k=5, percent=80)


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 9: findings are masked in the text."""
    prepared(spark)
    return secrets.masked(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 7: the pieces of the packed windows."""
    prepared(spark)
    return pieces(packing.pack(docs))


STAGES = [
    ("quality rules", quality_rules),
    ("quality classifier", quality_classifier),
    ("MinHash near-dedup", near_dedup),
    ("secret scan", secret_scan),
    ("packing", pack),
]
#: Classifier, network and packing have no SQL; tests hold the run against a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = saved(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
