"""Corpus pipeline: stages that filter, clean and at last pack documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tillsight.llm import decontaminate, jaccard_join, secret_scan, toxicity
from tillsight.llm.queries import packed, table
from tillsight.sources.workspace import written


def not_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the model fitted on the labels finds toxic go."""
    return toxicity.clean(docs, toxicity.fit(docs, table(spark, sf_dir, "labels")))


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each class of near duplicates the document of the smallest id stays."""
    return jaccard_join.first_of_each(docs)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a window of a benchmark item go."""
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark"))


def without_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets in texts are masked; all documents stay."""
    return secret_scan.redact(docs)


def in_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document's pieces with their places in sequences of 4096 tokens."""
    return packed(docs)


STAGES = [("toxicity", not_toxic), ("n-gram Jaccard join", one_of_each),
          ("benchmark decontamination", decontaminated), ("secret scans", without_secrets),
          ("best-fit packing", in_sequences)]

#: The stages learn, sample token paths, run an automaton and tokenise, which SQL cannot express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; every stage but the last is written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
