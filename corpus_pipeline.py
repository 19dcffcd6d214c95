"""The corpus pipeline: toxicity filter, near-duplicate removal, decontamination, personal data, source mixing.

Each stage takes (spark, docs, sf_dir) and works on all rows that the stage before kept; all but the last return the
columns of documents. run() writes every stage's result as Parquet to the shared folder and reads it for the next one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventmill.llm import decontamination, mixing, pii, simhash, toxicity
from eventmill.llm.common import table, unused, written


def toxicity_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, trained on the labelled rows of docs, does not reject."""
    scorer = toxicity.train(docs, table(spark, sf_dir, "labels"))
    score = unused(docs, "score")
    return toxicity.scored(docs, scorer, into=score).filter(F.col(score) < 0.5).select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: the one with the smallest id."""
    return simhash.deduplicated(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return decontamination.clean(docs, table(spark, sf_dir, "benchmark"))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with personal data replaced by surrogates and n_chars counted anew."""
    done = pii.pseudonymise(docs).select(*docs.columns)
    return done.withColumn("n_chars", F.coalesce(F.length("text"), F.lit(0)).cast("long")) if "n_chars" in docs.columns else done


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row per document: how often the mix takes it (copies) and how many words that is (taken)."""
    return mixing.mix(docs)


STAGES = [
    ("toxicity", toxicity_filter),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontaminate),
    ("personal_data", personal_data),
    ("mixing", mix_sources),
]

#: The classifier, the fingerprints and the surrogates cannot be put in SQL: tests hold the stages against plain loops.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
