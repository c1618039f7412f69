"""From documents to token files: each stage works on what the one before kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ebbline.llm import decontamination, mixing, near_duplicates, queries, toxicity
from ebbline.llm.common import read_table, small_batches
from ebbline.session import stage


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not predicted toxic; the machine is trained on the labels of ``docs`` that are not held out."""
    return toxicity.clean_rows(docs, read_table(spark, sf_dir, "labels"))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates, the one with the least id."""
    return near_duplicates.kept_rows(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of a benchmark item."""
    return decontamination.clean_rows(docs, read_table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them, so some twice and some not at all."""
    return mixing.mix(docs)


def token_files(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Write the ids of every row in binary files and return what is read back from them."""
    with small_batches(spark):
        return queries.token_file_rows(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("mixing", mix_sources),
    ("token_files", token_files),
]

#: SQL can express neither the trained machine nor the token files; tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for name, function in STAGES[:-1]:
        docs = stage(function(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
