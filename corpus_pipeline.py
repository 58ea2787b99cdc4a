"""The corpus pipeline: stages over ``documents``, each written and read again as the next one's input."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from dossier.llm import decontaminate, langid, lines, pieces, simhash
from dossier.llm.common import documents, written


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a letter, or like none of the learned languages, go."""
    return langid.language_stage(docs)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The lines of later occurrences of a three-line window go; the documents stay."""
    return lines.dedup_stage(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash group stays."""
    return simhash.dedup_stage(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold an item of ``benchmark`` within its edit budget go."""
    return decontaminate.decontamination_stage(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The ids of each document's text, with the check that they decode to it."""
    return pieces.encode(docs)


STAGES = [
    ("language ID", language),
    ("line dedup", line_dedup),
    ("SimHash near-dedup", near_dedup),
    ("benchmark decontamination", decontamination),
    ("SentencePiece encoding", encoding),
]

#: The learned prototypes, fingerprints and shortest paths have no SQL form; the stages are tested by brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in order over the documents of ``sf_dir``."""
    docs = documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
