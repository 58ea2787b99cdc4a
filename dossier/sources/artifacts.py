"""Fitted artifacts: saved vocabularies and tables built once."""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F

from dossier.functions.digest import files_digest, json_digest, table_digest
from dossier.operators.vocabulary import (
    TABLE_SCHEMA, Vocabulary, fit_vocabulary, vocabulary_table)
from dossier.sources.writers import write_table
from dossier.spec import EntitySpec


def has_text(spark: SparkSession, path: str) -> bool:
    """Whether there is a text table with rows at ``path``."""
    try:
        return not spark.read.text(path).isEmpty()
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return False
        raise


def mark_done(spark: SparkSession, path: str, target: str, inputs: str) -> None:
    """Leave a receipt for ``path``: where its data lies and the digest of what it was built from.

    It is written after the data, and the data of an earlier receipt is never
    overwritten, so a receipt cannot outlive what it names.
    """
    text = json.dumps({"target": target, "inputs": inputs})
    spark.range(1).select(F.lit(text)).write.mode("overwrite").text(f"{path}.done")


def receipt(spark: SparkSession, path: str) -> dict | None:
    """The receipt of a finished artifact, None before it is finished."""
    if not has_text(spark, f"{path}.done"):
        return None
    return json.loads(spark.read.text(f"{path}.done").first()[0])


def _fresh(path: str) -> str:
    return f"{path}/{uuid.uuid4().hex}"


def save_vocabulary(spark: SparkSession, vocabulary: Vocabulary, path: str, inputs: str = "") -> str:
    target = _fresh(path)
    vocabulary_table(spark, vocabulary).coalesce(1).write.json(target)
    mark_done(spark, path, target, inputs)
    return path


def load_vocabulary(spark: SparkSession, path: str) -> Vocabulary:
    """A saved vocabulary, or an error saying that none was fitted."""
    done = receipt(spark, path)
    if not done:
        raise FileNotFoundError(f"no vocabulary at {path}: fit one on the training split first")
    vocabulary: Vocabulary = {}
    # Bounded: fitting refuses columns over their level limit.
    for row in spark.read.schema(TABLE_SCHEMA).json(done["target"]).orderBy("col", "code").collect():
        vocabulary.setdefault(row.col, []).append(row.level)
    return vocabulary


def ensure_vocabulary(train: DataFrame, spec: EntitySpec, path: str,
                      force: bool = False) -> Vocabulary:
    """The vocabulary of these training rows: the saved one if it was fitted on them, else a new one."""
    spark = train.sparkSession
    rows = train.select(*spec.cat_cols)
    source = files_digest(train) if train.inputFiles() else list(table_digest(rows).first())
    inputs = json_digest({"train": source, "columns": list(spec.cat_cols), "missing": spec.missing_level})
    done = receipt(spark, path)
    if done and done["inputs"] == inputs and not force:
        return load_vocabulary(spark, path)
    vocabulary = fit_vocabulary(train, spec)
    save_vocabulary(spark, vocabulary, path, inputs)
    return vocabulary


def materialize(spark: SparkSession, build: Callable[[], DataFrame], path: str,
                inputs: dict, force: bool = False) -> DataFrame:
    """A table built at most once per distinct ``inputs``.

    ``inputs`` names what the table depends on (source digest, vocabulary
    digest, feature version); its digest is part of the path, so a table built
    from other inputs is never mistaken for this one. ``force`` rebuilds into a
    folder of its own, so a build that fails leaves the earlier table valid.
    """
    digest = json_digest(inputs)
    done = receipt(spark, f"{path}/{digest}")
    if force or not done:
        target = _fresh(f"{path}/{digest}")
        write_table(build(), target)
        mark_done(spark, f"{path}/{digest}", target, digest)
        return spark.read.parquet(target)
    return spark.read.parquet(done["target"])
