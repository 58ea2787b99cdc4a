"""The registered queries of this folder, each over its whole tables, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from dossier.llm import (
    brown, decontaminate, langid, license, lines, mainhtml, negatives, packing, periodic, pieces, quality, simhash,
    substrings)
from dossier.llm.common import documents

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {"op9_line_dedup": lines.ORACLE, "op12_hard_negatives": negatives.ORACLE}


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def _table(spark, sf_dir, name):
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query
def op1_simhash(spark, sf_dir):
    return simhash.near_duplicates(documents(spark, sf_dir))


@query
def op2_class_model(spark, sf_dir):
    return brown.score(documents(spark, sf_dir))


@query
def op3_main_text(spark, sf_dir):
    return mainhtml.main_text(_table(spark, sf_dir, "pages"))


@query
def op4_language(spark, sf_dir):
    return langid.identify(documents(spark, sf_dir))


@query
def op5_substrings(spark, sf_dir):
    return substrings.substring_dedup(documents(spark, sf_dir))


@query
def op6_quality_rules(spark, sf_dir):
    return quality.quality_rules(documents(spark, sf_dir), _table(spark, sf_dir, "labels"))


@query
def op7_license_scan(spark, sf_dir):
    return license.license_scan(documents(spark, sf_dir))


@query
def op8_decontamination(spark, sf_dir):
    return decontaminate.decontamination(documents(spark, sf_dir), _table(spark, sf_dir, "benchmark"))


@query
def op9_line_dedup(spark, sf_dir):
    return lines.line_dedup(documents(spark, sf_dir))


@query
def op10_pieces(spark, sf_dir):
    return pieces.encode(documents(spark, sf_dir))


@query
def op11_periodic_runs(spark, sf_dir):
    return periodic.run_digests(periodic.planted(documents(spark, sf_dir)))


@query
def op12_hard_negatives(spark, sf_dir):
    return negatives.hard_negatives(_table(spark, sf_dir, "embeddings"))


@query
def op13_packing(spark, sf_dir):
    return packing.piece_checksums(documents(spark, sf_dir))
