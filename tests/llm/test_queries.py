"""The registered queries: against their SQL, and whole."""

import pytest
from compare import difference, duck
from pyspark.sql import functions as F

import __spark_entry__ as entry
import corpus_pipeline
from dossier.llm import queries

ROWS = {"op3_main_text": "pages"}


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_against_sql(name, spark, sf):
    assert difference(queries.QUERIES[name](spark, sf), queries.ORACLES[name], duck(sf)) is None


@pytest.mark.parametrize("name", sorted(set(queries.QUERIES) - {
    "op8_decontamination", "op12_hard_negatives", "op13_packing"}))
def test_a_row_for_every_row(name, spark, sf):
    table = spark.read.parquet(f"{sf}/{ROWS.get(name, 'documents')}.parquet")
    got = queries.QUERIES[name](spark, sf)
    assert got.count() == table.count()
    assert sorted(got.columns)[0] and len(set(got.columns)) == len(got.columns)


def test_decontamination_finds_planted_items(spark, sf):
    planted = spark.read.parquet(f"{sf}/documents.parquet").join(
        spark.read.parquet(f"{sf}/benchmark.parquet").withColumnRenamed("text", "item"),
        F.contains("text", "item")).select("doc_id", "item_id")
    got = queries.QUERIES["op8_decontamination"](spark, sf)
    assert {tuple(r) for r in planted.collect()} <= {tuple(r) for r in got.select("doc_id", "item_id").collect()}


def test_registered():
    assert set(queries.QUERIES) | {"pipeline"} <= set(entry.queries())
    assert [n for n, _ in corpus_pipeline.STAGES] == [
        "language ID", "line dedup", "SimHash near-dedup", "benchmark decontamination", "SentencePiece encoding"]


def test_pipeline_against_plain_steps(spark, sf):
    """The stages' decisions by their operators' reports, one after the other."""
    from dossier.llm import decontaminate, langid, lines, simhash
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    named = langid.identify(docs).where((F.col("lang_pred") != "und") & (F.col("score") >= langid.LEAST_SCORE))
    docs = docs.join(named.select("doc_id"), "doc_id")
    docs = docs.drop("text").join(lines.line_dedup(docs).select("doc_id", "text"), "doc_id")
    docs = docs.join(simhash.near_duplicates(docs).where("doc_id = component_id").select("doc_id"), "doc_id")
    items = spark.read.parquet(f"{sf}/benchmark.parquet")
    docs = docs.join(decontaminate.decontamination(docs, items).select("doc_id"), "doc_id", "left_anti")
    want = {r["doc_id"]: r["text"] for r in docs.collect()}
    got = corpus_pipeline.run(spark, sf)
    assert {r["doc_id"] for r in got.collect()} == set(want)
    assert got.where(~F.col("round_trip")).count() == 0
