"""Every operator and stage on nulls, empty and long texts, repeated rows, no rows and clashing columns."""

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from dossier.llm import (
    brown, decontaminate, langid, license, lines, mainhtml, pieces, quality, simhash, substrings)


@pytest.fixture(scope="module")
def items(spark):
    return spark.createDataFrame(
        [(1, "One two three four. Five six. Seven eight nine."), (2, None), (3, ""), (3, "never there at all")],
        "item_id long, text string")


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame(
        [(1, 1, 0), (2, 0, 0), (2, 0, 0), (None, 1, 0), (5, None, None)], "doc_id long, quality int, toxic int")


@pytest.fixture(scope="module")
def operators(items, labels):
    return {
        "simhash": simhash.near_duplicates, "brown": lambda d: brown.score(d, classes=6, rounds=2),
        "langid": langid.identify, "substrings": substrings.substring_dedup,
        "quality": lambda d: quality.quality_rules(d, labels), "license": license.license_scan,
        "lines": lines.line_dedup, "pieces": pieces.encode,
    }


@pytest.mark.parametrize("name", ["simhash", "brown", "langid", "substrings", "quality", "license", "lines", "pieces"])
def test_every_row_has_a_result(name, operators, messy, empty, odd_columns):
    operator = operators[name]
    ids = sorted(str(r["doc_id"]) for r in messy.collect())
    got = operator(messy).collect()
    assert sorted(str(r["doc_id"]) for r in got) == ids
    assert operator(empty).count() == 0
    plain = lambda rows: sorted(
        repr([round(v, 9) if isinstance(v, float) else v for v in r]) for r in rows)
    assert plain(operator(odd_columns).collect()) == plain(got)


def test_matches_of_odd_rows(messy, empty, odd_columns, items):
    got = decontaminate.decontamination(messy, items)
    assert sorted((r["doc_id"], r["item_id"], r["distance"]) for r in got.collect()) == [(1, 1, 0), (1, 1, 0)]
    assert decontaminate.decontamination(empty, items).count() == 0
    assert decontaminate.decontamination(odd_columns, items.limit(0)).count() == 0
    assert decontaminate.decontamination(odd_columns, items).count() == 2


def test_pages_of_odd_rows(spark):
    pages = spark.createDataFrame(
        [(1, "u", None), (2, None, ""), (None, "u", "<"), (3, "u", "<article><p>Some text.</p></article>"),
         (3, "u", "<article><p>Some text.</p></article>"), (4, "u", "<b>" * 3000 + "x"), (5, "u", "<div>" * 3000 + "x"),
         (6, "u", "<p class='a"), (7, "u", "<script>never closed")],
        "page_id long, url string, html string").withColumn("trait", F.lit(1)).withColumn("text", F.lit("t"))
    got = mainhtml.main_text(pages).collect()
    assert len(got) == 9 and all(r["n_chars"] == len(r["text"]) for r in got)
    assert [r["text"] for r in got if r["page_id"] == 3] == ["Some text."] * 2
    assert all(r["text"] == "" for r in got if r["page_id"] in (1, 2, 6, 7))
    assert mainhtml.main_text(pages.limit(0)).count() == 0


@pytest.fixture(scope="module")
def stage_dir(items, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("stage"))
    items.write.parquet(f"{path}/benchmark.parquet")
    return path


@pytest.mark.parametrize("at", range(len(corpus_pipeline.STAGES)))
def test_stages_on_odd_rows(at, spark, messy, empty, odd_columns, stage_dir):
    stage = corpus_pipeline.STAGES[at][1]
    for docs in (messy, empty, odd_columns):
        out = stage(spark, docs, stage_dir)
        if at < len(corpus_pipeline.STAGES) - 1:
            assert out.columns == docs.columns
            assert [f.dataType for f in out.schema] == [f.dataType for f in docs.schema]
        rows = out.collect()
        assert len(rows) <= docs.count()
    assert stage(spark, empty, stage_dir).count() == 0


def test_near_dedup_keeps_one_of_repeated_rows(spark, messy):
    left = corpus_pipeline.near_dedup(spark, messy, "").collect()
    texts = [r["text"] for r in left]
    assert sum(t is not None and t.startswith("One two") for t in texts) == 1
    assert sum(t is None or not t.split() for t in texts) == 1  # all without words are one group


def test_decontamination_takes_out_the_dirty(spark, messy, stage_dir):
    left = corpus_pipeline.decontamination(spark, messy, stage_dir)
    assert sorted(str(r["doc_id"]) for r in left.collect()) == ["2", "3", "4", "5", "6", "7", "8", "None", "None"]
