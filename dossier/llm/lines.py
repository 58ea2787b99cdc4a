"""Line dedup by overlapping windows of consecutive lines.

A text is cut at line feeds. A window is ``size`` consecutive lines of one text that are not all blank.
Windows with equal lines are occurrences of each other; in the order (doc_id with null first, row key,
line number) all but the first are later ones, and every line that a later occurrence covers is removed,
covered positions being merged. What a removed line held is still there in the first occurrence.

Null and empty texts and texts with fewer lines than a window lose nothing; a null text stays null.
Rows that repeat both id and text count as one document and are treated alike. Extra columns are kept
by ``dedup_stage`` and ignored by ``line_dedup``; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from dossier.llm.common import K1, K2, row_keys, written

WINDOW_LINES = 3


def later_windows(docs: DataFrame, size: int = WINDOW_LINES) -> DataFrame:
    """Row keys and the start line of every later occurrence of a window."""
    k1, k2 = row_keys()
    cut = docs.select("doc_id", k1, k2, F.split("text", "\n", -1).alias("lines"))
    last = F.size("lines") - size

    def window(i):
        lines = [F.element_at("lines", i + 1 + j) for j in range(size)]
        blank = F.lit(True)
        for line in lines:
            blank = blank & (F.trim(line) == "")
        return F.struct(
            i.alias("start"), F.xxhash64(*lines).alias("h1"),
            F.xxhash64(F.lit(1), *lines).alias("h2"), blank.alias("blank"))

    windows = (
        cut.where(F.size("lines") >= size)
        .select("doc_id", K1, K2, F.explode(F.transform(F.sequence(F.lit(0), last), window)).alias("w"))
        .where(~F.col("w.blank"))
        .select(F.struct("doc_id", K1, K2, F.col("w.start").alias("start")).alias("at"), "w.h1", "w.h2"))
    windows = written(windows, "line-windows")
    first = (
        windows.groupBy("h1", "h2").agg(F.min("at").alias("first"), F.max("at").alias("last"))
        .where(F.col("first") != F.col("last")).select("h1", "h2", "first"))
    return (
        windows.join(first, ["h1", "h2"]).where(F.col("at") != F.col("first"))
        .select("at.*"))


def _decided(docs: DataFrame, size: int) -> DataFrame:
    """All rows of ``docs`` with ``lines`` and ``kept``, the numbers of the lines that stay."""
    covered = (
        later_windows(docs, size).groupBy(K1, K2)
        .agg(F.collect_set("start").alias("starts"))
        .select(K1, K2, F.flatten(F.transform("starts", lambda s: F.sequence(s, s + size - 1)))
                .alias("llm__covered")))
    k1, k2 = row_keys()
    every = F.sequence(F.lit(0), F.size("llm__lines") - 1)
    return (
        docs.select("*", k1, k2, F.split("text", "\n", -1).alias("llm__lines"))
        .join(covered, [K1, K2], "left")
        .withColumn("llm__kept", F.when(F.col("llm__covered").isNull(), every).otherwise(
            F.array_except(every, "llm__covered"))))


def _text():
    lines = F.transform("llm__kept", lambda i: F.element_at("llm__lines", i + 1))
    return F.when(F.col("llm__covered").isNull(), F.col("text")).otherwise(F.array_join(lines, "\n"))


def line_dedup(docs: DataFrame, size: int = WINDOW_LINES) -> DataFrame:
    """doc_id, n_lines, n_removed and the text that is left, one row per row of ``docs``."""
    lines = F.when(F.col("text").isNull(), 0).otherwise(F.size("llm__lines"))
    return _decided(docs.select("doc_id", "text"), size).select(
        "doc_id", lines.cast("long").alias("n_lines"),
        F.when(F.col("llm__covered").isNull(), 0).otherwise(lines - F.size("llm__kept"))
        .cast("long").alias("n_removed"),
        _text().alias("text"))


def dedup_stage(docs: DataFrame, size: int = WINDOW_LINES) -> DataFrame:
    """The columns of ``docs`` with the shorter text; ``n_chars``, where there is one, follows it."""
    out = _decided(docs, size).withColumn("text", _text())
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.when(
            F.col("llm__covered").isNull(), F.col("n_chars")).otherwise(
            F.length("text")).cast(docs.schema["n_chars"].dataType))
    return out.select(*docs.columns)


#: The same rows in DuckDB, by the lines themselves instead of their hashes.
ORACLE = """
WITH cut AS (
  SELECT doc_id, text, string_split(text, chr(10)) AS lines FROM documents),
w AS (
  SELECT doc_id, unnest(range(0, len(lines) - 2)) AS s, lines FROM cut WHERE len(lines) >= 3),
win AS (
  SELECT doc_id, s, lines[s+1] AS a, lines[s+2] AS b, lines[s+3] AS c FROM w),
ranked AS (
  SELECT doc_id, s, row_number() OVER (PARTITION BY a, b, c ORDER BY doc_id, s) AS rn
  FROM win WHERE NOT (trim(a) = '' AND trim(b) = '' AND trim(c) = '')),
covered AS (
  SELECT DISTINCT doc_id, unnest([s, s + 1, s + 2]) AS p FROM ranked WHERE rn > 1),
gone AS (SELECT doc_id, list(p) AS ps FROM covered GROUP BY doc_id)
SELECT cut.doc_id,
  CASE WHEN text IS NULL THEN 0 ELSE len(lines) END::BIGINT AS n_lines,
  coalesce(len(ps), 0)::BIGINT AS n_removed,
  CASE WHEN ps IS NULL THEN text ELSE array_to_string(
    [lines[i + 1] FOR i IN range(0, len(lines)) IF NOT list_contains(ps, i)], chr(10)) END AS text
FROM cut LEFT JOIN gone ON cut.doc_id = gone.doc_id
"""
