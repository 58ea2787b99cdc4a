"""The category vocabulary: which levels each category column has, in order."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from dossier.functions.levels import folded_label, level_order
from dossier.spec import EntitySpec

Vocabulary = dict[str, list[str]]

# Levels of one column. Every level becomes an output column, so a column with more
# is taken for a wrong role and refused; ``max_levels`` raises the limit.
MAX_LEVELS = 10_000

TABLE_SCHEMA = "col string, level string, code int"


def long_labels(df: DataFrame, spec: EntitySpec) -> DataFrame:
    """``(col, level)`` for every row and category column."""
    labels = df.select(*[
        folded_label(F.col(c), df.schema[c].dataType, spec.missing_level).alias(c)
        for c in spec.cat_cols])
    return labels.unpivot([], list(spec.cat_cols), "col", "level")


def observed_levels(df: DataFrame, spec: EntitySpec) -> DataFrame:
    """The distinct ``(col, level)`` pairs, missing marker left out.

    Duplicates fall away map-side, so the shuffle carries levels, not rows.
    """
    return long_labels(df, spec).where(F.col("level") != spec.missing_level).distinct()


def fit_vocabulary(df: DataFrame, spec: EntitySpec, max_levels: int = MAX_LEVELS) -> Vocabulary:
    """Scan the training rows once for the ordered levels of each column.

    The missing marker comes last in every column, seen or not: it is where a
    level unseen in training lands later.
    """
    spec.require(df.columns)
    found = (observed_levels(df, spec)
             .orderBy("col", *level_order(F.col("level")))
             .limit(max_levels * len(spec.cat_cols) + 1).collect())
    vocabulary: Vocabulary = {c: [] for c in spec.cat_cols}
    for row in found:
        vocabulary[row.col].append(row.level)
    wide = [c for c, levels in vocabulary.items() if len(levels) > max_levels]
    if wide:
        raise ValueError(f"more than {max_levels} levels in {wide}: is that a category column?")
    return {c: [*levels, spec.missing_level] for c, levels in vocabulary.items()}


def vocabulary_table(spark: SparkSession, vocabulary: Vocabulary) -> DataFrame:
    """The vocabulary as ``(col, level, code)`` rows."""
    rows = [(c, level, code)
            for c, levels in vocabulary.items() for code, level in enumerate(levels)]
    return spark.createDataFrame(rows, TABLE_SCHEMA)


def unseen_levels(df: DataFrame, spec: EntitySpec, vocabulary: Vocabulary,
                  show: int = 5) -> DataFrame:
    """Per column: rows at levels outside the vocabulary, and the first few of those.

    Counts combine map-side per level, and the ranked window keeps ``show``
    levels per task before the shuffle, so a column full of unseen text is safe.
    """
    labels = long_labels(df, spec)
    known = None
    for c, levels in vocabulary.items():
        test = (F.col("col") == c) & F.col("level").isin(levels)
        known = test if known is None else known | test
    counts = labels.where(~known).groupBy("col", "level").agg(F.count("*").alias("n"))
    totals = counts.groupBy("col").agg(F.sum("n").alias("n_rows"))
    ranked = counts.withColumn("place", F.row_number().over(
        Window.partitionBy("col").orderBy(*level_order(F.col("level")))))
    # Keeping the counts here lets both uses share one shuffle of them.
    first = (ranked.where(F.col("place") <= show)
             .groupBy("col")
             .agg(F.array_sort(F.collect_list(F.struct("place", "level", "n"))).alias("found"))
             .select("col", F.transform("found", lambda s: s["level"]).alias("levels")))
    return totals.join(first, "col")
