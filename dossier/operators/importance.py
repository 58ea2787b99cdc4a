"""Feature importance tables and their rollups."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from dossier.functions.naming import base_column


def importance_table(gains: DataFrame, cat_cols: list[str] | tuple[str, ...]) -> DataFrame:
    """``(feature, gain, splits)`` plus ``gain_pct`` of the total and the ``base`` column."""
    total = gains.agg(F.sum("gain").cast("double")).scalar()
    return gains.select(
        "feature", "gain", "splits",
        (100 * F.col("gain") / F.nullif(total, F.lit(0.0))).alias("gain_pct"),
        base_column(F.col("feature"), cat_cols).alias("base"))


def merge_by_base(table: DataFrame) -> DataFrame:
    """Importance summed back onto source columns, with the number of features merged."""
    return table.groupBy(F.col("base").alias("feature")).agg(
        F.sum("gain").alias("gain"), F.sum("gain_pct").alias("gain_pct"),
        F.sum("splits").alias("splits"), F.count("*").alias("parts"))


def ranked(table: DataFrame) -> DataFrame:
    return table.orderBy(F.desc("gain"), "feature")


def top_features(table: DataFrame, k: int = 20) -> DataFrame:
    """The ``k`` highest gains with their place and running share.

    The limit comes first, so the window sees ``k`` rows.
    """
    order = Window.orderBy(F.desc("gain"), "feature")
    running = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return ranked(table).limit(k).select(
        F.row_number().over(order).alias("place"), "feature", "gain", "gain_pct",
        F.sum("gain_pct").over(running).alias("cum_pct"))


def unused_features(table: DataFrame) -> DataFrame:
    """``(n_features, n_unused)``."""
    return table.agg(F.count("*").alias("n_features"),
                     F.count_if(F.col("gain") == 0).alias("n_unused"))
