"""Writing split statements, features, predictions and rankings."""

from __future__ import annotations

from pyspark.sql import DataFrame

from dossier.functions.numeric import half_round
from dossier.functions.levels import is_fractional

ROWS_PER_FILE = 1_000_000

# Fixed value of the statement files.
ZSTD_LEVEL = 9


def write_splits(statements: DataFrame, path: str, split: str = "split",
                 narrow: bool = False, rows_per_file: int = ROWS_PER_FILE,
                 even_files: bool = False) -> str:
    """Statements, one folder per split, zstd-compressed.

    Each task writes its own file per split, so nothing is shuffled to get here,
    and reading one split later prunes to its folder. ``narrow`` rounds
    fractional columns to half precision first. ``even_files`` pays for a
    shuffle to write fewer, evenly sized files: adaptive execution cuts the
    large splits and merges the small ones.
    """
    rows = statements
    if narrow:
        rows = rows.select(*[
            half_round(rows[c]).alias(c) if is_fractional(rows.schema[c].dataType) else rows[c]
            for c in rows.columns])
    if even_files:
        rows = rows.hint("rebalance", split)
    (rows.write.mode("overwrite").partitionBy(split)
     .option("compression", "zstd").option("parquet.compression.codec.zstd.level", ZSTD_LEVEL)
     .option("maxRecordsPerFile", rows_per_file).parquet(path))
    return path


def write_table(df: DataFrame, path: str) -> str:
    """A feature, label or prediction table as zstd parquet."""
    (df.write.mode("overwrite").option("compression", "zstd")
     .option("parquet.compression.codec.zstd.level", ZSTD_LEVEL).parquet(path))
    return path


def write_csv(df: DataFrame, path: str) -> str:
    """Predictions or rankings as CSV with a header in every part."""
    df.write.mode("overwrite").option("header", True).csv(path)
    return path
