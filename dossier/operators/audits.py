"""Checks on tables: ranges, order, uniqueness, sampling and schema."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from dossier.functions.levels import is_fractional, present
from dossier.functions.numeric import HALF_MAX
from dossier.operators.prefix import LITERAL_RANGES, in_ranges, tie_hash
from dossier.spec import EntitySpec


def overflow_audit(df: DataFrame, limit: float = HALF_MAX) -> DataFrame:
    """Fractional columns whose greatest magnitude exceeds ``limit``, in one pass.

    Magnitudes are taken in single precision; infinities count, NaN does not.
    """
    columns = [f.name for f in df.schema.fields if is_fractional(f.dataType)]
    peaks = df.agg(*[
        F.max(F.abs(present(F.col(c), df.schema[c].dataType).cast("float"))).alias(c)
        for c in columns])
    return (peaks.unpivot([], columns, "col", "peak")
            .where(F.col("peak") > F.lit(limit).cast("float")))


def entity_uniqueness(df: DataFrame, id_col: str) -> DataFrame:
    """``(n_rows, n_entities, is_unique)``."""
    return (df.agg(F.count("*").alias("n_rows"), F.countDistinct(id_col).alias("n_entities"))
            .withColumn("is_unique", F.col("n_rows") == F.col("n_entities")))


def _blocks(segments: DataFrame, place: list[str], entities: DataFrame) -> DataFrame:
    """Blocks from segments (``place``, first_id, last_id, inside) that follow one another in order of ``place``."""
    # Bounded: one row per segment.
    order = Window.orderBy(*place)
    seams = segments.select(
        "inside", (F.lag(F.lit(1)).over(order).isNull()
                   | ~F.col("first_id").eqNullSafe(F.lag("last_id").over(order))).alias("opens"))
    n_blocks = F.coalesce("n_blocks", F.lit(0))
    return (seams.agg((F.sum("inside") + F.count_if("opens")).alias("n_blocks"))
            .select("n_blocks", entities.scalar().alias("n_entities"))
            .select(n_blocks.alias("n_blocks"), "n_entities", (n_blocks == F.col("n_entities")).alias("contiguous")))


def contiguity_audit(df: DataFrame, id_col: str, seq_col: str, ranges: int | None = None,
                     literal: int = LITERAL_RANGES) -> DataFrame:
    """Blocks of consecutive rows (by ``seq_col``) of one entity, against distinct entities.

    Rows of one place in the sequence stand in order of a hash of their id, so repeated ids there are one; a
    place that many rows share is cut by that hash, and rows without a place come last. Changes are counted
    inside ranges; the last id of a range is then compared with the first id of the next.
    """
    rows = df.select(F.col(id_col).alias("id"), F.col(seq_col).alias("seq"))
    tie = F.coalesce(tie_hash("id"), F.lit(""))
    placed = in_ranges(rows, "seq", False, tie, ranges, literal).dropDuplicates(
        ["_range", "_part", "_value", "seq", "id"])
    order = F.struct("_value", "seq", "_tie")
    inside = Window.partitionBy("_range", "_part").orderBy("_value", "seq", "_tie")
    changed = placed.withColumn("changed", (F.row_number().over(inside) > 1)
                                & ~F.col("id").eqNullSafe(F.lag("id").over(inside)))
    segments = changed.groupBy("_range", "_part").agg(
        F.count_if("changed").alias("inside"),
        F.min_by("id", order).alias("first_id"), F.max_by("id", order).alias("last_id"))
    return _blocks(segments, ["_range", "_part"], rows.agg(F.countDistinct("id").alias("n_entities")))


#: Rows of a file that are looked at together.
FILE_PART = 1_000_000


def file_contiguity_audit(df: DataFrame, id_col: str, part_rows: int = FILE_PART) -> DataFrame:
    """Blocks of rows of one entity as they lie in parquet files, against distinct entities.

    Files follow one another by name, rows by their place in the file. A file is cut into parts of ``part_rows``
    rows; a part sums up as its first id, its last id and the changes between, and parts join up at their ends.
    ``df`` is a frame read from parquet files, not changed since.
    """
    rows = df.select(
        F.col(id_col).alias("id"), F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.row_index").alias("row")).withColumn("part", F.floor(F.col("row") / part_rows))
    inside = Window.partitionBy("file", "part").orderBy("row")
    changed = rows.withColumn("changed", F.lag("row").over(inside).isNotNull()
                              & ~F.col("id").eqNullSafe(F.lag("id").over(inside)))
    segments = changed.groupBy("file", "part").agg(
        F.count_if("changed").alias("inside"),
        F.min_by("id", "row").alias("first_id"), F.max_by("id", "row").alias("last_id"))
    return _blocks(segments, ["file", "part"], rows.agg(F.countDistinct("id").alias("n_entities")))


def order_audit(df: DataFrame, id_col: str, date_col: str, seq_col: str,
                ranges: int | None = None, literal: int = LITERAL_RANGES) -> DataFrame:
    """Entities whose dates go backwards in ``seq_col`` order, with how often.

    Each entity's rows are cut by ranges of the sequence, so a very long history
    is checked in many tasks; neighbouring ranges are then compared by their
    first and last dates.
    """
    rows = df.select(F.col(id_col).alias(id_col), F.col(date_col).alias("date"),
                     F.col(seq_col).alias("seq")).where(F.col("date").isNotNull())
    placed = in_ranges(rows, "seq", False, None, ranges, literal)
    inside = Window.partitionBy(id_col, "_range").orderBy("seq")
    marked = placed.withColumn("back", F.lag("date").over(inside) > F.col("date"))
    pieces = marked.groupBy(id_col, "_range").agg(
        F.count_if("back").alias("back"),
        F.min_by("date", "seq").alias("first_date"), F.max_by("date", "seq").alias("last_date"))
    # Bounded: at most one row per range and entity.
    seams = Window.partitionBy(id_col).orderBy("_range")
    counted = pieces.withColumn(
        "back", F.col("back")
        + F.coalesce((F.lag("last_date").over(seams) > F.col("first_date")).cast("int"), F.lit(0)))
    return (counted.groupBy(id_col).agg(F.sum("back").alias("n_backward"))
            .where(F.col("n_backward") > 0))


def entity_sample(df: DataFrame, id_col: str, n: int) -> DataFrame:
    """All rows of the first ``n`` entities by id."""
    chosen = df.select(id_col).distinct().orderBy(id_col).limit(n)
    return df.join(chosen, id_col, "left_semi")


def require_same_columns(a: DataFrame, b: DataFrame) -> None:
    """Two feature tables must agree on names and order."""
    if a.columns != b.columns:
        odd = sorted(set(a.columns) ^ set(b.columns))
        what = f"columns of one table only: {odd[:5]}" if odd else "same columns, another order"
        raise ValueError(f"feature columns fail to line up ({what}); build both tables from one vocabulary")


def align_features(df: DataFrame, id_col: str, expected: list[str]) -> DataFrame:
    """The id and the expected features in stored order; extra columns drop out."""
    have = set(df.columns)
    absent = [c for c in expected if c not in have]
    if absent:
        raise KeyError(f"the model wants {len(absent)} column(s) this table lacks, such as {absent[:5]}")
    return df.select(id_col, *[F.col(f"`{c}`") for c in expected])
