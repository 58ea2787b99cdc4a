"""Running sums and ranks over a whole table, without a single-task window.

A window with no partition puts every row in one task. Here the order is cut
into ranges by literal boundaries (sampled quantiles, or prefixes of a hash);
each range is a window partition of its own, and a "carry" row placed first in
it brings in the total of all ranges before. The carry rows are few, so the
only real shuffle is the one that groups rows by range.

Ties cannot overload a range: a score value heavy enough to be a boundary gets
a range to itself, and since all its rows tie there, that range is cut further
by prefixes of the tie-breaking hash.

Boundaries in the plan are for up to ``LITERAL_RANGES`` ranges. Beyond, rows are
sent through Spark's range partitioner, by value and tie-breaking hash, and written
with the number of their partition; totals go by that number. Neither the plan nor
what the driver sketches then grows with the rows, for one more shuffle.
"""

from __future__ import annotations

import math

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from dossier.functions.levels import is_fractional
from dossier.session import scratch_path, width

EXACT = float(1 << 53)      # whole numbers below it are doubles of their own
TIE_DIGITS = 2      # hex digits of the tie hash that split a tied range: 256 parts
#: More ranges than this are made by Spark's range partitioner instead of boundaries in the plan.
LITERAL_RANGES = 1000

_RANGE, _PART, _CARRY = "_range", "_part", "_is_row"


def tie_hash(id_col: str) -> Column:
    """Breaks ties by id, evenly and the same on every run."""
    return F.md5(F.col(id_col).cast("string"))


def quantile_bounds(df: DataFrame, col: str, ranges: int) -> list[float]:
    """Values that cut ``col`` into ranges of about equal row count."""
    steps = [i / ranges for i in range(1, ranges)]
    found = df.select(F.col(col).cast("double").alias(col)).approxQuantile(
        col, steps, 1.0 / (4 * ranges))
    return sorted({b + 0.0 for b in found if math.isfinite(b)})


def with_range(df: DataFrame, col: str, bounds: list[float], descending: bool) -> DataFrame:
    """Add the range number of ``col`` (in sort order) and whether it holds one value only.

    Range ``2i`` is the value ``bounds[i]`` itself, ``2i + 1`` the open interval
    above it. Rows without a value form the last range.
    """
    edges = [float("-inf"), *bounds, float("inf")]
    if len(edges) < 3:
        edges = [float("-inf"), 0.0, float("inf")]
    value = F.nanvl(F.col(col).cast("double"), F.lit(None).cast("double"))
    placed = Bucketizer(splits=edges, inputCol="_value", outputCol="_slot",
                        handleInvalid="keep").transform(df.withColumn("_value", value))
    slot = F.col("_slot").cast("int")
    lower = F.get(F.array(*[F.lit(e) for e in edges]), slot)
    # Whole numbers and decimals past double precision share doubles: such a range has many values.
    exact = F.lit(True) if isinstance(df.schema[col].dataType, (T.DoubleType, T.FloatType, T.IntegerType)) \
        else F.abs(F.col("_value")) < EXACT
    single = F.col("_value").isNull() | F.coalesce((F.col("_value") == lower) & exact, F.lit(False))
    number = 2 * slot + F.when(single, 0).otherwise(1)
    if descending:
        number = -number
    return (placed
            .withColumn(_RANGE, F.when(F.col("_value").isNull(), F.lit(2**31 - 1)).otherwise(number))
            .withColumn("_single", single)
            .drop("_slot"))


def in_ranges(df: DataFrame, col: str, descending: bool, tie: Column | None = None,
              ranges: int | None = None, literal: int = LITERAL_RANGES) -> DataFrame:
    """Rows with ``_range`` and ``_part``, in order of ``col`` and then of ``tie``; also ``_value`` and ``_tie``.

    ``_value`` is the column as a double, null where it has none; those rows come last.
    """
    ranges = ranges or width(df.sparkSession, df.count())
    tied = df.withColumn("_tie", F.lit("") if tie is None else tie)
    if ranges <= literal:
        placed = with_range(tied, col, quantile_bounds(df, col, ranges), descending)
        cut = F.lit(False) if tie is None else F.col("_single")
        return placed.withColumn(_PART, F.when(cut, F.substring("_tie", 1, TIE_DIGITS)).otherwise(F.lit("")))
    spark, path = df.sparkSession, scratch_path(df.sparkSession, "ranges")
    valued = tied.withColumn("_value", F.nanvl(F.col(f"`{col}`").cast("double"), F.lit(None).cast("double")))
    # Written before it is read: sampled again, the partitioner might cut elsewhere.
    (valued.repartitionByRange(ranges, *sort_keys(valued, col, descending))
     .withColumn(_RANGE, F.spark_partition_id()).withColumn(_PART, F.lit("")).write.parquet(path))
    return spark.read.parquet(path)


def sort_keys(placed: DataFrame, col: str, descending: bool) -> list[Column]:
    """Sort keys of placed rows: the double only picks the range; inside it the column's own values are compared."""
    value = F.col("_value") if is_fractional(placed.schema[col].dataType) and not isinstance(
        placed.schema[col].dataType, T.DecimalType) else F.col(f"`{col}`")
    return [value.desc_nulls_last() if descending else value.asc_nulls_last(), F.col("_tie")]


def running_sums(rows: DataFrame, sums: dict[str, str], groups: list[str],
                 order: list[Column]) -> DataFrame:
    """Running and overall sums for rows that already carry ``_range`` and ``_part``.

    ``sums`` maps a value column to its output name ``x``; the result has ``x``
    (inclusive running sum) and ``x_total`` (sum over the group).
    """
    place = [_RANGE, _PART]
    totals = rows.groupBy(*groups, *place).agg(
        *[F.sum(v).alias(v) for v in sums])
    # Bounded: at most ranges x parts rows per group.
    over_group = Window.partitionBy(*groups)
    before = over_group.orderBy(*place).rowsBetween(Window.unboundedPreceding, -1)
    carries = totals.select(
        *groups, *place, F.lit(0).alias(_CARRY),
        *[F.coalesce(F.sum(v).over(before), F.lit(0)).alias(v) for v in sums],
        *[F.sum(v).over(over_group).alias(f"{out}_total") for v, out in sums.items()])
    stacked = rows.withColumn(_CARRY, F.lit(1)).unionByName(carries, allowMissingColumns=True)
    within = (Window.partitionBy(*groups, *place).orderBy(_CARRY, *order)
              .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    summed = stacked.select(
        "*",
        *[F.sum(v).over(within).alias(out) for v, out in sums.items()],
        *[F.first(f"{out}_total").over(within).alias(f"_{out}_total") for out in sums.values()])
    kept = [c for c in rows.columns if c not in (_RANGE, _PART, "_value", "_single")]
    return summed.where(F.col(_CARRY) == 1).select(
        *kept, *sums.values(),
        *[F.col(f"_{out}_total").alias(f"{out}_total") for out in sums.values()])


def prefix_sum(df: DataFrame, order_col: str, id_col: str, sums: dict[str, str],
               groups: list[str] | None = None, descending: bool = True,
               ranges: int | None = None, literal: int = LITERAL_RANGES) -> DataFrame:
    """Running sums in ``order_col`` order, ties broken by a hash of ``id_col``.

    With ``groups``, one running sum per group. The ranges are cut over all
    rows, so no group, however large, makes a range larger than its share.
    Rows without an ``order_col`` value sort last.
    """
    placed = in_ranges(df, order_col, descending, tie_hash(id_col), ranges, literal)
    return running_sums(placed, sums, groups or [], sort_keys(placed, order_col, descending)).drop("_tie")


def hash_rank(df: DataFrame, hash_col: str, groups: list[str], digits: int = 3) -> DataFrame:
    """Add ``rank`` (1-based, by ``hash_col``) and ``rank_total`` per group.

    A hash spreads evenly, so its own prefixes are the ranges.
    """
    placed = (df.withColumn("_one", F.lit(1).cast("bigint"))
              .withColumn(_RANGE, F.conv(F.substring(hash_col, 1, digits), 16, 10).cast("int"))
              .withColumn(_PART, F.lit("")))
    return running_sums(placed, {"_one": "rank"}, groups, [F.col(hash_col)]).drop("_one")
