"""The ranking metric of many boosting rounds without a row per row and round.

A row carries one number per round. Each task adds its rows up into a histogram per round (how many rows of
either target fall into each bin of the probability), and histograms add up over tasks, so what is shuffled
does not grow with rows x rounds. Inside a bin the order of rows is unknown: positives first gives the metric's
greatest value, negatives first its least. A round whose greatest value does not pass the best so far cannot set
a record; only the others are ranked exactly, row by row. The round picked, and its metric, are therefore those
of ranking every round.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from dossier.operators.metric import (
    NEGATIVE_WEIGHT, binary_target, metric_from_sums, ranking_metric, weight_cutoff)

#: Bins of the probability, and the rounds that a task counts at a time (two counts per bin and round).
BINS = 1 << 16
AT_ONCE = 16
# Covers the rounding of the bounds, which are built from whole numbers.
SLACK = 1e-12


def probability(margin: Column) -> Column:
    """The probability of a boosted margin under logistic loss."""
    return 1 / (1 + F.exp(-2 * margin))


def _counts(bins: int, at_once: int):
    def count(batches: Iterator[pa.RecordBatch]):
        totals: dict[int, np.ndarray] = {}
        for batch in batches:
            positive = batch.column(0).to_numpy(zero_copy_only=False).astype(np.int64)
            margins = batch.column(1)
            rounds = len(margins[0]) if len(margins) else 0
            values = margins.flatten().to_numpy(zero_copy_only=False).reshape(len(margins), rounds)
            for first in range(0, rounds, at_once):
                part = values[:, first:first + at_once]
                with np.errstate(over="ignore"):
                    places = np.minimum((bins / (1 + np.exp(-2 * part))).astype(np.int64), bins - 1)
                for k in range(part.shape[1]):
                    added = np.bincount(2 * places[:, k] + positive, minlength=2 * bins)
                    totals[first + k] = totals[first + k] + added if first + k in totals else added
        for k, total in totals.items():
            own = np.flatnonzero(total.reshape(bins, 2).sum(1))
            both = total.reshape(bins, 2)[own]
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(own), k, np.int32)), pa.array(own.astype(np.int32)),
                 pa.array(both[:, 0]), pa.array(both[:, 1])], ["place", "bin", "negatives", "positives"])

    return count


def round_histogram(rows: DataFrame, target: str, margins: str = "margins", bins: int = BINS) -> DataFrame:
    """``place, bin, negatives, positives``: rows of either target per bin of each round's probability."""
    counted = rows.select(binary_target(F.col(target)).alias("target"), F.col(margins).alias("margins")).mapInArrow(
        _counts(bins, AT_ONCE), "place int, bin int, negatives long, positives long")
    return counted.groupBy("place", "bin").agg(
        F.sum("negatives").alias("negatives"), F.sum("positives").alias("positives"))


def round_bounds(histogram: DataFrame) -> DataFrame:
    """``place, low, high`` and counts: between which values the metric of each round must lie."""
    # Bounded: one row per bin and round, whatever the number of rows.
    down = Window.partitionBy("place").orderBy(F.desc("bin"))
    whole = Window.partitionBy("place")
    n, p = F.col("negatives"), F.col("positives")
    weight = n * NEGATIVE_WEIGHT + p
    cut = weight_cutoff(F.col("total"))
    placed = histogram.withColumn("total", F.sum(weight).over(whole)).withColumn(
        "before", F.sum(weight).over(down.rowsBetween(Window.unboundedPreceding, Window.currentRow)) - weight)
    room = F.greatest(cut - F.col("before"), F.lit(0))
    wide = lambda c: c.cast("decimal(20,0)")
    first = wide(p) * wide(F.col("before")) + wide(p) * wide(p + 1) / 2
    sums = placed.groupBy("place").agg(
        F.sum(n + p).alias("n_rows"), F.sum(p).alias("n_positive"),
        F.sum(first.cast("decimal(38,0)")).alias("least"),
        F.sum((wide(p) * wide(n * NEGATIVE_WEIGHT)).cast("decimal(38,0)")).alias("slack"),
        F.sum(F.least(p, room)).alias("most_captured"),
        F.sum(F.least(p, F.greatest(room - n * NEGATIVE_WEIGHT, F.lit(0)))).alias("least_captured"))
    at = lambda ranks, captured: metric_from_sums(sums.select(
        "place", "n_rows", "n_positive", ranks.alias("ranks"), F.col(captured).alias("n_captured")), ["place"])
    high = at(F.col("least"), "most_captured").select(
        "place", (F.col("score") + SLACK).alias("high"), "n_rows", "n_positive")
    low = at(F.col("least") + F.col("slack"), "least_captured").select(
        "place", (F.col("score") - SLACK).alias("low"))
    return low.join(high, "place").select("place", "low", "high", "n_rows", "n_positive")


def exact_rounds(rows: DataFrame, id_col: str, target: str, places: list[int], margins: str = "margins") -> DataFrame:
    """The metric of a few rounds, row by row, as ``place`` and its values."""
    named = rows.select(id_col, target, F.explode(F.array(*[F.struct(
        F.lit(k).alias("place"), probability(F.get(margins, F.lit(k))).alias("prediction")) for k in places]))
        .alias("one")).select(id_col, target, "one.*")
    return ranking_metric(named, id_col, target, "prediction", ["place"])


def ranked_rounds(rows: DataFrame, id_col: str, target: str, best: float = float("-inf"),
                  margins: str = "margins", bins: int = BINS) -> list[dict]:
    """Per round ``place, low, high`` and, where it may set a record, the exact metric.

    ``best`` is the best score of earlier rounds. ``rows`` is a written table: it is read once for the
    histograms and again for the rounds in doubt.
    """
    found = [r.asDict() for r in round_bounds(round_histogram(rows, target, margins, bins)).orderBy("place").collect()]
    # A round below the certain value of an earlier one sets no record either.
    doubtful, certain = [], best
    for r in found:
        if r["high"] is not None and r["high"] > certain:
            doubtful.append(r["place"])
            certain = max(certain, r["low"])
    exact = {}
    if doubtful:
        exact = {r["place"]: r.asDict() for r in exact_rounds(rows, id_col, target, doubtful, margins).collect()}
    return [{**r, **exact.get(r["place"], {"score": None})} for r in found]
