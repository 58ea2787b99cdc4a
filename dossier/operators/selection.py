"""Picking a boosting round or a run by its score."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F


def best_iteration(scores: DataFrame, iteration: str = "iteration", score: str = "score",
                   runs: list[str] | None = None, patience: int = 200) -> DataFrame:
    """The round early stopping would keep, per run.

    Training stops at the first round that lies ``patience`` rounds past the
    best so far; the best round up to there is kept, the earlier one on equal
    scores. ``scores`` has one row per run and round, so windows stay small.
    """
    runs = runs or []
    so_far = (Window.partitionBy(*runs).orderBy(iteration)
              .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    # A round sets the record when it beats every round before it.
    earlier = (Window.partitionBy(*runs).orderBy(iteration)
               .rowsBetween(Window.unboundedPreceding, -1))
    record = F.when(F.col(score).isNotNull()
                    & (F.coalesce(F.max(score).over(earlier), F.lit(float("-inf")))
                       < F.col(score)), F.col(iteration))
    marked = scores.withColumn("_record", record)
    marked = marked.withColumn("_best", F.max("_record").over(so_far))
    stopped = marked.withColumn("_done", F.col(iteration) - F.col("_best") >= patience)
    first_stop = F.min(F.when(F.col("_done"), F.col(iteration))).over(Window.partitionBy(*runs))
    within = stopped.withColumn("_stop", first_stop).where(
        F.col("_stop").isNull() | (F.col(iteration) <= F.col("_stop")))
    return within.groupBy(*runs).agg(
        F.max("_best").alias("best_iteration"), F.max(score).alias("best_score"),
        F.max(iteration).alias("rounds_run"))
