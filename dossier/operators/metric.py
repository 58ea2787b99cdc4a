"""The weighted ranking metric: mean of normalised gini and top-share capture.

Definition (per group, rows ranked by descending prediction): a row weighs 20
when its target is 0 and 1 otherwise. ``top4`` is the share of positives whose
running weight is within the whole part of 4 % of the total weight. ``gini`` is
the weighted area between the positives' running share and the weight's running
share, over the same area for a perfect ranking; ``auc`` is ``(gini + 1) / 2``
and ``score`` the mean of ``gini`` and ``top4``. Tied predictions are ordered by
a hash of the id. Without positives everything is NULL; without negatives only
``top4`` is defined.

Both sums in the gini reduce to counts plus one term that needs the ranking,
the running weight summed over positives, so one prefix sum serves the metric
and all sums stay exact integers up to the last division.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from dossier.functions.numeric import ratio
from dossier.operators.prefix import prefix_sum

# Fixed values of the metric.
NEGATIVE_WEIGHT = 20
TOP_SHARE = 0.04


def binary_target(target: Column) -> Column:
    """The target as 0 or 1; anything else, a missing one included, fails the job."""
    odd = F.raise_error(F.concat(F.lit("a target must be 0 or 1, not "), F.coalesce(
        target.cast("string"), F.lit("missing")))).cast("int")
    return F.when(target == 0, 0).when(target == 1, 1).otherwise(odd)


def class_weight(target: Column) -> Column:
    return F.when(target == 0, NEGATIVE_WEIGHT).otherwise(1).cast("bigint")


def weight_cutoff(total: Column) -> Column:
    """The whole part of 4 % of the total weight."""
    return F.floor(F.lit(TOP_SHARE) * total.cast("double"))


def ranked_weights(scored: DataFrame, id_col: str = "id", target: str = "target",
                   prediction: str = "prediction", groups: list[str] | None = None,
                   ranges: int | None = None) -> DataFrame:
    """Rows with their running ``cum_weight`` and running ``cum_positive``, and both totals."""
    rows = scored.select(
        *(groups or []), F.col(id_col), binary_target(F.col(target)).alias("target"),
        F.col(prediction).cast("double").alias("prediction"))
    rows = rows.withColumn("weight", class_weight(F.col("target")))
    rows = rows.withColumn("positive", (F.col("target") * F.col("weight")).cast("bigint"))
    return prefix_sum(rows, "prediction", id_col,
                      {"weight": "cum_weight", "positive": "cum_positive"}, groups, ranges=ranges)


def gain_curve(scored: DataFrame, id_col: str = "id", target: str = "target",
               prediction: str = "prediction", ranges: int | None = None) -> DataFrame:
    """Per row: running weight, positives found so far (``lorentz``), and the diagonal (``random``)."""
    rows = ranked_weights(scored, id_col, target, prediction, ranges=ranges)
    return rows.select(
        id_col, "cum_weight", "cum_positive",
        ratio(F.col("cum_positive"), F.col("cum_positive_total")).alias("lorentz"),
        ratio(F.col("cum_weight"), F.col("cum_weight_total")).alias("random"))


def metric_totals(scored: DataFrame, target: str = "target",
                  groups: list[str] | None = None) -> DataFrame:
    """Total weight, total positive weight, and row counts. No ranking needed."""
    value = binary_target(F.col(target))
    return scored.groupBy(*(groups or [])).agg(
        F.count("*").alias("n_rows"),
        F.sum(class_weight(value)).alias("total_weight"),
        F.sum((value * class_weight(value)).cast("bigint")).alias("positive_weight"),
        F.count_if(value == 1).alias("n_positive"))


def ranking_metric(scored: DataFrame, id_col: str = "id", target: str = "target",
                   prediction: str = "prediction", groups: list[str] | None = None,
                   ranges: int | None = None) -> DataFrame:
    """``score, gini, top4, auc`` and ``n_rows, n_positive``: one row, or one per group.

    The input is read three times (quantiles, range totals, ranking), so pass a
    written table rather than a plan that scores rows.
    """
    groups = groups or []
    rows = scored.select(
        *groups, F.col(id_col), binary_target(F.col(target)).alias("target"),
        F.col(prediction).cast("double").alias("prediction"))
    rows = rows.withColumn("weight", class_weight(F.col("target")))
    ranked = prefix_sum(rows, "prediction", id_col, {"weight": "cum_weight"}, groups, ranges=ranges)

    is_positive = F.col("target") == 1
    captured = is_positive & (F.col("cum_weight") <= weight_cutoff(F.col("cum_weight_total")))
    sums = ranked.groupBy(*groups).agg(
        F.count("*").alias("n_rows"),
        F.count_if(is_positive).alias("n_positive"),
        F.count_if(captured).alias("n_captured"),
        F.sum(F.when(is_positive, F.col("cum_weight")).cast("decimal(20,0)")).alias("ranks"))

    return metric_from_sums(sums, groups)


def metric_from_sums(sums: DataFrame, groups: list[str] | None = None) -> DataFrame:
    """The metric from ``n_rows, n_positive, n_captured`` and ``ranks``, the running weights of the positives summed."""
    groups = groups or []
    p, n = F.col("n_positive"), F.col("n_rows") - F.col("n_positive")
    wide = lambda c: c.cast("decimal(19,0)")                       # noqa: E731
    total = p + NEGATIVE_WEIGHT * n
    # sum of weight x running positives, and sum of weight x running weight
    found = (wide(p) * wide(total + 1) - F.col("ranks")).cast("double")
    paced = (wide(total) * wide(total) + wide(p)
             + wide(NEGATIVE_WEIGHT**2 * n)).cast("double") / 2
    raw = found / F.nullif(p, F.lit(0)) - paced / F.nullif(total, F.lit(0))
    perfect = (NEGATIVE_WEIGHT / 2) * n * (total - (NEGATIVE_WEIGHT - 1)) / F.nullif(total, F.lit(0))
    return (
        sums.withColumn("gini", F.when((p > 0) & (n > 0), raw / F.nullif(perfect, F.lit(0.0))))
        .withColumn("top4", ratio(F.col("n_captured"), p))
        .select(*groups,
                (0.5 * (F.col("gini") + F.col("top4"))).alias("score"), "gini", "top4",
                ((F.col("gini") + 1) / 2).alias("auc"), "n_rows", "n_positive"))


def rounded_metric(metric: DataFrame) -> DataFrame:
    """The four metric values to six places, other columns as they are."""
    return metric.select(*[
        F.round(c, 6).alias(c) if c in ("score", "gini", "top4", "auc") else F.col(c)
        for c in metric.columns])
