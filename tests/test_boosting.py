"""Boosting that stops, and the metric of rounds by histograms."""

import math
import random

import pytest
from pyspark.ml import PipelineModel
from pyspark.sql import functions as F
from test_jobs import SPEC, history

from dossier.operators import joins, rounds
from dossier.operators.collapse import collapse
from dossier.operators.metric import ranking_metric
from dossier.operators.selection import best_iteration
from dossier.operators.vocabulary import fit_vocabulary
from dossier.plans import boosting, model as trees, workflow


def scored(spark, n, rounds_, levels, seed):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        y = int(rng.random() < 0.3)
        rows.append((f"e{i}", y, [rng.choice(levels) + (k + 1) * 0.1 * y for k in range(rounds_)]))
    return spark.createDataFrame(rows, "id string, target int, margins array<double>")


@pytest.mark.parametrize("levels, bins", [([-1.0, 0.0, 0.3], 64), ([i / 50 for i in range(-60, 60)], 16),
                                          ([i / 500 for i in range(-600, 600)], 1 << 16)])
def test_bounds_hold_the_metric_of_every_round(spark, levels, bins):
    rows = scored(spark, 400, 20, levels, bins).repartition(5)
    bounds = {r.place: r for r in rounds.round_bounds(rounds.round_histogram(rows, "target", bins=bins)).collect()}
    staged = rows.select("id", "target", F.posexplode("margins").alias("place", "margin")).select(
        "id", "target", "place", rounds.probability(F.col("margin")).alias("prediction"))
    exact = {r.place: r for r in ranking_metric(staged, "id", "target", "prediction", ["place"]).collect()}
    assert set(bounds) == set(exact) == set(range(20))
    for k, r in exact.items():
        assert bounds[k].low <= r.score <= bounds[k].high
        assert (bounds[k].n_rows, bounds[k].n_positive) == (r.n_rows, r.n_positive)
    if bins == 1 << 16:
        assert max(b.high - b.low for b in bounds.values()) < 0.05


def test_records_are_those_of_ranking_every_round(spark):
    rows = scored(spark, 500, 12, [i / 100 for i in range(-90, 90)], 7).persist()
    judged = rounds.ranked_rounds(rows, "id", "target", bins=256)
    staged = rows.select("id", "target", F.posexplode("margins").alias("place", "margin")).select(
        "id", "target", "place", rounds.probability(F.col("margin")).alias("prediction"))
    exact = {r.place: r.score for r in ranking_metric(staged, "id", "target", "prediction", ["place"]).collect()}
    best = float("-inf")
    for r in judged:
        if exact[r["place"]] > best:        # a record: it must have been ranked, to the last digit
            best = exact[r["place"]]
            assert abs(r["score"] - best) < 1e-12
    again = rounds.ranked_rounds(rows, "id", "target", best=best, bins=256)
    assert all(r["score"] is None or r["score"] <= best for r in again)
    assert sum(r["score"] is None for r in again) >= sum(r["score"] is None for r in judged)


def test_histograms_need_no_row_per_round(spark):
    rows = scored(spark, 50, 4, [0.0, 1.0], 1)
    plan = rounds.round_histogram(rows, "target")._jdf.queryExecution().executedPlan().toString()
    assert "Generate" not in plan
    assert rounds.round_histogram(rows.limit(0), "target").count() == 0
    assert rounds.ranked_rounds(rows.limit(0), "id", "target") == []


@pytest.fixture(scope="module")
def tables(spark):
    statements, labels = history(spark, 240, 3)
    vocabulary = fit_vocabulary(statements, SPEC)
    rows = joins.join_labels(collapse(statements, SPEC, vocabulary), labels, SPEC).persist()
    part = F.pmod(F.xxhash64("id"), F.lit(3))
    expected = [c for c in rows.columns if c not in ("id", "target")]
    return rows.where(part > 0), rows.where(part == 0), expected, workflow.code_levels(vocabulary)


PARAMS = {"maxIter": 30, "maxDepth": 3, "subsamplingRate": 0.8, "minInstancesPerNode": 4,
          "featureSubsetStrategy": "all", "stepSize": 0.4}


def test_patience_ends_the_fit_and_the_saved_model_is_what_was_judged(spark, tables, tmp_path):
    train, held, expected, levels = tables
    fitted = boosting.boost(train, held, SPEC, expected, levels, PARAMS, patience=3, block=4)
    kept = fitted.best_iteration
    assert kept + 3 <= len(fitted.trees) < min(30, kept + 3 + 4)
    for name, n in (("cut", None), ("whole", len(fitted.trees))):
        fitted.save(spark, f"{tmp_path}/{name}", n)
    cut, whole = (PipelineModel.load(f"{tmp_path}/{name}") for name in ("cut", "whole"))
    assert trees.trees_of(cut).getNumTrees == kept and trees.trees_of(whole).getNumTrees == len(fitted.trees)
    staged = trees.staged_scores(held, whole, SPEC, levels, keep=["target"]).persist()
    by_round = trees.staged_metric(staged, SPEC).persist()
    picked = best_iteration(by_round, patience=3).first()
    assert picked.best_iteration == kept and abs(picked.best_score - fitted.best["score"]) < 1e-12
    exact = {r.iteration: r.score for r in by_round.collect()}
    for r in fitted.table(spark).collect():
        assert r.low <= exact[r.iteration] <= r.high
        assert r.score is None or abs(r.score - exact[r.iteration]) < 1e-12
    cut_scores = {r.id: r.prediction for r in trees.score(held, cut, SPEC, levels).collect()}
    at_best = {r.id: r.prediction for r in staged.where(F.col("iteration") == kept).collect()}
    assert all(abs(cut_scores[i] - at_best[i]) < 1e-12 for i in at_best)
    gains = trees.feature_gains(spark, f"{tmp_path}/cut", expected).agg(F.sum("gain"), F.sum("splits")).first()
    assert gains[0] > 0 and gains[1] > 0


def test_leaf_values_have_the_l2_term(spark):
    """One split, one round: a leaf adds sum of gradients / (sum of curvatures + L2) / 2 times the step."""
    rows = spark.createDataFrame([(f"e{i}", float(i % 2), int(i % 2 or i < 4)) for i in range(40)],
                                 "id string, x double, target int")
    fitted = boosting.boost(rows, rows, SPEC, ["x"], {}, {
        "maxIter": 1, "maxDepth": 1, "minInstancesPerNode": 1, "subsamplingRate": 1.0,
        "featureSubsetStrategy": "all", "stepSize": 0.5}, l2=3.0)
    share = 22 / 40
    assert abs(fitted.base - math.log(share / (1 - share)) / 2) < 1e-12
    curvature = 20 * share * (1 - share)
    want = [(2 - 20 * share) / (curvature + 3) / 2, (20 - 20 * share) / (curvature + 3) / 2]
    assert all(abs(a - b) < 1e-9 for a, b in zip(sorted(fitted.values[0]), want))


def test_one_class_is_refused(spark, tables):
    train, held, expected, levels = tables
    with pytest.raises(ValueError, match="both targets"):
        boosting.boost(train.where("target = 1"), held, SPEC, expected, levels, PARAMS)
    with pytest.raises(ValueError, match="both targets"):
        boosting.boost(train, held.where("target = 0"), SPEC, expected, levels, {**PARAMS, "maxIter": 1})
