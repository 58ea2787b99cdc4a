"""Boosting that stops: trees grown in blocks of rounds until the validation metric has not risen for a while.

A round fits one regression tree to the gradients of the logistic loss at the present margins, on a bag of rows.
The tree only says which rows belong together; what a leaf adds is ``sum of gradients / (sum of curvatures + L2)``,
an aggregate by leaf over the same rows, times the step. Margins are a column of a written table: inside a block
the block's trees are applied where rows are read, at its end rows and margins are written anew, so no lineage is
longer than a block and a lost executor costs at most one. The rounds of a block are then judged on the validation
rows (``operators/rounds.py``), and fitting ends with the block in which patience runs out.

The result is an ordinary saved tree model (Spark's own format), so scoring, staged scores and importance need to
know nothing of how it was fitted. Margins are half log-odds, as Spark's boosted trees have them; the first tree
also carries the margin of the positive share.
"""

from __future__ import annotations

import math
from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.ml import PipelineModel
from pyspark.ml.classification import GBTClassificationModel
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import DecisionTreeRegressionModel, RandomForestRegressor
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from dossier.operators.metric import binary_target
from dossier.operators.rounds import probability, ranked_rounds
from dossier.plans.model import PARAMS, PATIENCE, cut_saved_model, model_input
from dossier.session import remove_scratch, scratch_path
from dossier.sources.writers import write_table
from dossier.spec import EntitySpec

# The L2 term of a leaf, and the rounds that share a bag of rows.
L2 = 2.0
BAG_ROUNDS = 10
#: Rounds between two looks at the validation rows.
BLOCK = 10

METRICS = ("score", "gini", "top4", "auc")


@dataclass
class Boosted:
    """Fitted rounds: a tree and the values of its leaves each, and what the validation rows say."""

    features: list[str]
    step: float
    base: float
    trees: list[DecisionTreeRegressionModel] = field(default_factory=list)
    values: list[list[float]] = field(default_factory=list)
    rounds: list[dict] = field(default_factory=list)
    best: dict = field(default_factory=dict)

    @property
    def best_iteration(self) -> int:
        return self.best["iteration"]

    def stopped(self, patience: int) -> bool:
        return len(self.trees) - self.best_iteration >= patience

    def save(self, spark: SparkSession, path: str, rounds: int | None = None) -> None:
        """Save the first rounds (those up to the best) as a pipeline of boosted trees."""
        rounds = rounds or self.best_iteration
        java = spark._jvm
        grown = spark.sparkContext._gateway.new_array(
            java.org.apache.spark.ml.regression.DecisionTreeRegressionModel, rounds)
        weights = spark.sparkContext._gateway.new_array(java.double, rounds)
        for k, tree in enumerate(self.trees[:rounds]):
            grown[k], weights[k] = tree._java_obj, self.step
        whole = GBTClassificationModel(java.org.apache.spark.ml.classification.GBTClassificationModel(
            f"boosted_{spark.sparkContext.applicationId}", grown, weights)).setFeaturesCol("features")
        # Bounded by the model: a row per leaf.
        leaves = spark.createDataFrame(
            [(k, i, value + (self.base / self.step if k == 0 else 0.0))
             for k, values in enumerate(self.values[:rounds]) for i, value in enumerate(values)],
            "tree int, leaf int, value double")
        assembler = VectorAssembler(inputCols=self.features, outputCol="features")
        cut_saved_model(spark, PipelineModel([assembler, whole]), path, rounds, leaves)

    def table(self, spark: SparkSession) -> DataFrame:
        """``iteration, low, high, score`` of every fitted round; ``score`` where it was ranked exactly."""
        return spark.createDataFrame(
            [(r["iteration"], r["low"], r["high"], r["score"]) for r in self.rounds],
            "iteration int, low double, high double, score double")


def _prepared(rows: DataFrame, spec: EntitySpec, features: list[str], cat_levels: Mapping[str, list[str]],
              margin: Column) -> DataFrame:
    """Id, target, feature vector, margin and no margins of earlier rounds yet."""
    taken = model_input(rows, spec, features, cat_levels, [spec.target_col])
    vectors = VectorAssembler(inputCols=features, outputCol="features").transform(taken)
    return vectors.select(
        F.col(spec.id_col).alias("id"), binary_target(F.col(spec.target_col)).alias("target"), "features",
        margin.alias("margin"), F.array().cast("array<double>").alias("margins"))


def _grown(rows: DataFrame, tree: DecisionTreeRegressionModel, values: list[float], step: float) -> DataFrame:
    """Rows whose margin has moved by their leaf; ``margins`` keeps the margin of each round of the block."""
    moved = F.col("margin") + step * F.get(F.array(*[F.lit(v) for v in values]), F.col("_leaf").cast("int"))
    return (tree.setLeafCol("_leaf").setPredictionCol("").transform(rows)
            .withColumn("margin", moved).withColumn("margins", F.array_append("margins", F.col("margin")))
            .select("id", "target", "features", "margin", "margins"))


def _one_round(rows: DataFrame, k: int, settings: dict, l2: float):
    """The tree of round ``k`` (from 0) and the values of its leaves."""
    share, seed = settings["subsamplingRate"], settings["seed"]
    if share < 1:
        ticket = F.pmod(F.xxhash64("id", F.lit(seed), F.lit(k // BAG_ROUNDS)), F.lit(1_000_000))
        rows = rows.where(ticket < int(share * 1_000_000))
    p = probability(F.col("margin"))
    rows = rows.select("features", (F.col("target") - p).alias("gradient"), (p * (1 - p)).alias("curvature"))
    forest = RandomForestRegressor(
        featuresCol="features", labelCol="gradient", numTrees=1, bootstrap=False, subsamplingRate=1.0,
        featureSubsetStrategy=settings["featureSubsetStrategy"], maxDepth=settings["maxDepth"],
        maxBins=settings["maxBins"], minInstancesPerNode=settings["minInstancesPerNode"], seed=seed + k)
    tree = forest.fit(rows).trees[0].setFeaturesCol("features")
    leaf = F.col("_leaf").cast("int").alias("leaf")
    # Bounded: a row per leaf of one tree.
    sums = {r["leaf"]: r for r in tree.setLeafCol("_leaf").setPredictionCol("").transform(rows).groupBy(leaf).agg(
        F.sum("gradient").alias("g"), F.sum("curvature").alias("h")).collect()}
    values = [sums[i]["g"] / (sums[i]["h"] + l2) / 2 if i in sums else 0.0 for i in range(max(sums, default=-1) + 1)]
    return tree, values


def boost(train: DataFrame, validation: DataFrame, spec: EntitySpec, features: list[str],
          cat_levels: Mapping[str, list[str]], params: dict | None = None, patience: int = PATIENCE,
          block: int = BLOCK, l2: float = L2) -> Boosted:
    """Fit until the validation metric has not risen for ``patience`` rounds, or ``maxIter`` rounds.

    Both tables are labelled feature tables. The round kept is the one that ranking every round up to the end
    would keep: of equal scores the first.
    """
    spark = train.sparkSession
    settings = {**PARAMS, **(params or {})}
    settings["maxBins"] = max([settings["maxBins"], *[len(levels) for levels in cat_levels.values()]])
    share = train.agg(F.avg(binary_target(F.col(spec.target_col)))).first()[0]
    if share is None or not 0 < share < 1:
        raise ValueError("boosting needs training rows of both targets")
    base = math.log(share / (1 - share)) / 2
    paths: dict[str, str] = {}

    def write(name: str, rows: DataFrame) -> DataFrame:
        """The rows as the present table of that name; the one before goes."""
        old, paths[name] = paths.get(name), scratch_path(spark, f"boost-{name}")
        write_table(rows, paths[name])
        if old:
            remove_scratch(spark, old)
        return spark.read.parquet(paths[name])

    rows, held = (write(name, _prepared(t, spec, features, cat_levels, F.lit(base)))
                  for name, t in (("train", train), ("validation", validation)))
    out = Boosted(list(features), settings["stepSize"], base)
    while len(out.trees) < settings["maxIter"] and not (out.best and out.stopped(patience)):
        done = len(out.trees)
        rows, held = (t.withColumn("margins", F.array().cast("array<double>")) for t in (rows, held))
        for k in range(done, min(done + block, settings["maxIter"])):
            tree, values = _one_round(rows, k, settings, l2)
            out.trees.append(tree)
            out.values.append(values)
            rows, held = (_grown(t, tree, values, out.step) for t in (rows, held))
        rows, held = write("train", rows.drop("margins")), write("validation", held)
        judged = ranked_rounds(held, "id", "target", out.best.get("score", float("-inf")))
        for r in judged:
            r["iteration"] = done + r.pop("place") + 1
            if r["score"] is not None and (not out.best or r["score"] > out.best["score"]) and not (
                    out.best and r["iteration"] - out.best_iteration > patience):
                out.best = {m: r[m] for m in ("iteration", *METRICS)}
        out.rounds += judged
        if not out.best:
            raise ValueError("the metric needs validation rows of both targets")
    remove_scratch(spark, *paths.values())
    return out
