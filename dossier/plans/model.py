"""Boosted trees on feature tables: fitting, scoring, staged scores, importance."""

from __future__ import annotations

import json
from collections.abc import Mapping

import numpy as np
import pandas as pd
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F, types as T

from dossier.functions.levels import is_fractional
from dossier.operators.audits import align_features
from dossier.operators.metric import ranking_metric
from dossier.operators.rounds import probability
from dossier.session import remove_scratch, scratch_path, work_dir
from dossier.spec import EntitySpec

# How the boosted model is fitted unless told otherwise. Depth 7
# stands in for 100 leaves; Spark grows trees by level.
PARAMS = {
    "maxIter": 3000,
    "stepSize": 0.03,
    "maxDepth": 7,
    "maxBins": 255,
    "minInstancesPerNode": 40,
    "featureSubsetStrategy": "0.2",
    "subsamplingRate": 0.5,
    "seed": 42,
}
PATIENCE = 200

# Trees take no NaN. Missing sits below every real value, so a split can
# separate it; this needs no fitting and is the same for every table.
MISSING_VALUE = -3.0e38
LARGEST_VALUE = 2.9e38


def model_input(features: DataFrame, spec: EntitySpec, expected: list[str],
                cat_levels: Mapping[str, list[str]], keep: list[str] = ()) -> DataFrame:
    """Id, kept columns and the expected features, ready for a vector.

    ``cat_levels`` maps a code feature to its levels; such columns carry
    nominal metadata, so trees split them as categories.
    """
    align_features(features, spec.id_col, expected)
    columns = [F.col(c) for c in (spec.id_col, *keep)]
    for name in expected:
        c = F.col(f"`{name}`")
        if name in cat_levels:
            levels = cat_levels[name]
            attribute = {"ml_attr": {"type": "nominal", "name": name, "vals": list(levels)}}
            filled = F.coalesce(c.cast("double"), F.lit(float(len(levels) - 1)))
            columns.append(filled.alias(name, metadata=attribute))
        elif is_fractional(features.schema[name].dataType):
            value = F.nanvl(c.cast("double"), F.lit(None).cast("double"))
            bounded = F.greatest(F.least(value, F.lit(LARGEST_VALUE)), F.lit(-LARGEST_VALUE))
            columns.append(F.when(value.isNull(), MISSING_VALUE).otherwise(bounded).alias(name))
        else:
            columns.append(F.coalesce(c.cast("double"), F.lit(MISSING_VALUE)).alias(name))
    return features.select(*columns)


def fit_trees(train: DataFrame, spec: EntitySpec, expected: list[str],
              cat_levels: Mapping[str, list[str]], params: dict | None = None) -> PipelineModel:
    """Fit boosted trees on a labelled feature table."""
    work_dir(train.sparkSession)        # boosting checkpoints there every tenth round
    settings = {**PARAMS, **(params or {})}
    # A category needs a bin for each of its levels.
    settings["maxBins"] = max([settings["maxBins"], *[len(levels) for levels in cat_levels.values()]])
    rows = model_input(train, spec, expected, cat_levels, [spec.target_col])
    rows = rows.withColumn("label", F.col(spec.target_col).cast("double"))
    trees = GBTClassifier(featuresCol="features", labelCol="label",
                          checkpointInterval=10, **settings)
    return Pipeline(stages=[
        VectorAssembler(inputCols=expected, outputCol="features"), trees]).fit(rows)


def trees_of(model: PipelineModel) -> GBTClassificationModel:
    return model.stages[-1]


def expected_features(model: PipelineModel) -> list[str]:
    return list(model.stages[0].getInputCols())


def leaf_values(spark: SparkSession, model: PipelineModel) -> Column:
    """``values[tree][leaf]``: what each leaf adds to the margin, as a one-value subquery.

    Read from the saved node table, where the leaves of a tree are numbered by
    node id. The size is that of the model, whatever the data.
    """
    path = scratch_path(spark, "trees")
    model.write().save(path)
    weights = F.array(*[F.lit(float(w)) for w in trees_of(model).treeWeights])
    leaves = (spark.read.parquet(f"{path}/stages/*/data").select("treeID", "nodeData.*")
              .where(F.col("leftChild") < 0)
              .select("treeID", "id", (F.col("prediction") * F.get(weights, F.col("treeID")))
                      .alias("value")))
    by_tree = leaves.groupBy("treeID").agg(
        F.transform(F.array_sort(F.collect_list(F.struct("id", "value"))), lambda s: s["value"])
        .alias("values"))
    return by_tree.agg(F.transform(
        F.array_sort(F.collect_list(F.struct("treeID", "values"))), lambda s: s["values"])).scalar()


def _with_parts(rows: DataFrame, model: PipelineModel, keep: list[str]) -> DataFrame:
    """Rows with ``parts``: what each tree adds to their margin, in boosting order."""
    values = leaf_values(rows.sparkSession, model)
    leafed = trees_of(model).copy().setLeafCol("_leaf").transform(model.stages[0].transform(rows))
    return leafed.select(*keep, vector_to_array("_leaf").alias("leaf"), values.alias("values")) \
        .select(*keep, F.transform("leaf", lambda x, i: F.get(
            F.get(F.col("values"), i), x.cast("int"))).alias("parts"))


@F.pandas_udf(T.ArrayType(T.DoubleType()))
def _running(parts: pd.Series) -> pd.Series:
    """The running sums of each row's numbers."""
    return parts.map(np.cumsum)


def _sum(numbers: Column) -> Column:
    return F.aggregate(numbers, F.lit(0.0), lambda total, x: total + x)


def score(features: DataFrame, model: PipelineModel, spec: EntitySpec,
          cat_levels: Mapping[str, list[str]], rounds: int | None = None,
          output: str = "prediction") -> DataFrame:
    """``(id, probability)`` from a feature table, optionally from the first rounds only."""
    rows = model_input(features, spec, expected_features(model), cat_levels)
    if rounds is None or rounds >= trees_of(model).getNumTrees:
        return model.transform(rows).select(
            spec.id_col, vector_to_array("probability")[1].alias(output))
    parts = _with_parts(rows, model, [spec.id_col])
    return parts.select(spec.id_col, probability(_sum(F.slice("parts", 1, rounds))).alias(output))


def staged_scores(features: DataFrame, model: PipelineModel, spec: EntitySpec,
                  cat_levels: Mapping[str, list[str]], every: int = 1,
                  keep: list[str] = ()) -> DataFrame:
    """``(id, *keep, iteration, prediction)`` at every round, or every ``every`` rounds and the ends.

    One pass over the rows finds the leaf of every tree; all rounds follow from
    one running sum over the trees, taken for a batch of rows at once.
    """
    rounds = trees_of(model).getNumTrees
    kept = [spec.id_col, *keep]
    rows = model_input(features, spec, expected_features(model), cat_levels, list(keep))
    parts = _with_parts(rows, model, kept)
    staged = parts.select(*kept, F.posexplode(_running("parts")).alias("place", "margin")).select(
        *kept, (F.col("place") + 1).alias("iteration"), probability(F.col("margin")).alias("prediction"))
    at = F.col("iteration")
    return staged.where((at == 1) | (at == rounds) | (at % every == 0))


def staged_metric(staged: DataFrame, spec: EntitySpec) -> DataFrame:
    """The ranking metric at every checkpoint; pass a written table of staged scores."""
    return ranking_metric(staged, spec.id_col, spec.target_col, "prediction", ["iteration"])


def node_table(spark: SparkSession, model_path: str, rounds: int | None = None) -> DataFrame:
    """The inner nodes of a saved model, one row per split with its total gain.

    The stored gain is a decrease per row of the node, so it is weighed by the
    node's rows. ``rounds`` keeps the first trees only.
    """
    if rounds is not None and rounds < 1:
        raise ValueError(f"a model keeps one round or more, not {rounds}")
    nodes = spark.read.parquet(f"{model_path}/stages/*/data")
    if rounds is not None:
        nodes = nodes.where(F.col("treeID") < rounds)
    node = nodes.select("treeID", "nodeData.*")
    return node.where(F.col("leftChild") >= 0).select(
        "treeID", F.col("split.featureIndex").alias("feature_index"),
        (F.col("gain") * F.col("rawCount")).alias("gain"))


def cut_saved_model(spark: SparkSession, model: PipelineModel, path: str, rounds: int,
                    leaves: DataFrame | None = None) -> None:
    """Save a model with its first ``rounds`` trees only.

    ``leaves`` (``tree, leaf, value``), where given, replaces what each leaf predicts; the leaves of a
    tree are numbered by node id.
    """
    if not 1 <= rounds <= trees_of(model).getNumTrees:
        raise ValueError(f"cannot keep {rounds} of {trees_of(model).getNumTrees} rounds")
    model.write().overwrite().save(path)
    if rounds == trees_of(model).getNumTrees and leaves is None:
        return
    whole = scratch_path(spark, "whole-model")
    model.write().save(whole)
    place = f"stages/{len(model.stages) - 1}_{trees_of(model).uid}"
    for part in ("data", "treesMetadata"):
        rows = spark.read.parquet(f"{whole}/{place}/{part}")
        kept = rows.where(F.col(rows.columns[0]) < rounds)        # the tree's number
        if part == "data" and leaves is not None:
            kept = _with_leaf_values(kept, leaves)
        kept.write.mode("overwrite").parquet(f"{path}/{place}/{part}")
    facts = json.loads(spark.read.text(f"{whole}/{place}/metadata").first()[0])
    facts["numTrees"] = rounds
    facts["numFeatures"] = len(expected_features(model))
    (spark.createDataFrame([(json.dumps(facts),)], "value string").coalesce(1)
     .write.mode("overwrite").text(f"{path}/{place}/metadata"))
    remove_scratch(spark, whole)


def _with_leaf_values(nodes: DataFrame, leaves: DataFrame) -> DataFrame:
    """A node table in which every leaf predicts its value; other columns stay."""
    # Bounded: one window row per node of a tree.
    by_node = Window.partitionBy("treeID").orderBy(~F.col("nodeData.leftChild").eqNullSafe(-1), "nodeData.id")
    numbered = nodes.withColumn("_leaf", F.when(
        F.col("nodeData.leftChild") < 0, F.row_number().over(by_node) - 1))
    joined = numbered.join(
        leaves, (F.col("treeID") == F.col("tree")) & (F.col("_leaf") == F.col("leaf")), "left")
    value = F.when(F.col("_leaf").isNull(), F.col("nodeData.prediction")).otherwise(F.col("value"))
    return joined.withColumn("nodeData", F.col("nodeData").withField("prediction", value)).select(nodes.columns)


def feature_gains(spark: SparkSession, model_path: str, features: list[str],
                  rounds: int | None = None) -> DataFrame:
    """``(feature, gain, splits)`` for every feature of a saved model, unused ones at zero."""
    used = node_table(spark, model_path, rounds).groupBy("feature_index").agg(
        F.sum("gain").alias("gain"), F.count("*").alias("splits"))
    names = spark.createDataFrame(list(enumerate(features)), "feature_index int, feature string")
    return names.join(used, "feature_index", "left").select(
        "feature", F.coalesce("gain", F.lit(0.0)).alias("gain"),
        F.coalesce("splits", F.lit(0)).cast("bigint").alias("splits"))
