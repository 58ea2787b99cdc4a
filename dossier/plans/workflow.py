"""The jobs a user runs: split, train, predict, evaluate, report."""

from __future__ import annotations

import json
from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, Observation, SparkSession, functions as F

from dossier.functions.digest import (
    files_digest, json_digest, row_number_of, split_digest, table_digest)
from dossier.functions.naming import last_feature
from dossier.operators.audits import overflow_audit, require_same_columns
from dossier.operators.collapse import BATCH_AGGREGATES, collapse
from dossier.operators.importance import (
    importance_table, merge_by_base, ranked, top_features, unused_features)
from dossier.operators.joins import join_labels, unique_rows
from dossier.operators.metric import ranking_metric
from dossier.operators.splits import (
    assign_splits, class_balance, label_coverage, route_labelled, split_overlap, split_report)
from dossier.operators.vocabulary import Vocabulary, unseen_levels
from dossier.plans import boosting, model as trees
from dossier.session import leaves_no_scratch, scratch_path, scratch_scope
from dossier.sources import lineage, registry
from dossier.sources.artifacts import ensure_vocabulary, load_vocabulary, materialize
from dossier.sources.writers import write_csv, write_splits, write_table
from dossier.spec import FEATURE_VERSION, EntitySpec


@dataclass
class SplitResult:
    """Where a split was written, and its audits (lazy)."""

    split_id: str
    statements: str
    labels: str
    report: DataFrame
    balance: DataFrame
    coverage: DataFrame
    overlap: DataFrame
    overflow: DataFrame


def folder(path: str, split: str) -> str:
    return f"{path}/split={split}"


def code_levels(vocabulary: Vocabulary) -> dict[str, list[str]]:
    """Levels by the name of the code feature."""
    return {last_feature(c): levels for c, levels in vocabulary.items()}


@leaves_no_scratch
def split_job(spark: SparkSession, statements: DataFrame, labels: DataFrame, out: str,
              spec: EntitySpec, narrow: bool = False) -> SplitResult:
    """Cut labels into stratified splits, send statements after them, record where all came from."""
    # Checked once, then read many times.
    checked = scratch_path(spark, "checked-labels")
    write_table(unique_rows(labels.select(spec.id_col, spec.target_col), spec.id_col), checked)
    truth = spark.read.parquet(checked)
    statement_path, label_path = f"{out}/statements", f"{out}/labels"
    write_splits(assign_splits(truth, spec, checked=True), label_path)
    assigned = spark.read.parquet(label_path)
    known = assigned.select(spec.id_col, spec.target_col)
    # The statements' digest is taken while they are written.
    seen = Observation()
    sent = route_labelled(statements, known, spec).observe(
        seen, F.count(F.lit(1)).alias("n"), F.sum(row_number_of(statements.columns)).alias("sum"))
    write_splits(sent, statement_path, narrow=narrow)
    routed = spark.read.parquet(statement_path)
    source = table_digest(truth).select(F.concat_ws(
        ":", "n_rows", "digest", F.lit(str(seen.get["n"])), F.lit(str(seen.get["sum"])))).first()[0]
    digest = spark.range(1).select(split_digest(F.lit(source), spec.seed, spec.ratios)).first()[0]

    log = f"{out}/lineage"
    counts = {r["split"]: r for r in split_report(routed, spec).collect()}  # one row per split
    balance = {r["split"]: r for r in class_balance(assigned, spec).collect()}
    for name in spec.ratios:
        common = {"split_id": digest, "seed": spec.seed, "produced_by": "split_job",
                  "ratios": json.dumps(spec.ratios), "source_digest": json_digest(source)}
        held = balance.get(name)
        lineage.record(spark, log, folder(label_path, name), **common,
                       customers=held.n_entities if held else 0, positives=held.n_positive if held else 0)
        if name in counts:
            lineage.record(spark, log, folder(statement_path, name), rows=counts[name].n_rows,
                           customers=counts[name].n_entities, **common)
    numbers = [c for c in statements.columns if c in spec.numeric_cols(statements.columns)]
    return SplitResult(
        digest, statement_path, label_path,
        split_report(routed, spec), class_balance(assigned, spec),
        label_coverage(assigned, routed, spec), split_overlap(routed, spec),
        overflow_audit(statements.select(*numbers)))


@leaves_no_scratch
def collapse_job(spark: SparkSession, source: str, out: str, log: str, spec: EntitySpec,
                 vocabulary: Vocabulary, force: bool = False) -> DataFrame:
    """The feature table of one statement table, built once and recorded."""
    statements = spark.read.parquet(source)
    inputs = {"source": files_digest(statements), "vocabulary": json_digest(vocabulary),
              "feature_version": FEATURE_VERSION}

    def build() -> DataFrame:
        # What the collapse folds into the missing level is written beside the features.
        write_table(unseen_levels(statements, spec, vocabulary), f"{out}/unseen")
        return collapse(statements, spec, vocabulary, batch=BATCH_AGGREGATES)

    features = materialize(spark, build, out, inputs, force)
    lineage.inherit(spark, log, out, source, categories_digest=inputs["vocabulary"],
                    source_digest=inputs["source"], feature_version=FEATURE_VERSION,
                    produced_by="collapse_job", features=len(features.columns) - 1,
                    customers=features.count(), levels=sum(map(len, vocabulary.values())))
    return features


@leaves_no_scratch
def train_job(spark: SparkSession, split_dir: str, registry_root: str, spec: EntitySpec,
              params: dict | None = None, patience: int = trees.PATIENCE, block: int = boosting.BLOCK,
              l2: float = boosting.L2, force: bool = False, code_version: str | None = None) -> str:
    """Fit on the train split until the validation split stops improving, register the run."""
    log = f"{split_dir}/lineage"
    source = {n: folder(f"{split_dir}/statements", n) for n in ("train", "validation")}
    truth = {n: folder(f"{split_dir}/labels", n) for n in ("train", "validation")}
    table = {n: f"{split_dir}/features/{n}" for n in ("train", "validation")}
    vocabulary = ensure_vocabulary(
        spark.read.parquet(source["train"]), spec, f"{split_dir}/vocabulary", force)
    lineage.inherit(spark, log, f"{split_dir}/vocabulary", source["train"],
                    categories_digest=json_digest(vocabulary), produced_by="train_job")
    features = {n: collapse_job(spark, source[n], table[n], log, spec, vocabulary, force)
                for n in source}
    split_id = lineage.require_same_split(spark, log, *table.values(), *truth.values())
    require_same_columns(features["train"], features["validation"])

    labelled, report = {}, {}
    for n in source:
        seen, path = Observation(), scratch_path(spark, f"labelled-{n}")
        write_table(join_labels(features[n], spark.read.parquet(truth[n]), spec, seen), path)
        labelled[n] = spark.read.parquet(path)
        shares = class_balance(labelled[n], spec, by=None).first()
        report[n] = {"rows": seen.get["n_rows"], "unlabelled": seen.get["n_unlabelled"],
                     "positives": shares.n_positive, "positive_share": shares.positive_share}
    expected = [c for c in features["train"].columns if c != spec.id_col]
    levels = code_levels(vocabulary)
    settings = {**trees.PARAMS, "seed": spec.seed, **(params or {})}
    boosted = boosting.boost(labelled["train"], labelled["validation"], spec, expected, levels, settings,
                             patience, block, l2)

    run_id = registry.new_run_id(spec.seed)
    meta = {
        "run_id": run_id, "split_id": split_id, "feature_version": FEATURE_VERSION,
        "feature_name": expected, "cat_cols": list(spec.cat_cols), "categories": vocabulary,
        "categories_digest": json_digest(vocabulary), "best_iteration": boosted.best_iteration,
        "rounds_fitted": len(boosted.trees),
        "valid_metric": {m: boosted.best[m] for m in boosting.METRICS},
        "params": {k: str(v) for k, v in settings.items()}, "params_digest": json_digest(settings),
        "trained_on": table["train"], "validated_on": table["validation"],
        "inputs": {path: lineage.split_id_of(spark, log, path)
                   for path in (*table.values(), *truth.values())},
        "code_version": code_version, "labels": report,
    }
    registry.save_run(spark, registry_root, run_id, lambda path: boosted.save(spark, path), meta)
    lineage.record(spark, log, registry.run_dir(registry_root, run_id), split_id=split_id, run_id=run_id,
                   seed=spec.seed, produced_by="train_job", feature_version=FEATURE_VERSION,
                   features=len(expected), customers=report["train"]["rows"],
                   unlabelled=report["train"]["unlabelled"], positives=report["train"]["positives"],
                   levels=sum(map(len, vocabulary.values())), code_version=code_version)
    return run_id


def check_model_fits(meta: dict | None, data_split: str | None) -> None:
    """Refuse features of another version, or a holdout of another split; a loose model is taken as it is."""
    version, split = (meta or {}).get("feature_version", FEATURE_VERSION), (meta or {}).get("split_id")
    if version != FEATURE_VERSION:
        raise ValueError(f"this build makes features of version {FEATURE_VERSION} and the model knows "
                         f"version {version}; retrain it")
    if None not in (split, data_split) and split != data_split:
        raise ValueError(f"model and data cannot be compared: splits {split} and {data_split}")


def predict_job(spark: SparkSession, source: str, split_dir: str, registry_root: str, out: str,
                spec: EntitySpec, labels: str | None = None, run_id: str | None = None,
                model_path: str | None = None, force: bool = False):
    """Score one statement table; with labels, also the metric and the label audit.

    Returns ``(predictions, metric or None, audit or None)``.
    """
    log = f"{split_dir}/lineage"
    path = registry.resolve_model(spark, registry_root, run_id, model_path)
    meta = registry.load_meta(spark, path)
    check_model_fits(meta, lineage.split_id_of(spark, log, source))
    vocabulary = (meta or {}).get("categories") or load_vocabulary(spark, f"{split_dir}/vocabulary")
    features = collapse_job(spark, source, f"{out}/features", log, spec, vocabulary, force)
    model = PipelineModel.load(path)
    with scratch_scope(spark):
        scored = trees.score(features, model, spec, code_levels(vocabulary),
                             (meta or {}).get("best_iteration"))
        write_table(scored, f"{out}/predictions")
    lineage.inherit(spark, log, f"{out}/predictions", source,
                    run_id=(meta or {}).get("run_id"), produced_by="predict_job")
    predictions = spark.read.parquet(f"{out}/predictions")
    if labels is None:
        return predictions, None, None
    seen = Observation()
    write_table(join_labels(predictions, spark.read.parquet(labels), spec, seen), f"{out}/evaluated")
    audit = spark.createDataFrame(
        [(seen.get["n_rows"], seen.get["n_unlabelled"])], "n_rows long, n_unlabelled long")
    metric = ranking_metric(spark.read.parquet(f"{out}/evaluated"), spec.id_col, spec.target_col)
    return predictions, metric, audit


def score_statements(statements: DataFrame, model: PipelineModel, spec: EntitySpec,
                     vocabulary: Vocabulary, rounds: int | None = None) -> DataFrame:
    """Raw statements in any order to ``(id, predicted_probability)``, in one plan."""
    return trees.score(collapse(statements, spec, vocabulary), model, spec,
                       code_levels(vocabulary), rounds, "predicted_probability")


@leaves_no_scratch
def evaluate_job(spark: SparkSession, statements: DataFrame, labels: DataFrame,
                 model: PipelineModel, spec: EntitySpec, vocabulary: Vocabulary,
                 rounds: int | None = None) -> DataFrame:
    """``(auc, n_evaluated, n_unmatched)`` of raw statements against labels.

    The labelled scores are written once, as the metric reads them more than once.
    """
    missing = [c for c in (spec.id_col, spec.target_col) if c not in labels.columns]
    if missing:
        raise KeyError(f"labels lack column(s) {missing}")
    seen, path = Observation(), scratch_path(spark, "labelled-scores")
    scores = score_statements(statements, model, spec, vocabulary, rounds)
    write_table(join_labels(scores, labels, spec, seen), path)
    unmatched = seen.get["n_unlabelled"]
    evaluated = seen.get["n_rows"] - unmatched
    if not evaluated:
        raise ValueError("none of the scored ids has a label: different datasets?")
    auc = ranking_metric(spark.read.parquet(path), spec.id_col, spec.target_col,
                         "predicted_probability").select(F.round("auc", 6)).first()[0]
    return spark.createDataFrame([(auc, evaluated, unmatched)],
                                 "auc double, n_evaluated long, n_unmatched long")


def importance_job(spark: SparkSession, registry_root: str, out: str, run_id: str | None = None,
                   model_path: str | None = None, k: int = 20) -> dict[str, DataFrame]:
    """Raw and merged importance rankings, written as CSV, with their top rows."""
    path = registry.resolve_model(spark, registry_root, run_id, model_path)
    meta = registry.load_meta(spark, path) or {}
    features = meta.get("feature_name") or trees.expected_features(PipelineModel.load(path))
    gains = trees.feature_gains(spark, path, features, meta.get("best_iteration"))
    table = importance_table(gains, meta.get("cat_cols") or ())
    merged = merge_by_base(table)
    write_csv(ranked(table), f"{out}/gain")
    write_csv(ranked(merged), f"{out}/gain_merged")
    return {"table": ranked(table), "merged": ranked(merged),
            "top": top_features(table, k), "top_merged": top_features(merged, k),
            "unused": unused_features(table)}
