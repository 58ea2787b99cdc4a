"""Joins, sources, registry, lineage, whole jobs and streams."""

import datetime as dt
import random
import tempfile
from dataclasses import replace

import pytest
from pyspark.errors import PySparkException
from pyspark.ml import PipelineModel
from pyspark.sql import Observation, functions as F, types as T

from dossier import EntitySpec
from dossier.operators import joins
from dossier.operators.collapse import collapse
from dossier.operators.importance import importance_table, merge_by_base, top_features
from dossier.operators.vocabulary import fit_vocabulary
from dossier.plans import model as trees
from dossier.plans import workflow
from dossier.sources import artifacts, lineage, readers, registry, writers
from dossier.streaming import jobs

SPEC = EntitySpec(id_col="id", date_col="day", seq_col="seq", target_col="target", cat_cols=("cat",))


@pytest.fixture
def folder():
    return tempfile.mkdtemp(prefix="dossier-test-")


def history(spark, n=300, seed=1):
    rng = random.Random(seed)
    rows, labels = [], []
    for e in range(n):
        risk = rng.random()
        for k in range(rng.randrange(1, 6)):
            rows.append((f"e{e}", dt.date(2024, 1 + k, 1), k, risk + rng.gauss(0, 0.2),
                         rng.gauss(0, 1) if rng.random() < 0.8 else None,
                         rng.choice(["hi", "lo"]) if risk < 0.5 else "hi"))
        labels.append((f"e{e}", int(risk + rng.gauss(0, 0.15) > 0.7)))
    statements = spark.createDataFrame(
        rows, "id string, day date, seq long, x double, y double, cat string")
    return statements, spark.createDataFrame(labels, "id string, target int")


def test_label_join_reports_what_it_drops(spark):
    rows = spark.createDataFrame([("a", 1), ("b", 2), ("c", 3)], "id string, v int")
    labels = spark.createDataFrame([("a", 1), ("b", 0), ("z", 0)], "id string, target int")
    seen = Observation()
    out = joins.join_labels(rows, labels, SPEC, seen)
    assert sorted((r.id, r.v, r.target) for r in out.collect()) == [("a", 1, 1), ("b", 2, 0)]
    assert seen.get == {"n_rows": 3, "n_unlabelled": 1}
    assert sorted(joins.join_labels(rows, labels, SPEC).collect()) == sorted(out.collect())
    assert joins.label_audit(rows, labels, SPEC).first() == (3, 2, 1)


def test_duplicate_labels_fail(spark):
    rows = spark.createDataFrame([("a", 1)], "id string, v int")
    labels = spark.createDataFrame([("a", 1), ("a", 0)], "id string, target int")
    with pytest.raises(PySparkException, match="more than one row"):
        joins.join_labels(rows, labels, SPEC).collect()


def test_no_matches_is_an_error(spark):
    rows = spark.createDataFrame([("a", 1)], "id string, v int")
    labels = spark.createDataFrame([("q", 1)], "id string, target int")
    with pytest.raises(PySparkException, match="different"):
        joins.require_matches(joins.label_audit(rows, labels, SPEC)).collect()


@pytest.mark.parametrize("how", ["left", "inner", "left_semi", "left_anti"])
def test_salted_join_equals_plain_join(spark, how):
    rng = random.Random(2)
    facts = spark.createDataFrame(
        [(rng.choice(["hot"] * 5 + [None] + [f"k{i}" for i in range(9)]), i) for i in range(600)],
        "id string, v int")
    lookup = spark.createDataFrame([("hot", 1), *[(f"k{i}", i) for i in range(5)]], "id string, w int")
    hot = joins.hot_keys(facts, "id", 0.1)
    assert "hot" in hot and len(hot) <= 10
    got = joins.lookup_join(facts, lookup, "id", how, broadcast_bytes=0).collect()
    want = facts.join(lookup, "id", how).collect()
    assert sorted(got, key=str) == sorted(want, key=str)
    salted = joins.salted_join(facts, lookup, "id", ["hot"], how, salts=16)
    assert sorted(salted.collect(), key=str) == sorted(want, key=str)


def test_measured_bytes_grows_with_rows(spark):
    small = spark.createDataFrame([("a" * 10, 1)] * 10, "s string, i int")
    assert joins.measured_bytes(small) == 10 * (16 + 32 + 10)
    assert joins.measured_bytes(small.limit(0)) == 0


def test_probe_schema(spark, folder):
    path = f"{folder}/head.csv"
    with open(path, "w") as out:
        out.write("customer_ID,S_2,n,x,empty,text,mixed\n")
        out.write("0012,2017-03-09,1,0.5,,CO,1\n0013,2017-04-09,,2,,,a\n")
    schema = readers.probe_schema(spark, path, ["customer_ID"])
    assert [f.dataType for f in schema.fields] == [
        T.StringType(), T.DateType(), T.LongType(), T.DoubleType(), T.DoubleType(),
        T.StringType(), T.StringType()]
    rows = readers.read_statements(spark, path, text_cols=["customer_ID"]).collect()
    assert rows[0].customer_ID == "0012" and rows[1].S_2 == dt.date(2017, 4, 9)


def test_same_features_from_parquet_and_csv(spark, folder):
    statements, _ = history(spark, 30)
    writers.write_table(statements, f"{folder}/s.parquet")
    writers.write_csv(statements, f"{folder}/s.csv")
    vocabulary = fit_vocabulary(statements, SPEC)
    a, b = (collapse(readers.read_statements(spark, f"{folder}/s.{k}", text_cols=["id"]),
                     SPEC, vocabulary) for k in ("parquet", "csv"))
    assert sorted(a.collect()) == sorted(b.collect())


def test_unknown_format_and_missing_file(spark, folder):
    with pytest.raises(ValueError, match="parquet or csv"):
        readers.read_statements(spark, f"{folder}/x", kind="xls")
    with pytest.raises(PySparkException):
        readers.read_statements(spark, f"{folder}/none.parquet")


def test_file_without_extension_is_tried_as_both(spark, folder):
    statements, _ = history(spark, 5)
    writers.write_csv(statements, f"{folder}/plain")
    assert readers.read_statements(spark, f"{folder}/plain").count() == statements.count()


def test_vocabulary_is_saved_once(spark, folder):
    statements, _ = history(spark, 10)
    path = f"{folder}/vocabulary"
    with pytest.raises(FileNotFoundError):
        artifacts.load_vocabulary(spark, path)
    first = artifacts.ensure_vocabulary(statements, SPEC, path)
    assert first == artifacts.load_vocabulary(spark, path) == {"cat": ["hi", "lo", "NaN"]}
    fewer = statements.where("cat = 'hi'")
    written = artifacts.receipt(spark, path)
    assert artifacts.ensure_vocabulary(statements, SPEC, path) == first
    assert artifacts.receipt(spark, path) == written
    # Other training rows, as after another split, give another vocabulary.
    assert artifacts.ensure_vocabulary(fewer, SPEC, path) == {"cat": ["hi", "NaN"]}
    assert artifacts.ensure_vocabulary(fewer, SPEC, path, force=True) == {"cat": ["hi", "NaN"]}
    assert artifacts.receipt(spark, path) != written


def test_a_failed_rebuild_leaves_the_earlier_table(spark, folder):
    path, key = f"{folder}/t", {"a": 1}
    artifacts.materialize(spark, lambda: spark.range(3), path, key)
    broken = spark.range(3).select(F.raise_error(F.lit("stopped half way")).cast("long").alias("id"))
    with pytest.raises(PySparkException, match="half way"):
        artifacts.materialize(spark, lambda: broken, path, key, force=True)
    assert artifacts.materialize(spark, lambda: broken, path, key).count() == 3


@pytest.mark.parametrize("values, kind, want", [
    (["1d", "2f", "3"], "string", ["1d", "2f", "3"]), (["01", "1", "007"], "string", ["01", "1", "007"]),
    (["1e3", "2.5", "NaN", ".5", "-0"], "double", [1000.0, 2.5, None, 0.5, 0.0]), (["-7", "", "12"], "bigint", [-7, None, 12]),
    (["9223372036854775807", "-5"], "bigint", [2 ** 63 - 1, -5]), (["9223372036854775808"], "string", None),
    (["1234567890123456", "0.5"], "string", None), (["1e400", "2"], "string", None), (["+5", "1"], "string", None),
    (["0x1F", "1"], "string", None), (["1_000"], "string", None), (["Infinity", "-inf", "1"], "double", None),
    (["2024-1-05", "2024-02-29"], "date", None), (["2024-02-30"], "string", None), (["2024-01-01", "5"], "string", None),
    (["2024-01-01 10:00:00", ""], "timestamp", None), (["1L", "2"], "string", None), (["--1"], "string", None), (["."], "string", None)])
def test_csv_types_change_no_value(spark, folder, values, kind, want):
    with open(f"{folder}/t.csv", "w") as out:
        out.write("k,v\n" + "".join(f'{i},"{v}"\n' for i, v in enumerate(values)))
    got = readers.read_statements(spark, f"{folder}/t.csv")
    assert got.schema["v"].dataType.simpleString() == kind
    rows = [r.v for r in got.orderBy("k").collect()]
    assert want is None or [None if r != r else r for r in rows] == want
    if kind == "string":
        assert rows == values
        with pytest.raises(PySparkException, match="no (bigint|double)"):
            for number in ("bigint", "double"):
                readers.read_csv(spark, f"{folder}/t.csv", f"k bigint, v {number}").collect()


def test_late_csv_values_are_neither_lost_nor_mistyped(spark, folder):
    rows = [(i, None) for i in range(12_000)] + [(f"{i}.5", f"text {i}") for i in range(500)]
    path = f"{folder}/late.csv"
    with open(path, "w") as out:
        out.write("v,w\n" + "".join(f"{v},{w or ''}\n" for v, w in rows))
    got = readers.read_statements(spark, path)
    assert [f.dataType for f in got.schema.fields] == [T.DoubleType(), T.StringType()]
    assert got.agg(F.count("v"), F.count("w")).first() == (12_500, 500)
    with pytest.raises(PySparkException, match="no bigint"):
        readers.read_csv(spark, path, "v bigint, w string").agg(F.sum("v")).collect()
    with open(f"{folder}/ragged.csv", "w") as out:
        out.write("v,w\n1,2\n1,2,3\n")
    with pytest.raises(Exception, match="MALFORMED_CSV_RECORD"):
        readers.read_csv(spark, f"{folder}/ragged.csv", "v bigint, w bigint").collect()


def test_bytes_that_are_no_table_are_refused(spark, folder):
    with open(f"{folder}/noise", "wb") as out:
        out.write(random.Random(1).randbytes(4000))
    with pytest.raises(ValueError, match="control characters"):
        readers.read_statements(spark, f"{folder}/noise")
    with pytest.raises(PySparkException):
        readers.read_statements(spark, f"{folder}/missing")
    with open(f"{folder}/other.csv", "w") as out:
        out.write("a,b\n1,2\n")
    with pytest.raises(ValueError, match="no column id"):
        readers.read_statements(spark, f"{folder}/other.csv", id_col="id")


def test_tables_are_built_once_per_inputs(spark, folder):
    calls = []

    def build():
        calls.append(1)
        return spark.range(3)

    for inputs, force in (({"a": 1}, False), ({"a": 1}, False), ({"a": 2}, False), ({"a": 1}, True)):
        assert artifacts.materialize(spark, build, f"{folder}/t", inputs, force).count() == 3
    assert len(calls) == 3


def test_lineage(spark, folder):
    log = f"{folder}/lineage"
    assert lineage.get(spark, log, "one") is None
    lineage.record(spark, log, "one", split_id="a" * 12, rows=1)
    lineage.record(spark, log, "one", split_id="a" * 12, rows=2)
    lineage.record(spark, log, "two", split_id="b" * 12)
    lineage.inherit(spark, log, "three", "one")
    assert lineage.get(spark, log, "one").rows == 2
    assert lineage.require_same_split(spark, log, "one", "three") == "a" * 12
    with pytest.raises(ValueError, match="different splits"):
        lineage.require_same_split(spark, log, "one", "two")
    assert lineage.require_same_split(spark, log, "one", "unknown") is None
    with pytest.raises(ValueError):
        lineage.require_same_split(spark, log, "one", "two", "unknown")
    with pytest.raises(KeyError):
        lineage.record(spark, log, "one", nonsense=1)


def test_registry(spark, folder):
    with pytest.raises(FileNotFoundError, match="no runs"):
        registry.resolve_model(spark, folder)
    assert registry.latest_run_id(spark, folder) is None
    registry.log_run(spark, folder, {"run_id": "run-one", "score": 0.80})
    registry.log_run(spark, folder, {"run_id": "run-two", "score": 0.70})
    registry.log_run(spark, folder, {"run_id": "run-three"})
    runs = registry.list_runs(spark, folder)
    assert [r.run_id for r in runs.collect()] == ["run-one", "run-two", "run-three"]
    assert registry.latest_run_id(spark, folder) == "run-three"
    assert registry.best_run(runs).first() == ("run-one", 0.80)
    assert registry.resolve_model(spark, folder, model_path="/some/model") == "/some/model"
    with pytest.raises(FileNotFoundError, match="run-two"):
        registry.resolve_model(spark, folder, "run-two")
    assert registry.new_run_id(42) != registry.new_run_id(42)


def test_importance(spark):
    gains = spark.createDataFrame(
        [("P_2_mean", 6.0, 3), ("P_2_last", 2.0, 1), ("B_30_0", 2.0, 2), ("S_1_max", 0.0, 0)],
        "feature string, gain double, splits long")
    table = importance_table(gains, ["B_30"])
    merged = {r.feature: r for r in merge_by_base(table).collect()}
    assert (merged["P_2"].gain, merged["P_2"].gain_pct, merged["P_2"].parts) == (8.0, 80.0, 2)
    assert merged["B_30"].splits == 2 and merged["S_1"].gain == 0.0
    top = top_features(table, 2).collect()
    assert [(r.place, r.feature, r.cum_pct) for r in top] == [
        (1, "P_2_mean", 60.0), (2, "B_30_0", 80.0)]


def test_split_train_predict_evaluate_report(spark, folder):
    statements, labels = history(spark)
    strangers = statements.limit(5).withColumn("id", F.concat(F.lit("new"), F.col("id")))
    cut = workflow.split_job(spark, statements.unionByName(strangers), labels,
                             f"{folder}/split", SPEC)
    assert cut.report.agg(F.sum("n_rows")).first()[0] == statements.count() + 5
    assert cut.overlap.agg(F.sum("n_shared")).first()[0] == 0
    assert cut.coverage.agg(F.sum("n_never_seen")).first()[0] == 0
    assert cut.overflow.count() == 0
    balance = {r.split: (r.n_entities, r.n_positive) for r in cut.balance.collect()}
    positives = labels.agg(F.sum("target")).first()[0]
    per_class = [positives, 300 - positives]
    assert {s: n for s, (n, _) in balance.items()} == {
        "train": sum(n * 7 // 10 for n in per_class),
        "validation": sum(n * 9 // 10 - n * 7 // 10 for n in per_class),
        "test": sum(n - n * 9 // 10 for n in per_class)}
    known = lineage.get(spark, f"{folder}/split/lineage", workflow.folder(cut.labels, "train"))
    assert (known.customers, known.positives) == balance["train"] and '"train": 7' in known.ratios
    # Other statements under the same labels are another split.
    fewer = workflow.split_job(spark, statements.where("seq < 3"), labels, f"{folder}/other", SPEC)
    assert fewer.split_id != cut.split_id
    with pytest.raises(ValueError, match="different splits"):
        lineage.record(spark, f"{folder}/split/lineage", "foreign", split_id=fewer.split_id)
        lineage.require_same_split(spark, f"{folder}/split/lineage", "foreign",
                                   workflow.folder(cut.labels, "train"))

    params = {"maxIter": 6, "maxDepth": 3, "subsamplingRate": 1.0, "minInstancesPerNode": 5,
              "featureSubsetStrategy": "all", "stepSize": 0.3}
    run = workflow.train_job(spark, f"{folder}/split", f"{folder}/runs", SPEC, params,
                             patience=3, block=2)
    meta = registry.load_meta(spark, f"{folder}/runs/{run}/model")
    assert meta["split_id"] == cut.split_id and 1 <= meta["best_iteration"] <= 6
    assert registry.list_runs(spark, f"{folder}/runs").first().score == meta["valid_metric"]["score"]
    saved = PipelineModel.load(f"{folder}/runs/{run}/model")
    assert trees.trees_of(saved).getNumTrees == meta["best_iteration"]
    report = meta["labels"]["train"]
    strange = strangers.select("id").distinct().count()        # unlabelled entities go to the first split
    assert (report["rows"], report["unlabelled"]) == (balance["train"][0] + strange, strange)
    assert report["positives"] == balance["train"][1]
    record = lineage.get(spark, f"{folder}/split/lineage", f"{folder}/runs/{run}")
    assert (record.customers, record.unlabelled) == (report["rows"], strange)
    assert spark.read.parquet(f"{folder}/split/features/train/unseen").count() == 0
    typed = registry.read_metas(spark, f"{folder}/runs").first()
    assert typed.categories == meta["categories"] and typed.run_id == run

    test = workflow.folder(cut.statements, "test")
    predictions, metric, audit = workflow.predict_job(
        spark, test, f"{folder}/split", f"{folder}/runs", f"{folder}/out", SPEC,
        labels=workflow.folder(cut.labels, "test"))
    assert predictions.count() == metric.first().n_rows == audit.first().n_rows
    assert audit.first().n_unlabelled == 0 and metric.first().auc > 0.8
    assert lineage.split_id_of(spark, f"{folder}/split/lineage",
                               f"{folder}/out/predictions") == cut.split_id

    model = PipelineModel.load(registry.resolve_model(spark, f"{folder}/runs"))
    rows = spark.read.parquet(test).orderBy(F.rand(3))
    served = workflow.score_statements(rows, model, SPEC, meta["categories"], meta["best_iteration"])
    assert sorted(tuple(r) for r in served.collect()) == sorted(
        tuple(r) for r in predictions.collect())
    report = workflow.evaluate_job(spark, rows, labels, model, SPEC, meta["categories"],
                                   meta["best_iteration"]).first()
    assert report.auc == round(metric.first().auc, 6) and report.n_unmatched == 0
    with pytest.raises(KeyError, match="target"):
        workflow.evaluate_job(spark, rows, labels.drop("target"), model, SPEC, meta["categories"])

    ranking = workflow.importance_job(spark, f"{folder}/runs", f"{folder}/importance")
    assert ranking["merged"].first().feature == "x"
    assert abs(ranking["table"].agg(F.sum("gain_pct")).first()[0] - 100) < 1e-9
    written = spark.read.option("header", True).csv(f"{folder}/importance/gain")
    assert written.count() == len(meta["feature_name"])

    own = {f: g for f, g in zip(meta["feature_name"], trees.trees_of(saved).featureImportances.toArray())}
    for r in ranking["table"].collect():
        assert abs(r.gain_pct / 100 - own[r.feature]) < 1e-9
    lineage.record(spark, f"{folder}/split/lineage", test, split_id="another-cut!")
    with pytest.raises(ValueError, match="cannot be compared"):
        workflow.predict_job(spark, test, f"{folder}/split", f"{folder}/runs", f"{folder}/out2", SPEC)
    with pytest.raises(ValueError, match="cannot be compared"):
        workflow.check_model_fits(meta, "another-cut!")
    with pytest.raises(ValueError, match="retrain"):
        workflow.check_model_fits({**meta, "feature_version": 1}, cut.split_id)
    workflow.check_model_fits(None, cut.split_id)


def test_staged_scores_end_at_the_full_model(spark):
    statements, labels = history(spark, 80)
    vocabulary = fit_vocabulary(statements, SPEC)
    rows = joins.join_labels(collapse(statements, SPEC, vocabulary), labels, SPEC).persist()
    expected = [c for c in rows.columns if c not in ("id", "target")]
    levels = workflow.code_levels(vocabulary)
    model = trees.fit_trees(rows, SPEC, expected, levels, {
        "maxIter": 4, "maxDepth": 2, "minInstancesPerNode": 2, "subsamplingRate": 1.0,
        "featureSubsetStrategy": "all"})
    every = trees.staged_scores(rows, model, SPEC, levels)
    assert sorted({r.iteration for r in every.collect()}) == [1, 2, 3, 4]
    for k in range(1, 5):       # each round is the model of that many trees
        part = {r.id: r.prediction for r in trees.score(rows, model, SPEC, levels, rounds=k).collect()}
        own = {r.id: r.prediction for r in every.where(F.col("iteration") == k).collect()}
        assert all(abs(part[i] - own[i]) < 1e-12 for i in part)
    staged = trees.staged_scores(rows, model, SPEC, levels, every=2)
    assert sorted({r.iteration for r in staged.collect()}) == [1, 2, 4]
    full = {r.id: r.prediction for r in trees.score(rows, model, SPEC, levels).collect()}
    last = {r.id: r.prediction for r in staged.where("iteration = 4").collect()}
    assert all(abs(full[k] - last[k]) < 1e-12 for k in full)
    first = {r.id: r.prediction for r in trees.score(rows, model, SPEC, levels, rounds=2).collect()}
    half = {r.id: r.prediction for r in staged.where("iteration = 2").collect()}
    assert all(abs(first[k] - half[k]) < 1e-12 for k in first) and half != last


def test_codes_are_split_as_categories(spark):
    """Only a categorical split can part code 1 from codes 0 and 2 in one step."""
    rows = spark.createDataFrame([(f"e{i}", i % 3, int(i % 3 == 1)) for i in range(90)],
                                 "id string, cat_last tinyint, target int")
    model = trees.fit_trees(rows, SPEC, ["cat_last"], {"cat_last": ["a", "b", "NaN"]}, {
        "maxIter": 1, "maxDepth": 1, "minInstancesPerNode": 1, "subsamplingRate": 1.0,
        "featureSubsetStrategy": "all"})
    scored = trees.score(rows, model, SPEC, {"cat_last": ["a", "b", "NaN"]})
    both = scored.join(rows, "id").groupBy("target").agg(F.min("prediction"), F.max("prediction"))
    low, high = (tuple(r)[1:] for r in both.orderBy("target").collect())
    assert low[1] < 0.5 < high[0]


def test_missing_and_infinite_features_are_taken(spark):
    inf, nan = float("inf"), float("nan")
    rows = spark.createDataFrame(
        [("a", nan, 1), ("b", None, 1), ("c", inf, 0), ("d", -inf, 0), ("e", 0.5, 0)],
        "id string, x float, target int")
    model = trees.fit_trees(rows, SPEC, ["x"], {}, {
        "maxIter": 1, "maxDepth": 2, "minInstancesPerNode": 1, "subsamplingRate": 1.0,
        "featureSubsetStrategy": "all"})
    got = {r.id: r.prediction for r in trees.score(rows, model, SPEC, {}).collect()}
    assert got["a"] == got["b"] > 0.5 > got["c"]


def test_split_files_can_be_evened_out(spark, folder):
    rows = spark.range(1000).repartition(8).withColumn(
        "split", F.when(F.col("id") % 10 < 7, "train").otherwise("test"))
    writers.write_splits(rows, f"{folder}/even", even_files=True)
    back = spark.read.parquet(f"{folder}/even")
    assert len(back.inputFiles()) < 8 and back.count() == 1000


def test_stream_of_files_gives_the_batch_result(spark, folder):
    statements, labels = history(spark, 60)
    vocabulary = fit_vocabulary(statements, SPEC)
    statements.repartition(4, "seq", "x").write.parquet(f"{folder}/feed")
    stream = jobs.read_stream(spark, f"{folder}/feed", statements.schema, files_per_batch=1)
    jobs.collapse_stream(stream, SPEC, vocabulary, f"{folder}/changes",
                         f"{folder}/cp1").awaitTermination()
    changes = spark.read.parquet(f"{folder}/changes")
    assert changes.select("batch").distinct().count() > 1
    got = jobs.latest_features(changes, "id")
    want = collapse(statements, SPEC, vocabulary)
    key = lambda r: r.id                                        # noqa: E731
    for a, b in zip(sorted(got.collect(), key=key), sorted(want.collect(), key=key), strict=True):
        assert a.id == b.id
        for x, y in zip(a, b):
            assert x == y or abs(x - y) < 1e-6

    with pytest.raises(ValueError, match="another checkpoint"):
        jobs.collapse_stream(stream, SPEC, vocabulary, f"{folder}/changes", f"{folder}/cp9")

    from dossier.operators.splits import assign_splits
    with pytest.raises(ValueError, match="more than once"):
        assign_splits(labels.unionByName(labels.limit(1)), SPEC)
    assigned = assign_splits(labels.where("id <> 'e7'"), replace(SPEC, cat_cols=()))
    stream = jobs.read_stream(spark, f"{folder}/feed", statements.schema, files_per_batch=2)
    jobs.route_stream(stream, assigned, SPEC, f"{folder}/routed", f"{folder}/cp2").awaitTermination()
    routed = spark.read.parquet(f"{folder}/routed")
    batch = joins.route_statements(statements, assigned, SPEC)
    pick = ["id", "seq", "split"]
    assert sorted(routed.select(pick).collect()) == sorted(batch.select(pick).collect())
    assert {r.split for r in routed.where("id = 'e7'").collect()} == {"train"}
    jobs.route_stream(stream, assigned, SPEC, f"{folder}/salted", f"{folder}/cp3", hot=["e1", "e2"],
                      broadcast_bytes=0).awaitTermination()
    salted = spark.read.parquet(f"{folder}/salted")
    assert sorted(salted.select(pick).collect()) == sorted(batch.select(pick).collect())


def test_importance_is_that_of_the_model(spark):
    """Gains weigh a split by its rows: a split of few rows counts for little."""
    rng = random.Random(7)
    rows = spark.createDataFrame(
        [(f"e{i}", a := rng.random(), b := rng.random(), rng.random(), int(a + 0.1 * b > 0.6)) for i in range(2000)],
        "id string, a double, b double, c double, target int")
    model = trees.fit_trees(rows, SPEC, ["a", "b", "c"], {}, {
        "maxIter": 5, "maxDepth": 4, "minInstancesPerNode": 5, "subsamplingRate": 1.0,
        "featureSubsetStrategy": "all"})
    path = tempfile.mkdtemp(prefix="dossier-test-")
    model.write().overwrite().save(f"{path}/model")
    gains = {r.feature: r.gain for r in trees.feature_gains(spark, f"{path}/model", ["a", "b", "c"]).collect()}
    own = trees.trees_of(model).featureImportances.toArray()
    assert all(abs(gains[f] / sum(gains.values()) - own[i]) < 1e-9 for i, f in enumerate("abc"))
    assert gains["a"] > 0.9 * sum(gains.values())
    trees.cut_saved_model(spark, model, f"{path}/cut", 2)
    cut = {r.feature: r.gain for r in trees.feature_gains(spark, f"{path}/cut", ["a", "b", "c"]).collect()}
    first = {r.feature: r.gain for r in trees.feature_gains(spark, f"{path}/model", ["a", "b", "c"], 2).collect()}
    assert cut == first and cut != gains
    for rounds in (0, -1, 6):
        with pytest.raises(ValueError):
            trees.cut_saved_model(spark, model, f"{path}/none", rounds)


def test_wide_collapse_without_sequence_reads_the_statements_once(spark, folder):
    """177 number columns and no seq_col: every data column is scanned once, null ids fail at any width."""
    spec = EntitySpec(id_col="id", date_col="day", cat_cols=())
    rows = spark.range(60).select(
        (F.col("id") % 7).alias("id"), F.lit(dt.date(2024, 1, 1)).alias("day"),
        *[(F.col("id") * (i + 3) % 101).cast("double").alias(f"x{i}") for i in range(177)])
    rows.write.parquet(f"{folder}/wide")
    source = spark.read.parquet(f"{folder}/wide")
    wide = collapse(source, spec, {}, "double", batch=42)
    plain = collapse(source, spec, {}, "double")
    assert sorted(map(tuple, wide.collect())) == sorted(map(tuple, plain.collect()))
    leaves = wide._jdf.queryExecution().sparkPlan().collectLeaves()
    assert not {f for f in wide.inputFiles() if f"{folder}/wide" in f}      # the source was read before, once
    scanned = [leaves.apply(i).output().apply(j).name() for i in range(leaves.size())
               for j in range(leaves.apply(i).output().size())]
    numbers = [c for c in scanned if c.startswith("n")]
    assert leaves.size() > 10 and len(numbers) == len(set(numbers)) == 177
    for width in (2, 60):
        odd = source.select(F.lit(None).cast("long").alias("id"), "day", *[f"x{i}" for i in range(width)])
        with pytest.raises(PySparkException, match="without an id"):
            collapse(odd, spec, {}, batch=42).collect()


def test_jobs_leave_no_scratch(spark, folder):
    from dossier.session import scratch_path, scratch_scope, work_dir
    held = lambda: {f.getPath().getName() for f in fs.listStatus(where)} if fs.exists(where) else set()
    where = spark._jvm.org.apache.hadoop.fs.Path(f"{work_dir(spark)}/dossier")
    fs = where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    statements, labels = history(spark, 120)
    before = held()
    workflow.split_job(spark, statements, labels, f"{folder}/split", SPEC)
    workflow.train_job(spark, f"{folder}/split", f"{folder}/runs", SPEC, {
        "maxIter": 2, "maxDepth": 2, "minInstancesPerNode": 2, "featureSubsetStrategy": "all"}, block=2)
    workflow.predict_job(spark, workflow.folder(f"{folder}/split/statements", "test"), f"{folder}/split",
                         f"{folder}/runs", f"{folder}/out", SPEC)
    assert held() == before
    with pytest.raises(ZeroDivisionError), scratch_scope(spark):
        spark.range(3).write.parquet(scratch_path(spark, "lost"))
        1 / 0
    assert held() == before


def _exchanges(frame):
    """The shuffles of the plan that ran, with the rows each wrote in its partitions."""
    text = frame._jdf.queryExecution().toString()
    return text.count("REBALANCE_PARTITIONS_BY_COL"), text.count("ENSURE_REQUIREMENTS")


def test_wide_collapse_gathers_rows_before_it_aggregates(spark):
    """A wide collapse holds partial rows of its partition's ids only; a hot id keeps its partials."""
    spec = EntitySpec(id_col="id", date_col="day", seq_col="seq", cat_cols=())
    rows = spark.range(400).select(
        (F.col("id") % 7).alias("id"), F.lit(dt.date(2024, 1, 1)).alias("day"), F.col("id").alias("seq"),
        *[F.col("id").alias(f"x{i}") for i in range(8)])
    for batch in (None, 21):
        moved, combined = _exchanges(collapse(rows, spec, {}, "double", batch=batch))
        assert moved >= 1 and combined >= 1
    assert _exchanges(collapse(rows.drop("x6", "x7"), spec, {}, "double"))[0] == 0


def test_gathered_rows_keep_every_number(spark):
    """Numbers of any size and sign, missing ones and other types come through the shuffle as they are."""
    from dossier.operators.collapse import _gathered
    odd = [0, 1, -1, 127, -128, 255, 256, 32767, -32768, 65535, 65536, 2**31 - 1, -2**31, 2**32, 2**47, -2**47,
           2**63 - 1, -2**63, None]
    rows = spark.createDataFrame(
        [(i % 5 if i else None, i, n, odd[-i], float(i), f"t{i}", i) for i, n in enumerate(odd)],
        "id long, key long, n0 long, n1 long, n2 double, n3 string, n4 int")
    for cut in (True, False):
        for some in (rows, rows.select("id", "key", "n2")):
            back = _gathered(some, cut)
            assert back.dtypes == some.dtypes
            assert sorted(map(repr, back.collect())) == sorted(map(repr, some.collect()))


def test_unsequenced_wide_collapse_writes_rows_of_an_id_side_by_side(spark, folder):
    """Every id lies in one file of the keyed rows, so a batch shuffles one partial row an id."""
    spec = EntitySpec(id_col="id", date_col="day", cat_cols=())
    spark.range(3000).repartition(6).select(
        (F.col("id") % 100).alias("id"), F.lit(dt.date(2024, 1, 1)).alias("day"),
        *[(F.col("id") * (i + 3) % 101).alias(f"x{i}") for i in range(20)]).write.parquet(f"{folder}/spread")
    out = collapse(spark.read.parquet(f"{folder}/spread"), spec, {}, "double", batch=42)
    keyed = spark.read.parquet(*out.inputFiles()).select("id", F.input_file_name().alias("file")).groupBy("id").agg(
        F.countDistinct("file").alias("files"), F.count("*").alias("n")).collect()
    assert {(r.files, r.n) for r in keyed} == {(1, 30)} and len(keyed) == 100
