"""Prefix sums, the metric, splits and audits against brute force."""

import hashlib
import math
import random

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from dossier import EntitySpec
from dossier.operators import audits, splits
from dossier.operators.metric import gain_curve, metric_totals, ranking_metric
from dossier.operators.prefix import prefix_sum
from dossier.operators.selection import best_iteration

SPEC = EntitySpec(id_col="id", target_col="target", cat_cols=())


def md5(value):
    return hashlib.md5(str(value).encode()).hexdigest()


def scores(n, seed, tied=1 / 3, missing=0.0):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        p = 0.5 if rng.random() < tied else round(rng.random(), 3)
        if rng.random() < missing:
            p = None
        rows.append((i, rng.choice("ab"), int(rng.random() < 0.3 + 0.3 * (p or 0)), p))
    return rows


def in_order(rows):
    return sorted(rows, key=lambda r: (r[3] is None, -(r[3] or 0), md5(r[0])))


def brute_metric(rows):
    """The metric straight from its definition, in Python floats."""
    weight = lambda t: 20 if t == 0 else 1                     # noqa: E731
    targets = [r[2] for r in in_order(rows)]
    total, positive = sum(map(weight, targets)), sum(targets)

    def area(ordered):
        cum_w = cum_p = out = 0
        for t in ordered:
            cum_w += weight(t)
            cum_p += t
            out += (cum_p / positive - cum_w / total) * weight(t)
        return out

    gini = area(targets) / area(sorted(targets, reverse=True))
    cutoff, cum_w, found = int(0.04 * total), 0, 0
    for t in targets:
        cum_w += weight(t)
        found += t if cum_w <= cutoff else 0
    top = found / positive
    return {"score": 0.5 * (gini + top), "gini": gini, "top4": top, "auc": (gini + 1) / 2}


@pytest.fixture(scope="module")
def frame(spark):
    def make(rows):
        return spark.createDataFrame(rows, "id long, grp string, target int, prediction double")
    return make


@pytest.mark.parametrize("n,seed,tied,missing,ranges", [
    (400, 1, 1 / 3, 0.0, 16), (400, 2, 0.95, 0.0, 4), (300, 3, 0.0, 0.3, 8), (50, 4, 1.0, 0.0, 8)])
def test_running_sums(frame, n, seed, tied, missing, ranges):
    rows = scores(n, seed, tied, missing)
    df = frame(rows).withColumn("v", F.col("id") + 1)
    got = {r.id: (r.s, r.s_total) for r in prefix_sum(
        df, "prediction", "id", {"v": "s"}, ["grp"], ranges=ranges).collect()}
    want = {}
    for g in "ab":
        running, mine = 0, [r for r in in_order(rows) if r[1] == g]
        for r in mine:
            running += r[0] + 1
            want[r[0]] = (running, sum(m[0] + 1 for m in mine))
    assert got == want


@pytest.mark.parametrize("seed", range(3))
def test_metric_is_its_definition(frame, seed):
    rows = scores(500, seed)
    got = ranking_metric(frame(rows), "id", ranges=8).first()
    for name, value in brute_metric(rows).items():
        assert math.isclose(got[name], value, abs_tol=1e-12)
    curve = gain_curve(frame(rows), "id", ranges=8)
    assert curve.agg(F.max("lorentz"), F.max("random")).first() == (1.0, 1.0)


def test_metric_by_group(frame):
    rows = scores(500, 9)
    got = {r.grp: r for r in ranking_metric(frame(rows), "id", groups=["grp"]).collect()}
    for g in "ab":
        want = brute_metric([r for r in rows if r[1] == g])
        assert math.isclose(got[g].score, want["score"], abs_tol=1e-12)


def test_perfect_and_reversed_rankings(frame):
    perfect = [(i, "a", int(i < 30), 100.0 - i) for i in range(100)]
    assert math.isclose(ranking_metric(frame(perfect), "id").first().gini, 1.0)
    worst = [(i, g, t, -p) for i, g, t, p in perfect]
    got = ranking_metric(frame(worst), "id").first()
    assert math.isclose(got.gini, brute_metric(worst)["gini"]) and got.gini < 0


@pytest.mark.parametrize("targets,top4", [([0] * 5, None), ([1] * 5, 0.0), ([1] * 50, 0.04), ([], None)])
def test_metric_without_both_classes(frame, targets, top4):
    """Without negatives the gini is 0/0, but the captured share is still a share."""
    rows = [(i, "a", t, float(i)) for i, t in enumerate(targets)]
    got = ranking_metric(frame(rows), "id").first()
    assert (got.score, got.gini, got.top4, got.auc) == (None, None, top4, None)
    assert got.n_rows == len(targets)


def label_rows(spark, classes):
    rows = [(f"{t}-{i}", t) for t, n in classes.items() for i in range(n)]
    return spark.createDataFrame(rows, "id string, target int")


@pytest.mark.parametrize("classes", [{0: 700, 1: 90}, {0: 10, 1: 1, 2: 3}, {5: 1}])
def test_split_counts_are_exact_in_every_class(spark, classes):
    labels = label_rows(spark, classes)
    got = splits.assign_splits(labels, SPEC).collect()
    assert len(got) == sum(classes.values()) == len({r.id for r in got})
    for t, n in classes.items():
        count = lambda s: sum(r.target == t and r.split == s for r in got)
        assert count("train") == n * 7 // 10
        assert count("validation") == n * 9 // 10 - n * 7 // 10
    ranked = splits.assign_splits_ranked(labels, SPEC).collect()
    assert sorted(got) == sorted(ranked)


def test_many_classes_take_the_ranked_way(spark, monkeypatch):
    labels = label_rows(spark, {t: 5 for t in range(20)})
    usual = sorted(splits.assign_splits(labels, SPEC).collect())
    monkeypatch.setattr(splits, "MAX_STRATA", 3)
    assert splits.fit_split(labels, SPEC) is None
    assert sorted(splits.assign_splits(labels, SPEC).collect()) == usual


def test_seed_changes_the_split(spark):
    from dataclasses import replace
    labels = label_rows(spark, {0: 200})
    a = sorted(splits.assign_splits(labels, SPEC).collect())
    b = sorted(splits.assign_splits(labels, replace(SPEC, seed=7)).collect())
    assert a != b


@pytest.mark.parametrize("limit", [None, 0])
@pytest.mark.parametrize("classes", [{0: 300, 1: 40}, {0: 30, 1: 1}, {0: 0}])
def test_routing_by_hash_is_routing_by_join(spark, classes, limit):
    labels = label_rows(spark, classes)
    plan = splits.fit_split(labels, SPEC)
    ids = [r.id for r in labels.collect()] + [f"stranger-{i}" for i in range(60)] + [None]
    statements = spark.createDataFrame([(i, k) for i in ids for k in range(3)], "id string, k int")
    options = {} if limit is None else {"broadcast_bytes": limit}
    got = splits.route_by_plan(statements, labels, plan, **options).collect()
    split = {r.id: r.split for r in splits.assign_splits(labels, SPEC).collect()}
    assert len(got) == 3 * len(ids)
    assert all(r.split == split.get(r.id, "train") for r in got)


def test_routing_by_hash_moves_no_statements(spark):
    labels = label_rows(spark, {0: 300, 1: 40})
    statements = labels.select("id", F.lit(1).alias("k"))
    out = splits.route_by_plan(statements, labels, splits.fit_split(labels, SPEC))
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Exchange hashpartitioning" not in plan and "BroadcastHashJoin" in plan


def test_overlap_and_coverage(spark):
    rows = spark.createDataFrame(
        [("a", "train"), ("a", "test"), ("b", "train"), ("c", "validation"), ("c", "validation")],
        "id string, split string")
    got = {(r.split_a, r.split_b): r.n_shared for r in splits.split_overlap(rows, SPEC).collect()}
    assert got == {("train", "validation"): 0, ("train", "test"): 1, ("validation", "test"): 0}
    seen = splits.label_coverage(rows.distinct(), rows.where("id <> 'b'"), SPEC)
    assert {r.split: r.n_never_seen for r in seen.collect()} == {
        "train": 1, "validation": 0, "test": 0}


def test_order_audits(spark):
    rng = random.Random(3)
    rows, ids = [], [rng.choice("aaab") for _ in range(120)]
    for seq, i in enumerate(ids):
        rows.append((i, seq, rng.randrange(50)))
    df = spark.createDataFrame(rows, "id string, seq long, date int").repartition(5)
    blocks = 1 + sum(a != b for a, b in zip(ids, ids[1:]))
    got = audits.contiguity_audit(df, "id", "seq", ranges=6).first()
    assert (got.n_blocks, got.n_entities, got.contiguous) == (blocks, 2, False)
    back = {i: sum(a > b for a, b in zip(d, d[1:]))
            for i in "ab" for d in [[r[2] for r in rows if r[0] == i]]}
    for literal in (0, 1000):
        out = audits.order_audit(df, "id", "date", "seq", ranges=6, literal=literal).collect()
        assert {r.id: r.n_backward for r in out} == {i: n for i, n in back.items() if n}
    sorted_rows = df.where("id = 'a'")
    assert audits.contiguity_audit(sorted_rows, "id", "seq").first().contiguous


@pytest.mark.parametrize("descending", [True, False])
def test_ranges_of_the_partitioner_give_the_same_sums(spark, descending):
    rng = random.Random(4)
    rows = [(i, rng.choice("ab"), rng.choice([None, float("nan"), 1.0, 1.0, 1.0, rng.random() * 3]), i) for i in range(900)]
    df = spark.createDataFrame(rows, "id int, g string, x double, v long")
    sums = [sorted(map(str, prefix_sum(df, "x", "id", {"v": "s"}, ["g"], descending, 12, literal).collect()))
            for literal in (0, 1000)]
    assert sums[0] == sums[1]
    few, many = (prefix_sum(df, "x", "id", {"v": "s"}, ranges=n, literal=0)._jdf.queryExecution().optimizedPlan()
                 .toString() for n in (8, 300))
    assert len(many) < len(few) + 100


def test_contiguity_with_one_heavy_place(spark):
    rows = [(f"e{i % 9}", None if i % 4 == 0 else 5 if i % 4 < 3 else i) for i in range(400)] + [(None, 5), (None, 6)]
    df = spark.createDataFrame(rows, "id string, seq long")
    last = float("inf")
    tie = lambda r: hashlib.md5(r[0].encode()).hexdigest() if r[0] else ""
    order = sorted(set(rows), key=lambda r: (last if r[1] is None else r[1], tie(r)))
    blocks = sum(i == 0 or order[i][0] != order[i - 1][0] for i in range(len(order)))
    for ranges, literal in ((2, 1000), (30, 1000), (30, 0)):
        got = audits.contiguity_audit(df, "id", "seq", ranges=ranges, literal=literal).first()
        assert (got.n_blocks, got.n_entities, got.contiguous) == (blocks, 9, False)


def test_contiguity_of_files(spark, tmp_path):
    ids = [None if i // 7 % 5 == 0 else f"e{i // 7 % 5}" for i in range(500)]
    df = spark.createDataFrame([(i, x) for i, x in enumerate(ids)], "n long, id string")
    df.repartitionByRange(3, "n").sortWithinPartitions("n").write.parquet(f"{tmp_path}/t")
    blocks = sum(i == 0 or ids[i] != ids[i - 1] for i in range(500))
    for part_rows in (10, 64, 1000):
        got = audits.file_contiguity_audit(spark.read.parquet(f"{tmp_path}/t"), "id", part_rows).first()
        assert (got.n_blocks, got.n_entities) == (blocks, 4)
    empty = spark.read.parquet(f"{tmp_path}/t").where("n < 0")
    assert audits.file_contiguity_audit(empty, "id").first().n_blocks == 0
    once = spark.read.parquet(f"{tmp_path}/t").where("n >= 7 and n < 35")
    assert audits.file_contiguity_audit(once, "id").first().contiguous


def test_overflow_audit(spark):
    inf, nan = float("inf"), float("nan")
    df = spark.createDataFrame([(1.0, -70000.0, inf, nan, None), (2.0, 0.0, 1.0, 65504.0, None)],
                               "a double, b double, c double, d double, e double")
    got = {r.col: r.peak for r in audits.overflow_audit(df).collect()}
    assert got == {"b": 70000.0, "c": inf}


def test_feature_alignment(spark):
    df = spark.createDataFrame([("a", 1.0, 2.0, 3.0)], "id string, x double, y double, extra double")
    assert audits.align_features(df, "id", ["y", "x"]).columns == ["id", "y", "x"]
    with pytest.raises(KeyError, match="z"):
        audits.align_features(df, "id", ["x", "z"])
    with pytest.raises(ValueError, match="line up"):
        audits.require_same_columns(df, df.select("id", "y", "x", "extra"))


def early_stop(points, patience):
    best, best_at = None, None
    for at, value in points:
        if value is not None and (best is None or value > best):
            best, best_at = value, at
        if best_at is not None and at - best_at >= patience:
            return best_at, best, at
    return best_at, best, points[-1][0]


def test_best_iteration(spark):
    rng = random.Random(5)
    runs = {k: [(i, rng.choice([None, *(x / 10 for x in range(10))])) for i in range(1, 40)]
            for k in "abcd"}
    df = spark.createDataFrame([(k, i, s) for k, p in runs.items() for i, s in p],
                               "run string, iteration int, score double")
    got = {r.run: (r.best_iteration, r.best_score, r.rounds_run)
           for r in best_iteration(df, runs=["run"], patience=7).collect()}
    assert got == {k: early_stop(p, 7) for k, p in runs.items()}


def test_running_sums_of_whole_numbers_past_double_precision(spark):
    rows = [(i, 2**60 + i, 1) for i in range(200)]
    df = spark.createDataFrame(rows, "id long, big long, one long").repartition(5)
    got = prefix_sum(df, "big", "id", {"one": "rank"}, descending=False, ranges=16)
    assert {r.id: r["rank"] for r in got.collect()} == {i: i + 1 for i in range(200)}


@pytest.mark.parametrize("odd", [None, 2, -1])
def test_a_target_that_is_not_binary_fails(spark, odd):
    df = spark.createDataFrame([(1, 1, 0.5), (2, 0, 0.1), (3, odd, 0.3)], "id long, target int, prediction double")
    for run in (ranking_metric, metric_totals):
        with pytest.raises(PySparkException, match="must be 0 or 1"):
            run(df).collect()
