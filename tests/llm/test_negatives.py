"""Hard negatives against all pairs."""

import math
import random

import numpy as np
import pytest
from compare import difference, duck
from pyspark.sql import functions as F

from dossier.llm import negatives

SCHEMA = "vec_id long, embedding array<float>, label int"


def plain(rows, positives=5, count=10):
    """The contract's rows by looking at every pair."""
    usable = []
    for vec_id, v, label in rows:
        if vec_id is None or v is None or label is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        usable.append((vec_id, (label + 1) % 10 if vec_id % 7 == 0 else label, [math.floor(256 * float(x)) for x in v]))
    out = []
    for i, (anchor, label, u) in enumerate(usable):
        if anchor % 100:
            continue
        scored = sorted((-sum(a * b for a, b in zip(u, v)), vec_id, j, own == label)
                        for j, (vec_id, own, v) in enumerate(usable) if j != i)
        for p, positive, _, _ in [s for s in scored if s[3]][:positives]:
            band = [s for s in scored if not s[3] and 30 * -p <= 100 * -s[0] <= 90 * -p][:count]
            out += [(anchor, positive, rank, s[1], -p, -s[0]) for rank, s in enumerate(band, 1)]
    return sorted(out)


def mined(df):
    return sorted(tuple(r) for r in df.select(
        "anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score").collect())


def random_rows(n, dim, seed, spread=0.3, copies=0):
    """Clustered vectors, a part of them copies of one vector."""
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(10, dim))
    labels = rng.integers(0, 10, n)
    v = (centres[labels] + spread * rng.normal(size=(n, dim))).astype(np.float32)
    v[rng.permutation(n)[:copies]] = v[0]
    return [(i, [float(x) for x in v[i]], int(labels[i])) for i in range(n)]


@pytest.mark.parametrize("n, dim, spread, copies", [(900, 8, 0.3, 0), (900, 3, 1.5, 300), (400, 16, 4.0, 40)])
def test_against_all_pairs(spark, n, dim, spread, copies):
    rows = random_rows(n, dim, n + dim, spread, copies)
    assert mined(negatives.hard_negatives(spark.createDataFrame(rows, SCHEMA))) == plain(rows)


def test_slices_clusters_and_samples_change_nothing(spark):
    rows = random_rows(700, 6, 3, 0.8, 60)
    table = negatives.usable(
        spark.createDataFrame(rows, SCHEMA), F.col("vec_id") % 7 == 0, F.pmod(F.col("label") + 1, F.lit(10)))
    for clusters, sample, slice_rows in ((1, 1, 50), (4, 3, 10_000), (32, 4096, 30)):
        got = negatives.mine(table, F.col("vec_id") % 100 == 0, clusters=clusters, sample=sample, slice_rows=slice_rows)
        assert mined(got) == plain(rows)


def test_odd_rows(spark):
    rng = random.Random(5)
    rows = [(i, [rng.choice([0.0, 0.5, 1.0]) for _ in range(3)], i % 3) for i in range(0, 320, 4)]
    rows += [(None, [1.0, 1.0, 1.0], 1), (100, [1.0, 1.0, 1.0], None), (200, None, 1), (300, [1.0, None, 0.0], 1),
             (400, [float("nan"), 0.0, 1.0], 1), (500, [float("inf"), 0.0, 1.0], 1), (600, [], 0), (700, [1.0], 1),
             (800, [0.0, 0.0, 0.0], 2), (900, [-1.0, -1.0, -1.0], 0), (-100, [1.0, 0.5, 0.5], 0),
             *[(100, [1.0, 1.0, 0.0], 1)] * 3, *[(5, [1.0, 1.0, 0.5], 2)] * 3]
    table = spark.createDataFrame(rows, SCHEMA)
    want = plain(rows)
    assert want and mined(negatives.hard_negatives(table)) == want
    odd = table.select("*", *[F.lit(1).alias(c) for c in ("id", "v", "cluster", "slice", "score", "anchor", "near")])
    assert mined(negatives.hard_negatives(odd)) == want
    assert negatives.hard_negatives(table.limit(0)).count() == 0


def test_large_components(spark):
    rows = [(i, [float(2 ** 22 + 7 * i), float(i)], i % 2) for i in range(0, 900, 10)]
    rows = [(i, [float(np.float32(x)) for x in v], label) for i, v, label in rows]
    low = [(1000 + i, [float(2 ** 21), float(i)], i % 2) for i in range(1, 95)]
    assert mined(negatives.hard_negatives(spark.createDataFrame(rows + low, SCHEMA))) == plain(rows + low)


def test_walk_stops_before_the_end_of_the_list():
    rows = random_rows(40_000, 8, 1, 0.2)
    vectors = np.floor(256 * np.array([r[1] for r in rows]))
    ids = np.arange(len(rows))
    units, _ = negatives._unit(vectors)
    centre = negatives._unit(vectors[:1])[0]
    own = negatives.Slice(ids, ids, np.array([r[2] for r in rows]), vectors, centre, np.array([0.0]))
    own.shared_list(0)
    looked = []
    scores, own.scores = own.scores, lambda low, high, a: looked.append(high) or scores(low, high, a)
    own.walk(0, rows[0][2], vectors[0], [(-math.inf, math.inf)], True, 5)
    assert looked[-1] < len(rows) / 10


def test_query_against_sql(spark, sf):
    table = spark.read.parquet(f"{sf}/embeddings.parquet")
    assert difference(negatives.hard_negatives(table), negatives.ORACLE, duck(sf)) is None
