"""Hard-negative mining over anchor-clustered shared lists.

Anchors are grouped around centroids (spherical k-means on a bounded sample of ``SAMPLE`` anchors; every anchor is
then assigned). For a cluster whose members lie within an angle ``theta`` of their centroid c, no member u scores a
row x above ``|u| * |x| * cos(max(0, angle(x, c) - theta))``. A cluster sorts its candidates by this bound once; every
member walks that one list from the top and stops as soon as what it still needs is certain to lie before: for
positives when the bound falls below its k-th best row of its label, for the negatives of a positive when it falls
below the k-th best row of the band or below the band's foot. Nothing is approximate: bounds are widened by more than
the rounding of doubles, and equal scores are walked to their end. A score beyond 64 bits is the nearest long.

The mined rows: an anchor's positives are its ``POSITIVES`` highest-scoring other rows of its label; for each of them
the ``NEGATIVES`` highest-scoring rows of other labels whose score is between ``LOW`` and ``HIGH`` hundredths of the
positive's. A score is the integer inner product of components ``floor(SCALE * x)``; equal scores go by vec_id.

On Spark the candidates are dealt to slices by a hash of their row, so a task holds about ``SLICE`` of them whatever
their labels or vectors; anchors, a stated query set, visit every slice in order of their cluster. A slice's best
rows per anchor meet in a window whose limit is applied before its shuffle. Positives come first, for all slices;
their scores are the bands of the second visit. Nothing grows on the driver: centroids and angles are bounded.

Rows without a label, a vector, a vec_id, or with a null or non-finite component take no part. Shorter vectors are
filled up with zeros. Repeated rows are rows of their own: each is a candidate, each anchor among them is mined.
An anchor without positives, or a positive without negatives, gives no row. Extra columns are ignored; an empty table
gives an empty result.
"""

from __future__ import annotations

import math
from heapq import nsmallest
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from dossier.llm.common import written

SCALE = 256
POSITIVES, NEGATIVES = 5, 10
LOW, HIGH = 30, 90
#: Anchors that the centroids are fitted on, centroids, and rounds of the fit.
SAMPLE, CLUSTERS, ROUNDS = 4096, 32, 8
#: Candidates that a task holds at a time, and the fewest that are worth a slice of their own.
SLICE, LEAST_SLICE = 65_536, 1024
#: Places of the list looked at before the stopping rule is asked again.
STEP = 1024

ORACLE = """
WITH clean AS (
  SELECT vec_id, label,
         list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS DOUBLE)) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
r AS (
  SELECT row_number() OVER () AS id, vec_id, v,
         CASE WHEN vec_id % 7 = 0 THEN ((label + 1) % 10 + 10) % 10 ELSE label END AS label FROM clean),
scored AS (
  SELECT a.id AS aid, a.vec_id AS anchor_id, c.id, c.vec_id, a.label = c.label AS same,
         CAST(list_inner_product(a.v, c.v) AS BIGINT) AS score
  FROM r a JOIN r c ON a.id <> c.id WHERE a.vec_id % 100 = 0),
positives AS (
  SELECT * FROM scored WHERE same
  QUALIFY row_number() OVER (PARTITION BY aid ORDER BY score DESC, vec_id, id) <= 5),
ranked AS (
  SELECT p.anchor_id, p.vec_id AS positive_id, n.vec_id AS negative_id,
         p.score AS positive_score, n.score AS negative_score,
         row_number() OVER (PARTITION BY p.aid, p.id ORDER BY n.score DESC, n.vec_id, n.id) AS place
  FROM positives p JOIN scored n ON n.aid = p.aid AND NOT n.same
   AND 100 * n.score BETWEEN 30 * p.score AND 90 * p.score)
SELECT anchor_id, positive_id, CAST(place AS INTEGER) AS "rank", negative_id, positive_score, negative_score
FROM ranked WHERE place <= 10
"""


def usable(rows: DataFrame, moved: Column, label: Column, scale: int = SCALE) -> DataFrame:
    """vec_id, label (``label`` where ``moved``) and integer components of the rows that take part."""
    x = F.col("embedding")
    return rows.where(
        F.col("vec_id").isNotNull() & F.col("label").isNotNull() & x.isNotNull()
        & ~F.exists(x, lambda e: e.isNull() | F.isnan(e) | (F.abs(e) == float("inf")))
    ).select(
        F.col("vec_id").cast("long").alias("vec_id"),
        F.when(moved, label).otherwise(F.col("label")).cast("long").alias("label"),
        F.transform(x, lambda e: F.floor(e.cast("double") * scale).cast("double")).alias("v"))


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    """The vectors as rows of doubles, filled up with zeros."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    sizes = np.diff(column.offsets.to_numpy())
    out = np.zeros((len(column), width))
    out[np.arange(width) < sizes[:, None]] = column.flatten().to_numpy(zero_copy_only=False)
    return out


def _unit(vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    norms = np.sqrt((vectors * vectors).sum(1))
    return vectors / np.maximum(norms, 1e-300)[:, None], norms


def _angles(units: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    return np.arccos(np.clip(units @ centroids.T, -1, 1))


def _centroids(sample: np.ndarray, clusters: int, rounds: int) -> np.ndarray:
    """Spherical k-means, started from members spread by the farthest-first rule."""
    units, _ = _unit(sample)
    if not len(units):
        return np.zeros((1, sample.shape[1]))
    chosen, nearest = [0], units @ units[0]
    while len(chosen) < min(clusters, len(units)) and nearest.min() < 1 - 1e-9:
        chosen.append(int(nearest.argmin()))
        nearest = np.maximum(nearest, units @ units[chosen[-1]])
    centroids = units[chosen]
    for _ in range(rounds):
        own = (units @ centroids.T).argmax(1)
        sums = np.zeros_like(centroids)
        np.add.at(sums, own, units)
        centroids = np.where(np.abs(sums).sum(1, keepdims=True) > 0, _unit(sums)[0], centroids)
    return centroids


def _clustered(anchors: DataFrame, width: int, centroids: np.ndarray) -> DataFrame:
    """Anchors with their cluster and the angle to its centroid."""
    shared = anchors.sparkSession.sparkContext.broadcast(centroids)

    def assign(batches):
        for batch in batches:
            angles = _angles(_unit(_matrix(batch.column(batch.schema.get_field_index("v")), width))[0], shared.value)
            own = angles.argmin(1)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(own.astype(np.int32)), pa.array(angles[np.arange(len(own)), own])],
                [*batch.schema.names, "cluster", "angle"])

    return anchors.mapInArrow(
        assign, ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in anchors.schema)
        + ", cluster int, angle double")


class Slice:
    """The candidates a task holds, and one sorted list per cluster, the last one kept."""

    def __init__(self, ids, vec_ids, labels, vectors, centroids, thetas):
        self.ids, self.vec_ids, self.labels, self.vectors = ids, vec_ids, labels, vectors
        self.units, self.norms = _unit(vectors)
        self.centroids, self.thetas, self.cluster = centroids, thetas, -1
        # Doubles hold whole numbers up to 2 ** 53; beyond that sums are made of Python's own.
        self.largest = float(np.abs(vectors).max(initial=0))

    def shared_list(self, cluster: int) -> None:
        """Sort the candidates by the angular bound of a cluster, greatest first; of equals the smaller vec_id."""
        if cluster == self.cluster:
            return
        apart = np.maximum(_angles(self.units, self.centroids[cluster:cluster + 1])[:, 0]
                           - self.thetas[cluster] - 1e-6, 0)
        bound = self.norms * np.cos(apart)
        bound += np.abs(bound) * 1e-9 + 1e-9 * (1 + self.norms)
        order = np.lexsort((self.vec_ids, -bound))
        self.cluster, self.bound = cluster, bound[order]
        self.list = [x[order] for x in (self.ids, self.vec_ids, self.labels, self.vectors)]

    def scores(self, low: int, high: int, anchor: np.ndarray) -> np.ndarray:
        vectors = self.list[3][low:high]
        if self.largest * np.abs(anchor).max(initial=0) * max(1, len(anchor)) < 2.0 ** 53:
            return vectors @ anchor
        whole = [int(a) for a in anchor]
        sums = (sum(int(x) * a for x, a in zip(row, whole)) for row in vectors)
        return np.array([max(-2 ** 63, min(2 ** 63 - 1, s)) for s in sums], object)

    def walk(self, row: int, label: int, anchor: np.ndarray, bands, same: bool, k: int):
        """The k best (score, vec_id, id) of every band (foot, top), by one walk down the cluster's list."""
        ids, vec_ids, labels, _ = self.list
        norm = math.sqrt(float(anchor @ anchor))
        best: list[list[tuple]] = [[] for _ in bands]
        least = [foot if foot <= top else math.inf for foot, top in bands]  # what a row must score to be of use
        at, step, n = 0, STEP, len(ids)
        while at < n:
            most = self.bound[at] * norm  # no row from here on scores more
            if all(most < x for x in least):
                break
            end = min(n, at + step)
            scores = self.scores(at, end, anchor)
            other = ((labels[at:end] == label) == same) & (ids[at:end] != row)
            for b, (foot, top) in enumerate(bands):
                if most < least[b]:
                    continue
                use = np.flatnonzero(other & (scores >= least[b]) & (scores <= top))
                if len(use) > 4 * k:  # the k-th best score of these; its equals stay
                    got = scores[use]
                    use = use[got >= np.partition(got, len(got) - k)[len(got) - k]]
                if len(use):
                    rows = zip(scores[use].tolist(), vec_ids[at:end][use].tolist(), ids[at:end][use].tolist())
                    best[b] = nsmallest(k, chain(best[b], rows), key=lambda r: (-r[0], r[1], r[2]))
                    if len(best[b]) == k:
                        least[b] = best[b][-1][0]
            at, step = end, step * 2
        return best


def _bands(scores: list[int], low: int, high: int) -> list[tuple[int, int]]:
    """The whole scores s with low * p <= 100 * s <= high * p of each positive score p."""
    return [(-(-low * p // 100), high * p // 100) for p in scores]


def _visit(candidates: DataFrame, queries: DataFrame, slices: int, width: int, centroids, thetas,
           low: int, high: int, k: int) -> DataFrame:
    """The best candidates of each slice: anchor row, band (its place) and the found id, vec_id and score.

    With ``positive_scores`` in ``queries`` the rows of other labels in each score's band, else those of the label.
    A partition holds candidates of a slice first, then the anchors by cluster, so a task keeps one slice and one list.
    """
    shared = candidates.sparkSession.sparkContext.broadcast((centroids, thetas))
    bands = "positive_scores" in queries.columns
    none = F.lit(None).cast("array<long>")
    columns = ["id", "vec_id", "label", "v"]
    held = candidates.select(
        F.pmod(F.xxhash64("id"), F.lit(slices)).cast("int").alias("slice"), F.lit(-1).alias("cluster"),
        *columns, none.alias("positive_scores"))
    asked = queries.select(
        F.explode(F.sequence(F.lit(0), F.lit(slices - 1))).alias("slice"), "cluster", *columns,
        F.col("positive_scores") if bands else none.alias("positive_scores"))
    dealt = held.unionByName(asked).repartition(slices, "slice").sortWithinPartitions("slice", "cluster")

    def search(batches):
        held: list[pa.RecordBatch] = []
        current, own = None, None
        for batch in batches:
            slice_of, cluster_of = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            cuts = [0, *(np.flatnonzero((np.diff(slice_of) != 0) | (np.diff(cluster_of) != 0)) + 1), len(slice_of)]
            for start, end in zip(cuts[:-1], cuts[1:]):
                if start == end:
                    continue
                part = batch.slice(start, end - start)
                if slice_of[start] != current:
                    current, own, held = slice_of[start], None, []
                if cluster_of[start] < 0:
                    held.append(part)
                    continue
                if not held and own is None:
                    continue
                if own is None:
                    table = pa.Table.from_batches(held)
                    own, held = Slice(
                        *(table.column(c).to_numpy() for c in ("id", "vec_id", "label")),
                        _matrix(table.column("v"), width), *shared.value), []
                own.shared_list(int(cluster_of[start]))
                found = []
                for row, label, anchor, scores in zip(
                        part.column(2).to_pylist(), part.column(4).to_pylist(), _matrix(part.column(5), width),
                        part.column(6).to_pylist()):
                    spans = _bands(scores, low, high) if bands else [(-math.inf, math.inf)]
                    for b, best in enumerate(own.walk(row, label, anchor, spans, not bands, k)):
                        found += [(row, b, i, v, int(s)) for s, v, i in best]
                if found:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(c, t) for c, t in zip(zip(*found), (
                            pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()))],
                        ["anchor", "band", "found", "found_id", "score"])

    found = dealt.mapInArrow(search, "anchor long, band int, found long, found_id long, score long")
    order = Window.partitionBy("anchor", "band").orderBy(F.desc("score"), "found_id", "found")
    return found.withColumn("place", F.row_number().over(order)).where(F.col("place") <= k)


def mine(rows: DataFrame, is_anchor: Column, positives: int = POSITIVES, negatives: int = NEGATIVES,
         low: int = LOW, high: int = HIGH, clusters: int = CLUSTERS, sample: int = SAMPLE,
         slice_rows: int = SLICE) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id and both scores, from vec_id, label and ``v`` of ``usable`` rows."""
    spark = rows.sparkSession
    table = written(rows.select(F.monotonically_increasing_id().alias("id"), "vec_id", "label", "v"), "vectors")
    n, width = table.agg(F.count("*"), F.coalesce(F.max(F.size("v")), F.lit(0))).first()
    anchors = table.where(is_anchor)
    # A bounded, documented sample: as many anchors as the fit takes, spread by a hash of their row.
    fitted = anchors.orderBy(F.xxhash64("id"), "id").limit(sample).select("v").toPandas()["v"]
    vectors = np.zeros((len(fitted), width))
    for i, v in enumerate(fitted):
        vectors[i, :len(v)] = v
    centroids = _centroids(vectors, clusters, ROUNDS)
    named = written(_clustered(anchors, width, centroids), "anchors")
    thetas = np.zeros(len(centroids))
    for row in named.groupBy("cluster").agg(F.max("angle").alias("angle")).collect():
        thetas[row["cluster"]] = row["angle"]
    slices = max(1, -(-n // slice_rows), min(
        -(-n // LEAST_SLICE), int(spark.conf.get("spark.sql.shuffle.partitions"))))
    visit = (slices, width, centroids, thetas, low, high)
    near = written(_visit(table, named, *visit, positives), "positives")
    bands = near.groupBy("anchor").agg(F.array_sort(F.collect_list(
        F.struct("place", F.col("found_id").alias("positive_id"), "score"))).alias("near"))
    asked = written(named.join(bands, named["id"] == bands["anchor"]).select(
        *named.columns, "near", F.col("near.score").alias("positive_scores")), "bands")
    far = _visit(table, asked, *visit, negatives)
    positive = F.get("near", F.col("band"))
    return far.join(
        asked.select("id", F.col("vec_id").alias("anchor_id"), "near"), F.col("anchor") == F.col("id")).select(
        "anchor_id", positive["positive_id"].alias("positive_id"), F.col("place").cast("int").alias("rank"),
        F.col("found_id").alias("negative_id"), positive["score"].alias("positive_score"),
        F.col("score").alias("negative_score"))


def hard_negatives(embeddings: DataFrame) -> DataFrame:
    """Mined rows of a table whose labels are wrong by one in every seventh row; every hundredth is an anchor."""
    moved = usable(embeddings, F.col("vec_id") % 7 == 0, F.pmod(F.col("label").cast("long") + 1, F.lit(10)))
    return mine(moved, F.col("vec_id") % 100 == 0)
