"""Quality rules: statistics of rules, an isolation forest over them, a threshold from labelled rows.

Words are ``[^\\x20\\x09-\\x0D]+`` of the whole text (null: none). The rules count words, code points in words,
characters of ``#*$%&|<>``, lines with a word that are equal to an earlier line, and words in 5-word windows
found twice or more. The forests see shares of these, not sizes, so that long documents are no
anomaly by length alone. Each family of rules (``FAMILIES``) has a forest: ``TREES`` trees each split ``PER_TREE`` rows,
drawn from a sample of about ``SAMPLE`` rows (twice that at most) chosen by a hash of the row, at random features
and values; short mean paths are anomalies and a score is 2^(-path / expected path). A family's threshold is the
score with the best share of bad rows at or above it, less ``GOOD_WEIGHT`` times the share of good rows (one more counted), over all
labelled rows that the families before it leave; a family that the labels do not bear out has none. Without labels of both kinds only the base
rules decide.

A document is kept if the base rules pass (10 words or more, at most 20 % of words in repeated windows)
and no family's score reaches its threshold. Null and empty texts fail by the word count. Repeated ids are rows
like any other (an id labelled twice counts as bad if one label says so); extra columns are ignored;
an empty table gives an empty result.
"""

from __future__ import annotations

from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from dossier.llm.common import slices, written

SYMBOLS = "#*$%&|<>"  # fixed value
_MARKS = frozenset(SYMBOLS)
LEAST_WORDS = 10
MOST_REPEATED = 20
WINDOW = 5

SAMPLE = 16_384
TREES = 128
PER_TREE = 256
GOOD_WEIGHT = 20
#: Features of each family, in the order of ``_features``.
FAMILIES = {
    "symbols": ("symbol_share", "symbol_word_share"),
    "repeats": ("dup_line_share", "repeat_share", "twin_share"),
    "shape": ("mean_word", "upper_share", "digit_share"),
}
_BINS = 2000


def rule_counts(text: str) -> tuple[int, int, int, int, int]:
    """n_words, word_chars, n_symbols, n_dup_lines and n_repeat_words of one text."""
    data = text.encode("utf-8", "surrogatepass")
    words = data.split()
    blanks = sum(map(text.count, " \t\n\v\f\r"))
    lines = [x for x in data.split(b"\n") if x.strip()]
    repeated = 0
    if len(words) > WINDOW:
        windows = list(zip(*(words[i:] for i in range(WINDOW))))
        if len(seen := set(windows)) < len(windows):
            once, twice = set(), set()
            for w in windows:
                (twice if w in once else once).add(w)
            del seen
            reach = 0
            for i, w in enumerate(windows):
                if w in twice:
                    repeated += i + WINDOW - max(reach, i)
                    reach = i + WINDOW
    return (len(words), len(text) - blanks, sum(map(text.count, SYMBOLS)), len(lines) - len(set(lines)), repeated)


def _features(text: str, counts: tuple[int, ...]) -> list[float]:
    n_words, chars, symbols, dup_lines, repeated = counts
    words, n, letters = text.split(), max(n_words, 1), max(chars, 1)
    marked = sum(1 for w in words if not _MARKS.isdisjoint(w)) if symbols else 0
    return [symbols / letters, marked / n,
            dup_lines / (text.count("\n") + 1), repeated / n, sum(map(eq, words, words[1:])) / n,
            chars / n, sum(map(str.isupper, words)) / n, sum(map(text.count, "0123456789")) / letters]


def rule_table(docs: DataFrame) -> DataFrame:
    """doc_id, the five counts and the features of every row."""
    id_type = docs.schema["doc_id"].dataType.simpleString()

    def scan(batches):
        for part in slices(batches):
            texts = [t or "" for t in part.column(1).to_pylist()]
            counts = [rule_counts(t) for t in texts]
            features = [_features(t, c) for t, c in zip(texts, counts)]
            yield pa.RecordBatch.from_arrays(
                [part.column(0), *(pa.array([c[i] for c in counts], pa.int64()) for i in range(5)),
                 pa.array(features, pa.list_(pa.float64()))],
                ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "features"])

    return docs.select("doc_id", "text").mapInArrow(
        scan, f"doc_id {id_type}, n_words long, word_chars long, n_symbols long, n_dup_lines long, "
              "n_repeat_words long, features array<double>")


def _expected(n):
    """Mean path of an unsuccessful search among n rows of a random tree."""
    n = np.maximum(np.asarray(n, float), 1)
    return np.where(n > 2, 2 * (np.log(np.maximum(n - 1, 1)) + 0.5772156649) - 2 * (n - 1) / n, n == 2)


def grow(rows: np.ndarray, rng: np.random.Generator, depth: int) -> list[np.ndarray]:
    """A tree as arrays: feature (-1: leaf), cut, left child (right: the next one), path at leaf."""
    nodes: list[list[float]] = [[-1, 0, 0, 0]]
    work = [(0, np.arange(len(rows)), 0)]
    while work:
        at, mine, level = work.pop()
        own = rows[mine]
        spread = np.flatnonzero(np.ptp(own, axis=0) > 0) if len(mine) else []
        if level >= depth or not len(spread):
            nodes[at][3] = level + float(_expected(len(mine))) * (len(mine) > 1)
            continue
        feature = int(rng.choice(spread))
        cut = float(rng.uniform(own[:, feature].min(), own[:, feature].max()))
        below = own[:, feature] <= cut
        left = len(nodes)
        nodes[at][:3] = [feature, cut, left]
        nodes += [[-1, 0, 0, 0], [-1, 0, 0, 0]]
        work += [(left, mine[below], level + 1), (left + 1, mine[~below], level + 1)]
    return [np.array(x) for x in zip(*nodes)]


def fit_forest(sample: np.ndarray, trees: int = TREES, per_tree: int = PER_TREE, seed: int = 7):
    """The trees and the number of rows each was grown on; the sample is bounded by ``SAMPLE``."""
    rng, size = np.random.default_rng(seed), min(per_tree, len(sample))
    depth = int(np.ceil(np.log2(max(size, 2))))
    return [grow(sample[rng.choice(len(sample), size, replace=False)], rng, depth) for _ in range(trees)], size


def anomaly(rows: np.ndarray, forest) -> np.ndarray:
    """2^(-mean path / expected path) of each row."""
    trees, size = forest
    total = np.zeros(len(rows))
    for feature, cut, left, path in trees:
        at, going = np.zeros(len(rows), np.int64), np.arange(len(rows))
        feature, left = feature.astype(np.int64), left.astype(np.int64)
        while len(going := going[feature[at[going]] >= 0]):
            here = at[going]
            at[going] = left[here] + (rows[going, feature[here]] > cut[here])
        total += path[at]
    return np.exp2(-total / max(len(trees), 1) / max(float(_expected(size)), 1e-9))


def _scored(table: DataFrame, forests) -> DataFrame:
    names = [c for c in table.columns if c != "features"]
    kinds = ", ".join(f"`{c}` {table.schema[c].dataType.simpleString()}" for c in names)
    n = sum(map(len, FAMILIES.values()))

    def scan(batches):
        for part in slices(batches, 5000):
            rows = np.array(part.column(part.num_columns - 1).to_pylist(), float).reshape(-1, n)
            scores, at = [], 0
            for features, forest in zip(FAMILIES.values(), forests):
                scores.append(anomaly(rows[:, at:at + len(features)], forest))
                at += len(features)
            yield pa.RecordBatch.from_arrays(
                [*part.columns[:-1], pa.array(np.max(scores, axis=0)),
                 pa.array(np.transpose(scores).tolist(), pa.list_(pa.float64()))], [*names, "score", "scores"])

    return table.select(*names, "features").mapInArrow(scan, f"{kinds}, score double, scores array<double>")


def thresholds(scored: DataFrame, labels: DataFrame, good_weight: float = GOOD_WEIGHT) -> list[int]:
    """For each family the bin of scores (of ``_BINS``) from which rows go; past the last where none does.

    A family is judged on the labelled rows that the base rules and the families before it leave.
    """
    labelled = labels.where("quality IS NOT NULL AND doc_id IS NOT NULL").groupBy("doc_id").agg(
        F.min("quality").alias("quality"))
    rows = written(scored.where(~F.col("base_failed")).join(labelled, "doc_id").select(
        F.transform("scores", lambda s: F.floor(s * _BINS)).alias("bins"), (F.col("quality") > 0).alias("good")),
        "labelled-scores")
    found: list[int] = []
    for family in range(len(FAMILIES)):
        counts = np.zeros((2, _BINS + 2))
        for r in rows.groupBy("good", F.col("bins")[family].alias("bin")).count().collect():
            counts[int(r["good"]), int(r["bin"])] += r["count"]
        above = counts[:, ::-1].cumsum(axis=1)[:, ::-1]
        bad, good = counts.sum(axis=1)
        gain = above[0] / max(bad, 1) - good_weight * (above[1] + 1) / (good + 1)
        # Of equals the one in the middle between the good rows and the bad ones.
        last = len(gain) - 1 - int(gain[::-1].argmax())
        first = last
        while first and gain[first - 1] == gain[last]:
            first -= 1
        best = (first + last + 1) // 2
        found.append(best if bad and good and gain[best] > 0 else _BINS + 2)
        rows = rows.where(F.col("bins")[family] < found[-1])
    return found


def quality_rules(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, the counts, base_failed, score (the highest of the families), scores and kept of every row."""
    table = rule_table(docs).withColumn("base_failed", (F.col("n_words") < LEAST_WORDS) | (
        100 * F.col("n_repeat_words") > MOST_REPEATED * F.col("n_words")))
    table = written(table.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
        "features"), "rules")
    rows = table.where(~F.col("base_failed"))
    every = max(1, -(-rows.count() // SAMPLE))
    # By hash, so that neither the files' layout nor the tasks' order says which rows are drawn or where they stand.
    ticket = F.xxhash64("doc_id", "features")
    sample = np.array([r["features"] for r in rows.where(F.pmod(ticket, F.lit(every)) == 0).orderBy(
        ticket, "features").limit(2 * SAMPLE).select("features").collect()], float).reshape(
        -1, sum(map(len, FAMILIES.values())))
    forests, at = [], 0
    for features in FAMILIES.values():
        forests.append(fit_forest(sample[:, at:at + len(features)]) if len(sample) else ([], 1))
        at += len(features)
    scored = written(_scored(table, forests), "scored")
    passes = ~F.col("base_failed")
    for family, least in enumerate(thresholds(scored, labels)):
        passes = passes & (F.floor(F.col("scores")[family] * _BINS) < least)
    return scored.withColumn("kept", passes)
