"""Scoring texts with a class-based bigram model.

A-Z lower-cased, words ``[^\\x20\\x09-\\x0D]+``, then one end token. Training texts are those whose
crc32(doc_id as text) mod 5 is not 1 (a null id counts as empty text).

Units: each of the most frequent words (at most ``UNITS``) is a unit of its own; any other word belongs to the
unit of its ending, one of ``ENDINGS`` hash values of its last two characters. Every word of any corpus has a
unit without a table that grows. Units are put into ``CLASSES`` classes by exchange clustering: starting from
classes of equal token mass by frequency, in each of ``ROUNDS`` rounds every unit (a hashed half of
them at a time, so that neighbours do not swap back and forth) moves to the class that raises the likelihood
of the class bigrams most, given the other units' classes. Unit pairs are counted over all training texts
and stay in Spark; the driver holds classes of units and class-to-class counts only.

Score: sum over tokens of log10 P(class | class before) + log10 P(token | class). Transitions are smoothed by 0.5 a
class; an emission is (c + 0.5) / (N_class + 0.5 (V_class + 1)) with the word's own training count c, over
all words, so unseen words have the rest of their class. Start and end are classes of their own.

Counts of the ``KNOWN`` most frequent words at most go to the tasks; rarer tokens meet their counts in a join.
Null and empty texts are one end token. Repeated rows count and score each; extra columns are
ignored; an empty table gives an empty result, and with no training text every count is zero.
"""

from __future__ import annotations

import math
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from dossier.llm.common import raw, slices, written

UNITS = 8192
ENDINGS = 1024
CLASSES = 48
ROUNDS = 6
KNOWN = 131_072
_HELD = 400_000
END = b"\n"  # no word holds a line feed


def held_out():
    return F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))) % 5 == 1


def words_of(text: bytes) -> list[bytes]:
    return text.lower().split()


def word_counts(texts: DataFrame) -> DataFrame:
    """word (binary) and n over all texts, ends included; each task adds up before the shuffle."""
    def scan(batches):
        held: Counter[bytes] = Counter()

        def out():
            return pa.RecordBatch.from_arrays(
                [pa.array(list(held), pa.binary()), pa.array(list(held.values()), pa.int64())], ["word", "n"])

        for part in slices(batches, 200):
            for text in raw(part.column(0)):
                held.update(words_of(text))
                held[END] += 1
            if len(held) > _HELD:
                yield out()
                held.clear()
        yield out()

    return texts.select("text").mapInArrow(scan, "word binary, n long").groupBy("word").agg(
        F.sum("n").alias("n"))


def most_frequent(counts: DataFrame, most: int) -> dict[bytes, int]:
    """The words whose count is in the highest bands that together hold at most ``most`` words."""
    band = F.floor(F.log2("n") * 16)
    bands = sorted(((r["band"], r["size"]) for r in counts.groupBy(band.alias("band")).agg(
        F.count("*").alias("size")).collect()), reverse=True)
    least, total = None, 0
    for value, size in bands:
        if total + size > most:
            break
        least, total = value, total + size
    if least is None:
        return {}
    return {bytes(r["word"]): r["n"] for r in counts.where(band >= least).collect()}


class Units:
    """The unit of any word: 0 start, 1 end, then the frequent words, then the endings."""

    def __init__(self, words: list[bytes]):
        self.own = {END: 1} | {w: i + 2 for i, w in enumerate(words)}
        self.first = len(words) + 2
        self.n = self.first + ENDINGS

    def of(self, word: bytes) -> int:
        own = self.own.get(word)
        if own is not None:
            return own
        return self.first + zlib.crc32(word.decode("utf-8", "replace")[-2:].encode()) % ENDINGS

    def table(self) -> "_Table":
        return _Table(self)


class _Table(dict):
    """Units by word, as a task meets them; bounded."""

    def __init__(self, units: Units):
        super().__init__()
        self.units = units

    def __missing__(self, word: bytes) -> int:
        if len(self) >= _HELD:
            self.clear()
        got = self[word] = self.units.of(word)
        return got


def unit_pairs(texts: DataFrame, units: Units) -> DataFrame:
    """u, v and n: how often unit v follows unit u in the texts, start and end included."""
    shared = texts.sparkSession.sparkContext.broadcast(units)

    def scan(batches):
        table = shared.value.table()
        held: list[tuple[np.ndarray, np.ndarray]] = []

        def merged():
            keys, place = np.unique(np.concatenate([k for k, _ in held]), return_inverse=True)
            sums = np.bincount(place, weights=np.concatenate([n for _, n in held])).astype(np.int64)
            held[:] = [(keys, sums)]
            return len(keys)

        def out():
            keys, n = held[0]
            return pa.RecordBatch.from_arrays(
                [pa.array((keys >> 32).astype(np.int32)), pa.array((keys & 0xFFFFFFFF).astype(np.int32)),
                 pa.array(n)], ["u", "v", "n"])

        waiting = 0
        for part in slices(batches, 200):
            ids: list[int] = []
            for text in raw(part.column(0)):
                ids.append(0)
                ids.extend(map(table.__getitem__, words_of(text)))
                ids.append(1)
            row = np.array(ids, np.int64)
            keys = row[:-1] << 32 | row[1:]
            keys, n = np.unique(keys[row[:-1] != 1], return_counts=True)
            held.append((keys, n))
            waiting += len(keys)
            if waiting > 4 * _HELD:
                waiting = merged()
                if waiting > 2 * _HELD:
                    yield out()
                    held.clear()
                    waiting = 0
        if held:
            merged()
            yield out()

    return texts.select("text").mapInArrow(scan, "u int, v int, n long").groupBy("u", "v").agg(
        F.sum("n").alias("n"))


def _xlogx(x):
    return np.where(x > 0, x * np.log(np.maximum(x, 1e-300)), 0.0)


def best_class(own: int, left: np.ndarray, right: np.ndarray, loop: float,
               pairs: np.ndarray, rows: np.ndarray, columns: np.ndarray) -> int:
    """The class that makes the class bigrams likeliest for one unit.

    ``left``/``right``: its tokens after/before each class; ``loop``: of them those next to itself; ``pairs``: class bigram
    counts; ``rows``/``columns``: their sums. All still hold the unit in its own class.
    """
    k = len(rows)
    left, right = left.copy(), right.copy()
    left[own] -= loop
    right[own] -= loop
    base = pairs.copy()
    base[:, own] -= left
    base[own, :] -= right
    base[own, own] -= loop
    row, column = rows.copy(), columns.copy()
    total_out, total_in = right.sum() + loop, left.sum() + loop
    row[own] -= total_out
    column[own] -= total_in
    classes = np.arange(k)
    # Joining class g changes column g by left, row g by right and the corner by left[g] + right[g] + loop.
    at, before = np.flatnonzero(left), np.flatnonzero(right)
    into = (_xlogx(base[at] + left[at, None]) - _xlogx(base[at])).sum(axis=0)
    out = (_xlogx(base[:, before] + right[before]) - _xlogx(base[:, before])).sum(axis=1)
    corner = base[classes, classes]
    twice = (_xlogx(corner + left) - _xlogx(corner)) + (_xlogx(corner + right) - _xlogx(corner))
    gain = into + out - twice + _xlogx(corner + left + right + loop) - _xlogx(corner)
    gain -= _xlogx(row + total_out) - _xlogx(row) + _xlogx(column + total_in) - _xlogx(column)
    gain[:2] = -np.inf  # start and end are classes of their own
    best = int(gain.argmax())
    return best if gain[best] > gain[own] + 1e-9 else own


def exchange(pairs: DataFrame, sizes: np.ndarray, classes: int = CLASSES, rounds: int = ROUNDS) -> np.ndarray:
    """The class of every unit. ``sizes``: tokens of each unit."""
    spark = pairs.sparkSession
    of = np.zeros(len(sizes), np.int64)
    order = np.argsort(-sizes[2:], kind="stable") + 2
    mass = np.cumsum(sizes[order])
    of[order] = 2 + np.minimum((mass - sizes[order]) * (classes - 2) // max(1, mass[-1]), classes - 3).astype(np.int64)
    of[:2] = (0, 1)
    # Both directions as one table of unit contexts; loops apart.
    context = written(
        pairs.select(F.col("v").alias("unit"), F.col("u").alias("other"), F.lit(0).alias("side"), "n").unionByName(
            pairs.select(F.col("u").alias("unit"), F.col("v").alias("other"), F.lit(1).alias("side"), "n")),
        "unit-contexts")
    for turn in range(rounds):
        known = spark.createDataFrame([(i, int(c)) for i, c in enumerate(of)], "other int, class int")
        # ``known`` has one row per unit, at most UNITS + ENDINGS + 2.
        seen = context.join(F.broadcast(known), "other").groupBy("unit", "side", "class").agg(
            F.sum("n").alias("n"), F.sum(F.when(F.col("unit") == F.col("other"), F.col("n")).otherwise(0)).alias("loop"))
        seen = written(seen, "class-contexts")
        matrix = np.zeros((classes, classes))
        mine = spark.createDataFrame([(i, int(c)) for i, c in enumerate(of)], "unit int, own int")
        for r in seen.where("side = 1").join(F.broadcast(mine), "unit").groupBy("own", "class").agg(
                F.sum("n").alias("n")).collect():
            matrix[r["own"], r["class"]] = r["n"]
        rows, columns = matrix.sum(axis=1), matrix.sum(axis=0)

        def move(batches, of=of, matrix=matrix, rows=rows, columns=columns):
            for batch in batches:
                out = []
                for unit, entries in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                    left, right, loop = np.zeros(classes), np.zeros(classes), 0.0
                    for e in entries:
                        (right if e["side"] else left)[e["class"]] += e["n"]
                        loop += e["loop"] if e["side"] else 0
                    out.append(best_class(int(of[unit]), left, right, loop, matrix, rows, columns))
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, pa.int32())], ["unit", "best"])

        half = F.pmod(F.xxhash64("unit"), F.lit(2)) == turn % 2
        moved = (
            seen.where("unit > 1").where(half).groupBy("unit")
            .agg(F.collect_list(F.struct("side", "class", "n", "loop")).alias("entries"))  # at most two per class
            .mapInArrow(move, "unit int, best int").collect())
        changed = 0
        of = of.copy()
        for r in moved:
            changed += of[r["unit"]] != r["best"]
            of[r["unit"]] = r["best"]
        if not changed and turn:
            break
    return of


def score(docs: DataFrame, classes: int = CLASSES, rounds: int = ROUNDS) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score and class_perplexity of every row."""
    spark = docs.sparkSession
    docs = docs.select("doc_id", "text", held_out().alias("held_out"))
    training = docs.where("NOT held_out")
    counts = written(word_counts(training), "word-counts")
    total = counts.agg(F.sum("n").alias("n"), F.count("*").alias("v")).first()
    tokens, distinct = total["n"] or 0, total["v"]
    known = most_frequent(counts, KNOWN)
    frequent = sorted((w for w in known if w != END), key=lambda w: (-known[w], w))[:UNITS]
    units = Units(frequent)
    pairs = written(unit_pairs(training, units), "unit-pairs")

    shared_units = spark.sparkContext.broadcast(units)

    def by_unit(batches):
        n, v = np.zeros(shared_units.value.n, np.int64), np.zeros(shared_units.value.n, np.int64)
        for part in slices(batches, 10_000):
            own = np.array([shared_units.value.of(w) for w in part.column(0).to_pylist()], np.int64)
            np.add.at(n, own, part.column(1).to_numpy())
            np.add.at(v, own, 1)
        some = np.flatnonzero(v)
        yield pa.RecordBatch.from_arrays(
            [pa.array(some.astype(np.int32)), pa.array(n[some]), pa.array(v[some])], ["unit", "n", "v"])

    sizes, kinds = np.zeros(units.n, np.int64), np.zeros(units.n, np.int64)
    for r in counts.mapInArrow(by_unit, "unit int, n long, v long").groupBy("unit").agg(
            F.sum("n").alias("n"), F.sum("v").alias("v")).collect():
        sizes[r["unit"]], kinds[r["unit"]] = r["n"], r["v"]
    of = exchange(pairs, sizes, classes, rounds)

    steps = np.zeros((classes, classes))
    named = spark.createDataFrame([(i, int(c)) for i, c in enumerate(of)], "unit int, class int")
    first = named.select(F.col("unit").alias("u"), F.col("class").alias("a"))
    second = named.select(F.col("unit").alias("v"), F.col("class").alias("b"))
    for r in pairs.join(F.broadcast(first), "u").join(F.broadcast(second), "v").groupBy("a", "b").agg(
            F.sum("n").alias("n")).collect():
        steps[r["a"], r["b"]] = r["n"]
    transition = np.log10((steps + 0.5) / (steps.sum(axis=1, keepdims=True) + 0.5 * classes))
    class_n, class_v = np.bincount(of, sizes, classes), np.bincount(of, kinds, classes)
    emission_base = np.log10(class_n + 0.5 * (class_v + 1))
    base_all = math.log10(tokens + 0.5 * (distinct + 1))
    shared = spark.sparkContext.broadcast((units, of, transition, emission_base, known))
    id_type = docs.schema["doc_id"].dataType.simpleString()

    def scan(batches):
        units, of, transition, emission_base, known = shared.value
        table = units.table()
        logs = {w: math.log10(n + 0.5) for w, n in known.items()}
        for part in slices(batches, 500):
            rows = []
            for text in raw(part.column(2)):
                words = words_of(text)
                words.append(END)
                path = of[np.array([0, *map(table.__getitem__, words)], np.int64)]
                own = transition[path[:-1], path[1:]].sum() - emission_base[path[1:]].sum()
                found = list(map(logs.get, words))
                rare = Counter(w for w, x in zip(words, found) if x is None) if None in found else {}
                seen = len(words) - sum(rare.values())
                rows.append((len(words), seen, math.fsum(filter(None, found)), float(own), list(rare), list(rare.values())))
            yield pa.RecordBatch.from_arrays(
                [*part.columns[:2], part.column(3), *(pa.array([r[i] for r in rows], t) for i, t in enumerate((
                    pa.int64(), pa.int64(), pa.float64(), pa.float64(), pa.list_(pa.binary()), pa.list_(pa.int64()))))],
                ["row", "doc_id", "held_out", "n_tokens", "seen", "logs", "own", "rare", "times"])

    rows = written(
        docs.select(F.monotonically_increasing_id().alias("row"), "doc_id", "text", "held_out").mapInArrow(
            scan, f"row long, doc_id {id_type}, held_out boolean, n_tokens long, seen long, logs double, own double, "
                  "rare array<binary>, times array<long>"), "scored-rows")
    rare = (
        rows.select("row", F.explode(F.arrays_zip("rare", "times")).alias("w"))
        .select("row", F.col("w.rare").alias("word"), F.col("w.times").alias("times")))
    met = rare.join(counts, "word", "left").groupBy("row").agg(
        F.sum(F.when(F.col("n").isNotNull(), F.col("times")).otherwise(0)).alias("more"),
        F.sum(F.col("times") * F.log10(F.coalesce(F.col("n"), F.lit(0)) + 0.5)).alias("more_logs"))
    all_logs = F.col("logs") + F.coalesce("more_logs", F.lit(0.0))
    result = rows.drop("rare", "times").join(met, "row", "left").select(
        "doc_id", "held_out", "n_tokens", (F.col("seen") + F.coalesce("more", F.lit(0))).alias("n_known"),
        F.lit(tokens).cast("long").alias("train_tokens"),
        (all_logs - F.lit(base_all) * F.col("n_tokens")).alias("base_score"),
        (all_logs + F.col("own")).alias("score"))
    return result.withColumn("perplexity", F.pow(F.lit(10.0), -F.col("score") / F.col("n_tokens")))
