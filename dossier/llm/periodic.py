"""Periodic run detection: seed and extend on the diagonals of a document with itself.

A *run* is a stretch of consecutive words with smallest period q that no neighbouring word extends and that
is at least ``max(LEAST_WORDS, EXPONENT * q)`` words long. On the diagonal of lag q it is a stretch of equal
words of at least ``max(LEAST_WORDS - q, (EXPONENT - 1) * q)``: the overlap that a period guarantees.

Lags fall into classes, the first from 1 to 5, each next one up to three times as far. A class indexes k-grams
of the least overlap that its lags guarantee; that k is also as long as its longest lag, so (by the theorem of
Fine and Wilf) the k-gram at the start of a run occurs next exactly one period later. Each occurrence is
therefore paired with the next one of the same document only, and no run is missed; a unit word repeated a
million times makes a million pairs, not their square. A pair whose place lies before the furthest covered
place of its lag is part of a stretch already walked and is dropped; every other one is extended to both sides.
By the same theorem the stretches are the runs of exponent 2 or more, so all extensions together are short.

k-grams are named exactly: names of doubled length number the pairs of names. A longer class
looks only at documents in which a k-gram of the class before repeats.

A document is one row and needs none but itself, so there is no shuffle. A null text is empty and has no words;
a null doc_id is carried along; repeated rows give repeated rows; other columns are ignored; an empty table
gives an empty result. Words are ``[^\\x20\\x09-\\x0D]+``, compared byte by byte.
"""

from __future__ import annotations

from collections import defaultdict
from itertools import chain, count

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from dossier.llm.common import raw

LEAST_WORDS = 6
EXPONENT = 4
#: Words of many short documents are looked at together, up to about this many bytes of text.
TOGETHER = 1 << 21

RUN = "struct<start:long,length:long,period:long>"


def _named(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Names of pairs of names: equal pairs, and no others, get the same number."""
    return pd.factorize(left * (right.max() + 1) + right)[0]


def _grams(words: np.ndarray, k: int) -> np.ndarray:
    """The name of the k-gram at each place that has one."""
    names, size = words, 1
    while size * 2 <= k:
        names, size = _named(names[:-size], names[size:]), size * 2
    return names if size == k else _named(names[:len(words) - k + 1], names[k - size:])


def _equal_until(words: np.ndarray, at: int, lag: int) -> int:
    """The first place from ``at`` on whose word differs from the one a lag later (the last one always does)."""
    step = 32
    while True:
        left, right = words[at:at + step], words[at + lag:at + lag + step]
        differ = np.flatnonzero(left[:len(right)] != right)
        if len(differ):
            return at + int(differ[0])
        if len(right) < step:
            return at + len(right)
        at, step = at + step, step * 2


def _equal_from(words: np.ndarray, at: int, lag: int) -> int:
    """The first place of the stretch of equal words on the diagonal that holds ``at``."""
    step = 32
    while at > 0:
        low = max(0, at - step)
        differ = np.flatnonzero(words[low:at] != words[low + lag:at + lag])
        if len(differ):
            return low + int(differ[-1]) + 1
        at, step = low, step * 2
    return 0


def find_runs(words: np.ndarray, ends: np.ndarray, least: int = LEAST_WORDS,
              exponent: int = EXPONENT) -> list[tuple[int, int, int]]:
    """(start, length, period) of every run, in order of start and period.

    ``words`` holds the numbered words of several documents, each followed by a number that occurs nowhere
    else; ``ends`` holds the places of those numbers. Starts count from the first word of all.
    """
    runs, low, starts = [], 1, np.concatenate(([0], ends[:-1] + 1)) if len(ends) else ends
    places = np.arange(len(words))
    while len(words):
        k = min(max(least - q, (exponent - 1) * q) for q in (low, low + 1, low + 2))
        high = max(k, low)
        if len(words) <= k:
            break
        names = _grams(words, k)
        order = np.argsort(names, kind="stable")
        again = names[order[1:]] == names[order[:-1]]
        at, lag = order[:-1][again], np.diff(order)[again]
        near = (lag >= low) & (lag <= high)
        seeds = np.lexsort((at[near], lag[near]))
        seed_at, seed_lag = at[near][seeds], lag[near][seeds]
        if len(seed_at):  # a pair right behind another of its lag is in the same stretch
            head = np.ones(len(seed_at), bool)
            head[1:] = (np.diff(seed_at) != 1) | (np.diff(seed_lag) != 0)
            seed_at, seed_lag = seed_at[head], seed_lag[head]
        covered: dict[int, int] = defaultdict(int)  # the furthest place walked on each lag's diagonal
        for i, q in zip(seed_at.tolist(), seed_lag.tolist()):
            if i < covered[q]:
                continue
            first, covered[q] = _equal_from(words, i, q), _equal_until(words, i + k, q)
            length = covered[q] - first + q
            if length >= max(least, exponent * q):
                runs.append((int(places[first]), length, q))
        # Only documents with a repeated k-gram, and long enough, can hold a run of a longer period.
        low = high + 1
        doc = np.searchsorted(ends, order[:-1][again])
        which = np.unique(doc[doc == np.searchsorted(ends, order[1:][again])])
        which = which[ends[which] - starts[which] >= exponent * low]
        spans = [slice(starts[d], ends[d] + 1) for d in which.tolist()]
        places = np.concatenate([places[s] for s in spans]) if spans else places[:0]
        words = np.concatenate([words[s] for s in spans]) if spans else words[:0]
        ends = np.cumsum([s.stop - s.start for s in spans]) - 1
        starts = np.concatenate(([0], ends[:-1] + 1)) if spans else ends
    return sorted(runs, key=lambda r: (r[0], r[2]))


def _scan(least: int, exponent: int):
    def part(ids: pa.Array, texts: list[bytes]) -> pa.RecordBatch:
        words = [t.split() for t in texts]
        sizes = np.array([len(w) for w in words], np.int64)
        ends = np.cumsum(sizes + 1) - 1
        numbers: dict[bytes, int] = defaultdict(count(len(words)).__next__)
        flat = np.empty(int(sizes.sum()) + len(words), np.int64)
        inside = np.ones(len(flat), bool)
        inside[ends] = False
        flat[ends] = np.arange(len(words))
        flat[inside] = np.fromiter(map(numbers.__getitem__, chain.from_iterable(words)), np.int64, int(sizes.sum()))
        found: list[list[tuple[int, int, int]]] = [[] for _ in words]
        keep = np.ones(len(flat), bool)
        runs = find_runs(flat, ends, least, exponent)
        for doc, (start, length, period) in zip(np.searchsorted(ends, [r[0] for r in runs]).tolist(), runs):
            found[doc].append((start - int(ends[doc] - sizes[doc]), length, period))
            keep[start + period:start + length] = False
        kept = [b" ".join(w) if keep[end - len(w):end].all() else
                b" ".join(w[i] for i in np.flatnonzero(keep[end - len(w):end]).tolist())
                for w, end in zip(words, ends.tolist())]
        return pa.RecordBatch.from_arrays(
            [ids, pa.array(sizes), pa.array(
                [[dict(zip(("start", "length", "period"), r)) for r in rs] for rs in found],
                pa.list_(pa.struct([(n, pa.int64()) for n in ("start", "length", "period")]))),
             pa.array(kept, pa.binary()).cast(pa.string())],
            ["doc_id", "n_words", "runs", "collapsed"])

    def scan(batches):
        for batch in batches:
            texts = raw(batch.column(1))
            start = size = 0
            for i, text in enumerate(texts):
                size += len(text)
                if size >= TOGETHER or i + 1 == len(texts):
                    yield part(batch.column(0).slice(start, i + 1 - start), texts[start:i + 1])
                    start, size = i + 1, 0

    return scan


def periodic_runs(docs: DataFrame, least: int = LEAST_WORDS, exponent: int = EXPONENT) -> DataFrame:
    """doc_id, n_words, runs (start, length, period; by start, then period) and the collapsed text of every row.

    Collapsing drops every word that some run contains after its first period. ``exponent`` is at least 3 and
    ``least`` at most ``2 * exponent``, as the classes of lags need it.
    """
    if exponent < 3 or least > 2 * exponent:
        raise ValueError("runs need an exponent of 3 and at most twice the exponent as their least length")
    id_type = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(
        _scan(least, exponent), f"doc_id {id_type}, n_words long, runs array<{RUN}>, collapsed string")


def most_periodic(runs: Column) -> Column:
    """The run of the greatest exact length / period; of equals the first. Null without runs."""
    return F.reduce(runs, F.lit(None).cast(RUN), lambda best, r: F.when(
        best.isNull() | (r["length"] * best["period"] > best["length"] * r["period"]), r).otherwise(best))


def planted(docs: DataFrame) -> DataFrame:
    """doc_id and text, where a tenth of the documents becomes periodic from some word on.

    With h the crc32 of the id as text and g = h div 10: if h mod 10 is 0, each word from a = g mod n on becomes
    word a + (i - a) mod p, p = 1 + (n - a) div (3 + g mod 8). A row without an id or a word stays.
    """
    h = F.crc32(F.col("doc_id").cast("string"))
    words = F.filter(F.split("text", r"[\x20\x09-\x0D]+"), lambda w: w != "")
    n, g = F.size("words").cast("long"), F.floor(F.col("h") / 10)
    a = F.pmod(g, n)
    p = 1 + F.floor((n - F.col("a")) / (3 + F.pmod(g, F.lit(8))))
    return (
        docs.select("doc_id", "text", h.alias("h"), F.when(h % 10 == 0, words).alias("words"))
        .withColumn("a", F.when(n > 0, a)).withColumn("p", p)
        .select("doc_id", F.when(F.col("a").isNotNull(), F.array_join(F.transform("words", lambda w, i: F.get(
            "words", F.when(i < F.col("a"), i).otherwise(F.col("a") + (i - F.col("a")) % F.col("p")).cast("int"))),
            " ")).otherwise(F.col("text")).alias("text")))


def run_digests(docs: DataFrame) -> DataFrame:
    """The most periodic run of every document, with digests of all its runs and of the collapsed text."""
    best = F.col("best")
    line = lambda r: F.concat_ws(
        ",", *[r[c].cast("string") for c in ("start", "length", "period")])
    return periodic_runs(docs).withColumn("best", most_periodic(F.col("runs"))).select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), best["start"].alias("start"),
        best["length"].alias("length"), best["period"].alias("period"),
        F.floor(1000 * best["length"] / best["period"]).cast("long").alias("exponent_milli"),
        F.sha2(F.array_join(F.transform("runs", lambda r: F.concat(line(r), F.lit("\n"))), ""), 256)
        .alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"), "n_words")
