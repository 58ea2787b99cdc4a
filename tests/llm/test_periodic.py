"""Periodic runs against all lags of all places."""

import hashlib
import zlib
from fractions import Fraction

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from dossier.llm import periodic, queries


def plain_runs(words, least=6, exponent=4):
    """Every maximal stretch of every lag; of one stretch the smallest lag."""
    n, found = len(words), {}
    for q in range(1, n):
        i = 0
        while i + q < n:
            if words[i] != words[i + q]:
                i += 1
                continue
            first = i
            while i + q < n and words[i] == words[i + q]:
                i += 1
            if i - first + q >= max(least, exponent * q):
                smaller = any(all(words[j] == words[j + p] for j in range(first, i + q - p)) for p in range(1, q))
                if not smaller:
                    found[first, q] = i - first + q
    return [(s, length, q) for (s, q), length in sorted(found.items())]


def plain_row(doc_id, text):
    """A row of the query by its definition."""
    words = [w for w in (text or "").encode().split()]
    n, h = len(words), zlib.crc32(str(doc_id).encode())
    if doc_id is not None and h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
    runs = plain_runs(words)
    gone = {i for s, length, q in runs for i in range(s + q, s + length)}
    best = max(runs, key=lambda r: (Fraction(r[1], r[2]), -r[0], -r[2]), default=(None, None, None))
    sha = lambda b: hashlib.sha256(b).hexdigest()
    return (doc_id, len(runs), *best, 1000 * best[1] // best[2] if runs else None,
            sha("".join(f"{s},{length},{q}\n" for s, length, q in runs).encode()),
            sha(b" ".join(w for i, w in enumerate(words) if i not in gone)))


COLUMNS = ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]


def joined(texts):
    """Several documents the way a task lays them out."""
    numbers, flat, ends = {}, [], []
    for i, text in enumerate(texts):
        flat += [len(texts) + numbers.setdefault(w, len(numbers)) for w in text]
        ends.append(len(flat))
        flat.append(i)
    return np.array(flat, np.int64), np.array(ends, np.int64)


unit = st.lists(st.sampled_from("ab"), min_size=1, max_size=9)
text = st.lists(st.tuples(unit, st.integers(1, 8)), max_size=6).map(lambda parts: [w for u, r in parts for w in u * r])


@settings(max_examples=300, deadline=None)
@given(st.lists(text, min_size=1, max_size=4))
def test_runs_of_few_letters(texts):
    words, ends = joined(texts)
    want = [(s + int(ends[d]) - len(t), length, q) for d, t in enumerate(texts) for s, length, q in plain_runs(t)]
    assert periodic.find_runs(words, ends) == sorted(want, key=lambda r: (r[0], r[2]))


@settings(max_examples=100, deadline=None)
@given(text, st.sampled_from([(6, 3), (4, 4), (1, 5), (10, 6)]))
def test_other_thresholds(words, limits):
    flat, ends = joined([words])
    assert periodic.find_runs(flat, ends, *limits) == plain_runs(words, *limits)


def test_gram_that_occurs_twice_in_a_period():
    unit = list("aaaaaaaab") * 2 + list("aaaaaaaac")
    words = unit * 5
    flat, ends = joined([words])
    assert periodic.find_runs(flat, ends) == plain_runs(words)
    assert (0, 135, 27) in plain_runs(words)


def test_long_periods_and_long_texts():
    unit = [f"w{i % 977}" for i in range(10_000)] + ["end"]
    flat, ends = joined([unit * 4, ["a"] * 500_000, unit * 3])
    assert (0, 40_004, 10_001) in periodic.find_runs(flat, ends)
    assert (40_005, 500_000, 1) in periodic.find_runs(flat, ends)


def test_query_against_definition(spark, docs_of, messy):
    texts = ["spam " * 40, "a b " * 9 + "c", "no run here at all", "x y z " * 4, "x y z " * 3, "", "é é é é é é"]
    rows = [(i, t) for i in range(60) for t in [texts[i % 7] + " tail"] * (1 + i % 2)]
    docs = docs_of(rows + [(None, "m " * 12), (-3, None), (7, "word " * 3000)])
    got = periodic.run_digests(periodic.planted(docs)).select(COLUMNS).collect()
    key = lambda r: repr(tuple(r))
    want = [plain_row(r["doc_id"], r["text"]) for r in docs.collect()]
    assert sorted(map(tuple, got), key=repr) == sorted(want, key=key)


def test_query_on_short_documents_of_the_table(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    got = {r["doc_id"]: tuple(r) for r in queries.QUERIES["op11_periodic_runs"](spark, sf).select(COLUMNS).collect()}
    for row in docs.where(F.length("text") < 1500).collect():
        assert got[row["doc_id"]] == plain_row(row["doc_id"], row["text"])


def test_odd_rows(messy, empty, odd_columns):
    got = periodic.periodic_runs(messy).collect()
    assert [(r["doc_id"], r["n_words"]) for r in got] == [
        (r["doc_id"], len((r["text"] or "").encode().split())) for r in messy.collect()]
    (run,) = [r["runs"] for r in got if r["doc_id"] == 5]
    assert [tuple(r) for r in run] == [(0, 30_000, 1)]
    assert [r["collapsed"] for r in got if r["doc_id"] == 5] == ["word"]
    assert periodic.periodic_runs(empty).count() == 0 and periodic.run_digests(periodic.planted(empty)).count() == 0
    assert sorted(periodic.run_digests(periodic.planted(odd_columns)).collect(), key=repr) == sorted(
        periodic.run_digests(periodic.planted(messy)).collect(), key=repr)


def test_refuses_what_the_classes_cannot_promise(messy):
    with pytest.raises(ValueError):
        periodic.periodic_runs(messy, 6, 2)
