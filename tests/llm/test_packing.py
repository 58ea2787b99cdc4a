"""Packing: whole texts, no padding, balanced costs, and the order of assignment."""

import random
import zlib
from collections import defaultdict
from itertools import pairwise

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from dossier.llm import packing, queries

LIBRARY = Tokenizer.from_file(packing.MODEL)


def whole(text):
    return LIBRARY.encode(text, add_special_tokens=False).ids


def segmented(texts):
    segments = packing.Segments(packing.MODEL)
    return [np.frombuffer(segments.encode(t), "<u4").tolist() for t in texts]


TRICKY = [
    "", " ", "  ", "a", " a", "a ", "a  b", "a \n b", "a\n  b", "it's they'll  we 've", "x\t y", "a  b", "　 a  ",
    "one<|endoftext|>two <|endoftext|> three", "漢字 かな 漢字", "é à  ü!", "a.b , c ;d", "1 2  33 444", "end. ", "\x1c x \x85 y"]


def test_segments_give_the_ids_of_whole_texts(spark, sf):
    texts = TRICKY + [r["text"] or "" for r in spark.read.parquet(f"{sf}/documents.parquet").select("text").collect()]
    assert segmented(texts) == [whole(t) for t in texts]


@settings(max_examples=400, deadline=None)
@given(st.lists(st.sampled_from([" ", "  ", "a", "B", "'s", "'", "7", ".", "\n", "\t", "é", "漢", " ", "<|endoftext|>", "-"]))
       .map("".join) | st.text())
def test_segments_of_odd_characters(text):
    assert segmented([text]) == [whole(text)]


SIGNS = [" ", "  ", "\n", "\r\n", "\t", "\x0b", "\x1c", "\x85", "\xa0", "\u1680", "\u2003", "\u200b", "\u2028", "\u202f",
         "\u205f", "\u3000", "a", "Word", "it", "'s", "'LL", "'", "7", "42", "\xbd", ".", ",", "!?", "(", "_", "-", "<", "|", ">",
         "<|endoftext|>", "\xe9", "\xc0", "\xd7", "\xf7", "\u024f", "\u0250", "\u0301", "\u0436", "\u201c", "\u6f22", "\U0001f600"]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.lists(st.sampled_from(SIGNS)).map("".join) | st.none(), max_size=12), st.integers(1, 40))
def test_texts_encoded_together_give_the_ids_of_each(texts, joined):
    segments, held = packing.Segments(packing.MODEL), packing.JOINED
    try:
        packing.JOINED = joined
        body, ends = segments.encode_all(pa.array(["cut off", *texts], pa.string()).slice(1))
    finally:
        packing.JOINED = held
    assert [np.frombuffer(bytes(body[a:b]), "<u4").tolist() for a, b in pairwise(ends.tolist())] == [
        whole(t or "") for t in texts]


def test_plain_words_are_joined_only_where_no_token_spans_two():
    model = packing.Segments(packing.MODEL).tokenizer.model
    assert not packing._joins(model, {"\u0120the": 0, "\u010a\u010a": 1, "\u0120\xc2\u0142\u0120": 2})
    assert packing._joins(model, {"e\u0120t": 0}) and packing._joins(model, {"\u010aA": 0})


def test_new_words_need_the_pre_tokenizer_no_more(monkeypatch):
    """The cost of op13: plain words that a worker has not seen went one by one through the library's splitter."""
    segments, seen = packing.Segments(packing.MODEL), []
    plainly = segments._ids
    monkeypatch.setattr(segments, "_ids", lambda texts: seen.extend(texts) or plainly(texts))
    text = "Blick " + " ".join(f"{a}schöne{b}, {b}{a}wort." for a in "abcdef" for b in "xyz")
    assert np.frombuffer(segments.encode(text), "<u4").tolist() == whole(text)
    assert set(b"".join(seen).decode()) <= set("\n.,")


def test_blocks_hold_every_row_once():
    texts = [None, "x" * 5000, "", "y" * (packing.BLOCK + 1), "é" * 10, None]
    batch = pa.RecordBatch.from_arrays([pa.array(range(6)), pa.array(texts)], ["doc_id", "text"])
    blocks = list(packing._blocks(iter([batch.slice(1), batch.slice(0, 0), batch])))
    assert [i for b in blocks for i in b.column(0).to_pylist()] == [1, 2, 3, 4, 5, 0, 1, 2, 3, 4, 5]
    assert len(blocks) > 2


def test_kept_segments_stay_bounded(monkeypatch):
    monkeypatch.setattr(packing, "KEPT", 2000)  # a thousand bytes, then one text more
    segments = packing.Segments(packing.MODEL)
    rng = random.Random(1)
    for _ in range(30):
        text = " ".join(f"w{rng.randrange(500)}" for _ in range(50)) + "漢" * 100
        assert np.frombuffer(segments.encode(text), "<u4").tolist() == whole(text)
        assert segments.size <= 1000 and all(len(s) <= packing.LONGEST for s in segments)
        assert len(segments.before) < 60


def plainly(lengths, capacity, quadratic):
    """The rule with lists: the longest waiting document, the cheapest sequence with room for it."""
    sizes = packing.capacities(sum(lengths), capacity)
    held = [[] for _ in sizes]
    waiting = [(n, i, 0) for i, n in enumerate(lengths) if n]
    room = lambda s: sizes[s] - sum(p[2] for p in held[s])
    cost = lambda s: sum(p[2] + quadratic * p[2] ** 2 for p in held[s])
    while waiting:
        first = min(waiting, key=lambda d: (-d[0], d[1], -d[2]))
        waiting.remove(first)
        n, i, start = first
        able = [s for s in range(len(sizes)) if room(s) >= n] or [s for s in range(len(sizes)) if room(s)]
        at = min(able, key=lambda s: (cost(s), s))
        took = min(n, room(at))
        held[at].append((i, start, took))
        if took < n:
            waiting.append((n - took, i, start + took))
    return sorted((i, start, took, s, sum(p[2] for p in held[s][:k]))
                  for s in range(len(sizes)) for k, (i, start, took) in enumerate(held[s]))


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(0, 70), max_size=40), st.sampled_from([16, 64]))
def test_balance_against_the_rule(lengths, capacity):
    # An exact binary weight: both sides then add up costs without rounding.
    assert sorted(packing.balance(lengths, capacity, 1 / 64)) == plainly(lengths, capacity, 1 / 64)


def test_balance_is_better_than_first_come():
    rng = random.Random(3)
    lengths = [min(2047, int(rng.lognormvariate(5.3, 1))) + 1 for _ in range(3000)]
    spread = lambda costs: max(costs) / (sum(costs) / len(costs))
    costs = defaultdict(float)
    for _, _, n, s, _ in packing.balance(lengths):
        costs[s] += n + packing.QUADRATIC * n * n
    own = [c for s, c in costs.items() if s < sum(lengths) // 2048]
    filled, plain, room = [0.0], [], 2048
    for n in lengths:
        while n:
            took = min(n, room)
            filled[-1] += took + packing.QUADRATIC * took * took
            n, room = n - took, room - took
            if not room:
                filled.append(0.0)
                room = 2048
    plain = filled[:-1]
    assert spread(own) < spread(plain)
    assert len(packing.balance(lengths)) <= len(lengths) + len(packing.capacities(sum(lengths)))


def hold_whole(rows, docs, capacity=2048):
    """Every id in one piece, sequences gapless, within the capacity and without padding."""
    want = defaultdict(int)
    for d in docs:
        want[d["doc_id"], tuple(whole(d["text"] or "") + [1])] += 1
    pieces = defaultdict(list)
    for r in rows:
        pieces[r["doc_id"], r["doc_tokens"]].append(r)
    sequences = defaultdict(list)
    for r in rows:
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
    for held in sequences.values():
        at = 0
        for offset, length in sorted(held):
            assert offset == at and length > 0
            at += length
        assert at <= capacity and at & (at - 1) == 0
    texts = defaultdict(list)
    for (doc_id, ids), n in want.items():
        texts[doc_id, len(ids)].append((ids, n))
    assert set(texts) == set(pieces)
    for key, own in texts.items():
        covered = defaultdict(int)
        for r in pieces[key]:
            ids = np.frombuffer(r["ids"], "<u4").tolist()
            assert any(list(t[r["start"]:r["start"] + r["length"]]) == ids for t, _ in own)
            for i in range(r["start"], r["start"] + r["length"]):
                covered[i] += 1
        assert covered == {i: sum(n for _, n in own) for i in range(key[1])}


def test_odd_rows(messy, empty, odd_columns):
    hold_whole(packing.pack(messy).collect(), messy.collect())
    hold_whole(packing.pack(odd_columns, group=1).collect(), messy.collect())
    hold_whole(packing.pack(messy, capacity=64, group=3).collect(), messy.collect(), 64)
    assert packing.pack(empty).count() == 0 and packing.piece_checksums(empty).count() == 0
    with pytest.raises(ValueError):
        packing.pack(messy, capacity=1000)


def test_query_on_the_table(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    hold_whole(packing.pack(docs).collect(), docs.collect())
    texts = {r["doc_id"]: whole(r["text"] or "") + [1] for r in docs.collect()}
    got = queries.QUERIES["op13_packing"](spark, sf).collect()
    for r in got:
        part = texts[r["doc_id"]][r["start"]:r["start"] + r["length"]]
        assert r["ids_crc32"] == zlib.crc32(np.array(part, "<u4").tobytes()) and r["doc_tokens"] == len(texts[r["doc_id"]])
    assert sum(r["length"] for r in got) == sum(map(len, texts.values()))


def test_copies_of_one_document_spread(spark, docs_of):
    docs = docs_of([(1, "the same words again and again " * 40)] * 600 + [(i, f"other {i}") for i in range(2, 300)])
    rows = packing.pack(docs, group=4)
    assert rows.where((F.col("doc_id") == 1) & (F.col("sequence_id") % 2 == 1)).select(
        F.shiftright("sequence_id", 33)).distinct().count() > 10
    hold_whole(rows.collect(), docs.collect())
