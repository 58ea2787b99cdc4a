"""Cost-balanced packing of documents into sequences of at most ``CAPACITY`` tokens.

A document's tokens are its ids by the tokenizer file, then ``END``. A sequence costs ``tokens + QUADRATIC * sum of
length ** 2`` over its pieces: a linear part for the layers and a quadratic one for attention, which stays inside a
document. Documents go down by cost, each into the lowest-cost sequence that has token capacity left for it; where
none has, the document is cut at the end of the lowest-cost sequence with capacity left and its rest takes its place
among the documents still to come.

Every full ``CAPACITY`` of a long document is a sequence of its own, made where the document is read. The tails are
dealt to groups of about ``GROUP`` sequences by a hash of their row, so that copies of one document spread, and a
group is packed by itself: a task holds a few megabytes whatever the input. A group opens exactly as many sequences
as its tokens fill, and for the rest sequences of a power of two, which need no padding; cutting fills them all, so
no token of padding is left. A group makes at most as many cuts as it has sequences.

Tokenizing: the byte-level pre-tokenizer starts a new word at white space behind other characters, and where letters or
digits meet each other or a stop; so texts are cut into segments there, a block of rows at once, and a worker keeps the
ids of recent segments, up to ``KEPT`` bytes. New segments are encoded together. Most are words of Latin letters: those
go to the library's model without its pre-tokenizer, since no token of the model joins two of them (checked when it is
loaded). The ids equal those of the whole text (tested against the library).

A null text is empty and has the one token ``END``; repeated rows are packed each; a null doc_id is carried along;
other columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import gc
import os
import re
from bisect import insort
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain, pairwise

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F
from tokenizers import Tokenizer

from dossier.llm.common import written

MODEL = "/opt/tokenizers/byte_bpe_50k.json"
CAPACITY = 2048
END = 1
# Attention against the linear part per token: 1 / (6 * width), for a model 768 wide.
QUADRATIC = 1 / 4608
# Full sequences of one group.
GROUP = 256
#: Bytes of segments and their ids that a worker keeps, and the longest segment it keeps.
KEPT, LONGEST = 256 << 20, 64

#: Bytes of text that are cut and looked up together, and that the library gets at once.
BLOCK, JOINED = 4 << 20, 256 << 10
#: Plain words that the library gets as one text.
WORDS = 100

#: Bytes that an entry takes beside its own.
_ENTRY = 150
# White space as the pre-tokenizer sees it: ASCII, and the bytes of the other characters as numbers.
_BLANK = b" \n\t\r\x0b\x0c"
_WIDE = [int.from_bytes(c.encode()) for c in "\x85\xa0\u1680\u2028\u2029\u202f\u205f\u3000" + "".join(
    map(chr, range(0x2000, 0x200b)))]
_BLANKS = tuple(bytes([b]) for b in _BLANK) + tuple(n.to_bytes(2 if n < 1 << 16 else 3) for n in _WIDE)
_FIRST, _LAST = frozenset(b[0] for b in _BLANKS), frozenset(b[-1] for b in _BLANKS)


# A word of Latin letters, with a space or line feed before it or nothing.
_PLAIN = re.compile(rb"[ \n]?(?:[A-Za-z]|\xc3[\x80-\x96\x98-\xb6\xb8-\xbf]|[\xc4-\xc8][\x80-\xbf]|\xc9[\x80-\x8f])+")
# The character that a byte-level model has for each byte.
_OWN = [*range(33, 127), *range(161, 173), *range(174, 256)]
_CHARS = dict(zip([*_OWN, *(b for b in range(256) if b not in _OWN)], map(chr, [*_OWN, *range(256, 512)])))


def _joins(model, vocabulary: dict[str, int]) -> bool:
    """Whether the model could give plain words other ids where others stand before or behind them."""
    if model.ignore_merges or model.dropout or model.continuing_subword_prefix or model.end_of_word_suffix:
        return True
    used = "".join(_CHARS[b] for b in [*range(65, 91), *range(97, 123), *range(0x80, 0xc0), *range(0xc3, 0xca)])
    own, across = re.compile(f"[{used}ĠĊ]*"), re.compile(f"[{used}][ĠĊ]|Ċ[{used}]")
    return any(across.search(t) and own.fullmatch(t) for t in vocabulary)


@lru_cache(1)
def _library(model: str):
    """The tokenizer, its model alone if plain words may be joined, the bytes of every token, and two tables of bytes.

    A segment may begin between two bytes that share a bit in the tables.
    """
    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
    tokenizer = Tokenizer.from_file(model)
    vocabulary = tokenizer.get_vocab()  # a character of a byte-level token stands for a byte
    widths = np.zeros(max(vocabulary.values()) + 1, np.int64)
    widths[list(vocabulary.values())] = [len(t) for t in vocabulary]
    plain = None if _joins(tokenizer.model, vocabulary) else Tokenizer(tokenizer.model)
    whole = "".join(t.content for t in tokenizer.get_added_tokens_decoder().values()).encode()
    ends, begins = np.zeros(256, np.uint8), np.zeros(256, np.uint8)
    for b in range(256):
        digit, blank = 48 <= b < 58, b in _BLANK
        letter = b < 128 and chr(b).isalpha()
        stop = 32 < b < 127 and not letter and not digit and b not in whole
        # White space behind others, stops behind letters and digits, these behind stops but "'", digits beside letters.
        # Bytes of longer characters count as letters that end here.
        ends[b] = (not blank) | (letter or digit or b > 127) << 1 | (stop and b != 39) << 2 | letter << 3 | digit << 4
        begins[b] = (blank and b not in whole) | stop << 1 | (letter or digit) << 2 | digit << 3 | letter << 4
    return tokenizer, plain, widths, ends, begins


class Segments(dict):
    """The ids of recent segments (UTF-8), as the bytes of unsigned 32-bit numbers."""

    def __init__(self, model: str):
        super().__init__()
        self.tokenizer, self.plain, self.widths, self.ends, self.begins = _library(model)
        self.size, self.before = 0, {}

    def _ids(self, texts: list[bytes]) -> Iterator[np.ndarray]:
        for e in self.tokenizer.encode_batch_fast([t.decode() for t in texts], add_special_tokens=False):
            yield np.array(e.ids, "<u4")

    def _plain_ids(self, words: list[bytes]) -> np.ndarray:
        """The ids of plain words, each behind a space or line feed: merges never join two of them."""
        texts = [b"".join(words[i:i + WORDS]).decode("latin-1").translate(_CHARS) for i in range(0, len(words), WORDS)]
        ids = chain.from_iterable(e.ids for e in self.plain.encode_batch_fast(texts, add_special_tokens=False))
        return np.fromiter(ids, "<u4")

    def _joined(self, new: list[bytes], plain: bool, found: dict[bytes, bytes]) -> None:
        """Encode segments together and cut their ids by the bytes of the tokens.

        A line feed, a token of its own, stands before those that do not begin with a blank.
        """
        skipped = [0 if s[0] in _FIRST and s.startswith(_BLANKS) else 4 for s in new]
        joined = [b"\n" + s if skip else s for s, skip in zip(new, skipped)]
        ends = np.cumsum([len(s) for s in joined], dtype=np.int64)
        first = done = 0
        while first < len(new):
            until = max(first + 1, int(np.searchsorted(ends, done + JOINED)))
            part = joined[first:until]
            ids = self._plain_ids(part) if plain else next(self._ids([b"".join(part)]))
            cuts = 4 * (np.searchsorted(np.cumsum(self.widths[ids]), ends[first:until] - done) + 1)
            body = ids.tobytes()
            for s, skip, (a, b) in zip(new[first:until], skipped[first:until], pairwise([0, *cuts.tolist()])):
                found[s] = body[a + skip:b]
            first, done = until, int(ends[until - 1])

    def _learn(self, new: list[bytes], found: dict[bytes, bytes]) -> None:
        """Encode segments: plain words by the model alone, others by the whole tokenizer, those that end blank singly."""
        plain, others, apart = [], [], []
        for s in new:
            if self.plain and _PLAIN.fullmatch(s):
                plain.append(s)
            elif s[-1] in _LAST and s.endswith(_BLANKS):
                apart.append(s)
            else:
                others.append(s)
        self._joined(plain, True, found)
        self._joined(others, False, found)
        found.update(zip(apart, (ids.tobytes() for ids in self._ids(apart))))

    def _cut(self, data: np.ndarray, starts: np.ndarray) -> np.ndarray:
        """Where segments begin in texts that begin at ``starts``."""
        mask = np.zeros(len(data), bool)
        np.not_equal(self.ends[data[:-1]] & self.begins[data[1:]], 0, out=mask[1:])
        at = np.flatnonzero(mask[1:] & (data[:-1] > 127)) + 1
        if len(at):  # behind a character of more bytes: blanks if it is not one itself, stops if it is a Latin letter
            lead, last = data[at - 2].astype(np.int64), data[at - 1].astype(np.int64)
            pair = lead << 8 | last
            blank = np.isin(pair, _WIDE) | np.isin(data[at - 3].astype(np.int64) << 16 | pair, _WIDE)
            latin = (lead >= 0xC3) & (lead <= 0xC8) & (pair != 0xC397) & (pair != 0xC3B7)
            mask[at] = np.where(self.begins[data[at]] & 1, ~blank, latin)
        mask[starts[starts < len(data)]] = True
        return np.flatnonzero(mask)

    def encode_all(self, texts: pa.Array) -> tuple[memoryview, np.ndarray]:
        """The ids of whole texts, one behind another, and the bytes where each text's begin and the last one's end."""
        texts = texts.fill_null("").cast(pa.large_binary())
        bounds = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset:texts.offset + len(texts) + 1]
        if not len(texts) or bounds[0] == bounds[-1]:
            return memoryview(b""), np.zeros(len(texts) + 1, np.int64)
        data = texts.buffers()[2].slice(int(bounds[0]), int(bounds[-1] - bounds[0]))
        bounds = bounds - bounds[0]
        at = self._cut(np.frombuffer(data, np.uint8), bounds[:-1])
        found = pa.LargeBinaryArray.from_buffers(
            pa.large_binary(), len(at), [None, pa.py_buffer(np.append(at, len(data))), data]).dictionary_encode()
        parts = found.dictionary.to_numpy(zero_copy_only=False).tolist()
        row = list(map(self.get, parts))
        if None in row:
            new = {s: self.before.get(s) for s, ids in zip(parts, row) if ids is None}
            self._learn([s for s, ids in new.items() if ids is None], new)
            row = [new[s] if ids is None else ids for s, ids in zip(parts, row)]
            short = {s: ids for s, ids in new.items() if len(s) <= LONGEST}
            self.update(short)
            self.size += _ENTRY * len(short) + sum(map(len, short)) + sum(map(len, short.values()))
            if self.size > KEPT // 2:  # the segments used since the last time stay within reach
                self.before = dict(self)
                self.clear()
                self.size = 0
        ids = pa.array(row, pa.large_binary()).take(found.indices)
        ends = np.frombuffer(ids.buffers()[1], np.int64)[:len(at) + 1]
        return memoryview(ids.buffers()[2]), ends[np.searchsorted(at, bounds)]

    def encode(self, text: str) -> bytes:
        """The ids of a whole text."""
        return bytes(self.encode_all(pa.array([text]))[0])


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The batches in pieces of about ``BLOCK`` bytes of text, one row at least."""
    for batch in batches:
        sizes = np.cumsum(pc.binary_length(batch.column(1)).fill_null(0).to_numpy(zero_copy_only=False), dtype=np.int64)
        start = 0
        while start < len(sizes):
            held = int(sizes[start - 1]) if start else 0
            until = max(start + 1, int(np.searchsorted(sizes, held + BLOCK)))
            yield batch.slice(start, until - start)
            start = until


def _pieces_of(model: str, capacity: int, end: int):
    """Full sequences and the tail of every document."""
    last = np.array([end], "<u4").tobytes()

    def scan(batches: Iterator[pa.RecordBatch]):
        gc.set_threshold(200_000)  # nothing here makes cycles, and long lists of segments are dear to walk
        segments = Segments(model)
        for part in _blocks(batches):
            doc_ids, columns = [], [[], [], [], []]
            body, ends = segments.encode_all(part.column(1))
            for at, (a, b) in enumerate(pairwise(ends.tolist())):
                ids = bytes(body[a:b]) + last
                n = len(ids) // 4
                for start in range(0, n, capacity):
                    doc_ids.append(at)
                    for column, value in zip(columns, (
                            start, min(capacity, n - start), n, ids[4 * start:4 * (start + capacity)])):
                        column.append(value)
            yield pa.RecordBatch.from_arrays(
                [part.column(0).take(pa.array(doc_ids, pa.int64())),
                 *(pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.int64(), pa.int64(), pa.binary())))],
                ["doc_id", "start", "length", "doc_tokens", "ids"])

    return scan


def capacities(tokens: int, capacity: int = CAPACITY) -> list[int]:
    """Full sequences and powers of two that together hold exactly so many tokens."""
    rest = tokens % capacity
    return [capacity] * (tokens // capacity) + [1 << b for b in reversed(range(rest.bit_length())) if rest >> b & 1]


def balance(lengths: list[int], capacity: int = CAPACITY, quadratic: float = QUADRATIC):
    """(document, start, length, sequence, offset) of every piece; the documents' lengths come in any order.

    Of equally long documents the one listed first goes first, of equally dear sequences the first.
    """
    sizes = capacities(sum(lengths), capacity)
    left, cost = np.array(sizes, np.int64), np.zeros(len(sizes))
    waiting = sorted((n, -i, 0) for i, n in enumerate(lengths) if n)  # the last goes first
    pieces = []
    while waiting:
        n, i, start = waiting.pop()
        open_ = np.flatnonzero(left >= n)
        if not len(open_):
            open_ = np.flatnonzero(left)
        at = int(open_[cost[open_].argmin()])
        took = min(n, int(left[at]))
        pieces.append((-i, start, took, at, sizes[at] - int(left[at])))
        left[at] -= took
        cost[at] += took + quadratic * took * took
        if took < n:
            insort(waiting, (n - took, i, start + took))
    return pieces


def pack(docs: DataFrame, model: str = MODEL, capacity: int = CAPACITY, end: int = END,
         quadratic: float = QUADRATIC, group: int = GROUP) -> DataFrame:
    """Pieces: doc_id, start, length, ids (little-endian unsigned 32-bit), doc_tokens, sequence_id, offset.

    ``capacity`` is a power of two. Sequence ids are unique but not dense.
    """
    if capacity & (capacity - 1):
        raise ValueError("the capacity must be a power of two")
    spark = docs.sparkSession
    id_type = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {id_type}, start long, length long, doc_tokens long, ids binary"
    # Rows are numbered in a written table: nothing is tokenized twice and a retried task finds the same numbers.
    pieces = written(docs.select("doc_id", "text").mapInArrow(_pieces_of(model, capacity, end), schema)
                     .withColumn("row", F.monotonically_increasing_id()), "pieces")
    full = pieces.where(F.col("length") == capacity).select(
        "doc_id", "start", "length", "ids", "doc_tokens", (2 * F.col("row")).alias("sequence_id"),
        F.lit(0).cast("long").alias("offset"))
    tails = pieces.where(F.col("length") < capacity)
    tokens = tails.agg(F.coalesce(F.sum("length"), F.lit(0))).first()[0]
    groups = max(1, -(-tokens // (group * capacity)))

    def fill(table: pa.Table) -> pa.Table:
        table = table.combine_chunks().sort_by("row")
        bases, bodies = table.column("start").to_pylist(), table.column("ids").to_pylist()
        names = ("document", "start", "length", "sequence", "offset")
        made = dict(zip(names, zip(*balance(table.column("length").to_pylist(), capacity, quadratic))))
        number = table.column("group")[0].as_py()
        rows = pa.array(made["document"], pa.int64())
        return pa.table({
            "doc_id": table.column("doc_id").take(rows),
            "start": pa.array([bases[d] + s for d, s in zip(made["document"], made["start"])], pa.int64()),
            "length": pa.array(made["length"], pa.int64()),
            "ids": pa.array([bodies[d][4 * s:4 * (s + n)] for d, s, n in zip(
                made["document"], made["start"], made["length"])], pa.binary()),
            "doc_tokens": table.column("doc_tokens").take(rows),
            "sequence_id": pa.array([2 * ((number << 32) + s) + 1 for s in made["sequence"]], pa.int64()),
            "offset": pa.array(made["offset"], pa.int64())})

    packed = tails.withColumn("group", F.pmod(F.xxhash64("row"), F.lit(groups))).groupBy("group").applyInArrow(
        fill, f"doc_id {id_type}, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long")
    return full.unionByName(packed)


def piece_checksums(docs: DataFrame) -> DataFrame:
    """The pieces with the crc32 of their ids."""
    return pack(docs).select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")
