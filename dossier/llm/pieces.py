"""SentencePiece encoding and decoding as a weighted finite-state transducer.

Three transducers are compiled from a model file. The normaliser puts a blank in front (where the model
asks for it) and writes every blank as ``▁``; only models with an identity character map are taken. The
pieces map a string to an id. Byte fallback maps a character that is no piece to the ids of its UTF-8 bytes.
Composed with an input they give a lattice; its shortest path in the tropical semiring is the encoding.

Weights: for a unigram model an arc weighs the piece's negative score. For a merge (BPE) model pieces weigh
nothing and a pair of neighbouring pieces weighs infinity where the merge order would have joined across
their border, so exactly one path is finite: the one that merging gives (checked against the sentencepiece
library in the tests). No piece goes on past a blank after another character, so an input falls into
segments whose shortest paths are independent; where no piece joins a Latin letter to another ASCII character
either, they are cut there too. A worker keeps the paths of recent segments, bounded by bytes. A walk looks no
further than the longest piece, and a long run of blanks repeats its longest piece (verified when compiled), so
the work is linear in a text of any kind.

A null text encodes like an empty one, to no ids. Every row gives a row; extra columns are ignored; an empty
table gives an empty result. Any text round-trips: decoding gives the text with ``▁`` read as a blank.
"""

from __future__ import annotations

import re
from heapq import heappop, heappush

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame, functions as F

from dossier.llm.common import slices

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
BLANK = "▁"
#: Bytes of segments and their paths that a worker keeps, the longest segment it keeps, and its pairs of pieces.
KEPT, LONGEST, PAIRS = 64 << 20, 64, 300_000
#: Bytes that an entry takes beside its own.
_ENTRY = 150
# Latin letters, and the other ASCII characters.
_LETTER, _OTHER = "A-Za-z\xc0-\xd6\xd8-\xf6\xf8-ɏ", "\x00-@\\[-`{-\x7f"
_SEGMENT = re.compile("▁*[^▁]+|▁+")
_FINE_SEGMENT = re.compile(
    f"▁*[{_LETTER}]+(?=[▁{_OTHER}]|\\Z)|▁*[{_OTHER}]+(?=[▁{_LETTER}]|\\Z)|▁*[^▁]+|▁+")
_MIXED = re.compile(f"[{_LETTER}][{_OTHER}]|[{_OTHER}][{_LETTER}]")


def _fields(data: bytes):
    """(number, value) of the fields of a protocol-buffer message."""
    at = 0

    def varint():
        nonlocal at
        value = shift = 0
        while True:
            byte = data[at]
            at += 1
            value |= (byte & 127) << shift
            shift += 7
            if byte < 128:
                return value

    while at < len(data):
        key = varint()
        kind = key & 7
        if kind == 0:
            yield key >> 3, varint()
        else:
            size = varint() if kind == 2 else 4 if kind == 5 else 8
            yield key >> 3, data[at:at + size]
            at += size


class Transducer:
    """The compiled model: arcs by string, ids of bytes, weights and the table of allowed pairs."""

    def __init__(self, model: str = MODEL):
        with open(model, "rb") as f:
            parts = list(_fields(f.read()))
        trainer = dict(_fields(next(v for k, v in parts if k == 2)))
        normaliser = dict(_fields(next(v for k, v in parts if k == 3)))
        if normaliser.get(2) or normaliser.get(4, 1):
            raise ValueError("only models with an identity normaliser that keeps blanks are supported")
        library = sentencepiece.SentencePieceProcessor(model_file=model)
        n = library.get_piece_size()
        special = [library.is_byte(i) or library.is_control(i) or library.is_unknown(i) or library.is_unused(i)
                   for i in range(n)]
        self._compile(
            [library.id_to_piece(i) for i in range(n)], [library.get_score(i) for i in range(n)], special,
            [i for i in range(n) if library.is_byte(i)], trainer.get(3, 1) == 2, bool(normaliser.get(3, 1)))

    def _compile(self, text: list[str], scores: list[float], special: list[bool], byte_ids: list[int],
                 merges: bool, prefix: bool) -> None:
        """Arcs and weights from the pieces; ``special`` ones (bytes, controls) are no arcs of their own."""
        self.text, self.merges, self.prefix = text, merges, prefix
        self.byte_ids = {int(text[i][3:5], 16): i for i in byte_ids}
        if len(self.byte_ids) != 256:
            raise ValueError("the model has no byte fallback")
        self.bytes = [b"" if s else t.replace(BLANK, " ").encode() for t, s in zip(self.text, special)]
        for value, i in self.byte_ids.items():
            self.bytes[i] = bytes([value])
        self.joined = np.frombuffer(b"".join(self.bytes), np.uint8)
        self.sizes = np.array([len(b) for b in self.bytes])
        self.starts = np.cumsum(self.sizes) - self.sizes
        self.ids = {t: i for i, (t, s) in enumerate(zip(self.text, special)) if not s}
        if any(BLANK in t.lstrip(BLANK) or (t[:2] == BLANK * 2 and t.strip(BLANK)) for t in self.ids):
            raise ValueError("a piece goes on past a blank")
        self.rank = {i: -scores[i] for i in self.ids.values()}
        # What a unigram model pays for a character that is no piece: more than for any piece.
        self.unknown = max(self.rank.values()) + 10
        self.longest = max(map(len, self.ids))
        self.segments = _SEGMENT if any(map(_MIXED.search, self.ids)) else _FINE_SEGMENT
        self.made: dict[int, tuple[int, int] | None] = {}
        self.when: dict[int, float] = {}
        if self.merges:
            self._merge_trees()
            self._blank_runs()
        else:
            self.made = dict.fromkeys(self.ids.values())
        self.tree: dict[str, tuple[int, dict]] = {}
        for i in sorted(self.made, key=lambda i: len(self.text[i])):
            arcs = self.tree
            for c in self.text[i][:-1]:
                arcs = arcs.setdefault(c, (-1, {}))[1]
            arcs[self.text[i][-1]] = (i, arcs.get(self.text[i][-1], (-1, {}))[1])

    def _merged(self, symbols: list[str], splits: bool = False):
        """The pieces that merging by rank, then leftmost, gives; the last pair merged if asked for."""
        last = None
        while len(symbols) > 1:
            best, at = float("inf"), -1
            for i in range(len(symbols) - 1):
                own = self.ids.get(symbols[i] + symbols[i + 1])
                if own is not None and self.rank[own] < best:
                    best, at = self.rank[own], i
            if at < 0:
                break
            last = (symbols[at], symbols[at + 1])
            symbols[at:at + 2] = [symbols[at] + symbols[at + 1]]
        return (symbols, last) if splits else symbols

    def _merge_trees(self) -> None:
        """The last pair that makes each piece and the time it is made; pieces that merging cannot make drop out."""
        for t, i in sorted(self.ids.items(), key=lambda x: len(x[0])):
            if len(t) == 1:
                self.made[i], self.when[i] = None, -1.0
                continue
            symbols, last = self._merged(list(t), True)
            if len(symbols) == 1 and all(self.ids.get(s) in self.made for s in last):
                pair = (self.ids[last[0]], self.ids[last[1]])
                self.made[i] = pair
                self.when[i] = max(self.rank[i], self.when[pair[0]], self.when[pair[1]])

    def _blank_runs(self) -> None:
        """What runs of blanks merge to, as far as they differ: beyond, the longest piece repeats in front."""
        self.widest = max([len(t) for t in self.ids if not t.strip(BLANK)], default=1)
        self.runs = [[self.ids[p] for p in self._merged([BLANK] * n)] if BLANK in self.ids else []
                     for n in range(4 * self.widest + 1)]
        front = [self.ids[BLANK * self.widest]] if BLANK in self.ids else []
        if any(self.runs[n] != front + self.runs[n - self.widest] for n in range(2 * self.widest, len(self.runs))):
            raise ValueError("runs of blanks do not repeat their longest piece")

    def blank_run(self, n: int) -> list[int]:
        """The pieces that ``n`` blanks merge to."""
        more = max(0, n // self.widest - 2)
        return self.runs[self.widest][:1] * more + self.runs[n - more * self.widest]

    def _edge(self, piece: int, side: int) -> list[tuple[int, float]]:
        """The pieces that stand at one end while ``piece`` is being made, and when each is merged away."""
        out, until = [], float("inf")
        while True:
            out.append((piece, until))
            if self.made[piece] is None:
                return out
            until, piece = self.when[piece], self.made[piece][side]

    def allowed(self, left: int, right: int) -> bool:
        """Whether merging leaves the border between two pieces alone."""
        for x, x_until in self._edge(left, 1):
            for y, y_until in self._edge(right, 0):
                own = self.ids.get(self.text[x] + self.text[y])
                if own is not None:
                    time = max(self.rank[own], self.when[x], self.when[y])
                    if time < x_until and time <= y_until:
                        return False
        return True


class Encoder(dict):
    """A worker's transducer with the shortest paths of recent segments."""

    def __init__(self, transducer: Transducer):
        super().__init__()
        self.t, self.pairs, self.before, self.size = transducer, {}, {}, 0

    def _shortest(self, s: str) -> tuple[int, ...]:
        """The shortest path through the lattice of one segment: the input walks the tree of pieces.

        Arcs wait with their cost, cheapest first and of equals the longest of the place reached last. A merge model's
        arcs weigh nothing or infinity, so its one finite path is found without walking all of the lattice.
        """
        t, n = self.t, len(s)
        tree, merges, pairs, longest = t.tree, t.merges, self.pairs, t.longest
        done, back, last = [False] * (n + 1), [0] * (n + 1), [-1] * (n + 1)
        waiting: list[tuple[float, int, int, int]] = []
        push, pop = (list.append, list.pop) if merges else (heappush, heappop)
        at, here, own = 0, 0.0, -1
        while at < n:
            done[at] = True
            arcs, end = tree, at
            if s[at] not in arcs or arcs[s[at]][0] < 0:  # byte fallback
                push(waiting, (here if merges else here + t.unknown, at, at + 1, -1))
            for c in s[at:at + longest]:
                step = arcs.get(c)
                if step is None:
                    break
                arc, arcs = step
                end += 1
                if arc >= 0 and not done[end]:
                    push(waiting, (0.0 if merges else here + t.rank[arc], at, end, arc))
            while True:
                here, start, at, own = pop(waiting)
                if done[at]:
                    continue
                before = last[start]
                if merges and before >= 0 and own >= 0:
                    pair = before << 32 | own
                    good = pairs.get(pair)
                    if good is None:
                        good = pairs[pair] = t.allowed(before, own)
                    if not good:
                        continue
                break
            back[at], last[at] = start, own
        ids: list[int] = []
        while n:
            start, own = back[n], last[n]
            if own >= 0:
                ids.append(own)
            else:
                ids += [t.byte_ids[b] for b in reversed(s[start:n].encode("utf-8", "replace"))]
            n = start
        return tuple(reversed(ids))

    def segment(self, s: str) -> tuple[int, ...]:
        """The path of a segment: blanks, then no blank. All blanks but the last only merge among themselves."""
        blanks = len(s) - len(s.lstrip(BLANK))
        if blanks < 2 or not self.t.merges:
            return self._shortest(s)
        rest = self._shortest(s[blanks - 1:])
        alone = rest[0] == self.t.ids.get(BLANK)
        run = self.t.blank_run(blanks if alone else blanks - 1)
        return tuple(run) + (rest[1:] if alone else rest)

    def __missing__(self, s: str) -> bytes:
        """The ids of a segment's path, as the bytes of 32-bit numbers."""
        got = self.before.get(s) or np.array(self.segment(s), np.int32).tobytes()
        if len(self.pairs) >= PAIRS:
            self.pairs.clear()
        if len(s) > LONGEST:
            return got
        if self.size > KEPT // 2:  # the segments used since the last time stay within reach
            self.before, self.size = dict(self), 0
            self.clear()
        self.size += _ENTRY + len(s) + len(got)
        self[s] = got
        return got

    def encode_bytes(self, text: str) -> bytes:
        """The ids of a text, as the bytes of 32-bit numbers."""
        if not text:
            return b""
        flat = text.replace(" ", BLANK)
        return b"".join(map(self.__getitem__, self.t.segments.findall(BLANK + flat if self.t.prefix else flat)))

    def encode(self, text: str) -> list[int]:
        return np.frombuffer(self.encode_bytes(text), np.int32).tolist()

    def decode_bytes(self, ids: np.ndarray) -> bytes:
        """The UTF-8 of all pieces, by their places in one string of all pieces."""
        sizes = self.t.sizes[ids]
        ends = np.cumsum(sizes)
        places = np.repeat(self.t.starts[ids] - ends + sizes, sizes) + np.arange(ends[-1] if len(ends) else 0)
        return self.t.joined[places].tobytes()

    def decode(self, ids: list[int]) -> str:
        text = self.decode_bytes(np.asarray(ids, np.int64)).decode("utf-8", "replace")
        return text[1:] if self.t.prefix and text[:1] == " " else text


def encode(docs: DataFrame, model: str = MODEL) -> DataFrame:
    """doc_id, ids, n_pieces, n_byte_pieces and round_trip (decoding gives the text back) of every row."""
    id_type = docs.schema["doc_id"].dataType.simpleString()
    shared = docs.sparkSession.sparkContext.broadcast(Transducer(model))

    def scan(batches):
        encoder = Encoder(shared.value)
        is_byte = np.zeros(len(encoder.t.text), bool)
        is_byte[list(encoder.t.byte_ids.values())] = True
        for part in slices(batches, 500):
            texts = [t or "" for t in part.column(1).to_pylist()]
            arrays = [np.frombuffer(encoder.encode_bytes(t), np.int32) for t in texts]
            lead = " " if encoder.t.prefix else ""
            whole = [encoder.decode_bytes(a) == (lead + t.replace(BLANK, " ") if t else "").encode()
                     for a, t in zip(arrays, texts)]
            ends = np.concatenate(([0], np.cumsum([len(a) for a in arrays]))).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [part.column(0), pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(arrays))),
                 pa.array(np.diff(ends).astype(np.int64)),
                 pa.array([int(is_byte[a].sum()) for a in arrays], pa.int64()), pa.array(whole, pa.bool_())],
                ["doc_id", "ids", "n_pieces", "n_byte_pieces", "round_trip"])

    return docs.select("doc_id", "text").mapInArrow(
        scan, f"doc_id {id_type}, ids array<int>, n_pieces long, n_byte_pieces long, round_trip boolean")


def decode(encoded: DataFrame, model: str = MODEL) -> DataFrame:
    """doc_id and the text of every row of ids; null ids give an empty text."""
    id_type = encoded.schema["doc_id"].dataType.simpleString()
    shared = encoded.sparkSession.sparkContext.broadcast(Transducer(model))

    def scan(batches):
        encoder = Encoder(shared.value)
        for part in slices(batches, 500):
            yield pa.RecordBatch.from_arrays(
                [part.column(0), pa.array([encoder.decode(i or []) for i in part.column(1).to_pylist()])],
                ["doc_id", "text"])

    return encoded.select("doc_id", "ids").mapInArrow(scan, f"doc_id {id_type}, text string")
