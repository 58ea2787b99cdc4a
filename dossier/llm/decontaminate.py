"""Benchmark decontamination by pigeonhole edit matching.

Texts and items are lower-cased and their white space is made single blanks. An item of n characters may
differ by ``budget(n)`` edits, a tenth of it. It is split into one piece more than that, so any stretch of text
within the budget holds at least one piece exactly. An automaton finds all pieces in one pass over each text.

Pieces are short (``LEAST_PIECE`` characters or more, about ten) and many places hold one by chance, so they
stand in groups of two, or three for one group of an odd number. As the groups' sizes add up to one more than the budget,
some group has fewer edits than pieces, and so a piece without one. Of the halves of its other pieces, two a
piece, at least as many as there are other pieces are then untouched and stand within as many characters of their
place. Only such places are verified, with Myers' bit-parallel distance, and the best stretch of each item in each
text is returned; nothing within the budget is lost.

Items are read in blocks of about ``BLOCK_CHARS`` characters, dealt by a hash, so that what goes to the
driver and the tasks at once is bounded however many items there are; every text meets every block. The matches of
a block are written, and its items dropped from the tasks, before the next block is read.

Null and empty texts and items hold nothing; items shorter than ten characters must occur exactly.
Repeated text rows give repeated results, repeated item rows one. Ties go to the first stretch. Extra columns are
ignored by ``decontamination`` and kept by ``decontamination_stage``; an empty table gives no match.
"""

from __future__ import annotations

from collections.abc import Iterator

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from dossier.llm.common import slices, written

SHARE = 0.1
#: The shortest piece that the budget makes of an item with edits: half of ten characters.
LEAST_PIECE = 5
BLOCK_CHARS = 4_000_000


def plain(text: str) -> str:
    return " ".join(text.lower().split())


def budget(n: int) -> int:
    """Edits an item of n characters may differ by."""
    return int(n * SHARE)


def pieces(item: str, edits: int) -> list[tuple[int, str]]:
    """(offset, piece) of the item in edits + 1 pieces."""
    cuts = [len(item) * i // (edits + 1) for i in range(edits + 2)]
    return [(a, item[a:b]) for a, b in zip(cuts, cuts[1:])]


def halves(cut: list[tuple[int, str]], at: int) -> tuple[int, list[tuple[str, int, int]]]:
    """How many of the group's other pieces' halves a place of piece ``at`` needs, and for each (half, low, high):
    it must lie between these, counted from the place."""
    first = min(at // 2 * 2, max(0, len(cut) - 2 - len(cut) % 2))
    last = first + 2 if first + 2 < len(cut) - len(cut) % 2 else len(cut)
    others = [cut[i] for i in range(first, last) if i != at]
    found = []
    for offset, piece in others:
        middle = len(piece) // 2
        for part, start in ((piece[:middle], offset), (piece[middle:], offset + middle)):
            low = start - cut[at][0] - len(others)
            found.append((part, low, low + len(part) + 2 * len(others)))
    return len(others), found


def myers(pattern: str, text: str, most: int) -> tuple[int, int] | None:
    """(distance, end) of the best stretch of ``text`` for ``pattern``, the first of equals, or None."""
    n = len(pattern)
    masks: dict[str, int] = {}
    for i, c in enumerate(pattern):
        masks[c] = masks.get(c, 0) | 1 << i
    full, high = (1 << n) - 1, 1 << n - 1
    plus, minus, distance, best = full, 0, n, (min(n, most + 1), 0)
    for end, c in enumerate(text, 1):
        match = masks.get(c, 0)
        diagonal = (((match & plus) + plus) ^ plus) | match | minus
        up = minus | ~(diagonal | plus) & full
        down = plus & diagonal
        distance += (up & high > 0) - (down & high > 0)
        up, down = up << 1 & full, down << 1 & full
        plus, minus = down | ~(diagonal | up) & full, up & diagonal
        if distance < best[0]:
            best = (distance, end)
    return best if best[0] <= most else None


def stretch(item: str, text: str, most: int) -> tuple[int, int, int] | None:
    """(distance, start, end) of the best stretch: the end forwards, the start backwards from it."""
    got = myers(item, text, most)
    if got is None:
        return None
    distance, end = got
    low = max(0, end - len(item) - most)
    back = myers(item[::-1], text[low:end][::-1], distance)
    return distance, end - back[1] if back else low, end


class Finder:
    """The automaton over the pieces of one block of items."""

    def __init__(self, items: list[tuple[object, str]]):
        self.items, self.budgets = items, [budget(len(t)) for _, t in items]
        at: dict[str, list[tuple]] = {}
        for i, (_, item) in enumerate(items):
            cut = pieces(item, self.budgets[i])
            for j, (offset, piece) in enumerate(cut):
                at.setdefault(piece, []).append((i, offset, *halves(cut, j)))
        self.automaton = ahocorasick.Automaton()
        for piece, places in at.items():
            self.automaton.add_word(piece, (len(piece), places))
        self.automaton.make_automaton()

    def matches(self, text: str) -> list[tuple[int, int, int, int]]:
        """(item, distance, start, end) of every item found, its best stretch."""
        spots: dict[int, list[int]] = {}
        for end, (size, places) in self.automaton.iter(text):
            start = end + 1 - size
            for item, offset, need, near in places:
                for part, low, high in near:
                    if need and text.find(part, max(0, start + low), max(0, start + high)) >= 0:
                        need -= 1
                if not need:
                    spots.setdefault(item, []).append(start - offset)
        found = []
        for item, starts in spots.items():
            pattern, most, best = self.items[item][1], self.budgets[item], None
            starts = sorted(set(starts))
            while starts:  # starts that lie close together are one region
                last = 1
                while last < len(starts) and starts[last] - starts[last - 1] <= 2 * most + 1:
                    last += 1
                low = max(0, starts[0] - most)
                got = stretch(pattern, text[low:starts[last - 1] + len(pattern) + most], most)
                if got and (best is None or got[0] < best[0]):
                    best = (got[0], low + got[1], low + got[2])
                starts = starts[last:]
            if best:
                found.append((item, *best))
        return found


def item_blocks(items: DataFrame, block_chars: int = BLOCK_CHARS) -> Iterator[list[tuple[object, str]]]:
    """(item_id, plain text) of all items, in blocks of about ``block_chars`` characters, one at a time."""
    known = items.where("text IS NOT NULL").select("item_id", "text").distinct()
    total = known.agg(F.sum(F.length("text"))).first()[0] or 0
    blocks = max(1, -(-total // block_chars))
    for block in range(blocks):
        own = known.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == block).collect()
        found = sorted([(r["item_id"], p) for r in own if (p := plain(r["text"]))], key=lambda x: (str(x[0]), x[1]))
        if found:
            yield found


def decontamination(docs: DataFrame, items: DataFrame, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """doc_id, item_id, distance, start and end (in the plain text) of every item in every text.

    Clean documents have no row.
    """
    spark = docs.sparkSession
    kinds = [f"{c} {t.schema[c].dataType.simpleString()}" for t, c in ((docs, "doc_id"), (items, "item_id"))]
    id_kind = pa.int64() if "bigint" in kinds[1] else pa.int32() if "int" in kinds[1] else pa.string()
    schema = f"{kinds[0]}, {kinds[1]}, distance int, start int, end int"
    texts = docs.where("text IS NOT NULL").select("doc_id", "text")
    found = spark.createDataFrame([], schema)
    for block in item_blocks(items, block_chars):
        shared = spark.sparkContext.broadcast(block)

        def scan(batches, shared=shared):
            finder = Finder(shared.value)
            for part in slices(batches, 500):
                rows, got = [], []
                for i, text in enumerate(part.column(1).to_pylist()):
                    for match in finder.matches(plain(text)):
                        rows.append(i)
                        got.append(match)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0).take(pa.array(rows, pa.int64())),
                     pa.array([finder.items[m[0]][0] for m in got], id_kind),
                     *(pa.array([m[i] for m in got], pa.int32()) for i in (1, 2, 3))],
                    ["doc_id", "item_id", "distance", "start", "end"])

        found = found.unionByName(written(texts.mapInArrow(scan, schema), "matches"))
        shared.unpersist()
    return found


def decontamination_stage(docs: DataFrame, items: DataFrame, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """The rows of ``docs`` that hold no item: each block of items filters what the one before left."""
    schema, columns, at = docs.schema, docs.columns, docs.columns.index("text")
    left, shared = docs, None
    for block in item_blocks(items, block_chars):
        if shared is not None:  # the rows that the block before left
            left = written(left, "filtered")
            shared.unpersist()
        shared = docs.sparkSession.sparkContext.broadcast(block)

        def scan(batches, shared=shared):
            finder = Finder(shared.value)
            for part in slices(batches, 500):
                clean = [not (t and finder.matches(plain(t))) for t in part.column(at).to_pylist()]
                yield pa.RecordBatch.from_arrays(part.filter(pa.array(clean, pa.bool_())).columns, columns)

        left = left.mapInArrow(scan, schema)
    return left
