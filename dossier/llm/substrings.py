"""Substring dedup by recompression.

Words are ``[^\\x20\\x09-\\x0D]+`` of the unchanged text (null: none). A window is ``size`` consecutive words of one
document; every word covered by a window whose words also start anywhere else, the same document included, is
removed, all windows being judged on the input.

Recompression: in each round a document's symbols (at first its words) are shortened twice: maximal runs of one
symbol get the name of (symbol, length), and of neighbours the pairs (left kind, right kind) the name of (a, b), the kind
being a bit of the symbol's name and the round. Names are hashes of their parts in two 64-bit lanes, so all tasks
give equal strings equal names without exchanging a dictionary. With each symbol goes the stretch of words that its
being made depends on; a symbol is *safe* in a window that holds that stretch: wherever else the window's words stand, the
symbol is there too.

Reveal: every window picks one of its safe symbols: one of four words or more where there is one, then the one that
depends on the fewest words, then the smallest name, then the leftmost. Neighbouring windows with the same pick are a
run, one row: name of the symbol, hash of the run's words, key of the document, place. Spark counts names and compares the
runs of a name. A name that stands once has no repeated window. A run that stands twice or more is repeated as a whole.
Verify: a run that stands once while its name has others, as at the borders of a copy, is open: each of its windows, and
those of one copy of every repeated run of that name, is a row with a 128-bit hash of its words, and Spark counts
those. Windows without a safe symbol are runs of their own.

Counting joins are on names and hashes; a name that very many documents hold is added up before the shuffle, and the join
back is an ordinary equi-join that Spark may split. Texts go through the shuffles compressed. Rows with equal id and text
are documents of their own and repeat each other. Texts shorter than a window lose nothing. Extra columns are ignored; an
empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame, functions as F

from dossier.llm.common import K1, K2, raw, row_keys, slices, written

KEY = "llm__key"

WINDOW = 35
#: Symbols of so many words are preferred: shorter ones stand in many unlike places.
LONG = 4
_CHUNK_BYTES = 1_500_000
_HELD = 200_000
_FAR = 1 << 40
# Odd constants of the scramble and of the two rolling sums.
_SALT = np.uint64(0x9E3779B97F4A7C15)
_BASES = (0xD1342543DE82EF95, 0xAF251AF3B0F025B5)


def _mixed(x: np.ndarray) -> np.ndarray:
    """A one-to-one scramble of 64-bit numbers."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class _Names(dict):
    """The two lanes of a word's name, as 16 bytes; bounded."""

    def __missing__(self, word: bytes) -> bytes:
        if len(self) >= _HELD:
            self.clear()
        got = self[word] = xxhash.xxh3_128_digest(word)
        return got


def _shift(x: np.ndarray, by: int, fill) -> np.ndarray:
    """``x`` one place on (the place before for by = 1, the next for by = -1)."""
    out = np.empty_like(x)
    if by > 0:
        out[1:], out[:1] = x[:-1], fill
    else:
        out[:-1], out[-1:] = x[1:], fill
    return out


def safe_symbols(one: np.ndarray, two: np.ndarray, doc: np.ndarray, size: int) -> tuple[np.ndarray, ...]:
    """name, start, end, low and high of all symbols made whose stretch [low, high) is ``size`` words or less.

    ``one`` and ``two`` are the lanes of the words' names, ``doc`` the documents' numbers; a border of a document counts as
    far away, as other words may stand there elsewhere.
    """
    start = np.arange(len(one))
    end, low, high = start + 1, start.copy(), start + 1
    found: list[tuple[np.ndarray, ...]] = []
    level = 0

    def keep(made):
        made &= (high - low <= size)
        if made.any():
            found.append((_mixed(one[made] ^ two[made]), start[made], end[made], low[made], high[made]))

    while len(one) and (high - low <= size).any():
        level += 1
        # Runs.
        other = np.ones(len(one), bool)
        other[1:] = (one[1:] != one[:-1]) | (two[1:] != two[:-1]) | (doc[1:] != doc[:-1])
        first = np.flatnonzero(other)
        last = np.append(first[1:], len(one)) - 1
        length = (last - first + 1).astype(np.uint64)
        # Being a whole run depends on the single symbols on either side being others.
        sides = low[np.maximum(first - 1, 0)], high[np.minimum(last + 1, len(one) - 1)]
        one, two, doc, start, end = one[first], two[first], doc[first], start[first], end[last]
        low, high = low[first], high[last]
        run = length > 1
        if run.any():
            one[run] = _mixed(one[run] ^ (length[run] * _SALT))
            two[run] = _mixed(two[run] + (length[run] * _SALT))
        left_edge = doc != _shift(doc, 1, -1)
        right_edge = doc != _shift(doc, -1, -1)
        low = np.where(left_edge, -_FAR, np.minimum(low, sides[0]))
        high = np.where(right_edge, _FAR, np.maximum(high, sides[1]))
        keep(run)
        # Pairs of a left kind and a right kind.
        turn = np.multiply(np.uint64(level), _SALT, dtype=np.uint64)
        right = (_mixed(one + np.full(1, turn)) >> np.uint64(17) & np.uint64(1)).astype(bool)
        head = np.zeros(len(one), bool)
        head[:-1] = ~right[:-1] & right[1:] & ~right_edge[:-1]
        body = _shift(head, 1, False)
        before = (_shift(low, 1, -_FAR), _shift(high, 1, _FAR))
        after = (_shift(low, -1, -_FAR), _shift(high, -1, _FAR))
        # A pair depends on both parts; a lone left kind on what follows it, a lone right kind on what precedes it.
        on_next, on_last = head | (~body & ~right), ~head & ~body & right
        low, high = (
            np.where(on_next, np.where(right_edge, -_FAR, np.minimum(low, after[0])),
                     np.where(on_last, np.where(left_edge, -_FAR, np.minimum(low, before[0])), low)),
            np.where(on_next, np.where(right_edge, _FAR, np.maximum(high, after[1])),
                     np.where(on_last, np.where(left_edge, _FAR, np.maximum(high, before[1])), high)))
        at = np.flatnonzero(head)
        one[at] = _mixed(_mixed(one[at] + _SALT) + one[at + 1] * np.uint64(3))
        two[at] = _mixed(_mixed(two[at] ^ _SALT) - two[at + 1] * np.uint64(5))
        end[at] = end[at + 1]
        rest = ~body
        one, two, doc, start, end, low, high, made = (
            x[rest] for x in (one, two, doc, start, end, low, high, head))
        keep(made.copy())
        if len(at) == 0 and not run.any() and level > 200:
            break  # documents of one symbol each
    return tuple(np.concatenate(x) for x in zip(*found)) if found else tuple(
        np.empty(0, t) for t in (np.uint64, np.int64, np.int64, np.int64, np.int64))


def stretch_hashes(one: np.ndarray, two: np.ndarray, start: np.ndarray, end: np.ndarray):
    """Two lanes of the hash of the words [start, end), by rolling sums over the lanes of the words' names."""
    out = []
    for lane, base in zip((one, two), _BASES):
        n = len(lane)
        power, back = np.ones(n + 1, np.uint64), np.ones(n + 1, np.uint64)
        np.multiply.accumulate(np.full(n, base, np.uint64), out=power[1:])
        np.multiply.accumulate(np.full(n, pow(base, -1, 1 << 64), np.uint64), out=back[1:])
        total = np.zeros(n + 1, np.uint64)
        np.cumsum(lane * power[:n], out=total[1:])
        out.append(_mixed((total[end] - total[start]) * back[start]))
    return out


def window_hashes(lanes: np.ndarray, windows: np.ndarray, size: int):
    return stretch_hashes(lanes[:, 0].copy(), lanes[:, 1].copy(), windows, windows + size)


class Chunk:
    """Some documents: their words, and the runs of windows with one pick."""

    def __init__(self, texts: list[bytes], names: _Names, size: int):
        self.words = [t.split() for t in texts]
        self.counts = np.array([len(w) for w in self.words], np.int64)
        self.base = np.cumsum(self.counts) - self.counts
        lanes = np.frombuffer(
            b"".join(b"".join(map(names.__getitem__, w)) for w in self.words), np.uint64).reshape(-1, 2)
        self.size, n = size, len(lanes)
        self.doc = np.repeat(np.arange(len(texts)), self.counts)
        one, two = lanes[:, 0].copy(), lanes[:, 1].copy()
        self._runs(one, two)

    def _runs(self, one: np.ndarray, two: np.ndarray) -> None:
        """name, words (hash), first and last window of every run."""
        size, n = self.size, len(one)
        has = np.zeros(n, bool)
        has[:max(n - size + 1, 0)] = self.doc[:max(n - size + 1, 0)] == self.doc[size - 1:]
        windows = np.flatnonzero(has)
        name, start, end, low, high = safe_symbols(one, two, self.doc, size) if len(windows) else (
            np.empty(0, np.uint64), *(np.empty(0, np.int64),) * 4)
        # Symbols in rising order of preference; every window keeps the highest place among its safe ones.
        order = np.lexsort((-start, ~name, low - high, np.minimum(end - start, LONG)))
        name, start, low, high = (x[order] for x in (name, start, low, high))
        first = np.maximum(high - size, 0)
        reach = np.maximum(low - first + 1, 0)
        pick = np.full(n, -1, np.int64)
        place = np.repeat(np.arange(len(name)), reach)
        spot = np.arange(len(place)) - np.repeat(np.cumsum(reach) - reach, reach) + np.repeat(first, reach)
        np.maximum.at(pick, spot, place)
        pick = pick[windows]
        new = np.ones(len(windows), bool)
        new[1:] = (pick[1:] != pick[:-1]) | (pick[1:] < 0) | (np.diff(windows) != 1)
        heads = np.flatnonzero(new)
        self.first = windows[heads]
        self.last = windows[np.append(heads[1:], len(windows)) - 1] if len(heads) else windows
        chosen = pick[heads]
        whole, second = stretch_hashes(one, two, self.first, self.last + size)
        if len(name):
            offset = (self.first - start[chosen]).astype(np.uint64)
            self.name = np.where(chosen >= 0, name[chosen], second)
            self.run = np.where(chosen >= 0, _mixed(whole + offset * _SALT), whole)
        else:
            self.name, self.run = second, whole


def chunks(batches: Iterator[pa.RecordBatch], text: int) -> Iterator[pa.RecordBatch]:
    """The batches in pieces of about ``_CHUNK_BYTES`` bytes of text, a document at least."""
    for batch in slices(batches, 1000):
        sizes = np.array([len(t) for t in raw(batch.column(text))])
        group = np.cumsum(sizes) // _CHUNK_BYTES
        cuts = [0, *(np.flatnonzero(np.diff(group)) + 1).tolist(), len(sizes)]
        for a, b in zip(cuts, cuts[1:]):
            if b > a:
                yield batch.slice(a, b - a)


def run_rows(docs: DataFrame, size: int = WINDOW) -> DataFrame:
    """name, run (hash of the run's words), the document's key and place of every run.

    The place packs the first window, the number of windows and two bits for the kind that ``facts_of`` finds.
    """
    def scan(batches):
        names = _Names()
        for part in chunks(batches, 1):
            chunk = Chunk(raw(part.column(1)), names, size)
            owner = chunk.doc[chunk.first]
            yield pa.RecordBatch.from_arrays(
                [pa.array(chunk.name.view(np.int64)), pa.array(chunk.run.view(np.int64)),
                 part.column(0).take(pa.array(owner)),
                 pa.array((chunk.first - chunk.base[owner]) << 20 | (chunk.last - chunk.first + 1) << 2)],
                ["name", "run", KEY, "place"])

    return docs.select(KEY, "text").mapInArrow(
        scan, f"name long, run long, {KEY} {_type(docs, KEY)}, place long")


def _type(df: DataFrame, column: str) -> str:
    return df.schema[column].dataType.simpleString()


def keyed(docs: DataFrame) -> DataFrame:
    """doc_id, text and a key of both: 64 bits where no two documents share them, else all 128 as text."""
    docs = docs.select("doc_id", "text", *row_keys())
    unlike = docs.groupBy(K1).agg(F.min(K2).alias("a"), F.max(K2).alias("b")).where("a <> b")
    key = F.concat_ws(":", K1, K2) if unlike.limit(1).count() else F.col(K1)
    return docs.select("doc_id", "text", key.alias(KEY))


SURE, OPEN, COPY = 0, 1, 2


def facts_of(runs: DataFrame) -> DataFrame:
    """Per document the places and kinds of its runs that may repeat.

    Kinds: ``SURE`` stands twice or more; ``OPEN`` stands once, its name more often; ``COPY`` is the one of the sure runs
    of a name with open ones that shows its windows.
    """
    names = (
        runs.groupBy("name").agg(F.count("*").alias("all"), F.min("run").alias("a"), F.max("run").alias("b"))
        .where(F.col("all") > 1).select("name", (F.col("a") != F.col("b")).alias("unlike")))
    # A written side lets Spark split the rows of a name that very many documents hold.
    shared = written(runs.join(written(names, "shared-names"), "name"), "shared-runs")
    at = F.struct(KEY, "place")
    mixed = shared.where("unlike")
    variants = written(mixed.groupBy("name", "run").agg(
        F.count("*").alias("times"), F.min(at).alias("copy")), "run-variants")
    kind = F.when(F.col("times") == 1, OPEN).when(F.col("copy") == at, COPY).otherwise(SURE)
    judged = mixed.join(variants, ["name", "run"]).select(KEY, (F.col("place") + kind).alias("place"))
    sure = shared.where("NOT unlike").select(KEY, "place")
    return sure.unionByName(judged).groupBy(KEY).agg(F.collect_list("place").alias("facts"))


def _digest(words: list[bytes], gone: np.ndarray) -> tuple[int, str]:
    """Words removed and the SHA-256 of the rest."""
    left = [w for w, g in zip(words, gone.tolist()) if not g] if gone.any() else words
    return len(words) - len(left), hashlib.sha256(b" ".join(left)).hexdigest()


def _covered(starts: np.ndarray, ends: np.ndarray, n: int) -> np.ndarray:
    """Which of n words lie in a stretch [start, end)."""
    edges = np.zeros(n + 1, np.int64)
    np.add.at(edges, starts, 1)
    np.add.at(edges, ends, -1)
    return np.cumsum(edges)[:n] > 0


def packed_texts(docs: DataFrame) -> DataFrame:
    """The rows with their text compressed."""

    def scan(batches):
        pack = zstandard.ZstdCompressor(level=5).compress
        for part in slices(batches, 500):
            yield pa.RecordBatch.from_arrays(
                [*part.columns[:2], pa.array(list(map(pack, raw(part.column(2)))), pa.binary())],
                [KEY, "doc_id", "packed"])

    return docs.select(KEY, "doc_id", "text").mapInArrow(
        scan, f"{KEY} {_type(docs, KEY)}, doc_id {_type(docs, 'doc_id')}, packed binary")


def judged(docs: DataFrame, facts: DataFrame, size: int = WINDOW) -> DataFrame:
    """Every row with its result where the runs decide, else its packed text and the words surely gone; shown windows.

    ``starts`` has -1 for a window that is known to repeat.
    """

    def one_document(words: list[bytes], facts: np.ndarray, names: _Names):
        first, n, kind = facts >> 20, facts >> 2 & 0x3FFFF, facts & 3
        sure = kind != OPEN
        gone = _covered(first[sure], first[sure] + n[sure] - 1 + size, len(words))
        show = kind != SURE
        if not show.any():
            return gone, None
        first, n = first[show], n[show]
        windows = np.repeat(first - np.cumsum(n) + n, n) + np.arange(n.sum())
        lanes = np.frombuffer(b"".join(map(names.__getitem__, words)), np.uint64).reshape(-1, 2)
        one, two = window_hashes(lanes, windows, size)
        starts = np.where(np.repeat(kind[show] == OPEN, n), windows, -1).astype(np.int32)
        return gone, (starts, one.view(np.int64), two.view(np.int64))

    def scan(batches):
        names, unpack = _Names(), zstandard.ZstdDecompressor().decompress
        for part in slices(batches, 200):
            out = []
            for packed, facts in zip(part.column(2).to_pylist(), part.column(3)):
                words = unpack(packed).split()
                if not facts.is_valid:
                    out.append((len(words), *_digest(words, np.zeros(0, bool)), *(None,) * 5))
                    continue
                gone, shown = one_document(words, np.asarray(facts.values, np.int64), names)
                waits = shown is not None and (shown[0] >= 0).any()
                out.append((
                    len(words), *((None, None) if waits else _digest(words, gone)), packed if waits else None,
                    np.packbits(gone).tobytes() if waits else None, *(shown or (None,) * 3)))
            kinds = (pa.int64(), pa.int64(), pa.string(), pa.binary(), pa.binary(), pa.list_(pa.int32()),
                     pa.list_(pa.int64()), pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays(
                [*part.columns[:2], *(pa.array([o[i] for o in out], t) for i, t in enumerate(kinds))],
                [KEY, "doc_id", "n_words", "n_removed", "kept_sha256", "packed", "gone", "starts", "one", "two"])

    return packed_texts(docs).join(facts, KEY, "left").select(KEY, "doc_id", "packed", "facts").mapInArrow(
        scan, f"{KEY} {_type(docs, KEY)}, doc_id {_type(docs, 'doc_id')}, n_words long, n_removed long, kept_sha256 string, "
              "packed binary, gone binary, starts array<int>, one array<long>, two array<long>")


def found_windows(windows: DataFrame) -> DataFrame:
    """Per document the open windows that stand twice or are known to; counted by one lane, the other checked."""
    weight = F.sum(F.when(F.col("start") < 0, 2).otherwise(1)).alias("weight")
    counted = written(
        windows.groupBy("one").agg(weight, F.min("two").alias("two"), F.max("two").alias("other"))
        .where("weight > 1"), "counted-windows")
    shown = windows.where("start >= 0")
    found = shown.select(KEY, "start", "one").join(counted.where("two = other").select("one"), "one")
    clash = counted.where("two <> other").select("one")
    if clash.limit(1).count():  # unlike windows that share a lane: rare to the point of never, counted by both
        both = windows.join(clash, "one", "left_semi").groupBy("one", "two").agg(weight).where("weight > 1")
        found = found.select(KEY, "start").unionByName(
            shown.join(both.select("one", "two"), ["one", "two"]).select(KEY, "start"))
    return found.groupBy(KEY).agg(F.collect_set("start").alias("found"))


def substring_dedup(docs: DataFrame, size: int = WINDOW) -> DataFrame:
    """doc_id, n_words, n_removed and kept_sha256 of every row."""
    docs = keyed(docs)
    table = written(judged(docs, facts_of(written(run_rows(docs, size), "runs")), size), "judged")
    windows = table.where("starts IS NOT NULL").select(
        KEY, F.explode(F.arrays_zip("starts", "one", "two")).alias("w")).select(
        KEY, F.col("w.starts").alias("start"), F.col("w.one").alias("one"), F.col("w.two").alias("two"))
    found = found_windows(windows)

    def scan(batches):
        unpack = zstandard.ZstdDecompressor().decompress
        for part in slices(batches, 200):
            results = []
            for packed, gone, starts in zip(*(part.column(i).to_pylist() for i in (2, 3, 4))):
                words = unpack(packed).split()
                starts = np.array(starts or [], np.int64)
                own = np.unpackbits(np.frombuffer(gone, np.uint8), count=len(words)).astype(bool)
                results.append(_digest(words, own | _covered(starts, starts + size, len(words))))
            yield pa.RecordBatch.from_arrays(
                [part.column(0), part.column(1), pa.array([n for n, _ in results], pa.int64()),
                 pa.array([d for _, d in results], pa.string())], ["doc_id", "n_words", "n_removed", "kept_sha256"])

    waiting = table.where("packed IS NOT NULL").select(KEY, "doc_id", "n_words", "packed", "gone").join(
        found, KEY, "left").select("doc_id", "n_words", "packed", "gone", "found").mapInArrow(
        scan, f"doc_id {_type(docs, 'doc_id')}, n_words long, n_removed long, kept_sha256 string")
    return table.where("packed IS NULL").select(
        "doc_id", "n_words", "n_removed", "kept_sha256").unionByName(waiting)
