"""Language ID with hyperdimensional profiles.

Letters of a lower-cased text keep their code point; everything else between letters is one blank. Every
symbol has a random vector of +1 and -1 in ``DIMENSIONS`` dimensions, drawn from the code point as seed, so
all workers agree. A 3-gram binds its symbols by multiplying the first's vector rotated twice, the
second's rotated once and the third's; a document bundles (adds) its 3-grams' vectors, and a language's
prototype bundles those of its training documents. A document gets the language whose prototype has
the largest cosine (ties: the first in order of the name); ``score`` is that cosine, 0 if negative.

Texts that are null, empty or without a letter give ``und`` and 0, and so does every text when no
training document has a language. Null and repeated ids are rows like any other; extra columns are ignored
by ``identify`` and kept by ``language_stage``. An empty table gives an empty result.

``language_stage`` keeps what is closer to its language than noise. The cosine of unrelated vectors spreads by
1 / sqrt(DIMENSIONS), so ``LEAST_SCORE`` is four times that. Letter noise that shares 3-grams with a language
scores more, and more so the longer it is, as do clean texts; hence the cut lies half-way between ``LEAST_SCORE``
and the cosine that all but ``LOW`` of the labelled held-out rows of that language and ``band`` reach. A band is
the binary logarithm of how many different 3-grams the text amounts to, n^2 / |vector|^2 for n 3-grams. A band with
fewer than ``LEAST_ROWS`` such rows takes in the shorter ones below it; one without any has ``LEAST_SCORE``.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from dossier.llm.common import slices, written

DIMENSIONS = 1024
UNKNOWN = "und"
#: A document of the pipeline goes if its best cosine is below this, whatever its language and length.
LEAST_SCORE = 4 / DIMENSIONS ** 0.5
LOW = 0.01
LEAST_ROWS = 20
BANDS = 16
_BINS = 1000
_CHARS = 500_000
_GRAMS = 4096


class Alphabet:
    """Symbols of code points as this worker meets them, and their vectors in three rotations."""

    def __init__(self, dimensions: int):
        self.dimensions = dimensions
        self.of = np.full(0x110000, -1, np.int32)
        self.rows: list[np.ndarray] = []
        self.rotated: tuple[np.ndarray, ...] = ()
        self._add(32)

    def _add(self, code: int) -> None:
        self.of[code] = len(self.rows)
        self.rows.append(np.random.default_rng(code).integers(0, 2, self.dimensions, np.int8) * 2 - 1)

    def symbols(self, text: str) -> np.ndarray:
        """The text's symbols with a blank (0) before, after and between runs of letters; empty if it has none."""
        codes = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32)
        got = self.of[codes]
        if (got < 0).any():
            for code in np.unique(codes[got < 0]).tolist():
                if chr(code).isalpha():
                    self._add(code)
                else:
                    self.of[code] = 0
            got = self.of[codes]
        if not got.any():
            return np.empty(0, np.int32)
        got = np.concatenate(([0], got, [0]))
        return got[(got != 0) | np.concatenate(([True], got[:-1] != 0))]

    def vectors(self, grams: np.ndarray, bits: int) -> np.ndarray:
        """The vectors of packed 3-grams."""
        if not self.rotated or len(self.rotated[0]) < len(self.rows):
            table = np.stack(self.rows)
            self.rotated = tuple(np.roll(table, shift, axis=1) for shift in (2, 1, 0))
        mask = (1 << bits) - 1
        first, second, third = self.rotated
        bound = first[grams >> 2 * bits] * second[grams >> bits & mask] * third[grams & mask]
        return bound.astype(np.float32)


@lru_cache(1)
def _alphabet(dimensions: int) -> Alphabet:
    return Alphabet(dimensions)


def bundles(texts: list[str], groups: list[int], n: int, dimensions: int, sizes: np.ndarray | None = None) -> np.ndarray:
    """The sum of all 3-gram vectors of each of ``n`` groups of texts; their numbers are added to ``sizes``."""
    alphabet, total = _alphabet(dimensions), np.zeros((n, dimensions))
    held: list[tuple[int, np.ndarray]] = []
    size = 0

    def flush():
        nonlocal size
        if not held:
            return
        bits = max(1, (len(alphabet.rows) - 1).bit_length())
        grams = np.concatenate([
            s[:-2].astype(np.int64) << 2 * bits | s[1:-1].astype(np.int64) << bits | s[2:] for _, s in held])
        owner = np.repeat([g for g, _ in held], [len(s) - 2 for _, s in held])
        if 3 * bits <= 22:  # a small code space needs no sort
            found = np.flatnonzero(np.bincount(grams, minlength=1 << 3 * bits))
            place = np.zeros(1 << 3 * bits, np.int64)
            place[found] = np.arange(len(found))
            where = place[grams]
        else:
            found, where = np.unique(grams, return_inverse=True)
        for low in range(0, len(found), _GRAMS):
            part = found[low:low + _GRAMS]
            mine = (where >= low) & (where < low + len(part))
            counts = np.bincount(
                owner[mine] * len(part) + where[mine] - low, minlength=n * len(part))
            total[:] += counts.reshape(n, -1).astype(np.float32) @ alphabet.vectors(part, bits)
        held.clear()
        size = 0

    for text, group in zip(texts, groups):
        symbols = alphabet.symbols(text) if text else np.empty(0, np.int32)
        if sizes is not None:
            sizes[group] += max(0, len(symbols) - 2)
        for low in range(0, len(symbols) - 2, _CHARS):
            held.append((group, symbols[low:low + _CHARS + 2]))
            size += len(held[-1][1])
            if size >= _CHARS:
                flush()
    flush()
    return total


def held_out() -> F.Column:
    return F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))) % 4 == 2


def prototypes(docs: DataFrame, dimensions: int = DIMENSIONS) -> tuple[list[str], np.ndarray]:
    """The learned languages in order and the unit vector of each, from the rows with ``lang``.

    Each task adds up its documents; Spark adds up the tasks. The driver gets one vector per language.
    """
    def scan(batches):
        sums: dict[str, np.ndarray] = {}
        for part in slices(batches):
            langs = part.column(1).to_pylist()
            names = sorted(set(langs))
            got = bundles(part.column(0).to_pylist(), [names.index(x) for x in langs], len(names), dimensions)
            for name, vector in zip(names, got):
                sums[name] = sums.get(name, 0) + vector
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(sums), pa.string()),
             pa.array([v.tolist() for v in sums.values()], pa.list_(pa.float64()))], ["lang", "vector"])

    parts = docs.where("lang IS NOT NULL").select("text", "lang").mapInArrow(
        scan, "lang string, vector array<double>")
    rows = (
        parts.select("lang", F.posexplode("vector").alias("i", "x")).groupBy("lang", "i")
        .agg(F.sum("x").alias("x")).groupBy("lang")
        .agg(F.sort_array(F.collect_list(F.struct("i", "x"))).alias("v"))
        .select("lang", "v.x").orderBy("lang").collect())
    vectors = np.array([r["x"] for r in rows]).reshape(len(rows), dimensions)
    lengths = np.linalg.norm(vectors, axis=1)
    return ([r["lang"] for r, n in zip(rows, lengths) if n > 0],
            vectors[lengths > 0] / lengths[lengths > 0, None])


def _cosines(texts: list[str], names: list[str], vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The cosine of each text with each prototype, whether the text has a letter and there is a prototype, its band."""
    if not names:
        return np.zeros((len(texts), 1)), np.zeros(len(texts), bool), np.zeros(len(texts), np.int64)
    sizes = np.zeros(len(texts))
    own = bundles(texts, list(range(len(texts))), len(texts), vectors.shape[1], sizes)
    lengths = np.linalg.norm(own, axis=1)
    different = np.maximum(sizes, 1) ** 2 * vectors.shape[1] / np.maximum(lengths, 1e-9) ** 2
    band = np.clip(np.floor(np.log2(np.maximum(different, 1))), 0, BANDS - 1).astype(np.int64)
    return own @ vectors.T / np.maximum(lengths, 1e-9)[:, None], lengths > 0, band


def cuts(docs: DataFrame, names: list[str], vectors: np.ndarray, least: float = LEAST_SCORE) -> np.ndarray:
    """The least cosine of each language (rows) in each band, from the rows of ``docs`` with ``lang``.

    Spark counts cosines by language, band and thousandth; the driver gets at most so many counts.
    """
    def scan(batches):
        for part in slices(batches, 500):
            langs = part.column(1).to_pylist()
            cosine, known, band = _cosines(part.column(0).to_pylist(), names, vectors)
            rows = [i for i, lang in enumerate(langs) if known[i] and lang in names]
            own = np.array([names.index(langs[i]) for i in rows], np.int64)
            bins = np.clip(cosine[rows, own] * _BINS, 0, _BINS - 1).astype(np.int64)
            yield pa.RecordBatch.from_arrays(
                [pa.array(x.astype(np.int32)) for x in (own, band[rows], bins)], ["own", "band", "bin"])

    counts = np.zeros((len(names), BANDS, _BINS), np.int64)
    if names:
        for r in docs.where("lang IS NOT NULL").select("text", "lang").mapInArrow(
                scan, "own int, band int, bin int").groupBy("own", "band", "bin").count().collect():
            counts[r["own"], r["band"], r["bin"]] = r["count"]
    got = np.full((len(names), BANDS), least)
    for own, band in np.ndindex(*got.shape):
        low = band
        while low and counts[own, low:band + 1].sum() < LEAST_ROWS:
            low -= 1
        below = counts[own, low:band + 1].sum(axis=0).cumsum()
        if below[-1]:
            usual = np.flatnonzero(below > below[-1] * LOW)[0] / _BINS
            got[own, band] = max(least, (least + usual) / 2)
    return got


def identify(docs: DataFrame, dimensions: int = DIMENSIONS) -> DataFrame:
    """doc_id, held_out, lang_pred and score of every row, learned from the rows not held out."""
    docs = docs.select("doc_id", "text", "lang", held_out().alias("held_out"))
    names, vectors = prototypes(docs.where("NOT held_out"), dimensions)
    id_type = docs.schema["doc_id"].dataType.simpleString()

    def scan(batches):
        for part in slices(batches, 500):
            cosine, known, _ = _cosines(part.column(0).to_pylist(), names, vectors)
            best = cosine.argmax(axis=1)
            yield pa.RecordBatch.from_arrays(
                [part.column(1), part.column(2),
                 pa.array([names[b] if k else UNKNOWN for b, k in zip(best, known)], pa.string()),
                 pa.array(np.where(known, np.clip(cosine.max(axis=1), 0, 1), 0.0))],
                ["doc_id", "held_out", "lang_pred", "score"])

    return docs.select("text", "doc_id", "held_out").mapInArrow(
        scan, f"doc_id {id_type}, held_out boolean, lang_pred string, score double")


def language_stage(docs: DataFrame, least: float = LEAST_SCORE) -> DataFrame:
    """The rows of ``docs`` whose language is known with a score of at least ``least`` and the cut of its band."""
    names, vectors = prototypes(docs.where(~held_out()))
    levels = cuts(docs.where(held_out()), names, vectors, least)
    columns, at = docs.columns, docs.columns.index("text")

    def scan(batches):
        for part in slices(batches, 500):
            cosine, known, band = _cosines(part.column(at).to_pylist(), names, vectors)
            if names:
                known &= cosine.max(axis=1) >= levels[cosine.argmax(axis=1), band]
            stays = part.filter(pa.array(known, pa.bool_()))
            yield pa.RecordBatch.from_arrays(stays.columns, columns)

    return docs.mapInArrow(scan, docs.schema)
