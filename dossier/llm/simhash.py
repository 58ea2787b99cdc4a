"""SimHash near-dedup with BK-trees.

Fingerprint: A-Z lower-cased, words ``[^\\x20\\x09-\\x0D]+``, shingles of ``k`` words with repeats (fewer
words: the whole sequence; none, null included: fingerprint zero). A bit is 1 if it is set in over half
of the shingles' XXH64 (seed 42). Two fingerprints link at ``max_bits`` or fewer differing bits.

Search: of ``max_bits + 1`` bands of the 64 bits at least one is equal in linked fingerprints, so the
distinct fingerprints are dealt to shards by a hash of each band, about ``SHARD`` to a shard. Every
shard is a BK-tree (a shard that grew too large is several), a row of a table: children are keyed by
their integer Hamming distance to the parent. The tree rows are joined to the query rows of the same
shard, by broadcast where Spark measures them small, else by a shuffle; a query follows only the edges
within ``max_bits`` of its distance to a node. A task joins what it links and gives a spanning forest
instead of all pairs, so a group of n fingerprints gives under n rows for each pair of trees.

Each row of the input gives a row; repeated rows, null ids and null texts included. ``component_id`` is
the smallest non-null doc_id of the group (null if there is none). Extra columns are ignored by
``near_duplicates`` and kept by ``dedup_stage``; an empty table gives an empty result.
"""

from __future__ import annotations

import itertools

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from dossier.llm.common import K1, K2, kept_columns, raw, row_keys, slices, written
from dossier.llm.components import components

SHINGLE = 3
MAX_BITS = 2
SHARD = 1024
_CHUNK = 1 << 16


def _fingerprint(text: bytes, k: int) -> int:
    words = text.lower().split()
    if not words:
        return 0
    shingles = map(b" ".join, zip(*(words[i:] for i in range(k)))) if len(words) >= k else [b" ".join(words)]
    total, ones = 0, np.zeros(64, np.int64)
    hashes = map(xxhash.xxh64_intdigest, shingles, itertools.repeat(42))
    while len(part := np.fromiter(itertools.islice(hashes, _CHUNK), np.uint64)):
        total += len(part)
        bits = np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int32)
    return int(np.packbits(2 * ones > total, bitorder="little").view(np.int64)[0])


def fingerprints(docs: DataFrame, k: int = SHINGLE) -> DataFrame:
    """doc_id, the row keys and fingerprint (the 64 bits as a long), one row per row of ``docs``."""
    id_type = docs.schema["doc_id"].dataType.simpleString()

    def scan(batches):
        for part in slices(batches):
            prints = pa.array([_fingerprint(t, k) for t in raw(part.column(3))], pa.int64())
            yield pa.RecordBatch.from_arrays(
                [part.column(0), part.column(1), part.column(2), prints], ["doc_id", K1, K2, "fingerprint"])

    return docs.select("doc_id", *row_keys(), "text").mapInArrow(
        scan, f"doc_id {id_type}, {K1} long, {K2} long, fingerprint long")


def build_tree(prints: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """parent and edge distance of each fingerprint of a BK-tree whose root is the first one."""
    n = len(prints)
    parent, edge = np.full(n, -1, np.int32), np.full(n, -1, np.int32)
    left, at = np.arange(1, n, dtype=np.int64), np.zeros(max(n - 1, 0), np.int64)
    while len(left):
        distance = np.bitwise_count(prints[left] ^ prints[at]).astype(np.int64)
        _, first, place = np.unique(at * 65 + distance, return_index=True, return_inverse=True)
        parent[left[first]], edge[left[first]] = at[first], distance[first]
        rest = np.ones(len(left), bool)
        rest[first] = False
        at, left = left[first][place][rest], left[rest]
    return parent, edge


def search_tree(prints, parent, edge, queries, radius) -> tuple[np.ndarray, np.ndarray]:
    """Positions (query, node) of all pairs within ``radius``; only edges within it are followed."""
    child = np.full((len(prints), 65), -1, np.int32)
    child[parent[1:], edge[1:]] = np.arange(1, len(prints), dtype=np.int32)
    who, node = np.arange(len(queries)), np.zeros(len(queries), np.int64)
    found: list[tuple[np.ndarray, np.ndarray]] = []
    while len(who):
        distance = np.bitwise_count(queries[who] ^ prints[node]).astype(np.int64)
        hit = distance <= radius
        found.append((who[hit], node[hit]))
        near = distance[:, None] + np.arange(-radius, radius + 1)
        below = child[node[:, None], np.clip(near, 0, 64)]
        row, column = np.nonzero((below >= 0) & (near >= 0) & (near <= 64))
        who, node = who[row], below[row, column].astype(np.int64)
    return (np.concatenate([f[0] for f in found]) if found else np.empty(0, np.int64),
            np.concatenate([f[1] for f in found]) if found else np.empty(0, np.int64))


def _forest(a: np.ndarray, b: np.ndarray) -> list[tuple[int, int]]:
    """Each value with the smallest value it is linked to, by union-find over the pairs."""
    up: dict[int, int] = {}

    def top(x):
        while (y := up.setdefault(x, x)) != x:
            up[x] = up[y]
            x = y
        return x

    for x, y in zip(a.tolist(), b.tolist()):
        x, y = top(x), top(y)
        if x != y:
            up[max(x, y)] = min(x, y)
    return [(x, top(x)) for x in list(up) if top(x) != x]


def _trees(prints: DataFrame, bits: int, shard: int) -> DataFrame:
    """band, shard, part and the tree (prints, parent, edge), one row per BK-tree."""
    n = max(1, -(-prints.count() // shard))
    cuts = [round(64 * i / (bits + 1)) for i in range(bits + 2)]
    value = F.array(*[
        F.shiftrightunsigned("fingerprint", lo).bitwiseAND((1 << (hi - lo)) - 1) if hi - lo < 64 else F.col("fingerprint")
        for lo, hi in itertools.pairwise(cuts)])
    dealt = (
        prints.select("fingerprint", F.posexplode(value).alias("band", "value"))
        .select("fingerprint", "band", F.pmod(F.xxhash64("band", "value"), F.lit(n)).alias("shard")))
    sizes = dealt.groupBy("band", "shard").agg(F.count("*").alias("size"))
    parts = F.ceil(F.col("size") / (2 * shard))
    dealt = dealt.join(sizes, ["band", "shard"]).withColumn(
        "part", F.pmod(F.xxhash64("fingerprint"), parts)).drop("size")

    def build(key, group):
        own = group["fingerprint"].to_numpy(np.int64).view(np.uint64)
        parent, edge = build_tree(own)
        return pd.DataFrame({"band": [key[0]], "shard": [key[1]], "part": [key[2]],
                             "prints": [own.tobytes()], "parent": [parent.tobytes()],
                             "edge": [edge.tobytes()]})

    return dealt.groupBy("band", "shard", "part").applyInPandas(
        build, "band int, shard long, part long, prints binary, parent binary, edge binary")


def fingerprint_links(prints: DataFrame, max_bits: int = MAX_BITS, shard: int = SHARD) -> DataFrame:
    """a and b: links that join the same fingerprints as all pairs within ``max_bits`` do.

    ``prints`` holds distinct fingerprints.
    """
    trees = written(_trees(prints, max_bits, shard), "bk-trees")
    queries = trees.select("band", "shard", F.col("part").alias("by"), F.col("prints").alias("queries"))
    met = trees.join(queries, ["band", "shard"]).where("by <= part").select(
        "prints", "parent", "edge", "queries")

    def search(batches):
        for batch in slices(batches, 1):
            own, parent, edge, asked = (batch.column(i)[0].as_py() for i in range(4))
            own, asked = np.frombuffer(own, np.uint64), np.frombuffer(asked, np.uint64)
            who, node = search_tree(
                own, np.frombuffer(parent, np.int32), np.frombuffer(edge, np.int32), asked, max_bits)
            links = _forest(asked[who].view(np.int64), own[node].view(np.int64))
            yield pa.RecordBatch.from_arrays(
                [pa.array([x for x, _ in links], pa.int64()), pa.array([y for _, y in links], pa.int64())],
                ["a", "b"])

    return met.mapInArrow(search, "a long, b long").distinct()


def grouped(docs: DataFrame, k: int = SHINGLE, max_bits: int = MAX_BITS) -> tuple[DataFrame, DataFrame]:
    """Fingerprints of the rows, and the root fingerprint of each linked fingerprint (node, root)."""
    marks = written(fingerprints(docs, k), "fingerprints")
    distinct = written(marks.select("fingerprint").distinct(), "distinct-fingerprints")
    return marks, components(fingerprint_links(distinct, max_bits))


def near_duplicates(docs: DataFrame, k: int = SHINGLE, max_bits: int = MAX_BITS) -> DataFrame:
    """doc_id, fingerprint (16 hex digits) and component_id of every row."""
    marks, roots = grouped(docs, k, max_bits)
    least = marks.groupBy("fingerprint").agg(F.min("doc_id").alias("least"))
    rooted = least.join(roots, F.col("fingerprint") == F.col("node"), "left").select(
        "fingerprint", F.coalesce("root", "fingerprint").alias("root"), "least")
    named = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    of = rooted.select("fingerprint", "root").join(named, "root").select("fingerprint", "component_id")
    return marks.select("doc_id", "fingerprint").join(of, "fingerprint").select(
        "doc_id", F.lower(F.lpad(F.hex("fingerprint"), 16, "0")).alias("fingerprint"), "component_id")


def dedup_stage(docs: DataFrame, k: int = SHINGLE, max_bits: int = MAX_BITS) -> DataFrame:
    """The columns of ``docs``, one document of each group: the smallest doc_id (null ids last)."""
    marks, roots = grouped(docs, k, max_bits)
    at = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", K1, K2)
    least = marks.groupBy("fingerprint").agg(F.min(at).alias("least"))
    stays = (
        least.join(roots, F.col("fingerprint") == F.col("node"), "left")
        .groupBy(F.coalesce("root", "fingerprint").alias("root")).agg(F.min("least").alias("least"))
        .select(f"least.{K1}", f"least.{K2}"))
    return kept_columns(docs, stays)
