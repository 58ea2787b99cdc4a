"""SimHash, its BK-trees and components, line dedup and substring dedup against brute force."""

import hashlib
import itertools
import random
from collections import Counter

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from dossier.llm import components, lines, simhash, substrings


def brute_print(text):
    words = (text or "").encode().lower().split()
    grams = [b" ".join(words[i:i + 3]) for i in range(len(words) - 2)] or ([b" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(g, 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_groups(prints, radius):
    """Smallest index reachable by links of at most ``radius`` bits."""
    up = list(range(len(prints)))

    def top(x):
        while up[x] != x:
            x = up[x]
        return x

    for i, j in itertools.combinations(range(len(prints)), 2):
        if (prints[i] ^ prints[j]).bit_count() <= radius:
            a, b = sorted((top(i), top(j)))
            up[b] = a
    return [top(i) for i in range(len(prints))]


@pytest.fixture(scope="module")
def near_docs(docs_of):
    rng = random.Random(5)
    texts = []
    for _ in range(60):
        words = [rng.choice("alpha beta gamma delta epsilon zeta Eta theta iota KAPPA".split()) + str(rng.randint(0, 50))
                 for _ in range(rng.randint(0, 80))]
        texts.append(" ".join(words))
        for _ in range(rng.randint(0, 3)):
            changed = list(words)
            if changed:
                changed[rng.randrange(len(changed))] = "changed"
            texts.append("  ".join(changed) if rng.random() < 0.5 else " ".join(words).upper())
    return docs_of([(3 * i % 1009, t) for i, t in enumerate(texts)])


def test_simhash_against_brute_force(near_docs):
    rows = sorted(((r["doc_id"], r["text"]) for r in near_docs.collect()))
    prints = [brute_print(t) for _, t in rows]
    want = {(d, f"{p:016x}", rows[g][0]) for (d, _), p, g in zip(rows, prints, brute_groups(prints, 2))}
    got = simhash.near_duplicates(near_docs)
    assert {tuple(r) for r in got.select("doc_id", "fingerprint", "component_id").collect()} == want


@pytest.mark.parametrize("radius", [0, 1, 2, 3, 5])
def test_links_join_what_all_pairs_join(spark, radius):
    rng = np.random.default_rng(radius)
    seeds = rng.integers(0, 2**63, 60, dtype=np.int64)
    prints = {0, -1}
    for s in seeds.tolist():
        for _ in range(12):
            prints.add(s)
            s ^= 1 << int(rng.integers(0, 63))
    prints = sorted(prints)
    df = spark.createDataFrame([(p,) for p in prints], "fingerprint long")
    links = simhash.fingerprint_links(df, radius, shard=16)  # small shards: several trees for one shard
    roots = {r["node"]: r["root"] for r in components.components(links).collect()}
    unsigned = [p & (2**64 - 1) for p in prints]
    want = [prints[g] for g in brute_groups(unsigned, radius)]
    assert [roots.get(p, p) for p in prints] == want
    assert all((a & (2**64 - 1)) != (b & (2**64 - 1)) for a, b in links.collect())


def test_tree_children_are_keyed_by_distance():
    prints = np.random.default_rng(1).integers(0, 2**63, 500, dtype=np.int64).view(np.uint64)
    parent, edge = simhash.build_tree(prints)
    assert parent[0] == -1 and len(set(zip(parent[1:].tolist(), edge[1:].tolist()))) == 499
    assert all(int(prints[i] ^ prints[parent[i]]).bit_count() == edge[i] for i in range(1, 500))
    who, node = simhash.search_tree(prints, parent, edge, prints ^ np.uint64(3), 2)
    assert {(a, a) for a in range(500)} <= set(zip(who.tolist(), node.tolist()))


def test_components_of_a_long_chain(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(300)] + [(500, 501), (7, 7)], "a long, b long")
    got = {r["node"]: r["root"] for r in components.components(links).collect()}
    assert got == {**dict.fromkeys(range(301), 0), 500: 500, 501: 500}


def brute_lines(rows):
    seen, gone = set(), {}
    for i, (_, text) in enumerate(rows):
        cut = text.split("\n")
        for s in range(len(cut) - 2):
            w = tuple(cut[s:s + 3])
            if all(not x.strip(" ") for x in w):
                continue
            if w in seen:
                gone.setdefault(i, set()).update((s, s + 1, s + 2))
            seen.add(w)
    return [(d, t.count("\n") + 1, len(gone.get(i, ())), "\n".join(
        x for j, x in enumerate(t.split("\n")) if j not in gone.get(i, ()))) for i, (d, t) in enumerate(rows)]


def test_lines_against_brute_force(docs_of):
    rng = random.Random(3)
    rows = [(i, "\n".join(rng.choice(["a", "b", "c", "", " ", "d e"]) for _ in range(rng.randint(1, 12)))) for i in range(80)]
    got = sorted(tuple(r) for r in lines.line_dedup(docs_of(rows)).collect())
    assert got == sorted(brute_lines(rows))


def test_lines_stage_keeps_first_occurrence_and_follows_length(docs_of):
    docs = docs_of([(2, "x\na\nb\nc\ny"), (1, "a\nb\nc"), (3, None)])
    out = {r["doc_id"]: (r["text"], r["n_chars"]) for r in lines.dedup_stage(docs).collect()}
    assert out == {1: ("a\nb\nc", 5), 2: ("x\ny", 3), 3: (None, None)}


def brute_substrings(rows, size):
    words = [(d, (t or "").encode().split()) for d, t in rows]
    count = Counter(tuple(w[i:i + size]) for _, w in words for i in range(len(w) - size + 1))
    out = []
    for d, w in words:
        gone = [False] * len(w)
        for i in range(len(w) - size + 1):
            if count[tuple(w[i:i + size])] > 1:
                gone[i:i + size] = [True] * size
        left = [x for x, g in zip(w, gone) if not g]
        out.append((d, len(w), len(w) - len(left), hashlib.sha256(b" ".join(left)).hexdigest()))
    return sorted(out)


@pytest.mark.parametrize("size,alphabet", [(35, 400), (35, 3), (8, 5), (8, 60), (3, 30)])
def test_substrings_against_brute_force(docs_of, size, alphabet):
    rng = random.Random(size * alphabet)
    words = [f"w{i}" for i in range(alphabet)]
    passages = [[rng.choice(words) for _ in range(n)] for n in (size - 1, size, size + 1, 2 * size, 5 * size, 300)]
    rows = []
    for i in range(70):
        text = [rng.choice(words) for _ in range(rng.randint(0, 120))]
        for _ in range(rng.randint(0, 3)):
            p = list(rng.choice(passages))
            if rng.random() < 0.3:
                p[rng.randrange(len(p))] = "edit"
            at = rng.randint(0, len(text))
            text[at:at] = p
        if rng.random() < 0.1:
            text = ["same"] * rng.randint(1, 3 * size)  # runs
        rows.append((i, " ".join(text)))
    got = sorted(tuple(r) for r in substrings.substring_dedup(docs_of(rows), size).select(
        "doc_id", "n_words", "n_removed", "kept_sha256").collect())
    assert got == brute_substrings(rows, size)


def test_substrings_where_keys_clash(docs_of, monkeypatch):
    """With two documents of one 64-bit key the longer key is taken; results stay the same."""
    same = " ".join(f"w{i % 50}" for i in range(90))
    docs = docs_of([(1, same), (2, "x " + same + " y"), (3, "other words"), (4, None)])
    want = sorted(tuple(r) for r in substrings.substring_dedup(docs).collect())
    first = F.lit(1).cast("long").alias(substrings.K1)
    second = substrings.row_keys()[1]
    monkeypatch.setattr(substrings, "row_keys", lambda: (first, second))
    assert substrings.keyed(docs).schema[substrings.KEY].dataType.simpleString() == "string"
    assert sorted(tuple(r) for r in substrings.substring_dedup(docs).collect()) == want


def test_windows_that_share_one_lane(spark):
    """Counted by both lanes: equal twice, sure once, and two unlike ones."""
    rows = [(1, 5, 7, 70), (2, 6, 7, 70), (3, 8, 7, 71), (4, 9, 8, 80), (5, -1, 8, 80), (6, 3, 9, 90), (7, 2, 4, 40), (8, 2, 4, 41)]
    df = spark.createDataFrame(rows, f"{substrings.KEY} long, start int, one long, two long")
    got = {r[0]: r["found"] for r in substrings.found_windows(df).collect()}
    assert got == {1: [5], 2: [6], 4: [9]}


def test_equal_windows_pick_equal_symbols():
    rng = random.Random(9)
    core = [b"c%d" % rng.randrange(200) for _ in range(60)]
    texts = [b" ".join([b"x%d" % rng.randrange(200) for _ in range(rng.randint(5, 40))] + core) for _ in range(20)]
    chunk = substrings.Chunk(texts, substrings._Names(), 35)
    by_window = {}
    for name, first, last in zip(chunk.name.tolist(), chunk.first.tolist(), chunk.last.tolist()):
        for at in range(first, last + 1):
            doc = int(chunk.doc[at])
            offset = int(at - chunk.base[doc] - chunk.counts[doc] + 60)
            if 0 <= offset <= 25:
                by_window.setdefault(offset, set()).add(name)
    assert len(by_window) == 26 and all(len(names) == 1 for names in by_window.values())


def test_groups_hold_a_third_of_the_rows(docs_of):
    same = "the same words again and again in very many documents of one source " * 4
    docs = docs_of([(i, same if i % 3 == 0 else f"word{i} other{i} third{i} " * 12) for i in range(300)])
    got = simhash.near_duplicates(docs).where("component_id = 0").count()
    assert got >= 100
    gone = substrings.substring_dedup(docs).where(F.col("doc_id") % 3 == 0).agg(F.min("n_removed")).first()[0]
    assert gone == 52
