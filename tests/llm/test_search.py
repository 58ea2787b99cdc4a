"""License scan, decontamination and piece encoding against brute force and the library."""

import random
import re

import pytest
import sentencepiece
from pyspark.sql import functions as F

from dossier.llm import decontaminate, license, pieces


def brute_base(text):
    low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)
    places = []
    for phrase, label in license.BASE:
        own = phrase.split()
        places += [(i, label) for i in range(len(words)) if words[i:i + len(own)] == own]
    at = [i for i, _ in places]
    return (len(words), len(at), min(at, default=None), max(at, default=None), ",".join(sorted({x for _, x in places})))


def test_base_phrases_against_brute_force(docs_of):
    rng = random.Random(11)
    parts = ["GNU", "General", "public", "LICENSE", "apache", "Apache License", "CC", "by", "cc-by", "MIT", "mit license",
             "of", "the", "é", "4.0", "K", "İ", "gnu general public license", "x_y", "\n"]
    rows = [(i, " ".join(rng.choice(parts) for _ in range(rng.randint(0, 40)))) for i in range(150)] + [(150, None), (151, "")]
    got = license.license_scan(docs_of(rows)).collect()
    want = {i: brute_base(t) for i, t in rows}
    for r in got:
        assert (r["n_words"], r["n_base"], r["first_word"], r["last_word"], r["base_labels"]) == want[r["doc_id"]]
        assert set(filter(None, r["base_labels"].split(","))) <= set(r["labels"].split(","))
        assert 0 <= r["score"] <= 1


def test_diagonals_stand_small_changes(docs_of):
    full = "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files"
    docs = docs_of([(1, f"Start here. {full}."), (2, full.replace("free of charge", "freely and of charge")),
                    (3, "permission is granted and a copy of this is any person"), (4, "Released under the MIT License.")])
    got = {r["doc_id"]: r for r in license.license_scan(docs).collect()}
    assert got[1]["labels"] == got[2]["labels"] == "mit-notice" and got[1]["score"] == 1 and 0.7 < got[2]["score"] < 1
    assert got[1]["matches"][0]["start"] == 2 and got[1]["matches"][0]["end"] == 22
    assert got[3]["labels"] == "" and got[3]["score"] == 0
    assert got[4]["labels"] == "mit,mit-notice" and got[4]["base_labels"] == "mit"


def test_a_replaced_word_costs_one_word(docs_of):
    """Every template is found with any one inner word replaced that does not decide, and not with one that does."""
    rows, want = [], {}
    for phrase, label, deciding in license.TEMPLATES:
        words = phrase.split()
        for i in range(1, len(words) - 1):
            d = len(rows)
            rows.append((d, "so it is " + " ".join(words[:i] + ["qqq"] + words[i + 1:]) + " and more"))
            kept = {j for j in range(len(words)) if j != i}
            alone = {j for j in kept if j - 1 not in kept and j + 1 not in kept}  # no 2-gram left: one word at either end
            kept -= alone | ({0} if i == 1 else set()) | ({len(words) - 1} if i == len(words) - 2 else set())
            own = len(kept) / len(words) >= license.LEAST and all(phrase.split().index(w) in kept for w in deciding.split())
            want[d] = (label, own)
    got = {r["doc_id"]: r["labels"].split(",") for r in license.license_scan(docs_of(rows)).collect()}
    others = {d: {x for p, x, _ in license.TEMPLATES if p in t} for d, t in rows}
    for d, (label, own) in want.items():
        if label not in others[d]:
            assert (label in got[d]) == own, rows[d]
    named = docs_of([(1, "Licensed under the Apache Licence, Version 2.0"), (2, "released under an MIT license"),
                     (3, "licensed under CC BY-SA 4.0"), (4, "the GNU General Public License, version 3")])
    got = {r["doc_id"]: r["labels"] for r in license.license_scan(named).collect()}
    assert got == {1: "apache-2.0", 2: "mit,mit-notice", 3: "cc-by,cc-by-sa-4.0", 4: "gpl,gpl-3.0"}


def test_scan_runs_no_python(docs_of):
    plan = license.license_scan(docs_of(["a b"]))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan


def distances(item, text):
    """Least edits between the item and any stretch of the text, by the plain recurrence."""
    row = [0] * (len(text) + 1)
    for i, c in enumerate(item, 1):
        new = [i]
        for j, d in enumerate(text, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (c != d)))
        row = new
    return min(row)


def test_myers_against_the_recurrence():
    rng = random.Random(1)
    for _ in range(300):
        item = "".join(rng.choice("abc") for _ in range(rng.randint(1, 70)))
        text = "".join(rng.choice("abc") for _ in range(rng.randint(0, 90)))
        want = distances(item, text)
        assert decontaminate.myers(item, text, len(item))[0] == want if want <= len(item) else True
        got = decontaminate.stretch(item, text, len(item))
        assert distances(item, text[got[1]:got[2]]) == want


def test_matches_against_brute_force(spark, docs_of):
    rng = random.Random(7)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 8)))
    items = [(i, " ".join(word() for _ in range(rng.randint(1, 30)))) for i in range(12)]
    rows = []
    for i in range(60):
        text = [word() for _ in range(rng.randint(0, 60))]
        if rng.random() < 0.6:
            chosen = list(rng.choice(items)[1])
            for _ in range(rng.randint(0, 20)):
                at = rng.randrange(len(chosen))
                chosen[at:at + rng.randint(0, 1)] = rng.choice(["", "x", "yy"])
            text.insert(rng.randint(0, len(text)), "".join(chosen).upper())
        rows.append((i, " \n".join(text)))
    table = spark.createDataFrame(items, "item_id long, text string")
    want = set()
    for d, t in rows:
        for i, item in items:
            best = distances(decontaminate.plain(item), decontaminate.plain(t))
            if best <= decontaminate.budget(len(decontaminate.plain(item))):
                want.add((d, i, best))
    for block in (4_000_000, 200):  # one block, several blocks
        got = decontaminate.decontamination(docs_of(rows), table, block)
        assert {(r["doc_id"], r["item_id"], r["distance"]) for r in got.collect()} == want
        left = decontaminate.decontamination_stage(docs_of(rows), table, block)
        assert {r["doc_id"] for r in left.collect()} == {d for d, _ in rows} - {d for d, _, _ in want}
    assert len(want) > 10


def test_a_tenth_of_an_item_may_differ(spark, docs_of):
    """Items of all lengths with as many edits as a tenth of their characters, and one more, by the plain recurrence."""
    rng = random.Random(12)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(rng.randint(2, 8)))
    sizes = [10, 11, 15, 19, 20, 23, 30, 45, 70, 95, 120, 233]
    items = [(i, (" ".join(word() for _ in range(90)))[:n].strip().ljust(n, "z")) for i, n in enumerate(sizes)]
    rows = []
    for i, item in items:
        for edits in {1, len(item) // 10 - 1, len(item) // 10, len(item) // 10 + 1}:
            for _ in range(2):
                chosen = list(item)
                for _ in range(edits):
                    at = rng.randrange(1, len(chosen) - 1)
                    chosen[at:at + rng.randint(0, 1)] = rng.choice(["", "x", "y"])
                rows.append((len(rows), f"{word()} {''.join(chosen)} {word()}"))
    replaced = items[9][1][:40] + "qqqqqqqq" + items[9][1][48:]
    rows.append((len(rows), replaced))
    want = {(d, i, best) for d, t in rows for i, item in items
            if (best := distances(decontaminate.plain(item), decontaminate.plain(t))) <= len(item) // 10}
    assert any(d == len(rows) - 1 and 7 <= best <= 9 for d, _, best in want)
    table = spark.createDataFrame(items, "item_id long, text string")
    got = decontaminate.decontamination(docs_of(rows), table)
    assert {(r["doc_id"], r["item_id"], r["distance"]) for r in got.collect()} == want


def test_pieces_of_an_item_are_more_than_its_budget():
    for n in range(1, 400):
        edits = decontaminate.budget(n)
        cut = decontaminate.pieces("x" * n, edits)
        assert len(cut) == edits + 1 and sum(len(p) for _, p in cut) == n
        assert edits == 0 or min(len(p) for _, p in cut) >= decontaminate.LEAST_PIECE


@pytest.fixture(scope="module")
def encoder():
    return pieces.Encoder(pieces.Transducer())


def test_encoding_equals_the_library(encoder):
    library = sentencepiece.SentencePieceProcessor(model_file=pieces.MODEL)
    rng = random.Random(4)
    alphabet = ["the", "ing", " ", "  ", "\n", "\t", "é", "é", "漢", "𠮷", "ﬁ", "▁", "0", "123", "ABC", "Hello", ".", "http://", "!", "\x00"]
    texts = ["".join(rng.choice(alphabet) for _ in range(rng.randint(0, 25))) for _ in range(3000)]
    texts += ["", " ", " " * 40, "a" * 500, " " * 17 + "b", "🙂 ok"]
    for text in texts:
        ids = encoder.encode(text)
        assert ids == library.encode(text), repr(text)
        assert encoder.decode(ids) == text.replace("▁", " ")


def test_table_round_trip(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    encoded = pieces.encode(docs)
    assert encoded.where(~F.col("round_trip")).count() == 0
    back = pieces.decode(encoded).withColumnRenamed("text", "back").join(docs, "doc_id")
    assert back.where(F.col("back") != F.replace("text", F.lit("▁"), F.lit(" "))).count() == 0
    sizes = encoded.agg(F.sum(F.size("ids")).alias("a"), F.sum("n_pieces").alias("b")).first()
    assert sizes["a"] == sizes["b"] > 0


def test_unigram_paths_against_all_segmentations():
    """Scores instead of merges: the cheapest of all ways to cut a text."""
    rng = random.Random(2)
    texts = ["▁", "a", "b", "c", "ab", "bc", "abc", "▁a", "▁ab", "ca", "cab", "de", "▁b"]
    scores = [-rng.uniform(1, 9) for _ in texts]
    pieces_of = [f"<0x{i:02X}>" for i in range(256)] + texts
    t = pieces.Transducer.__new__(pieces.Transducer)
    t._compile(pieces_of, [0.0] * 256 + scores, [True] * 256 + [False] * len(texts), list(range(256)), False, True)
    encoder, cost = pieces.Encoder(t), dict(zip(texts, [-x for x in scores]))

    def cheapest(s):
        best = [0.0] + [float("inf")] * len(s)
        for end in range(1, len(s) + 1):
            for start in range(end):
                own = cost.get(s[start:end], t.unknown if end - start == 1 else None)
                if own is not None:
                    best[end] = min(best[end], best[start] + own)
        return best[-1]

    for _ in range(300):
        text = "".join(rng.choice("abcde ") for _ in range(rng.randint(1, 9)))
        ids = encoder.encode(text)
        assert encoder.decode(ids) == text
        paid = sum(cost[pieces_of[i]] if i >= 256 else t.unknown for i in ids)
        assert paid == pytest.approx(cheapest("▁" + text.replace(" ", "▁")))


def test_texts_of_one_kind_take_linear_time(spark):
    import time

    import sentencepiece
    library = sentencepiece.SentencePieceProcessor(model_file=pieces.MODEL)
    encoder = pieces.Encoder(pieces.Transducer())
    for unit in ("a", " ", "漢字", ".", "ab c"):
        start = time.process_time()
        encoder.encode_bytes(unit * (1_000_000 // len(unit)))
        assert time.process_time() - start < 20
        assert encoder.encode(unit * 3000) == library.encode(unit * 3000)
    for n in [*range(1, 150), 1000, 4099]:
        for text in (" " * n, "a" + " " * n + "b", "." + " " * n):
            assert encoder.encode(text) == library.encode(text)


def test_kept_paths_are_bounded_by_bytes(monkeypatch):
    monkeypatch.setattr(pieces, "KEPT", 4000)
    encoder = pieces.Encoder(pieces.Transducer())
    for i in range(2000):
        encoder.encode_bytes(f"word{i} " + "漢" * 300)
    held = [*encoder.items(), *encoder.before.items()]
    assert sum(150 + len(s) + len(ids) for s, ids in held) < 5000 and max(len(s) for s, _ in held) <= pieces.LONGEST


def test_letters_and_stops_are_cut_only_where_no_piece_joins_them():
    transducer = pieces.Transducer()
    assert transducer.segments is pieces._FINE_SEGMENT
    assert transducer.segments.findall("▁word,▁12b.\n▁▁né漢.x") == [
        "▁word", ",", "▁12", "b", ".\n", "▁▁né漢.x"]
