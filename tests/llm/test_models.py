"""Class model, language ID, quality rules and page model against brute force and held-out rows."""

import math
import random
import time
import zlib
from collections import Counter

import numpy as np
import pytest

from dossier.llm import brown, langid, mainhtml, quality


def sentences(rng, words, n):
    return " ".join(rng.choice(words) for _ in range(n))


@pytest.fixture(scope="module")
def mixed(docs_of):
    """Four invented languages with words of their own."""
    rng = random.Random(2)
    parts = {"en": "th er on an re he in ed nd ha".split(), "fr": "é eau ou è oi que ai aux ê ç".split(),
             "de": "sch ü ß ö ach ung heit keit ä pf".split(), "es": "ción ñ ll rr ó í ado que os ez".split()}
    rows, known = [], {lang: ["".join(rng.choice(p) for _ in range(rng.randint(1, 3))) for _ in range(60)]
                       for lang, p in parts.items()}
    for i in range(240):
        lang = list(parts)[i % 4]
        words = known[lang] + ["".join(rng.choice(parts[lang]) for _ in range(rng.randint(1, 3))) for _ in range(5)]
        rows.append((i, sentences(rng, words, rng.randint(15, 60)).capitalize() + ".", lang))
    return docs_of(rows)


def test_language_of_held_out_rows(mixed):
    want = {r["doc_id"]: r["lang"] for r in mixed.collect()}
    got = langid.identify(mixed).collect()
    for r in got:
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2)
        assert 0 <= r["score"] <= 1
    held = [r for r in got if r["held_out"]]
    assert len(held) > 30 and np.mean([r["lang_pred"] == want[r["doc_id"]] for r in held]) > 0.97


def test_language_scores_against_plain_vectors(mixed):
    """Cosines from vectors bound and added one 3-gram at a time."""
    size = 64
    rows = [(r["doc_id"], r["text"], r["lang"]) for r in mixed.limit(40).collect()]
    letter = {}

    def vector(text):
        kept = "".join(c if c.isalpha() else " " for c in text.lower())
        kept = f" {' '.join(kept.split())} " if kept.strip() else ""
        total = np.zeros(size)
        for c in kept:
            letter.setdefault(c, np.random.default_rng(ord(c)).integers(0, 2, size, np.int8) * 2 - 1)
        for a, b, c in zip(kept, kept[1:], kept[2:]):
            total += np.roll(letter[a], 2) * np.roll(letter[b], 1) * letter[c]
        return total

    train = [r for r in rows if zlib.crc32(str(r[0]).encode()) % 4 != 2]
    protos = {lang: sum(vector(t) for _, t, x in train if x == lang) for lang in sorted({x for _, _, x in train})}
    want = {}
    for d, t, _ in rows:
        v = vector(t)
        cosine = {lang: v @ p / np.linalg.norm(v) / np.linalg.norm(p) for lang, p in protos.items()}
        best = max(cosine, key=cosine.get)
        want[d] = (best, round(max(0.0, cosine[best]), 6))
    got = langid.identify(mixed.limit(40), size).collect()
    assert {r["doc_id"]: (r["lang_pred"], round(r["score"], 6)) for r in got} == want


def test_language_without_letters_or_training(docs_of):
    docs = docs_of([(1, None), (2, ""), (3, "12 !?"), (4, "abc"), (5, "abc def", None)])
    got = {r["doc_id"]: r["lang_pred"] for r in langid.identify(docs).collect()}
    assert [got[i] for i in (1, 2, 3)] == ["und"] * 3 and got[4] == "en"
    none = docs_of([(1, "abc", None)])
    assert [tuple(r) for r in langid.identify(none).select("lang_pred", "score").collect()] == [("und", 0.0)]
    assert {r["doc_id"] for r in langid.language_stage(docs).collect()} == {4, 5}


def test_stage_rejects_scripts_and_letters_it_has_not_learned(mixed, docs_of):
    """Every planted text goes, every learned one stays."""
    rng = random.Random(9)
    learned = [(r["doc_id"], r["text"], r["lang"]) for r in mixed.collect()]
    letters = [[chr(c) for c in range(*span)] for span in (
        (0x3B1, 0x3CA), (0x430, 0x450), (0x5D0, 0x5EB), (0x4E00, 0x4F00), (0x61, 0x7B))]
    noise = [(1000 + i, sentences(rng, ["".join(rng.choice(own) for _ in range(rng.randint(2, 9))) for _ in range(300)], n), None)
             for i, (own, n) in enumerate((own, n) for own in letters for n in (20, 150, 1000) for _ in range(8))]
    left = {r["doc_id"] for r in langid.language_stage(docs_of(learned + noise)).collect()}
    assert left == {d for d, _, _ in learned}


def base_scores(rows):
    train = [t for d, t in rows if zlib.crc32(str(d).encode()) % 5 != 1]
    tokens = lambda t: (t or "").encode().lower().split() + [b"\n"]
    count = Counter(w for t in train for w in tokens(t))
    n, v = sum(count.values()), len(count)
    return {d: (len(tokens(t)), sum(w in count for w in tokens(t)), n,
                sum(math.log10((count[w] + 0.5) / (n + 0.5 * (v + 1))) for w in tokens(t))) for d, t in rows}


@pytest.mark.parametrize("known", [5, 131_072])
def test_base_scores(mixed, monkeypatch, known):
    monkeypatch.setattr(brown, "KNOWN", known)  # few known words: nearly all counts come by the join
    rows = [(r["doc_id"], r["text"]) for r in mixed.collect()]
    got = brown.score(mixed, classes=8, rounds=2).collect()
    want = base_scores(rows)
    for r in got:
        a = want[r["doc_id"]]
        assert (r["n_tokens"], r["n_known"], r["train_tokens"]) == a[:3]
        assert r["base_score"] == pytest.approx(a[3], abs=1e-6)


def test_classes_beat_the_base_on_held_out_rows(mixed):
    rows = [r for r in brown.score(mixed, classes=8, rounds=4).collect() if r["held_out"]]
    assert sum(r["score"] for r in rows) > sum(r["base_score"] for r in rows)


def likelihood(pairs, of, k):
    m = np.zeros((k, k))
    for (u, v), n in pairs.items():
        m[of[u], of[v]] += n
    f = lambda x: float((x[x > 0] * np.log(x[x > 0])).sum())
    return f(m) - f(m.sum(axis=1)) - f(m.sum(axis=0)), m


def test_best_class_against_likelihood_of_every_move():
    rng = random.Random(4)
    k, units = 6, 20
    of = [0, 1] + [rng.randint(2, k - 1) for _ in range(units - 2)]
    pairs = Counter((rng.randint(2, units - 1), rng.randint(2, units - 1)) for _ in range(300))
    for unit in range(2, units):
        _, m = likelihood(pairs, of, k)
        left, right, loop = np.zeros(k), np.zeros(k), pairs[unit, unit]
        for (u, v), n in pairs.items():
            if v == unit:
                left[of[u]] += n
            if u == unit:
                right[of[v]] += n
        values = {c: likelihood(pairs, of[:unit] + [c] + of[unit + 1:], k)[0] for c in range(2, k)}
        best = brown.best_class(of[unit], left, right, loop, m, m.sum(axis=1), m.sum(axis=0))
        assert values[best] == pytest.approx(max(values.values()), abs=1e-6)


def test_model_scores_against_plain_sums(mixed, monkeypatch):
    """Transitions and emissions counted one token at a time, under given classes."""
    k, seen = 7, {}

    def classes_of(pairs, sizes, classes, rounds):
        seen["of"] = np.array([0, 1] + [2 + i % (classes - 2) for i in range(len(sizes) - 2)])
        return seen["of"]

    made = brown.Units.__init__

    def keep(self, words):
        made(self, words)
        seen["units"] = self

    monkeypatch.setattr(brown, "exchange", classes_of)
    monkeypatch.setattr(brown.Units, "__init__", keep)
    monkeypatch.setattr(brown, "UNITS", 30)
    got = {r["doc_id"]: r["score"] for r in brown.score(mixed, classes=k).collect()}
    rows = [(r["doc_id"], (r["text"] or "").encode().lower().split() + [b"\n"]) for r in mixed.collect()]
    unit = {w: seen["units"].of(w) for _, t in rows for w in t}
    label = {w: int(seen["of"][u]) for w, u in unit.items()}
    train = [t for d, t in rows if zlib.crc32(str(d).encode()) % 5 != 1]
    count = Counter(w for t in train for w in t)
    tokens, kinds = Counter(), Counter()
    for w, n in count.items():
        tokens[label[w]] += n
        kinds[label[w]] += 1
    steps = Counter((a, b) for t in train for a, b in zip([0] + [label[w] for w in t], [label[w] for w in t]))
    out = Counter()
    for (a, _), n in steps.items():
        out[a] += n
    for d, t in rows:
        want, before = 0.0, 0
        for w in t:
            c = label[w]
            want += math.log10((steps[before, c] + 0.5) / (out[before] + 0.5 * k))
            want += math.log10((count[w] + 0.5) / (tokens[c] + 0.5 * (kinds[c] + 1)))
            before = c
        assert got[d] == pytest.approx(want, abs=1e-6)


def brute_rules(text):
    words = [w for w in __import__("re").split(r"[\x20\x09-\x0D]+", text) if w]
    lines = [x for x in text.split("\n") if x.strip(" \t\n\v\f\r")]
    windows = [tuple(words[i:i + 5]) for i in range(len(words) - 4)]
    twice = {w for w, n in Counter(windows).items() if n > 1}
    covered = {i + j for i, w in enumerate(windows) if w in twice for j in range(5)}
    return (len(words), sum(map(len, words)), sum(text.count(c) for c in "#*$%&|<>"),
            sum(x in lines[:i] for i, x in enumerate(lines)), len(covered))


def test_rule_counts_against_brute_force():
    rng = random.Random(8)
    for _ in range(300):
        text = "".join(rng.choice(["a ", "b ", "é ", " ", " ", "\n", "#", "|", " ", "\t", "a b a b a "]) for _ in range(rng.randint(0, 60)))
        assert quality.rule_counts(text) == brute_rules(text), repr(text)


def test_quality_verdict_follows_labels(spark, docs_of):
    rng = random.Random(6)
    words = [f"{a}{b}" for a in "lorem ipsum dolor sit amet".split() for b in "abcdefgh"]
    rows, labels = [], []
    for i in range(400):
        bad = i % 10 == 0
        text = [rng.choice(words) + (rng.choice(["***", "$$$"]) if bad else "") for _ in range(rng.randint(15, 200))]
        rows.append((i, " ".join(text)))
        if i % 3 == 0:
            labels.append((i, 0 if bad else 1, 0))
    labels = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    got = {r["doc_id"]: r for r in quality.quality_rules(docs_of(rows), labels).collect()}
    unlabelled = [i for i in range(400) if i % 3]
    assert all(got[i]["kept"] for i in unlabelled if i % 10)
    assert not any(got[i]["kept"] for i in unlabelled if i % 10 == 0)
    plain = quality.quality_rules(docs_of(rows), labels.limit(0)).collect()
    assert all(r["kept"] == (not r["base_failed"]) for r in plain)


def test_forest_isolates_outliers():
    rng = np.random.default_rng(3)
    rows = np.concatenate([rng.normal(0, 1, (500, 2)), [[9, 9]]])
    scores = quality.anomaly(rows, quality.fit_forest(rows))
    assert scores.argmax() == 500 and np.all((scores > 0) & (scores < 1))


def test_messages_against_all_labellings():
    """Marginals of a small tree by adding up every labelling."""
    import itertools
    model = mainhtml.fitted({})
    page = mainhtml.Page("<body><nav><ul><li><a>x</a></li></ul></nav><div class='post'><p>Some text. It goes on, and on.</p></div></body>")
    n = len(page.parent)
    mass = np.zeros((n, 3))
    siblings = Counter(zip(page.parent, page.tags))
    for labels in itertools.product(range(3), repeat=n):
        total = mainhtml.ROOT[labels[0]]
        for i, y in enumerate(labels):
            for t in page.traits[i]:
                if t in model.traits:
                    total += model.traits[t][y] * (
                        mainhtml.LENGTH_WEIGHT / siblings[page.parent[i], page.tags[i]] if ":" in t else 1)
            if i:
                total += model.edges.get(page.tags[i], model.usual)[labels[page.parent[i]], y]
        for i, y in enumerate(labels):
            mass[i, y] += math.exp(total)
    want = mass[:, mainhtml.MAIN] / mass.sum(axis=1)
    assert np.allclose(model.marginals([page])[0], want)


def test_marked_pages_are_read_back():
    model = mainhtml.fitted({})
    for source in mainhtml.LABELLED:
        page = mainhtml.Page(source)
        want = [label == mainhtml.MAIN for label in mainhtml.labels(page)]
        assert (model.marginals([page])[0] >= 0.5).tolist() == want


def test_text_of_blocks(spark):
    source = ("<html><head><title>no</title><style>p{}</style></head><body><nav><a>menu</a></nav><article><h1>Big  title</h1>"
              "<p>One<b>bold</b> &amp; two<br>three&nbsp;four<p>un&copy;closed</b> <script>var x='</p>';</script>end"
              "<!-- <p>gone</p> --></article><footer>foot</footer>")
    pages = spark.createDataFrame([(1, "u", source)], "page_id long, url string, html string")
    assert mainhtml.main_text(pages).first()["text"] == "Big title Onebold & two three four un©closed end"


def test_formulas_are_read_as_text(spark):
    source = ("<body><article><p>The law <math><semantics><mrow><mi>E</mi><mo>=</mo><mi>m</mi><msup><mi>c</mi><mn>2</mn></msup></mrow>"
              "<annotation encoding='TeX'>E=mc^2</annotation></semantics></math> holds, and <math><mtable><mtr><mtd><mn>1</mn></mtd>"
              "<mtd><mn>0</mn></mtd></mtr></mtable></math> is a row.</p></article></body>")
    pages = spark.createDataFrame([(1, "u", source)], "page_id long, url string, html string")
    assert mainhtml.main_text(pages).first()["text"] == "The law E=mc2 holds, and 1 0 is a row."


def test_pages_of_the_test_tables(spark, sf):
    import html
    import re
    pages = spark.read.parquet(f"{sf}/pages.parquet")
    want = {}
    for r in pages.collect():
        article = re.search(r"<article>(.*?)(</article>|\Z)", r["html"], re.S)[1]
        article = re.sub(r"<[^>]*>", " ", re.sub(r"</?b>", "", article))
        want[r["page_id"]] = " ".join(html.unescape(article).split())
    got = {r["page_id"]: r["text"] for r in mainhtml.main_text(pages).collect()}
    assert got == want


def test_quality_rules_do_not_depend_on_the_layout(spark, sf):
    docs, labels = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("documents", "labels"))
    once, again = (sorted(map(tuple, quality.quality_rules(docs.repartition(n, by), labels).select(
        "doc_id", "score", "kept").collect())) for n, by in ((1, "doc_id"), (7, "source")))
    assert once == again


@pytest.mark.parametrize("source,want", [
    ("<p>one <button>go<p>two</p>", "one two"), ("<div><button>go</div><p>two</p>", "two"),
    ("<p>a<noscript><p>x</p></noscript>b</p>", "a b"), ("<div><select><option>A<option>B</div>rest", "rest"),
    ("<p>x<svg viewBox='0'><title>T</title><text>lab</text><path d=''/></svg>y</p>", "x lab y"),
    ("<math><annotation>q<annotation-xml>z</annotation-xml></annotation></math>k", "k"),
    ("<script>a</scripty>b</script>c", "c"), ("<p>a<video>v<p>b", "a b"), ("a<script>b", "a")])
def test_unseen_elements_end_with_their_parent(source, want):
    assert " ".join("".join(t for _, t in mainhtml.Page(source).parts).split()) == want


def test_pages_are_read_in_linear_time():
    for tags in ("<div>", "<button>", "<video>x", "<p><li>", "<div><p>"):
        begin = time.process_time()
        mainhtml.Page(tags * 50_000)
        assert time.process_time() - begin < 5, tags
