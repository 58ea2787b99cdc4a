"""Main text of web pages by a tree-structured graphical model.

Block elements of a page are the nodes of a tree; each is a container of both kinds (0), main content (1) or
beside it (2). A node's potential
comes from its own traits (words of class, id and role; by tag, length and link share of its own text and its
sentence marks), an edge's from how often a child with its tag has a label under each label of its parent. Sum-product messages
go up from the leaves and down from the root, level by level for many pages at once, and give every node's
marginal; the text of the nodes with a marginal of at least one half is the page's text.

Both potentials are counts, learned from labelled pages: a few written here with their content marked, and a
sample of about ``TRAIN_PAGES`` pages of the table, chosen by a hash, that mark their article themselves (what
is inside ``<article>`` or ``<main>`` but not in a nested menu, aside, header, footer or form is content). Half of the
latter are learned with that tag replaced by ``div``, so that the other traits count too.

Character references are decoded, white space inside a block becomes one space, blocks are joined by one space
in page order. Scripts, styles, comments, forms' controls and other unseen elements are never text. A null or empty
page and a page without content give an empty text; broken markup is read as far as it goes. Every row
gives a row, repeated ones too; extra columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import html
import re
import zlib
from collections import Counter
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from dossier.llm.common import slices

TRAIN_PAGES = 2000
MIXED, MAIN, BESIDE = 0, 1, 2
#: The pages written here count at least so many times: their marks are sure.
LEAST_WEIGHT = 50.0
#: So many nodes of the mean of all labels are added to each label's lengths, so that a few pages do not decide.
SHRINK = 20
#: Power of the length potentials: few pages show lengths beside the content, so they bear witness at half weight.
LENGTH_WEIGHT = 0.7
#: Log prior of a whole page's label.
ROOT = np.array([0.0, -8.0, -4.0])

# Kinds of HTML elements.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q ruby rp rt s samp "
    "small span strike strong sub sup time tt u var center nobr "
    "math maction menclose merror mfenced mfrac mi mmultiscripts mn mo mover mpadded mphantom mprescripts mroot mrow ms "
    "mspace msqrt mstyle msub msubsup msup mtable mtd mtext mtr munder munderover none semantics "
    "svg g defs symbol use path circle ellipse line polygon polyline rect image text tspan textpath clippath mask pattern "
    "marker filter lineargradient radialgradient stop".split())
#: Formula rows and cells and the labels of a drawing are inline, but words of two of them do not run together.
CELLS = frozenset("mtable mtr mtd text".split())
RAW = frozenset("script style iframe textarea title".split())
UNSEEN = RAW | frozenset(
    "noscript template select button object canvas audio video annotation annotation-xml desc metadata".split())
CLOSES_P = frozenset(
    "address article aside blockquote details div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 "
    "header hr main menu nav ol p pre section table ul".split())
#: Opening one of these closes an open one of the second group, unless one of the third stands between.
IMPLIED = {
    "li": (("li",), ("ul", "ol", "menu")), "dt": (("dt", "dd"), ("dl",)), "dd": (("dt", "dd"), ("dl",)),
    "tr": (("tr", "td", "th"), ("table",)), "td": (("td", "th"), ("tr", "table")), "th": (("td", "th"), ("tr", "table")),
}
OPTIONS = frozenset("option optgroup".split())
OFF_TAGS = frozenset("nav aside header footer form".split())

# Pages with their content marked (data-main) and what stands inside it but is none (data-off).
LABELLED = (
    """<html><body><header class="site-header"><a href="/">Home</a><nav class="menu"><ul><li><a>One</a></li>
    <li><a>Two</a></li></ul></nav></header><div class="cookie notice banner"><p>We use cookies on this site to see which pages are
    read and how often. You may accept them all, or choose which of them you accept, or read our rules on what we keep.</p>
    </div><main data-main><h1>How rivers meet the sea</h1><p>Where a river slows down, it drops the sand it carries, and
    over the years the sand becomes land.</p><p>Plants hold the new land in place. Birds follow the plants.</p></main>
    <aside class="sidebar related"><h3>More</h3><ul><li><a>Lakes</a></li></ul></aside><footer>&copy; Someone, some rights.
    </footer></body></html>""",
    """<html><body><div id="top" class="topbar menu"><a>Login</a> <a>Register</a></div><div class="ad advert sponsored">
    Buy two lamps and get one for free. Only today.</div><div id="content" class="post entry article content" data-main>
    <h2>A short history of lamps</h2><p>The first lamps were stones with a hollow, filled with fat and a wick of moss.</p>
    <div class="ad promo" data-off>The best lamps, sold by us.</div><p>Glass came later, and with it a steady light.</p>
    <ul><li>Oil lamps burned for hours.</li><li>Gas lamps lit whole streets.</li></ul></div><div id="comments"
    class="comments"><div class="comment"><p>I liked this one very much, thank you for writing it. My mother had such a lamp in the
    kitchen, and in winter we sat around it in the evenings, because the hall was cold and wood was dear in those years.</p></div><div
    class="comment"><p>My lamp is older than yours.</p></div></div><form class="search newsletter"><p>Sign up for our letter.
    </p></form><div class="footer copyright">All pages by the makers.</div></body></html>""",
    """<html><body><div class="wrapper page"><div class="header masthead"><p>The Daily Page, news since the year one.</p></div>
    <div class="breadcrumb"><a>Start</a> / <a>News</a></div><div class="main text body story" data-main><h1>Rain expected</h1>
    <p>Rain is expected in the north from the early morning on. The wind will turn in the evening.</p><blockquote>It is the
    season for it, said a farmer.</blockquote><table><tr><td>North</td><td>Rain all day long.</td></tr></table></div>
    <div class="sidebar widget"><p>Most read stories of the week, picked by readers.</p></div><div class="share social">
    <a>Share</a><a>Tell</a></div><div class="notice alert popup modal"><p>Your browser is old. Some parts of this site will not work as they
    should. Please get a new one from its makers, it takes a minute.</p>
    </div><footer class="footer"><p>Imprint. Terms of use.</p></footer></div></body></html>""",
    """<html><body><nav role="navigation"><a>Up</a></nav><section role="main" class="article" data-main><h1>Bread</h1><p>Mix
    flour, water and salt. Let the dough rest for a night.</p><p>Bake it hot, with steam at first.</p><section
    class="comments" data-off><h3>Comments</h3><p>Worked well with rye, thanks for it. I let the dough stand for
    two nights in the cellar, took less salt, and baked it in a pot with the lid on, which gave a crust like that of a baker.</p></section></section><section
    class="related teaser"><p>Try our soups, they are quick to make.</p></section><div role="banner"><p>A banner over the
    whole width of the page.</p></div><div role="contentinfo"><p>Made in a kitchen.</p></div></body></html>""",
    """<html><body><ul class="menu"><li><a>Home</a></li><li><a>Map</a></li></ul><h1 data-main>On walking</h1><p data-main>
    Walking is slow, and that is the point of it. Begin with an hour.</p><p data-main>Then take a day, a bag and some bread.
    </p><div class="ads"><p>Shoes for every road, at half the price.</p></div><div class="copyright">A walker's page.</div>
    </body></html>""",
    """<html><body><nav><ul><li><a>Home</a></li><li><a>News</a></li></ul></nav><div class="ad">Cheap flights to everywhere.
    </div><article data-main><h1>On sleep</h1><p>Sleep is long for the young, and short for the old.</p><p>No one knows why.</p>
    </article><section class="comments"><p>I sleep badly.</p></section><footer>Some site &middot; all rights kept.</footer></body>
    </html>""",
    """<html><body><header><h2>The Paper</h2><nav><a>Home</a></nav></header><article data-main><p>One line of news.</p></article>
    <aside><p>Weather: it rains.</p></aside><footer><p>Imprint</p></footer></body></html>""",
)

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>|<[a-zA-Z/!?][^>]*(?:>|\Z)", re.S)
_ATTRIBUTE = re.compile(r"(?i)\b(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))")
_WORD = re.compile(r"[a-z]+")


@cache
def _same(tag: str) -> re.Pattern:
    """An end of an unseen element; for one that is not raw text also the start of another."""
    return re.compile(rf"<(/{'' if tag in RAW else '?'}){re.escape(tag)}(?=[\s/>]|\Z)", re.I)


class Page:
    """The tree of one page: parents, depths, traits of the nodes, and the text parts in page order."""

    def __init__(self, source: str, hide_article: bool = False):
        self.parent, self.depth, self.tags, self.traits = [-1], [0], ["#page"], [[]]
        self.inside, self.main = [0], [0]  # marked or in an article; is the marked element or the article
        self.own, self.linked, self.marks = [0], [0], [0]
        self.parts: list[tuple[int, str]] = []
        self._read(source, hide_article)
        for tag, traits, own, linked, marks in zip(self.tags, self.traits, self.own, self.linked, self.marks):
            traits.append(f"{tag}:size={min(own, 1 << 12).bit_length()}")
            if own:
                traits.append(f"{tag}:links={(4 * linked) // own}")
                traits.append(f"{tag}:marks={min(marks, 3)}")

    def _open(self, tag: str, attributes: str, stack: list[tuple[str, int]], hide: bool) -> None:
        up = stack[-1][1]
        article = tag in ("article", "main")
        marked = article or "data-main" in attributes
        off = tag in OFF_TAGS or "data-off" in attributes
        traits = []
        if attributes:
            for a, b, c in _ATTRIBUTE.findall(attributes):
                traits += ["word=" + w for w in dict.fromkeys(_WORD.findall((a or b or c).lower()))]
        stack.append((tag, len(self.parent)))
        self.parent.append(up)
        self.depth.append(self.depth[up] + 1)
        self.tags.append("div" if hide and article else tag)
        self.traits.append(traits)
        self.inside.append(0 if off else 1 if marked else self.inside[up])
        self.main.append(int(marked))
        self.own.append(0)
        self.linked.append(0)
        self.marks.append(0)

    def _text(self, text: str, node: int, in_link: bool) -> None:
        if "&" in text:
            text = html.unescape(text)
        self.parts.append((node, text))
        size = len(text.strip())
        self.own[node] += size
        self.linked[node] += size * in_link
        self.marks[node] += text.count(". ") + text.count(", ")

    def _read(self, source: str, hide: bool) -> None:
        stack, at, in_link, size = [("#page", 0)], 0, False, len(source)
        opened: Counter[str] = Counter()  # tags of the stack
        unseen = 0  # place in the stack of an unseen element without an end of its own

        def shut(places: int) -> None:
            nonlocal unseen
            while len(stack) > max(1, places):
                opened[stack.pop()[0]] -= 1
            if len(stack) <= unseen:
                unseen = 0

        def last(tag: str) -> int:
            i = len(stack) - 1
            while stack[i][0] != tag:
                i -= 1
            return i

        while at < size:
            found = _TOKEN.search(source, at)
            end = found.start() if found else size
            if end > at and not unseen:
                self._text(source[at:end], stack[-1][1], in_link)
            if not found:
                break
            at = found.end()
            closing, tag, attributes = found.groups()
            if tag is None:
                continue
            tag = tag.lower()
            if tag in INLINE:
                in_link = not closing if tag == "a" else in_link
                if tag in CELLS:
                    self.parts.append((-1, " "))
                continue
            self.parts.append((-1, " "))
            if tag in VOID:
                continue
            if tag in UNSEEN and not closing:
                if not attributes.endswith("/"):
                    past = _same(tag).search(source, at)
                    if past and past.group(1):
                        at = past.start()
                    elif tag in RAW:
                        at = size
                    else:  # it ends at the next block, or with its parent
                        unseen = unseen or len(stack)
                        stack.append((tag, stack[-1][1]))
                        opened[tag] += 1
                continue
            if closing:
                if opened[tag]:
                    shut(last(tag))
            else:
                if unseen and tag not in OPTIONS:
                    shut(unseen)
                if tag in CLOSES_P and opened["p"]:
                    shut(last("p"))
                elif tag in IMPLIED and any(opened[t] for t in IMPLIED[tag][0]):
                    over, until = IMPLIED[tag]
                    for i in range(len(stack) - 1, 0, -1):
                        if stack[i][0] in until:
                            break
                        if stack[i][0] in over:
                            shut(i)
                            break
                self._open(tag, attributes, stack, hide)
                opened[tag] += 1
            in_link = False

    def content(self, chosen) -> str:
        """The text of the chosen nodes."""
        return " ".join("".join([t for node, t in self.parts if node < 0 or chosen[node]]).split())


class Model:
    """Log potentials: of traits by label, and of a child's label by its tag and its parent's label."""

    def __init__(self, counts: dict[str, np.ndarray]):
        nodes = counts["node"]
        self.traits = {
            name: np.log((n + 0.5) / (nodes + 1)) for name, n in counts.items() if name[:5] == "word="}
        for name, n in counts.items():
            if ":" in name and name[:5] != "edge ":
                of_tag = counts["node " + name.partition(":")[0]]
                share = n.sum() / of_tag.sum()
                self.traits[name] = np.log((n + SHRINK * share) / (of_tag + SHRINK))
        pairs: dict[str, np.ndarray] = {}
        for name, n in counts.items():
            if name[:5] == "edge ":
                up, tag = name[5:].split("=", 1)
                pairs.setdefault(tag, np.zeros((3, 3)))[int(up)] += n
        usual = sum(pairs.values(), np.full((3, 3), 0.5))
        usual = usual / usual.sum(axis=1, keepdims=True)
        self.usual = np.log(usual)
        self.edges = {tag: np.log((n + usual / 4) / (n + usual / 4).sum(axis=1, keepdims=True))
                      for tag, n in pairs.items()}

    def marginals(self, pages: list[Page]) -> list[np.ndarray]:
        """P(content) of every node of every page, by messages up and down the levels of all trees."""
        sizes = [len(p.parent) for p in pages]
        base = np.concatenate(([0], np.cumsum(sizes)))[:-1]
        parent = np.concatenate([np.array(p.parent) + b for p, b in zip(pages, base)])
        depth = np.concatenate([p.depth for p in pages])
        own = np.zeros((len(parent), 3))
        traits = [(i, self.traits[t], ":" in t) for i, own_traits in enumerate(t for p in pages for t in p.traits)
                  for t in own_traits if t in self.traits]
        # Siblings of one tag are alike, so their lengths together weigh as those of one.
        _, group, alike = np.unique(parent * 65536 + np.array(
            [zlib.crc32(tag.encode()) & 65535 for p in pages for tag in p.tags]), return_inverse=True,
            return_counts=True)
        place = np.array([i for i, _, _ in traits], np.int64)
        share = np.where([length for _, _, length in traits], LENGTH_WEIGHT / alike[group][place], 1.0)
        np.add.at(own, place, np.array([v for _, v, _ in traits]).reshape(-1, 3) * share[:, None])
        order = np.argsort(depth, kind="stable")
        cuts = np.searchsorted(depth[order], np.arange(depth.max() + 2))
        levels = [order[a:b] for a, b in zip(cuts, cuts[1:])]
        sent = np.zeros_like(own)
        edges = np.stack([self.edges.get(tag, self.usual) for p in pages for tag in p.tags])
        for level in reversed(levels[1:]):
            sent[level] = np.logaddexp.reduce(own[level, None, :] + edges[level], axis=2)
            np.add.at(own, parent[level], sent[level])
        belief = own.copy()  # potential and messages from below; messages from above are added on the way down
        belief[levels[0]] += ROOT
        for level in levels[1:]:
            rest = belief[parent[level]] - sent[level]
            belief[level] += np.logaddexp.reduce(rest[:, :, None] + edges[level], axis=1)
        share = np.exp(belief[:, MAIN] - np.logaddexp.reduce(belief, axis=1))
        return np.split(share, np.cumsum(sizes)[:-1])


def labels(page: Page) -> list[int]:
    """The label of each node of a marked page; a parent always stands before its children."""
    found = [MAIN if inside else BESIDE for inside in page.inside]
    for i in range(len(found) - 1, 0, -1):
        if found[i] != BESIDE and found[page.parent[i]] == BESIDE:
            found[page.parent[i]] = MIXED
    return found


def _counts(pages: list[Page]) -> dict[str, np.ndarray]:
    """By label: nodes ("node"), nodes of a tag ("node p"), nodes with a trait, children of a tag under a label of the parent ("edge 0=p")."""
    counts: dict[str, np.ndarray] = {}
    for page in pages:
        found = labels(page)
        for i, label in enumerate(found):
            up = page.parent[i]
            own = (*page.traits[i], "node", f"node {page.tags[i]}") if up < 0 else (
                *page.traits[i], "node", f"node {page.tags[i]}", f"edge {found[up]}={page.tags[i]}")
            for t in own:
                counts.setdefault(t, np.zeros(3))[label] += 1
    return counts


def fitted(learned: dict[str, np.ndarray], written: tuple[str, ...] = LABELLED) -> Model:
    """The model from the counts of the table's pages and the pages written here.

    Both kinds weigh the same for words and edges; lengths are counted as they are.
    """
    own = _counts([Page(source) for source in written])
    weight = max(LEAST_WEIGHT, learned["node"].sum() / own["node"].sum() if "node" in learned else 0)
    return Model({
        k: learned.get(k, 0) + (1 if ":" in k or k[:5] == "node " else weight) * own.get(k, np.zeros(3))
        for k in learned.keys() | own.keys()})


def train(pages: DataFrame, sample: int = TRAIN_PAGES) -> Model:
    """The model from the pages written here and about ``sample`` self-marked pages of the table."""
    rows = pages.count()
    every = max(1, -(-rows // max(sample, 1)))

    def scan(batches):
        total: dict[str, np.ndarray] = {}
        for part in slices(batches, 200):
            read = [Page(h, zlib.crc32(h.encode("utf-8", "replace")) % 2 == 1)
                    for h in part.column(0).to_pylist() if h]
            for name, n in _counts([p for p in read if sum(p.main) == 1]).items():
                total[name] = total.get(name, 0) + n
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(total), pa.string()),
             *(pa.array([float(n[i]) for n in total.values()], pa.float64()) for i in range(3))],
            ["trait", "mixed", "main", "beside"])

    chosen = pages.where(F.pmod(F.xxhash64("html"), F.lit(every)) == 0).select("html").limit(2 * sample)
    learned = (
        chosen.mapInArrow(scan, "trait string, mixed double, main double, beside double").groupBy("trait")
        .agg(*(F.sum(c).alias(c) for c in ("mixed", "main", "beside"))).collect())
    return fitted({r["trait"]: np.array([r["mixed"], r["main"], r["beside"]]) for r in learned})


def main_text(pages: DataFrame, sample: int = TRAIN_PAGES) -> DataFrame:
    """page_id, url, text and n_chars of every page."""
    model = train(pages, sample)
    kinds = [pages.schema[c].dataType.simpleString() for c in ("page_id", "url")]

    def scan(batches):
        for part in slices(batches, 200):
            read = [Page(h or "") for h in part.column(2).to_pylist()]
            texts = [p.content(m >= 0.5) for p, m in zip(read, model.marginals(read))]
            yield pa.RecordBatch.from_arrays(
                [part.column(0), part.column(1), pa.array(texts, pa.string()),
                 pa.array([len(t) for t in texts], pa.int64())], ["page_id", "url", "text", "n_chars"])

    return pages.select("page_id", "url", "html").mapInArrow(
        scan, f"page_id {kinds[0]}, url {kinds[1]}, text string, n_chars long")
