"""Main-text extraction by a tree-structured graphical model.

A page becomes a tree: block elements are inner nodes, runs of text between
them are leaves. Every node has a hidden label, content or other. A label
depends on the parent's (parent-child potentials); what a node shows (tag,
names in class, id and role; for text its length, share of links and last
character) depends on its label. Messages go up the tree once and down once
(sum-product); a leaf whose content marginal is at least a half is part of
the text.

All potentials are counts over labelled pages: the small ones of
``LABELLED``, and a bounded sample of the corpus' own pages that mark their
article (``silver``), at most ``MAX_PAGES`` chosen by a hash of page_id.

Blocks keep page order. Character references are decoded, white space in a
block becomes one space, ``br`` is white space; scripts, styles, templates,
titles and comments are never text. Custom elements whose names only start so
(``svg-icon``) are ordinary ones; ``<svg/>`` and ``<!-->`` hold nothing.

Defined results: null or empty html gives an empty text; markup that isn't
closed ends with the page; a ``<`` that starts no tag is text; null page_id
or url stay null; repeated rows repeat; extra columns are not read.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from html import unescape

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import bound_batches, read_table, slices, staged

#: Corpus pages that a fit reads at most, and the weight of a page of ``LABELLED`` against one of them.
MAX_PAGES = 2000
WEIGHT = 200
SMOOTH = 0.5
#: Log ratios that one feature may reach: looks of a text say less about it than markup does.
MOST = {"tag": 4.0, "name": 7.0}
MOST_OF_TEXT = 0.7

# HTML element names.
BLOCKS = frozenset("""html body address article aside blockquote button caption dd details dialog dir div dl dt fieldset figcaption figure
footer form h1 h2 h3 h4 h5 h6 header hgroup legend li main menu nav ol optgroup option p pre section select summary table tbody td
textarea tfoot th thead tr ul center label""".split())
BOXES = frozenset("html body div section article main aside nav header footer form td center details dialog fieldset".split())
GROUPS = ("box", "flow", "text")
BREAKS = frozenset("hr".split())
#: A start tag of the key ends an open element of the values, up to the nearest of the stops.
ENDS = {"li": "li", "dt": "dt dd", "dd": "dt dd", "tr": "tr td th", "td": "td th", "th": "td th", "option": "option"}
STOPS = frozenset("ul ol dl table select".split())
#: Elements that may stand inside an open paragraph without ending it.
IN_PARAGRAPH = frozenset("button label select option textarea".split())

_TOKEN = re.compile(
    r"<!--(?:-?>|.*?(?:--!?>|\Z))"
    r"|<svg(?=[\s/])(?:[^>\"']|\"[^\"]*\"|'[^']*')*+(?<=/)>"
    r"|<(script|style|noscript|template|svg|iframe|title)(?=[\s/>])(?:(?:[^>\"']|\"[^\"]*\"|'[^']*')*+>|[^>]*>).*?(?:</\1(?=[\s/>])[^>]*>|\Z)"
    r"|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*+)>"
    r"|<[!?][^>]*>", re.S | re.I)
_NAMES = re.compile(r"""\b(class|id|role|aria-label|itemprop|data-label)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
_PARTS = re.compile(r"[a-z]+")
CONTENT, OTHER = 1, 0


class Page:
    """parent, features and forced label of each node, in page order; text of the leaves."""

    __slots__ = ("parent", "shows", "label", "text")

    def __init__(self):
        self.parent, self.shows, self.label, self.text = [-1], [("tag:html",)], [None], [None]


def parse(html: str) -> Page:
    page = Page()
    stack: list[tuple[str, int]] = [("html", 0)]
    run: list[str] = []
    linked = links = 0  # characters inside links, open links

    def flush():
        nonlocal linked
        text = " ".join("".join(run).split())
        run.clear()
        if text:
            page.parent.append(stack[-1][1])
            page.shows.append(_text_shows(text, linked))
            page.label.append(None)
            page.text.append(text)
        linked = 0

    def add(raw: str):
        nonlocal linked
        if raw:
            raw = unescape(raw)
            run.append(raw)
            if links:
                linked += len(raw)

    # Where the open elements of a name stand, so that closing one looks at names, never down the stack.
    opened: dict[str, list[int]] = {}

    def close(names, stops=frozenset()):
        last = lambda wanted: max((opened[n][-1] for n in wanted if opened.get(n)), default=0)
        at = last(names)
        if at and at >= last(stops):
            for name, _ in stack[at:]:
                opened[name].pop()
            del stack[at:]

    at = 0
    for m in _TOKEN.finditer(html):
        if m.start() > at:
            add(html[at:m.start()])
        at = m.end()
        name = m[3]
        if name is None:
            continue
        name = name.lower()
        if m[2]:
            if name in BLOCKS:
                flush()
                if name != "html" and name != "body":
                    close((name,))
            elif name == "a":
                links = max(0, links - 1)
        elif name in BLOCKS:
            flush()
            if name == "html" or name == "body" and opened.get("body"):
                continue
            if name not in IN_PARAGRAPH:
                close(("p",), STOPS | {"td", "th", "li", "button"})
            if name in ENDS:
                close(ENDS[name].split(), STOPS)
            names, label = _element_names(m[4])
            page.parent.append(stack[-1][1])
            page.shows.append(("tag:" + name, *names))
            page.label.append(label)
            page.text.append(None)
            if not m[4].endswith("/"):
                opened.setdefault(name, []).append(len(stack))
                stack.append((name, len(page.parent) - 1))
        elif name in BREAKS:
            flush()
        elif name == "br":
            run.append(" ")
        elif name == "a":
            links += 1
    if at < len(html):
        add(html[at:])
    flush()
    return page


def _element_names(attributes: str):
    if "=" not in attributes:
        return (), None
    names, label = {}, None
    for key, *values in _NAMES.findall(attributes):
        value = "".join(values).lower()
        if key.lower() == "data-label":
            label = CONTENT if value == "content" else OTHER
        else:
            names.update(dict.fromkeys("name:" + x for x in _PARTS.findall(value)))
    return tuple(names), label


def _text_shows(text: str, linked: int) -> tuple[str, ...]:
    size = min(6, int(math.log2(len(text) + 1)) // 2)
    return f"size:{size}", f"linked:{min(3, 3 * linked // max(1, len(text)))}", f"end:{text[-1] in '.!?:;\"'}"


# ---------------------------------------------------------------------- model

def group_of(shows: tuple[str, ...]) -> str:
    """Parent-child potentials differ for boxes, which may hold anything, other elements, and text."""
    if not shows[0].startswith("tag:"):
        return "text"
    return "box" if shows[0][4:] in BOXES else "flow"


class Model:
    """Log potentials from counts."""

    def __init__(self, shown: dict, edges: dict, roots: dict):
        # Names may be missing, so their chance is a share of nodes; a node has one of each other kind.
        nodes = {y: sum(n for (f, z), n in shown.items() if z == y and f.startswith("tag:")) for y in (OTHER, CONTENT)}
        kinds = Counter(f.split(":")[0] for f in {f for f, _ in shown})
        totals: Counter = Counter()
        for (feature, y), n in shown.items():
            totals[feature.split(":")[0], y] += n
        self.ratio = {}
        for feature in {f for f, _ in shown}:
            kind = feature.split(":")[0]
            all_of = nodes if kind == "name" else {y: totals[kind, y] + SMOOTH * kinds[kind] for y in (OTHER, CONTENT)}
            of = [math.log((shown.get((feature, y), 0) + SMOOTH) / (all_of[y] + SMOOTH)) for y in (OTHER, CONTENT)]
            most = MOST.get(kind, MOST_OF_TEXT)
            self.ratio[feature] = max(-most, min(most, of[CONTENT] - of[OTHER]))
        self.up = {}
        for group in GROUPS:
            for y in (OTHER, CONTENT):
                a, b = (edges.get((group, y, z), 0) + SMOOTH for z in (OTHER, CONTENT))
                self.up[group, y] = b / (a + b)  # chance that a child of this group is content if its parent is y
        self.root = math.log((roots.get(CONTENT, 0) + SMOOTH) / (roots.get(OTHER, 0) + SMOOTH))
        self.seen: dict = {}

    def evidence(self, shows: tuple[str, ...]) -> float:
        out = self.seen.get(shows)
        if out is None:
            out = sum(self.ratio.get(f, 0.0) for f in shows)
            if len(self.seen) < 10_000:
                self.seen[shows] = out
        return out

    def marginals(self, page: Page) -> list[float]:
        """Log odds of content of every node: messages up, then down."""
        n, exp, log = len(page.parent), math.exp, math.log
        chances = {g: (self.up[g, CONTENT], self.up[g, OTHER]) for g in GROUPS}
        own = [self.evidence(s) for s in page.shows]
        message = [0.0] * n
        for i in range(n - 1, 0, -1):  # children come after their parent
            odds = exp(min(50.0, max(-50.0, own[i])))
            p1, p0 = chances[group_of(page.shows[i])]
            message[i] = log((p1 * odds + 1 - p1) / (p0 * odds + 1 - p0))
            own[page.parent[i]] += message[i]
        out = [self.root + own[0]] + [0.0] * (n - 1)
        for i in range(1, n):
            rest = 1 / (1 + exp(-min(50.0, max(-50.0, out[page.parent[i]] - message[i]))))
            p1, p0 = chances[group_of(page.shows[i])]
            chance = rest * p1 + (1 - rest) * p0
            out[i] = log(chance / (1 - chance)) + own[i]
        return out


def extract(html: str, model: Model) -> str:
    page = parse(html)
    odds = model.marginals(page)
    return "\n".join(t for t, x in zip(page.text, odds) if t is not None and x >= 0)


def labelled(page: Page) -> list[int]:
    """Labels of a page with ``data-label``: a node without takes its parent's."""
    out: list[int] = []
    for parent, label in zip(page.parent, page.label):
        out.append(label if label is not None else out[parent] if parent >= 0 else OTHER)
    return out


#: Elements that mark an article, and those that mark something else wherever they stand.
_ARTICLE, _APART = ("tag:article", "tag:main"), ("tag:nav", "tag:aside", "tag:footer", "tag:header", "tag:form")
_APART_NAMES = frozenset("name:" + x for x in "ad ads advert sidebar menu comments comment cookie newsletter related promo share".split())


def silver(page: Page) -> list[int] | None:
    """Labels by the page's own markup; None if it marks no article."""
    if not any(s[0] in _ARTICLE for s in page.shows):
        return None
    out: list[int] = []
    barred: list[bool] = []
    for parent, shows in zip(page.parent, page.shows):
        stop = (parent >= 0 and barred[parent]) or shows[0] in _APART or not _APART_NAMES.isdisjoint(shows)
        inside = (parent >= 0 and out[parent] == CONTENT) or shows[0] in _ARTICLE
        barred.append(stop)
        out.append(CONTENT if inside and not stop else OTHER)
    return out


def count(page: Page, labels: list[int], weight: int = 1) -> Counter:
    """Counts of (kind, key, label)."""
    out: Counter = Counter()
    for parent, shows, y in zip(page.parent, page.shows, labels):
        for f in shows:
            out["show", f, y] += weight
        if parent < 0:
            out["root", "", y] += weight
        else:
            out["edge", f"{group_of(shows)} {labels[parent]}", y] += weight
    return out


def fit(pages: DataFrame, max_pages: int = MAX_PAGES) -> Model:
    """Potentials from ``LABELLED`` and at most ``max_pages`` pages of the corpus."""
    bound_batches(pages.sparkSession)
    chosen = pages.where("html IS NOT NULL").select("page_id").distinct().orderBy(F.xxhash64("page_id"), "page_id").limit(max_pages)
    sample = pages.select("page_id", "html").join(F.broadcast(staged(chosen, "html-chosen")), "page_id").select("html")

    def run(batches):
        import pyarrow as pa

        total: Counter = Counter()
        for batch in slices(batches, "html"):
            for html in batch.column("html").to_pylist():
                page = parse(html or "")
                if (labels := silver(page)) is not None:
                    total += count(page, labels)
        rows = list(zip(*((kind, key, y, n) for (kind, key, y), n in total.items()))) or [()] * 4
        yield pa.RecordBatch.from_arrays([pa.array(rows[0], pa.string()), pa.array(rows[1], pa.string()), pa.array(rows[2], pa.int32()),
                                          pa.array(rows[3], pa.int64())], ["kind", "key", "label", "n"])

    found = sample.mapInArrow(run, "kind string, key string, label int, n long").groupBy("kind", "key", "label").agg(F.sum("n").alias("n"))
    total: Counter = Counter()
    for kind, key, y, n in found.collect():  # names and tags of max_pages pages
        total[kind, key, y] += n
    for html in LABELLED:
        page = parse(html)
        total += count(page, labelled(page), WEIGHT)
    return Model({(key, y): n for (kind, key, y), n in total.items() if kind == "show"},
                 {(key.split()[0], int(key.split()[1]), y): n for (kind, key, y), n in total.items() if kind == "edge"},
                 {y: n for (kind, _, y), n in total.items() if kind == "root"})


def main_text(pages: DataFrame, model: Model) -> DataFrame:
    """One row per page: page_id, url, text, n_chars. No shuffle."""

    def run(batches):
        import pyarrow as pa

        for batch in slices(batches, "html"):
            texts = [extract(h or "", model) for h in batch.column("html").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string()),
                                              pa.array([len(t) for t in texts], pa.int64())], ["page_id", "url", "text", "n_chars"])

    return pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), "html").mapInArrow(
        run, "page_id long, url string, text string, n_chars long")


def op4_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = read_table(spark, sf_dir, "pages")
    return main_text(pages, fit(pages))


# Labelled pages. A node without data-label has its parent's; the page itself is other.
LABELLED = (
    """<body><header class="site-header"><div class="logo">Daily News</div><nav class="main-menu"><ul><li><a href="/">Home</a></li>
<li><a href="/w">World</a></li></ul></nav></header><div class="cookie-notice" role="alert"><p>We use cookies to improve this site.</p>
<button>Accept</button></div><main data-label="content"><article><h1>Rain ends the drought</h1><p>Rain fell for three days in the valley, and the river rose again.</p>
<p>Farmers said they had waited since spring.</p><h2>What comes next</h2><ul><li>The dams will be filled first.</li><li>Fields follow in May.</li></ul>
<blockquote>We have never seen this before.</blockquote><div class="ad advert" data-label="other"><p>Buy two, pay one. Only today!</p></div>
<p>No.</p><section class="comments" id="comments" data-label="other"><h3>Comments</h3><div class="comment"><p>I live there and it was about time. Good report.</p></div>
<div class="comment"><p>First!</p></div><form><textarea>Your comment</textarea><button>Send</button></form></section></article></main>
<aside class="sidebar"><h3>Most read</h3><ul><li><a href="/1">Ten ways to sleep better</a></li></ul></aside>
<footer class="site-footer"><p>Copyright Daily News. All rights reserved.</p><p>Contact us for reprints of any text on this page.</p></footer></body>""",
    """<body><div id="header" class="header"><h1>My site</h1></div><div id="nav" class="navigation menu"><ul><li><a>One</a></li><li><a>Two</a></li></ul></div>
<div class="breadcrumb breadcrumbs"><a>Home</a> / <a>Texts</a></div><div id="content" class="content post entry" data-label="content"><h2>How bread rises</h2>
<p>Yeast feeds on sugar and gives off gas. The dough holds it.</p><div>Warm places help, as any baker knows.</div><pre>1 kg flour</pre>
<table><tr><td>Flour</td><td>1 kg</td></tr></table><div class="share social" data-label="other"><a>Share this</a></div>
<div class="related" data-label="other"><h4>Related</h4><ul><li><a>How cheese ages</a></li></ul></div></div>
<div id="sidebar" class="sidebar widget"><div class="newsletter subscribe signup"><p>Get our newsletter every week.</p><form><label>Mail</label></form></div></div>
<div id="footer" class="footer"><p>All rights reserved.</p></div></body>""",
    """<body><div class="banner promo sponsored advertisement"><p>Our sponsors bring you this page. Read more about them.</p></div>
<article class="story" data-label="content"><header data-label="other"><p>Section: Science</p></header><h1>A new moon</h1><p>Astronomers found it by chance.</p>
<figure><figcaption>The moon, seen in March.</figcaption></figure><p>It is small.</p><aside class="notice" data-label="other"><p>This text is older than a year.</p></aside>
<div class="responses discussion replies" data-label="other"><p>What a find! I had hoped for this for years, to be honest.</p></div>
<footer data-label="other"><p>Written by a member of staff.</p></footer></article>
<div class="popup modal consent"><p>Please accept our terms to go on reading.</p></div>
<form class="search login"><label>Search this site</label><select><option>All</option></select><button>Go</button></form></body>""",
    """<body><nav><ul><li><a>Start</a></li><li><a>About</a></li><li><a>Contact</a></li></ul></nav><div class="ad ads"><p>Cheap flights to the sun.</p></div>
<article data-label="content"><h1>Notes</h1><p>Short.</p><p>Another line that says a little more than the one before it.</p><ol><li>One</li><li>Two</li></ol>
<dl><dt>Term</dt><dd>What it means.</dd></dl></article><footer>Imprint and terms of use.</footer></body>""",
    """<body data-label="content"><h1>Plain page</h1><p>It has no box around its text, just paragraphs.</p><p>Two of them.</p>
<div data-label="other"><a>Back to the list</a></div></body>""",
    """<body><div class="wrapper layout container page"><div class="main inner"><div class="text body article" data-label="content"><h2>On salt</h2>
<p>Salt was money once, and roads were named after it.</p><p>Not any more.</p></div></div><div class="column rail"><h3>Latest</h3>
<p>Five things to know about pepper, and where to buy it.</p><p>Sugar prices rise once more this week.</p></div></div></body>""",
)
