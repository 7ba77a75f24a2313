"""HTML main-text extraction (operator 10): gradient-boosted trees over
DOM-node features with hierarchical decoding.

Every element of a page becomes a row of features: its tag and attribute
words, those of its ancestors, depth, siblings, and the density of text, links
and punctuation in its subtree.  Trees give each node the log-odds of being
main text.  Decoding looks at the whole tree: on every way from the root the
nodes are first outside, then inside, then taken out again (an advert in an
article), never inside once more; a pass up the tree finds the best total of
log-odds under that rule.

Labels come from pages that say where their article is (``article`` or
``main`` elements, less the elements in them that are named as something
else), taken from a bounded sample of the table, and from a small set of
templates with menus, notices, comments and forms.  Each page is learned
twice, the second time with its sectioning tags replaced by ``div``, so that
pages without them are told by density and attributes.

Defined cases: null and empty pages give an empty text; unclosed, stray and
misnested tags and very deep trees are read without recursion and in linear
time; a character reference lies within one text node, tags cut it; repeated rows
give repeated results; null ids stay null; an empty table gives an empty
result; other columns are ignored.
"""

from __future__ import annotations

import re
from html import unescape
from math import log1p

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm import gbt
from tessera.llm.chunks import slices
from tessera.llm.common import hash_sample

SAMPLE = 400  # pages
SAMPLE_CHARS = 100_000  # longer pages are not fitted on

# Fixed values of HTML.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript template iframe noembed noframes xmp".split())
CLOSES_P = frozenset(
    "address article aside blockquote details div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 "
    "header hr main menu nav ol p pre section table ul".split())
BLOCK = CLOSES_P | frozenset(
    "html body head li dt dd tr td th thead tbody tfoot caption option select button title dialog summary".split())
SELF_CLOSING = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"},
                "th": {"td", "th"}, "option": {"option"}}
SCOPE = frozenset("ul ol dl table select html body".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
FORM = frozenset("form input button select option textarea label fieldset".split())
SECTIONS = frozenset("article main nav header footer aside section".split())
# Words of attributes that page authors use for main text and for the rest.
INNER = frozenset("article articlebody body content entry main post story text".split())
OUTER = frozenset(
    "ad ads advert advertisement advertising banner breadcrumb breadcrumbs comment comments consent cookie cookies "
    "copyright disqus discussion dialog footer foot gdpr header hidden login masthead menu modal nav navbar navigation "
    "newsletter notice notices pager pagination popup promo promoted promotion recommended related reply replies "
    "respond search share sharing shoutbox sidebar signup social sponsor sponsored subscribe tags toolbar topbar "
    "widget widgets alert".split())

# As HTML reads a tag: quotes count only where a value begins, other values end at white space or ">".
# A quote without its partner is an ordinary character, so the tag still ends.
PART = re.compile(r"""[\s/]++|(?:=[^\s/>=]*+|[^\s/>=]++)(?:\s*+=\s*+(?:"[^"]*+"|'[^']*+'|[^\s>]*+))?+""")
# The same for a whole tag whose quotes all have partners, which nothing behind it can change.
TAG = re.compile(
    r"""<(/?)([a-zA-Z][^\s/>]*+)"""
    r"""((?:[\s/]++|(?:=[^\s/>=]*+|[^\s/>=]++)(?:\s*+=\s*+(?:"[^"]*+"|'[^']*+'|(?!["'])[^\s>]*+)|(?!\s*+=)))*+)>""")
SHORT = 512  # characters of a tag read at once; longer ones are read part by part
NAME_ENDS = re.compile(r"[\s/>]")
ATTR = re.compile(r"""(?:^|[\s"'/])(?:class|id|role|itemprop)\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+)""", re.I)
WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
ZEROS, LARGE = re.compile(r"&#0+(?=[0-9])"), re.compile(r"&#[0-9]{8,}")


class Tags:
    """Comments, declarations and tags of a page, from the left.

    A tag may fail to end only at the end of the page.  Where its parts began
    is kept, and a later "<" that comes upon one of those places fails at
    once, so any page is read in linear time."""

    __slots__ = ("html", "last", "dead", "name")

    def __init__(self, html: str):
        self.html, self.last = html, html.rfind(">")
        self.dead: set[int] = set()
        self.name = (0, 0)  # a stretch that holds no end of a name, and where it stops

    def find(self, pos: int):
        """(start, end, closing, name, attributes) of the next one, its name
        None for comments and declarations; None if there is none."""
        html, n = self.html, len(self.html)
        lt = html.find("<", pos)
        while lt >= 0:
            c = html[lt + 1:lt + 2]
            if c == "!" and html.startswith("--", lt + 2):
                end = html.find("-->", lt + 4)
                return lt, end + 3 if end >= 0 else n, "", None, ""
            if lt > self.last:  # nothing but comments can end
                lt = html.find("<!--", lt + 1)
                continue
            if c == "!" or c == "?":
                return lt, html.index(">", lt + 2) + 1, "", None, ""
            m = TAG.match(html, lt, min(n, lt + SHORT))
            if m:
                return lt, m.end(), m[1], m[2], m[3]
            start = lt + 2 if c == "/" else lt + 1
            if html[start:start + 1].isalpha() and html[start].isascii():
                got = self.parts(start)
                if got:
                    stop, end = got
                    return lt, end + 1, "/" if c == "/" else "", html[start:stop], html[stop:end]
            lt = html.find("<", lt + 1)
        return None

    def parts(self, start: int) -> tuple[int, int] | None:
        """Where the name and the tag that begin at ``start`` end."""
        html, n = self.html, len(self.html)
        if not self.name[0] <= start < self.name[1]:
            m = NAME_ENDS.search(html, start)
            self.name = (start, m.start() if m else n)
        stop = i = self.name[1]
        seen = []
        while i < n and i not in self.dead:
            if html[i] == ">":
                return stop, i
            seen.append(i)
            i = PART.match(html, i).end()
        self.dead.update(seen)
        return None


class Page:
    """Elements in document order and the text between tags.

    ``items`` holds (node, text) for texts and (node, None) for line breaks,
    in page order."""

    __slots__ = ("tags", "parents", "words", "items")

    def __init__(self, html: str):
        self.tags, self.parents, self.words = ["#page"], [-1], [frozenset()]
        self.items: list[tuple[int, str | None]] = []
        tags, parents = self.tags, self.parents
        at, pos = 0, 0
        opened = {"p": 0}  # open elements by name: ends without a partner cost nothing
        # Open elements that may end by themselves, a list for each open scope: one of a kind at most.
        scopes: list[list[int]] = [[]]

        def close_to(node: int) -> int:
            i = at
            while True:
                t = tags[i]
                opened[t] -= 1
                if t in SCOPE:
                    scopes.pop()
                elif t in SELF_CLOSING:
                    scopes[-1].pop()
                if i == node:
                    return parents[i]
                i = parents[i]

        n = len(html)
        found = Tags(html)
        while pos < n:
            m = found.find(pos)
            end = m[0] if m else n
            if end > pos:
                self.items.append((at, html[pos:end]))
            if not m:
                break
            _, pos, closing, name, attributes = m
            if name is None:
                continue
            name = name.lower()
            if closing:
                if opened.get(name):
                    i = at
                    while tags[i] != name:
                        i = parents[i]
                    at = close_to(i)
                continue
            if name in CLOSES_P and opened["p"]:
                i = at
                while tags[i] != "p":
                    i = parents[i]
                at = close_to(i)
            ends = SELF_CLOSING.get(name)
            if ends:
                outermost = next((i for i in scopes[-1] if tags[i] in ends), 0)
                if outermost:
                    at = close_to(outermost)
            if name == "br":
                self.items.append((at, None))
            if name in VOID:
                continue
            tags.append(name)
            parents.append(at)
            got = ATTR.findall(attributes) if "=" in attributes else ()
            self.words.append(frozenset(w.lower() for a in got for w in WORD.findall(a)) if got else frozenset())
            node = len(tags) - 1
            if name in RAW:
                stop = re.compile(f"</{re.escape(name)}(?=[\\s/>])[^>]*>", re.I).search(html, pos, found.last + 1)
                if name == "title":
                    self.items.append((node, html[pos:stop.start() if stop else n]))
                pos = stop.end() if stop else n
                continue
            at = node
            opened[name] = opened.get(name, 0) + 1
            if name in SCOPE:
                scopes.append([])
            elif ends:
                scopes[-1].append(node)


FEATURES = (
    "article main section div body p heading list item nav header footer aside form table link inline raw title_or_head "
    "inner_word outer_word above_inner above_outer above_article above_other above_form depth children own_chars chars "
    "share links words density stops siblings same_siblings place blocks").split()


def features(page: Page, plain: bool = False):
    """One row a node; ``plain``: sectioning tags count as ``div``."""
    import numpy as np

    tags, parents, n = page.tags, page.parents, len(page.tags)
    if plain:
        tags = ["div" if t in SECTIONS else t for t in tags]
    own, stops, words = [0] * n, [0] * n, [0] * n
    for node, text in page.items:
        if text:
            k = len(text.strip())
            own[node] += k
            if k:
                words[node] += text.count(" ") + 1
                stops[node] += text.count(".") + text.count(",")
    chars, count, blocks, link = own[:], [1] * n, [0] * n, [0] * n
    children: list[list[int]] = [[] for _ in range(n)]
    for i in range(n - 1, 0, -1):
        p = parents[i]
        link[i] = chars[i] if tags[i] == "a" else link[i]
        chars[p] += chars[i]
        words[p] += words[i]
        stops[p] += stops[i]
        count[p] += count[i]
        link[p] += link[i]
        blocks[p] += blocks[i] + (tags[i] in BLOCK)
        children[p].append(i)
    total = max(1, chars[0])
    same, place = [1] * n, [0.0] * n
    for kids in children:
        if len(kids) > 1:
            names: dict[str, int] = {}
            for c in kids:
                names[tags[c]] = names.get(tags[c], 0) + 1
            for j, c in enumerate(reversed(kids)):
                same[c], place[c] = names[tags[c]], j / (len(kids) - 1)
    depth, above = [0] * n, [(0, 0, 0, 0, 0)] * n
    rows = []
    for i in range(n):
        t, w = tags[i], page.words[i]
        inner, outer = not w.isdisjoint(INNER), not w.isdisjoint(OUTER)
        p = parents[i]
        if p >= 0:
            depth[i] = depth[p] + 1
        a = above[p] if p >= 0 else (0, 0, 0, 0, 0)
        above[i] = (a[0] or inner, a[1] or outer, a[2] or t in ("article", "main"),
                    a[3] or t in ("nav", "header", "footer", "aside"), a[4] or t in FORM)
        k = chars[i]
        rows.append((
            t == "article", t == "main", t == "section", t == "div", t in ("body", "html", "#page"), t == "p",
            t in HEADINGS, t in ("ul", "ol", "dl"), t in ("li", "dt", "dd"), t == "nav", t == "header", t == "footer",
            t == "aside", t in FORM, t in ("table", "tr", "td", "th"), t == "a", t not in BLOCK and t != "a",
            t in RAW, t in ("title", "head"), inner, outer, *a, min(depth[i], 50), log1p(len(children[i])),
            log1p(own[i]), log1p(k), k / total, link[i] / (k or 1), log1p(words[i]), log1p(k / count[i]),
            stops[i] / (words[i] or 1), log1p(len(children[p]) if p >= 0 else 1), log1p(same[i]), place[i],
            log1p(blocks[i])))
    return np.array(rows, np.float64)


def named_labels(page: Page) -> list[int] | None:
    """1 for nodes of the article a page names, None if it names none."""
    inside: list[int] = []
    for t, w, p in zip(page.tags, page.words, page.parents):
        up = inside[p] if p >= 0 else 0
        if up == 1 and (t in ("nav", "footer", "aside") or t in FORM or t in RAW or not w.isdisjoint(OUTER)):
            up = -1
        elif up == 0 and t in ("article", "main") and w.isdisjoint(OUTER):
            up = 1
        elif up == 0 and (t in ("nav", "footer", "aside") or t in FORM or not w.isdisjoint(OUTER)):
            up = -1
        inside.append(up)
    return [int(x == 1) for x in inside] if 1 in inside else None


def decode(page: Page, margin) -> list[bool]:
    """Nodes inside the main text: the labelling outside* inside* outside* on
    each way down that has the largest sum of log-odds inside."""
    n, parents = len(page.tags), page.parents
    m = margin.tolist() if hasattr(margin, "tolist") else list(margin)
    # Best totals of a subtree: its root inside, or still outside.
    inside, outside = m[:], [0.0] * n
    for i in range(n - 1, 0, -1):
        p = parents[i]
        inside[p] += inside[i] if inside[i] > 0 else 0.0  # else taken out below here
        best = inside[i] if inside[i] > outside[i] else outside[i]
        outside[p] += best if best > 0 else 0.0
    state = ["out"] * n
    if inside[0] > outside[0] and inside[0] > 0:
        state[0] = "in"
    for i in range(1, n):
        up = state[parents[i]]
        if up == "in":
            state[i] = "in" if inside[i] > 0 else "gone"
        elif up == "out":
            state[i] = "in" if inside[i] > outside[i] and inside[i] > 0 else "out"
        else:
            state[i] = "gone"
    return [s == "in" for s in state]


def decoded(text: str) -> str:
    """Character references of one text node as characters; a number of any
    length is read."""
    if "&#" in text:
        text = LARGE.sub("&#1114112", ZEROS.sub("&#", text))  # all above the last code point alike
    return unescape(text) if "&" in text else text


def text_of(page: Page, inside: list[bool]) -> str:
    """Blocks of the chosen nodes in page order, white space as one space."""
    block = [0] * len(page.tags)
    for i in range(1, len(block)):
        block[i] = i if page.tags[i] in BLOCK else block[page.parents[i]]
    out, run, last = [], [], None
    for node, text in page.items:
        b = block[node]
        if b != last:
            out.append("".join(run))
            run, last = [], b
        if inside[node]:
            run.append(" " if text is None else decoded(text))
    out.append("".join(run))
    return "\n".join(x for x in (" ".join(x.split()) for x in out) if x)


def templates(n: int = 120) -> list[str]:
    """Pages with the parts that sites put around an article, which is
    marked by its tag."""
    import random

    r = random.Random(5)

    def words(a, b):
        return " ".join("".join(r.choice("aeioubdklmnrst") for _ in range(r.randint(2, 9))) for _ in range(r.randint(a, b)))

    def para():
        return "<p>" + ". ".join(words(5, 18).capitalize() for _ in range(r.randint(1, 6))) + ".</p>"

    def links(k):
        return "<ul>" + "".join(f'<li><a href="/{i}">{words(1, 3)}</a></li>' for i in range(k)) + "</ul>"

    pages = []
    for _ in range(n):
        body = "".join(r.choice([para, para, para, lambda: f"<h2>{words(2, 6)}</h2>", lambda: "<ul>" + "".join(
            f"<li>{words(4, 12)}.</li>" for _ in range(3)) + "</ul>", lambda: f"<blockquote>{words(8, 25)}.</blockquote>"])()
            for _ in range(r.randint(2, 12)))
        advert = f'<div class="{r.choice(["ad", "advert", "promo", "sponsored", "banner-ad"])}">{words(4, 14)}.</div>'
        if r.random() < 0.4:
            body += advert + para()
        start, end = r.choice([("<article>", "</article>"), ("<main>", "</main>"), ("<main><article>", "</article></main>"),
                               ('<article class="post">', "</article>")])
        around = [
            f"<nav>{links(r.randint(3, 8))}</nav>", f'<div class="{r.choice(["menu", "navbar", "breadcrumb"])}">{links(4)}</div>',
            f'<header class="site-header"><h1>{words(1, 3)}</h1>{links(3)}</header>', advert,
            f'<div class="cookie-{r.choice(["notice", "banner", "consent"])}"><p>{words(8, 20)}.</p><button>{words(1, 2)}</button></div>']
        after = [
            f'<aside class="sidebar"><h3>{words(1, 3)}</h3><p>{words(10, 30)}.</p>{links(5)}</aside>',
            f'<div class="sidebar"><p>{words(10, 30)}.</p>{links(4)}</div>',
            f'<section id="comments" class="comments"><h3>{words(1, 2)}</h3>' + "".join(
                f'<div class="comment"><p>{words(6, 40)}.</p></div>' for _ in range(r.randint(1, 5))) + "</section>",
            f'<form action="/s"><label>{words(1, 4)}</label><input name="q"><button>{words(1, 2)}</button></form>',
            f'<div class="related">{links(4)}</div>', f"<footer><p>&copy; {words(3, 12)}.</p></footer>",
            f'<div class="newsletter"><p>{words(5, 16)}.</p></div>']
        r.shuffle(around)
        r.shuffle(after)
        pages.append(f"<html><head><title>{words(2, 6)}</title><style>p{{}}</style></head><body>"
                     + "".join(around[:r.randint(1, 4)]) + '<div class="wrap">' * r.randint(0, 1) + start
                     + f"<h1>{words(3, 9)}</h1>" + body + end + "".join(after[:r.randint(1, 5)]) + "</body></html>")
    return pages


def fit_pages(pages: list[str], **options) -> gbt.Trees:
    """Trees from pages that name their article, each also without its
    sectioning tags."""
    import numpy as np

    x, y, w = [], [], []
    for html in pages:
        page = Page(html)
        labels = named_labels(page)
        if labels is None:
            continue
        for plain in (False, True):
            x.append(features(page, plain))
            y.append(np.array(labels, float))
            w.append(np.full(len(labels), 0.3 if plain else 1.0))
    return gbt.fit(np.concatenate(x), np.concatenate(y), np.concatenate(w),
                   **({"trees": 50, "depth": 5, "rate": 0.25, "bins": 32} | options))


def fit(pages: DataFrame, id_col: str = "page_id", html_col: str = "html", sample: int = SAMPLE, **options) -> gbt.Trees:
    """Trees from the templates and at most ``sample`` pages of at most
    ``SAMPLE_CHARS`` characters, those with the smallest hash."""
    some = pages.select(F.col(html_col).alias("h")).where(F.length("h").between(1, SAMPLE_CHARS))
    got = hash_sample(some.withColumn("o", F.xxhash64("h")), "o", sample, pages.count()).collect()
    return fit_pages([r["h"] for r in got] + templates(), **options)


def extract(pages: DataFrame, model: gbt.Trees, id_col: str = "page_id", url_col: str = "url",
            html_col: str = "html") -> DataFrame:
    """(id_col, url_col, text, n_chars) for each page."""
    kinds = {c: pages.schema[c].dataType.simpleString() for c in (id_col, url_col)}
    held = pages.sparkSession.sparkContext.broadcast(model)  # a few thousand numbers

    def run(batches):
        import numpy as np
        import pyarrow as pa

        trees = held.value
        for batch in batches:
            for part in slices(batch, 1 << 20):
                parsed = [Page(h) for h in part.column(2).to_pylist()]
                x = [features(p) for p in parsed]
                margins = np.split(trees.margin(np.concatenate(x)), np.cumsum([len(a) for a in x])[:-1])
                texts = [text_of(p, decode(p, m)) for p, m in zip(parsed, margins)]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), pa.array(texts, pa.string()),
                     pa.array([len(t) for t in texts], pa.int64())], names=["_id", "_url", "text", "n_chars"])

    rows = pages.select(F.col(id_col).alias("_id"), F.col(url_col).alias("_url"),
                        F.coalesce(F.col(html_col).cast("string"), F.lit("")).alias("_h"))
    out = rows.mapInArrow(run, f"_id {kinds[id_col]}, _url {kinds[url_col]}, text string, n_chars long")
    return out.select(F.col("_id").alias(id_col), F.col("_url").alias(url_col), "text", "n_chars")
