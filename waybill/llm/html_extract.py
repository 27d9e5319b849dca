"""Main text of web pages by composite text density.

For every element: characters for each tag, adjusted for links (composite text
density, after Sun, Song and Liao, "DOM based content extraction via text
density", 2011). An element's density sum is the sum of its children's
densities. The element with the largest sum is the core; the least density on
its path to the body is the threshold. Densities are taken on the page with its
menus and boxes, without what is never shown and readers' comments, which are as
dense as an article. If the core lies in an ``article`` or ``main`` element,
the innermost is the content as a whole; otherwise every element at or above the
threshold contributes the largest-sum element of its subtree. What stands within
and is no article text by tag, role or class (forms, adverts, share bars) goes.
If the core itself is such a box, or no element is an article, boxes go first.
"""

from __future__ import annotations

import html
import math
import re

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ._common import python_ready, table, without

TOKEN = re.compile(r"""<!--.*?(?:-->|\Z)|<[!?][^>]*>?|<(?P<end>/?)(?P<tag>[a-zA-Z][^\s/>]*)(?P<attrs>(?>[^>"']|"[^"]*"|'[^']*')*+)>|<(?P<end2>/?)(?P<tag2>[a-zA-Z][^\s/>]*)(?P<attrs2>[^>]*)(?:>|\Z)""", re.S)
ATTRIBUTE = re.compile(r"""(?:^|\s)(class|id|role|hidden|aria-hidden|style|itemprop)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""", re.I)
RAW = {"script", "style", "textarea", "title", "xmp", "noembed", "noframes", "iframe", "noscript"}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
#: Elements that stand within a line; all others break it.
INLINE = {"a", "abbr", "acronym", "b", "bdi", "bdo", "big", "cite", "code", "data", "del", "dfn", "em", "font", "i", "img", "ins", "kbd", "label", "mark", "q", "rb", "rp", "rt", "ruby", "s", "samp", "small", "span", "strike", "strong", "sub", "sup", "time", "tt", "u", "var", "wbr"}
#: A start tag of these ends an open paragraph.
ENDS_P = {"address", "article", "aside", "blockquote", "center", "details", "dialog", "dir", "div", "dl", "fieldset", "figcaption", "figure", "footer", "form", "h1", "h2", "h3", "h4", "h5", "h6", "header", "hgroup", "hr", "main", "menu", "nav", "ol", "p", "pre", "search", "section", "summary", "table", "ul"}
#: tag -> (open elements it ends, elements in which the search for them stops)
ENDS = {"li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}), "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}), "tbody": ({"thead", "tbody", "tfoot"}, {"table"}), "tfoot": ({"thead", "tbody", "tfoot"}, {"table"}), "option": ({"option"}, {"select"})}
CUT = {"head", "script", "style", "noscript", "template", "iframe", "object", "embed", "svg", "canvas", "select", "button", "input", "textarea", "title", "datalist", "dialog", "noframes", "audio", "video", "map"}
#: Not rendered as a block, so the line goes on around them.
UNSEEN = CUT - {"head", "title", "dialog"}
#: Cut unless the article is inside.
CUT_OUTER = {"nav", "aside", "footer", "form", "menu"}
NOISE = set("ad ads adv advert adverts advertisement advertising adsense banner banners promo promos promotion sponsor sponsored sponsors nav navbar navigation menu menus breadcrumb breadcrumbs sidebar sidebars aside footer comment comments commentlist reply replies respond disqus cookie cookies consent gdpr notice notices notification alert alerts popup modal overlay newsletter subscribe subscription signup share sharing sharebar social related recommended recommendations widget widgets skip pagination pager toolbar login search masthead topbar disclaimer paywall complementary contentinfo feedback discussion discussions".split())
#: Words that may stand beside those of NOISE in a token; with any other word (related-work, elementor-widget) it isn't noise.
BESIDE = set("site page global main primary secondary left right top bottom area bar block box body container content inner outer item items list link links wrap wrapper section thread author meta form li div id post".split())
HEADINGS = {"h1", "h2", "h3", "h4", "h5", "h6"}
#: Only outside an article.
NOISE_OUTER = {"header"}
COMMENTS = {"comments", "comment", "commentlist", "disqus", "replies"}
HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)
HTML = "__wb_html"
SPLIT = re.compile(r"[^a-z0-9]+")
CAMEL = re.compile(r"(?<=[a-z])(?=[A-Z])")


class Dom:
    """Elements in page order with their parents, and the page's texts and line breaks as they come."""

    def __init__(self, source: str):
        self.tag, self.attrs, self.parent = ["html"], [""], [-1]
        #: (element, text), or (-1, "") where a block begins or ends
        self.flow: list[tuple[int, str]] = []
        self._stack = [0]
        self._read(source)

    def _pop(self, k: int) -> None:
        if any(self._breaks(self.tag[i]) for i in self._stack[k:]):
            self.flow.append((-1, ""))
        del self._stack[k:]

    @staticmethod
    def _breaks(tag: str) -> bool:
        return tag not in INLINE and tag not in UNSEEN

    def _find(self, names: set[str], stop) -> int | None:
        """Where in the stack an open element of these stands, the outermost before ``stop(tag)``."""
        at = None
        for k in range(len(self._stack) - 1, 0, -1):
            tag = self.tag[self._stack[k]]
            if tag in names:
                at = k
            elif stop(tag):
                break
        return at

    def _start(self, tag: str, attrs: str) -> None:
        if tag == "html" or tag == "body" and "body" in self.tag:
            return
        if tag in ENDS_P and (k := self._find({"p"}, lambda t: t not in INLINE)) is not None:
            self._pop(k)
        if tag in ENDS:
            ended, stop = ENDS[tag]
            if (k := self._find(ended, stop.__contains__)) is not None:
                self._pop(k)
        if tag == "body" and (k := self._find({"head"}, lambda t: False)) is not None:
            self._pop(k)
        if self._breaks(tag):
            self.flow.append((-1, ""))
        self.tag.append(tag)
        self.attrs.append(attrs)
        self.parent.append(self._stack[-1])
        if tag not in VOID:
            self._stack.append(len(self.tag) - 1)

    def _end(self, tag: str) -> None:
        for k in range(len(self._stack) - 1, 0, -1):
            name = self.tag[self._stack[k]]
            if name == tag:
                return self._pop(k)
            if tag in INLINE and name not in INLINE:
                return None  # an inline end tag closes nothing beyond its block
        if tag in ("br", "p"):
            self.flow.append((-1, ""))

    def _read(self, source: str) -> None:
        at = 0
        while m := TOKEN.search(source, at):
            if m.start() > at:
                self.flow.append((self._stack[-1], source[at : m.start()]))
            at = m.end()
            tag = (m["tag"] or m["tag2"] or "").lower()
            if not tag:
                continue
            if m["end"] or m["end2"]:
                self._end(tag)
                continue
            attrs = m["attrs"] or m["attrs2"] or ""
            self._start(tag, attrs)
            if attrs.endswith("/") and tag in ("svg", "math"):
                self._pop(len(self._stack) - 1)
            elif tag in RAW:
                close = re.compile(rf"</{tag}(?=[\s/>]|\Z)", re.I).search(source, at)
                at = close.start() if close else len(source)
        if at < len(source):
            self.flow.append((self._stack[-1], source[at:]))


def _names(attrs: str) -> tuple[set[str], bool]:
    """The words of NOISE and NOISE_OUTER, and ``main``, that tokens of an element's class, id and role name; whether it is hidden."""
    words, hidden = set(), False
    for name, *values in ATTRIBUTE.findall(attrs):
        name, value = name.lower(), "".join(values)
        if name in ("class", "id", "role"):
            for token in value.split():
                parts = {x for x in SPLIT.split(CAMEL.sub("-", token).lower()) if x and not x.isdigit()}
                known = parts & (NOISE | NOISE_OUTER)
                if parts <= known | BESIDE:
                    words |= known
                if "main" in parts:
                    words.add("main")
        elif name == "hidden" or name == "aria-hidden" and value.lower() == "true" or name == "style" and HIDDEN.search(value):
            hidden = True
    return words, hidden


def _cut(dom: Dom, all_noise: bool = True) -> tuple[list[bool], list[bool], list[bool]]:
    """(elements that aren't article text, those within an article, elements that are an article)

    all_noise: without it, only what is never shown as text goes, and readers' comments, which are as dense as an article.
    """
    tag, parent, n = dom.tag, dom.parent, len(dom.tag)
    named = [_names(a) if a else (set(), False) for a in dom.attrs]
    sure = [t in CUT or hidden for t, (_, hidden) in zip(tag, named)]
    page = [t in ("html", "body", "main") for t in tag]
    likely = [not page[i] and (tag[i] in CUT_OUTER or bool(named[i][0] & NOISE)) for i in range(n)]
    talk = [False] * n  # in readers' comments, whose single comments may be article elements
    for i in range(1, n):
        talk[i] = talk[parent[i]] or not page[i] and bool(named[i][0] & COMMENTS)
    article = [(tag[i] in ("article", "main") or "main" in named[i][0]) and not likely[i] and not talk[i] for i in range(n)]
    holds = list(article)
    for i in range(n - 1, 0, -1):
        holds[parent[i]] = holds[parent[i]] or holds[i]
    gone, within = [False] * n, list(article)
    for i in range(1, n):
        p = parent[i]
        within[i] = within[p] or article[i]
        outer = not page[i] and not within[i] and (tag[i] == "header" or bool(named[i][0] & NOISE_OUTER))
        # Ids of headings and sections in an article are slugs of its own words.
        slug = within[p] and tag[i] in HEADINGS | {"section"} and not named[i][0] & COMMENTS
        # Whatever its class says, an element around an article isn't noise.
        gone[i] = gone[p] or sure[i] or talk[i] and not holds[i] or all_noise and not holds[i] and (likely[i] and not slug or outer)
    return gone, within, article


class Densities:
    """Composite text density and density sum of every element, from those that aren't cut.

    density: characters a tag, times the logarithm of characters and tags over
    those in links, to a base that grows with the share of links of element and page.
    """

    def __init__(self, dom: Dom, flow: list[tuple[int, str]], gone: list[bool]):
        tag, parent, n = dom.tag, dom.parent, len(dom.tag)
        linked = [False] * n
        for i in range(1, n):
            linked[i] = linked[parent[i]] or tag[i] == "a"
        self.chars, self.links, self.tags, self.link_tags = [0] * n, [0] * n, [0] * n, [0] * n
        page_chars = page_links = 0
        for i, t in flow:
            if i >= 0 and tag[i] not in CUT:
                c = len("".join(t.split()))
                page_chars += c
                page_links += c * linked[i]
                if not gone[i]:
                    self.chars[i] += c
                    self.links[i] += c * linked[i]
        for i in range(n - 1, 0, -1):
            if not gone[i]:
                p = parent[i]
                self.chars[p] += self.chars[i]
                self.links[p] += self.links[i]
                self.tags[p] += self.tags[i] + 1
                self.link_tags[p] += self.link_tags[i] + (tag[i] == "a")
        share = page_links / max(1, page_chars)
        self.density = [self.of(self.chars[i], self.links[i], self.tags[i], self.link_tags[i], share) for i in range(n)]
        self.sums = [0.0] * n
        for i in range(1, n):
            self.sums[parent[i]] += self.density[i]

    @staticmethod
    def of(c: int, lc: int, t: int, lt: int, share: float) -> float:
        if not c:
            return 0.0
        lc, t, lt = max(1, lc), max(1, t), max(1, lt)
        # The logarithm's base: near 1 without any link, so its own logarithm is held at 0.1.
        base = math.log(math.log(c / max(1, c - lc) * lc + share * c + math.e))
        return c / t * math.log(max(1.0, c / lc * t / lt)) / max(base, 0.1)

    def select(self, dom: Dom) -> tuple[list[int], float, list[int]]:
        """(path from the core to the body, the least density on it, the largest-sum element of each subtree)."""
        n, parent = len(dom.tag), dom.parent
        body = dom.tag.index("body") if "body" in dom.tag else 0
        top = list(range(n))  # the outermost on ties
        for i in range(n - 1, 0, -1):
            if self.sums[top[i]] > self.sums[top[parent[i]]]:
                top[parent[i]] = top[i]
        path = [top[body] if self.chars[body] else top[0]]
        while path[-1] not in (body, 0):
            path.append(parent[path[-1]])
        return path, min(self.density[i] for i in path), top


def main_text(source: str | None, densities: type[Densities] = Densities) -> str:
    """The main text of one page; empty if there is none. densities: how elements are weighed."""
    if not source:
        return ""
    dom = Dom(source)
    tag, parent, n = dom.tag, dom.parent, len(dom.tag)
    flow = [(i, html.unescape(t) if "&" in t else t) for i, t in dom.flow]
    # Density chooses on the page with its menus and boxes; only what is no article text whatever its density is cut before.
    bare, _, article = _cut(dom, False)
    weights = densities(dom, flow, bare)
    if not weights.chars[0]:
        return ""
    path, threshold, top = weights.select(dom)
    gone = _cut(dom)[0]
    home = next((i for i in path if article[i]), None)
    if home is None and (gone[path[0]] or not any(article)):
        # The core is a box, or nothing marks an article: density again without the boxes, unless nothing is left.
        weights = densities(dom, flow, gone)
        if not weights.chars[0]:
            gone, weights = bare, densities(dom, flow, bare)
        path, threshold, top = weights.select(dom)
        home = next((i for i in path if article[i]), None)
    content = [False] * n
    if home is not None:
        content[home] = True  # a whole article, with its headings, which are sparse
    else:
        content[path[0]] = True
        for i in range(n):
            if weights.density[i] >= threshold and weights.chars[i]:
                content[top[i]] = True
    within = list(article)
    for i in range(1, n):
        within[i] = within[i] or within[parent[i]]
        # Outside an article a list of nothing but links is a menu; in one it may be its sources.
        menu = not within[i] and tag[i] in ("ul", "ol") and weights.link_tags[i] >= 3 and weights.links[i] == weights.chars[i]
        content[i] = (content[i] or content[parent[i]]) and not gone[i] and not menu
    out = []
    for i, t in flow:
        out.append(" " if i < 0 else t if content[i] else "")
    return " ".join("".join(out).split())


def extract_main_text(pages: DataFrame, html_col: str = "html", text_col: str = "text") -> DataFrame:
    """``pages`` without the html, with the main text in ``text_col``.

    A null, empty or textless page gives an empty text. Broken markup is read as
    browsers do, roughly; a page cut off in the middle gives the text so far.
    Repeated rows each get their text; an input column named ``text_col`` is
    replaced. White space, no-break spaces included, turns into single spaces.
    """
    python_ready(pages.sparkSession)
    keep = without(pages.drop(html_col), text_col)
    rows = pages.select(*[F.col(f"`{c}`") for c in keep.columns], F.col(html_col).cast("string").alias(HTML))
    schema = T.StructType([*keep.schema.fields, T.StructField(text_col, T.StringType())])

    def run(batches):
        for batch in batches:
            for k in range(0, batch.num_rows, 256):
                part = batch.slice(k, 256)
                texts = pa.array([main_text(x) for x in part.column(part.num_columns - 1).to_pylist()], pa.string())
                yield pa.RecordBatch.from_arrays([*part.columns[:-1], texts], names=[*part.schema.names[:-1], text_col])

    return rows.mapInArrow(run, schema)


def op5_html_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = extract_main_text(table(spark, sf_dir, "pages").select("page_id", "url", "html"))
    return out.select("page_id", "url", "text", F.char_length("text").cast("long").alias("n_chars"))


QUERIES = {"op5_html_extract": op5_html_extract}
ORACLES: dict[str, str] = {}
