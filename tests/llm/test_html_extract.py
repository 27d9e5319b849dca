"""Main text extraction on small pages, with the text each must give."""

import math
import random
import re

import pytest

from waybill.llm.html_extract import Densities, Dom, extract_main_text, main_text

P1 = "The first paragraph is long enough to look like an article, with some commas, and words."
P2 = "The second one goes on about the same thing for a while and ends with a full stop."
NAV = '<nav><ul><li><a href="/a">Home</a></li><li><a href="/b">News</a></li><li><a href="/c">About</a></li></ul></nav>'
PAGES = [
    (None, ""),
    ("", ""),
    ("   ", ""),
    ("<html><body></body></html>", ""),
    (f"<html><head><title>T</title><style>p{{}}</style></head><body>{NAV}<article><h1>Head</h1><p>{P1}</p><p>{P2}</p></article><footer>&copy; x</footer></body></html>", f"Head {P1} {P2}"),
    # unclosed elements, as in <p><b>..<br><p>, and a script with markup in it
    (f'<body><script>var t="</p>";</script>{NAV}<div class="ad">Buy this. Now.</div><article><h1>Head</h1><p><b>Lead.<br><p>{P1}</p></article><footer>foot</footer>', f"Head Lead. {P1}"),
    # cut off in a tag
    (f"<body><article><p>{P1}</p><p>{P2}</p><p cla", f"{P1} {P2}"),
    # no article element: the densest block
    (f'<body><div id="header"><a href="/">Site</a></div>{NAV}<div id="content"><h1>Head</h1><p>{P1}</p><p>{P2}</p><p>Short.</p></div><div class="sidebar"><p>{P2}{P2}</p></div><div id="footer">foot</div></body>', f"Head {P1} {P2} Short."),
    # comments that are longer than the article, as article elements
    (f'<body><article><h1>Head</h1><p>{P1}</p></article><section id="comments"><article class="comment"><p>{P2 * 9}</p></article></section></body>', f"Head {P1}"),
    (f'<body><main><h1>Head</h1><p>{P1}</p><div class="comments"><div class="comment"><p>{P2 * 9}</p></div></div><form><label>Mail</label><input></form></main></body>', f"Head {P1}"),
    # a wrapper whose class names a sidebar holds the article
    (f'<body><div class="with sidebar"><article><p>{P1}</p></article></div></body>', P1),
    # inline elements don't break words, blocks and line breaks do; references are decoded once
    (f"<article><p>{P1} a<b>b</b>c &amp;lt; &#233;&eacute;&nbsp;x<br>y</p><ul><li>one</li><li>two</li></ul><table><tr><td>1<td>2<tr><td>3</table></article>", f"{P1} abc &lt; éé x y one two 1 2 3"),
    (f'<article><header><h1>Head</h1></header><p>{P1}</p><p>See <a href="/x">that page</a> too.</p></article>', f"Head {P1} See that page too."),
    (f'<body><div hidden>no</div><div style="display: none">no</div><div class="cookie-notice"><p>{P2}</p></div><article><p>{P1}</p><!-- no --><noscript>no</noscript></article></body>', P1),
    (f"<body><p>{P1}</p><p>{P2}</p></body>", f"{P1} {P2}"),
    (f"<article><p>1 < 2 and 3 > 2, {P1}</p></article>", f"1 < 2 and 3 > 2, {P1}"),
    ("just text, no markup", "just text, no markup"),
]


@pytest.mark.parametrize("page,text", PAGES)
def test_main_text(page, text):
    assert main_text(page) == text


def test_very_long_page():
    page = f"{NAV}<article>" + f"<p>{P1}</p>" * 20_000 + "</article>"
    assert main_text(page) == " ".join([P1] * 20_000)
    assert main_text("<div>" * 50_000 + P1) == P1


def test_operator(spark):
    rows = [(k, "u", p, 1) for k, (p, _) in enumerate(PAGES)] + [(None, None, PAGES[4][0], None)]
    out = extract_main_text(spark.createDataFrame(rows, "page_id long, url string, html string, TEXT int"))
    assert out.columns == ["page_id", "url", "text"]
    assert sorted((r.page_id if r.page_id is not None else -1, r.text) for r in out.collect()) == [(-1, PAGES[4][1])] + [(k, t) for k, (_, t) in enumerate(PAGES)]
    assert extract_main_text(spark.createDataFrame([], "page_id long, url string, html string")).collect() == []


@pytest.mark.parametrize(
    "page,text",
    [
        (f'<article><h2 id="related-work">Related work</h2><p>{P1}</p><h2 id="search">Search</h2><section id="discussion"><p>{P2}</p></section></article>', f"Related work {P1} Search {P2}"),
        (f'<body><div class="elementor-widget elementor-widget-text-editor"><p>{P1}</p></div><div class="elementor-widget"><p>{P2}</p></div></body>', f"{P1} {P2}"),
        (f'<body><div class="widget"><p>{P1}</p><p>{P2}</p></div></body>', f"{P1} {P2}"),
        (f'<article><p>{P1}</p><section id="comments"><p>{P2}</p></section><div class="comment-list widget-area"><p>{P2}</p></div></article>', P1),
    ],
)
def test_article_words_are_not_noise(page, text):
    assert main_text(page) == text


def test_lists_of_links():
    items = "".join(f'<li><a href="/{k}">Source {k}</a></li>' for k in range(3))
    assert main_text(f"<article><p>{P1}</p><ol>{items}</ol><ul class='nav'>{items}</ul></article>") == f"{P1} Source 0 Source 1 Source 2"
    assert main_text(f"<body><div><p>{P1}</p><p>{P2}</p><ul>{items}</ul></div></body>") == f"{P1} {P2}"


P = "<p>" + "Some words of a long paragraph that reads on and on. " * 6 + "</p>"


@pytest.mark.parametrize("x", ['<h2 id="related-work">Related work here</h2>', '<p id="comment-on-method">A comment para</p>', '<section id="notice-period"><p>Notice period text</p></section>', '<div class="warning">Warn text</div>', "<ul><li><a href=1>One src</a></li><li><a href=2>Two src</a></li><li><a href=3>Three src</a></li></ul>", "<p>so <math><mi>x</mi><mo>=</mo><mn>2</mn></math> holds</p>"])
def test_article_text_with_odd_names_stays(x):
    out = main_text(f"<html><body><nav><a href=0>Menu</a></nav><article><h1>T</h1>{P}{x}{P}</article></body></html>")
    assert all(w in out for w in re.sub("<[^>]+>", " ", x).split()) and "Menu" not in out


def test_body_in_one_form():
    assert main_text(f"<html><body><form>{P}{P}<input name=a><button>Go</button></form></body></html>").count("paragraph") == 12


class Flat(Densities):
    of = staticmethod(lambda c, lc, t, lt, share: 1.0 if c else 0.0)


def test_density_decides():
    """No names and no article: what is chosen depends on densities alone."""
    links = "".join(f'<div><a href="/{k}">Some link text {k}</a></div>' for k in range(12))
    page = f"<html><body><div>{links}</div><div>{P}{P}{P}</div><div><span>short</span></div></body></html>"
    assert main_text(page) == " ".join(["Some words of a long paragraph that reads on and on."] * 18)
    assert main_text(page, Flat) != main_text(page) and "Some link text" in main_text(page, Flat)
    # Of two articles the denser one is the page's.
    two = f"<html><body><article><p>tiny</p><p>bits</p><p>of</p><p>text</p><p>here</p></article><article>{P}{P}</article></body></html>"
    assert "tiny" not in main_text(two) and "tiny" in main_text(two, Flat)


def plain(dom, flow, gone, i, page):
    """(density, sum, chars, links, tags, link tags) of an element, by recursion."""
    children = [k for k in range(1, len(dom.tag)) if dom.parent[k] == i and not gone[k]]
    below = [plain(dom, flow, gone, k, page) for k in children]
    up, linked = i, False
    while up > 0:
        linked, up = linked or dom.tag[up] == "a", dom.parent[up]
    own = sum(len("".join(t.split())) for k, t in flow if k == i)
    c, lc = own + sum(b[2] for b in below), own * linked + sum(b[3] for b in below)
    t, lt = len(children) + sum(b[4] for b in below), sum(dom.tag[k] == "a" for k in children) + sum(b[5] for b in below)
    if not c:
        return 0.0, sum(b[0] for b in below), c, lc, t, lt
    x = math.log(math.log(c * max(1, lc) / max(1, c - max(1, lc)) + page[1] / page[0] * c + math.e))
    density = c / max(1, t) * math.log(max(1, c / max(1, lc) * max(1, t) / max(1, lt))) / max(x, 0.1)
    return density, sum(b[0] for b in below), c, lc, t, lt


def test_densities_against_recursion():
    r = random.Random(4)

    def tree(depth):
        if depth == 0 or r.random() < 0.2:
            return "word " * r.randrange(0, 30)
        return "".join(f"<{t}>{tree(depth - 1)}{'x ' * r.randrange(3)}</{t}>" for t in r.choices(["div", "section", "span", "a", "b", "script"], k=r.randrange(1, 5)))

    for _ in range(40):
        dom = Dom(f"<html><body>{tree(4)}</body></html>")
        gone = [t == "script" for t in dom.tag]
        for k in range(1, len(gone)):
            gone[k] = gone[k] or gone[dom.parent[k]]
        got = Densities(dom, dom.flow, gone)
        shown = [(i, len("".join(t.split()))) for i, t in dom.flow if i >= 0 and dom.tag[i] != "script"]
        def in_link(i):
            return i > 0 and (dom.tag[i] == "a" or in_link(dom.parent[i]))
        page = (max(1, sum(n for _, n in shown)), sum(n for i, n in shown if in_link(i)))
        live = [i for i in range(len(gone)) if not gone[i]]
        want = {i: plain(dom, dom.flow, gone, i, page) for i in live}
        assert [got.density[i] for i in live] == pytest.approx([want[i][0] for i in live], rel=1e-9)
        assert [got.sums[i] for i in live] == pytest.approx([want[i][1] for i in live], rel=1e-9)
        path, threshold, _ = got.select(dom)
        body = dom.tag.index("body")
        inside = [i for i in live if i >= body]
        if want[body][2]:
            assert got.sums[path[0]] == pytest.approx(max(want[i][1] for i in inside)) and path[-1] in (body, 0)
            assert threshold == pytest.approx(min(want[i][0] for i in path))
