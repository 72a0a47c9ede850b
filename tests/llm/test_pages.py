"""Main texts of the given pages against another parser, and of pages written by hand in layouts that no generator here makes."""

import re
from collections import Counter
from html.parser import HTMLParser

import pytest

from martkit.llm import extraction, html_blocks, queries

FOLDER = "/root/testdata/sf0.01"
BREAKS = set("address article aside blockquote body br dd div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr html li main nav ol p pre section table tbody td tfoot th thead title tr ul".split()) - {"br"}


class Article(HTMLParser):
    """Blocks inside the article element, by the standard library's parser; elements that never hold an article left out."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.inside, self.off, self.blocks, self.now = 0, [], [], ""

    def end_block(self):
        text = " ".join(re.split(r"[\x20\x09-\x0D\xa0]+", self.now)).strip()
        if text:
            self.blocks.append(text)
        self.now = ""

    def handle_starttag(self, tag, attrs):
        if tag in BREAKS:
            self.end_block()
        if tag == "br":
            self.now += " "
        if tag == "article":
            self.inside += 1
        names = " ".join(v or "" for k, v in attrs if k in ("class", "id")).split()
        if tag in ("script", "style", "nav", "aside", "form", "footer", "header", "template", "textarea") or {"." + n for n in names} & extraction.NEVER_NAMED:
            self.off.append(tag)
        elif self.off and tag == self.off[-1]:
            self.off.append(tag)

    def handle_endtag(self, tag):
        if tag in BREAKS:
            self.end_block()
        if self.off and tag == self.off[-1]:
            self.off.pop()
        if tag == "article":
            self.inside -= 1

    def handle_data(self, data):
        if self.inside > 0 and not self.off:
            self.now += data


def other_parser(page):
    reader = Article()
    reader.feed(page)
    reader.end_block()
    return "\n\n".join(reader.blocks)


@pytest.fixture(scope="module")
def model(spark):
    return extraction.fit(spark.read.parquet(f"{FOLDER}/pages.parquet"))


def test_query_against_another_parser(spark):
    pages = {r.page_id: r for r in spark.read.parquet(f"{FOLDER}/pages.parquet").collect()}
    got = queries.op8(spark, FOLDER).collect()
    assert len(got) == len(pages) and all(r.n_chars == len(r.text) and r.url == pages[r.page_id].url for r in got)
    want = {i: other_parser(p.html or "") for i, p in pages.items()}
    words = lambda t: Counter(t.split())
    held = [(sum((words(r.text) & words(want[r.page_id])).values()), len(r.text.split()), len(want[r.page_id].split())) for r in got]
    both, ours, theirs = map(sum, zip(*held))
    assert both >= 0.98 * ours and both >= 0.98 * theirs
    assert sum(r.text == want[r.page_id] for r in got) >= 0.9 * len(got)


P = [
    "The town council met on Tuesday evening to decide whether the old bridge over the river should be closed to cars for good.",
    "Engineers had warned in spring that two of its pillars were sinking faster than expected, and that repairs would take at least three years.",
    "Shop owners on both banks fear for their customers, while parents of pupils at the nearby school have asked for the closure since last winter.",
    "A decision is expected before the end of the month; until then lorries have to use the motorway bridge north of the town.",
]
MENU = "<ul><li><a href='/'>Home</a></li><li><a href='/n'>News</a></li><li><a href='/s'>Sport</a></li><li><a href='/c'>Contact</a></li></ul>"
PAGES = {
    "blog": ("Bridge to close", f"""<html><head><title>Bridge to close - The Daily</title></head><body class="post-template"><header id="masthead"><h2><a href="/">The Daily</a></h2><nav class="main-navigation">{MENU}</nav></header>
        <div id="primary" class="content-area"><main id="main"><article class="post type-post"><h1>Bridge to close</h1><div class="entry-content"><p>{P[0]}</p><p>{P[1]}</p><blockquote><p>{P[2]}</p></blockquote><p>{P[3]}</p></div></article></main></div>
        <aside id="secondary" class="widget-area"><section class="widget"><h2>Recent posts</h2><ul><li><a href="/1">Older story</a></li></ul></section></aside><footer id="colophon"><p>Proudly powered by us</p></footer></body></html>"""),
    "news": ("Bridge to close", f"""<div class="topbar">{MENU}</div><div class="cookie-notice">We use cookies. <button>Accept</button></div><main><h1>Bridge to close</h1><p>{P[0]}</p><div class="advert">Buy a new car today and save a lot of money on it</div><p>{P[1]}</p><p>{P[2]}</p><p>{P[3]}</p></main>
        <section class="comments"><p>First!</p><p>I have lived here for thirty years and nobody ever asked us about this bridge or about anything else.</p></section><footer>&copy; 2026 The News</footer>"""),
    "plain": (None, f"""<body><div id="nav">{MENU}</div><div id="content"><p>{P[0]}<p>{P[1]}<p>{P[2]}<p>{P[3]}</div><div id="footer">Imprint | Privacy | Terms</div></body>"""),
    "list": (None, f"""<header><form action="/q"><label>Search</label><input name="q"></form></header><article><p>{P[0]}</p><ol><li>{P[1]}</li><li>{P[2]}</li></ol><p>{P[3]}</p></article><aside class="related"><h3>Read on</h3><p>Ten bridges to see before they close</p></aside>"""),
    "newsletter": (None, f"""<nav>{MENU}</nav><article><p>{P[0]}</p><p>{P[1]}</p><div class="newsletter"><form><p>Get our letter every morning</p><input><button>Sign up</button></form></div><p>{P[2]}</p><p>{P[3]}</p></article><footer><p>All stories are our own.</p></footer>"""),
}


@pytest.mark.parametrize("name", PAGES)
def test_pages_by_hand(model, name):
    """Every paragraph of the article, and next to nothing else."""
    title, page = PAGES[name]
    found = html_blocks.blocks(page)
    text = extraction.text_of(found, extraction.score(model, [html_blocks.features(found)])[0])
    got = text.split("\n\n")
    assert [p for p in got if p in P] == P
    assert len([p for p in got if p not in P and p != title]) <= 1


def test_repeated_long_and_clashing(spark):
    pages = spark.read.parquet(f"{FOLDER}/pages.parquet").select("page_id", "url", "html")
    long = "<nav>" + MENU + "</nav><article>" + "".join(f"<p>{P[k % 4]} Part {k}.</p>" for k in range(20_000)) + "</article><footer>end</footer>"
    odd = spark.createDataFrame([(-1, "u", long), (-2, "u", PAGES["blog"][1]), (-2, "u", PAGES["blog"][1]), (-3, None, None), (-4, "u", ""), (-5, "u", "<p")], pages.schema)
    whole = pages.unionAll(odd).selectExpr("*", "'x' AS text", "1 AS n_chars", "'t' AS turn")
    out = extraction.extract(whole)
    assert out.columns == ["page_id", "url", "text", "n_chars"]
    got = [r for r in out.where("page_id < 0").collect()]
    by_id = {r.page_id: r.text for r in got}
    assert len(got) == 6 and len({r.text for r in got if r.page_id == -2}) == 1
    assert by_id[-3] == by_id[-4] == "" and by_id[-1].count("\n\n") >= 19_990 and f"{P[3]} Part 19999." in by_id[-1]
