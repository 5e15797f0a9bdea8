"""Main text of pages: exact on made pages, and on the given ones against their article element."""

import random
import re
from html import unescape

from stackroom.llm.html_blocks import read_blocks
from stackroom.llm.main_text import Weights, best_stretch, extract, fit, learn, main_text, prior
from stackroom.llm.queries import table

LONG = (
    "Alpha beta gamma delta epsilon zeta eta theta iota kappa lambda. Mu nu xi omicron pi rho sigma tau "
    "upsilon phi chi psi omega."
)


def article_of(page):
    """The text of the given pages' article element, read by their own simple form."""
    body = re.search(r"<article>(.*?)</article>", page, re.S)[1]
    parts = (re.sub(r"<br>", " ", re.sub(r"</?b>", "", p)) for p in re.split(r"</?(?:p|h1)>", body))
    return "\n\n".join(t for p in parts if (t := " ".join(unescape(p).split())))


def test_given_pages(spark):
    pages = table(spark, "/root/testdata/sf0.01", "pages")
    weights = learn(pages)
    html = {r.page_id: r.html for r in pages.collect()}
    got = extract(pages, weights).collect()
    assert len(got) == len(html)
    for row in got:
        assert row.text == article_of(html[row.page_id]) and row.n_chars == len(row.text)
    # Without the elements that tell, by all the rest.
    plain = {k: re.sub(r"</?(article|nav|footer)>", lambda m: "</div>" if "/" in m[0] else "<div>", h) for k, h in html.items()}
    right = sum(main_text(h, weights) == article_of(html[k]) for k, h in plain.items())
    assert right >= 0.95 * len(plain)


def both(page):
    """With the priors alone, and with weights that saw a few pages."""
    learned = Weights(fit([("in:article tag:p words:20", 90, 0), ("in:nav in:ul tag:li+a words:2", 0, 90), ("tag:div name:ad words:10", 0, 30)]), {"li": -1.0, "a": -1.0, "p": -0.01})
    texts = {main_text(page, w) for w in (Weights(), learned)}
    assert len(texts) == 1, texts
    return texts.pop()


def test_parts_that_are_no_main_text():
    page = f"""<html><head><title>T</title><style>p{{}}</style></head><body class="has-sidebar">
      <div id="header"><a href=/>Home</a> <a href=/x>About us</a></div>
      <ul class="menu"><li><a href=1>One</a><li><a href=2>Two</a></ul>
      <div class="cookie-notice">We use cookies to make this site better. Accept all cookies please.</div>
      <div id=content><h1>Head &lt;line&gt;</h1><p>{LONG}</p><div class="ad-slot">Buy our shiny things now.</div>
      <p>{LONG}<p>In <b>bold</b>ly&nbsp;so,<br>done. <script>var a = "</p>" + "<b>";</script><!-- > no -->
      <ul><li>first item<li>second</ul><p>Short end.</p></div>
      <aside><p>{LONG}</p></aside><section id="comments"><p>{LONG}</p></section>
      <form><label>Name</label><input value="a > b"></form><footer>&copy; Company</footer></body></html>"""
    assert both(page) == f"Head <line>\n\n{LONG}\n\n{LONG}\n\nIn boldly so, done.\n\nfirst item\n\nsecond\n\nShort end."


def test_articles_comments_and_nesting():
    page = f"""<header><h1>Site</h1><nav>a b c</nav></header><form><main><h1>Title</h1><p>{LONG}
      <aside>Related stuff.</aside><p>Fine &amp; good.<section class=comments><p>{LONG}</section></main></form><footer>f"""
    assert both(page) == f"Title\n\n{LONG}\n\nFine & good."
    nested = f"<article><p>{LONG}</p><article><p>{LONG} A comment.</p></article></article>"
    assert both(nested) == LONG


def test_odd_markup():
    def plain(page):
        return main_text(page, Weights())

    assert main_text(None, Weights()) == main_text("", Weights()) == main_text("<p> </p>", Weights()) == ""
    assert plain("Just text, without any tag.") == "Just text, without any tag."
    assert plain("a < b and <3, <> &nosuchname; &amp") == "a < b and <3, <> &nosuchname; &"
    assert plain(f'<p class="x>{LONG}</p><p>y') in (f"{LONG}\n\ny", "")  # an attribute without its quote
    assert plain("<p>one</p><p>cut off <a href='") == "one\n\ncut off"
    assert plain("<P>UP</P><SCRIPT>no</SCRIPT><p>end &#128512;") == "UP\n\nend \U0001f600"
    assert plain("<script>never closed <p>x") == ""


def test_time_grows_with_length():
    for part in ("<a ", '<a "', "<", "<div>", "</p>", "<!--", "&", "<p>x", "<article>", "<b><i>", "<script>"):
        read_blocks(part * 30_000)
    text = main_text(f"<p>{LONG}</p>" * 20_000, Weights())
    assert text.count("\n\n") == 19_999


def test_best_stretch_against_all_stretches():
    random.seed(2)
    pages = ["".join(random.choice(["<p>", "<div>", "<li><a>", "</a>", "<nav>", "</nav>", "w ", "some words here. "]) for _ in range(40)) for _ in range(60)]
    weights = Weights({"any": -1.0, "tag:p": 2.0, "in:nav": -3.0}, {"p": -0.5, "div": -1.5, "a": -0.7})
    for page in pages:
        blocks = read_blocks(page)[0]

        def total(i, j, blocks=blocks):
            own = sum(weights.word(b.features) * b.words + sum(map(weights.tag, b.within)) for b in blocks[i:j])
            return own + sum(weights.tag(t) for b in blocks[i + 1 : j] for t in b.before)

        first, end = best_stretch(blocks, weights)
        best = max((total(i, j) for i in range(len(blocks)) for j in range(i + 1, len(blocks) + 1)), default=0.0)
        assert abs((total(first, end) if end > first else 0.0) - max(best, 0.0)) < 1e-9


def test_rows(spark):
    schema = "page_id bigint, url string, html string, text string, page string, at bigint, n_chars string"
    rows = [(1, "u", f"<article><p>{LONG}</p></article>", "t", "p", 3, "n")] * 2 + [(None, None, None, None, None, None, None)]
    pages = spark.createDataFrame(rows, schema)
    got = sorted(map(tuple, extract(pages, learn(pages)).collect()), key=str)
    assert got == [(1, "u", LONG, len(LONG)), (1, "u", LONG, len(LONG)), (None, None, "", 0)]
    empty = pages.limit(0)
    assert extract(empty, learn(empty)).collect() == []
    assert prior("name:cookie") < 0 < prior("name:content")
