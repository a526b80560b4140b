import html as _html
import re

import duckdb

from logweave.llm import html_extract as he
from logweave.llm.queries import op5_html

SF = "/root/testdata/sf0.01"
PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var a="<p>no</p>";</script></head><body>
<header><a href="/">Site</a></header><nav><ul><li><a href="/a">A</a><li><a href="/b">B</a></ul></nav>
<div class="cookie-notice"><p>We use cookies. Please accept them. They are good.</p></div>
<div id="content"><h1>A   title &amp; more</h1><p>First paragraph of the story, with <b>bold</b> text.<p>Second one<br>goes on&hellip; and on. It ends here.
<div class="ad">Buy now. Really. Buy it.</div><blockquote>A quote of some length, said by someone.</blockquote>
<form><p>Enter your mail address here. We will write.</p><button>Send</button></form>
<p>Third paragraph, after all that. It is &#x41; &lt;tag&gt; too.</p></div>
<aside><p>Related stories that nobody reads. There are many of them.</p></aside>
<section class="comments"><h2>Comments</h2><p>Great article. I liked it a lot. Thanks!</p><p>So did I. It was good. Very good!</p><p>Me too. Long text here.</p></section>
<footer>&copy; someone</footer></body></html>"""
WANT = ["A title & more", "First paragraph of the story, with bold text.", "Second one goes on… and on. It ends here.",
        "A quote of some length, said by someone.", "Third paragraph, after all that. It is A <tag> too."]


def articles(source):
    """Blocks of the article of a test page by plain pattern matching."""
    a = re.search(r"<article>(.*?)</article>", source, re.S)
    blocks = re.split(r"</?(?:p|h1)>", a[1]) if a else []
    text = [" ".join(_html.unescape(re.sub(r"<[^>]*>", " " if "br" in b else "", b)).split()) for b in blocks]
    return "\n\n".join(t for t in text if t)


def test_whole_table(spark):
    pages = {r[0]: r[1:] for r in duckdb.sql(f"SELECT page_id, url, html FROM read_parquet('{SF}/pages.parquet')").fetchall()}
    rows = op5_html(spark, SF).collect()
    assert len(rows) == len(pages)
    for r in rows:
        assert r.url == pages[r.page_id][0] and r.n_chars == len(r.text)
        assert r.text == articles(pages[r.page_id][1])


def test_page_without_article():
    for pot in (he.Potentials(), he.Potentials({"tag:box": [500, 100], "tag:p": [10, 3000], ">in|1": [0, 3000], ">tag|0": [4000, 300]})):
        assert he.main_text(PAGE, pot).split("\n\n") == WANT
    inner = PAGE.replace('<div id="content">', "<main><article>").replace("</p></div>\n<aside>", "</p></article></main>\n<aside>")
    assert he.main_text(inner, he.Potentials()).split("\n\n") == WANT


def test_marginals_equal_enumeration():
    import itertools
    import math
    pot = he.Potentials()
    t = he.parse("<div><p>One sentence here. And two.</p><ul><li><a>link</a></ul></div><article><p>x</p></article>")
    n, edges = len(t.tag), he._edges(t)
    own = [sum(pot.unary.get(f, 0.0) for f in fs) for fs in t.features]
    z, one = 0.0, [0.0] * n
    for s in itertools.product((0, 1), repeat=n):
        w = math.log(0.01 if s[0] else 0.99) + sum(own[i] for i in range(n) if s[i])
        w += sum(pot.edge[edges[i], s[t.parent[i]]][s[i]] for i in range(1, n))
        z += math.exp(w)
        for i in range(n):
            one[i] += s[i] * math.exp(w)
    assert all(abs(a / z - b) < 1e-9 for a, b in zip(one, he.marginals(t, pot)))


def test_edge_pages(spark):
    rows = [(1, "u", None), (1, "u", None), (2, None, ""), (3, "u", "no markup. At all."), (None, "u", "<p>unclosed <b>bold"),
            (4, "u", "<" * 50_000), (5, "u", "<article>" + "<p>a. b. c.</p>" * 20_000), (6, "u", "<div " * 5000), (7, "u", '<p title="x'),
            (8, "u", "<!-- open <p>text</p>"), (9, "u", "<div>" * 3000 + "deep. text. here.")]
    df = spark.createDataFrame([r + ("x",) for r in rows], "page_id long, url string, html string, text string")
    got = he.extract(df, he.train(df)).collect()
    assert len(got) == len(rows) and all(r.n_chars == len(r.text) for r in got)
    by = {r.page_id: r.text for r in got}
    assert by[1] == by[2] == by[8] == "" and by[5].count("a. b. c.") == 20_000
    assert he.extract(df.limit(0), he.train(df.limit(0))).count() == 0


def test_self_closed_foreign_elements_keep_the_rest_of_the_page():
    page = "<article><p>The first sentence of the article is here.</p>{}<p>The second one follows it, also whole.</p></article>"
    for inner in ("<svg/>", '<svg class="i" />', "<math/>", "<svg><path d='m'/>no text</svg>"):
        text = he.main_text(page.format(inner), he.Potentials())
        assert text == "The first sentence of the article is here.\n\nThe second one follows it, also whole.", inner


BODY = "<h1>The title</h1><p>First paragraph of the story, with some text. It goes on.</p><p>Second paragraph, said by someone. It ends.</p>"
BLOCKS = ["The title", "First paragraph of the story, with some text. It goes on.", "Second paragraph, said by someone. It ends."]


def test_wrappers_that_mention_a_word_keep_their_article(spark):
    pots = (he.Potentials(), he.train(spark.read.parquet(f"{SF}/pages.parquet")))
    wrappers = ["<article class='post comments-open'>%s</article>", "<article class='overflow-hidden'>%s</article>",
                "<div class='content with-sidebar'><article>%s</article></div>", "<div class='content with-sidebar'>%s</div>",
                "<div id='post-share-target'><article>%s</article></div>", "<div style='overflow: hidden'><article>%s</article></div>",
                "<div class='has-sidebar no-ads'><main>%s</main></div>", "<div class='overlay'><main>%s</main></div>",
                "<article class='comment'>%s</article>", "<div data-widget='sidebar hidden' class='post'>%s</div>"]
    for pot in pots:
        for w in wrappers:
            assert he.main_text(f"<html><body>{w % BODY}</body></html>", pot).split("\n\n") == BLOCKS, w


def test_named_boxes_go_whatever_their_length(spark):
    long = "".join(f"<p>Reader {i} wrote a long and whole sentence here. And then another one. It was good!</p>" for i in range(200))
    boxes = ["<section class='comments'>%s</section>", "<div class='post-comments'>%s</div>", "<div id='comments-area'>%s</div>",
             "<div class='sidebar-right'>%s</div>", "<div class='cookie-notice'>%s</div>", "<div hidden>%s</div>",
             "<div class='related'><article>%s</article></div>", "<div aria-hidden='true'>%s</div>", "<div class='comment-list'><div class='comment-body'>%s</div></div>"]
    for pot in (he.Potentials(), he.train(spark.read.parquet(f"{SF}/pages.parquet"))):
        for box in boxes:
            assert he.main_text(f"<html><body><article>{BODY}{box % long if 'article' not in box else ''}</article>{box % long}</body></html>", pot).split("\n\n") == BLOCKS, box


def test_labels_in_linear_time():
    t = he.parse("<body>" + "<article><p>text</p></article>" * 20_000)
    assert he.labels(t) is None
    t = he.parse("<main>" + "<article><p>text</p></article>" * 3 + "</main>")
    assert sum(he.labels(t)) == 10
