import html
import json
import re

import pytest
from strata.llm import wrappers as w
from strata.llm.queries import op4_wrapper_extraction

PAGE = """<!DOCTYPE html><html><head><title>t</title><style>p{{}}</style><script>var a="</p><p>no";</script></head><body>
<header><h1>Site</h1></header><nav><ul><li><a href="/">Home</a></li><li>{menu}</li></ul></nav><div class="cookie-notice">We use cookies</div>
<{box}><h2>T &amp; {n}</h2><p>first  <b>bo</b>ld&nbsp;x<br>{body}<p>a &lt; b<div class="ad">buy</div><form><label>mail</label><input></form>
<section id="comments"><p>reader says</p></section></{end}><aside>side</aside><div>Always the same line</div><footer>&copy; 2024</footer></body>"""


def page(n, box="article", end=None):
    return PAGE.format(menu=f"m{n}", n=n, body=f"body {n} " * (n % 3 + 1), box=box, end=end or box)


def want(n):
    return " ".join(f"T & {n} first bold x {f'body {n} ' * (n % 3 + 1)} a < b".split())


def learned(spark, pages, **params):
    """Wrapper of one host from its pages."""
    df = spark.createDataFrame([(f"http://a.org/{k}", p) for k, p in enumerate(pages)], "url string, html string")
    row, = w.learn_wrappers(df, **params).collect()
    return w.HostWrapper(**json.loads(row.wrapper))


def read(p, wrapper):
    return w.main_text(w.parse(p)[0], wrapper)


def test_article_and_template(spark):
    assert read(page(1), w.HostWrapper()) == want(1)
    plain = [page(n, "div class='text'", "div") for n in range(1, 6)]
    wrapper = learned(spark, plain + plain[:2])
    assert wrapper.regions == ["/html/body/div.text"]
    for n, p in enumerate(plain, 1):
        assert read(p, wrapper) == want(n)


def body_of(n, words=40):
    return " ".join(f"w{n}x{k}" for k in range(words))


def test_teaser_articles(spark):
    """The body is in a div, and the article elements are cards."""
    pages = [f"<html><body><div class='text'><p>{body_of(n)}</p><p>{body_of(-n)}</p></div>"
             f"<article>Teaser {n}</article><article>Card {n}</article></body></html>" for n in range(6)]
    wrapper = learned(spark, pages)
    for n, p in enumerate(pages):
        assert read(p, wrapper) == f"{body_of(n)} {body_of(-n)}"
        assert read(p, w.HostWrapper()) == f"{body_of(n)} {body_of(-n)}"


def test_template_line_inside_the_article(spark):
    """Fixed lines go; without the wrapper, or on a host's few pages, they can't be known."""
    pages = [f"<body><article><h1>T{n}</h1><p>{body_of(n)}</p><p>Sign up to our daily letter today</p><p>{body_of(-n)}</p></article></body>"
             for n in range(10)]
    wrapper = learned(spark, pages)
    for n, p in enumerate(pages):
        assert read(p, wrapper) == f"T{n} {body_of(n)} {body_of(-n)}"
        assert "Sign up to our daily letter today" in read(p, w.HostWrapper())
    assert learned(spark, pages[:2]).template == []


def test_headings_of_slots_are_told_from_template_lines(spark):
    """Of texts on every page, the aligned wrapper keeps a heading with text of its own behind it."""
    def one(n, second):
        return (f"<body><article><h2>Introduction</h2><div><p>{body_of(n)}</p></div>" + ("<h2 class='s'>Results</h2>" + second)
                + "<h3>Read on</h3></article><section><h2>Links</h2></section>"
                f"<p>{n}</p></body>")

    texts = [f"<p>{body_of(-n)}</p>" if n % 3 else f"<ul><li>{body_of(-n)}</li><li>x {n}</li></ul>" for n in range(20)]
    wrapper = learned(spark, [one(n, t) for n, t in enumerate(texts)])
    assert len(wrapper.template) == 2  # "Read on" and "Links"
    got = [read(one(n, t), wrapper) for n, t in enumerate(texts)]
    assert got == [f"Introduction {body_of(n)} Results {body_of(-n)}" + ("" if n % 3 else f" x {n}") for n in range(20)]
    same = learned(spark, [one(n, "<p>the same everywhere</p>") for n in range(20)])
    assert len(same.template) == 4  # "Results" heads no slot there
    assert w.section_headings(["<h2>", "=1", ("slot",), "</h2>", "<p>", ("slot",), "</p>"]) == set()
    assert w.section_headings(["<div>", "<h2>", "=1", "</h2>", "</div>", ("+", ["<p>", ("slot",), "</p>"])]) == set()
    assert w.section_headings(["<h2>", "=1", "</h2>", ("?", [("+", ["<p>", ("slot",), "</p>"])])]) == {1}


def test_names_inside_the_article():
    kept = "<p>a b c d e f</p><div class='share-price'>12 EUR</div><p id='notice-2'>second notice</p>"
    gone = "<div class='ad-slot'>buy</div><div class='cookie-notice'>cookies</div><section id='comments'><p>I say</p></section>"
    assert read(f"<body><article>{kept}{gone}</article></body>", w.HostWrapper()) == "a b c d e f 12 EUR second notice"


def test_region_inside_a_named_part(spark):
    pages = [f"<body><div class='main-banner'><p>{body_of(n)}</p></div><div class='ad'>{n}</div></body>" for n in range(4)]
    wrapper = learned(spark, pages)
    assert [read(p, wrapper) for p in pages] == [body_of(n) for n in range(4)]


def test_two_layouts_and_a_short_body(spark):
    """Every layout that a tenth of the pages have is known, wherever in the table its pages are."""
    first = [f"<body><article><p>{body_of(n)}</p></article><div class='x'>{body_of(-n, 5)}</div></body>" for n in range(30)]
    second = [f"<body><div class='text'><p>{body_of(n)}</p></div><article>card {n}</article></body>" for n in range(100, 106)]
    short = "<body><article><p>brief</p></article><div class='x'>" + body_of(7, 30) + "</div></body>"
    wrapper = learned(spark, [*first, *second, short])
    assert wrapper.regions == ["/body/article", "/body/div.text"]
    assert [read(p, wrapper) for p in second] == [body_of(n) for n in range(100, 106)]
    assert read(short, wrapper) == "brief" and read(short, w.HostWrapper()) != "brief"


def test_copies_keep_their_text(spark):
    """Near copies of one page: nearly all text is on all of them, and stays."""
    pages = [f"<body><article><p>{body_of(1)}</p><p>{body_of(2)}</p><p>copy {n}</p></article></body>" for n in range(8)]
    wrapper = learned(spark, pages)
    assert len(wrapper.template) == 2
    assert [read(p, wrapper) for p in pages] == [f"{body_of(1)} {body_of(2)} copy {n}" for n in range(8)]


def test_fixed_texts_against_a_plain_count(spark):
    """A host's fixed texts are those that a count over all of its different pages gives."""
    lines = [f"line {k}" for k in range(12)]
    pages = [f"<body><article><p>{body_of(n)}</p>" + "".join(f"<p>{t}</p>" for k, t in enumerate(lines) if n % (k + 1) < k or k == 0)
             + "</article></body>" for n in range(40)]
    pages += pages[:20]
    different = set(pages)
    want = {w.block_mark(b) for p in different for b in w.parse(p)[0]
            if sum(any(x.path == b.path and x.text == b.text for x in w.parse(q)[0]) for q in different) >= 0.8 * len(different)}
    assert set(learned(spark, pages, share=0.8).template) == want and len(want) >= 3


@pytest.mark.parametrize("size", [1, 5, 40])
def test_fold(size):
    group = [f"<t{k}>" for k in range(size)] + ["<x>", ("slot",)]
    assert w.fold(["<a>", *group * 5, "</a>"]) == ["<a>", ("+", group), "</a>"]
    assert w.fold(["<a>", *group, "</a>"]) == ["<a>", *group, "</a>"]


def test_merged_streams_match_all_pages():
    """The expression of pages with other numbers of items and optional parts."""
    def one(items, extra):
        return w.skeleton(w.shape("<body><ul>" + "<li>i</li>" * items + "</ul>" + ("<div>e</div>" if extra else "") + "<h1>t</h1></body>"),
                          set(), {w._mark(t) for t in ("<body>", "<ul>", "<li>", "<div>", "<h1>")})

    wrapper = w.merged(one(n, n % 2) for n in (3, 1, 2, 5))
    assert w.expression(wrapper) == "<body><ul>(<li>#</li>)+</ul>(<div>#</div>)?<h1>#</h1></body>"


def test_inference():
    def stream(body):
        return w.parse(f"<body>{body}</body>")[1]

    got = w.expression(w.infer([stream("<ul><li>a</li><li>b</li><li>c</li></ul><h1>x</h1>"),
                                stream("<ul><li>d</li></ul><h1>y</h1><div>only here</div>")]))
    assert got == "<body><ul>(<li>#</li>)+</ul><h1>#</h1>(<div>only here</div>)?</body>"


@pytest.mark.parametrize("text", ["", "<", "<p", "<p class='x>y", "a < b > c", "<![CDATA[x]]>z", "</div></p>x", "<script>no end", "&#x41;&bad;&amp;lt;"])
def test_broken_markup(text):
    blocks, _ = w.parse(text)
    assert w.main_text(blocks, w.HostWrapper()) in {
        "", "<", "<p", "<p class='x>y", "a < b > c", "z", "x", "A&bad;&lt;", "y"}


def test_rows(spark):
    rows = [(1, "http://a.org/1", page(1)), (1, "http://a.org/1", page(1)), (2, None, page(2)), (None, "x", None), (3, "http://B.org", ""),
            (4, "http://a.org/2", "<article>" + "<p>long text</p>" * 20_000 + "</article>")]
    df = spark.createDataFrame([(*r, "t") for r in rows], "page_id long, url string, html string, text string")
    got = w.extract(df, w.learn_wrappers(df)).collect()
    assert sorted((r.page_id or 0, r.text, r.n_chars) for r in got) == sorted(
        [(1, want(1), len(want(1)))] * 2 + [(2, want(2), len(want(2))), (0, "", 0), (3, "", 0),
                                            (4, " ".join(["long text"] * 20_000), 200_000 - 1)])
    assert w.extract(df.limit(0), w.learn_wrappers(df.limit(0))).collect() == []


def test_query_keeps_the_article(spark, sf_small):
    got = {r.page_id: r for r in op4_wrapper_extraction(spark, sf_small).collect()}
    pages = spark.read.parquet(f"{sf_small}/pages.parquet").collect()
    assert len(got) == len(pages)
    for r in pages:
        article = re.search(r"<article>(.*)</article>", r.html, re.S)[1]
        text = html.unescape(re.sub(r"</?(?:b|i|em|strong|a|span)\b[^>]*>", "", article))
        assert got[r.page_id].text == " ".join(re.sub(r"<[^>]+>", " ", text).split())
