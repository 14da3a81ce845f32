import random
import re
import time

import pytest

from outcomelab.llm import html_extract as h

from .conftest import prose


def page(k, body=None):
    rng = random.Random(k)
    paragraphs = [prose(rng.random(), rng.randrange(1, 60)) for _ in range(rng.randrange(1, 6))]
    body = body or "".join(f"<p>{p}</p>" for p in paragraphs)
    links = "".join(f"<li><a href='/x'>{prose(rng.random(), 3)}</a></li>" for _ in range(6))
    head = f"<head><title>Title {k}</title><style>p{{a:b}}</style><script>var t='</p>word word';</script></head>"
    return (f"<!DOCTYPE html><html>{head}<body><header>Site name</header><nav><ul>{links}</ul></nav><!-- ad <p>no</p> -->"
            f"<div class='ad'>{prose(rng.random(), 20)}</div><article><h1>Head {k}</h1>{body}</article>"
            f"<aside><p>{prose(rng.random(), 30)}</p></aside><footer>&copy; {prose(rng.random(), 40)}</footer></body></html>"
            ), "\n".join([f"Head {k}", *paragraphs])


@pytest.fixture(scope="module")
def weights(spark):
    rows = [(k, page(k)[0]) for k in range(60)]
    return h.learn(spark.createDataFrame(rows, "page_id long, html string"))


def test_whole_articles(weights):
    for k in range(100, 160):
        html, expected = page(k)
        assert h.extract(html, weights) == expected


@pytest.mark.parametrize(("body", "expected"), [
    ("<p>a &amp; b&nbsp;c &lt;d&gt;</p>", "a & b c <d>"),
    ("<p>one\n  two<br>three</p><p></p><p> </p><p>x</p>", "one two three\nx"),
    ("<p>in<b>li</b>ne <i>tag</i>s", "inline tags"),
    ("<p><b>open bold<br><p>next <!-- c --> one</p>", "open bold\nnext one"),
    ("<p title='a > b'>quoted</p>", "quoted"),
    ("<ul><li>first</li><li>second</li></ul>", "first\nsecond"),
    ("<p>text</p><div class='ad'>buy now</div><p>more text here</p>", "text\nmore text here"),
    ("<p>text of it</p><div id='comments'><p>first!</p></div><form>name <input> <button>send</button></form>", "text of it"),
    ("<div class='content'><p>shade and adder</p></div>", "shade and adder"),
    ("<p>before</p><script>if (a < b) { document.write('<p>x</p>') }</script><p>after</p>", "before\nafter"),
])
def test_bodies(weights, body, expected):
    assert h.extract(page(7, body)[0], weights) == f"Head 7\n{expected}"


def test_linear_scan_is_the_best_run():
    rng = random.Random(1)
    for _ in range(300):
        s = [rng.randrange(-4, 5) for _ in range(rng.randrange(0, 12))]
        a, b = h.best_region(s)
        best = max((sum(s[i:j]) for i in range(len(s)) for j in range(i + 1, len(s) + 1)), default=0)
        assert sum(s[a:b]) == max(best, 0)


def test_tables(spark, weights):
    long = page(3, "<p>" + "long word " * 60_000 + "</p>")[0]
    rows = [(1, "u", None), (2, None, ""), (None, "u", page(5)[0]), (4, "u", "just words"), (5, "u", "<p>"),
            (6, "u", "<nav>menu only</nav>"), (7, "u", long), (7, "u", long), (8, "u", "<p>cut off <a href='")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").selectExpr("*", "1 AS text", "2 AS tag")
    got = [(r["page_id"], r["n_chars"], r["text"]) for r in h.main_text(pages, weights=weights).collect()]
    assert all(n == len(t) for _, n, t in got) and len(got) == len(rows)
    by = {i: t for i, _, t in got}
    assert by[1] == by[2] == by[5] == by[6] == "" and by[4] == "just words" and by[None] == page(5)[1]
    assert len(by[7].split()) == 120_002
    assert h.main_text(pages).count() == len(rows)          # no more than one labelled page
    assert h.main_text(pages.limit(0)).count() == 0


#: The markup of a page as one pattern; it searches to the end at every open quote.
PATTERN = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?\]\]>|<[!?][^>]*>"
    r"|<(" + "|".join(h.RAW) + r")\b(?:\"[^\"]*\"|'[^']*'|[^>\"'])*>.*?(?:</\1\s*>|\Z)"
    r"|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)((?:\"[^\"]*\"|'[^']*'|[^>\"'])*)>",
    re.DOTALL | re.IGNORECASE)


def test_markup_is_that_of_the_pattern():
    rng = random.Random(2)
    bits = ["<", ">", "a", "/", "'", '"', " ", "<p", "</p>", "<b x='", "<script", "</script >", "<svg>", "</svg>", "<!--", "-->",
            "<![CDATA[", "]]>", "<!", "<?", "=", "<SCRIPT>", "</Script>", "<a href=\"", "word", "\n", "<scripty>", "<math-x>"]
    for k in range(6000):
        html = "".join(rng.choice(bits) for _ in range(rng.randrange(1, 30)))
        expected = [(m.start(), m.end(), (m[3] or "").lower(), bool(m[2]), m[4] or "") for m in PATTERN.finditer(html)]
        got = [(a, b, name, closing and bool(name), x) for a, b, name, closing, x in h.markup(html)]
        assert got == expected, html


@pytest.mark.parametrize("unit", [
    "<a '", '<a "', "<a '\"", "<a", "<!", "<![CDATA[", "<script '", "<b>", "</b>", "<div>", "<i><hr>", "<script", "</script "])
def test_long_broken_pages_take_linear_time(weights, unit):
    before = time.process_time()
    h.extract(unit * (1_000_000 // len(unit)), weights)
    h.extract("<p><div>" + "<b>" * 100_000 + unit * 50_000 + "</x>" * 50_000, weights)
    assert time.process_time() - before < 15


def test_every_key_of_the_sample_is_weighed(spark):
    rows = [(k, "<article>" + "".join(f"<p class='k{k}x{j}'>in</p>" for j in range(700)) + "</article>") for k in range(40)]
    weights = h.learn(spark.createDataFrame(rows, "page_id long, html string"))
    assert sum(key.endswith(f"p.k{k}x{j}") for k in (0, 39) for j in (0, 699) for key in weights.tags) == 4
    assert len(weights.tags) > 28_000
