"""Wrappers: aligned expressions, regions of several kinds of templates, and whole texts."""

import random
import re
from html import escape, unescape

import pytest
from helpers import same_rows, with_clashes

from tabfold.llm import wrappers
from tabfold.llm.wrappers import choose, expression, extract, infer_wrappers, main_text, merge, page_wrapper, rules_of

PAGE = "page_id long, url string, html string"


def wrapper_of(*pages):
    found = page_wrapper(pages[0])
    for page in pages[1:]:
        found = merge(found, page_wrapper(page))
    return found


def text_of(*pages):
    rule = wrappers._as_sets(choose(wrapper_of(*pages)))
    return [extract(p, rule) for p in pages]


def test_expressions():
    assert expression(wrapper_of("<p>a")) == "<p>#</p>"
    assert expression(wrapper_of("<p>a", "<p>a")) == "<p>'#'</p>"
    assert expression(wrapper_of("<h1>a</h1><p>b</p>", "<h1>c</h1>")) == "<h1>#</h1><p>#</p>?"
    assert expression(wrapper_of("<ul><li>a<li>b</ul>", "<ul><li>c</ul>")) == "<ul>(<li>#</li>)+</ul>"
    # Pairs that come again are one group; so are labels that swap places between pages.
    assert expression(wrapper_of("<dl><dt>a<dd>b<dt>c<dd>d</dl>")) == "<dl>(<dd>#</dd><dt>#</dt>)+</dl>"
    assert expression(wrapper_of("<h2>a</h2><p>b</p>", "<p>c</p><h2>d</h2>")) == "(<h2>#</h2><p>#</p>)+"
    # Both optional, in the order in which they are first met.
    assert expression(wrapper_of("<h1>t</h1><p>b</p>", "<h1>t</h1><h2>d</h2>")).count("?") == 2


def test_merging_does_not_depend_on_the_order_of_like_pages():
    draw = random.Random(3)
    pages = [f"<h1>{i}</h1>" + "".join(draw.choice(["<p>x{}</p>", "<ul><li>{}</ul>", ""]).format(i) for _ in range(4)) for i in range(40)]
    one = wrapper_of(*pages)
    draw.shuffle(pages)
    assert expression(wrapper_of(*pages)) == expression(one)
    halves = merge(wrapper_of(*pages[:17]), wrapper_of(*pages[17:]))
    assert expression(halves) == expression(one)


def test_size_follows_the_labels_and_not_the_pages():
    pages = ["<body>" + "".join(f"<div class='c{chr(97 + i % 26)}{chr(97 + j)} x{'abcdef'[j % 6]}'><p>t{i}</p></div>" for j in range(20)) for i in range(300)]
    assert len(wrappers._dump(wrapper_of(*pages))) < 20000
    assert text_of(*pages)[7] == " ".join(["t7"] * 20)
    many = "<body>" + "<p>some words</p>" * 5000
    assert len(wrappers._dump(page_wrapper(many))) < 300


ARTICLE = "<h1>The  title &amp; more</h1><p>First <b>bo</b>ld &lt;i&gt;\n line<br>two<p>Second</p><ul><li>item</ul>"
WANTED = "The title & more First bold <i> line two Second item"


@pytest.mark.parametrize(
    "template",
    [
        "<nav><a href=/>Home</a></nav><article>{}</article><footer>Copy</footer>",
        "<header><h1>Site</h1></header><main>{}</main><aside>Side</aside><form>Mail <input><button>Go</button></form>",
        "<div id=nav>Home About</div><div class='article-body post'>{}</div><div class='cookie-notice'>Cookies</div>",
        "<div role=navigation>Home</div><div role=main>{}<section id=comments><article class=comment>Nice!</article></section></div>",
        "<body class='has-sidebar'><div class='wrap with-sidebar'><article>{}<aside class=related><a>More</a></aside></article>"
        "<div class=sidebar><p>Some long, long, long, long side text of many words that is no article at all</p></div></div>",
        "<script>if (a < b) '<p>no</p>'</script><style>p{{}}</style><noscript>no</noscript><article>{}<!-- <p>no</p> --></article>",
        "<article><header>{}</header><div class=ad>Buy</div><footer>by me</footer></article>",
        "<article>{}<span class='share-buttons'>Share this</span></article><ol class=commentlist><li><p>First comment</ol>",
    ],
)
def test_templates(template):
    pages = [template.format(ARTICLE), template.format(ARTICLE.replace("Second", "Other")), template.format("<p>Third</p>")]
    assert text_of(*pages) == [WANTED, WANTED.replace("Second", "Other"), "Third"]


def test_no_element_says_that_it_is_the_article():
    template = "<div class=top><a href=/>Home</a> <a href=/x>About us</a></div><div class=wide><div class=story>{}</div><div class=more><a href=1>Other page {}</a></div></div><div class=end>All rights reserved</div>"
    pages = [template.format(f"<h2>Title {i}</h2><p>A text of some length about number {i}, which differs.</p>", i) for i in range(5)]
    assert text_of(*pages)[2] == "Title 2 A text of some length about number 2, which differs."


@pytest.mark.parametrize(
    "page, wanted",
    [
        ("", ""), ("plain & text", "plain & text"), ("<p>a<p", "a"), ("<p>a <!-- b", "a"), ("a < b > c", "a < b > c"), ("<article>x</p></div>y", "xy"),
        ("<article><p>&am</p><p>&amp&quot;&#233;&nbsp;z</p>", "&am &\"é z"), ("<p title='a>b'>c</p>", "c"), ("<p title=\"a>b</p>c", "b c"),
        ("<article>" + "<div>" * 500 + "deep" + "</div>" * 500 + "</article>", "deep"), ("<TABLE><TR><TD>a<TD>b</TABLE>", "a b"),
    ],
)
def test_broken_pages(page, wanted):
    assert text_of(page) == [wanted]


def page(i, host, draw):
    words = " ".join(draw.choices(["alpha", "beta", "R&D", "<tag>", "é"], k=draw.randint(1, 60)))
    paragraphs = "".join(f"<p>{escape(words)} {i}" + draw.choice(["", "</p>"]) for _ in range(draw.randint(1, 5)))
    nav = "".join(f"<li><a href=/{j}>menu {j}</a>" for j in range(draw.randint(1, 4)))
    extra = draw.choice(["", "<div class=ad>Buy now</div>", "<aside><p>Other</aside>"])
    return (i, f"http://{host}/p{i}", f"<html><body><nav><ul>{nav}</ul></nav>{extra}<article><h1>T{i}</h1>{paragraphs}</article><footer>&copy; me</footer>")


def brute(html):
    body = re.search("<article>(.*)</article>", html, re.S)[1]
    return " ".join(unescape(re.sub("<[^>]*>", " ", body)).split())


def test_hot_and_rare_hosts(spark, monkeypatch):
    draw = random.Random(5)
    rows = [page(i, "hot.com" if i % 3 else f"h{i}.org", draw) for i in range(600)]
    # Some hosts' rules are sent, the others joined.
    monkeypatch.setattr(wrappers, "FREQUENT", 100)
    df = with_clashes(spark.createDataFrame(rows, PAGE)).repartition(9)
    found = main_text(df, keep=["page_id", "url"])
    assert same_rows(found.collect(), [(i, u, brute(h)) for i, u, h in rows])
    hosts = rules_of(infer_wrappers(df)).collect()
    assert len(hosts) == 201 and {r.n_pages for r in hosts} == {1, 400}


def test_odd_rows(spark):
    long = "<article>" + "<p>some words &amp; more</p>" * 50000 + "</article>"
    rows = [(1, None, None), (1, None, ""), (2, "no scheme", "<article>a"), (2, "no scheme", "<article>a"), (None, "http://x.com/", long),
            (3, "http://x.com/2", "<nav>only</nav>"), (4, "http://x.com/3", "<p>another template</p>")]
    df = spark.createDataFrame(rows, PAGE)
    wanted = [(1, ""), (1, ""), (2, "a"), (2, "a"), (None, " ".join(["some words & more"] * 50000)), (3, ""), (4, "another template")]
    assert same_rows(main_text(df, keep=["page_id"]).collect(), wanted)


def test_empty(spark):
    assert main_text(spark.createDataFrame([], PAGE), keep=["page_id"]).collect() == []
