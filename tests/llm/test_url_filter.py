import pytest
from helpers import same_rows, with_clashes

from tabfold.llm.queries import URL_RULES
from tabfold.llm.url_filter import judge_urls

RULES = "host string, path string, verdict string"
URLS = [
    "http://www.example.com/en/1", "https://Blog.Example.com/en/x?q=1", "http://example.com/EN/", "http://com/", "http://x.net/es/1",
    "http://net/fr/", "http://xnet/fr/", "http://notexample.com/en/1", "http://example.com", "http://a.com?x", "ftp://u@h.com:80/en/",
    "no scheme.com/en/", "", None, "http://", "x://y://z.com/a", "http://a\x01.com/", "http://com\x01b/", "http://.com/", "http://a..com//",
]


def brute(urls, rules, default="allow"):
    out = []
    for i, url in urls:
        host = path = ""
        if url is not None and "://" in url:
            rest = url.split("://", 1)[1]
            cut = min([rest.find(c) for c in "/?#" if c in rest] or [len(rest)])
            host, path = rest[:cut], rest[cut:]
            path = path[: min([path.find(c) for c in "?#" if c in path] or [len(path)])]
            host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in host)
        fits = [r for r in rules if None not in r and path.startswith(r[1]) and (host == r[0] or host.endswith("." + r[0]))]
        best = max(fits, key=lambda r: (len(r[0] + r[1]), len(r[0]), r[2]), default=None)
        out.append((i, host, path, best and best[0] + best[1], best[2] if best else default))
    return out


@pytest.mark.parametrize("parts", [1, 7])
def test_against_all_rules(spark, parts):
    urls = list(enumerate(URLS)) + [(0, URLS[0]), (None, URLS[1])]
    rules = URL_RULES + [("example.com", "/", "block"), ("example.com", "/en/x", "allow"), ("a.com", "", "block"), ("com", "/", "block"),
                         (None, "/", "block"), ("net", None, "block"), ("net", "/", None), ("b.c.d", "/", "block")]
    pages = spark.createDataFrame(urls, "page_id long, url string")
    found = judge_urls(with_clashes(pages), spark.createDataFrame(rules, RULES), keep=["page_id"], parts=parts)
    assert same_rows(found.collect(), brute(urls, rules))


def test_hot_url_and_many_nested_rules(spark):
    urls = [(i, "http://a.b.c.com/x/y") for i in range(500)] + [(1000 + i, f"http://s{i % 40}.b.c.com/x/{i}") for i in range(500)]
    rules = [(f"s{i}.b.c.com", f"/x/{j}", "block") for i in range(40) for j in range(9)] + [("c.com", "/x/y", "allow"), ("b.c.com", "/", "block")]
    pages = spark.createDataFrame(urls, "page_id long, url string")
    found = judge_urls(pages, spark.createDataFrame(rules, RULES), keep=["page_id"], parts=16)
    assert same_rows(found.collect(), brute(urls, rules))


def test_empty(spark):
    pages, rules = spark.createDataFrame([], "page_id long, url string"), spark.createDataFrame([], RULES)
    assert judge_urls(pages, rules, keep=["page_id"]).collect() == []
    one = spark.createDataFrame([(1, "http://a.com/")], "page_id long, url string")
    assert [tuple(r) for r in judge_urls(one, rules, keep=["page_id"], default="block").collect()] == [(1, "a.com", "/", None, "block")]
