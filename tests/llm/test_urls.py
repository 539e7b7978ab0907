from ledgerloom.llm import url_filters
from ledgerloom.llm.queries import URL_RULES


def plain(url, rules, default="allow"):
    rest = url.partition("://")[2] if url and "://" in url else ""
    cut = min([rest.find(c) for c in "/?#" if c in rest] or [len(rest)])
    host, tail = rest[:cut], rest[cut:]
    host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in host)
    path = tail[: min([tail.find(c) for c in "?#" if c in tail] or [len(tail)])]
    fits = [
        (len(h + p), v, h + p)
        for v, h, p in rules
        if (host == h or host.endswith("." + h)) and path.startswith(p)
    ]
    best = max(fits, default=(0, default, None))
    return host, path, best[2], best[1]


def test_rules(spark):
    urls = [
        None,
        "",
        "no scheme/de/x",
        "http://",
        "https://A.Example.ORG/en/1?x=/es/",
        "https://example.org/en/123/",
        "https://xexample.org/es/",
        "https://m.example.org/es/4#/en/1",
        "http://a.com/de/4",
        "http://com/fr/",
        "http://a.com?/de/",
        "http://a.com#://b.org/",
        "ftp://a..com/de//x",
        "http://É.com/fr/é",
        "http://www.net/" + "x/" * 5000,
        "http://" + "a." * 3000 + "org/x",
    ]
    rules = [*URL_RULES, ("block", "net", "/x/x/"), ("allow", "net", "/x/x/")]
    rows = [(k, url, "h") for k, url in enumerate(urls * 2)] + [(None, urls[4], None)]
    pages = spark.createDataFrame(rows, "page_id long, url string, rule string")
    got = sorted(map(tuple, url_filters.judge(pages, url_filters.rule_table(spark, rules)).collect()), key=str)
    assert got == sorted(((k, *plain(url, rules)) for k, url, _ in rows), key=str)


def test_no_rules_and_no_pages(spark):
    pages = spark.createDataFrame([(1, "http://a.org/")], "page_id long, url string")
    rows = url_filters.judge(pages, url_filters.rule_table(spark, [])).collect()
    assert [tuple(row) for row in rows] == [(1, "a.org", "/", None, "allow")]
    assert url_filters.judge(pages.limit(0), url_filters.rule_table(spark, URL_RULES)).count() == 0
