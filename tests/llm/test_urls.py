import re

import pytest

from recmill.llm import urls

URLS = [
    "http://a.NET/x", "https://net/", "http://net", "http://xnet/", "http://example.net/en/1", "http://www.example.net/en", "ftp://example.net/EN/",
    "http://example.com/de/?a=/en/", "http://b.example.com/de/", "http://example.com/fr/de/", "http://x.org/fr/", "http://org/fr/a#b", "http://x.org?/fr/",
    "net/", "", None, "http://", "http:///net/", "a://b://net/", "http://u@example.net:80/en/", "http://example.net./en/", "http://ÉX.net/",
    "http://a.net/x\ny", "//example.net/en/", "http://deep.sub.example.com/de/x/y/z", "http://q.e+d/a.b*c/", "http://QxE+d/a.b*c/", r"http://a.quote.org/\E/xyz", "http://quote.org/E/x", "http://any.where/ads/1", "http://any.where/ads",
]
RULES = [
    ("block", "net", "/"), ("allow", "example.net", "/en/"), ("block", "example.com", "/de/"), ("allow", "org", "/fr/"),
    ("block", "q.e+d", "/a.b*c/"), ("block", "", "/ads/"), ("allow", "sub.example.com", ""), ("block", None, "/"), ("block", "net", None),
    (None, "net", "/en/"), ("block", "tie.net", "/"), ("allow", "tie.net", "/"), ("block", "net", "/"), ("block", "Quote.Org", r"/\E/x"),
]


def brute(url):
    _, found, rest = (url or "").partition("://")
    host = re.split("[/?#]", rest)[0] if found else ""
    path = re.split("[?#]", rest[len(host) :])[0] if found else ""
    host = "".join(c.lower() if "A" <= c <= "Z" else c for c in host)
    rules = [(action, h and h.lower(), p) for action, h, p in RULES]
    fits = [
        (-len(h + p), h + p, action)
        for action, h, p in rules
        if None not in (action, h, p) and (not h or host == h or host.endswith("." + h)) and path.startswith(p)
    ]
    _, rule, verdict = min(fits, default=(0, None, "allow"))
    return host, path, rule, verdict


@pytest.fixture(scope="module")
def tables(spark):
    rows = [(i, u, "x") for i, u in enumerate(URLS + ["http://tie.net/", URLS[0]])] + [(None, URLS[4], None), (3, URLS[4], None)]
    pages = spark.createDataFrame(rows, "page_id long, url string, rule string")
    rules = spark.createDataFrame([(*r, 1) for r in RULES], "action string, host string, path string, size int")
    return rows, pages, rules


@pytest.mark.parametrize("most", [200_000, 0])
def test_matches_brute_force(tables, monkeypatch, most):
    monkeypatch.setattr(urls, "BROADCAST_ROWS", most)
    monkeypatch.setattr(urls, "BROADCAST_VERDICTS", most)
    rows, pages, rules = tables
    got = sorted(str((r.page_id, r.host, r.path, r.rule, r.verdict)) for r in urls.judge(pages, rules).collect())
    assert got == sorted(str((i, *brute(u))) for i, u, _ in rows)


def test_empty_tables(tables):
    rows, pages, rules = tables
    assert urls.judge(pages.limit(0), rules).count() == 0
    assert {(r.rule, r.verdict) for r in urls.judge(pages, rules.limit(0), default="block").collect()} == {(None, "block")}


def test_only_indexed_rules_meet_a_url(tables):
    """The rarest token of example.net/en/ is en, not net or example."""
    _, pages, rules = tables
    frame = urls.judge(pages, rules)
    assert not re.search("Python|Pandas|Arrow|CartesianProduct|NestedLoop", frame._jdf.queryExecution().toString())
