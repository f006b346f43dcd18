"""URL rules against a loop over all rules."""

import itertools

from textmill.llm import url_rules as u

URLS = [
    None, "", "no scheme", "http://", "https://Example.ORG/es/x", "http://www.example.org/en/12?q#f", "ftp://a.example.org",
    "http://notexample.org/es/", "http://com/fr/", "http://x.com/de/1", "http://x.com/dex", "http://x.net/fr/", "http://org/",
    "http://a..com/fr/", "http://.com/de/", "http://x.com:80/de/", "x://y.com/fr/#a", "http://b.org?x/", "a://b.org/\n/z",
    "http://example.org/es/://c.com/de/", "http://com/de/" + "p" * 50_000,
]
RULES = [
    *u.RULES, ("block", "a.b.com", "/"), ("allow", "b.com", "/x/"), ("block", "b.com", "/x/y/"), ("allow", "b.com", ""),
    ("block", "b.com", "/x/"), ("block", "xb.com", ""), ("allow", "c.b.com", "/x/y/z"),
]
HOSTS = ["b.com", "a.b.com", "c.b.com", "xb.com", "y.xb.com", "z.a.b.com"]
PATHS = ["", "/", "/x", "/x/", "/x/y/", "/x/y/z/1", "/w", "/x/a", "?x/"]


def expected(url, rules):
    url = url or ""
    rest = url.split("://", 1)[1] if "://" in url else ""
    cut = next((i for i, c in enumerate(rest) if c in "/?#"), len(rest))
    host = "".join(c.lower() if c.isascii() else c for c in rest[:cut])
    path = rest[cut:]
    path = path[: next((i for i, c in enumerate(path) if c in "?#"), len(path))]
    fits = [
        (len(h + p), len(h), h + p, v)
        for v, h, p in rules
        if (host == h or host.endswith("." + h)) and path.startswith(p)
    ]
    best = max(fits, default=(0, 0, None, "allow"))
    return host, path, best[2], best[3]


def test_verdicts(spark, clashing):
    urls = URLS + [f"http://{h}{p}" for h, p in itertools.product(HOSTS, PATHS)]
    rows = [(i, url) for i, url in enumerate(urls)] + [(None, URLS[4]), (4, URLS[4])]
    pages = clashing(spark.createDataFrame(rows, "page_id long, url string").repartition(4))
    for rules in (u.RULES, RULES, ()):
        got = u.judge_urls(pages, u.rules_frame(spark, rules)).collect()
        assert len(got) == len(rows)
        for r in got:
            assert (r.host, r.path, r.rule, r.verdict) == expected(urls[r.id] if r.id is not None else URLS[4], rules)


def test_empty_table(spark):
    pages = spark.createDataFrame([], "page_id long, url string")
    assert u.judge_urls(pages, u.rules_frame(spark)).isEmpty()


def test_a_host_of_very_many_labels(spark):
    url = "http://" + "a." * 20_000 + "example.org/es/x"
    got = u.judge_urls(spark.createDataFrame([(1, url)], "page_id long, url string"), u.rules_frame(spark)).collect()
    assert [(r.rule, r.verdict) for r in got] == [("example.org/es/", "block")]
