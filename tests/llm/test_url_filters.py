import random

import pytest

from runledger.llm import url_filters
from runledger.llm.url_filters import judge_urls, rule_table

LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def split(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    host_end = min([rest.index(c) for c in "/?#" if c in rest], default=len(rest))
    path = rest[host_end:]
    path_end = min([path.index(c) for c in "?#" if c in path], default=len(path))
    return rest[:host_end].translate(LOWER), path[:path_end]


def judged(url, rules):
    host, path = split(url)
    fits = [(len(h) + len(p), len(h), v, h + p) for h, p, v in rules
            if (host == h or host.endswith("." + h)) and path.startswith(p)]
    best = max(fits, default=None)
    return host, path, best and best[3], best[2] if best else "allow"


RULES = [("net", "/", "block"), ("example.net", "/en/", "allow"),
         ("example.com", "/de/", "block"), ("org", "/fr/", "allow")]
URLS = [
    None, "", "no scheme/path", "http://", "https://EXAMPLE.net/en/x", "https://example.net/en",
    "https://a.b.example.net/en/1?q=/x#y", "http://net/", "http://net", "http://xnet/",
    "ftp://x.net/a//b", "http://example.com/de/ü", "http://example.com?/de/", "http://a.org/fr/",
    "http://a.org:80/fr/", "http://é.net/\n", "x://y://z.net/", "http://./", "http://.net/",
    "http://www.example.com/de", "HTTP://A.Example.Com/de/1",
]


def check(spark, urls, rules):
    pages = spark.createDataFrame([(i, u, "mine") for i, u in enumerate(urls)],
                                  "page_id bigint, url string, rule string")
    found = judge_urls(pages, rule_table(spark, rules)).orderBy("page_id").collect()
    assert [(r.host, r.path, r.rule, r.verdict) for r in found] == [judged(u, rules) for u in urls]


def test_rules_of_the_query(spark):
    check(spark, URLS + URLS, RULES)


@pytest.mark.parametrize("broadcast", [True, False])
def test_random_rules(spark, monkeypatch, broadcast):
    if not broadcast:
        monkeypatch.setattr(url_filters, "fits_broadcast", lambda df: False)
    rng = random.Random(2)

    def host():
        return ".".join(rng.choice(["a", "b", "ab"]) for _ in range(rng.randint(1, 4)))

    def path():
        return "".join(rng.choice(["/", "x", "xy", "/x/"]) for _ in range(rng.randint(0, 4)))

    rules = {(host(), "/" * rng.randint(0, 1) + path()): rng.choice(["allow", "block"]) for _ in range(60)}
    urls = [f"http://{host()}/{path()}" for _ in range(300)] + ["http://a.b/" + "x/" * 300] * 3
    check(spark, urls, [(h, p, v) for (h, p), v in rules.items()])


def test_no_rules_no_pages(spark):
    pages = spark.createDataFrame([(1, "http://a.net/")], "page_id bigint, url string")
    empty = rule_table(spark, RULES).limit(0)
    assert [r.verdict for r in judge_urls(pages, empty).collect()] == ["allow"]
    assert judge_urls(pages.limit(0), rule_table(spark, RULES)).count() == 0


def test_equal_rules_and_rules_without_a_host(spark):
    rules = rule_table(spark, [("net", "/", "allow"), ("NET", "/", "block"), ("", "/", "block")])
    pages = spark.createDataFrame([("http://a.net/",), ("http:///x",)], "url string")
    found = {r.url: (r.rule, r.verdict) for r in judge_urls(pages, rules).collect()}
    assert found == {"http://a.net/": ("net/", "block"), "http:///x": (None, "allow")}
