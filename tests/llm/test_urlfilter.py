from __future__ import annotations

import random

from strata.llm.urlfilter import RULE_SCHEMA, RuleTrie, judge_urls

URLS = [
    "http://a.net/x", "https://example.net/en/", "https://example.net/en", "https://www.EXAMPLE.net/en/q?x#y", "http://x.net",
    "http://net/", "http://notnet/", "ftp://example.com/de/1", "http://example.com/DE/1", "http://example.com?/de/",
    "http://example.com#/de/", "http://w.org/fr/a/b", "http://org/fr/", "http://a://b.net/", "no scheme", "", None, "http:///path", "http://..net/a",
]


def _slow(rules, url):
    """Longest host, then longest path, then block, by trying every rule."""
    if url is None or "://" not in url:
        host = path = ""
    else:
        rest = url.split("://", 1)[1]
        cut = min([rest.find(c) for c in "/?#" if c in rest], default=len(rest))
        host = rest[:cut].translate({i: i + 32 for i in range(65, 91)})
        path = rest[cut:].split("?")[0].split("#")[0]
    fits = [r for r in rules if (host == r[1] or host.endswith("." + r[1])) and path.startswith(r[2])]
    best = max(fits, key=lambda r: (len(r[1]), len(r[2]), r[0] == "block"), default=None)
    return host, path, best and best[1] + best[2], best[0] if best else "allow"


def _check(spark, rules, urls, **kw):
    df = spark.createDataFrame([(i, u, "mine") for i, u in enumerate(urls)], "page_id long, url string, other string")
    got = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in judge_urls(df, spark.createDataFrame(rules, RULE_SCHEMA), **kw).collect()}
    assert got == {i: _slow(rules, u) for i, u in enumerate(urls)}


def test_contract_rules_on_odd_urls(spark):
    rules = [("block", "net", "/"), ("allow", "example.net", "/en/"), ("block", "example.com", "/de/"), ("allow", "org", "/fr/")]
    _check(spark, rules, URLS + URLS[:3])
    _check(spark, rules, URLS, max_trie_bytes=0)


def test_random_rules_by_trie_and_by_join(spark):
    rnd = random.Random(2)
    host = lambda: ".".join(rnd.choice(["a", "b", "net", "org"]) for _ in range(rnd.randint(1, 3)))
    path = lambda: "".join(rnd.choice(["/", "/x", "/xy", "x", "/y/"]) for _ in range(rnd.randint(0, 3)))
    rules = [(rnd.choice(["allow", "block"]), host(), path()) for _ in range(60)]
    urls = [f"http://{host()}{path()}" for _ in range(300)]
    _check(spark, rules, urls)
    _check(spark, rules, urls, max_trie_bytes=0)


def test_no_rules_and_no_urls(spark):
    none = spark.createDataFrame([], RULE_SCHEMA)
    urls = spark.createDataFrame([(1, "http://a.b/c")], "page_id long, url string")
    assert [r.verdict for r in judge_urls(urls, none, default="block").collect()] == ["block"]
    assert judge_urls(urls.limit(0), none).count() == 0


def test_extra_columns_named_like_results_are_replaced(spark):
    urls = spark.createDataFrame([("http://a.b/c", "x", "y")], "url string, host string, rule string")
    row = judge_urls(urls, spark.createDataFrame([("block", "b", "/")], RULE_SCHEMA)).first()
    assert (row.host, row.rule, row.verdict) == ("a.b", "b/", "block")


def test_trie_of_equal_rules_blocks():
    assert RuleTrie([("allow", "a", "/"), ("block", "a", "/")]).match("x.a", "/y") == ("a/", "block")
