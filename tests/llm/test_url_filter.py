import random

import pytest
from helpers import collected

from ledgermart.llm import queries, url_filter


def plain(url, rules, default="allow"):
    if url is None or "://" not in url:
        return "", "", None, default
    rest = url.split("://", 1)[1]
    cut = min([rest.index(c) for c in "/?#" if c in rest], default=len(rest))
    host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in rest[:cut])
    rest = rest[cut:]
    path = rest[: min([rest.index(c) for c in "?#" if c in rest], default=len(rest))]
    fits = [(len(h + p), len(h), h + p, v) for h, p, v in rules if (host == h or host.endswith("." + h)) and path.startswith(p)]
    best = max(fits, default=None)
    return host, path, best and best[2], best[3] if best else default


def judged(spark, urls, rules, **settings):
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    found = url_filter.judge(pages, spark.createDataFrame(rules, "host string, path string, verdict string"), **settings)
    return sorted(collected(found, "page_id", "host", "path", "rule", "verdict"))


ODD = [
    None, "", "no scheme", "http://", "://", "http:///path", "HTTP://WWW.Example.COM/en/x?q=/en/", "http://example.com", "http://example.com?x",
    "http://example.com/en", "http://example.com/en/", "http://a.b.example.com/en/1#f", "http://notexample.com/en/", "http://com/", "http://.com/",
    "http://user@example.com:80/en/", "http://x.net/es/1", "http://x.net/fr/", "http://x.net/de/", "a://b://example.com/en/", "http://exa\nmple.com/\n",
    "http://www.example.com/en/" + "y" * 50_000, "http://www..com/", "http://ÉX.com/É", "http://example.com/EN/",
]


@pytest.mark.parametrize("keys_per_task", [1, 50_000])
def test_contract_rules(spark, keys_per_task):
    rules = queries.URL_RULES
    assert judged(spark, ODD, rules, keys_per_task=keys_per_task) == [(i, *plain(u, rules)) for i, u in enumerate(ODD)]


@pytest.mark.parametrize("keys_per_task", [3, 50_000])
def test_random_nested_rules(spark, keys_per_task):
    rng = random.Random(8)
    host = lambda: ".".join(rng.choice("abc") for _ in range(rng.randrange(1, 4)))
    path = lambda: "/" + "/".join(rng.choice(["x", "xy", "z"]) for _ in range(rng.randrange(3)))
    rules = sorted({(h, p): (h, p, rng.choice(["allow", "block"])) for h, p in ((host(), path()) for _ in range(40))}.values())
    urls = [f"https://{host()}{path()}" for _ in range(400)]
    assert judged(spark, urls, rules, default="block", keys_per_task=keys_per_task) == [(i, *plain(u, rules, "block")) for i, u in enumerate(urls)]


def test_no_rules_no_pages_and_filter(spark):
    assert judged(spark, ["http://a.com/"], []) == [(0, "a.com", "/", None, "allow")]
    assert judged(spark, [], queries.URL_RULES) == []
    pages = spark.createDataFrame([(1, "http://x.net/es/", "own"), (2, None, "own"), (3, "http://a.com/", "own")], "page_id long, url string, host string")
    kept = url_filter.keep_allowed(pages, spark.createDataFrame(queries.URL_RULES, "host string, path string, verdict string"))
    assert sorted(collected(kept, "page_id", "host")) == [(2, "own"), (3, "own")]
