import random

from headway.llm import url_filter
from headway.llm.queries import RULES

PAGES = "page_id long, url string, host string, verdict string"


def brute(url, rules, default="allow"):
    host = path = ""
    if url is not None and "://" in url:
        rest = url.split("://", 1)[1]
        end = min([rest.index(c) for c in "/?#" if c in rest], default=len(rest))
        host, tail = rest[:end], rest[end:]
        host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in host)
        path = tail[: min([tail.index(c) for c in "?#" if c in tail], default=len(tail))]
    fits = [(len(h + p), len(h), h + p, a) for h, p, a in rules if (host == h or host.endswith("." + h)) and path.startswith(p)]
    best = max(fits, default=(0, 0, None, default))
    return host, path, best[2], best[3]


def check(spark, urls, rules):
    pages = spark.createDataFrame([(i, u, "h", "v") for i, u in enumerate(urls)], PAGES)
    found = url_filter.filter_urls(pages, spark.createDataFrame(rules, "host string, path string, action string"))
    assert {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in found.collect()} == {i: brute(u, rules) for i, u in enumerate(urls)}


URLS = [
    None, "", "no scheme", "://", "http://", "http://net", "http://net/", "HTTP://A.Example.NET/en/x?y#z", "x://example.net/en", "x://example.net/EN/", "https://notexample.com/de/", "https://example.com/de/a", "https://www.example.com/de/",
    "https://a..net/", "https://.net/", "https://ÄB.net/", "ftp://org/fr/", "ftp://w.org/fr/q", "ftp://w.org/fr", "x://example.com:80/de/", "x://u@example.com/de/", "x://example.com?/de/", "x://example.com#/de/", "a://b://example.net/en/", "x://net/\n/en/",
]


def test_rules_of_the_query(spark):
    check(spark, URLS + ["http://same.net/x"] * 50, RULES)


def test_many_rules(spark):
    rng = random.Random(3)
    name = lambda: ".".join(rng.choice(["a", "b", "net", "com", "x1"]) for _ in range(rng.randrange(1, 5)))
    path = lambda: "/" + "/".join(rng.choice(["p", "q", "en"]) for _ in range(rng.randrange(0, 4)))
    rules = list({(h, p): (h, p, rng.choice(["allow", "block"])) for h, p in ((name(), path()) for _ in range(300))}.values())
    rules += [("only.host", "", "block")]
    # rules of one canonical length and host length can only be one and the same here
    check(spark, [f"http://{name()}{path()}{rng.choice(['', '?q', '/more'])}" for _ in range(400)] + ["http://a.only.host"], rules)


def test_empty_tables_and_repeated_rules(spark):
    pages = spark.createDataFrame([(1, "http://a.net/"), (1, "http://a.net/")], "page_id long, url string")
    none = spark.createDataFrame([], "host string, path string, action string")
    assert [tuple(r) for r in url_filter.filter_urls(pages, none).collect()] == [(1, "a.net", "/", None, "allow")] * 2
    twice = spark.createDataFrame([("net", "/", "allow"), ("net", "/", "block"), (None, None, "allow")], "host string, path string, action string")
    assert {r.verdict for r in url_filter.filter_urls(pages, twice).collect()} == {"block"}
    assert url_filter.filter_urls(pages.limit(0), twice).count() == 0


def test_filter_has_no_false_negatives_and_few_false_hits(spark):
    keys = spark.range(5000).selectExpr("concat('host', id, '/') as key")
    words = url_filter.bloom_filter(keys).first().words
    assert len(words) == 5000 * 16 // 256 * 4 + 4
    probe = spark.range(20000).selectExpr("concat('host', id, '/') as key").crossJoin(spark.createDataFrame([(words,)], "words array<bigint>"))
    counts = {r.listed: r.n for r in probe.withColumn("hit", url_filter.might_contain(probe["key"], probe["words"])).filter("hit").selectExpr("cast(regexp_extract(key, '[0-9]+', 0) as int) < 5000 as listed").groupBy("listed").count().withColumnRenamed("count", "n").collect()}
    assert counts[True] == 5000 and counts.get(False, 0) < 300
