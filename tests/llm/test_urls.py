"""URL filters against a plain search through all rules."""

import random
import re

import pytest
from pyspark.sql import functions as F

from tradeflow.llm import urls

PAGES = "page_id long, url string, html string, host int, `a.b` string, found string"


@pytest.fixture
def many_ranges(spark):
    name = "spark.sql.adaptive.coalescePartitions.enabled"
    before = spark.conf.get(name)
    spark.conf.set(name, "false")
    yield
    spark.conf.set(name, before)


def parts(url):
    if url is None or "://" not in url:
        return "", ""
    host, path = re.match(r"([^/?#]*)([^?#]*)", url.split("://", 1)[1]).groups()
    return re.sub("[A-Z]", lambda m: m[0].lower(), host), path


def brute(url, rules, default="allow"):
    host, path = parts(url)
    fits = [
        (len(h + p), len(h), h + p, v)
        for h, p, v in rules
        if h and p is not None and (host == h or host.endswith("." + h)) and path.startswith(p)
    ]
    return (host, path, *(max(fits)[2:] if fits else (None, default)))


def judged(spark, pages, rules, **more):
    table = spark.createDataFrame(rules, "host string, path string, verdict string")
    df = spark.createDataFrame([(i, u, None, 1, "x", "y") for i, u in pages], PAGES)
    found = urls.judged(df.repartition(3), table, **more)
    assert found.columns == ["page_id", "host", "path", "rule", "verdict"]
    return sorted(map(tuple, found.collect()), key=repr)


def test_rules_of_the_contract(spark):
    rules = [("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow")]
    pages = [
        (1, "http://a.example.net/en/1"), (2, "HTTPS://A.EXAMPLE.NET/EN/1?x#y"), (3, "https://example.net"),
        (4, "https://example.com/de/2.html#t"), (5, "https://notexample.com/de/"), (6, "https://x.org/fr/"),
        (7, None), (8, ""), (9, "no scheme/net/"), (10, "http://net/"), (11, "http://a..net/de//"), (12, "http://net./"),
        (13, "http://.net/"), (14, "http://a.net:80/"), (15, "x://y://a.net/"), (16, "http://É.net/é"), (None, "http://a.net/"),
        (16, "http://É.net/é"), (17, "http://a.b?.net/"), (18, "http://" + "a." * 3000 + "net/" + "b" * 200_000),
        (19, "http://net/\x00\U0010ffff"), (20, "a\n://x.net/\nb"),
    ]
    found = judged(spark, pages, rules)
    assert found == sorted([(i, *brute(u, rules)) for i, u in pages], key=repr)
    digest = urls.url_filters(spark, spark.createDataFrame([(i, u, None, 1, "x", "y") for i, u in pages], PAGES))
    assert sorted(map(tuple, digest.collect()), key=repr) == found


@pytest.mark.parametrize("seed", range(2))
def test_nested_rules_and_a_hot_host(spark, many_ranges, seed):
    rng = random.Random(seed)
    label = lambda: rng.choice(["a", "b", "ab", "c", "", "a-b", "é"])
    host = lambda: ".".join(label() for _ in range(rng.randint(1, 4)))
    path = lambda: "".join(rng.choice(["/", "a", "b", "/a/", "\x00", "é", "\U0010ffff"]) for _ in range(rng.randint(0, 5)))
    rules = [(host(), path(), rng.choice(["allow", "block"])) for _ in range(120)]
    rules += [("a.b", "/" * k, "block") for k in range(8)] + [("", "/", "block"), ("a", None, "block"), (None, "/", "block")]
    pages = [(i, f"h://{'a.b' if i % 3 == 0 else host()}/{path()}") for i in range(700)]
    strongest = {}
    for h, p, v in rules:
        strongest[h, p] = max(v, strongest.get((h, p), v))
    kept = [(h, p, v) for (h, p), v in strongest.items()]
    assert judged(spark, pages, rules, default="block") == sorted(
        [(i, *brute(u, kept, "block")) for i, u in pages], key=repr
    )


def test_no_rules_and_no_pages(spark):
    assert judged(spark, [(1, "http://a.net/")], []) == [(1, "a.net", "/", None, "allow")]
    assert judged(spark, [], [("net", "/", "block")]) == []


def test_only_built_in_functions(spark):
    pages = spark.createDataFrame([(1, "http://a.net/", None, 1, "x", "y")], PAGES)
    plan = urls.url_filters(spark, pages.filter(F.col("page_id") > 0))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Cartesian" not in plan and "NestedLoop" not in plan
