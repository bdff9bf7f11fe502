"""URL rules against a plain longest-match."""

import random

from playmart.llm import urls
from playmart.operators import Scratch
from pyspark.sql import functions as F


def parts(url):
    if not url or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    host = rest
    for c in "/?#":
        host = host.split(c, 1)[0]
    path = rest[len(host) :].split("?", 1)[0].split("#", 1)[0]
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in host), path


def plain(url, rules):
    host, path = parts(url)
    fits = [
        (len(h + p), len(h), h + p, v)
        for h, p, v in rules
        if h is not None and p is not None and (host == h or host.endswith("." + h)) and path.startswith(p)
    ]
    best = max(fits, default=None)
    return (host, path, None, "allow") if best is None else (host, path, best[2], best[3])


def judged(spark, given, rules):
    pages = spark.createDataFrame([(i, u, "old") for i, u in enumerate(given)], "page_id int, url string, verdict string")
    got = urls.apply_rules(pages, urls.rule_rows(spark, rules), Scratch(spark, "t")).collect()
    return {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in got}


def test_nested_rules_on_random_urls(spark):
    draw = random.Random(8)
    labels = ["a", "b", "com", "example", "é", "a-b", "net"]
    paths = ["", "/", "/a", "/a/", "/a/b", "/b/"]
    host = lambda: ".".join(draw.choice(labels) for _ in range(draw.randrange(1, 4)))
    rules = list({(host(), draw.choice(paths)): draw.choice(["allow", "block"]) for _ in range(150)}.items())
    rules = [(h, p, v) for (h, p), v in rules] + [(None, "/", "block"), ("com", None, "block")]
    given = [f"http://{host()}{draw.choice(paths)}{draw.choice(['', '?q', '#f', 'x/y'])}" for _ in range(1500)]
    given += [None, "", "no scheme", "http://", "http://COM/", "HTTP://Example.Com:80/a/?://x", "a://b://c/d", "x://com?/a", "http://com\n/a"]
    got = judged(spark, given, rules)
    for i, url in enumerate(given):
        assert got[i] == plain(url, rules), url


def test_one_hot_host_spans_ranges(spark):
    pages = spark.range(5000).select(F.col("id").alias("page_id"), F.lit("http://x.example.com/en/1").alias("url"))
    scratch = Scratch(spark, "t")
    got = urls.apply_rules(pages, urls.rule_rows(spark), scratch)
    assert {(r.rule, r.verdict) for r in got.select("rule", "verdict").distinct().collect()} == {("example.com/en/", "block")}
    stored = spark.read.parquet(scratch.path("ranges"))
    assert got.count() == 5000 and stored.select("url_range").distinct().count() >= 4


def test_a_rule_given_twice_and_no_rows(spark):
    assert judged(spark, ["http://a.com/x"], [("com", "/", "block"), ("com", "/", "allow")])[0][2:] == ("com/", "block")
    assert judged(spark, ["http://a.com/x"], [("org", "/", "block")])[0][2:] == (None, "allow")
    empty = spark.createDataFrame([], "page_id int, url string")
    assert urls.apply_rules(empty, urls.rule_rows(spark), Scratch(spark, "t")).count() == 0
