"""URL verdicts against a comparison of every URL with every rule."""

import random
import re

import pytest
from pyspark.sql import functions as F

from spindle.llm import url_filter


def lower(x):
    return re.sub("[A-Z]", lambda m: m[0].lower(), x)


def brute(url, rules, default="allow"):
    if url is None or "://" not in url:
        return "", "", None, default
    rest = url.split("://", 1)[1]
    host = re.match(r"[^/?#]*", rest).group()
    path = re.match(r"[^?#]*", rest[len(host) :]).group()
    host = lower(host)
    fits = [(len(h + p), len(h), h + p, v) for (h, p), v in rules.items() if host and (host == h or host.endswith("." + h)) and path.startswith(p)]
    return host, path, *(max(fits)[2:] if fits else (None, default))


@pytest.fixture(scope="module")
def made():
    r = random.Random(3)
    host = lambda: ".".join(r.choice(["a", "b", "A", "net", "", "é"]) for _ in range(r.randint(1, 5)))
    path = lambda: "".join(r.choice(["/", "a", "b", ""]) for _ in range(r.randint(0, 5)))

    def url():
        kind, p = r.random(), path()
        if kind < 0.06:
            return None if kind < 0.03 else host() + p
        return r.choice(["http", "", "x://y", "a\nb"]) + "://" + host() + ("/" + p if p and p[0] != "/" else p) + r.choice(["", "?q=://z/", "#f"])

    urls = [url() for _ in range(1500)]
    urls += ["http://b.a/b"] * 700 + ["", "://", "http://" + "a." * 300 + "net/" + "a" * 5000]
    rules = [(host(), r.choice([None, path()]), r.choice(["allow", "block"])) for _ in range(120)] + [(None, "/", "block"), ("", "/", "block"), ("a", "", None)]
    best = {}
    for h, p, v in rules:
        if h and v:
            best[lower(h), p or ""] = max(best.get((lower(h), p or ""), ""), v)
    return urls, rules, best


@pytest.mark.parametrize("keys_a_part", [1 << 20, 40])
def test_verdicts(spark, made, keys_a_part):
    """Also with so many partitions that rules opened in one cover the next ones."""
    urls, rules, best = made
    df = spark.createDataFrame([(i, x, "h", "p", "r", 1) for i, x in enumerate(urls)], "page_id long, url string, host string, path string, rule string, near int")
    got = url_filter.filter_urls(df, spark.createDataFrame(rules, "host string, path string, verdict string"), keys_a_part=keys_a_part)
    assert got.columns == ["page_id", "host", "path", "rule", "verdict"]
    got = {x.page_id: tuple(x)[1:] for x in got.collect()}
    assert got == {i: brute(x, best) for i, x in enumerate(urls)}


def test_odd_tables(spark):
    schema, rule = "page_id long, url string", "host string, path string, verdict string"
    rules = spark.createDataFrame([("net", "/", "block")], rule)
    assert url_filter.filter_urls(spark.createDataFrame([], schema), rules).collect() == []
    rows = [(None, "http://x.net/"), (None, "http://x.net/"), (1, "http://NET"), (1, None)]
    df = spark.createDataFrame(rows, schema)
    got = sorted(url_filter.filter_urls(df, rules).select("page_id", "verdict").collect(), key=str)
    assert [tuple(x) for x in got] == [(1, "allow"), (1, "allow"), (None, "block"), (None, "block")]
    none = url_filter.filter_urls(df, spark.createDataFrame([], rule), default="block")
    assert {(x.rule, x.verdict) for x in none.collect()} == {(None, "block")} and none.count() == 4


def test_a_hot_url_is_one_key(spark):
    """What is sorted doesn't grow with the rows of one URL, and the rows themselves aren't shuffled."""
    rules = spark.createDataFrame([("net", "/", "block")], "host string, path string, verdict string")
    df = spark.range(20_000).select(F.col("id").alias("page_id"), F.when(F.col("id") >= 0, "http://x.net/a").alias("url"))
    out = url_filter.filter_urls(df, rules)
    assert out.filter("verdict = 'block'").count() == 20_000
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "Exchange hash" not in plan


def test_registered_query(spark):
    import __spark_entry__
    from spindle.llm.entries import URL_RULES

    small = "/root/testdata/sf0.001"
    urls = {r.page_id: r.url for r in spark.read.parquet(f"{small}/pages.parquet").collect()}
    got = {x.page_id: tuple(x)[1:] for x in __spark_entry__.queries()["op12_url_filter"](spark, small).collect()}
    assert got == {i: brute(u, {(h, p): v for h, p, v in URL_RULES}) for i, u in urls.items()} and {v[3] for v in got.values()} == {"allow", "block"}
