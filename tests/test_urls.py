"""URL Columns against the standard library."""

from urllib.parse import urljoin, urlparse

import pytest
from pyspark.sql import functions as F

from vacancyflow.functions import urls

BASES = [
    "https://h.example/a/b/c?q=1",
    "https://h.example",
    "https://h.example/",
    "http://H.example:81/a//b/",
    "https://h.example/a;p/b;z",
    "https://u@h.example/careers/SearchJobs?x=1#f",
]
HREFS = [
    *["x", "./x", "../x", "../../../x", "/x/../y", "/..//x", "x/../../y/", "?z=1", "#t", "//o.example/p", "//o.example"],
    *["https://o.example/a/../b", "HTTPS://o.example/Q?", "http:rel", "mailto:a@b", "/a;b", "x//y", "/x?", "a:b", "1a:b"],
    *[".", "..", "x/.", " /sp ", "/a\tb", "https:foo", "//o.example?x", "///p", "javascript:void(0)", "x?a#b", "/é", " "],
]


@pytest.fixture(scope="module")
def pairs(spark):
    return spark.createDataFrame([(b, h) for b in BASES for h in HREFS], "base string, href string")


def test_resolve_equals_urljoin(pairs):
    split = urls.split_url(urls.split_url(pairs, "base", "b_"), "href", "h_")
    base, href = urls.UrlParts.columns("b_"), urls.UrlParts.columns("h_")
    rows = split.select("base", "href", urls.resolve(F.col("base"), base, F.col("href"), href).alias("url"))
    wrong = [(r.base, r.href, r.url) for r in rows.collect() if r.url != urljoin(r.base, r.href)]
    assert not wrong


def test_parts_equal_urlparse(pairs):
    every = pairs.select(F.explode(F.array("base", "href")).alias("url")).distinct()
    parts = urls.UrlParts.columns("u_")
    rows = urls.split_url(every, "url", "u_").select(
        "url", "u_scheme", "u_netloc", urls.own_path(parts).alias("path"), "u_query", "u_fragment"
    )
    for row in rows.collect():
        expected = urlparse(row.url)
        found = (row.u_scheme, row.u_netloc, row.path, row.u_query, row.u_fragment)
        assert found == (expected.scheme, expected.netloc, expected.path, expected.query, expected.fragment), row.url


def test_unreadable_hosts(spark):
    cases = {"http://[bad/x": True, "//x]y/": True, "/a[b]": False, "http://[::1]/": False, "x?[": False}
    rows = spark.createDataFrame([(url,) for url in cases], "url string")
    found = {r.url: r.bad for r in rows.select("url", urls.is_unreadable(F.col("url")).alias("bad")).collect()}
    assert found == cases


def test_feed_rank_needs_the_exact_address(spark):
    cases = {
        "https://h.example/rss": 1,
        "https://h.example/jobs/feed": 3,
        "https://h.example/x/rss": 0,
        "https://h.example/rss?x=1": 0,
        "https://h.example/rss#t": 0,
        "https://h.example": 0,
    }
    rows = urls.split_url(spark.createDataFrame([(url,) for url in cases], "url string"), "url", "u_")
    rank = urls.feed_rank(F.col("url"), urls.UrlParts.columns("u_"), ["/rss", "/feed", "/jobs/feed"])
    assert {r.url: r.rank for r in rows.select("url", rank.alias("rank")).collect()} == cases


def test_normalise(spark):
    cases = {"h.example//": "https://h.example", "http://h.example/": "http://h.example", "https://a": "https://a"}
    rows = spark.createDataFrame([(url,) for url in cases], "url string")
    assert {r[0]: r[1] for r in rows.select("url", urls.normalise(F.col("url"))).collect()} == cases
