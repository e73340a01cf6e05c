"""Feeds: reading documents, choosing one per site, mining links."""

import pytest
from pyspark.sql import functions as F

from vacancyflow import DEFAULT_PROFILE as PROFILE
from vacancyflow.operators.feeds import feed_addresses, feed_jobs, mined_links
from vacancyflow.sources.feeds import feed_links, with_feed_items, with_item_fields
from vacancyflow.sources.fetched import read_pages

VENDOR = PROFILE.vendor_suffix

DOCUMENTS = {
    "plain": ("<rss><channel><item><title> T </title><link>u</link><guid isPermaLink='false'>g</guid></item></channel></rss>", [("T", "u", "", "g")]),
    "cdata": ("<rss><channel><item><title>T</title><description><![CDATA[<p>a &amp; b</p>]]></description></item></channel></rss>", [("T", "", "<p>a &amp; b</p>", "")]),
    "rdf": ("<r:RDF xmlns:r='r' xmlns='x'><channel/><item><title>A &amp; B</title></item><item><title>C</title></item></r:RDF>", [("A & B", "", "", ""), ("C", "", "", "")]),
    "spaces": ("<rss xmlns:m='m' xmlns:a='a'><channel><item><m:title>M</m:title><title>T</title><a:link href='x'/><link>u</link></item></channel></rss>", [("M", "u", "", "")]),
    "deep": ("<rss><channel><group><item a='1'><title>D</title></item></group></channel></rss>", [("D", "", "", "")]),
    "mixed depth": ("<rss><channel><item><title>A</title></item><group><item><title>B</title></item></group><item/></channel></rss>", [("A", "", "", ""), ("B", "", "", ""), ("", "", "", "")]),
    "no items inside": ("<rss><channel><note><![CDATA[<item><title>N</title></item>]]></note><!-- <item><title>C</title></item> --><item><title>A</title></item></channel></rss>", [("A", "", "", "")]),
    "empty item": ("<rss><channel><item/></channel></rss>", [("", "", "", "")]),
    "markup": ("<rss><channel><item><title> A <b x='1&gt;0' y='&quot;'>B &amp; &lt;i> </b> C</title><description>p<!-- c -->q<br/>r<![CDATA[<p>s</p>]]> <i><b> t</b></i> </description><guid><![CDATA[<a>]]></guid></item></channel></rss>", [("AB & <i>  C", "", "pqr<p>s</p>  t", "<a>")]),
    "sections": ("<rss><channel><item><title><![CDATA[a <![CDATA[ b]]]]>&gt;<![CDATA[<x> & \"y\"]]></title><!-- <![CDATA[ --><description>&#60;p>&#x3C;/p> <![CDATA[]]></description></item></channel></rss>", [('a <![CDATA[ b]]><x> & "y"', "", "<p></p>", "")]),
    "references": ("<rss><channel><item><title>&#60;p>&#x3c;/p></title><description><u>all</u> of <u>it</u></description></item></channel></rss>", [("<p></p>", "", "all of it", "")]),
    "deep markup": ("<rss><channel><group><item><title><b>D</b> <![CDATA[<item>]]></title></item></group></channel></rss>", [("D <item>", "", "", "")]),
    "cut": ("<rss><channel><item><title>T</title></item><item><title>x", []),
    "entity": ("<rss><channel><item><title>T&nbsp;</title></item></channel></rss>", []),
    "no xml": ("hello", []),
    "nothing": ("", []),
    "null": (None, []),
}


def test_documents(spark):
    rows = spark.createDataFrame([(name, body) for name, (body, _) in DOCUMENTS.items()], "name string, body string")
    items = with_feed_items(rows, F.col("body")).select("name", F.posexplode("feed_items").alias("pos", "item"))
    found = {name: [] for name in DOCUMENTS}
    for r in with_item_fields(items.select("name", "pos", "item.*")).orderBy("name", "pos").collect():
        found[r.name].append((r.title, r.link, r.description, r.guid))
    assert found == {name: expected for name, (_, expected) in DOCUMENTS.items()}


@pytest.mark.parametrize(
    ("body", "expected"),
    [
        ("<a href='x'>", []),
        ("<a class=y href='x'>", ["x"]),
        ("<LINK rel=r HREF=\"x\"/>", ["x", "x"]),
        ("<link href='x'>", ["x"]),
        ("<link>a</link><LINK>b</LINK><link> c </link>", ["a", " c "]),
        ("<link>1</link><a b='' url='2'>", ["2", "1"]),
    ],
)
def test_link_patterns(spark, body, expected):
    rows = spark.createDataFrame([(body,)], "body string")
    assert rows.select(feed_links(F.col("body"), PROFILE)).first()[0] == expected


def rss(*items):
    inner = "".join(f"<item><title>{title}</title><link>{link}</link></item>" for title, link in items)
    return f"<rss><channel>{inner}</channel></rss>"


@pytest.fixture(scope="module")
def pages(spark):
    a, b, c = (f"https://{name}.{VENDOR}" for name in "abc")
    fetched = [
        (f"{a}/rss", 200, rss(("Post", f"{a}/blogs/1"), ("Known", a), ("Other", "https://other.example/"))),
        (f"{a}/careers/rss", 200, rss(("", f"{a}/careers/1"), ("Two", f"{a}/careers/2"), ("Login", f"{a}/careers/login"))),
        (f"{a}/feed", 200, rss(("Late", f"{a}/careers/3"))),
        (f"{b}/rss", 404, rss(("Gone", f"{b}/careers/1"))),
        (f"{b}/jobs/feed", 200, rss(("Only", f"{b}/jobs/1"))),
        (f"{c}/x/rss", 200, rss(("No feed address", f"{c}/careers/1"))),
    ]
    rows = spark.createDataFrame(fetched, "url string, status int, body string")
    return read_pages(rows, PROFILE)


def test_first_productive_feed(spark, pages):
    a, b, c = (f"https://{name}.{VENDOR}" for name in "abc")
    hubs = spark.createDataFrame([(a, 4), (b, 2), (c, 1), ("https://none.example", 0)], "origin string, link_seq int")
    found = feed_jobs(hubs, pages, PROFILE).orderBy("seq").collect()
    assert [(r.seq.link, r.seq.pos, r.source_site, r.application_url, r.job_title) for r in found] == [
        (2, 0, f"b.{VENDOR}", f"{b}/jobs/1", "Only"),
        (4, 0, f"a.{VENDOR}", f"{a}/careers/1", "Untitled"),
        (4, 1, f"a.{VENDOR}", f"{a}/careers/2", "Two"),
        (4, 2, f"a.{VENDOR}", f"{a}/careers/login", "Login"),
    ]
    assert {r.source_url for r in found} == {f"{a}/careers/rss", f"{b}/jobs/feed"} == {r.metadata.source_feed for r in found}


def test_mined_links(spark, pages):
    a, b = (f"https://{name}.{VENDOR}" for name in "ab")
    sites = spark.createDataFrame([(f"{a}/careers",), (a,), (b,)], "url string")
    found = mined_links(sites, pages, PROFILE).orderBy("site", "pos").collect()
    assert [(r.url, r.site, r.pos) for r in found] == [(f"{a}/blogs/1", a, 0)]


def test_addresses(spark):
    rows = spark.createDataFrame([("https://h.example", 7)], "origin string, link_seq int")
    found = feed_addresses(rows, ("/rss", "/feed")).orderBy("feed_rank").collect()
    assert [tuple(r) for r in found] == [("https://h.example", 7, 1, "https://h.example/rss"), ("https://h.example", 7, 2, "https://h.example/feed")]
