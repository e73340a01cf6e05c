"""The page reader on tag soup; expected nodes are set by hand."""

import json
import time
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from vacancyflow import DEFAULT_PROFILE as PROFILE
from vacancyflow.operators import listing, pages
from vacancyflow.sources.html import _read_page, _Selectors

SELECTORS = _Selectors(PROFILE)


def read(body, want_links=True):
    return _read_page(body, want_links, SELECTORS, PROFILE)


@pytest.mark.parametrize(
    ("body", "expected"),
    [
        ("<article>a<p>b<p>c</article>d", ["a\nb\nc"]),
        ("<article>a</b>b</article>", ["a\nb"]),
        ("<article>a &amp; b&nbsp;&copy &unknown; &#233;&#150;</article>", ["a & b\xa0© &unknown é–"]),
        ("<article> a <!-- no --> b <script>no</script><style>no</style><template><i>no</i></template></article>", ["a\nb"]),
        ("<article>a<br>b<br/>c<img src=x>d</article>", ["a\nb\nc\nd"]),
        ("<article>line\n\n\n\nline</article>", ["line\n\nline"]),
        ("<article><div>open to the end", ["open to the end"]),
        ("<article>x<span/>y</article>", ["x\ny"]),
        ("<div class='a description b'>by class</div>", ["by class"]),
        ("<div class='Description'>case counts</div>", []),
        ("<p><i>a</p>b</i><article>c</article>", ["c"]),
        ("<div data-job-description>by attribute</div>", ["by attribute"]),
        ("<DIV DATA-Job-Description>by attribute</DIV>", ["by attribute"]),
        ("<div class='job&#45;details'>hidden name</div>", ["hidden name"]),
        ("<div class=content>no</div><main><div class=content>in main</div></main>", ["in main", "in main", "no"]),
        ("<article>first</article><article>second</article>", ["first"]),
    ],
)
def test_descriptions(body, expected):
    assert read(body)["descriptions"] == expected


def test_reading_stops_after_the_first_long_description():
    long = "x" * 101
    nodes = read(f"<article>{long}</article><main>more</main><div class=job-details>short</div>")
    assert nodes["descriptions"] == ["short", long]
    assert nodes["body_text"] is None


def test_body_text_only_without_any_description():
    assert read("<body>a<p>b")["body_text"] == "a\nb"
    assert read("<body><article> </article>a")["body_text"] == "a"
    assert read("<body><article>x</article>a")["body_text"] is None
    assert read("no body at all")["body_text"] is None


@pytest.mark.parametrize(
    ("body", "expected"),
    [
        ("<title> A &amp; B </title>", "A & B"),
        ("<title>a</title><title>b</title>", "a"),
        ("<title></title>", None),
        ("<svg><title>deep</title></svg>", "deep"),
        ("<p>none", None),
    ],
)
def test_title_tag(body, expected):
    assert read(body)["title_tag"] == expected


def test_title_candidates_in_rank_order():
    nodes = read("<p class='job-title'>second</p><h1> <b>first</b> </h1><h1>other</h1><div data-job-title>third</div>")
    assert nodes["titles"] == ["first", "second", "third"]


def test_apply_links():
    body = (
        "<a href='/x'>x</a><a class='btn-apply' href='/b'>b</a><button><i><a href='http://z'>z</a></i></button>"
        "<div class='apply-button'><a>no link</a></div><a href='/Apply'>A</a><a href='/apply'>a</a><p data-apply-url='/u'>u</p>"
    )
    assert read(body)["apply_hrefs"] == ["/apply", "/Apply", "http://z", "", "/b", ""]


def test_metadata_keeps_selector_and_classes():
    nodes = read("<i class='job-location big'>Here</i><i class='posted-date location-like'>Now</i>")
    assert [(m["selector"], m["classes"], m["text"]) for m in nodes["metadata"]] == [
        (".job-location", "job-location big", "Here"),
        (".posted-date", "posted-date location-like", "Now"),
    ]


def test_links_and_cards():
    body = (
        "<a>none</a><a href=''>empty</a><a href='/1'>one <b>bold</b></a>"
        "<div class='x job-row'>Row <a href='/2'>two</a><a href='/JobDetail/3'>three</a></div><div data-job-id=1>no link</div>"
    )
    nodes = read(body)
    assert [(a["href"], a["text"]) for a in nodes["anchors"]] == [
        ("", "empty"),
        ("/1", "one\nbold"),
        ("/2", "two"),
        ("/JobDetail/3", "three"),
    ]
    assert [(c["href"], c["text"]) for c in nodes["cards"]] == [("/JobDetail/3", "Row\ntwo\nthree")]
    assert read(body, want_links=False)["anchors"] == [] == read(body, want_links=False)["cards"]


def test_a_card_that_is_a_link_needs_a_link_inside():
    assert read("<a class='job' href='/JobDetail/1'>x</a>")["cards"] == []


def test_unsupported_selector_is_refused():
    from dataclasses import replace

    with pytest.raises(ValueError, match="unsupported selector"):
        _Selectors(replace(PROFILE, title_selectors=("h1 > b",)))


@pytest.fixture(scope="module")
def as_nodes(spark):
    from vacancyflow.sources.html import page_nodes_udf

    def make(bodies):
        rows = spark.createDataFrame(list(bodies.items()), "url string, body string")
        return rows.select("url", page_nodes_udf(PROFILE)(F.col("body"), F.lit(True)).alias("nodes"))

    return make


def test_a_large_batch_is_read_in_slices(spark):
    """What is held beside the batch does not grow with it; a page above the limit is alone, and rows keep their order."""
    import tracemalloc

    import pyarrow as pa

    from vacancyflow.sources.html import _SLICE_BYTES, page_nodes_udf

    run = page_nodes_udf(PROFILE).func
    page = "<title>{0}</title><article>" + ("<p>" + "text of page {0} " * 40) * 15
    bodies = [None if n % 50 == 7 else "" if n % 50 == 8 else page.format(n) for n in range(1000)]
    bodies[333] = "<h1>333</h1>" + "x" * 2 * _SLICE_BYTES
    batch = pa.array(bodies), pa.array([n % 3 == 0 for n in range(1000)])
    tracemalloc.start()
    try:
        found = []
        for part in run(iter([batch, (pa.array([], pa.string()), pa.array([], pa.bool_()))])):
            found += [(node["title_tag"].as_py(), [t.as_py() for t in node["titles"]]) if node.is_valid else None for node in part]
            del part
        most = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    expected = [body if body is None else (None, []) if body == "" else (str(n), []) for n, body in enumerate(bodies)]
    expected[333] = (None, ["333"])
    assert found == expected
    assert most < 6 * _SLICE_BYTES and sum(len(body or "") for body in bodies) > 10 * _SLICE_BYTES


def test_slices_of_a_batch_come_back_to_their_rows(as_nodes):
    bodies = {f"https://h.example/{n}": None if n % 40 == 3 else f"<h1>{n}</h1><p>{'text ' * 9000}" for n in range(160)}
    found = as_nodes(bodies).coalesce(1).select("url", F.get("nodes.titles", 0).alias("title")).collect()
    assert {r.url: r.title for r in found} == {url: body and url.rsplit("/", 1)[1] for url, body in bodies.items()}


def test_page_jobs(as_nodes):
    long = "long " * 30
    bodies = {
        "https://H.example/1": f"<h1>T</h1><article>{long}</article><main>{long} x</main>",
        "https://H.example/2": "<h1> </h1><title>Tag</title><div class=job-details>a</div><main>b</main>",
        "https://H.example/d/3": "<body>only <a href='../apply?x=1'>body</a>",
        "https://H.example/4": "<h1>T</h1><a href='http://[apply'>bad link</a>",
        "https://H.example/5": "<p class=location>L1</p><p class='job-location'>L2</p><p class=posted-date>D1</p><p class=date-posted>D2</p><h1>M</h1>",
        "https://H.example/6": "",
        "https://H.example/7": None,
    }
    found = {r.source_url[-1]: r for r in pages.page_jobs(as_nodes(bodies), PROFILE).collect()}
    assert sorted(found) == ["1", "2", "3", "5"]
    assert (found["1"].job_title, found["1"].job_description, found["1"].source_site) == ("T", long.strip(), "H.example")
    assert found["1"].application_url == "https://H.example/1"
    assert (found["2"].job_title, found["2"].job_description) == ("Tag", "b")
    assert (found["3"].job_title, found["3"].job_description) == ("Untitled", "only\nbody")
    assert found["3"].application_url == "https://H.example/apply?x=1"
    assert (found["5"].metadata.location, found["5"].metadata.date_posted) == ("L2", "D2")
    assert found["5"].metadata.source_page == "https://H.example/5"


LISTING = "https://H.example/careers/SearchJobs"
ANCHORS = {
    # href: whether it is a job link of LISTING
    "/careers/JobDetail/T/1": True,
    "JobDetail/T/2?x=1": True,
    "//h.EXAMPLE/careers/JobDetail/T/3": True,
    "//other.example/careers/JobDetail/T/4": False,
    "/careers/login/JobDetail/5": False,
    "/careers/JobDetail/MyLogin": False,
    "/careers/SearchJobs": False,
    "/careers/SearchJobs/": False,
    "/x/SearchJobs": False,
    "/x/SearchJobs?jobId=1": True,
    "/careers/SearchJobs?page=2": False,
    "/careers/SearchJobs/deep": True,
    "/careers/7/view": True,
    "/careers/7": False,
    "/about/us/now": False,
    "mailto:a@b": False,
}


def test_listing_rules(as_nodes):
    body = "".join(f"<a href='{href}'>t</a>" for href in ANCHORS)
    found = listing.listing_links(as_nodes({LISTING: body}), PROFILE).orderBy("pos").collect()
    from urllib.parse import urljoin

    assert [r.job_url for r in found] == [urljoin(LISTING, href) for href, kept in ANCHORS.items() if kept]


@pytest.mark.parametrize(
    ("base", "href", "kept"),
    [
        ("https://h.example/", "/a/b", True),
        ("https://h.example/", "/a", False),
        ("https://h.example/team", "/team/5", True),
        ("https://h.example/team", "/team/x", False),
        ("https://h.example/team", "/teamwork/x/y", True),
        ("https://h.example/en/searchjobs", "/en/other/longer-path/5", True),
        ("https://h.example/en/searchjobs", "/en/short", False),
        ("https://h.example/en/SearchJobs", "/en/other/longer-path/5", False),
    ],
)
def test_links_below_the_listing(as_nodes, base, href, kept):
    found = listing.listing_links(as_nodes({base: f"<a href='{href}'>t</a>"}), PROFILE)
    assert (found.count() == 1) is kept


def test_listing_titles_limits_and_fallbacks(as_nodes):
    bodies = {
        "https://h.example/a/careers": "<a href='/careers/JobDetail/1'> </a><a href='/careers/JobDetail/1'>again</a>"
        f"<a href='/careers/JobDetail/2'>{'x' * 301}</a><a href='/careers/JobDetail/3'>third</a>"
        "<div class=job><a href='/b/careers/SearchJobs'>card</a></div>",
        "https://h.example/b/careers": f"<div class=jobs>{'y' * 500}<a href='/z/careers/SearchJobs'>c</a></div>",
        "https://h.example/c/careers": "<a href='/nothing'>n</a>",
        "https://h.example/d/careers": "<a href='/careers/JobDetail/1'>x</a><a href='http://[bad'>x</a>",
    }
    found = listing.listing_links(as_nodes(bodies), PROFILE, limit=2, or_page_itself=True).orderBy("url", "pos").collect()
    assert [(r.url[18], r.job_url[17:], r.card_title) for r in found] == [
        ("a", "/careers/JobDetail/1", "Job"),
        ("a", "/careers/JobDetail/2", "x" * 300 + "..."),
        ("b", "/z/careers/SearchJobs", "y" * 400 + "..."),
        ("c", "/c/careers", None),
    ]


def test_nodes_survive_json(as_nodes):
    row = as_nodes({"u": "<h1>é</h1>"}).select(F.to_json("nodes").alias("j")).first()
    assert json.loads(row.j)["titles"] == ["é"]


@pytest.mark.parametrize(
    ("body", "expected"),
    [
        ("<div class=a><p class=b><i>1</i>", ["1"]),
        ("<div class=b><p class=a><i>1</i>", []),
        ("<div class=a><p class=b></p><i>1</i>", []),
        ("<div class='a b'><i>1</i>", []),
        ("<div class='a b'><p class='a b'><i>1</i>", ["1"]),
        ("<div class=a></div><p class=b><i>1</i></p><div class=a><p class=b><i>2</i>", ["2"]),
    ],
)
def test_steps_lie_inside_one_another(body, expected):
    profile = replace(PROFILE, title_selectors=(".a .b i",))
    assert _read_page(body, True, _Selectors(profile), profile)["titles"] == expected


@pytest.mark.parametrize("piece", ["<p><a>x", "<div class=job><a href=/x>y"])
def test_unclosed_tags_take_linear_time(piece):
    """A reader that walks all open tags per tag would need many minutes."""
    began = time.process_time()
    read("<div class=apply-button></div>" + piece * (300_000 // len(piece)))
    assert time.process_time() - began < 15
