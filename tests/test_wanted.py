"""Reading wanted pages only, and the newest fetch of each."""

import pytest
from pyspark.sql import functions as F

from vacancyflow import DEFAULT_PROFILE as PROFILE
from vacancyflow import WHOLE_PROFILE
from vacancyflow.plans.extract import extract_jobs
from vacancyflow.sources import wanted
from vacancyflow.sources.fetched import answered, page_nodes
from vacancyflow.sources.wanted import WantedPages

VENDOR = PROFILE.vendor_suffix
SITE = f"https://a.{VENDOR}"
TABLE = "url string, status int, body string, fetched_at int"


def page(title):
    return f"<html><body><h1>{title}</h1><article>text of {title}</article></body></html>"


def fetches(spark, n=2000):
    rows = [(f"{SITE}/careers/JobDetail/{i}", 200, page(f"Job {i}"), 1) for i in range(n)]
    return spark.createDataFrame(rows, TABLE)


def urls(spark, *numbers):
    return spark.createDataFrame([(f"{SITE}/careers/JobDetail/{i}",) for i in numbers], "url string")


def plan(rows):
    return rows._jdf.queryExecution().executedPlan().toString()


def test_the_filter_stands_between_scan_and_reader(spark, tmp_path):
    fetches(spark).write.parquet(str(tmp_path / "fetched"))
    pages = WantedPages(spark.read.parquet(str(tmp_path / "fetched")), WHOLE_PROFILE)
    lines = plan(pages.nodes(urls(spark, 3, 5))).splitlines()
    at = {name: [i for i, line in enumerate(lines) if name in line] for name in ("ArrowEvalPython", "BroadcastHashJoin", "body#")}
    reader = at["ArrowEvalPython"][0]
    scan = max(i for i in at["body#"] if "FileScan" in lines[i])
    assert sum(reader < i < scan for i in at["BroadcastHashJoin"]) == len(wanted._PROBES)
    # Between the scan and the reader nothing is shuffled: the only exchanges there are of the filter's words.
    assert not any("hashpartitioning(url" in line for line in lines[reader:scan])


def test_only_wanted_pages_are_taken_apart(spark):
    pages = WantedPages(fetches(spark), WHOLE_PROFILE)
    some = urls(spark, *range(0, 2000, 40), 99999)
    assert pages.nodes(some).count() == 50
    assert 50 <= pages.candidates(pages.places(some)).count() <= 52
    assert pages.nodes(urls(spark)).count() == 0
    assert pages.nodes(some.union(some)).count() == 50


def test_a_full_filter_lets_more_through_and_the_result_stays(spark, monkeypatch):
    monkeypatch.setattr(wanted, "FILTER_BITS", 64)
    pages = WantedPages(fetches(spark, 300), WHOLE_PROFILE)
    some = urls(spark, *range(100))
    assert pages.candidates(pages.places(some)).count() > 200
    assert pages.nodes(some).count() == 100


def test_filter_has_a_bounded_number_of_words(spark, monkeypatch):
    monkeypatch.setattr(wanted, "FILTER_BITS", 1 << 12)
    keys = spark.range(20000).select(F.col("id").cast("string").alias("url"))
    words = wanted.filter_words(keys, ["url"])
    assert words.count() == (1 << 12) // 64
    assert wanted.maybe_among(keys, ["url"], words).count() == 20000


@pytest.mark.parametrize("body_first", [True, False])
def test_the_newest_fetch_counts_whatever_its_status(spark, body_first):
    rows = [
        (f"{SITE}/careers/JobDetail/1", 200, page("old"), 1),
        (f"{SITE}/careers/JobDetail/1", 200, page("new"), 7),
        (f"{SITE}/careers/JobDetail/1", 500, "busy", 3),
        (f"{SITE}/careers/JobDetail/2", 200, page("gone"), 1),
        (f"{SITE}/careers/JobDetail/2", 404, "", 2),
        (f"{SITE}/careers/JobDetail/3", 200, page("never again"), None),
        (None, 200, page("nameless"), 1),
    ]
    fetched = spark.createDataFrame(rows if body_first else rows[::-1], TABLE)
    found = {r.url[-1]: r.nodes.titles[0] for r in WantedPages(fetched, WHOLE_PROFILE).nodes(urls(spark, 1, 2, 3)).collect()}
    # Without any time a fetch can't be placed, so it does not count.
    assert found == {"1": "new"}
    assert [r.url[-1] for r in answered(fetched).collect()] == ["1"]
    assert [r.nodes.titles[0] for r in page_nodes(fetched, WHOLE_PROFILE).collect()] == ["new"]
    undated = fetched.drop("fetched_at").where("status = 200 and url like '%3'")
    assert WantedPages(undated, WHOLE_PROFILE).nodes(urls(spark, 3)).count() == 1


def test_jobs_of_a_site_that_was_read_twice(spark):
    def item(name):
        return f"<item><title>{name}</title><link>{SITE}/careers/{name}</link></item>"

    rows = [
        (SITE, 200, page("Home"), 1),
        (f"{SITE}/rss", 200, f"<rss><channel>{item('old')}</channel></rss>", 1),
        (f"{SITE}/rss", 200, f"<rss><channel>{item('new')}</channel></rss>", 2),
        (f"{SITE}/careers/SearchJobs", 200, "<a href='/careers/JobDetail/1'>One</a>", 1),
        (f"{SITE}/careers/SearchJobs", 200, "<a href='/careers/JobDetail/2'>Two</a>", 2),
        (f"{SITE}/careers/JobDetail/1", 200, page("One"), 1),
        (f"{SITE}/careers/JobDetail/2", 200, page("Two"), 1),
        (f"{SITE}/careers/JobDetail/2", 200, page("Two, again"), 2),
    ]
    given = spark.createDataFrame([(0, SITE), (1, f"{SITE}/careers/SearchJobs")], "link_seq int, url string")
    jobs = extract_jobs(given, WantedPages(spark.createDataFrame(rows, TABLE), WHOLE_PROFILE))
    assert {r.job_title for r in jobs.collect()} == {"new", "Two, again"}
