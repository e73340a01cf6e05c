"""Whole runs on a small site, written files included."""

import json

import pytest
from pyspark.sql import functions as F

from vacancyflow import DEFAULT_PROFILE as PROFILE
from vacancyflow import WHOLE_PROFILE
from vacancyflow.operators.links import classify
from vacancyflow.operators.listing import listing_links
from vacancyflow.plans.extract import extract_jobs, found_jobs
from vacancyflow.plans.run import run_all, run_extraction
from vacancyflow.plans.staging import stage_pages, staged
from vacancyflow.sinks.files import data_folder
from vacancyflow.sources.discovery import search_bases
from vacancyflow.sources.fetched import read_pages

VENDOR = PROFILE.vendor_suffix
SITE = f"https://a.{VENDOR}"


def page(title, text="", more=""):
    return f"<html><head><title>{title}</title></head><body><h1>{title}</h1>{more}<article>{text}</article></body></html>"


def item(name, text):
    return f"<item><title>{name}</title><link>{SITE}/careers/{name}</link><description>{text}</description></item>"


FETCHED = [
    (SITE, 200, page("Home")),
    (f"{SITE}/careers", 200, page("Careers")),
    (f"{SITE}/jobs", 404, ""),
    (f"{SITE}/rss", 200, f"<rss><channel>{item('one', 'short')}{item('two', 'a long text of the feed')}</channel></rss>"),
    (f"{SITE}/careers/SearchJobs", 200, "<a href='/careers/JobDetail/3'>Three</a><a href='/careers/JobDetail/4'>Four</a>"),
    (f"{SITE}/careers/JobDetail/3", 200, page("Three é", "third")),
    (f"{SITE}/careers/JobDetail/4", 200, "<article>fourth</article>"),
    (f"{SITE}/careers/one", 200, page("One", "the longer text of the page", "<p class=location>Here</p>")),
    (f"{SITE}/careers/two", 200, page("Two", "tiny", "<a href='/careers/apply/2'>Apply</a>")),
]
EXPECTED = {
    (1, f"{SITE}/careers/one"): ("one", "the longer text of the page", "Here"),
    (1, f"{SITE}/careers/two"): ("two", "a long text of the feed", None),
    (2, f"{SITE}/careers/JobDetail/3"): ("Three é", "third", None),
    (2, f"{SITE}/careers/JobDetail/4"): ("Four", "fourth", None),
    (3, f"{SITE}/careers/apply/2"): ("Two", "tiny", None),
}


@pytest.fixture(scope="module")
def fetched(spark):
    return spark.createDataFrame(FETCHED, "url string, status int, body string")


@pytest.fixture(scope="module")
def pages(fetched):
    return stage_pages(read_pages(fetched, PROFILE))


def links(spark, *urls):
    return spark.createDataFrame(list(enumerate(urls)), "link_seq int, url string")


def summary(jobs):
    return {
        (r.seq["pass"], r.application_url): (r.job_title, r.job_description, r.metadata.location) for r in jobs.collect()
    }


def test_three_passes(spark, pages):
    given = links(spark, SITE, f"{SITE}/careers/SearchJobs")
    assert summary(extract_jobs(given, pages)) == EXPECTED
    assert summary(extract_jobs(given.repartition(2), pages.repartition(5), max_job_pages=None)) == EXPECTED


def test_switches(spark, pages):
    given = links(spark, SITE, f"{SITE}/careers/SearchJobs")
    assert {k[0] for k in summary(extract_jobs(given, pages, fetch_rss=False))} == {2}
    assert {k[0] for k in summary(extract_jobs(given, pages, fetch_job_pages=False))} == {1}
    with pytest.raises(ValueError, match="at least one"):
        extract_jobs(given, pages, fetch_rss=False, fetch_job_pages=False)


def test_no_enrichment_without_a_hub(spark, pages):
    listing = f"{SITE}/en/careers/SearchJobs"
    body = "<a href='/careers/two'>Two</a><a href='/careers/JobDetail/3'>3</a>"
    extra = read_pages(spark.createDataFrame([(listing, 200, body)], "url string, status int, body string"), PROFILE)
    found = extract_jobs(links(spark, listing), staged(pages.unionByName(extra)))
    assert set(summary(found)) == {(2, f"{SITE}/careers/JobDetail/3")}


def test_page_limit(spark, pages):
    given = links(spark, f"{SITE}/careers/one", f"{SITE}/careers/JobDetail/3", f"{SITE}/careers/JobDetail/4")
    for limit, expected in ((0, 0), (1, 1), (2, 2), (None, 3)):
        found = found_jobs(classify(given, PROFILE), pages, fetch_rss=False, max_job_pages=limit)
        assert found.count() == expected


def test_a_link_of_many_listings(spark):
    apex = f"https://{PROFILE.vendor_apex_hosts[0]}"
    titles = ["Our HR-Trends", "The /blog/ story", "Real job", "Other title", None]
    bodies = [(f"{apex}/l{n}/careers/SearchJobs", 200, f"<a href='/careers/JobDetail/1'>{t}</a>" if t else "<p>none") for n, t in enumerate(titles)]
    bodies.append((f"{apex}/careers/JobDetail/1", 200, "<article>text</article>"))
    read = read_pages(spark.createDataFrame(bodies, "url string, status int, body string"), PROFILE)
    for order in ([0, 1, 2, 3], [3, 0, 2, 1]):
        given = links(spark, *[bodies[n][0] for n in order])
        found = found_jobs(classify(given, PROFILE), read, fetch_rss=False)
        first = next(titles[n] for n in order if n > 1)
        assert summary(found) == {(2, f"{apex}/careers/JobDetail/1"): (first, "text", None)}


def read_folder(path):
    parts = sorted(path.glob("part-*"))
    return "".join(part.read_text(encoding="utf-8") for part in parts)


def test_run_all_writes_everything(spark, fetched, tmp_path):
    certificates = spark.createDataFrame([(f"*.a.{VENDOR}",)], "name_value string")
    results = spark.createDataFrame([], "query string, rank int, href string")
    seeds = tmp_path / "seed.txt"
    seeds.write_text(f"{SITE}/careers/SearchJobs\n")
    path = run_all(spark, certificates, results, fetched, str(tmp_path), [str(seeds)])
    data = tmp_path / "data"
    assert path == str(data / "jobs")
    assert read_folder(data / "career_links").split() == [SITE, f"{SITE}/careers"]
    assert read_folder(data / "all_links").split() == [SITE, f"{SITE}/careers", f"{SITE}/careers/one", f"{SITE}/careers/two"]
    jobs = [json.loads(line) for line in read_folder(data / "jobs").splitlines()]
    # The pages named by the feed are links now: read as listings, not enriched.
    names = ("one", "two", "JobDetail/3", "JobDetail/4")
    assert [j["application_url"] for j in jobs] == [f"{SITE}/careers/{name}" for name in names]
    assert all(j["extracted_at"].endswith("Z") for j in jobs)
    assert "location" not in jobs[1]["metadata"]


def test_array_output(spark, pages, tmp_path):
    seeds = tmp_path / "seed.txt"
    seeds.write_text(f"{SITE}\n{SITE}/careers/SearchJobs\n")
    path = run_extraction(spark, [str(seeds)], pages, str(tmp_path / "data" / "out"), as_array=True)
    assert path == str(tmp_path / "data" / "out")
    text = read_folder(tmp_path / "data" / "out")
    assert "é" in text
    assert {job["application_url"] for job in json.loads(text)} == {url for _, url in EXPECTED}


def test_default_links_and_empty_lists(spark, pages, tmp_path):
    data = tmp_path / "data"
    data.mkdir()
    output = str(data / "jobs")
    assert run_extraction(spark, None, pages, output) is None
    assert not (data / "jobs").exists()
    (data / "initial_links.txt").write_text(f"{SITE}/careers/JobDetail/3\n")
    assert run_extraction(spark, None, pages, output) == output
    jobs = [json.loads(line) for line in read_folder(data / "jobs").splitlines()]
    assert [j["application_url"] for j in jobs] == [f"{SITE}/careers/JobDetail/3"]
    assert run_extraction(spark, [], pages, output) is None
    assert len(read_folder(data / "jobs").splitlines()) == 1


@pytest.mark.parametrize(("given", "expected"), [("data", "data"), ("out", "out/data"), ("s3://b/x/data/", "s3://b/x/data"), (".", "./data")])
def test_outputs_lie_in_a_data_folder(given, expected):
    assert data_folder(given) == expected


@pytest.mark.parametrize("master", ["local[4]", "spark://somewhere:1"])
def test_staging_uses_shared_folders_only(master):
    from vacancyflow.plans.staging import staging_folder

    class Session:
        settings = {"spark.sql.warehouse.dir": "hdfs://warehouse"}

        class conf:
            get = staticmethod(lambda name, default=None: Session.settings.get(name, default))

        class sparkContext:
            applicationId = "app"
            getCheckpointDir = staticmethod(lambda: None)

    Session.sparkContext.master = master
    assert staging_folder(Session).startswith("hdfs://warehouse/staging/")
    Session.settings = {"spark.checkpoint.dir": "hdfs://shared/"}
    assert staging_folder(Session).startswith("hdfs://shared/vacancyflow-")


def test_page_joins_do_not_shuffle_pages(spark, pages):
    from vacancyflow.plans.extract import enrichment_rows

    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        targets = spark.createDataFrame([(SITE, (1, 0, 0, 0))], "url string, seq struct<pass:int,via:int,link:int,pos:int>")
        plan = enrichment_rows(targets, pages, PROFILE)._jdf.queryExecution().executedPlan().toString()
        assert plan.count("Exchange hashpartitioning(url") == 1
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_nothing_is_cut_without_a_limit(spark):
    """Link 101 onward of a listing, long titles, long bodies and late search results."""
    site = f"https://h.{VENDOR}"
    jobs = [f"{site}/careers/JobDetail/{n}" for n in range(130)]
    listing = "".join(f"<a href='{url}'>{'t' * 350}</a>" for url in jobs)
    cards = f"<div class=job>{'c' * 450}<a href='/en/careers/SearchJobs'></a></div>"
    rows = [(f"{site}/careers/SearchJobs", 200, listing), (f"{site}/en_US/careers/SearchJobs", 200, cards), (f"{site}/en/careers/SearchJobs", 200, "<p>" + "x" * 200)]
    rows += [(url, 200, f"<body>{'b' * 16_000}</body>") for url in jobs]
    read = stage_pages(read_pages(spark.createDataFrame(rows, "url string, status int, body string"), WHOLE_PROFILE))
    nodes = read.select("url", "nodes").where(F.col("url").isin(f"{site}/careers/SearchJobs", f"{site}/en_US/careers/SearchJobs"))
    titles = {r.card_title for r in listing_links(nodes, WHOLE_PROFILE).collect()}
    assert "t" * 350 in titles and {len(t) for t in titles} == {350, 450}
    found = found_jobs(classify(links(spark, f"{site}/careers/SearchJobs"), WHOLE_PROFILE), read, fetch_rss=False).collect()
    assert {r.application_url for r in found} == set(jobs)
    assert {(len(r.job_title), len(r.job_description)) for r in found} == {(350, 16_000)}
    results = [(PROFILE.search_queries[0], n, f"https://n{n}.{VENDOR}/x") for n in range(70)]
    assert search_bases(spark.createDataFrame(results, "query string, rank int, href string"), WHOLE_PROFILE).count() == 70
