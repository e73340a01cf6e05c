"""Link files, link classes and limits; expected values are set by hand."""

import pytest
from pyspark.sql import functions as F

from vacancyflow import DEFAULT_PROFILE as PROFILE
from vacancyflow.operators import links
from vacancyflow.sources.links import load_link_file, load_links, read_link_lines, valid_links

# path: hub, job page, listing
CLASSES = {
    "": (True, False, False),
    "/": (True, False, False),
    "/careers": (True, False, True),
    "/Jobs/": (True, False, True),
    "/careers/123": (True, True, True),
    "/careers/SearchJobs": (True, True, True),
    "/en_US/careers": (False, True, True),
    "/en_US/careers/SearchJobs": (False, True, True),
    "/en_US/careers/team/5": (False, True, False),
    "/careers/JobDetail/Title/5": (False, True, False),
    "/careers/JobDetail/SearchJobs/5": (False, True, False),
    "/jobs/Home": (True, True, True),
    "/SearchJobs": (False, False, True),
    "/externalcareers": (False, False, True),
    "/blogs/a-post": (False, True, False),
    "/about": (False, False, False),
    "/a/b": (False, True, False),
    "/x/blog/": (False, True, False),
    "/careers;v=1": (True, False, True),
    "/team/other/careers": (False, True, True),
}


def test_link_classes(spark):
    rows = spark.createDataFrame([(n, "https://h.example" + path) for n, path in enumerate(CLASSES)], "link_seq int, url string")
    found = {
        r.url.removeprefix("https://h.example"): (r.is_hub, r.is_job_page, r.is_listing)
        for r in links.classify(rows, PROFILE).collect()
    }
    assert found == CLASSES


def test_files_keep_order_and_drop_other_lines(spark, tmp_path):
    first, second = tmp_path / "first.txt", tmp_path / "second.txt"
    first.write_text("# comment\n\n  https://a.example/1  \nftp://no\nHTTP://no\nhttp://b.example\nhttps://a.example/1\n", encoding="utf-8")
    second.write_text("https://c.example/é\nhttp://b.example\nhttps://d.example", encoding="utf-8")
    merged = load_links(spark, [str(first), str(tmp_path / "missing.txt"), str(second)]).orderBy("link_seq")
    assert [r.url for r in merged.collect()] == ["https://a.example/1", "http://b.example", "https://c.example/é", "https://d.example"]
    assert [r.url for r in load_links(spark, [str(first)]).orderBy("link_seq").collect()] == ["https://a.example/1", "http://b.example"]
    single = load_link_file(spark, str(first)).orderBy("link_seq")
    assert [r.url for r in single.collect()] == ["https://a.example/1", "http://b.example", "https://a.example/1"]
    assert load_links(spark, [str(tmp_path / "missing.txt")]).count() == 0


def test_line_order_over_many_splits(spark, tmp_path):
    file = tmp_path / "many.txt"
    wanted = [f"https://h.example/{n:05d}" for n in range(5000, 0, -1)]
    file.write_text("\n".join(wanted), encoding="utf-8")
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "16k")
    try:
        lines = valid_links(read_link_lines(spark, [str(file)]))
        assert lines.rdd.getNumPartitions() > 3
        assert [r.url for r in lines.orderBy("link_seq").collect()] == wanted
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)


@pytest.mark.parametrize("limit", [3, None])
def test_page_limit_counts_repeats(spark, limit):
    names = ["/a/b", "/x", "/a/b", "/c/d", "/e/f"]
    rows = spark.createDataFrame([(n, "https://h.example" + p) for n, p in enumerate(names)], "link_seq int, url string")
    found = links.pages_to_read(links.classify(rows.repartition(3), PROFILE), limit)
    expected = {("/a/b", 0), ("/c/d", 3)} | (set() if limit else {("/e/f", 4)})
    assert {(r.url.removeprefix("https://h.example"), r.link_seq) for r in found.collect()} == expected


def test_hub_origins_take_the_first_hub(spark):
    rows = spark.createDataFrame(
        [(5, "https://H.example/careers"), (2, "https://H.example"), (1, "http://H.example"), (0, "https://H.example/a/b")],
        "link_seq int, url string",
    )
    found = links.hub_origins(links.classify(rows, PROFILE)).orderBy("link_seq").collect()
    assert [(r.origin, r.link_seq) for r in found] == [("http://H.example", 1), ("https://H.example", 2)]
    assert links.classify(rows, PROFILE).where(F.col("is_hub")).count() == 3
