"""Discovery from certificate records and search results."""

import json

from vacancyflow import DEFAULT_PROFILE as PROFILE
from vacancyflow.plans import crawl
from vacancyflow.sources.discovery import certificate_domains, read_certificate_records, search_bases

VENDOR = PROFILE.vendor_suffix


def test_certificates(spark, tmp_path):
    records = [
        {"id": 1, "name_value": f"*.A.{VENDOR}\nb.{VENDOR} \nother.example"},
        {"name_value": f"a.{VENDOR}"},
        {"no_names": True},
        {"name_value": f"not{VENDOR}"},
    ]
    array, lines = tmp_path / "array.json", tmp_path / "lines.json"
    array.write_text(json.dumps(records, indent=1))
    lines.write_text("\n".join(json.dumps(record) for record in records))
    expected = {f"a.{VENDOR}", f"b.{VENDOR}", f"not{VENDOR}"}
    for read in (read_certificate_records(spark, str(array), json_lines=False), read_certificate_records(spark, str(lines))):
        assert {r.domain for r in certificate_domains(read, PROFILE).collect()} == expected


def test_search_cap_counts_all_results_of_a_query(spark):
    query = PROFILE.search_queries[0]
    rows = [(query, rank, f"https://n{rank}.{VENDOR}/x" if rank % 2 else "https://other.example") for rank in range(1, 70)]
    rows += [("unknown", 1, f"https://z.{VENDOR}"), (PROFILE.search_queries[1], 1, f"//host.{VENDOR}/"), (query, 0, None)]
    found = search_bases(spark.createDataFrame(rows, "query string, rank int, href string"), PROFILE)
    expected = {f"https://n{rank}.{VENDOR}" for rank in range(1, 50, 2)} | {f"://host.{VENDOR}"}
    assert {r.base for r in found.collect()} == expected


def test_search_cap_works_before_the_shuffle(spark):
    rows = spark.createDataFrame([(PROFILE.search_queries[0], 1, "https://x")], "query string, rank int, href string")
    plan = search_bases(rows, PROFILE)._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan


def test_domains_become_career_urls(spark):
    names = [f" A.{VENDOR}", f"mail.{VENDOR}", f"qatar.{VENDOR}", "other.example", "", f"sandboxb.{VENDOR}"]
    kept = crawl.career_domains(spark.createDataFrame([(n,) for n in names], "domain string"), PROFILE)
    urls = kept.select(crawl.career_urls(kept.domain, PROFILE).alias("url")).collect()
    assert sorted(r.url for r in urls) == [f"https://a.{VENDOR}", f"https://a.{VENDOR}/careers", f"https://a.{VENDOR}/jobs"]
