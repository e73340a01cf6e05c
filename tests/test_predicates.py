"""Acceptance rules; expected values are set by hand."""

import pytest
from pyspark.sql import functions as F

from vacancyflow import DEFAULT_PROFILE as PROFILE
from vacancyflow.functions import predicates, text, urls
from vacancyflow.operators.jobs import with_acceptance

VENDOR = PROFILE.vendor_suffix
POSTINGS = {
    # url, title: posting
    ("", "Engineer"): False,
    (f"https://www.{VENDOR}/careers/5", "Engineer"): True,
    (f"https://{VENDOR}/about", "Engineer"): False,
    (f"https://{VENDOR}/careers", "Engineer"): False,
    (f"https://{VENDOR}/blogs/careers/", "Engineer"): False,
    (f"https://{VENDOR}/{PROFILE.marketing_words[0]}/careers/x", "Engineer"): False,
    (f"https://c.{VENDOR}/ctscareers/x", "Engineer"): True,
    (f"https://C.{VENDOR.upper()}/MyJobs", "Engineer"): True,
    (f"https://c.{VENDOR}/global/SearchJobs", "Engineer"): True,
    (f"https://c.{VENDOR}/about", "Engineer"): False,
    (f"https://c.{VENDOR}/careers/hr-trends/1", "Engineer"): False,
    (f"https://c.{VENDOR}/careers/1", "HR-Trends of the year"): False,
    (f"https://c.{VENDOR}/careers/1", "The /blog/ post"): False,
    (f"https://c.{VENDOR}/careers/1", None): True,
    ("https://other.example/ctscareers/x", "Engineer"): False,
    ("https://other.example/x/jobs", "Engineer"): True,
    ("https://other.example/jobsite", "Engineer"): True,
    ("https://other.example/x?careers", "Engineer"): False,
    ("https://other.example/Careers/1", "Engineer"): True,
}


def test_postings(spark):
    rows = spark.createDataFrame(list(POSTINGS), "url string, title string")
    parts = urls.UrlParts.columns("u_")
    keep = predicates.is_posting(urls.host(parts), urls.lower_path(parts), F.col("title"), PROFILE)
    found = urls.split_url(rows, "url", "u_").select("url", "title", keep.alias("keep")).collect()
    assert {(r.url, r.title): r.keep for r in found} == POSTINGS


JOB = f"https://c.{VENDOR}/careers/1"
FORGOT = "Forgot your password? Login here. "
REGISTERED = "Already registered? LOGIN with your password "
ACCEPTED = {
    # url, title, description: accepted
    (JOB, "T", "Fine"): True,
    (JOB, "T", None): True,
    ("", "T", "Fine"): True,
    (f"https://c.{VENDOR}/blogs/1", "T", "Fine"): False,
    (f"https://c.{VENDOR}/Blogs/1", "T", "Fine"): True,
    (f"https://c.{VENDOR}/x?y=/LOGIN", "T", "Fine"): False,
    (f"https://{VENDOR}/about", "T", "Fine"): False,
    (f"https://c.{VENDOR}/about", "Our hr-trends", "Fine"): True,
    (f"https://{VENDOR}/careers/1", "Our hr-trends", "Fine"): False,
    (JOB, "T", "\n Your password must have " + "x" * 5000): False,
    (JOB, "T", (FORGOT + "x" * 600)[:599]): False,
    (JOB, "T", (FORGOT + "x" * 600)[:600]): True,
    (JOB, "T", " " * 50 + (FORGOT + "x" * 600)[:599] + "\n" * 50): False,
    (JOB, "T", "x" * 580 + FORGOT.strip()): True,
    (JOB, "T", (REGISTERED + "x" * 600)[:499]): False,
    (JOB, "T", (REGISTERED + "x" * 600)[:500]): True,
    (JOB, "T", "So: " + REGISTERED): True,
}


def test_acceptance(spark):
    rows = spark.createDataFrame(list(ACCEPTED), "application_url string, job_title string, job_description string")
    found = with_acceptance(rows, PROFILE).collect()
    assert {(r.application_url, r.job_title, r.job_description): r.acceptable for r in found} == ACCEPTED


@pytest.mark.parametrize("blank", [" ", "\n\t", "\xa0", "　 ", "\x1c\x85"])
def test_strip_equals_the_standard_library(spark, blank):
    padded = f"{blank}a{blank}b{blank}"
    assert spark.createDataFrame([(padded,)], "t string").select(text.strip(F.col("t"))).first()[0] == padded.strip()


def test_cap(spark):
    row = spark.createDataFrame([("ééé",)], "t string").select(text.cap(F.col("t"), 2, "..."), text.cap(F.col("t"), 3, "...")).first()
    assert tuple(row) == ("éé...", "ééé")
