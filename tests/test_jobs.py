"""First-wins and merging, against a row-by-row replay of the rules."""

import random

import pytest
from pyspark.sql import functions as F

from vacancyflow import DEFAULT_PROFILE as PROFILE
from vacancyflow.operators import schema
from vacancyflow.operators.jobs import accepted, first_wins, merge_enrichment

ROWS = (
    "pass int, link int, source_site string, application_url string, job_title string, job_description string, "
    "date_posted string, location string, source_url string"
)
WALL = "Your password must be new "


def random_rows(seed, count):
    rng = random.Random(seed)
    rows = []
    for n in range(count):
        hot = rng.random() < 1 / 3
        link = "https://h.example/careers/" + ("hot" if hot else str(rng.randrange(12)))
        if rng.random() < 0.1:
            link += "/login"
        text = rng.choice(["", "a", "b", "aa", "bb", WALL, WALL + "and longer than the rest"])
        place = rng.choice([None, None, "", f"L{n}"])
        rows.append(
            (rng.choice([1, 3, 3]), n, f"s{0 if hot else rng.randrange(2)}", link, f"T{n}", text, rng.choice([None, f"D{n}"]), place, f"u{n}")
        )
    return rows


def frame(spark, rows):
    return spark.createDataFrame(rows, ROWS).select(
        F.struct("pass", "link").alias("seq"),
        *schema.JOB_KEY,
        "job_title",
        "job_description",
        schema.metadata(date_posted=F.col("date_posted"), location=F.col("location")).alias("metadata"),
        "source_url",
    )


def replay(rows):
    jobs = {}
    for number, link, site, url, title, text, date, place, source in sorted(rows):
        barred = "/login" in url or text.startswith("Your password must")
        job = jobs.get((site, url))
        if job is None:
            if not barred:
                jobs[site, url] = [number, link, title, text, date, place, source]
        elif number == 3:
            if len(text) > len(job[3]):
                job[3] = text
            job[4] = job[4] if date is None else date
            job[5] = job[5] if place is None else place
    return {key: tuple(job) for key, job in jobs.items()}


@pytest.mark.parametrize("seed", range(4))
def test_merge_equals_replay(spark, seed):
    rows = random_rows(seed, 150)
    found = first_wins(accepted(frame(spark, [r for r in rows if r[0] == 1]), PROFILE))
    later = frame(spark, [r for r in rows if r[0] == 3]).repartition(5)
    merged = merge_enrichment(found.repartition(3), later, PROFILE).collect()
    assert len(merged) == len({(r.source_site, r.application_url) for r in merged})
    assert replay(rows) == {
        (r.source_site, r.application_url): (
            *(r.seq["pass"], r.seq.link, r.job_title, r.job_description),
            *(r.metadata.date_posted, r.metadata.location, r.source_url),
        )
        for r in merged
    }


def aggregates_over(frame, name):
    """The aggregates of the plan whose functions mention a column."""
    plan = frame._jdf.queryExecution().executedPlan().toString()
    return [line for line in plan.splitlines() if "Aggregate" in line and name in line]


def test_first_wins_reduces_before_the_shuffle(spark):
    chosen = first_wins(frame(spark, random_rows(0, 20)))
    plan = chosen._jdf.queryExecution().executedPlan().toString()
    assert "partial_min" in plan
    assert "Window" not in plan
    assert not aggregates_over(chosen, "job_description")


def test_texts_stay_out_of_aggregates(spark):
    rows = random_rows(1, 40)
    found = first_wins(accepted(frame(spark, [r for r in rows if r[0] == 1]), PROFILE))
    merged = merge_enrichment(found, frame(spark, [r for r in rows if r[0] == 3]), PROFILE)
    assert aggregates_over(merged, "application_url")
    for text in ("job_description", "job_title"):
        assert not aggregates_over(merged, text)


def test_no_description_is_the_shortest(spark):
    place = ("s0", "https://h.example/careers/x")
    rows = [(1, 1, *place, "T", None, None, None, "u1"), (3, 2, *place, "U", "text", None, None, "u2")]
    merged = merge_enrichment(frame(spark, rows[:1]), frame(spark, rows[1:]), PROFILE).collect()
    assert [(r.job_title, r.job_description, r.source_url) for r in merged] == [("T", "text", "u1")]
