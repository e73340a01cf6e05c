"""Shape of job rows.

`seq` is processing order: (pass, via, link, pos), where `link` is the order of the link a row came from,
`pos` its place within that link and `via` the pass of the job an enrichment row belongs to.
First-wins rules, limits and merges all compare `seq`; nothing is ever numbered globally. No two rows share
a `seq`, so the texts of a chosen row are found by it.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

FEED_PASS, PAGE_PASS, ENRICH_PASS = 1, 2, 3

METADATA_FIELDS = ("date_posted", "job_id", "source_feed", "source_page", "location")
# What a job from a feed has, known or not.
FEED_FIELDS = ("date_posted", "job_id", "source_feed")
JOB_KEY = ("source_site", "application_url")
JOB_PAYLOAD = ("job_title", "job_description", "metadata", "source_url")
JOB_COLUMNS = ("seq", *JOB_KEY, *JOB_PAYLOAD)


def seq(this_pass: int, link: Column, pos: Column, via: Column | int = 0) -> Column:
    via = F.lit(via) if isinstance(via, int) else via
    return F.struct(
        F.lit(this_pass).alias("pass"), via.alias("via"), link.alias("link"), pos.cast("int").alias("pos")
    )


def metadata(**fields: Column) -> Column:
    missing = F.lit(None).cast("string")
    return F.struct(*[fields.get(name, missing).alias(name) for name in METADATA_FIELDS])
