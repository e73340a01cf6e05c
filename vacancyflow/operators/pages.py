"""One job row per page, chosen from the page's nodes; no shuffle anywhere here.

The choosing Columns are over the fields of `nodes`, taken out as columns of their own.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vacancyflow.functions.once import once
from vacancyflow.functions.text import cap, none_if_blank, or_default
from vacancyflow.functions.urls import UrlParts, is_unreadable, resolve, split_url
from vacancyflow.operators.schema import metadata
from vacancyflow.profile import SiteProfile


def page_title() -> Column:
    """Text of the first selector that matches, even if blank; then the title tag; then empty."""
    return F.coalesce(none_if_blank(F.get("titles", 0)), "title_tag", F.lit(""))


def page_description(profile: SiteProfile) -> Column:
    """The first long text, else the last match's text, else the head of the body's text."""
    long_ones = F.filter("descriptions", lambda text: F.length(text) > profile.long_description)
    last = none_if_blank(F.try_element_at("descriptions", F.lit(-1)))
    return F.coalesce(F.get(long_ones, 0), last, cap(F.col("body_text"), profile.body_text_cap), F.lit(""))


def apply_href() -> Column:
    """First filled link among the first matches of the apply selectors; null if there is none."""
    return F.get(F.filter("apply_hrefs", lambda href: href != ""), 0)


def page_metadata(about_location: bool) -> Column:
    """Text of the last match about the place, or of the last other one whose selector names a date; null if there is none."""

    def is_location(match: Column) -> Column:
        return F.lower(match["selector"]).contains("location") | match["classes"].contains("location")

    def is_date(match: Column) -> Column:
        selector = F.lower(match["selector"])
        return ~is_location(match) & (selector.contains("date") | selector.contains("posted"))

    kept = F.filter("metadata", is_location if about_location else is_date)
    return F.try_element_at(kept, F.lit(-1))["text"]


def page_jobs(pages: DataFrame, profile: SiteProfile) -> DataFrame:
    """Job columns for every page that has a title or a description; `pages` has url and nodes.

    Further columns of `pages` are passed through.
    """
    url = F.col("url")
    carried = [name for name in pages.columns if name not in ("url", "nodes")]
    read = once(
        pages.where(F.col("nodes").isNotNull()).select(*carried, "url", "nodes.*"),
        title=page_title(),
        job_description=page_description(profile),
        apply_href=apply_href(),
        location=page_metadata(about_location=True),
        date_posted=page_metadata(about_location=False),
    )
    kept = read.where("title <> '' or job_description <> ''").where(
        ~F.coalesce(is_unreadable(F.col("apply_href")), F.lit(False))
    )
    return with_apply_url(kept).select(
        *carried,
        F.col("page_netloc").alias("source_site"),
        "application_url",
        or_default(F.col("title"), "Untitled").alias("job_title"),
        "job_description",
        metadata(date_posted=F.col("date_posted"), location=F.col("location"), source_page=url).alias("metadata"),
        url.alias("source_url"),
    )


def with_apply_url(rows: DataFrame) -> DataFrame:
    """Adds the URL's parts with page_ and the application_url: the apply link, or the page without one."""
    url, href = F.col("url"), F.col("apply_href")
    split = split_url(split_url(rows, "url", "page_"), "apply_href", "apply_")
    found = resolve(url, UrlParts.columns("page_"), href, UrlParts.columns("apply_"))
    return once(split, application_url=F.coalesce(found, url))
