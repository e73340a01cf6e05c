"""Job links of listing pages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vacancyflow.functions.once import once
from vacancyflow.functions.text import cap, or_default, strip
from vacancyflow.functions.urls import (
    has_digit_segment,
    UrlParts,
    host,
    is_unreadable,
    last_segment,
    lower_path,
    own_path,
    resolve,
    slash_count,
    split_url,
    without_end_slashes,
)
from vacancyflow.profile import SiteProfile

_ANCHOR, _CARD, _PAGE_ITSELF = 0, 1, 2


def is_sign_in(path: Column, profile: SiteProfile) -> Column:
    return path.contains(profile.login_path) | last_segment(path).contains(profile.login_path.strip("/"))


def is_search_form(path: Column, query: Column, profile: SiteProfile) -> Column:
    return (
        path.rlike(f"{profile.listing_word}/*$")
        & ~path.contains(f"/{profile.detail_word}")
        & ~query.contains("jobid")
    )


def names_a_job(path: Column, query: Column, profile: SiteProfile) -> Column:
    """The link says by its words that it leads to a job."""
    deep = slash_count(path) >= 3
    return (
        path.contains(profile.detail_word)
        | query.contains("jobid")
        | (path.contains(profile.listing_word) & deep)
        | (path.contains(profile.career_words[0]) & has_digit_segment(path) & deep)
    )


def lies_below(path: Column, base: Column, profile: SiteProfile) -> Column:
    """The link lies deeper than the listing: something numeric, or several segments, follows.

    Kept as defined: `base`, the listing's path, keeps its case and is cut at the listing word only in lower
    case, while what follows is measured from the length of the uncut path.
    """
    before_word = F.substring_index(base, profile.listing_word, 1)
    prefix = F.lower(F.when(before_word == "", base).otherwise(before_word))
    extra = F.trim(F.substr(path, F.length(base) + 1), F.lit("/"))
    return (path != base) & path.startswith(prefix) & (extra.rlike(r"^\d+$") | extra.contains("/"))


def anchor_counts(profile: SiteProfile) -> Column:
    """Whether a plain link of a listing is a job link."""
    path, query = F.col("path"), F.col("query")
    return (
        F.col("same_host")
        & ~is_sign_in(path, profile)
        & (without_end_slashes(F.col("job_url")) != without_end_slashes(F.col("url")))
        & ~is_search_form(path, query, profile)
        & (names_a_job(path, query, profile) | lies_below(path, F.col("base"), profile))
    )


def card_counts(profile: SiteProfile) -> Column:
    """Whether the link of a job-like block is a job link."""
    path = F.col("path")
    named = path.contains(profile.detail_word) | (path.contains(profile.listing_word) & (slash_count(path) >= 3))
    return F.col("same_host") & named


def readable_listings(listings: DataFrame) -> DataFrame:
    """A listing with a link that cannot be taken apart gives nothing at all."""
    flat = listings.where(F.col("nodes").isNotNull()).select("*", "nodes.anchors", "nodes.cards").drop("nodes")
    return flat.where(~F.exists("anchors", lambda a: is_unreadable(a["href"])))


def _tagged(kind: int, links: str) -> Column:
    return F.transform(
        links, lambda a: F.struct(F.lit(kind).alias("kind"), a["href"].alias("href"), a["text"].alias("text"))
    )


def _page_itself() -> Column:
    no_text = F.lit(None).cast("string").alias("text")
    return F.array(F.struct(F.lit(_PAGE_ITSELF).alias("kind"), F.col("url").alias("href"), no_text))


def listing_links(
    listings: DataFrame, profile: SiteProfile, limit: int | None = None, or_page_itself: bool = False
) -> DataFrame:
    """(url, pos, job_url, card_title): the job links of each listing in document order, each once.

    `listings` has url, once each, and nodes; other columns are passed through. Blocks count only on
    listings without a job anchor. With `or_page_itself`, a listing without any job link gives one row that
    names the listing and has no card title: it stands last in line, so no anti-join is needed to find it.

    All windows are partitioned by the listing, that is by the links of one page, and share one shuffle,
    which a preceding join on url already provides.
    """
    url, kind, href = F.col("url"), F.col("kind"), F.col("href")
    carried = [name for name in listings.columns if name not in ("url", "nodes")]
    in_line = [_tagged(_ANCHOR, "anchors"), _tagged(_CARD, "cards")]
    if or_page_itself:
        in_line.append(_page_itself())
    page, link, job = (UrlParts.columns(prefix) for prefix in ("page_", "link_", "job_"))
    rows = (
        split_url(readable_listings(listings), "url", "page_")
        .select("*", F.posexplode(F.concat(*in_line)).alias("pos", "found"))
        .select("*", "found.*")
        .drop("anchors", "cards", "found")
        .where((kind != _ANCHOR) | (strip(href) != ""))
    )
    split = split_url(rows, "href", "link_")
    resolved = once(split, job_url=F.when(kind == _PAGE_ITSELF, url).otherwise(resolve(url, page, href, link)))
    known = once(
        split_url(resolved, "job_url", "job_"),
        same_host=host(job) == host(page),
        path=lower_path(job),
        query=F.lower(job.query),
        base=without_end_slashes(own_path(page)),
    )
    candidates = known.where(
        F.when(kind == _ANCHOR, anchor_counts(profile)).when(kind == _CARD, card_counts(profile)).otherwise(True)
    )
    title = or_default(F.col("text"), "Job")
    by_listing = Window.partitionBy("url")
    by_link = Window.partitionBy("url", "job_url").orderBy("pos")
    links = (
        candidates.withColumn("first_kind", F.min("kind").over(by_listing))
        .where("kind = first_kind")
        .withColumn("nth_of_link", F.row_number().over(by_link))
        .where("nth_of_link = 1")
        .select(
            *carried,
            "url",
            "pos",
            "job_url",
            F.when(kind == _ANCHOR, cap(title, profile.anchor_title_cap, "..."))
            .when(kind == _CARD, cap(title, profile.card_title_cap, "..."))
            .alias("card_title"),
        )
    )
    if limit is None:
        return links
    nth = F.row_number().over(by_listing.orderBy("pos"))
    return links.withColumn("nth", nth).where(F.col("nth") <= limit).drop("nth")
