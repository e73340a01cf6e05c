"""Everything that is specific to one applicant-tracking vendor or to one set of limits."""

from __future__ import annotations

from dataclasses import dataclass, replace


@dataclass(frozen=True)
class SiteProfile:
    """Vendor names, paths, selectors and limits; override a field to aim at another vendor.

    The defaults are fixed values: results depend on every one of them.
    """

    # Vendor names.
    vendor_suffix: str = "avature.net"
    vendor_apex_hosts: tuple[str, ...] = ("www.avature.net", "avature.net")
    vendor_token: str = "avature"

    # Discovery.
    search_queries: tuple[str, ...] = (
        "site:avature.net careers",
        '"powered by Avature" careers',
        "inurl:avature.net/careers",
        "inurl:avature.net/jobs",
    )
    search_results_per_query: int | None = 50
    skip_words: tuple[str, ...] = (
        "analytics",
        "cdn",
        "clientcertificate",
        "smtp",
        "mail",
        "sandbox",
        "uat",
        "qa",
        "integrations",
        "jarvis",
        "mobiletrust",
    )
    career_paths: tuple[str, ...] = ("", "/careers", "/jobs")
    crawl_feed_paths: tuple[str, ...] = ("/rss", "/careers/rss", "/jobs/rss", "/feed", "/careers/feed")
    job_feed_paths: tuple[str, ...] = (
        "/rss",
        "/careers/rss",
        "/jobs/rss",
        "/feed",
        "/careers/feed",
        "/jobs/feed",
    )
    # Link patterns of a feed, in the order their matches are listed.
    feed_link_patterns: tuple[str, ...] = (
        r"""(?i)<(?:link|a)\s[^>]*\s(?:href|url)=["']([^"']+)["']""",
        r"""(?i)<link[^>]+href=["']([^"']+)["']""",
        r"<link>([^<]+)</link>",
    )

    # Path words and patterns.
    listing_word: str = "searchjobs"
    detail_word: str = "jobdetail"
    career_words: tuple[str, ...] = ("careers", "jobs")
    blog_paths: tuple[str, ...] = ("/blogs/", "/blog/")
    marketing_words: tuple[str, ...] = ("avatureupfront", "hr-trends")
    non_job_patterns: tuple[str, ...] = ("/blogs/", "/blog/", "avatureupfront", "hr-trends", "test-cookies")
    login_path: str = "/login"

    # Selectors, tried in this order.
    title_selectors: tuple[str, ...] = (
        "h1",
        ".job-title",
        ".position-title",
        "[data-job-title]",
        ".job-header h1",
        ".page-title",
    )
    description_selectors: tuple[str, ...] = (
        ".job-description",
        ".job-description .content",
        ".description",
        ".job-details",
        "article",
        ".job-content",
        ".position-description",
        "[data-job-description]",
        "main .content",
        "main",
        ".content",
    )
    apply_selectors: tuple[str, ...] = (
        'a[href*="apply"]',
        'a[href*="Apply"]',
        'button a[href^="http"]',
        ".apply-button a",
        ".apply-btn a",
        "a.btn-apply[href]",
        "[data-apply-url]",
    )
    metadata_selectors: tuple[str, ...] = (
        ".location",
        ".job-location",
        "[data-location]",
        ".location-value",
        ".posted-date",
        ".date-posted",
    )
    card_selectors: tuple[str, ...] = (
        "[class*='job']",
        "[class*='result']",
        "[class*='position']",
        "[data-job-id]",
    )
    card_link_words: tuple[str, ...] = ("JobDetail", "SearchJobs")

    # Limits. All but the first may be None, which means no limit.
    long_description: int = 100
    body_text_cap: int | None = 15_000
    anchor_title_cap: int | None = 300
    card_title_cap: int | None = 400
    jobs_per_listing: int | None = 100
    max_job_pages: int | None = 500


DEFAULT_PROFILE = SiteProfile()

# The same without any limit on results, links or texts: what the plans use unless another one is given.
WHOLE_PROFILE = replace(
    DEFAULT_PROFILE,
    search_results_per_query=None,
    body_text_cap=None,
    anchor_title_cap=None,
    card_title_cap=None,
    jobs_per_listing=None,
    max_job_pages=None,
)
