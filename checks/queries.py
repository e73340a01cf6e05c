"""The registered queries: each runs the package's own functions over tables derived from the given ones."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from checks import fixtures
from vacancyflow import DEFAULT_PROFILE as PROFILE
from vacancyflow import WHOLE_PROFILE, SiteProfile
from vacancyflow.functions import predicates, text, urls
from vacancyflow.functions.once import once
from vacancyflow.operators import feeds, jobs, links, listing, pages, schema
from vacancyflow.plans import counts, crawl, extract
from vacancyflow.plans.staging import staged
from vacancyflow.sinks import files
from vacancyflow.sources import discovery, fetched
from vacancyflow.sources import feeds as feed_source
from vacancyflow.sources import links as link_source
from vacancyflow.sources.wanted import WantedPages

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}


def query(run: Query) -> Query:
    QUERIES[run.__name__] = run
    return run


class Tables:
    """Given tables and fixtures of one scale folder."""

    def __init__(self, spark: SparkSession, folder: str) -> None:
        self.spark, self.folder = spark, folder

    def given(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")

    def spread(self, name: str) -> DataFrame:
        """The given files are single row groups, so one task each. Where a scan has fewer tasks than there
        are cores, spread its rows; a table with enough splits stays unshuffled."""
        rows, cores = self.given(name), self.spark.sparkContext.defaultParallelism
        return rows if rows.rdd.getNumPartitions() >= cores else rows.repartition(cores)

    def fixture(self, sql: str, spread: bool = False) -> DataFrame:
        names = [name for name in ("pages", "events", "documents") if f"{{{name}}}" in sql]
        read = self.spread if spread else self.given
        return self.spark.sql(sql, **{name: read(name) for name in names})

    def wanted_pages(self, profile: SiteProfile = WHOLE_PROFILE) -> WantedPages:
        return WantedPages(self.fixture(fixtures.FETCHED, spread=True), profile)

    def read_pages(self, profile: SiteProfile = PROFILE) -> DataFrame:
        return fetched.read_pages(self.fixture(fixtures.FETCHED, spread=True), profile)

    def nodes(self, sql: str = fixtures.FETCHED) -> DataFrame:
        return fetched.page_nodes(self.fixture(sql, spread=True), WHOLE_PROFILE)

    def classes(self, sql: str = fixtures.LINKS) -> DataFrame:
        return links.classify(self.fixture(sql), PROFILE)


def flat_jobs(rows: DataFrame, *more: str) -> DataFrame:
    return rows.select(*more, *schema.JOB_KEY, "job_title", "job_description", "metadata.*", "source_url")


def flat_seq(*extra: str) -> list[Column]:
    return [F.col("seq.pass"), F.col("seq.via"), F.col("seq.link"), *[F.col(name) for name in extra]]


# Links ------------------------------------------------------------------------
@query
def link_scan(spark, folder):
    rows = Tables(spark, folder).fixture(fixtures.LINK_LINES)
    lines = rows.select(F.struct("source", "line").alias("link_seq"), "value")
    return link_source.valid_links(lines).select("link_seq.*", "url")


@query
def link_merge(spark, folder):
    rows = Tables(spark, folder).fixture(fixtures.LINK_LINES)
    lines = rows.select(F.struct("source", "line").alias("link_seq"), "value")
    return link_source.first_links(link_source.valid_links(lines)).select("link_seq.*", "url")


@query
def link_classes(spark, folder):
    return Tables(spark, folder).classes(fixtures.REPEATED_LINKS)


@query
def link_routing(spark, folder):
    flags = ["is_hub", "is_job_page", "is_listing"]
    classes = Tables(spark, folder).classes(fixtures.REPEATED_LINKS)
    return classes.groupBy(*flags).agg(F.count("*").alias("n"), F.count_distinct("url").alias("n_urls"))


@query
def page_cap(spark, folder):
    classes = Tables(spark, folder).classes(fixtures.REPEATED_LINKS)
    return links.pages_to_read(classes, PROFILE.max_job_pages)


@query
def url_parts(spark, folder):
    rows = Tables(spark, folder).given("pages").select("page_id", "url")
    parts = urls.UrlParts.columns("")
    return urls.split_url(rows, "url", "").select(
        *["page_id", "scheme", "netloc", "query", "fragment"],
        urls.own_path(parts).alias("path"),
        urls.origin(parts).alias("origin"),
    )


@query
def url_segments(spark, folder):
    path = F.col("path")
    rows = Tables(spark, folder).given("pages").select("page_id", "url")
    return once(rows, path=urls.bare_path(urls.UrlParts.split(urls.tidy(F.col("url"))))).select(
        "page_id",
        "path",
        urls.segment_count(path).alias("segments"),
        urls.last_segment(path).alias("last_segment"),
        urls.has_digit_segment(path).alias("has_digit_segment"),
    )


@query
def url_resolve(spark, folder):
    rows = Tables(spark, folder).fixture(fixtures.HREFS)
    split = urls.split_url(urls.split_url(rows, "url", "page_"), "href", "link_")
    page, link = urls.UrlParts.columns("page_"), urls.UrlParts.columns("link_")
    full_url = urls.resolve(F.col("url"), page, F.col("href"), link)
    return split.select("page_id", full_url.alias("full_url"))


# Discovery --------------------------------------------------------------------
def _certificates(tables: Tables) -> DataFrame:
    return tables.fixture(fixtures.CERTIFICATES)


def _search_results(tables: Tables) -> DataFrame:
    names = F.array(*[F.lit(text) for text in (*PROFILE.search_queries, "another search")])
    rows = tables.fixture(fixtures.SEARCH_RESULTS)
    return rows.select(F.get(names, F.col("nth")).alias("query"), "rank", "href")


@query
def ct_domains(spark, folder):
    return discovery.certificate_domains(_certificates(Tables(spark, folder)), PROFILE)


@query
def search_bases(spark, folder):
    return discovery.search_bases(_search_results(Tables(spark, folder)), PROFILE)


@query
def domain_filter(spark, folder):
    names = _certificates(Tables(spark, folder)).select(F.explode(F.split("name_value", "\n")).alias("domain"))
    kept = crawl.career_domains(names, PROFILE)
    return kept.groupBy("domain").agg(F.count("*").alias("n"))


@query
def domain_skip(spark, folder):
    found = discovery.certificate_domains(_certificates(Tables(spark, folder)), PROFILE)
    return found.select("domain", text.contains_any(F.col("domain"), PROFILE.skip_words).alias("skipped"))


@query
def domain_expand(spark, folder):
    found = discovery.certificate_domains(_certificates(Tables(spark, folder)), PROFILE)
    return crawl.career_domains(found, PROFILE).select(
        "domain", crawl.career_urls(F.col("domain"), PROFILE).alias("url")
    )


@query
def url_normalise(spark, folder):
    rows = Tables(spark, folder).fixture(fixtures.SEARCH_RESULTS).where("href <> ''")
    return rows.select(urls.normalise(F.concat("href", F.lit("//"))).alias("url")).distinct()


@query
def discover_union(spark, folder):
    tables = Tables(spark, folder)
    return crawl.discovered_sites(_certificates(tables), _search_results(tables), PROFILE)


def _site_links(tables: Tables) -> DataFrame:
    """Career sites as found: the sites of the fixture, with and without an answer."""
    return tables.fixture(fixtures.WEB).where("role < 2").select("url")


def _answers(tables: Tables) -> DataFrame:
    return fetched.answered(tables.fixture(fixtures.FETCHED))


@query
def validate_links(spark, folder):
    tables = Tables(spark, folder)
    return crawl.validated(_site_links(tables), _answers(tables))


@query
def career_links(spark, folder):
    tables = Tables(spark, folder)
    names = tables.fixture(fixtures.WEB).select(F.regexp_extract("url", "//([^/]+)", 1).alias("name_value"))
    found = crawl.career_links(names, _search_results(tables), _answers(tables), PROFILE)
    return found.orderBy("url")


@query
def site_feeds(spark, folder):
    split = urls.split_url(_site_links(Tables(spark, folder)), "url", "site_")
    sites = split.select(urls.origin(urls.UrlParts.columns("site_")).alias("origin")).distinct()
    return feeds.feed_addresses(sites, PROFILE.crawl_feed_paths)


@query
def site_feed_pick(spark, folder):
    tables = Tables(spark, folder)
    split = urls.split_url(tables.fixture(fixtures.WEB).select("url"), "url", "site_")
    origins = split.select(urls.origin(urls.UrlParts.columns("site_")).alias("origin")).distinct()
    read = feeds.feeds_with(tables.wanted_pages(), "feed_links", PROFILE.crawl_feed_paths, origins)
    with_links = read.where(F.size("feed_links") > 0)
    return feeds.first_feeds(with_links)


@query
def feed_links(spark, folder):
    tables = Tables(spark, folder)
    return feeds.mined_links(_site_links(tables), tables.wanted_pages(), PROFILE)


@query
def all_links(spark, folder):
    tables = Tables(spark, folder)
    found = crawl.all_links(_site_links(tables), tables.wanted_pages(), PROFILE)
    return found.orderBy(*crawl.LINK_ORDER)


# Feeds ------------------------------------------------------------------------
@query
def hub_feeds(spark, folder):
    hubs = links.hub_origins(Tables(spark, folder).classes())
    return feeds.feed_addresses(hubs, PROFILE.job_feed_paths)


@query
def rss_items(spark, folder):
    rows = fetched.answered(Tables(spark, folder).fixture(fixtures.FEEDS))
    read = feed_source.with_feed_items(rows, F.col("body"))
    items = read.select("url", F.posexplode("feed_items").alias("pos", "item")).select("url", "pos", "item.*")
    return feed_source.with_item_fields(items)


@query
def rss_links(spark, folder):
    scheme = urls.UrlParts.split(F.col("url")).scheme
    linked = rss_items(spark, folder).withColumn("link", feeds.item_link(F.col("link"), F.col("guid"), scheme))
    return linked.where("link <> ''").select("url", "pos", "link")


@query
def posting_filter(spark, folder):
    rows = Tables(spark, folder).fixture(fixtures.ACCEPTANCE_ROWS)
    split = urls.split_url(rows, "application_url", "link_")
    parts = urls.UrlParts.columns("link_")
    host, path = urls.host(parts), urls.lower_path(parts)
    keep = predicates.is_posting(host, path, F.col("job_title"), PROFILE)
    return split.select("page_id", keep.alias("is_posting"))


@query
def hub_feed_pick(spark, folder):
    tables = Tables(spark, folder)
    hubs = links.hub_origins(tables.classes())
    return hubs.join(feeds.first_feeds(feeds.posting_items(tables.wanted_pages(), PROFILE, hubs)), "origin")


@query
def rss_jobs(spark, folder):
    tables = Tables(spark, folder)
    rows = feeds.feed_jobs(links.hub_origins(tables.classes()), tables.wanted_pages(), PROFILE)
    return rows.select(*flat_seq("seq.pos", *schema.JOB_KEY, "job_title", "job_description", "metadata.*", "source_url"))


# Pages ------------------------------------------------------------------------
@query
def fetch_join(spark, folder):
    tables = Tables(spark, folder)
    bodies = _answers(tables).select("url", F.length("body").alias("size"), F.md5("body").alias("body_md5"))
    return tables.fixture(fixtures.LINKS).join(bodies, "url")


@query
def page_nodes(spark, folder):
    lists = ("titles", "descriptions", "apply_hrefs", "metadata", "anchors", "cards")
    return Tables(spark, folder).nodes().select("url", "nodes.*").select(
        "url", "title_tag", *[F.size(name).alias(name) for name in lists]
    )


@query
def clean_text(spark, folder):
    plain = "select url, 200 as status, html as body from {pages}"
    return Tables(spark, folder).nodes(plain).select("url", F.get("nodes.descriptions", 0).alias("article_text"))


@query
def page_title(spark, folder):
    return Tables(spark, folder).nodes().select("url", "nodes.*").select("url", pages.page_title().alias("title"))


@query
def page_description(spark, folder):
    described = pages.page_description(WHOLE_PROFILE)
    return Tables(spark, folder).nodes().select("url", "nodes.*").select("url", described.alias("description"))


@query
def page_apply_url(spark, folder):
    links = Tables(spark, folder).nodes().select("url", "nodes.*").select("url", pages.apply_href().alias("apply_href"))
    return pages.with_apply_url(links).select("url", "application_url")


@query
def page_metadata(spark, folder):
    return Tables(spark, folder).nodes().select("url", "nodes.*").select(
        "url",
        pages.page_metadata(about_location=True).alias("location"),
        pages.page_metadata(about_location=False).alias("date_posted"),
    )


@query
def page_jobs(spark, folder):
    return flat_jobs(pages.page_jobs(Tables(spark, folder).nodes(), WHOLE_PROFILE))


@query
def text_caps(spark, folder):
    text_column = F.col("text")
    return Tables(spark, folder).given("documents").select(
        "doc_id",
        text.cap(text_column, PROFILE.anchor_title_cap, "...").alias("anchor_title"),
        text.cap(text_column, PROFILE.card_title_cap, "...").alias("card_title"),
        text.cap(text_column, PROFILE.body_text_cap).alias("body_text"),
    )


@query
def job_defaults(spark, folder):
    given = Tables(spark, folder).fixture(fixtures.ACCEPTANCE_ROWS)
    title = F.when(F.col("page_id") % 3 == 0, "").otherwise(F.col("job_title"))
    return given.select(
        "page_id",
        text.or_default(title, "Untitled").alias("job_title"),
        text.or_default(title, "Job").alias("card_title"),
        text.none_if_blank(F.col("job_description")).alias("date_posted"),
    )


# Listings ---------------------------------------------------------------------
def _listings(tables: Tables, sql: str = fixtures.FETCHED) -> DataFrame:
    to_read = links.pages_to_read(tables.classes(), None).where("is_listing").select("url")
    return to_read.join(tables.nodes(sql), "url")


@query
def listing_links(spark, folder):
    found = listing.listing_links(_listings(Tables(spark, folder)), WHOLE_PROFILE)
    return found.select("url", "job_url", "card_title")


@query
def listing_cap(spark, folder):
    rows = _listings(Tables(spark, folder), fixtures.LONG_FETCHED)
    found = listing.listing_links(rows, PROFILE, PROFILE.jobs_per_listing)
    return found.select("url", "job_url")


@query
def listing_fallback(spark, folder):
    found = listing.listing_links(_listings(Tables(spark, folder)), WHOLE_PROFILE, or_page_itself=True)
    return found.where("card_title is null").select("url")


@query
def listing_jobs(spark, folder):
    tables = Tables(spark, folder)
    classes = tables.classes().where("is_listing")
    read = tables.wanted_pages()
    targets = staged(extract.detail_targets(classes, read, WHOLE_PROFILE, None))
    return flat_jobs(extract.detail_jobs(targets, read, WHOLE_PROFILE))


# Jobs -------------------------------------------------------------------------
@query
def job_accept(spark, folder):
    rows = Tables(spark, folder).fixture(fixtures.ACCEPTANCE_ROWS)
    return jobs.accepted(rows, PROFILE)


@query
def login_wall(spark, folder):
    rows = Tables(spark, folder).fixture(fixtures.ACCEPTANCE_ROWS)
    plain = text.strip(F.col("job_description"))
    is_wall = predicates.is_login_wall(F.lower(plain), F.length(plain))
    return rows.select("page_id", is_wall.alias("is_login_wall"))


@query
def job_dedup(spark, folder):
    rows = Tables(spark, folder).fixture(fixtures.EVENT_JOBS).select(
        F.col("event_id").alias("seq"),
        *schema.JOB_KEY,
        "job_title",
        "job_description",
        schema.metadata().alias("metadata"),
        F.col("application_url").alias("source_url"),
    )
    return jobs.first_wins(rows).select("seq", *schema.JOB_KEY, "job_title", "job_description")


@query
def enrich_merge(spark, folder):
    rows = Tables(spark, folder).fixture(fixtures.DOCUMENT_JOBS).select(
        F.struct("pass", F.col("doc_id").alias("link")).alias("seq"),
        *schema.JOB_KEY,
        "job_title",
        "job_description",
        schema.metadata(location=F.col("location"), date_posted=F.col("date_posted")).alias("metadata"),
        F.concat(F.lit("https://p/"), "doc_id").alias("source_url"),
    )
    found = jobs.first_wins(jobs.accepted(rows.where("seq.pass = 1"), PROFILE))
    merged = jobs.merge_enrichment(found, rows.where("seq.pass = 3"), PROFILE)
    return flat_jobs(merged, "seq.pass", "seq.link")


def _pages_and_classes(tables: Tables) -> tuple[WantedPages, DataFrame]:
    return tables.wanted_pages(), tables.classes()


@query
def enrich_targets(spark, folder):
    tables = Tables(spark, folder)
    read, classes = _pages_and_classes(tables)
    found = extract.found_jobs(classes, read, WHOLE_PROFILE, max_job_pages=None)
    return extract.enrichment_targets(found, classes, None).select("url", *flat_seq())


@query
def jobs_all(spark, folder):
    tables = Tables(spark, folder)
    read = tables.wanted_pages()
    found = extract.extract_jobs(tables.fixture(fixtures.LINKS), read, WHOLE_PROFILE, max_job_pages=None)
    return flat_jobs(found, *flat_seq())


@query
def jobs_json(spark, folder):
    tables = Tables(spark, folder)
    read, classes = _pages_and_classes(tables)
    found = extract.found_jobs(classes, read, WHOLE_PROFILE, max_job_pages=None)
    return files.job_array_lines(staged(found)).orderBy("part", "seq").select("value")


@query
def run_counts(spark, folder):
    tables = Tables(spark, folder)
    given = tables.fixture(fixtures.LINKS)
    per_hub = counts.feed_counts(given, tables.wanted_pages(), PROFILE)
    return counts.link_counts(given, PROFILE).unionByName(
        per_hub.select(F.concat(F.lit("items of "), "url").alias("measure"), "n")
    )
