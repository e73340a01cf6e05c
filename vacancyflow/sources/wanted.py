"""Reading only the wanted pages of a fetched-page table, and of each page only its newest fetch.

A fetched-page table is far larger than what one run asks for, and taking a page apart costs much more than
scanning it. So each hop of a run (listings, then their jobs, then application links) names its URLs, a
Bloom filter of them goes to the scan, and only what passes is taken apart; an exact semi join behind it
drops what passed by chance. No body is shuffled.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vacancyflow.functions.once import once
from vacancyflow.plans.staging import staged
from vacancyflow.profile import SiteProfile
from vacancyflow.sources.feeds import feed_links, with_feed_items
from vacancyflow.sources.fetched import newest_fetches, split_bodies, with_nodes

FILTER_BITS = 1 << 26  # 8 MB; on more than some ten million URLs it lets more through, never less
_PROBES = (0, 32)


def _probe(key: str, shift: int) -> str:
    return f"(shiftrightunsigned({key}, {shift}) & {FILTER_BITS - 1})"


def filter_words(keys: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(word, bits): a Bloom filter of the rows, two bits each, in at most FILTER_BITS / 64 rows."""
    hashed = keys.select(F.xxhash64(*columns).alias("key"))
    bits = hashed.select(F.explode(F.array(*[F.expr(_probe("key", shift)) for shift in _PROBES])).alias("bit"))
    word = F.shiftright("bit", 6).alias("word")
    return bits.groupBy(word).agg(F.bit_or(F.expr("shiftleft(1L, int(bit & 63))")).alias("bits"))


def maybe_among(rows: DataFrame, columns: Sequence[str], words: DataFrame) -> DataFrame:
    """The rows whose columns may be among those of the filter; two lookups in a broadcast of bounded size."""
    found = once(rows, _key=F.xxhash64(*columns))
    for n, shift in enumerate(_PROBES):
        named = F.broadcast(words.toDF(f"_word{n}", f"_bits{n}"))
        hit = F.expr(f"{_probe('_key', shift)} >> 6") == F.col(f"_word{n}")
        has_bit = F.expr(f"(_bits{n} & shiftleft(1L, int({_probe('_key', shift)} & 63))) <> 0")
        found = found.join(named, hit).where(has_bit)
    return found.select(*rows.columns)


class WantedPages:
    """The answered pages of `fetched` (url, status, body, and maybe fetched_at), read by name.

    Where `fetched_at` exists, only the newest fetch of a URL counts, whatever its status; rows equal in url
    and fetched_at are taken as copies.
    """

    def __init__(self, fetched: DataFrame, profile: SiteProfile) -> None:
        self.fetched, self.profile = fetched, profile

    def urls(self) -> DataFrame:
        """(url) of every answered page; no body is read."""
        return newest_fetches(self.fetched).where("status = 200").select("url")

    def places(self, urls: DataFrame) -> DataFrame:
        """What names the wanted fetches: url, and fetched_at where it exists; stored, as it is read twice."""
        wanted = urls.select("url").distinct()
        if "fetched_at" not in self.fetched.columns:
            return staged(wanted)
        # The semi join comes first, on narrow rows.
        narrow = self.fetched.select("url", "fetched_at").join(wanted, "url", "left_semi")
        return staged(narrow.groupBy("url").agg(F.max("fetched_at").alias("fetched_at")))

    def candidates(self, places: DataFrame) -> DataFrame:
        """Fetched rows that pass the filter: the wanted ones, and some others by chance."""
        answered = self.fetched.where("status = 200").select(*places.columns, "body")
        return maybe_among(answered, places.columns, filter_words(places, places.columns))

    def nodes(self, urls: DataFrame) -> DataFrame:
        """(url, nodes) of the answered ones of `urls`; they should be stored, as they are read twice."""
        places = self.places(urls)
        rows = split_bodies(self.candidates(places))
        found = with_nodes(rows, self.profile).select(*places.columns, "nodes")
        return found.join(places, places.columns, "left_semi").select("url", "nodes")

    def feeds(self, urls: DataFrame, column: str) -> DataFrame:
        """(url, `column`) of the answered ones of `urls`: feed_items or feed_links."""
        places = self.places(urls)
        bodies = self.candidates(places)
        if column == "feed_items":
            found = with_feed_items(bodies, F.col("body"))
        else:
            found = once(bodies, feed_links=feed_links(F.col("body"), self.profile))
        found = found.select(*places.columns, column)
        return found.join(places, places.columns, "left_semi").select("url", column)


Pages = DataFrame | WantedPages


def nodes_of(pages: Pages, urls: DataFrame) -> DataFrame:
    """(url, nodes): those of `urls` at least; tables that were read before are given as they are."""
    return pages.nodes(urls) if isinstance(pages, WantedPages) else pages.select("url", "nodes")


def feeds_of(pages: Pages, addresses: DataFrame, column: str) -> DataFrame:
    """(url, column) of feeds: those at `addresses` (feed_url) at least."""
    if isinstance(pages, WantedPages):
        return pages.feeds(addresses.select(F.col("feed_url").alias("url")), column)
    return pages.where(F.col(column).isNotNull()).select("url", column)


def answered_urls(pages: Pages) -> DataFrame:
    return pages.urls() if isinstance(pages, WantedPages) else pages.select("url")
