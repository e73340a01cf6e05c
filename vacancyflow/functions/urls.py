"""URL taking-apart and joining as native Column expressions (RFC 3986 splitting, no UDF).

Functions that need several parts of a URL take `UrlParts`. Callers compute them with `split_url`.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, fields

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vacancyflow.functions.once import once

_URL = r"(?s)^(?:([A-Za-z][A-Za-z0-9+.\-]*):)?(?://([^/?#]*))?([^?#]*)(?:\?([^#]*))?(?:#(.*))?$"
_LEADING_CONTROLS_OR_BREAKS = r"^[\x00-\x20]+|[\t\r\n]"
_DOT_SEGMENT = r"(?:^|/)\.\.?(?:/|$)"
# A host part with only one of the two square brackets.
_BROKEN_HOST = (
    r"^[\x00-\x20]*(?:[A-Za-z][A-Za-z0-9+.\-]*:)?//"
    r"(?:[^/?#\[]*\][^/?#\[]*|[^/?#\]]*\[[^/?#\]]*)(?:[/?#]|$)"
)


@dataclass(frozen=True)
class UrlParts:
    """Scheme (lower case), netloc as written, path, query and fragment; missing ones are empty.

    Flat columns, not a struct: pruning single struct fields below a chain of generators makes Spark 4.1
    drop columns that are still needed.
    """

    scheme: Column
    netloc: Column
    path: Column
    query: Column
    fragment: Column

    @classmethod
    def split(cls, tidy_url: Column) -> UrlParts:
        scheme, *others = (F.regexp_extract(tidy_url, _URL, group) for group in range(1, 6))
        return cls(F.lower(scheme), *others)

    @classmethod
    def columns(cls, prefix: str) -> UrlParts:
        return cls(*[F.col(prefix + part.name) for part in fields(cls)])

    def named(self, prefix: str) -> dict[str, Column]:
        return {prefix + part.name: getattr(self, part.name) for part in fields(self)}


def tidy(url: Column) -> Column:
    """Without leading blanks and controls, and without line breaks and tabs anywhere."""
    return F.regexp_replace(url, _LEADING_CONTROLS_OR_BREAKS, "")


def split_url(rows: DataFrame, url: str, prefix: str) -> DataFrame:
    """Adds the parts of the column `url`, each computed once; `UrlParts.columns(prefix)` names them."""
    clean = f"{prefix}tidy_url"
    return once(once(rows, **{clean: tidy(F.col(url))}), **UrlParts.split(F.col(clean)).named(prefix)).drop(clean)


def host(parts: UrlParts) -> Column:
    return F.lower(parts.netloc)


def origin(parts: UrlParts) -> Column:
    return F.concat(parts.scheme, F.lit("://"), parts.netloc)


def own_path(parts: UrlParts) -> Column:
    """Path without `;params` of its last segment."""
    return F.regexp_replace(parts.path, ";[^/]*$", "")


def lower_path(parts: UrlParts) -> Column:
    return F.lower(own_path(parts))


def without_end_slashes(text: Column) -> Column:
    return F.rtrim(text, F.lit("/"))


def bare_path(parts: UrlParts) -> Column:
    """Lower-cased path without trailing slashes: the form the link classes are defined on."""
    return without_end_slashes(lower_path(parts))


def segment_count(path: Column) -> Column:
    return F.regexp_count(path, F.lit("[^/]+"))


def slash_count(path: Column) -> Column:
    return F.regexp_count(path, F.lit("/"))


def last_segment(path: Column) -> Column:
    return F.substring_index(path, "/", -1)


def has_digit_segment(path: Column) -> Column:
    return path.rlike(r"(?:^|/)[0-9]+(?:/|$)")


def is_unreadable(url: Column) -> Column:
    """True for a link whose host part cannot be taken apart."""
    return url.rlike(_BROKEN_HOST)


def normalise(url: Column) -> Column:
    """No trailing slashes, and a scheme in front."""
    bare = without_end_slashes(url)
    return F.when(bare.startswith("http"), bare).otherwise(F.concat(F.lit("https://"), bare))


def feed_rank(url: Column, parts: UrlParts, paths: Sequence[str]) -> Column:
    """1-based place of a feed URL in `paths`, 0 for any URL that is not an origin plus one of them."""
    at = F.array_position(F.array(*[F.lit(path) for path in paths]), parts.path)
    return F.when(url == F.concat(origin(parts), parts.path), at).otherwise(0).cast("int")


def _without_dot_segments(path: Column) -> Column:
    segments = F.split(path, "/", -1)
    kept = F.aggregate(
        F.filter(segments, lambda s: s != "."),
        F.expr("cast(array() as array<string>)"),
        lambda done, s: F.when(s == "..", F.slice(done, 1, F.greatest(F.size(done) - 1, F.lit(0)))).otherwise(
            F.concat(done, F.array(s))
        ),
    )
    ended_on_dots = last_segment(path).isin(".", "..")
    end = F.when(ended_on_dots, F.array(F.lit(""))).otherwise(F.expr("cast(array() as array<string>)"))
    joined = F.array_join(F.concat(kept, end), "/")
    return F.concat(F.lit("/"), F.regexp_replace(joined, "^/", ""))


def _prefixed(mark: str, text: Column) -> Column:
    return F.when(text != "", F.concat(F.lit(mark), text)).otherwise("")


def resolve(base_url: Column, base: UrlParts, href: Column, link: UrlParts) -> Column:
    """Absolute form of `href`, whose parts are `link`, as seen from the http(s) URL with the parts `base`."""
    path = link.path
    directory = F.regexp_replace(base.path, "[^/]*$", "")
    relative = F.regexp_replace(F.concat(F.lit("/"), directory, path), "/{2,}", "/")
    merged = F.when(path.startswith("/"), path).otherwise(relative)
    clean = F.when(merged.rlike(_DOT_SEGMENT), _without_dot_segments(merged)).otherwise(merged)
    fragment = _prefixed("#", link.fragment)
    tail = F.concat(_prefixed("?", link.query), fragment)
    inherited = F.when(link.query == "", base.query).otherwise(link.query)
    elsewhere_path = F.when((path == "") | path.startswith("/"), path).otherwise(F.concat(F.lit("/"), path))
    return (
        F.when(href == "", base_url)
        .when((link.scheme != "") & (link.scheme != base.scheme), href)
        .when(link.netloc != "", F.concat(base.scheme, F.lit("://"), link.netloc, elsewhere_path, tail))
        .when(path == "", F.concat(origin(base), base.path, _prefixed("?", inherited), fragment))
        .otherwise(F.concat(origin(base), clean, tail))
    )
