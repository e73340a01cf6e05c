"""RSS documents: items as structs, and links mined by pattern."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vacancyflow.functions.once import once
from vacancyflow.functions.text import strip
from vacancyflow.profile import SiteProfile

# Every field is a list: with several elements of one name, or one name in several namespaces, the
# first in document order counts.
_ITEM = (
    "struct<title:array<string>,link:array<string>,description:array<string>,"
    "pubDate:array<string>,guid:array<string>>"
)
_DOCUMENT = f"struct<channel:struct<item:array<{_ITEM}>>,item:array<{_ITEM}>,broken:string>"
_OPTIONS = {"ignoreNamespace": "true", "mode": "PERMISSIVE", "columnNameOfCorruptRecord": "broken"}
# Item elements, and CDATA sections and comments outside of them, which may hold what looks like one.
_ITEM_BLOCK = r"(?s)<!\[CDATA\[.*?\]\]>|<!--.*?-->|<(?:[\w.\-]+:)?item(?:\s[^>]*?)?(?:/>|>.*?</(?:[\w.\-]+:)?item\s*>)"

# `<`, `>`, `&` and `"` that are text and not markup go through the XML reader as noncharacters, so that what it
# returns with a `<` is an element inside a field.
_MARKUP, _MASKS = '<>&"', "\ufdd0\ufdd1\ufdd2\ufdd3"
_CDATA, _CDATA_END = "<![CDATA[", "]]>"
_XML_TOKEN = r"(?s)<!--.*?-->|<!\[CDATA\[.*?\]\]>|[^<]+|<"
_TAG = r"""<(?:[^<>"']|"[^"]*"|'[^']*')*>|<[^>]*>"""


def _masked(body: Column) -> Column:
    """The document with the same texts, but markup characters in CDATA sections and references as noncharacters."""

    def references(text: Column) -> Column:
        signs = F.regexp_replace(text, "&(?:lt|#0*60|#x0*3[cC]);", _MASKS[0])
        return F.regexp_replace(signs, "&(?:quot|#0*34|#x0*22);", _MASKS[3])

    def token(text: Column) -> Column:
        inner = F.substring(text, F.lit(len(_CDATA) + 1), F.length(text) - len(_CDATA + _CDATA_END))
        section = F.length(text) >= len(_CDATA + _CDATA_END)
        return (
            F.when(text.startswith(_CDATA) & section, F.translate(inner, _MARKUP, _MASKS))
            .when(text.startswith("<!--"), text)
            .otherwise(references(text))
        )

    tokens = F.regexp_extract_all(body, F.lit(_XML_TOKEN), 0)
    return F.when(body.contains(_CDATA), F.array_join(F.transform(tokens, token), "")).otherwise(references(body))


def element_text(inner: Column) -> Column:
    """Text of an element of a masked document: what precedes its first child, and all the rest, both stripped."""
    head, rest = F.regexp_extract(inner, "^[^<]*", 0), F.regexp_replace(inner, "^[^<]*", "")
    text = F.concat(strip(head), strip(F.regexp_replace(rest, _TAG, "")))
    return F.translate(text, _MASKS, _MARKUP)


def with_feed_items(rows: DataFrame, body: Column) -> DataFrame:
    """Adds `feed_items`: the items of an RSS or RDF document, none when the XML is malformed.

    Items stand in the channel or under the root. Where a well-formed document has more of them, at whatever
    depth, its item blocks are cut out and read as one flat document. Null bodies cost nothing and give null.
    Fields keep the tags inside them and are masked; `with_item_fields` makes texts of them.
    """
    given, rows, body = rows.columns, once(rows, masked_body=_masked(body)), F.col("masked_body")
    document, flat_document = F.col("feed_document"), F.col("flat_document")
    is_sound = body.isNotNull() & document["broken"].isNull()
    blocks = F.filter(F.regexp_extract_all(body, F.lit(_ITEM_BLOCK), 0), lambda block: ~block.startswith("<!"))
    joined = F.concat(F.lit("<items>"), F.array_join("item_blocks", ""), F.lit("</items>"))
    flat = F.when(F.size("item_blocks") > F.size("usual_items"), joined)
    found = (
        rows.select("*", F.from_xml(body, _DOCUMENT, _OPTIONS).alias("feed_document"))
        .select(
            *given,
            F.when(is_sound, _items_of(document)).alias("usual_items"),
            F.when(is_sound, blocks).alias("item_blocks"),
        )
        .select("*", F.from_xml(flat, _DOCUMENT, _OPTIONS).alias("flat_document"))
        .select(
            *given,
            "usual_items",
            F.when(flat_document["broken"].isNull(), _items_of(flat_document)).alias("all_items"),
        )
    )
    more = F.size("all_items") > F.size("usual_items")
    items = F.when(more, F.col("all_items")).otherwise(F.col("usual_items"))
    return once(found, feed_items=items).drop("usual_items", "all_items")


def _items_of(document: Column) -> Column:
    none = F.expr(f"cast(array() as array<{_ITEM}>)")
    return F.concat(F.coalesce(document["channel"]["item"], none), F.coalesce(document["item"], none))


def with_item_fields(items: DataFrame) -> DataFrame:
    """Replaces the fields of exploded items by title, link, description, pub_date and guid texts.

    A missing field is empty; elements inside a field give their text only.
    """
    lists = ("title", "link", "description", "pubDate", "guid")

    def first(name: str) -> Column:
        return element_text(F.coalesce(F.get(name, 0), F.lit("")))

    # A link element may come as an empty one of another namespace first.
    filled_link = F.get(F.filter("link", lambda link: link != ""), 0)
    texts = {
        "title_text": first("title"),
        "link_text": element_text(F.coalesce(filled_link, F.lit(""))),
        "description_text": first("description"),
        "pub_date_text": first("pubDate"),
        "guid_text": first("guid"),
    }
    others = [name for name in items.columns if name not in lists]
    named = [F.col(name).alias(name.removesuffix("_text")) for name in texts]
    return once(items, **texts).select(*others, *named)


def feed_links(body: Column, profile: SiteProfile) -> Column:
    """All links in the text of a feed: every match of the first pattern, then of the second, and so on."""
    return F.concat(*[F.regexp_extract_all(body, F.lit(pattern), 1) for pattern in profile.feed_link_patterns])
