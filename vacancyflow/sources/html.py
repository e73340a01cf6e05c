"""HTML pages to the few nodes the pipeline needs: the one Python stage, an Arrow-batched UDF.

The tree follows tag-soup rules: an unclosed tag nests until an outer tag closes, an end tag closes up to
its nearest open match, an end tag without a match is ignored, void tags never nest. Script, style,
template and ruby texts and comments are no text. The page is read once, front to back, keeping only the
open tags and the text pieces; choosing between the found nodes is left to native Columns.
"""

from __future__ import annotations

import html
import re
import sys
from bisect import bisect_left
from collections import defaultdict
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from html.entities import html5
from html.parser import HTMLParser
from typing import NamedTuple

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column
from pyspark.sql import functions as F

from vacancyflow.profile import SiteProfile

NODES_TYPE = (
    "struct<titles:array<string>,title_tag:string,descriptions:array<string>,body_text:string,"
    "apply_hrefs:array<string>,metadata:array<struct<selector:string,classes:string,text:string>>,"
    "anchors:array<struct<href:string,text:string>>,cards:array<struct<href:string,text:string>>>"
)
_LINK = pa.struct([("href", pa.string()), ("text", pa.string())])
_META = pa.struct([("selector", pa.string()), ("classes", pa.string()), ("text", pa.string())])
_NODES = pa.struct(
    [
        ("titles", pa.list_(pa.string())),
        ("title_tag", pa.string()),
        ("descriptions", pa.list_(pa.string())),
        ("body_text", pa.string()),
        ("apply_hrefs", pa.list_(pa.string())),
        ("metadata", pa.list_(_META)),
        ("anchors", pa.list_(_LINK)),
        ("cards", pa.list_(_LINK)),
    ]
)

# HTML's void elements, with the obsolete ones.
_VOID = frozenset(
    "area base basefont bgsound br col command embed frame hr image img input isindex keygen link "
    "menuitem meta nextid param source spacer track wbr".split()
)
# Elements whose text belongs to them alone.
_OWN_TEXT = frozenset(("script", "style", "template", "rt", "rp"))

_STEP = re.compile(r"""(?P<tag>[a-z][a-z0-9]*)|\.(?P<cls>[\w-]+)|\[(?P<attr>[\w-]+)(?:(?P<op>[*^]?=)["'](?P<val>[^"']*)["'])?\]""")
_REFERENCE = re.compile(r"&([a-zA-Z#][^;&<\s]*;?)")
_COMPLETE_REFERENCE = re.compile(r"[a-zA-Z][a-zA-Z0-9]*;|#[0-9]+;|#[xX][0-9a-fA-F]+;")
_MANY_BREAKS = re.compile(r"\n{3,}")
_SLICE_BYTES = 1 << 20


@dataclass(frozen=True)
class _Step:
    """One compound of a selector, such as `a.btn[href]`."""

    tag: str | None
    classes: tuple[str, ...]
    attrs: tuple[tuple[str, str, str], ...]

    @classmethod
    def of(cls, text: str) -> _Step:
        tokens = list(_STEP.finditer(text))
        if "".join(t.group() for t in tokens) != text:
            raise ValueError(f"unsupported selector: {text}")
        return cls(
            next((t["tag"] for t in tokens if t["tag"]), None),
            tuple(t["cls"] for t in tokens if t["cls"]),
            tuple((t["attr"], t["op"] or "", t["val"] or "") for t in tokens if t["attr"]),
        )

    def fits(self, tag: str, attrs: dict[str, str]) -> bool:
        if self.tag is not None and self.tag != tag:
            return False
        if self.classes and not set(self.classes) <= set(attrs.get("class", "").split()):
            return False
        for name, op, wanted in self.attrs:
            value = attrs.get(name)
            if value is None:
                return False
            if op:
                if name == "class":
                    value = " ".join(value.split())
                if op == "*=" and wanted not in value:
                    return False
                if op == "^=" and not value.startswith(wanted):
                    return False
                if op == "=" and value != wanted:
                    return False
        return True


@dataclass(frozen=True)
class _Selector:
    """Descendant selector, split into the element it selects and the steps outside of it, inmost first."""

    place: tuple[str, int]
    own: _Step
    outer: tuple[_Step, ...]

    @classmethod
    def of(cls, group: str, rank: int, text: str) -> _Selector:
        *outer, own = (_Step.of(step) for step in text.split())
        return cls((group, rank), own, tuple(reversed(outer)))

    @property
    def key(self) -> str:
        """The tag, .class or [attribute] that an element must have to be worth a closer look."""
        if self.own.tag:
            return self.own.tag
        return f".{self.own.classes[0]}" if self.own.classes else f"[{self.own.attrs[0][0]}"

    @property
    def marks(self) -> tuple[set[str], set[str]]:
        """Attribute names in lower case, and other texts, that any page with a match must hold somewhere."""
        steps = (self.own, *self.outer)
        names = {name for step in steps for name, _, _ in step.attrs}
        values = {value for step in steps for _, _, value in step.attrs if not re.search(r"\s", value)}
        return names, values.union(*[step.classes for step in steps])

    def fits(self, tag: str, attrs: dict[str, str], depths: dict[_Step, list[int]]) -> bool:
        """`depths` has, for every outer step, the rising depths of the open tags that fit it."""
        if not self.own.fits(tag, attrs):
            return False
        inner = sys.maxsize
        for step in self.outer:
            outside = bisect_left(depths[step], inner)
            if not outside:
                return False
            inner = depths[step][outside - 1]
        return True


@dataclass(slots=True)
class _Found:
    """A selected element: its attributes and the slice of text pieces that lie inside it."""

    attrs: dict[str, str]
    kind: str
    start: int
    end: int = -1
    anchors_from: int = 0
    anchors_to: int = 0


class _Open(NamedTuple):
    tag: str
    found: _Found | None
    depths: tuple[list[int], ...]  # of the outer steps that the tag fits


_NO_ATTRS: dict[str, str] = {}


class _Selectors:
    """All selectors of a profile; `for_page` leaves those that the page's text can match at all."""

    def __init__(self, profile: SiteProfile) -> None:
        groups = {
            "title": profile.title_selectors,
            "description": profile.description_selectors,
            "apply": profile.apply_selectors,
            "metadata": profile.metadata_selectors,
            "card": profile.card_selectors,
            "title_tag": ("title",),
            "body": ("body",),
        }
        self.every = [_Selector.of(g, rank, text) for g, texts in groups.items() for rank, text in enumerate(texts)]
        self.marks = [(number, *selector.marks) for number, selector in enumerate(self.every)]
        self.by_key: dict[tuple[int, ...], dict[str, tuple[_Selector, ...]]] = {}

    def for_page(self, body: str, references: set[str]) -> dict[str, tuple[_Selector, ...]]:
        if any(re.search(r"[\w-]", html.unescape(f"&{name}")) for name in references):
            possible = tuple(range(len(self.every)))  # a reference may hide a letter of a name
        else:
            lower = body.lower()
            possible = tuple(
                number
                for number, names, texts in self.marks
                if all(name in lower for name in names) and all(text in body for text in texts)
            )
        if possible not in self.by_key:
            grouped = defaultdict(list)
            for number in possible:
                grouped[self.every[number].key].append(self.every[number])
            self.by_key[possible] = {key: tuple(selectors) for key, selectors in grouped.items()}
        return self.by_key[possible]


class _PageReader(HTMLParser):
    def __init__(self, by_key: dict[str, tuple[_Selector, ...]], want_links: bool, plain_references: bool) -> None:
        super().__init__(convert_charrefs=plain_references)
        self.by_key = by_key
        self.depths = {step: [] for selectors in by_key.values() for s in selectors for step in s.outer}
        self.want_links = want_links
        self.first: dict[tuple[str, int], _Found] = {}
        self.cards: list[_Found] = []
        self.anchors: list[_Found] = []
        self.pieces: dict[str, list[str]] = defaultdict(list)
        self.kinds = [""]
        self.open_tags: list[_Open] = []
        self.open_count: dict[str, int] = defaultdict(int)
        self.buffer: list[str] = []
        self.title_at: int | None = None
        self.title_inner_tags = 0
        self.title_texts: list[tuple[int, str]] = []

    def updatepos(self, i: int, j: int) -> int:
        """Line numbers are not needed."""
        return j

    # Text -----------------------------------------------------------------
    def handle_data(self, data: str) -> None:
        self.buffer.append(data)

    def handle_charref(self, name: str) -> None:
        self.buffer.append(html.unescape(f"&#{name};"))

    def handle_entityref(self, name: str) -> None:
        self.buffer.append(html5.get(f"{name};", f"&{name}"))

    def unknown_decl(self, data: str) -> None:
        self.flush()
        if data[:6].upper() == "CDATA[":
            self.buffer.append(data[6:])
            self.flush()

    def handle_comment(self, data: str) -> None:
        self.flush()
        self.note_title_text(data)

    def handle_decl(self, decl: str) -> None:
        self.flush()

    def handle_pi(self, data: str) -> None:
        self.flush()

    def flush(self) -> None:
        """End the running text node: keep it unless blank."""
        if self.buffer:
            text = "".join(self.buffer)
            self.buffer.clear()
            if self.title_at is not None:
                self.note_title_text(text)
            text = text.strip()
            if text:
                if "\n\n\n" in text:
                    text = _MANY_BREAKS.sub("\n\n", text)
                self.pieces[self.kinds[-1]].append(text)

    def note_title_text(self, text: str) -> None:
        if self.title_at is not None:
            self.title_texts.append((len(self.open_tags) - self.title_at - 1, text))

    def title_tag(self) -> str | None:
        """The title tag's text if it has a single text child, or single tags around one; else nothing."""
        if len(self.title_texts) == 1 and self.title_texts[0][0] == self.title_inner_tags:
            return self.title_texts[0][1].strip()
        return None

    # Tags -----------------------------------------------------------------
    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        if self.buffer:
            self.flush()
        self.open(tag, attrs)
        if tag in _VOID:
            self.close_innermost()

    def handle_startendtag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        self.flush()
        self.open(tag, attrs)
        self.close_innermost()

    def handle_endtag(self, tag: str) -> None:
        if self.buffer:
            self.flush()
        if self.open_count[tag]:
            while self.open_tags[-1].tag != tag:
                self.close_innermost()
            self.close_innermost()

    def open(self, tag: str, attr_list: list[tuple[str, str | None]]) -> None:
        attrs = {name: value or "" for name, value in attr_list} if attr_list else _NO_ATTRS
        found = self.select(tag, attrs)
        if self.title_at is not None:
            self.title_inner_tags += 1
        elif found and self.first.get(("title_tag", 0)) is found:
            self.title_at = len(self.open_tags)
        fitting = tuple(depths for step, depths in self.depths.items() if step.fits(tag, attrs)) if self.depths else ()
        for depths in fitting:
            depths.append(len(self.open_tags))
        self.open_tags.append(_Open(tag, found, fitting))
        self.open_count[tag] += 1
        if tag in _OWN_TEXT:
            self.kinds.append(tag)

    def select(self, tag: str, attrs: dict[str, str]) -> _Found | None:
        """What the element is found as: a selector's first match, a link, a card."""
        by_key = self.by_key
        candidates = by_key.get(tag, ())
        for name in attrs:
            candidates += by_key.get(f"[{name}", ())
            if name == "class":
                for own_class in dict.fromkeys(attrs[name].split()):
                    candidates += by_key.get(f".{own_class}", ())
        is_link = self.want_links and tag == "a" and "href" in attrs
        if not candidates and not is_link:
            return None
        places = [s.place for s in candidates if s.place not in self.first and s.fits(tag, attrs, self.depths)]
        if not places and not is_link:
            return None
        kind = tag if tag in _OWN_TEXT else ""
        hit = _Found(attrs, kind, len(self.pieces[kind]))
        is_card = False
        for place in places:
            if place[0] == "card":
                is_card = True
            else:
                self.first[place] = hit
        if is_link:
            self.anchors.append(hit)
        hit.anchors_from = len(self.anchors)
        if is_card and self.want_links:
            self.cards.append(hit)
        return hit

    def close_innermost(self) -> None:
        closed = self.open_tags.pop()
        self.open_count[closed.tag] -= 1
        for depths in closed.depths:
            depths.pop()
        if closed.found:
            closed.found.end = len(self.pieces[closed.found.kind])
            closed.found.anchors_to = len(self.anchors)
        if closed.tag in _OWN_TEXT:
            self.kinds.pop()
        if self.title_at == len(self.open_tags):
            self.title_at = None

    def finish(self) -> None:
        self.close()
        self.flush()
        while self.open_tags:
            self.close_innermost()

    # Results --------------------------------------------------------------
    def text(self, hit: _Found) -> str:
        return "\n".join(self.pieces[hit.kind][hit.start : hit.end])

    def text_up_to(self, hit: _Found, limit: int | None) -> str:
        """Enough of the text to tell whether it is longer than `limit`; without one, the whole text."""
        if limit is None:
            return self.text(hit)
        pieces, size = [], -1
        for at in range(hit.start, hit.end):
            pieces.append(self.pieces[hit.kind][at])
            size += len(pieces[-1]) + 1
            if size > limit:
                break
        return "\n".join(pieces)[: limit + 1]

    def matches(self, group: str, texts: tuple[str, ...]) -> list[tuple[str, _Found]]:
        return [(text, self.first[group, rank]) for rank, text in enumerate(texts) if (group, rank) in self.first]


def _are_plain(references: set[str], body: str) -> bool:
    """Every character reference is complete and known: then the parser may decode whole texts at once.

    It would read the others differently: an unknown name loses its semicolon, a name never ends early, and
    references in an unfinished last tag stay as they are.
    """
    if body.rfind("<") > body.rfind(">"):
        return False
    return all(_COMPLETE_REFERENCE.fullmatch(name) and (name[0] == "#" or name in html5) for name in references)


def _next_named(anchors: list[_Found], words: tuple[str, ...]) -> list[int]:
    """From every place on, that of the next link with one of the words; the number of links if there is none."""
    places = [len(anchors)] * (len(anchors) + 1)
    for at in range(len(anchors) - 1, -1, -1):
        places[at] = at if any(word in anchors[at].attrs["href"] for word in words) else places[at + 1]
    return places


def _read_page(body: str, want_links: bool, selectors: _Selectors, profile: SiteProfile) -> dict | None:
    references = set(_REFERENCE.findall(body))
    reader = _PageReader(selectors.for_page(body, references), want_links, _are_plain(references, body))
    try:
        reader.feed(body)
        reader.finish()
    except AssertionError:  # the parser's way to refuse markup
        return None
    descriptions: list[str] = []
    for _, hit in reader.matches("description", profile.description_selectors):
        descriptions.append(reader.text(hit))
        if len(descriptions[-1]) > profile.long_description:
            break
    body_text = None
    if not (descriptions and descriptions[-1]) and ("body", 0) in reader.first:
        body_text = reader.text(reader.first["body", 0])
    cards = []
    named = _next_named(reader.anchors, profile.card_link_words) if reader.cards else []
    for card in reader.cards:
        at = named[card.anchors_from] if named[card.anchors_from] < card.anchors_to else card.anchors_from
        if at < card.anchors_to and reader.anchors[at].attrs["href"]:
            cards.append({"href": reader.anchors[at].attrs["href"], "text": reader.text_up_to(card, profile.card_title_cap)})
    return {
        "titles": [reader.text(hit) for _, hit in reader.matches("title", profile.title_selectors)],
        "title_tag": reader.title_tag(),
        "descriptions": descriptions,
        "body_text": body_text,
        "apply_hrefs": [hit.attrs.get("href", "") for _, hit in reader.matches("apply", profile.apply_selectors)],
        "metadata": [
            {"selector": text, "classes": " ".join(hit.attrs.get("class", "").split()), "text": reader.text(hit)}
            for text, hit in reader.matches("metadata", profile.metadata_selectors)
        ],
        "anchors": [
            {"href": a.attrs["href"], "text": reader.text_up_to(a, profile.anchor_title_cap)}
            for a in reader.anchors
        ],
        "cards": cards,
    }


def _slices(bodies: pa.Array) -> Iterator[tuple[int, int]]:
    """Start and length of consecutive rows whose bodies have about `_SLICE_BYTES`; a longer one is alone."""
    start = size = 0
    for at, length in enumerate(pc.binary_length(bodies).to_pylist()):
        if at > start and size + (length or 0) > _SLICE_BYTES:
            yield start, at - start
            start, size = at, 0
        size += length or 0
    if len(bodies):
        yield start, len(bodies) - start


def page_nodes_udf(profile: SiteProfile) -> Callable[[Column, Column], Column]:
    """UDF (body, want_links) -> nodes. Links and cards are listed only where `want_links` is true.

    A batch is read slice by slice: texts and nodes as Python objects take many times the room of its bodies.
    """
    selectors = _Selectors(profile)

    @F.arrow_udf(NODES_TYPE)
    def nodes(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for bodies, want_links in batches:
            for part in _slices(bodies):
                rows = (
                    None if body is None else _read_page(body, bool(wanted), selectors, profile)
                    for body, wanted in zip(bodies.slice(*part).to_pylist(), want_links.slice(*part).to_pylist(), strict=True)
                )
                yield pa.array(rows, type=_NODES)

    # Declared nondeterministic so that no filter on the nodes is pushed below the reading, which would
    # read every page twice.
    return nodes.asNondeterministic()
