"""String helpers as Columns."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Blanks of any kind: all below U+3001 that Unicode or ASCII calls white space.
_BLANKS = "".join(chr(code) for code in range(0x3001) if chr(code).isspace())


def strip(text: Column) -> Column:
    """Remove blanks of any kind, not only spaces, from both ends."""
    return F.trim(text, F.lit(_BLANKS))


def none_if_blank(text: Column) -> Column:
    return F.nullif(text, F.lit(""))


def or_default(text: Column, default: str) -> Column:
    return F.coalesce(none_if_blank(text), F.lit(default))


def contains_any(text: Column, words: Sequence[str]) -> Column:
    """One regex alternation, so that a word list costs one pass over the text."""
    return text.rlike("|".join(re.escape(word) for word in words))


def cap(text: Column, limit: int | None, suffix: str = "") -> Column:
    """The first `limit` characters, with `suffix` only where something was cut; no limit means the whole text."""
    if limit is None:
        return text
    return F.when(F.length(text) > limit, F.concat(F.substring(text, 1, limit), F.lit(suffix))).otherwise(text)
