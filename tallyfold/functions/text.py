"""Predicates and extraction on short texts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def bounded(text: Column, phrase: str) -> Column:
    """Whether the phrase stands in the text between word boundaries, in any case, by Unicode's notion of a word."""
    return text.rlike(rf"(?iU)\b\Q{phrase}\E\b")


def any_bounded(text: Column, phrases: list[str]) -> Column:
    return text.rlike(r"(?iU)\b(" + "|".join(rf"\Q{p}\E" for p in phrases) + r")\b")


def stripped(text: Column) -> Column:
    """Without white space at both ends, by Unicode's notion of it."""
    return F.regexp_replace(text, r"(?U)^\s+|\s+$", "")


def extracted(text: Column, pattern: str, group: int = 1) -> Column:
    """A group of the first match, null where there is none."""
    return F.nullif(F.regexp_extract(text, pattern, group), F.lit(""))


def length_bucket(chars: Column) -> Column:
    return F.when(chars < 20, "<20").when(chars < 50, "20-49").when(chars < 100, "50-99").when(chars < 200, "100-199").otherwise("200+")


#: Fixed forms in which an author's tag names a group: an emoji code, a bracketed code, a legacy code.
EMOJI_CODE, BRACKET_CODE, LEGACY_CODE = r"^:(\w{2,4})-\d+:", r"^\[([A-Z]{3})\]", r"^:bw-(\w{2,4}):"


def tag_code(tag: Column) -> Column:
    """The code in a tag, upper-cased, whichever form it has."""
    return F.upper(F.coalesce(extracted(tag, EMOJI_CODE), extracted(tag, BRACKET_CODE), extracted(tag, LEGACY_CODE)))


def tag_form(tag: Column) -> Column:
    return F.when(tag.rlike(r"^:[\w-]+:"), "emoji").when(tag.rlike(r"^\[[A-Z]{3}\]"), "bracket").otherwise("other")


def batch_number(name: Column) -> Column:
    """1 of batch_001.jsonl; null where there is no number."""
    return extracted(name, r"batch_(\d+)").cast("int")
