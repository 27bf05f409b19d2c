"""Text helpers; every one is a plain column expression."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def count_char(text: Column, char: str) -> Column:
    """How often ``char`` occurs."""
    return F.length(text) - F.length(F.replace(text, F.lit(char), F.lit("")))


def null_if_blank(text: Column) -> Column:
    return F.nullif(text, F.lit(""))


def value_after_key(text: Column, key: str, width: int | None = None) -> Column:
    """Value after ``key:`` up to the next comma; NULL when the key is absent."""
    found = F.regexp_extract(text, rf"(?:^|,){key}:([^,]*)", 1)
    found = F.when(F.regexp_like(text, F.lit(rf"(?:^|,){key}:")), found)
    return found if width is None else F.substring(found, 1, width)


def number_from_text(text: Column, min_length: int | None = None, kind: str = "bigint") -> Column:
    """Number in a text, NULL if it is none; ``min_length`` also rejects shorter texts."""
    number = text.try_cast(kind)
    return number if min_length is None else F.when(F.length(text) >= min_length, number)


def contains_ignore_case(text: Column, part: Column) -> Column:
    return F.contains(F.lower(text), F.lower(part))


def strip_brackets(text: Column) -> Column:
    """Remove quotes, braces and square brackets."""
    return F.regexp_replace(text, r'[\[\]{}"]', "")
