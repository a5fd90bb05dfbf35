"""Text clean-up with JVM expressions only."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def title_case(text: Column) -> Column:
    """Capitalise every run of letters, lower-case the rest ('x_CITY-a' to 'X_City-A')."""
    runs = F.regexp_extract_all(F.lower(text), F.lit(r"(\p{L}+|\P{L}+)"), F.lit(1))
    return F.array_join(
        F.transform(runs, lambda run: F.concat(F.upper(F.left(run, F.lit(1))), F.substr(run, F.lit(2)))),
        "",
    )


def strip_prefix(text: Column, prefix: str) -> Column:
    return F.replace(text, F.lit(prefix), F.lit(""))


def drop_tail(text: Column, keyword: str) -> Column:
    """Cut the text from ``keyword`` on, with the white space before it."""
    return F.trim(F.regexp_replace(text, rf"\s*{keyword}.*$", ""))


def strip_tags(text: Column) -> Column:
    return F.regexp_replace(text, r"<.*?>", "")


def safe_identifier(text: Column) -> Column:
    """Lower-case name with everything but a-z, 0-9 and _ turned into _."""
    return F.regexp_replace(F.lower(F.trim(text)), r"[^a-z0-9_]", "_")


def find_first(text: Column, pattern: str, group: int = 1) -> Column:
    """First match, trimmed; empty text where there is none."""
    return F.trim(F.coalesce(F.regexp_extract(text, pattern, group), F.lit("")))


def wkt_point(text: Column) -> tuple[Column, Column]:
    """The two numbers of 'POINT (a b)', in that order; NULL where malformed."""
    number = r"\s*(-?\d+(?:\.\d+)?)"
    pattern = rf"POINT\s*\({number}{number}\s*\)"
    return tuple(F.regexp_extract(text, pattern, i).try_cast("double") for i in (1, 2))


def unescape(text: Column) -> Column:
    r"""Decode ``\uXXXX`` style escapes by reading the text as a JSON string."""
    quoted = F.concat(F.lit('["'), F.regexp_replace(text, r'(?<!\\)"', r'\\"'), F.lit('"]'))
    return F.coalesce(F.get(F.from_json(quoted, "array<string>"), F.lit(0)), text)


def repair_mojibake(text: Column) -> Column:
    """Undo UTF-8 that was read as Latin-1; other text is left alone."""
    latin = F.rlike(text, F.lit(r"^[\x00-\xFF]*$"))
    raw = F.encode(F.when(latin, text), "ISO-8859-1").cast("string")
    return F.when(latin & F.is_valid_utf8(raw), raw).otherwise(text)


def clean_label(text: Column) -> Column:
    """Unescape, repair, drop tags, trim commas and blanks."""
    bare = strip_tags(repair_mojibake(unescape(F.coalesce(text, F.lit("")))))
    return F.trim(F.regexp_replace(bare, r"^,+|,+$", ""))
