"""Whitespace, trimming, word and rounding expressions."""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# Whitespace as a Unicode-aware language sees it: all separators (Z) and the control
# characters that count as space. Java's \s alone is ASCII only, and its (?U)\s leaves
# out 1C-1F. Kept short: every character of every mail is tested against it.
SPACE_CLASS = r"[\t-\r\x1c-\x20\x85\p{Z}]"
SPACE_CHARS = "".join(map(chr, [
    *range(0x09, 0x0E), *range(0x1C, 0x21), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B),
    0x2028, 0x2029, 0x202F, 0x205F, 0x3000,
]))
# Whitespace as a browser sees it.
WEB_SPACE_CLASS = r"[\t-\r\p{Z}\x{feff}]"
WEB_SPACE_CHARS = "".join(map(chr, [
    *range(0x09, 0x0E), 0x20, 0xA0, 0x1680, *range(0x2000, 0x200B),
    0x2028, 0x2029, 0x202F, 0x205F, 0x3000, 0xFEFF,
]))
EMAIL_ADDRESS = r"(?i)[A-Z0-9._%+-]+@[A-Z0-9.-]+\.[A-Z]{2,}"


def blank_if_null(col: Column) -> Column:
    return F.coalesce(col, F.lit(""))


def strip(col: Column) -> Column:
    """Trim Unicode whitespace at both ends."""
    return F.btrim(col, F.lit(SPACE_CHARS))


def web_strip(col: Column) -> Column:
    return F.btrim(col, F.lit(WEB_SPACE_CHARS))


def collapse_spaces(col: Column) -> Column:
    """Each whitespace run becomes one space; no whitespace is left at the ends."""
    return F.btrim(F.regexp_replace(col, SPACE_CLASS + "+", " "))


def web_collapse_spaces(col: Column) -> Column:
    return F.btrim(F.regexp_replace(col, WEB_SPACE_CLASS + "+", " "))


def clean_text(col: Column, max_chars: int | None = None) -> Column:
    """Null-safe whitespace clean-up, optionally cut to the first ``max_chars``."""
    cleaned = collapse_spaces(blank_if_null(col))
    return cleaned if max_chars is None else F.substring(cleaned, 1, max_chars)


def count_contained(col: Column, words: list[str]) -> Column:
    """How many of the words occur in ``col`` (each counted once)."""
    return reduce(lambda a, b: a + b, [F.contains(col, F.lit(w)).cast("int") for w in words],
                  F.lit(0))


def any_contained(col: Column, words: list[str]) -> Column:
    return reduce(lambda a, b: a | b, [F.contains(col, F.lit(w)) for w in words], F.lit(False))


def count_of(col: Column, token: str) -> Column:
    """Non-overlapping occurrences of ``token``."""
    return F.size(F.split(col, re.escape(token))) - 1


def first_text(*cols: Column) -> Column:
    """First value that is neither null nor empty."""
    return F.coalesce(*[F.nullif(c, F.lit("")) for c in cols])


def round2(col: Column) -> Column:
    """Round to cents on a decimal, so that float noise cannot move the last digit."""
    return F.round(col.cast("decimal(18,6)"), 2).cast("double")


def seeded_key(seed: int, *cols: Column) -> Column:
    """A stable pseudo-random sort key."""
    return F.md5(F.concat_ws("", F.lit(str(seed)), *[c.cast("string") for c in cols]))
