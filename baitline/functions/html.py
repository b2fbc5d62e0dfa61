"""Visible text, titles and links of HTML, by regular expressions inside the JVM."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from baitline.functions.strings import blank_if_null, web_collapse_spaces

# Pages may be written to slow their reader down. Every pattern takes time in proportion to the
# page: a part that is never closed reaches to the end, as in a browser, and no tag reaches
# beyond the next opening bracket.

# Parts that are never rendered. The first pattern takes the head, once.
HEAD = r"(?is)\A(?>(.*?)<head\b).*?</head\s*+>"
HIDDEN = (r"(?is)<!--.*?(?:-->|\z)|<script\b.*?(?:</script\s*+>|\z)|<style\b.*?(?:</style\s*+>|\z)"
          r"|<noscript\b.*?(?:</noscript\s*+>|\z)|<template\b.*?(?:</template\s*+>|\z)")
# Tags that do not break a line: text on both sides runs together.
INLINE_TAG = (r"(?is)</?(?:a|abbr|b|bdi|bdo|cite|code|del|dfn|em|font|i|ins|kbd|label|mark|q|s|samp"
              r"|small|span|strike|strong|sub|sup|time|tt|u|var|wbr)(?:\s[^<>]*+)?/?>")
ANY_TAG = r"(?s)<[^<>]++>"
TITLE = r"(?is)<title\b[^<>]*+>(.*?)(?:</title\s*+>|\z)"
LINK = r"""(?is)<a\s(?:[^<>]*?\s)?href\s*+=\s*+("[^"]*"|'[^']*'|[^\s"'>]+)"""
ENTITIES = {
    "&lt;": "<", "&gt;": ">", "&quot;": '"', "&apos;": "'", "&nbsp;": " ",
    "&copy;": "©", "&reg;": "®", "&trade;": "™", "&middot;": "·",
    "&bull;": "•", "&hellip;": "…", "&ndash;": "–", "&mdash;": "—",
    "&lsquo;": "‘", "&rsquo;": "’", "&ldquo;": "“", "&rdquo;": "”",
    "&laquo;": "«", "&raquo;": "»", "&euro;": "€", "&pound;": "£",
}


def _character(code: Column) -> Column:
    """Code point number to text, also beyond one byte."""
    return F.decode(F.unhex(F.lpad(F.hex(code), 8, "0")), "UTF-32")


def _numeric_entities(text: Column, pattern: str, base: int) -> Column:
    found = F.array_distinct(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)))

    def decoded(acc: Column, entity: Column) -> Column:
        digits = F.regexp_extract(entity, pattern, 1)
        code = F.conv(digits, base, 10).cast("bigint")
        legal = code.between(1, 0xD7FF) | code.between(0xE000, 0x10FFFF)
        return F.when(legal, F.replace(acc, entity, _character(code))).otherwise(acc)

    return F.aggregate(found, text, decoded)


def unescape(text: Column) -> Column:
    """Character references to characters; ``&amp;`` last so nothing is decoded twice."""
    def named(col: Column) -> Column:
        plain = reduce(lambda c, e: F.replace(c, F.lit(e), F.lit(ENTITIES[e])), ENTITIES, col)
        return F.replace(plain, F.lit("&amp;"), F.lit("&"))

    decimal = _numeric_entities(text, r"&#([0-9]{1,7});", 10)
    hexed = _numeric_entities(decimal, r"&#[xX]([0-9A-Fa-f]{1,6});", 16)
    return (F.when(text.contains("&#"), named(hexed))
            .when(text.contains("&"), named(text)).otherwise(text))


def shown_html(html: Column) -> Column:
    """What is left of a page without the parts that are never rendered."""
    body = F.regexp_replace(blank_if_null(html), HEAD, "$1 ")
    return F.regexp_replace(body, HIDDEN, " ")


def visible_text(html: Column) -> Column:
    return text_of(shown_html(html))


def text_of(shown: Column) -> Column:
    flat = F.regexp_replace(F.regexp_replace(shown, INLINE_TAG, ""), ANY_TAG, " ")
    return web_collapse_spaces(unescape(flat))


def page_title(html: Column) -> Column:
    return web_collapse_spaces(unescape(F.regexp_extract(blank_if_null(html), TITLE, 1)))


def raw_links(html: Column) -> Column:
    """``href`` values of the anchors in document order, quotes and escapes removed."""
    return links_of(shown_html(html))


def links_of(shown: Column) -> Column:
    return F.transform(F.regexp_extract_all(shown, F.lit(LINK), F.lit(1)),
                       lambda h: unescape(F.btrim(h, F.lit("\"' "))))


def page_base(page_url: Column) -> Column:
    """The parts of a page URL that relative links need, computed once per page."""
    scheme = F.regexp_extract(page_url, r"^([A-Za-z][A-Za-z0-9+.\-]*:)", 1)
    origin = F.regexp_extract(page_url, r"^([A-Za-z][A-Za-z0-9+.\-]*://[^/?#]*)", 1)
    no_fragment = F.substring_index(page_url, "#", 1)
    no_query = F.substring_index(no_fragment, "?", 1)
    folder = F.regexp_extract(no_query, r"^([A-Za-z][A-Za-z0-9+.\-]*://[^/]*/(?:.*/)?)", 1)
    return F.struct(scheme.alias("scheme"), origin.alias("origin"), folder.alias("folder"),
                    no_fragment.alias("no_fragment"), no_query.alias("no_query"))


def resolve(href: Column, base: Column) -> Column:
    """A link as the browser reports it, relative forms completed from ``page_base``."""
    scheme, origin, folder = base["scheme"], base["origin"], base["folder"]
    no_fragment, no_query = base["no_fragment"], base["no_query"]
    return (F.when(href.rlike(r"^[A-Za-z][A-Za-z0-9+.\-]*:"), href)
            .when(href.startswith("//"), F.concat(scheme, href))
            .when(href.startswith("/"), F.concat(origin, href))
            .when(href.startswith("#"), F.concat(no_fragment, href))
            .when(href.startswith("?"), F.concat(no_query, href))
            .when(href == "", no_fragment)
            .when(folder != "", F.concat(folder, href))
            .otherwise(F.concat(origin, F.lit("/"), href)))
