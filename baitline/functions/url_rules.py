"""Splitting URLs and judging them, as array expressions.

The steps are separate ``transform`` calls on purpose: a lambda body has no common
subexpression elimination, so each intermediate value is put in a struct once and read
from there instead of running its regular expression again at every use.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from baitline import fixed_values as fv
from baitline.functions.strings import any_contained, strip
from baitline.rules import RuleSet

# Generic URI syntax: scheme, authority, path, query; the fragment is left over.
URI = r"^(?:([A-Za-z][A-Za-z0-9+.\-]*):)?(?://([^/?#]*))?([^?#]*)(?:\?([^#]*))?"
DROPPED_CHARACTERS = r"^[\x00-\x20]+|[\t\r\n]"
PARAM_SCHEMES = ["", "ftp", "hdl", "prospero", "http", "https", "shttp", "rtsp", "rtsps",
                 "sip", "sips", "mms", "sftp", "tel"]

_OCTET = r"(?:25[0-5]|2[0-4][0-9]|1[0-9]{2}|[1-9]?[0-9])"
_V4 = rf"{_OCTET}(?:\.{_OCTET}){{3}}"
IPV4 = rf"^{_V4}$"


def _ipv6() -> str:
    """All legal spellings: full, or with one ``::`` standing for one or more groups."""
    group = "[0-9A-Fa-f]{1,4}"
    tail = f"(?:{group}:{group}|{_V4})"
    forms = [f"(?:{group}:){{6}}{tail}", f"::(?:{group}:){{5}}{tail}"]
    for after in range(4, -1, -1):
        before = f"(?:(?:{group}:){{0,{4 - after}}}{group})?"
        forms.append(f"{before}::(?:{group}:){{{after}}}{tail}")
    forms.append(f"(?:(?:{group}:){{0,5}}{group})?::{group}")
    forms.append(f"(?:(?:{group}:){{0,6}}{group})?::")
    return "(?:" + "|".join(forms) + ")(?:%[^%\\]]+)?"


BRACKETED = rf"^[^\[]*\[({_ipv6()}|[vV][0-9A-Fa-f]+\.[^\]]+)\]"


def dedupe_array(urls: Column) -> Column:
    """Stripped, non-empty, first occurrence kept in order."""
    stripped = F.transform(urls, lambda u: strip(F.coalesce(u, F.lit(""))))
    return F.array_distinct(F.filter(stripped, lambda u: u != ""))


def split_urls(urls: Column) -> Column:
    """array<string> -> array<struct<url, host, path, query, is_ip>>."""
    cleaned = F.transform(urls, lambda u: F.struct(
        u.alias("url"), F.regexp_replace(u, DROPPED_CHARACTERS, "").alias("uri")))
    parts = F.transform(cleaned, lambda s: F.struct(
        s["url"].alias("url"),
        F.lower(F.regexp_extract(s["uri"], URI, 1)).alias("scheme"),
        F.substring_index(F.regexp_extract(s["uri"], URI, 2), "@", -1).alias("place"),
        F.regexp_extract(s["uri"], URI, 3).alias("path"),
        F.regexp_extract(s["uri"], URI, 4).alias("query")))

    def host(s: Column) -> Column:
        bracket = s["place"].contains("[") | s["place"].contains("]")
        return F.lower(F.when(bracket, F.regexp_extract(s["place"], BRACKETED, 1))
                       .otherwise(F.substring_index(s["place"], ":", 1)))

    def path(s: Column) -> Column:
        # Parameters belong to the last segment and are not part of the path.
        cut = F.regexp_replace(s["path"], r";[^/]*$", "")
        return F.when(s["scheme"].isin(PARAM_SCHEMES) & s["path"].contains(";"), cut).otherwise(
            s["path"])

    hosts = F.transform(parts, lambda s: F.struct(
        s["url"].alias("url"), host(s).alias("host"), path(s).alias("path"),
        s["query"].alias("query"), s["place"].contains("[").alias("in_brackets")))
    return F.transform(hosts, lambda s: F.struct(
        s["url"].alias("url"), s["host"].alias("host"), s["path"].alias("path"),
        s["query"].alias("query"),
        (s["host"].rlike(IPV4) | (s["in_brackets"] & s["host"].contains(":")
                                  & ~s["host"].startswith("v"))).alias("is_ip")))


def parent_domains(host: Column) -> Column:
    """``a.b.c`` -> [a.b.c, b.c]; longest first, never the bare last label."""
    labels = F.size(F.split(host, r"\."))
    chain = F.transform(F.sequence(labels, F.lit(2), F.lit(-1)),
                        lambda k: F.call_function("substring_index", host, F.lit("."), -k))
    return F.when(labels > 1, chain).otherwise(F.array().cast("array<string>"))


def judge_urls(urls: Column, bad_domain: Callable[[Column], Column],
               bad_ip: Callable[[Column], Column], rules: RuleSet) -> Column:
    """array<string> -> array<struct<url, host, points, reasons>>, in input order.

    ``bad_domain`` and ``bad_ip`` turn a host column into a boolean column; how the
    feed is held (literal set or per-row hits from a join) is the caller's business.
    """
    def parents_in_feed(s: Column) -> Column:
        hits = F.filter(parent_domains(s["host"]), bad_domain)
        return F.when(~s["is_ip"], F.get(hits, F.lit(0)))

    known = F.transform(split_urls(urls), lambda s: F.struct(
        s["url"].alias("url"), s["host"].alias("host"), s["is_ip"].alias("is_ip"),
        F.lower(F.concat_ws(" ", s["path"], s["query"])).alias("tail"),
        F.size(F.split(s["host"], r"\.")).alias("labels"),
        parents_in_feed(s).alias("feed_domain")))

    def finding(kind: str, test: Column, detail: Column | None = None) -> Column:
        text = F.lit(fv.URL_REASONS[kind])
        return F.when(test, F.struct(
            F.lit(fv.URL_POINTS[kind]).alias("points"),
            (text if detail is None else F.concat(text, detail)).alias("reason")))

    def findings(s: Column) -> Column:
        url, host, is_ip = s["url"], s["host"], s["is_ip"]
        last_label = F.substring_index(host, ".", -1)
        wording = any_contained(s["tail"], rules.url_keywords) | any_contained(
            host, rules.url_keywords)
        found = F.array(
            finding("bad_ip", is_ip & bad_ip(host), host),
            finding("bad_domain", s["feed_domain"].isNotNull(), s["feed_domain"]),
            finding("ip_host", is_ip, host),
            finding("subdomains", s["labels"] - 2 >= fv.URL_SUBDOMAINS_FROM, host),
            finding("punycode", F.contains(host, F.lit("xn--")), host),
            finding("shortener", host.isin(rules.shorteners), host),
            finding("keyword", wording, url),
            finding("tld", (s["labels"] > 1) & last_label.isin(rules.uncommon_tlds), last_label),
            finding("long", F.length(url) > fv.URL_LONG_OVER),
        )
        nothing_else = F.array(finding("malformed", F.lit(True), url))
        return F.when(host == "", nothing_else).otherwise(F.array_compact(found))

    judged = F.transform(known, lambda s: F.struct(
        s["url"].alias("url"), s["host"].alias("host"), findings(s).alias("found")))
    return F.transform(judged, lambda s: F.struct(
        s["url"].alias("url"), s["host"].alias("host"),
        F.aggregate(s["found"], F.lit(0), lambda acc, f: acc + f["points"]).alias("points"),
        F.transform(s["found"], lambda f: f["reason"]).alias("reasons")))


def capped_points(judged: Column) -> Column:
    """Sum of points, at most 100; 0 for an empty array."""
    total = F.aggregate(judged, F.lit(0), lambda acc, j: acc + j["points"])
    return F.least(F.lit(100.0), total.cast("double"))
