"""URL indicator: reputation feeds, findings and scores."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from baitline import fixed_values as fv
from baitline.functions import url_rules as ur
from baitline.plans.bloom import Bloom
from baitline.plans.scale import LITERAL_ROWS, cut_lineage, lookup_join, measure
from baitline.rules import DEFAULT_RULES, RuleSet


@dataclass(frozen=True)
class Feeds:
    """Reputation feeds: short lists, or one-column tables of any size.

    A table has the column ``domain`` or ``ip``; ``None`` means the built-in list.
    """

    domains: DataFrame | list[str] | None = None
    ips: DataFrame | list[str] | None = None


def feed_table(spark: SparkSession, values: DataFrame | list[str] | None, column: str) -> DataFrame:
    """A feed as a one-column table of distinct values."""
    if isinstance(values, DataFrame):
        return values.select(column).distinct()
    if values is None:
        values = fv.DEFAULT_BAD_DOMAINS if column == "domain" else fv.DEFAULT_BAD_IPS
    return spark.createDataFrame([(v,) for v in values], f"{column} string").distinct()


def dedupe_urls(emails: DataFrame) -> DataFrame:
    return emails.withColumn("urls", ur.dedupe_array(F.col("urls")))


def explode_urls(emails: DataFrame, key: str = "email_id") -> DataFrame:
    return emails.select(key, F.posexplode("urls").alias("pos", "url"))


def url_parts(urls: DataFrame, column: str = "url") -> DataFrame:
    """Adds host, path, query and is_ip to a table of URLs."""
    part = F.col("_part")
    return (urls.withColumn("_part", F.get(ur.split_urls(F.array(column)), F.lit(0)))
            .withColumns({"host": part["host"], "path": part["path"], "query": part["query"],
                          "is_ip": part["is_ip"]}).drop("_part"))


def feed_entries(spark: SparkSession, feeds: Feeds) -> DataFrame:
    """Both feeds as one table of distinct entries, ``domain:x`` or ``ip:x``."""
    tagged = [feed_table(spark, values, column).select(
        F.concat(F.lit(f"{column}:"), column).alias("entry"))
        for values, column in ((feeds.domains, "domain"), (feeds.ips, "ip"))]
    return tagged[0].unionByName(tagged[1])


def _entries_of(part: Column) -> Column:
    """What a host would be listed as, most specific first; IP hosts have no parents."""
    chain = F.when(part["is_ip"], F.array(F.concat(F.lit("ip:"), part["host"]))).otherwise(
        F.transform(ur.parent_domains(part["host"]), lambda d: F.concat(F.lit("domain:"), d)))
    return F.when(part["host"] != "", chain).otherwise(F.array().cast("array<string>"))


def occurring_entries(candidates: DataFrame, listed: DataFrame) -> DataFrame:
    """The feed entries that occur among ``candidates`` (both have the column ``entry``).

    A Bloom filter of the feed drops what cannot be listed before anything is shuffled; of the rest
    each different entry goes to the feed once, so a host in a third of all rows is one row.
    """
    size = measure(listed)
    if size.rows <= LITERAL_ROWS:
        return listed.join(candidates, "entry", "left_semi")
    may = candidates.filter(Bloom(listed, "entry", size.rows).may_hold(F.col("entry"))).distinct()
    return may.join(listed, "entry", "left_semi")


def match_reputation(urls: DataFrame, feeds: Feeds = Feeds()) -> DataFrame:
    """URL table -> its distinct hosts found in a feed: host, matched, feed.

    Hosts are made distinct first (with partial aggregation), so a host that fills a
    third of the URL table is matched once; the longest listed parent wins.
    """
    hosts = (urls.select(F.get(ur.split_urls(F.array("url")), F.lit(0)).alias("p"))
             .select("p.host", "p.is_ip").distinct())
    chain = hosts.select("host", F.posexplode(_entries_of(
        F.struct("host", "is_ip"))).alias("pos", "entry"))
    entries = cut_lineage(occurring_entries(chain.select("entry"), feed_entries(urls.sparkSession, feeds)))
    first = (lookup_join(chain, entries, "entry", ["host"], how="inner")
             .groupBy("host").agg(F.min_by("entry", "pos").alias("entry")))
    return first.select("host", F.expr("substring(entry, locate(':', entry) + 1)").alias("matched"),
                        F.substring_index("entry", ":", 1).alias("feed"))


def _literal_feed(values: DataFrame | list[str] | None, column: str) -> list[str] | None:
    """The feed as a short list, or None when it is too long to be a literal."""
    if values is None:
        return fv.DEFAULT_BAD_DOMAINS if column == "domain" else fv.DEFAULT_BAD_IPS
    if not isinstance(values, DataFrame):
        return values if len(values) <= LITERAL_ROWS else None
    found = values.select(column).limit(LITERAL_ROWS + 1).collect()
    return [r[0] for r in found] if len(found) <= LITERAL_ROWS else None


def _touched(urls: Column) -> Column:
    """Every entry a mail's URLs may be listed as."""
    return F.array_distinct(F.flatten(F.transform(ur.split_urls(urls), _entries_of)))


def _with_hits(emails: DataFrame, listed: DataFrame) -> DataFrame:
    """Adds ``_hits``, the listed entries an email's URL hosts touch.

    Hits depend on nothing but the list of URLs, so a hash of the list is the key: it is
    never null, and mails with equal lists are looked up once. Only lists with a hit come
    back, and the wide rows are joined with these once, each key spread over many tasks.
    """
    held = emails.withColumn("_list", F.struct(
        F.xxhash64("urls").alias("a"), F.xxhash64(F.lit(1), "urls").alias("b")))
    lists = held.select("_list", "urls").groupBy("_list").agg(F.first("urls").alias("urls"))
    pairs = lists.select("_list", F.explode(_touched(F.col("urls"))).alias("entry"))
    hits = (lookup_join(pairs, listed, "entry", ["_list"], how="inner")
            .groupBy("_list").agg(F.collect_set("entry").alias("_hits")))
    held = held.withColumn("_row", F.monotonically_increasing_id())
    size = measure(hits.select(F.array_join("_hits", " ").alias("said")), "said")
    return lookup_join(held, hits, "_list", ["_row"], size=size).drop("_list", "_row")


def _in_list(values: list[str]) -> Callable[[Column], Column]:
    return lambda c: c.isin(values) if values else F.lit(False)


def _in_hits(kind: str) -> Callable[[Column], Column]:
    return lambda c: F.coalesce(
        F.array_contains(F.col("_hits"), F.concat(F.lit(f"{kind}:"), c)), F.lit(False))


def _judged(emails: DataFrame, feeds: Feeds, rules: RuleSet, key: str) -> DataFrame:
    domains, ips = _literal_feed(feeds.domains, "domain"), _literal_feed(feeds.ips, "ip")
    if domains is None or ips is None:
        # Of a long feed only what occurs in these mails matters, mostly a short list again.
        touched = emails.select(F.explode(_touched(F.col("urls"))).alias("entry"))
        listed = cut_lineage(occurring_entries(touched, feed_entries(emails.sparkSession, feeds)))
        entries = [r[0] for r in listed.limit(LITERAL_ROWS + 1).collect()]
        if len(entries) > LITERAL_ROWS:
            emails = _with_hits(emails, listed)
        else:
            domains, ips = ([e.split(":", 1)[1] for e in entries if e.startswith(f"{kind}:")]
                            for kind in ("domain", "ip"))
    if domains is None or ips is None:
        tests = _in_hits("domain"), _in_hits("ip")
    else:
        tests = _in_list(domains), _in_list(ips)
    return emails.withColumn("_judged", ur.judge_urls(F.col("urls"), *tests, rules)).drop("_hits")


def url_findings(emails: DataFrame, feeds: Feeds = Feeds(), rules: RuleSet = DEFAULT_RULES,
                 key: str = "email_id") -> DataFrame:
    """One row per URL of an email: key, pos, url, host, points, reasons."""
    judged = _judged(emails.select(key, "urls"), feeds, rules, key)
    rows = judged.select(key, F.posexplode("_judged").alias("pos", "j"))
    return rows.select(key, "pos", "j.url", "j.host", "j.points", "j.reasons")


def score_urls(emails: DataFrame, feeds: Feeds = Feeds(), rules: RuleSet = DEFAULT_RULES,
               key: str = "email_id") -> DataFrame:
    """Adds url_score, url_reasons, url_count. Map-only when the feeds are short lists."""
    judged = _judged(emails, feeds, rules, key)
    return judged.withColumns({
        "url_score": F.coalesce(ur.capped_points(F.col("_judged")), F.lit(0.0)),
        "url_reasons": F.coalesce(
            F.flatten(F.transform("_judged", lambda j: j["reasons"])),
            F.array().cast("array<string>")),
        "url_count": F.when(F.col("urls").isNull(), 0).otherwise(F.size("urls")),
    }).drop("_judged")


def score_url_table(urls: DataFrame, threshold: float = fv.URL_THRESHOLD, feeds: Feeds = Feeds(),
                    rules: RuleSet = DEFAULT_RULES) -> DataFrame:
    """Every URL on its own: adds url_score and y_pred."""
    # The URL is its own key: hits of equal URLs are equal.
    held = urls.withColumn("urls", F.array("url"))
    scored = score_urls(held, feeds, rules, key="url")
    return threshold_predict(scored.drop("urls", "url_reasons", "url_count"), threshold)


def threshold_predict(scored: DataFrame, threshold: float = fv.URL_THRESHOLD,
                      score: str = "url_score") -> DataFrame:
    return scored.withColumn("y_pred", F.when(F.col(score) >= threshold, 1).otherwise(0))
