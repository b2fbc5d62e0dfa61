"""Sender indicator."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from baitline.functions import sender_rules as sr
from baitline.functions.strings import blank_if_null
from baitline.operators.patterns import find_patterns
from baitline.plans.scale import UNBOUNDED, lookup_join
from baitline.rules import DEFAULT_RULES, RuleSet


def with_sender_domain(emails: DataFrame) -> DataFrame:
    return emails.withColumn("sender_domain", sr.sender_domain(F.col("sender_email")))


def extract_sender(mail: DataFrame, header: str = "from_header") -> DataFrame:
    """From header -> sender_email, sender_name."""
    return mail.withColumns({"sender_email": sr.header_address(F.col(header)),
                             "sender_name": sr.header_name(F.col(header))})


def brand_mismatch(emails: DataFrame, rules: RuleSet = DEFAULT_RULES,
                   key: str = "email_id") -> DataFrame:
    """One row per brand a display name claims against its domain: key, pos, title."""
    domain = sr.sender_domain(F.col("sender_email"))
    found = F.when(domain != "", sr.brand_findings(F.col("sender_name"), domain, rules))
    return (emails.select(key, domain.alias("sender_domain"), found.alias("_b"))
            .select(key, "sender_domain", F.posexplode("_b").alias("pos", "title")))


def claimed_brands(emails: DataFrame, brands: DataFrame, key: str = "email_id") -> DataFrame:
    """As :func:`brand_mismatch` for a brand table of any size: key, ord, title.

    ``brands`` has ord, brand, title, expected_domain. Each different sender is read once by an
    automaton of all brands; only claims are shuffled.
    """
    usable = brands.filter("expected_domain IS NOT NULL AND expected_domain <> ''"
                           " AND brand <> ''").select("ord", "brand", "title", "expected_domain")
    senders = emails.select(key, F.struct(
        F.lower(blank_if_null(F.col("sender_name"))).alias("name"),
        sr.sender_domain(F.col("sender_email")).alias("domain")).alias("pair"))
    pairs = senders.filter("pair.domain <> '' AND pair.name <> ''").select("pair").distinct()
    claims = (find_patterns(pairs.withColumn("name", F.col("pair.name")), usable, "pair", "name", "brand")
              .filter(~F.contains(F.col("pair.domain"), F.col("expected_domain"))).groupBy("pair")
              .agg(F.array_sort(F.collect_list(F.struct("ord", "title"))).alias("claims")))
    # A sender seen in a third of the mail is spread by the mail key.
    return (lookup_join(senders, claims, "pair", [key], how="inner", size=UNBOUNDED)
            .select(key, F.explode("claims").alias("c")).select(key, "c.ord", "c.title"))


def score_senders(emails: DataFrame, rules: RuleSet = DEFAULT_RULES) -> DataFrame:
    """Adds sender_domain, sender_score, sender_reasons. Map-only."""
    held = with_sender_domain(emails).withColumn("_brands", sr.brand_findings(
        F.col("sender_name"), F.col("sender_domain"), rules))
    domain, brands = F.col("sender_domain"), F.col("_brands")
    return held.withColumns({
        "sender_score": sr.sender_points(domain, brands, rules),
        "sender_reasons": sr.sender_reasons(domain, brands, rules),
    }).drop("_brands")
