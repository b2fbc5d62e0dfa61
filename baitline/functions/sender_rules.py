"""Sender address and display-name expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from baitline import fixed_values as fv
from baitline.functions.strings import EMAIL_ADDRESS, blank_if_null, strip, web_strip
from baitline.rules import RuleSet


def sender_domain(address: Column) -> Column:
    """Text after the last ``@``, lower-cased and stripped; empty when there is no ``@``."""
    return strip(policy_domain(address))


def policy_domain(address: Column) -> Column:
    """Like :func:`sender_domain` but unstripped: list lookups compare the raw text."""
    held = blank_if_null(address)
    return F.when(held.contains("@"), F.lower(F.substring_index(held, "@", -1))).otherwise("")


def header_address(header: Column) -> Column:
    return F.lower(F.regexp_extract(blank_if_null(header), EMAIL_ADDRESS, 0))


def header_name(header: Column) -> Column:
    """What is left of a From header without its (lower-cased) address and brackets."""
    held = blank_if_null(header)
    address = header_address(header)
    without = F.when(address != "", F.replace(held, address, F.lit(""))).otherwise(held)
    return F.btrim(F.replace(without, F.lit("<>"), F.lit("")), F.lit('" <>'))


def shown_address(raw: Column) -> Column:
    """First address in a displayed sender, else the trimmed text itself."""
    held = blank_if_null(raw)
    found = F.regexp_extract(held, EMAIL_ADDRESS, 0)
    return F.when(found != "", found).otherwise(web_strip(held))


def brand_findings(name: Column, domain: Column, rules: RuleSet) -> Column:
    """Titles of the brands a display name claims although the domain is another one."""
    low = F.lower(blank_if_null(name))
    return F.array_compact(F.array(*[
        F.when(F.contains(low, F.lit(brand)) & ~F.contains(domain, F.lit(expected)),
               F.lit(brand.title()))
        for brand, expected in rules.brands if expected
    ])) if any(expected for _, expected in rules.brands) else F.array().cast("array<string>")


def sender_points(domain: Column, brands: Column, rules: RuleSet) -> Column:
    points = fv.SENDER_POINTS
    total = (F.when(domain.rlike(r"\p{Nd}{3,}"), points["digits"]).otherwise(0)
             + F.when(domain.isin(rules.free_providers), points["free"]).otherwise(0)
             + F.size(brands) * points["brand"])
    return (F.when(domain == "", F.lit(float(points["invalid"])))
            .otherwise(F.least(F.lit(100.0), total.cast("double"))))


def sender_reasons(domain: Column, brands: Column, rules: RuleSet) -> Column:
    head, middle = fv.SENDER_REASONS["brand"]
    claims = F.transform(brands, lambda b: F.concat(F.lit(head), b, F.lit(middle), domain))
    plain = F.array_compact(F.array(
        F.when(domain.rlike(r"\p{Nd}{3,}"), F.lit(fv.SENDER_REASONS["digits"])),
        F.when(domain.isin(rules.free_providers), F.lit(fv.SENDER_REASONS["free"]))))
    return (F.when(domain == "", F.array(F.lit(fv.SENDER_REASONS["invalid"])))
            .otherwise(F.concat(plain, claims)))
