"""Allow and block lists."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from baitline import fixed_values as fv
from baitline.functions import sender_rules as sr
from baitline.operators.risk import INDICATORS
from baitline.plans.scale import Measured, lookup_join

# Blanked on listed mail, so that scoring it costs next to nothing.
SCORED_INPUTS = ["subject", "body_text", "urls", "attachments"]


def effective_policy(policy: DataFrame) -> DataFrame:
    """One action per domain; block wins over allow."""
    known = policy.filter("domain <> '' AND action IN ('block', 'allow')")
    return known.groupBy("domain").agg(F.max("action").alias("policy_action"))


def with_policy(emails: DataFrame, policy: DataFrame, key: str = "email_id",
                size: Measured | None = None) -> DataFrame:
    """Adds policy_domain and policy_action (null for unlisted senders)."""
    listed = effective_policy(policy).withColumnRenamed("domain", "policy_domain")
    held = emails.withColumn("policy_domain", sr.policy_domain(F.col("sender_email")))
    return lookup_join(held, listed, "policy_domain", [key], size=size)


def mute_listed(emails: DataFrame) -> DataFrame:
    """Empty the scored columns of listed mail: one pass over the input, no anti-join."""
    listed = F.col("policy_action").isNotNull()
    return emails.withColumns({
        c: F.when(~listed, F.col(c)) for c in SCORED_INPUTS if c in emails.columns})


def policy_verdict(verdicts: DataFrame) -> DataFrame:
    """Replace the verdict of listed mail by the fixed one of its list."""
    action, domain = F.col("policy_action"), F.col("policy_domain")
    block, allow = action == "block", action == "allow"

    def choose(blocked, allowed, column: str):
        return F.when(block, blocked).when(allow, allowed).otherwise(F.col(column))

    def fixed_indicators(sender: float):
        return F.struct(*[F.lit(sender if i == "sender" else 0.0).alias(i) for i in INDICATORS])

    return verdicts.withColumns({
        "risk_score": choose(F.lit(100.0), F.lit(0.0), "risk_score"),
        "risk_level": choose(F.lit("high"), F.lit("low"), "risk_level"),
        "reasons": choose(F.array(F.concat(domain, F.lit(fv.POLICY_REASONS["block"]))),
                          F.array(F.concat(domain, F.lit(fv.POLICY_REASONS["allow"]))), "reasons"),
        "indicators": choose(fixed_indicators(100.0), fixed_indicators(0.0), "indicators"),
        "recommended_action": choose(F.lit(fv.POLICY_ACTIONS["block"]),
                                     F.lit(fv.POLICY_ACTIONS["allow"]), "recommended_action"),
    })


def manual_verdict(verdicts: DataFrame) -> DataFrame:
    """The shorter answer of a check by hand: listed mail has neither indicators nor action."""
    listed = F.col("policy_action").isNotNull()
    return policy_verdict(verdicts).withColumns({
        c: F.when(~listed, F.col(c)) for c in ("indicators", "recommended_action")})
