"""The main job: emails in, verdicts out."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from baitline import fixed_values as fv
from baitline.operators.attachments import score_attachments
from baitline.operators.datasets import build_url_testset
from baitline.operators.intake import normalize_emails
from baitline.operators.metrics import binary_metrics
from baitline.operators.policy import mute_listed, policy_verdict, with_policy
from baitline.operators.risk import assemble_verdict
from baitline.operators.senders import score_senders
from baitline.operators.text import clean_emails, score_text
from baitline.operators.urls import Feeds, dedupe_urls, score_url_table, score_urls
from baitline.rules import DEFAULT_RULES, RuleSet

VERDICT = ["risk_score", "risk_level", "reasons", "indicators", "recommended_action"]


def score_emails(emails: DataFrame, feeds: Feeds = Feeds(), policy: DataFrame | None = None,
                 rules: RuleSet = DEFAULT_RULES, aggregation: str = "mean",
                 subject_chars: int | None = None, body_chars: int | None = None,
                 max_reasons: int | None = None,
                 keep: tuple[str, ...] = (), key: str = "email_id") -> DataFrame:
    """Validated emails -> one verdict row each.

    Everything happens on the row: with list-sized feeds and policies the job has no
    shuffle at all, reads its input once and writes as it reads. Longer feeds and
    policies add joins on their own keys only (see ``plans.scale``). ``keep`` names
    input columns to carry along unchanged. Whole texts and all reasons count unless a limit
    is given.
    """
    held = emails.withColumn("_kept", F.struct(*[F.col(c) for c in keep])) if keep else emails
    if policy is not None:
        held = mute_listed(with_policy(held, policy, key))
    held = dedupe_urls(clean_emails(normalize_emails(held), subject_chars, body_chars))
    held = score_text(held, aggregation, rules)
    held = score_urls(held, feeds, rules, key)
    held = score_senders(held, rules)
    held = assemble_verdict(score_attachments(held, rules), rules, max_reasons)
    if policy is not None:
        held = policy_verdict(held)
    return held.select(key, *[F.col(f"_kept.{c}").alias(c) for c in keep], *VERDICT)


def url_benchmark(lines: DataFrame, n_bad: int, n_good: int,
                  threshold: float = fv.URL_THRESHOLD, feeds: Feeds = Feeds()) -> DataFrame:
    """URL lines -> test set -> scores -> metrics, as one lazy plan."""
    return binary_metrics(score_url_table(
        build_url_testset(lines, n_bad, n_good), threshold, feeds))
