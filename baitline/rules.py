"""The rule set a scoring run uses. Every list can be replaced by the caller."""

from __future__ import annotations

from dataclasses import dataclass, field

from baitline import fixed_values as fv


@dataclass(frozen=True)
class RuleSet:
    """Short word and extension lists that become literals in the plan.

    Feeds, policies and large brand tables are DataFrames and are passed to the
    operators separately; only lists a person would write by hand belong here.
    """

    text_keywords: list[str] = field(default_factory=lambda: list(fv.TEXT_KEYWORDS))
    url_keywords: list[str] = field(default_factory=lambda: list(fv.URL_KEYWORDS))
    shorteners: list[str] = field(default_factory=lambda: list(fv.SHORTENERS))
    uncommon_tlds: list[str] = field(default_factory=lambda: list(fv.UNCOMMON_TLDS))
    free_providers: list[str] = field(default_factory=lambda: list(fv.FREE_PROVIDERS))
    brands: list[tuple[str, str | None]] = field(default_factory=lambda: list(fv.BRANDS))
    executable_extensions: list[str] = field(
        default_factory=lambda: list(fv.EXECUTABLE_EXTENSIONS))
    macro_extensions: list[str] = field(default_factory=lambda: list(fv.MACRO_EXTENSIONS))
    archive_extensions: list[str] = field(default_factory=lambda: list(fv.ARCHIVE_EXTENSIONS))
    weights: dict[str, float] = field(default_factory=lambda: dict(fv.WEIGHTS))


DEFAULT_RULES = RuleSet()
