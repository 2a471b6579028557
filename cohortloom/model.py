"""Study configuration: what a cohort is made of.

These objects hold parameters only. Code lists are DataFrames (see
``operators.concepts``), since a resolved code list grows with the vocabulary.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

DISEASE = "Disease"
DRUG = "Drug"

# Rules are bits of bigint words; a cohort of more rules has more words.
RULES_PER_WORD = 62

AT_LEAST = "at_least"
EXACTLY = "exactly"


@dataclass(frozen=True)
class Criterion:
    """Events of one domain whose code lies in one codeset.

    ``start_from`` and ``start_to`` are the closed bounds of an occurrence-date
    filter; ``None`` leaves that side open.
    """

    domain: str
    codeset_id: int
    start_from: dt.date | None = None
    start_to: dt.date | None = None


@dataclass(frozen=True)
class Rule:
    """How many events of a codeset must fall in the index event's observation period.

    Counted events start on or after the first day of the period. With
    ``days_after`` set they start at most that many days after the index event,
    otherwise anywhere up to the end of the period.
    """

    domain: str
    codeset_id: int
    kind: str
    occurrences: int
    days_after: int | None = None

    def __post_init__(self):
        if self.kind not in (AT_LEAST, EXACTLY):
            raise ValueError(f"unknown rule kind {self.kind!r}")


@dataclass(frozen=True)
class CohortDefinition:
    """Entry events, inclusion rules, exit and era settings of one cohort."""

    cohort_id: int
    name: str
    cohort_type: str
    primary: tuple[Criterion, ...]
    rules: tuple[Rule, ...] = ()
    prior_days: int = 365
    post_days: int = 0
    first_only: bool = False
    exit_days: int = 1
    censor_at_death: bool = True
    era_pad: int = 0

    def __post_init__(self):
        if self.cohort_type not in (DISEASE, DRUG):
            raise ValueError(f"unknown cohort type {self.cohort_type!r}")
        if self.exit_days < 0:
            raise ValueError("an exit before the index date would drop the event")


def word_names(name: str, words: int) -> list[str]:
    """Columns of a mask: the first has the plain name, further words are numbered."""
    return [name if w == 0 else f"{name}_{w}" for w in range(words)]


def rule_words(definitions) -> int:
    """Words that the masks of these cohorts' rules take, at least one."""
    return max([1, *(-(-len(d.rules) // RULES_PER_WORD) for d in definitions)])


def cohort_ids(definitions, cohort_type: str) -> list[int]:
    return [d.cohort_id for d in definitions if d.cohort_type == cohort_type]
