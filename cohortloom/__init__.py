"""Cohort and rate analytics over patient-level event tables, as Spark DataFrame plans."""

from cohortloom.model import CohortDefinition, Criterion, Rule

__all__ = ["CohortDefinition", "Criterion", "Rule"]
