"""One query per operator over the example study; each takes a session and a folder of tables."""

from __future__ import annotations

import datetime as dt
import json
from collections.abc import Callable
from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession, functions as F

from cohortloom.functions.dates import floor_start
from cohortloom.model import AT_LEAST, DISEASE, DRUG, EXACTLY, CohortDefinition, Criterion, Rule
from cohortloom.operators import impact, population as pop, rates, views
from cohortloom.operators.concepts import concept_items, resolve_concept_sets
from cohortloom.operators.counts import cohort_counts
from cohortloom.operators.disclosure import mask_small_cells
from cohortloom.operators.dose import dose_summary
from cohortloom.operators.eras import collapse_eras
from cohortloom.operators.events import (
    CONDITION, DRUG_SOURCE, OBSERVATION, PROCEDURE, death_events, domain_events,
)
from cohortloom.operators.exits import first_exit, offset_exit
from cohortloom.operators.margins import add_margins
from cohortloom.operators.profile import diagnosis_profile
from cohortloom.operators.rules import meets_all_rules
from cohortloom.plans import retail_study as study
from cohortloom.plans.cohorts import Codes, build_cohorts, qualified_events
from cohortloom.plans.file_study import study_of_documents
from cohortloom.session import local_frame
from cohortloom.sources.definitions import definition_items, parse_definitions
from cohortloom.sources.retail import BRAND_BASE, PART_BASE, retail_tables

NARROW_START, NARROW_END = dt.date(1997, 3, 1), dt.date(2000, 10, 31)
FLOOR = dt.date(1997, 1, 1)
SPARSE_PAIRS = ((1, 10), (2, 11), (3, 16))
MINIMUM_CELL = 5
MULTI_DOMAIN = CohortDefinition(
    5,
    "several domains",
    DISEASE,
    tuple(Criterion(domain, 1, start_from=dt.date(1997, 1, 1)) for domain in (CONDITION, OBSERVATION, PROCEDURE)),
    first_only=True,
)

TWICE_INDICATED = CohortDefinition(
    study.ANY_STRENGTH,
    "indicated twice",
    DRUG,
    (Criterion(DRUG_SOURCE, study.ANY_STRENGTH),),
    (Rule(CONDITION, study.INDICATIONS, AT_LEAST, 2, days_after=30), Rule(CONDITION, 1, EXACTLY, 1, days_after=0)),
)


@dataclass
class Study:
    """The example study's frames, each built when first asked for. Nothing is run here."""

    spark: SparkSession
    root: str
    start: dt.date = study.WINDOW_START
    end: dt.date = study.WINDOW_END

    @cached_property
    def tables(self):
        return retail_tables(self.spark, self.root)

    @cached_property
    def codes(self) -> Codes:
        return study.codes(self.spark, self.tables)

    def qualified(self, definitions=study.DEFINITIONS) -> DataFrame:
        return qualified_events(self.tables, self.codes, definitions)

    def cohorts(self, definitions=study.DEFINITIONS) -> DataFrame:
        return build_cohorts(self.tables, self.codes, definitions)

    @cached_property
    def population(self) -> DataFrame:
        return pop.observed_population(
            self.tables["person"], self.tables["observation_period"], self.start.year, self.end.year
        )

    def prepared(self, definitions=study.DEFINITIONS) -> DataFrame:
        return pop.attach_demographics(self.cohorts(definitions), self.population)

    def in_window(self, definitions=study.DEFINITIONS) -> DataFrame:
        return rates.within_months(self.prepared(definitions), self.start, self.end)

    def denominators(self, grain: str) -> DataFrame:
        if grain == rates.YEAR:
            return pop.population_by_year(self.population, self.start.year, self.end.year)
        return pop.population_by_month(self.population, self.start, self.end)

    def profiles(self, grain: str, definitions=study.DEFINITIONS) -> rates.Profiles:
        return rates.stratum_profiles(
            self.in_window(definitions), [d.cohort_id for d in definitions], grain
        )

    @property
    def registry(self) -> DataFrame:
        return rates.registry_frame(self.spark, [(d.cohort_id, d.name) for d in study.DEFINITIONS])

    def combined(self, grain: str) -> DataFrame:
        return rates.combined_rates(
            self.denominators(grain), self.profiles(grain), study.PAIRS, self.registry, study.DATABASE
        )

    def catalogue(self) -> DataFrame:
        return impact.rule_catalogue(self.spark, study.DEFINITIONS)


def _one_set(codeset: int, include: list[int], exclude: list[int]):
    def run(spark: SparkSession, root: str) -> DataFrame:
        tables = retail_tables(spark, root)
        items = concept_items(spark, codeset, include, exclude)
        return resolve_concept_sets(tables["concept"], tables["concept_ancestor"], items)

    return run


def codesets_union(spark, root):
    return Study(spark, root).codes.concepts


def _events(domain: str):
    def run(spark: SparkSession, root: str) -> DataFrame:
        s = Study(spark, root)
        wanted = s.codes.sources if domain == DRUG_SOURCE else s.codes.concepts
        return domain_events(s.tables, domain, wanted).drop("domain")

    return run


def multi_domain_events(spark, root):
    s = Study(spark, root)
    wanted = s.codes.concepts.where(F.col("codeset_id") == 1)
    found = [domain_events(s.tables, d, wanted) for d in (CONDITION, OBSERVATION, PROCEDURE)]
    return found[0].unionByName(found[1]).unionByName(found[2]).drop("codeset_id")


def death_events_query(spark, root):
    return death_events(Study(spark, root).tables["death"])


def _per_day(events: DataFrame, *more: str) -> DataFrame:
    """Index events, of which there is one row a cohort, person, day and period."""
    return events.select("cohort_id", "person_id", "start_date", "op_start_date", "op_end_date", *more, "n_events")


def primary_events_lookback(spark, root):
    return _per_day(Study(spark, root).qualified())


def _meeting(bit: int):
    def run(spark: SparkSession, root: str) -> DataFrame:
        events = Study(spark, root).qualified(study.DRUGS)
        return _per_day(events.where(F.col("rule_mask").bitwiseAND(F.lit(1 << bit).cast("bigint")) != 0))

    return run


def rules_counting_occurrences(spark, root):
    return _per_day(Study(spark, root).qualified((TWICE_INDICATED,)), "rule_mask")


def inclusion_mask(spark, root):
    return _per_day(Study(spark, root).qualified(), "rule_mask")


def included_events(spark, root):
    return _per_day(meets_all_rules(Study(spark, root).qualified()))


def date_offset_exit(spark, root):
    events = meets_all_rules(Study(spark, root).qualified())
    return events.select(
        "cohort_id", "person_id", "start_date", "op_end_date", offset_exit(1).alias("end_date")
    ).distinct()


def death_censor(spark, root):
    events = meets_all_rules(Study(spark, root).qualified())
    return (
        events.where("censor_date IS NOT NULL")
        .select("cohort_id", "person_id", "start_date", "op_end_date", "censor_date")
        .distinct()
    )


def first_exit_query(spark, root):
    events = meets_all_rules(Study(spark, root).qualified())
    return events.select(
        "cohort_id", "person_id", "start_date",
        first_exit(F.col("exit_days"), F.col("censored")).alias("exit_date"),
    ).distinct()


def _drug_eras(pad: int):
    """Eras of a person's exposures to the study's drug, of whatever strength."""

    def run(spark: SparkSession, root: str) -> DataFrame:
        s = Study(spark, root)
        every = s.codes.sources.where(F.col("codeset_id") == study.ANY_STRENGTH)
        exposures = domain_events(s.tables, DRUG_SOURCE, every).where("end_date >= start_date")
        return collapse_eras(exposures, ["person_id"], "start_date", "end_date", pad)

    return run


def _cohorts(definitions):
    return lambda spark, root: Study(spark, root).cohorts(definitions)


def cohort_counts_query(spark, root):
    s = Study(spark, root)
    return cohort_counts(s.cohorts(), s.registry)


def observed_population(spark, root):
    return Study(spark, root).population


def observed_population_narrow(spark, root):
    return Study(spark, root, NARROW_START, NARROW_END).population


def cohort_demographics(spark, root):
    return pop.expand_periods(Study(spark, root).prepared())


def age_groups(spark, root):
    prepared = Study(spark, root).prepared(study.DISEASES)
    return prepared.groupBy("age", "age_band", "gender").agg(F.count_distinct("subject_id").alias("subjects"))


def _population(grain: str, start=study.WINDOW_START, end=study.WINDOW_END):
    return lambda spark, root: Study(spark, root, start, end).denominators(grain)


def dataset_counts(spark, root):
    return pop.dataset_counts(Study(spark, root).population)


def _rates(analysis: str, grain: str):
    """One analysis on its own; only the cohorts it needs are built."""
    of_disease, of_drug = rates.ANALYSES[analysis]

    def run(spark: SparkSession, root: str) -> DataFrame:
        s = Study(spark, root)
        definitions = study.DISEASES if of_drug is None else study.DRUGS if of_disease is None else study.DEFINITIONS
        population = None if of_disease and of_drug else s.denominators(grain)
        found = rates.compute_rates(population, s.profiles(grain, definitions), study.PAIRS, [analysis])
        absent = [name for name, kind in (("diseaseId", of_disease), ("drugId", of_drug)) if kind is None]
        return found.drop("analysis", *absent)

    return run


def _combined(grain: str, start=study.WINDOW_START, end=study.WINDOW_END):
    return lambda spark, root: Study(spark, root, start, end).combined(grain)


def _margins(grain: str):
    return lambda spark, root: add_margins(Study(spark, root).combined(grain))


def _masked(grain: str, margins: bool):
    def run(spark: SparkSession, root: str) -> DataFrame:
        combined = Study(spark, root).combined(grain)
        return mask_small_cells(add_margins(combined) if margins else combined, MINIMUM_CELL)

    return run


def _dose(fanout: bool):
    return lambda spark, root: dose_summary(
        Study(spark, root).in_window(study.DRUGS), study.ANY_STRENGTH, study.STRENGTHS, fanout
    )


def _profile(restrict_to_drug: bool):
    return lambda spark, root: diagnosis_profile(
        Study(spark, root).in_window(),
        study.ANY_STRENGTH,
        [d.cohort_id for d in study.DISEASES],
        restrict_to_drug,
    )


def rates_sparse_pairs(spark, root):
    """Pair analyses of a few listed pairs among cohorts that make up many more."""
    s = Study(spark, root)
    paired = [a for a, kinds in rates.ANALYSES.items() if None not in kinds]
    return rates.compute_rates(None, s.profiles(rates.YEAR), SPARSE_PAIRS, paired)


def rates_floor_year(spark, root):
    """Rates whose yearly window begins before the earliest day allowed."""
    start = floor_start(study.WINDOW_START, FLOOR)
    return Study(spark, root, start, study.WINDOW_END).combined(rates.YEAR)


def best_events(spark, root):
    return impact.best_events(Study(spark, root).qualified(study.DRUGS))


MODES = (impact.ALL_EVENTS, impact.BEST_EVENT)


def _both_modes(summary: Callable[[Study, DataFrame, int], DataFrame]):
    """A summary of all events and one of best events, from one set of index events."""

    def run(spark: SparkSession, root: str) -> DataFrame:
        s = Study(spark, root)
        qualified = s.qualified(study.DRUGS)
        every, best = (summary(s, impact.inclusion_result(qualified, mode), mode) for mode in MODES)
        return every.unionByName(best)

    return run


inclusion_result = _both_modes(lambda s, result, mode: result)
inclusion_stats = _both_modes(lambda s, result, mode: impact.inclusion_stats(result, s.catalogue(), mode))
attrition_summary = _both_modes(lambda s, result, mode: impact.attrition_summary(result, s.catalogue(), mode))


def rates_view_year(spark, root):
    return views.rates_view(
        add_margins(Study(spark, root).combined(rates.YEAR)),
        database=study.DATABASE, analysis=rates.INCIDENCE_OF_DISEASE, disease="disease one", drug=rates.ABSENT,
        age_groups=["<18", "25-34", ">=65", "All"], genders=["Female", "All"], after=1996,
    ).withColumnRenamed("Incidence(%)", "incidence_percent")


def rates_view_month(spark, root):
    return views.rates_view(
        add_margins(Study(spark, root).combined(rates.MONTH)),
        database=study.DATABASE, analysis=rates.PREVALENCE_OF_DRUG_IN_DISEASE, disease="indications", drug="drug",
        after=dt.date(1996, 12, 31),
    ).withColumnRenamed("Prevalence(%)", "prevalence_percent")


def available_choices(spark, root):
    results = Study(spark, root).combined(rates.YEAR)
    diseases = views.available_diseases(results, rates.PREVALENCE_OF_DISEASE, after=1996)
    drugs = views.available_drugs(results, rates.PREVALENCE_OF_DRUG_IN_DISEASE, "disease one", after=1996)
    return diseases.select(F.lit("disease").alias("kind"), F.col("diseaseCohortName").alias("name")).unionByName(
        drugs.select(F.lit("drug").alias("kind"), F.col("drugCohortName").alias("name"))
    )


def definition_documents(spark: SparkSession, root: str) -> DataFrame:
    """A definition document per part: the part and its brand, without the brand for large parts."""
    part = spark.read.schema("p_partkey bigint, p_brand string, p_size int").parquet(f"{root}/part.parquet")
    brand = BRAND_BASE + F.substring_index("p_brand", "#", -1).cast("bigint")

    def item(concept, **flags: bool):
        named = [F.lit(value).alias(name) for name, value in flags.items()]
        return F.to_json(F.struct(F.struct(concept.alias("CONCEPT_ID")).alias("concept"), *named))

    own = item(PART_BASE + F.col("p_partkey"), includeDescendants=True)
    plain = item(brand)
    without = F.when(F.col("p_size") > 25, item(brand, isExcluded=True))
    entries = F.concat_ws(", ", own, plain, without)
    text = F.concat(
        F.lit('{"ConceptSets": [{"id": 7, "name": "'), F.col("p_brand"),
        F.lit('", "expression": {"items": ['), entries, F.lit("]}}]}"),
    )
    return part.select(F.col("p_partkey").alias("definition_id"), text.alias("document"))


def definition_concept_sets(spark, root):
    tables = retail_tables(spark, root)
    definitions = parse_definitions(definition_documents(spark, root), "document")
    return resolve_concept_sets(tables["concept"], tables["concept_ancestor"], definition_items(definitions))


# Two cohorts as documents. The first enters by three domains from a day on, once per person, until
# death; the second by drug concepts, for ten days.
WRITTEN_STUDY = [
    (
        21,
        "brands one and two",
        DISEASE,
        {
            "ConceptSets": [
                {
                    "id": 1000,
                    "name": "brands",
                    "expression": {
                        "items": [
                            {"concept": {"CONCEPT_ID": BRAND_BASE + 1}, "includeDescendants": True},
                            {"concept": {"CONCEPT_ID": BRAND_BASE + 2}, "includeDescendants": True},
                            {"concept": {"CONCEPT_ID": PART_BASE + 1}, "includeDescendants": True, "isExcluded": True},
                        ]
                    },
                }
            ],
            "PrimaryCriteria": {
                "CriteriaList": [
                    {
                        domain: {
                            "CodesetId": 1000,
                            "OccurrenceStartDate": {"Value": "1997-01-01", "Extent": "2001-12-31", "Op": "gte"},
                        }
                    }
                    for domain in ("ConditionOccurrence", "Observation", "ProcedureOccurrence")
                ],
                "ObservationWindow": {"PriorDays": 365, "PostDays": 0},
                "PrimaryCriteriaLimit": {"Type": "All"},
            },
            "QualifiedLimit": {"Type": "First"},
            "ExpressionLimit": {"Type": "All"},
            "InclusionRules": [],
            "EndStrategy": {"DateOffset": {"DateField": "StartDate", "Offset": 1}},
            "CensoringCriteria": [{"Death": {}}],
            "CollapseSettings": {"CollapseType": "ERA", "EraPad": 0},
            "CensorWindow": {},
            "cdmVersionRange": ">=5.0.0",
        },
    ),
    (
        22,
        "brand three",
        DRUG,
        {
            "ConceptSets": [
                {
                    "id": 0,
                    "name": "brand",
                    "expression": {"items": [{"concept": {"CONCEPT_ID": BRAND_BASE + 3}, "includeDescendants": True}]},
                }
            ],
            "PrimaryCriteria": {
                "CriteriaList": [{"DrugExposure": {"CodesetId": 0}}],
                "ObservationWindow": {"PriorDays": 180, "PostDays": 30},
                "PrimaryCriteriaLimit": {"Type": "All"},
            },
            "QualifiedLimit": {"Type": "All"},
            "ExpressionLimit": {"Type": "All"},
            "InclusionRules": [],
            "EndStrategy": {"DateOffset": {"DateField": "StartDate", "Offset": 10}},
            "CensoringCriteria": [],
            "CollapseSettings": {"CollapseType": "ERA", "EraPad": 0},
            "CensorWindow": {},
        },
    ),
]


def cohort_from_definitions(spark, root):
    """Cohorts from document text: concept sets, criteria, windows, limits, exits and censoring."""
    tables = retail_tables(spark, root)
    rows = [(i, name, kind, json.dumps(document)) for i, name, kind, document in WRITTEN_STUDY]
    documents = local_frame(spark, rows, "definition_id int, name string, cohort_type string, text string")
    codes, definitions = study_of_documents(tables, parse_definitions(documents, "text"))
    return build_cohorts(tables, codes, definitions)


def _named_by_grain(name: str, make: Callable[[str], Callable]) -> dict[str, Callable]:
    return {f"{name}_{grain}": make(grain) for grain in (rates.YEAR, rates.MONTH)}


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "concept_set_descendants": _one_set(2, [103], []),
    "concept_set_excluded": _one_set(1, [101, 102], [10001]),
    "codesets_union": codesets_union,
    "definition_concept_sets": definition_concept_sets,
    "cohort_from_definitions": cohort_from_definitions,
    "condition_events": _events(CONDITION),
    "source_code_events": _events(DRUG_SOURCE),
    "multi_domain_events": multi_domain_events,
    "death_events": death_events_query,
    "primary_events_lookback": primary_events_lookback,
    "rule_at_least_one": _meeting(0),
    "rule_exactly_zero": _meeting(1),
    "rules_counting_occurrences": rules_counting_occurrences,
    "inclusion_mask": inclusion_mask,
    "included_events": included_events,
    "date_offset_exit": date_offset_exit,
    "death_censor": death_censor,
    "first_exit": first_exit_query,
    "era_collapse": _drug_eras(0),
    "era_collapse_padded": _drug_eras(30),
    "cohort_disease": _cohorts(study.DISEASES),
    "cohort_drug": _cohorts(study.DRUGS),
    "cohort_all": _cohorts(study.DEFINITIONS),
    "cohort_first_of_several_domains": _cohorts((MULTI_DOMAIN,)),
    "cohort_counts": cohort_counts_query,
    "observed_population": observed_population,
    "observed_population_narrow": observed_population_narrow,
    "cohort_demographics": cohort_demographics,
    "age_groups": age_groups,
    "population_by_year": _population(rates.YEAR),
    "population_by_month": _population(rates.MONTH),
    "population_by_month_narrow": _population(rates.MONTH, NARROW_START, NARROW_END),
    "dataset_counts": dataset_counts,
    **_named_by_grain("disease_incidence", lambda g: _rates(rates.INCIDENCE_OF_DISEASE, g)),
    **_named_by_grain("disease_prevalence", lambda g: _rates(rates.PREVALENCE_OF_DISEASE, g)),
    **_named_by_grain("drug_incidence", lambda g: _rates(rates.INCIDENCE_OF_DRUG, g)),
    **_named_by_grain("drug_prevalence", lambda g: _rates(rates.PREVALENCE_OF_DRUG, g)),
    **_named_by_grain("drug_in_disease_incidence", lambda g: _rates(rates.INCIDENCE_OF_DRUG_IN_DISEASE, g)),
    **_named_by_grain("drug_in_disease_prevalence", lambda g: _rates(rates.PREVALENCE_OF_DRUG_IN_DISEASE, g)),
    **_named_by_grain("rates_combined", _combined),
    "rates_combined_year_narrow": _combined(rates.YEAR, NARROW_START, NARROW_END),
    **_named_by_grain("rates_margins", _margins),
    "mask_small_cells": _masked(rates.YEAR, margins=False),
    **_named_by_grain("masked_margins", lambda g: _masked(g, margins=True)),
    "rates_sparse_pairs": rates_sparse_pairs,
    "rates_floor_year": rates_floor_year,
    "dose_summary": _dose(fanout=True),
    "dose_summary_per_person": _dose(fanout=False),
    "diagnosis_profile": _profile(restrict_to_drug=False),
    "diagnosis_profile_in_drug": _profile(restrict_to_drug=True),
    "best_events": best_events,
    "inclusion_result": inclusion_result,
    "inclusion_stats": inclusion_stats,
    "attrition_summary": attrition_summary,
    "rates_view_year": rates_view_year,
    "rates_view_month": rates_view_month,
    "available_choices": available_choices,
}
