"""Queries over what studies store: each writes to a folder that the cluster shares, and reads it back.

What a query stores lies in a new folder, so runs don't meet. The study that is stored is the example study, or
one of nineteen cohorts and eighty-four pairs that are kept in files.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Sequence
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession, functions as F

from cohortloom.model import DISEASE, CohortDefinition
from cohortloom.operators import rates, views
from cohortloom.operators.concepts import source_codes
from cohortloom.operators.events import DRUG_SOURCE, domain_events
from cohortloom.plans import patch_study, retail_study as study
from cohortloom.plans.cohorts import build_cohorts
from cohortloom.plans.file_study import run_file_study
from cohortloom.plans.study import DoseSettings, StudyParameters, StudyPaths, run_study
from cohortloom.schemas import (
    COHORT_COUNTS, DATASET_COUNTS, DIAGNOSIS_PROFILE, INCLUSION_STATS, PAIRS, RATES_MONTH, RATES_YEAR, REGISTRY, dose,
    masked,
)
from cohortloom.session import local_frame, shared_folder
from cohortloom.sources import store
from cohortloom.sources.definitions import write_definitions
from cohortloom.sources.retail import BRAND_BASE, retail_tables
from cohortloom.sources.settings import read_pairs, read_registry

MINIMUM_CELL = 5
LONGER_STAY = 30
#: Products of a list given by hand.
LISTED_PRODUCTS = tuple(str(i) for i in range(5, 200, 13))

DOSE = dose([s.label for s in study.STRENGTHS])


def longer(definitions: Sequence[CohortDefinition], ids: Sequence[int]) -> list[CohortDefinition]:
    """The definitions with a longer stay for some cohorts."""
    return [replace(d, exit_days=LONGER_STAY) if d.cohort_id in ids else d for d in definitions]


def _parameters(**changes) -> StudyParameters:
    windows = dict(
        year_start=study.WINDOW_START, year_end=study.WINDOW_END, month_start=study.WINDOW_START,
        month_end=study.WINDOW_END, floor_date=study.WINDOW_START,
    )
    return StudyParameters(database=study.DATABASE, **{**windows, **changes})


def _run(
    spark: SparkSession, root: str, folder: str, definitions: Sequence[CohortDefinition] = study.DEFINITIONS, **changes
) -> StudyPaths:
    """The example study, stored in a folder; the folder may hold an earlier run of it."""
    tables = retail_tables(spark, root)
    strengths = DoseSettings(study.ANY_STRENGTH, "drug", study.STRENGTHS)
    return run_study(
        spark, tables, study.codes(spark, tables), definitions, study.PAIRS, folder, _parameters(**changes), strengths
    )


def stored_cohorts_replaced(spark: SparkSession, root: str) -> DataFrame:
    """A table of all cohorts in which two are replaced by others of a longer stay and one is emptied."""
    tables, path = retail_tables(spark, root), shared_folder(spark, "cohorts")
    codes = study.codes(spark, tables)
    store.create_cohort_table(spark, path)
    store.write_cohorts(build_cohorts(tables, codes, study.DEFINITIONS), path, [d.cohort_id for d in study.DEFINITIONS])
    changed = [1, study.ANY_STRENGTH]
    others = build_cohorts(tables, codes, [d for d in longer(study.DEFINITIONS, changed) if d.cohort_id in changed])
    store.write_cohorts(others, path, [*changed, 2])
    return store.read_cohorts(spark, path)


def stored_cohort_by_id(spark: SparkSession, root: str) -> DataFrame:
    """One stored cohort, of which alone the files are read."""
    tables, path = retail_tables(spark, root), shared_folder(spark, "cohorts")
    cohorts = build_cohorts(tables, study.codes(spark, tables), study.DISEASES)
    store.write_cohorts(cohorts, path, [d.cohort_id for d in study.DISEASES])
    return store.read_cohorts(spark, path, [study.INDICATIONS])


def _again(spark: SparkSession, root: str, **changes) -> StudyPaths:
    """The example study taken up in a folder where some cohorts were defined otherwise."""
    folder = shared_folder(spark, "study")
    _run(spark, root, folder, longer(study.DEFINITIONS, [1, study.ANY_STRENGTH]), **changes)
    return _run(spark, root, folder, **changes)


def stored_study_resumed(spark: SparkSession, root: str) -> DataFrame:
    """Yearly rates of a study that is run again after two of its definitions have changed.

    Only these cohorts are built again; rates are made anew, as the rows below them have changed.
    """
    paths = _again(spark, root)
    return store.read_csv(spark, paths["by_year"], RATES_YEAR)


def stored_rates_reused(spark: SparkSession, root: str) -> DataFrame:
    """Monthly rates of a study that is run a second time from what it has stored, without its tables."""
    folder = shared_folder(spark, "study")
    _run(spark, root, folder)
    paths = _run(spark, root, folder, create_cohorts=False)
    return store.read_csv(spark, paths["by_month"], RATES_MONTH)


def stored_rule_impact(spark: SparkSession, root: str) -> DataFrame:
    """Rule statistics, those of a cohort defined otherwise before replaced."""
    paths = _again(spark, root, rule_impact=True, run_prevalence=False)
    return spark.read.schema(INCLUSION_STATS).parquet(paths["inclusion_stats"])


def _stored(read: Callable[[SparkSession, StudyPaths], DataFrame], **changes):
    return lambda spark, root: read(spark, _run(spark, root, shared_folder(spark, "study"), **changes))


def brand_study_cohorts() -> list[tuple[int, str, str, int]]:
    """Id, name, type and brand of nineteen cohorts; ids and names are those of the shipped study."""
    return [(d.cohort_id, d.name, d.cohort_type, n) for n, d in enumerate(patch_study.definitions(), start=1)]


def _brand_document(kind: str, brand: int) -> dict:
    concept = {"concept": {"CONCEPT_ID": BRAND_BASE + brand}, "includeDescendants": True}
    entry = "ConditionOccurrence" if kind == DISEASE else "DrugExposure"
    return {
        "ConceptSets": [{"id": 0, "name": "brand", "expression": {"items": [concept]}}],
        "PrimaryCriteria": {
            "CriteriaList": [{entry: {"CodesetId": 0}}],
            "ObservationWindow": {"PriorDays": 365, "PostDays": 0},
            "PrimaryCriteriaLimit": {"Type": "All"},
        },
        "QualifiedLimit": {"Type": "All"},
        "ExpressionLimit": {"Type": "All"},
        "InclusionRules": [],
        "EndStrategy": {"DateOffset": {"DateField": "StartDate", "Offset": 1}},
        "CensoringCriteria": [{"Death": {}}],
        "CollapseSettings": {"CollapseType": "ERA", "EraPad": 0},
        "CensorWindow": {},
        "cdmVersionRange": ">=5.0.0",
    }


def write_brand_study(spark: SparkSession, folder: str) -> list[str]:
    """Registry, pairs and definition documents of the brand study, as files below ``folder``."""
    cohorts = brand_study_cohorts()
    paths = [f"{folder}/{name}" for name in ("cohorts.csv", "pairs.csv", "documents")]
    names = {i: name for i, name, _, _ in cohorts}
    registry = [(i, f"[study] {name}", i, name, kind) for i, name, kind, _ in cohorts]
    pairs = [(a, names[a], b, names[b]) for a, b in patch_study.pairs()]
    store.write_csv(local_frame(spark, registry, REGISTRY), paths[0])
    store.write_csv(local_frame(spark, pairs, PAIRS), paths[1])
    documents = [(name, json.dumps(_brand_document(kind, brand))) for _, name, kind, brand in cohorts]
    write_definitions(local_frame(spark, documents, "name string, text string"), paths[2])
    return paths


def stored_file_study(spark: SparkSession, root: str) -> DataFrame:
    """Yearly rates of a study of nineteen cohorts and eighty-four pairs whose settings are all read from files."""
    folder = shared_folder(spark, "files")
    files = write_brand_study(spark, folder)
    paths = run_file_study(spark, retail_tables(spark, root), *files, f"{folder}/out", _parameters())
    return store.read_csv(spark, paths["by_year"], RATES_YEAR)


def stored_registry_pairs(spark: SparkSession, root: str) -> DataFrame:
    """The pairs of the stored settings, with the patients that are in both cohorts at any time."""
    folder = shared_folder(spark, "files")
    files = write_brand_study(spark, folder)
    paths = run_file_study(
        spark, retail_tables(spark, root), *files, f"{folder}/out", _parameters(run_prevalence=False)
    )
    registry, pairs = read_registry(spark, files[0]), read_pairs(spark, files[1])
    # A subject's cohorts are a set no longer than the registry, so that pairs are counted without a join of rows.
    subjects = store.read_cohorts(spark, paths["cohort"]).groupBy("subject_id").agg(
        F.collect_set("cohort_definition_id").alias("held")
    )
    sets = subjects.groupBy(F.array_sort("held").alias("held")).agg(F.count("*").alias("n"))
    members = sets.select(F.explode("held").alias("diseaseId"), "held", "n")
    both = members.select("diseaseId", F.explode("held").alias("drugId"), "n").groupBy("diseaseId", "drugId").agg(
        F.sum("n").alias("subjects")
    )
    kinds = registry.select("cohortId", "cohortType")
    return (
        pairs.join(both, ["diseaseId", "drugId"], "left")
        .join(kinds.withColumnsRenamed({"cohortId": "diseaseId", "cohortType": "diseaseType"}), "diseaseId")
        .join(kinds.withColumnsRenamed({"cohortId": "drugId", "cohortType": "drugType"}), "drugId")
        .withColumn("subjects", F.coalesce("subjects", F.lit(0)))
    )


def inline_code_events(spark: SparkSession, root: str) -> DataFrame:
    """Events of products listed by hand."""
    listed = source_codes(spark, 1, LISTED_PRODUCTS)
    return domain_events(retail_tables(spark, root), DRUG_SOURCE, listed).drop("domain")


def stored_rates_view(spark: SparkSession, root: str) -> DataFrame:
    """A choice among displayed results, which reads the folder of that choice."""
    paths = _run(spark, root, shared_folder(spark, "study"))
    return views.rates_view(
        store.read_display(spark, paths["display_by_year"], RATES_YEAR),
        database=study.DATABASE, analysis=rates.INCIDENCE_OF_DISEASE, disease="disease one", drug=rates.ABSENT,
        age_groups=["<18", "25-34", ">=65", "All"], genders=["Female", "All"], after=1996,
    ).withColumnRenamed("Incidence(%)", "incidence_percent")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "inline_code_events": inline_code_events,
    "stored_cohorts_replaced": stored_cohorts_replaced,
    "stored_cohort_by_id": stored_cohort_by_id,
    "stored_study_resumed": stored_study_resumed,
    "stored_rates_reused": stored_rates_reused,
    "stored_rule_impact": stored_rule_impact,
    "stored_file_study": stored_file_study,
    "stored_registry_pairs": stored_registry_pairs,
    "stored_rates_view": stored_rates_view,
    "stored_cohort_counts": _stored(
        lambda spark, paths: store.read_csv(spark, paths["cohort_counts"], COHORT_COUNTS), run_prevalence=False
    ),
    "stored_dataset_counts": _stored(lambda spark, paths: store.read_csv(spark, paths["dataset_counts"], DATASET_COUNTS)),
    "stored_dose_summary": _stored(lambda spark, paths: store.read_csv(spark, paths.dose("drug"), DOSE)),
    "stored_diagnosis_profile": _stored(
        lambda spark, paths: store.read_csv(spark, paths.demographics("drug"), DIAGNOSIS_PROFILE)
    ),
    "stored_masked_year": _stored(
        lambda spark, paths: store.read_csv(spark, paths["by_year_masked"], masked(RATES_YEAR)), min_cell_count=MINIMUM_CELL
    ),
    "stored_display_month": _stored(
        lambda spark, paths: store.read_display(spark, paths["display_by_month"], masked(RATES_MONTH)),
        min_cell_count=MINIMUM_CELL,
    ),
}
