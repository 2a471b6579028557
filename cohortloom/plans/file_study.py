"""A study whose cohorts, pairs and definitions are files."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F

from cohortloom.model import DISEASE, DRUG, CohortDefinition
from cohortloom.operators.concepts import resolve_concept_sets
from cohortloom.plans.cohorts import Codes
from cohortloom.plans.study import DoseSettings, StudyParameters, StudyPaths, run_study
from cohortloom.sources.definitions import cohort_definitions, definition_items, read_definitions
from cohortloom.sources.settings import read_pairs, read_registry
from cohortloom.sources.tables import Tables


@dataclass(frozen=True)
class StudySettings:
    """What a study is made of: resolved codes, cohorts in the registry's order, and pairs."""

    codes: Codes
    definitions: tuple[CohortDefinition, ...]
    pairs: tuple[tuple[int, int], ...]


def study_of_documents(tables: Tables, documents: DataFrame) -> tuple[Codes, list[CohortDefinition]]:
    """Codes and cohorts of parsed documents with ``definition_id``, ``name`` and ``cohort_type``."""
    concepts = resolve_concept_sets(tables["concept"], tables["concept_ancestor"], definition_items(documents))
    return Codes(concepts), cohort_definitions(documents)


def read_study(
    spark: SparkSession, tables: Tables, registry_path: str, pairs_path: str, definitions_path: str
) -> StudySettings:
    """The study that the registry asks for.

    Each cohort of the registry is the document whose file has its name. The driver
    holds the registry, the pairs and the settings of the documents, all as long as
    the study. A cohort without a document, an id or name given twice, and a pair of
    cohorts that the registry doesn't have, or has with other types, are errors.
    """
    registry = read_registry(spark, registry_path).select("cohortId", "name", "cohortType")
    listed = registry.collect()
    for column in ("cohortId", "name"):
        values = [r[column] for r in listed]
        if None in values or len(values) != len(set(values)):
            raise ValueError(f"the registry has a {column} twice or none")
    documents = read_definitions(spark, definitions_path).join(F.broadcast(registry), "name").select(
        F.col("cohortId").alias("definition_id"), F.col("cohortType").alias("cohort_type"), "*"
    ).drop("cohortId", "cohortType")
    codes, built = study_of_documents(tables, documents)
    by_id = {d.cohort_id: d for d in built}
    missing = [r.name for r in listed if r.cohortId not in by_id]
    if missing:
        raise ValueError(f"no definition for {', '.join(missing)}")
    pairs = tuple((r.diseaseId, r.drugId) for r in read_pairs(spark, pairs_path).collect())
    for pair in pairs:
        for cohort_id, cohort_type in zip(pair, (DISEASE, DRUG)):
            if cohort_id not in by_id or by_id[cohort_id].cohort_type != cohort_type:
                raise ValueError(f"pair {pair} needs a cohort {cohort_id} of type {cohort_type}")
    return StudySettings(codes, tuple(by_id[r.cohortId] for r in listed), tuple(dict.fromkeys(pairs)))


def run_file_study(
    spark: SparkSession,
    tables: Tables,
    registry_path: str,
    pairs_path: str,
    definitions_path: str,
    output: str,
    parameters: StudyParameters = StudyParameters(),
    dose: DoseSettings | None = None,
) -> StudyPaths:
    """Runs the study of the files; see ``run_study``."""
    settings = read_study(spark, tables, registry_path, pairs_path, definitions_path)
    return run_study(
        spark, tables, settings.codes, settings.definitions, settings.pairs, output, parameters, dose
    )
