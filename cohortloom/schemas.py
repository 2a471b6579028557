"""Fixed schemas of source tables, cohort rows and results."""

from __future__ import annotations

from pyspark.sql import types as T

_LONG, _INT, _DATE, _STR, _DBL = (
    T.LongType(), T.IntegerType(), T.DateType(), T.StringType(), T.DoubleType(),
)


def _schema(**columns) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in columns.items()])


PERSON = _schema(
    person_id=_LONG, gender_concept_id=_INT, year_of_birth=_INT, month_of_birth=_INT, day_of_birth=_INT,
)
OBSERVATION_PERIOD = _schema(
    person_id=_LONG, observation_period_start_date=_DATE, observation_period_end_date=_DATE,
)
CONDITION_OCCURRENCE = _schema(
    condition_occurrence_id=_LONG, person_id=_LONG, condition_concept_id=_LONG,
    condition_start_date=_DATE, condition_end_date=_DATE, visit_occurrence_id=_LONG,
)
DRUG_EXPOSURE = _schema(
    drug_exposure_id=_LONG, person_id=_LONG, drug_concept_id=_LONG, drug_source_value=_STR,
    drug_exposure_start_date=_DATE, drug_exposure_end_date=_DATE, days_supply=_INT,
    visit_occurrence_id=_LONG,
)
OBSERVATION = _schema(
    observation_id=_LONG, person_id=_LONG, observation_concept_id=_LONG,
    observation_date=_DATE, visit_occurrence_id=_LONG,
)
PROCEDURE_OCCURRENCE = _schema(
    procedure_occurrence_id=_LONG, person_id=_LONG, procedure_concept_id=_LONG,
    procedure_date=_DATE, visit_occurrence_id=_LONG,
)
DEATH = _schema(person_id=_LONG, death_date=_DATE)
CONCEPT = _schema(concept_id=_LONG, invalid_reason=_STR)
CONCEPT_ANCESTOR = _schema(ancestor_concept_id=_LONG, descendant_concept_id=_LONG)

SOURCE_TABLES = {
    "person": PERSON,
    "observation_period": OBSERVATION_PERIOD,
    "condition_occurrence": CONDITION_OCCURRENCE,
    "drug_exposure": DRUG_EXPOSURE,
    "observation": OBSERVATION,
    "procedure_occurrence": PROCEDURE_OCCURRENCE,
    "death": DEATH,
    "concept": CONCEPT,
    "concept_ancestor": CONCEPT_ANCESTOR,
}

# Columns that a site's tables may lack or leave null.
OPTIONAL_COLUMNS = {
    "year_of_birth", "month_of_birth", "day_of_birth", "condition_end_date", "drug_exposure_end_date",
    "days_supply", "visit_occurrence_id", "invalid_reason",
}

COHORT = _schema(
    cohort_definition_id=_INT, subject_id=_LONG, cohort_start_date=_DATE, cohort_end_date=_DATE,
)

CONCEPT_ITEM = _schema(
    codeset_id=_LONG, concept_id=_LONG, include_descendants=T.BooleanType(), is_excluded=T.BooleanType(),
)
SOURCE_CODE = _schema(codeset_id=_LONG, source_code=_STR)

# Columns of the settings files.
REGISTRY = _schema(atlasId=_INT, atlasName=_STR, cohortId=_INT, name=_STR, cohortType=_STR)
PAIRS = _schema(diseaseId=_INT, diseaseCohort=_STR, drugId=_INT, drugCohort=_STR)


def rates(calendar: T.DataType) -> T.StructType:
    """Result rows; ``calendar`` is int for yearly and date for monthly results."""
    return _schema(
        database=_STR, diseaseId=_STR, diseaseCohortName=_STR, drugId=_STR, drugCohortName=_STR,
        calDate=calendar, ageGroup=_STR, Gender=_STR, totalPatients=_LONG, Counts=_LONG,
        rate=_DBL, analysis=_STR,
    )


RATES_YEAR = rates(_INT)
RATES_MONTH = rates(_DATE)
DATASET_COUNTS = _schema(total_counts=_LONG, total_followup_yr=_LONG)
COHORT_COUNTS = _schema(cohortDefinitionId=_INT, cohortName=_STR, incidencecounts=_LONG)
DIAGNOSIS_PROFILE = _schema(
    diseaseId=_INT, ageGroup=_STR, Gender=_STR, totalPatients=_LONG, Counts=_LONG, rate=_DBL,
)
INCLUSION_STATS = _schema(
    cohort_definition_id=_INT, rule_sequence=_INT, person_count=_LONG, gain_count=_LONG, person_total=_LONG,
    mode_id=_INT,
)


def dose(labels) -> T.StructType:
    """Rows of a dose summary for strengths of these labels."""
    return _schema(
        calDate=_INT, ageGroup=_STR, Gender=_STR, totalPatients=_LONG, totalCounts=_LONG,
        **{f"Counts_{label}": _LONG for label in labels}, rate=_DBL,
    )


def masked(result: T.StructType) -> T.StructType:
    """Result rows whose small counts are masked: their numbers are text."""
    return _schema(**{f.name: _STR if f.name in ("totalPatients", "Counts") else f.dataType for f in result})
