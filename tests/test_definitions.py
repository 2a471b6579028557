import json

import pytest
from helpers import day, rows

from cohortloom.model import DISEASE, DRUG, CohortDefinition, Criterion
from cohortloom.operators.concepts import resolve_concept_sets
from cohortloom.operators.events import CONDITION, DRUG as DRUG_CONCEPT, OBSERVATION, PROCEDURE
from cohortloom.plans import patch_study
from cohortloom.plans.file_study import read_study, run_file_study
from cohortloom.plans.study import StudyParameters
from cohortloom.sources.definitions import (
    cohort_definitions, definition_items, parse_definitions, read_definitions,
)
from cohortloom.sources.settings import read_pairs, read_registry, registry_names
from pyspark.sql import functions as F


def item(concept, **flags):
    return {"concept": {"CONCEPT_ID": concept, "CONCEPT_NAME": "x", "INVALID_REASON": "V"}, **flags}


def criterion(domain, codeset, condition=None):
    return {domain: {"CodesetId": codeset, **({"OccurrenceStartDate": condition} if condition else {})}}


def document(sets, criteria, limit="First", **changes):
    return {
        "ConceptSets": [{"id": i, "name": "n", "expression": {"items": items}} for i, items in sets.items()],
        "PrimaryCriteria": {
            "CriteriaList": criteria,
            "ObservationWindow": {"PriorDays": 365, "PostDays": 0},
            "PrimaryCriteriaLimit": {"Type": "All"},
        },
        "QualifiedLimit": {"Type": limit},
        "ExpressionLimit": {"Type": "All"},
        "InclusionRules": [],
        "EndStrategy": {"DateOffset": {"DateField": "StartDate", "Offset": 1}},
        "CensoringCriteria": [{"Death": {}}],
        "CollapseSettings": {"CollapseType": "ERA", "EraPad": 0},
        "CensorWindow": {},
        "cdmVersionRange": ">=5.0.0",
        **changes,
    }


def parsed(spark, *documents):
    frame = spark.createDataFrame(
        [(i, f"d{i}", json.dumps(d)) for i, d in enumerate(documents, start=1)],
        "definition_id int, name string, text string",
    )
    return parse_definitions(frame, "text")


ID = 1 << 32  # a document's id stands above its local ids
SINCE = {"Value": "2016-01-01", "Extent": "2021-12-31", "Op": "gte"}


def test_settings_become_definitions(spark):
    several = document(
        {0: [item(1, includeDescendants=True)]},
        [criterion("ConditionOccurrence", 0, SINCE), criterion("Observation", 0, SINCE),
         criterion("ProcedureOccurrence", 0)],
    )
    drug = document({2: [item(1)]}, [criterion("DrugExposure", 2)], limit="All", CensoringCriteria=[])
    found = cohort_definitions(parsed(spark, several, drug), DISEASE)
    start = day("2016-01-01")
    assert sorted(found, key=lambda d: d.cohort_id) == [
        CohortDefinition(
            1, "d1", DISEASE,
            (Criterion(CONDITION, ID, start), Criterion(OBSERVATION, ID, start), Criterion(PROCEDURE, ID)),
            first_only=True,
        ),
        CohortDefinition(2, "d2", DISEASE, (Criterion(DRUG_CONCEPT, 2 * ID + 2),), censor_at_death=False),
    ]


@pytest.mark.parametrize(
    "operator, bounds",
    [("gt", ("2016-01-02", None)), ("lt", (None, "2015-12-31")), ("lte", (None, "2016-01-01")),
     ("eq", ("2016-01-01", "2016-01-01")), ("bt", ("2016-01-01", "2021-12-31"))],
)
def test_date_operators(spark, operator, bounds):
    text = document({0: [item(1)]}, [criterion("Observation", 0, {**SINCE, "Op": operator})])
    only = cohort_definitions(parsed(spark, text), DISEASE)[0].primary[0]
    assert (only.start_from, only.start_to) == tuple(b and day(b) for b in bounds)


@pytest.mark.parametrize(
    "change",
    [
        {"InclusionRules": [{"name": "r"}]},
        {"ExpressionLimit": {"Type": "First"}},
        {"EndStrategy": {"DateOffset": {"DateField": "EndDate", "Offset": 1}}},
        {"CensoringCriteria": [{"Observation": {}}]},
        {"CensorWindow": {"StartDate": "2015-01-01"}},
        {"AdditionalCriteria": {"Type": "ALL"}},
        {"EndStrategy": {"DateOffset": {"DateField": "StartDate", "Offset": 1}, "CustomEra": {}}},
        {"PrimaryCriteria": None},
        {"QualifiedLimit": None},
    ],
)
def test_what_is_not_supported_is_refused(spark, change):
    text = document({0: [item(1)]}, [criterion("Observation", 0)], **change)
    with pytest.raises(ValueError, match="d1"):
        cohort_definitions(parsed(spark, text), DISEASE)


@pytest.mark.parametrize("setting", [{"First": True}, {"Age": {"Value": 1, "Op": "gt"}}, {"Gender": []}, {"OccurrenceEndDate": {}}])
def test_settings_of_criteria_are_refused(spark, setting):
    entry = {"Observation": {"CodesetId": 0, **setting}}
    with pytest.raises(ValueError, match=f"CriteriaList/Observation/{next(iter(setting))}"):
        cohort_definitions(parsed(spark, document({0: [item(1)]}, [entry])), DISEASE)


def test_mapped_concepts_are_refused_where_asked_for(spark):
    plain = document({0: [item(1, includeMapped=False)]}, [criterion("Observation", 0)])
    assert rows(definition_items(parsed(spark, plain)), "concept_id") == [(1,)]
    mapped = document({0: [item(1, includeMapped=True)]}, [criterion("Observation", 0)])
    with pytest.raises(Exception, match="includeMapped"):
        definition_items(parsed(spark, plain, mapped)).collect()
    with pytest.raises(ValueError, match="includeMapped"):
        cohort_definitions(parsed(spark, plain, mapped), DISEASE)


def test_codeset_ids_of_documents_do_not_meet(spark):
    sets = parsed(spark, document({1000: [item(1)]}, []), document({0: [item(2)]}, []))
    assert rows(definition_items(sets), "codeset_id", "concept_id") == [(ID + 1000, 1), (2 * ID, 2)]
    with pytest.raises(Exception, match="out of range"):
        definition_items(parsed(spark, document({-1: [item(1)]}, []))).collect()


def test_broken_files_fail(spark, tmp_path):
    (tmp_path / "good.json").write_text(json.dumps(document({0: [item(7)]}, [criterion("Observation", 0)])))
    (tmp_path / "broken.json").write_text('{"ConceptSets": [{"id": 0, ')
    read = read_definitions(spark, str(tmp_path)).withColumn("definition_id", F.lit(1))
    with pytest.raises(Exception, match="MALFORMED|malformed"):
        definition_items(read).collect()
    with pytest.raises(Exception, match="MALFORMED|malformed"):
        cohort_definitions(read, DISEASE)


def write_study(tmp_path, pairs="7,b c,9,d\n"):
    (tmp_path / "documents").mkdir()
    ill = document({0: [item(1, includeDescendants=True)]}, [criterion("ConditionOccurrence", 0)], limit="All")
    drug = document({0: [item(50)]}, [criterion("DrugExposure", 0)], limit="All")
    (tmp_path / "documents" / "b c.json").write_text(json.dumps(ill))
    (tmp_path / "documents" / "d.json").write_text(json.dumps(drug))
    (tmp_path / "documents" / "unused.json").write_text(json.dumps(ill))
    (tmp_path / "cohorts.csv").write_text(
        "atlasId,atlasName,cohortId,name,cohortType\n7,[a] b c,7,b c,Disease\n9,[a] d,9,d,Drug\n"
    )
    (tmp_path / "pairs.csv").write_text(f"diseaseId,diseaseCohort,drugId,drugCohort\n{pairs}")
    return [str(tmp_path / name) for name in ("cohorts.csv", "pairs.csv", "documents")]


def test_a_study_runs_from_its_files(spark, make_tables, tmp_path):
    tables = make_tables(
        person=[{"person_id": 1, "gender_concept_id": 8507, "year_of_birth": 1970}],
        observation_period=[{"person_id": 1, "observation_period_start_date": day("2010-01-01"),
                             "observation_period_end_date": day("2020-12-31")}],
        concept=[{"concept_id": c} for c in (1, 2, 50)],
        concept_ancestor=[{"ancestor_concept_id": 1, "descendant_concept_id": 2}],
        condition_occurrence=[{"person_id": 1, "condition_concept_id": 2, "condition_start_date": day("2013-02-03")}],
        drug_exposure=[{"person_id": 1, "drug_concept_id": 50, "drug_exposure_start_date": day("2013-06-06")}],
    )
    files = write_study(tmp_path)
    paths = run_file_study(spark, tables, *files, str(tmp_path / "out"), StudyParameters(database="site"))
    by_year = spark.read.option("header", True).csv(paths["by_year"])
    paired = by_year.where("analysis = 'Prevalence of Drug in Disease Cohort'")
    assert rows(paired, "diseaseCohortName", "drugCohortName", "calDate", "Counts", "totalPatients") == [
        ("b c", "d", "2013", "1", "1")
    ]


def test_settings_files_are_held_to_their_documents(spark, make_tables, tmp_path):
    tables, files = make_tables(), write_study(tmp_path, pairs="9,d,7,b c\n")
    with pytest.raises(ValueError, match="pair"):
        read_study(spark, tables, *files)
    (tmp_path / "documents" / "d.json").unlink()
    with pytest.raises(ValueError, match="no definition for d"):
        read_study(spark, tables, *files)
    (tmp_path / "cohorts.csv").write_text("atlasId,atlasName,cohortId,name,cohortType\n7,x,7,b c,Disease\n7,y,7,d,Drug\n")
    with pytest.raises(ValueError, match="cohortId"):
        read_study(spark, tables, *files)


def test_items_resolve_per_document(spark, make_tables):
    tables = make_tables(
        concept=[{"concept_id": c} for c in (1, 2, 3)],
        concept_ancestor=[{"ancestor_concept_id": 1, "descendant_concept_id": d} for d in (1, 2, 3)],
    )
    definitions = parsed(
        spark,
        document({0: [item(1, includeDescendants=True), item(2, isExcluded=True)]}, []),
        document({0: [item(1)], 3: [item(3, isExcluded=False)]}, []),
    )
    items = definition_items(definitions)
    assert rows(resolve_concept_sets(tables["concept"], tables["concept_ancestor"], items), "codeset_id", "concept_id") == [
        (ID, 1), (ID, 3), (2 * ID, 1), (2 * ID + 3, 3),
    ]


def test_files_are_named_after_themselves(spark, tmp_path):
    text = document({0: [item(7, includeDescendants=True)]}, [criterion("Observation", 0)])
    (tmp_path / "Low mood.json").write_text(json.dumps(text, indent=2))
    (tmp_path / "Other.json").write_text(json.dumps(text))
    read = read_definitions(spark, str(tmp_path)).withColumn(
        "definition_id", F.when(F.col("name") == "Low mood", 4).otherwise(5)
    )
    assert rows(read, "definition_id", "name") == [(4, "Low mood"), (5, "Other")]
    assert rows(definition_items(read)) == [(4 * ID, 7, True, False), (5 * ID, 7, True, False)]


def test_csv_settings(spark, tmp_path):
    (tmp_path / "cohorts.csv").write_text("atlasId,atlasName,cohortId,name,cohortType\n7,[a] b c,7,b c,Disease\n")
    (tmp_path / "pairs.csv").write_text("diseaseId,diseaseCohort,drugId,drugCohort\n7,b c,9,d\n")
    assert rows(registry_names(read_registry(spark, str(tmp_path / "cohorts.csv")))) == [(7, "b c")]
    assert rows(read_pairs(spark, str(tmp_path / "pairs.csv"))) == [(7, "b c", 9, "d")]


def test_shipped_study(spark):
    definitions = patch_study.definitions()
    assert [d.cohort_type for d in definitions].count(DISEASE) == 12
    assert [d.cohort_type for d in definitions].count(DRUG) == 7
    assert len(patch_study.pairs()) == len(set(patch_study.pairs())) == 84
    counts = {r.codeset_id: r.n for r in patch_study.items(spark).groupBy("codeset_id").agg(F.count("*").alias("n")).collect()}
    assert counts == {
        1289: 4, 1292: 1, 1293: 7, 1294: 8, 1295: 4, 1296: 16, 1297: 19, 1319: 1,
        1301: 159, 1304: 29, 1306: 130, 1308: 2, 1: 26,
    }
    listed_twice = set(patch_study.OA_INDICATIONS) & set(patch_study.NEUROPATHY_INDICATIONS)
    assert listed_twice == {72986, 76191}


def test_shipped_study_as_published(spark, make_tables):
    own = {d.cohort_id: d.name for d in patch_study.definitions()}
    published = {d.cohort_id: d.name for d in patch_study.definitions(as_published=True)}
    assert (own[1346], published[1346]) == ("fentanyl_6", "fentanyl_5")
    assert [s.cohort_id for s in patch_study.strengths()][-2:] == [1288, 1346]
    assert [s.cohort_id for s in patch_study.strengths(as_published=True)][-2:] == [1288, 1288]
    tables = make_tables()
    for as_published, last in ((False, 9), (True, 7)):
        products = patch_study.codes(spark, tables, as_published).sources
        sizes = {r.codeset_id: r.n for r in products.groupBy("codeset_id").agg(F.count("*").alias("n")).collect()}
        assert sizes == {1239: 52, 1284: 11, 1285: 12, 1286: 1, 1287: 12, 1288: 7, 1346: last}
