"""The SQL of the queries over stored studies: what a study stores is what the questions ask for."""

from __future__ import annotations

from checks.retail_sql import (
    COHORT, EVENTS, PREPARED, QUALIFIED, RESOLVED, SOURCES, SQL as RETAIL, combined, denominators, eras, in_window,
    numerator, of_base, pair_numerator, population, statement,
)

# Diseases by brand 1 to 12, drugs by brand 13 to 19, in the order of the registry.
DISEASES = {
    1289: "depression", 1292: "bipolar disorder", 1293: "schizophrenia", 1294: "anxiety disorder",
    1295: "neurodevelopmental disorder", 1296: "alcohol use disorder", 1297: "substance use disorder",
    1319: "somatoform disorder", 1301: "total indications", 1304: "oa indications", 1306: "neuropathy indications",
    1308: "pancreas indications",
}
DRUGS = {
    1239: "fentanyl", 1284: "fentanyl_1", 1285: "fentanyl_2", 1286: "fentanyl_3", 1287: "fentanyl_4",
    1288: "fentanyl_5", 1346: "fentanyl_6",
}
_BRANDS = ", ".join(f"({i}, {n})" for n, i in enumerate([*DISEASES, *DRUGS], start=1))
_IS_DISEASE = f"cohort_id IN ({', '.join(map(str, DISEASES))})"

BRAND_COHORTS = f"""
brand_of(cohort_id, brand) AS (VALUES {_BRANDS}),
product AS (
    SELECT b.cohort_id, a.d AS concept_id
    FROM brand_of b JOIN ancestor a ON a.a = 100 + b.brand JOIN concept c ON c.concept_id = a.d
    WHERE NOT c.invalid),
started AS (
    SELECT p.cohort_id, l.person_id, l.order_date AS start_date
    FROM line l JOIN product p ON p.concept_id = 10000 + l.l_partkey
    WHERE l.l_linenumber % 2 = 1 AND {_IS_DISEASE}
    UNION
    SELECT p.cohort_id, l.person_id, l.ship_date
    FROM line l JOIN product p ON p.concept_id = 10000 + l.l_partkey
    WHERE l.l_linenumber % 2 = 0 AND NOT {_IS_DISEASE}),
stay AS (
    SELECT t.cohort_id, t.person_id, t.start_date,
           LEAST(t.start_date + 1, op.e,
                 COALESCE((SELECT MIN(d.death_date) FROM death d WHERE d.person_id = t.person_id
                           AND d.death_date BETWEEN t.start_date AND op.e), op.e)) AS exit_date
    FROM started t JOIN op ON op.person_id = t.person_id AND t.start_date BETWEEN op.s AND op.e
    WHERE op.s + 365 <= t.start_date)"""

_BRAND_BASE = (SOURCES, BRAND_COHORTS, COHORT)
_BRAND_RATES = combined(tuple(DISEASES), tuple(DRUGS), DISEASES | DRUGS, f"d.{_IS_DISEASE}")

REPLACED = """
longer AS (
    SELECT cohort_id, person_id, start_date,
           LEAST(start_date + 30, op_end_date, COALESCE(censor_date, op_end_date)) AS exit_date
    FROM censored WHERE cohort_id IN (1, 10))"""

_ROWS = (
    "cohort_id AS cohort_definition_id, person_id AS subject_id, opened AS cohort_start_date, closed AS cohort_end_date"
)

SQL: dict[str, str] = {
    "inline_code_events": statement(
        (SOURCES,),
        """SELECT CAST(1 AS BIGINT) AS codeset_id, person_id, ship_date AS start_date,
                  COALESCE(end_date, ship_date + days_supply, ship_date + 1) AS end_date,
                  l_orderkey AS visit_occurrence_id
           FROM line WHERE l_linenumber % 2 = 0 AND l_partkey IN (SELECT unnest(range(5, 200, 13)))""",
    ),
    "stored_cohorts_replaced": statement(
        (SOURCES, RESOLVED, EVENTS, QUALIFIED, COHORT, REPLACED,
         eras("long_stay", "longer", "cohort_id, person_id", "start_date", "exit_date")),
        f"SELECT {_ROWS} FROM cohort WHERE cohort_id NOT IN (1, 2, 10) UNION ALL SELECT {_ROWS} FROM long_stay",
    ),
    "stored_cohort_by_id": of_base(f"SELECT {_ROWS} FROM cohort WHERE cohort_id = 3"),
    "stored_study_resumed": RETAIL["rates_combined_year"],
    "stored_rates_reused": RETAIL["rates_combined_month"],
    "stored_rule_impact": RETAIL["inclusion_stats"],
    "stored_file_study": statement(
        (
            *_BRAND_BASE, population(), denominators("year"), PREPARED, in_window("year"),
            numerator("prevalent", "inside"), numerator("incident", "first_inside"),
            pair_numerator("pair_prevalent", "inside", _IS_DISEASE, f"NOT d.{_IS_DISEASE}"),
            pair_numerator("pair_incident", "first_inside", _IS_DISEASE, f"NOT d.{_IS_DISEASE}"),
        ),
        _BRAND_RATES,
    ),
    "stored_registry_pairs": statement(
        (*_BRAND_BASE, f"""
            cohort_name(cohort_id, name) AS (
                VALUES {", ".join(f"({i}, '{name}')" for i, name in (DISEASES | DRUGS).items())})"""),
        f"""SELECT CAST(a.cohort_id AS INTEGER) AS "diseaseId", a.name AS "diseaseCohort",
                   CAST(b.cohort_id AS INTEGER) AS "drugId", b.name AS "drugCohort",
                   'Disease' AS "diseaseType", 'Drug' AS "drugType",
                   (SELECT COUNT(DISTINCT x.person_id) FROM cohort x JOIN cohort y ON x.person_id = y.person_id
                    WHERE x.cohort_id = a.cohort_id AND y.cohort_id = b.cohort_id) AS subjects
            FROM cohort_name a CROSS JOIN cohort_name b WHERE a.{_IS_DISEASE} AND NOT b.{_IS_DISEASE}""",
    ),
    "stored_rates_view": RETAIL["rates_view_year"],
    "stored_cohort_counts": RETAIL["cohort_counts"],
    "stored_dataset_counts": RETAIL["dataset_counts"],
    "stored_dose_summary": RETAIL["dose_summary"],
    "stored_diagnosis_profile": RETAIL["diagnosis_profile"],
    "stored_masked_year": RETAIL["mask_small_cells"],
    "stored_display_month": RETAIL["masked_margins_month"],
}
