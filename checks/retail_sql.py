"""For each registered query, the same question in plain SQL over the given tables.

The SQL follows the definitions word by word (EXISTS, COUNT(DISTINCT), one join per
period) and shares no logic with the Spark plans, so that the two check each other.
Each statement is put together from the common table expressions below.
"""

from __future__ import annotations

WINDOW = ("1995-01-01", "2001-12-31")
NARROW = ("1997-03-01", "2000-10-31")
DISEASES, DRUGS = (1, 2, 3), (10, 11, 12, 13, 14, 15, 16)
NAMES = {
    1: "disease one", 2: "disease two", 3: "indications", 10: "drug",
    11: "drug 12", 12: "drug 25", 13: "drug 375", 14: "drug 50", 15: "drug 75", 16: "drug 100",
}

SOURCES = """
line AS (
    SELECT o.o_custkey AS person_id, CAST(o.o_orderdate AS DATE) AS order_date,
           CAST(l.l_shipdate AS DATE) AS ship_date, l.l_orderkey, l.l_linenumber, l.l_partkey,
           CASE WHEN l.l_returnflag <> 'R' THEN CAST(l.l_shipdate AS DATE) END AS end_date,
           CAST(l.l_quantity AS INTEGER) AS days_supply
    FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey),
person AS (
    SELECT c_custkey AS person_id,
           CASE c_custkey % 3 WHEN 0 THEN 8507 WHEN 1 THEN 8532 ELSE 0 END AS gender_concept_id,
           CASE c_custkey % 3 WHEN 0 THEN 'Male' WHEN 1 THEN 'Female' ELSE 'Unknown' END AS gender,
           make_date(CAST(1925 + (c_custkey * 7) % 76 AS INTEGER),
                     CAST(CASE WHEN c_custkey % 5 = 0 THEN 7 ELSE 1 + c_custkey % 12 END AS INTEGER),
                     CAST(CASE WHEN c_custkey % 4 = 0 THEN 1 ELSE 1 + c_custkey % 28 END AS INTEGER)) AS dob
    FROM customer),
whole_span AS (
    SELECT o_custkey AS person_id, CAST(MIN(o_orderdate) AS DATE) AS s, CAST(MAX(o_orderdate) AS DATE) AS e
    FROM orders GROUP BY o_custkey),
op AS (
    SELECT person_id, s, e FROM whole_span
    WHERE NOT (person_id % 10 = 0 AND s < DATE '1998-07-01' AND e >= DATE '1998-07-01')
    UNION ALL
    SELECT person_id, s, DATE '1998-06-30' FROM whole_span
    WHERE person_id % 10 = 0 AND s < DATE '1998-07-01' AND e >= DATE '1998-07-01'
    UNION ALL
    SELECT person_id, DATE '1998-07-01', e FROM whole_span
    WHERE person_id % 10 = 0 AND s < DATE '1998-07-01' AND e >= DATE '1998-07-01'),
death AS (
    SELECT w.person_id, w.e - 200 AS death_date
    FROM whole_span w JOIN customer c ON c.c_custkey = w.person_id WHERE c.c_acctbal < 0),
concept AS (
    SELECT 10000 + p_partkey AS concept_id, p_partkey % 17 = 0 AS invalid FROM part
    UNION ALL
    SELECT DISTINCT 100 + CAST(replace(p_brand, 'Brand#', '') AS BIGINT), FALSE FROM part),
ancestor AS (
    SELECT 100 + CAST(replace(p_brand, 'Brand#', '') AS BIGINT) AS a, 10000 + p_partkey AS d FROM part
    UNION ALL
    SELECT concept_id, concept_id FROM concept),
item(codeset_id, concept_id, deep, excluded) AS (
    VALUES (1, 101, TRUE, FALSE), (1, 102, TRUE, FALSE), (1, 10001, TRUE, TRUE),
           (2, 103, TRUE, FALSE), (4, 104, TRUE, FALSE)
    UNION ALL
    SELECT 3, concept_id, FALSE, FALSE FROM concept WHERE concept_id >= 10000 AND concept_id % 4 = 0)"""

RESOLVED = """
meant AS (
    SELECT i.codeset_id, i.concept_id, i.excluded
    FROM item i WHERE i.concept_id IN (SELECT concept_id FROM concept)
    UNION
    SELECT i.codeset_id, a.d, i.excluded
    FROM item i JOIN ancestor a ON a.a = i.concept_id JOIN concept c ON c.concept_id = a.d
    WHERE i.deep AND NOT c.invalid),
codeset AS (
    SELECT CAST(codeset_id AS BIGINT) AS codeset_id, CAST(concept_id AS BIGINT) AS concept_id
    FROM (SELECT codeset_id, concept_id FROM meant WHERE NOT excluded
          EXCEPT SELECT codeset_id, concept_id FROM meant WHERE excluded))"""

EVENTS = """
source_code AS (
    SELECT CAST(10 + p_partkey % 10 AS BIGINT) AS codeset_id, CAST(p_partkey AS VARCHAR) AS code
    FROM part WHERE p_partkey % 10 IN (1, 2, 3, 4, 5, 6)
    UNION ALL
    SELECT CAST(10 AS BIGINT), CAST(p_partkey AS VARCHAR) FROM part WHERE p_partkey % 10 IN (1, 2, 3, 4, 5, 6)),
condition_event AS (
    SELECT c.codeset_id, l.person_id, l.order_date AS start_date,
           COALESCE(l.end_date, l.order_date + 1) AS end_date, l.l_orderkey AS visit_occurrence_id
    FROM line l JOIN codeset c ON c.concept_id = 10000 + l.l_partkey WHERE l.l_linenumber % 2 = 1),
drug_event AS (
    SELECT c.codeset_id, l.person_id, l.ship_date AS start_date,
           COALESCE(l.end_date, l.ship_date + l.days_supply, l.ship_date + 1) AS end_date,
           l.l_orderkey AS visit_occurrence_id
    FROM line l JOIN source_code c ON c.code = CAST(l.l_partkey AS VARCHAR) WHERE l.l_linenumber % 2 = 0),
observation_event AS (
    SELECT c.codeset_id, l.person_id, l.ship_date AS start_date, l.ship_date + 1 AS end_date,
           l.l_orderkey AS visit_occurrence_id
    FROM line l JOIN codeset c ON c.concept_id = 10000 + l.l_partkey WHERE l.l_linenumber = 3),
procedure_event AS (
    SELECT c.codeset_id, l.person_id, l.order_date AS start_date, l.order_date + 1 AS end_date,
           l.l_orderkey AS visit_occurrence_id
    FROM line l JOIN codeset c ON c.concept_id = 10000 + l.l_partkey WHERE l.l_linenumber = 2)"""

QUALIFIED = """
entry AS (
    SELECT CAST(codeset_id AS INTEGER) AS cohort_id, person_id, start_date
    FROM condition_event WHERE codeset_id IN (1, 2, 3)
    UNION ALL
    SELECT CAST(codeset_id AS INTEGER), person_id, start_date FROM drug_event),
index_event AS (
    SELECT t.cohort_id, t.person_id, t.start_date, op.s AS op_start_date, op.e AS op_end_date,
           COUNT(*) AS n_events
    FROM entry t JOIN op ON op.person_id = t.person_id AND t.start_date BETWEEN op.s AND op.e
    WHERE op.s + 365 <= t.start_date
    GROUP BY ALL),
flagged AS (
    SELECT q.*,
           q.cohort_id >= 10 AND EXISTS (
               SELECT 1 FROM condition_event i
               WHERE i.codeset_id = 3 AND i.person_id = q.person_id
                 AND i.start_date BETWEEN q.op_start_date AND q.start_date) AS rule_0,
           q.cohort_id >= 10 AND NOT EXISTS (
               SELECT 1 FROM condition_event x
               WHERE x.codeset_id = 4 AND x.person_id = q.person_id
                 AND x.start_date BETWEEN q.op_start_date AND q.op_end_date) AS rule_1
    FROM index_event q),
qualified AS (
    SELECT *, CAST(rule_0 AS BIGINT) + 2 * CAST(rule_1 AS BIGINT) AS rule_mask FROM flagged),
included AS (
    SELECT * FROM qualified WHERE cohort_id < 10 OR (rule_0 AND rule_1)),
censored AS (
    SELECT i.*, (SELECT MIN(d.death_date) FROM death d
                 WHERE d.person_id = i.person_id
                   AND d.death_date BETWEEN i.start_date AND i.op_end_date) AS censor_date
    FROM included i),
stay AS (
    SELECT cohort_id, person_id, start_date, LEAST(start_date + 1, op_end_date) AS offset_date, censor_date,
           LEAST(start_date + 1, op_end_date, COALESCE(censor_date, op_end_date)) AS exit_date
    FROM censored)"""


def eras(name: str, source: str, keys: str, start: str, end: str, pad: int = 0) -> str:
    """Eras open where no earlier interval reaches, and last until the next one opens."""
    same = " AND ".join(f"b.{k} = a.{k}" for k in keys.split(", "))
    return f"""
{name}_open AS (
    SELECT DISTINCT {keys}, {start} AS opened FROM {source} a
    WHERE NOT EXISTS (SELECT 1 FROM {source} b
                      WHERE {same} AND b.{start} < a.{start} AND b.{end} + {pad} >= a.{start})),
{name}_span AS (
    SELECT *, LEAD(opened) OVER (PARTITION BY {keys} ORDER BY opened) AS next_opened FROM {name}_open),
{name} AS (
    SELECT {", ".join("a." + k for k in keys.split(", "))}, a.opened, MAX(b.{end}) AS closed
    FROM {name}_span a JOIN {source} b
      ON {same} AND b.{start} >= a.opened AND (a.next_opened IS NULL OR b.{start} < a.next_opened)
    GROUP BY ALL)"""


COHORT = eras("cohort", "stay", "cohort_id, person_id", "start_date", "exit_date")

BASE = (SOURCES, RESOLVED, EVENTS, QUALIFIED, COHORT)

BAND = """CASE WHEN age BETWEEN 0 AND 17 THEN 0 WHEN age BETWEEN 18 AND 24 THEN 1
     WHEN age BETWEEN 25 AND 34 THEN 2 WHEN age BETWEEN 35 AND 44 THEN 3 WHEN age BETWEEN 45 AND 54 THEN 4
     WHEN age BETWEEN 55 AND 64 THEN 5 WHEN age BETWEEN 65 AND 150 THEN 6 END"""
LABEL = "['<18', '18-24', '25-34', '35-44', '45-54', '55-64', '>=65'][age_band + 1]"
INTERVAL = "['[0,17]', '(17,24]', '(24,34]', '(34,44]', '(44,54]', '(54,64]', '(64,150]'][age_band + 1]"


def age(year: str) -> str:
    """Completed years on 1 July; births later than that count back to zero."""
    born_after = "(month(dob) > 7 OR (month(dob) = 7 AND day(dob) > 1))"
    born_before = "month(dob) < 7"
    return f"""CAST(CASE WHEN year(dob) > {year} THEN
        -(year(dob) - {year} - CASE WHEN {born_before} THEN 1 ELSE 0 END)
      ELSE GREATEST({year} - year(dob) - CASE WHEN {born_after} THEN 1 ELSE 0 END, 0) END AS INTEGER)"""


def population(window=WINDOW) -> str:
    y0, y1 = window[0][:4], window[1][:4]
    return f"""
observed AS (
    SELECT p.person_id AS subject_id, p.gender_concept_id, p.gender, p.dob, op.s, op.e,
           date_trunc('month', op.s) AS sm, date_trunc('month', op.e) AS em
    FROM op JOIN person p ON p.person_id = op.person_id
    WHERE year(op.s) <= {y1} AND year(op.e) >= {y0})"""


def denominators(grain: str, window=WINDOW) -> str:
    if grain == "year":
        calendar = f"""SELECT CAST(y AS INTEGER) AS c, CAST(y AS INTEGER) AS y
            FROM range({window[0][:4]}, {int(window[1][:4]) + 1}) t(y)"""
        covers = "year(o.s) <= k.c AND year(o.e) >= k.c"
    else:
        calendar = f"""SELECT CAST(m AS DATE) AS c, CAST(year(m) AS INTEGER) AS y
            FROM range(DATE '{window[0]}', DATE '{window[1]}' + 1, INTERVAL 1 MONTH) t(m)"""
        covers = "o.sm <= k.c AND o.em >= k.c"
    return f"""
calendar AS ({calendar}),
observed_in AS (
    SELECT k.c AS "calDate", o.gender, o.subject_id, {age("k.y")} AS age
    FROM observed o JOIN calendar k ON {covers}),
denominator AS (
    SELECT "calDate", {BAND} AS age_band, gender, COUNT(DISTINCT subject_id) AS "totalPatients"
    FROM observed_in GROUP BY ALL)"""


PREPARED = f"""
prepared AS (
    SELECT *, {BAND} AS age_band
    FROM (SELECT c.cohort_id, c.person_id AS subject_id, c.opened, c.closed, o.gender, o.dob,
                 CAST(year(c.opened) AS INTEGER) AS start_year,
                 CAST(date_trunc('month', c.opened) AS DATE) AS start_month,
                 {age("year(c.opened)")} AS age
          FROM cohort c JOIN observed o ON o.subject_id = c.person_id))"""


def in_window(grain: str, window=WINDOW) -> str:
    period = "start_year" if grain == "year" else "start_month"
    return f"""
inside AS (
    SELECT *, {period} AS "calDate" FROM prepared
    WHERE start_month BETWEEN DATE '{window[0]}' AND DATE '{window[1]}'),
first_inside AS (
    SELECT i.* FROM inside i
    JOIN (SELECT cohort_id, subject_id, MIN(opened) AS opened FROM inside GROUP BY ALL) f
      ON f.cohort_id = i.cohort_id AND f.subject_id = i.subject_id AND f.opened = i.opened)"""


def numerator(name: str, source: str) -> str:
    return f"""
{name} AS (
    SELECT cohort_id, "calDate", age_band, gender, COUNT(DISTINCT subject_id) AS n
    FROM {source} GROUP BY ALL)"""


def pair_numerator(name: str, source: str, disease: str = "cohort_id < 10", drug: str = "d.cohort_id >= 10") -> str:
    return f"""
{name} AS (
    SELECT dis.cohort_id AS "diseaseId", d.cohort_id AS "drugId", d."calDate", d.age_band, d.gender,
           COUNT(DISTINCT d.subject_id) AS n
    FROM {source} d
    JOIN (SELECT DISTINCT cohort_id, subject_id, "calDate" FROM inside WHERE {disease}) dis
      ON dis.subject_id = d.subject_id AND dis."calDate" = d."calDate"
    WHERE {drug} GROUP BY ALL)"""


def ids(name: str, values) -> str:
    return f"(SELECT CAST(v AS INTEGER) AS \"{name}\" FROM unnest([{', '.join(map(str, values))}]) t(v))"


def cohort_rates(id_name: str, values, counts: str) -> str:
    return f"""
SELECT i."{id_name}", d."calDate", CAST(d.age_band AS INTEGER) AS age_band, d.gender, d."totalPatients",
       COALESCE(n.n, 0) AS "Counts", COALESCE(n.n, 0) / d."totalPatients" AS rate
FROM denominator d CROSS JOIN {ids(id_name, values)} i
LEFT JOIN {counts} n ON n.cohort_id = i."{id_name}" AND n."calDate" = d."calDate"
     AND n.age_band IS NOT DISTINCT FROM d.age_band AND n.gender = d.gender"""


def pair_rates(counts: str, drugs=DRUGS, disease: str = "d.cohort_id < 10") -> str:
    return f"""
SELECT d.cohort_id AS "diseaseId", g."drugId", d."calDate", CAST(d.age_band AS INTEGER) AS age_band, d.gender,
       d.n AS "totalPatients", COALESCE(n.n, 0) AS "Counts", COALESCE(n.n, 0) / d.n AS rate
FROM prevalent d CROSS JOIN {ids("drugId", drugs)} g
LEFT JOIN {counts} n ON n."diseaseId" = d.cohort_id AND n."drugId" = g."drugId" AND n."calDate" = d."calDate"
     AND n.age_band IS NOT DISTINCT FROM d.age_band AND n.gender = d.gender
WHERE {disease}"""


def rate_ctes(grain: str, window=WINDOW) -> tuple[str, ...]:
    return (
        *BASE, population(window), denominators(grain, window), PREPARED, in_window(grain, window),
        numerator("prevalent", "inside"), numerator("incident", "first_inside"),
        pair_numerator("pair_prevalent", "inside"), pair_numerator("pair_incident", "first_inside"),
    )


def name_of(column: str, names=None) -> str:
    return "CASE " + column + " " + " ".join(f"WHEN {k} THEN '{v}'" for k, v in (names or NAMES).items()) + " END"


def formatted(select: str, analysis: str, disease: bool, drug: bool, names=None) -> str:
    disease_id, disease_name = (
        ('CAST("diseaseId" AS VARCHAR)', name_of('"diseaseId"', names)) if disease else ("'Nil'", "'Nil'")
    )
    drug_id, drug_name = ('CAST("drugId" AS VARCHAR)', name_of('"drugId"', names)) if drug else ("'Nil'", "'Nil'")
    return f"""
SELECT 'retail' AS database, {disease_id} AS "diseaseId", {disease_name} AS "diseaseCohortName",
       {drug_id} AS "drugId", {drug_name} AS "drugCohortName", "calDate", {LABEL} AS "ageGroup",
       gender AS "Gender", "totalPatients", "Counts", rate, '{analysis}' AS analysis
FROM ({select})"""


def combined(diseases=DISEASES, drugs=DRUGS, names=None, disease: str = "d.cohort_id < 10") -> str:
    """The six analyses."""
    paired = [(c, pair_rates(f"pair_{c}", drugs, disease)) for c in ("prevalent", "incident")]
    return "\nUNION ALL\n".join(
        [
            formatted(cohort_rates("diseaseId", diseases, "incident"), "Incidence of Disease", True, False, names),
            formatted(cohort_rates("diseaseId", diseases, "prevalent"), "Prevalence of Disease", True, False, names),
            formatted(cohort_rates("drugId", drugs, "incident"), "Incidence of Drug", False, True, names),
            formatted(cohort_rates("drugId", drugs, "prevalent"), "Prevalence of Drug", False, True, names),
            formatted(paired[0][1], "Prevalence of Drug in Disease Cohort", True, True, names),
            formatted(paired[1][1], "incidence of Drug in Disease Cohort", True, True, names),
        ]
    )


COMBINED = combined()

COMBINED_CTE = f"\ncombined AS ({COMBINED})"
_FIXED = 'database, "diseaseId", "diseaseCohortName", "drugId", "drugCohortName", "calDate", analysis'


def _margin(age_group: str, gender: str, group: str) -> str:
    return f"""
    SELECT {_FIXED}, {age_group} AS "ageGroup", {gender} AS "Gender",
           CAST(SUM("totalPatients") AS BIGINT) AS "totalPatients", CAST(SUM("Counts") AS BIGINT) AS "Counts",
           SUM("Counts") / SUM("totalPatients") AS rate
    FROM combined GROUP BY {_FIXED}{group}"""


MARGINS_CTE = f"""
margins AS (
    SELECT {_FIXED}, "ageGroup", "Gender", "totalPatients", "Counts", rate FROM combined
    UNION ALL {_margin('"ageGroup"', "'All'", ', "ageGroup"')}
    UNION ALL {_margin("'All'", '"Gender"', ', "Gender"')}
    UNION ALL {_margin("'All'", "'All'", "")})"""


def masked(source: str) -> str:
    return f"""
SELECT * REPLACE (
    CASE WHEN "totalPatients" < 5 THEN '<5' ELSE CAST("totalPatients" AS VARCHAR) END AS "totalPatients",
    CASE WHEN "totalPatients" < 5 OR "Counts" = 0 THEN '0' WHEN "Counts" < 5 THEN '<5'
         ELSE CAST("Counts" AS VARCHAR) END AS "Counts",
    CASE WHEN "totalPatients" < 5 OR "Counts" < 5 THEN 0.0::DOUBLE ELSE rate END AS rate)
FROM {source}"""


def statement(ctes, select: str) -> str:
    return "WITH " + ",".join(ctes) + "\n" + select


def of_base(select: str, depth: int = len(BASE)) -> str:
    return statement(BASE[:depth], select)


_INDEX = "cohort_id, person_id, start_date, op_start_date, op_end_date, n_events"
_COHORT_ROWS = (
    "SELECT cohort_id AS cohort_definition_id, person_id AS subject_id, opened AS cohort_start_date, "
    "closed AS cohort_end_date FROM cohort"
)


def drug_eras(pad: int) -> str:
    exposure = """
exposure AS (
    SELECT person_id, start_date, end_date FROM drug_event WHERE codeset_id = 10 AND end_date >= start_date)"""
    era = eras("era", "exposure", "person_id", "start_date", "end_date", pad)
    return statement(
        (SOURCES, RESOLVED, EVENTS, exposure, era),
        "SELECT person_id, opened AS start_date, closed AS end_date FROM era",
    )


def observed_population(window) -> str:
    return statement(
        (SOURCES, population(window)),
        """SELECT subject_id, CAST(gender_concept_id AS INTEGER) AS gender_concept_id, gender, dob,
                  s AS cohort_start_date, e AS cohort_end_date, CAST(year(s) AS INTEGER) AS start_year,
                  CAST(year(e) AS INTEGER) AS end_year, CAST(sm AS DATE) AS start_month,
                  CAST(em AS DATE) AS end_month, COUNT(*) AS n_periods
           FROM observed GROUP BY ALL""",
    )


def population_counts(grain: str, window=WINDOW) -> str:
    return statement(
        (SOURCES, population(window), denominators(grain, window)),
        'SELECT "calDate", CAST(age_band AS INTEGER) AS age_band, gender, "totalPatients" FROM denominator',
    )


RANKED = """
ranked AS (
    SELECT *, CAST(bit_count(rule_mask) AS INTEGER) AS rule_count,
           CASE WHEN rule_0 THEN 0 WHEN rule_1 THEN 1 ELSE 0 END AS min_rule_id
    FROM qualified WHERE cohort_id >= 10),
best AS (
    SELECT * FROM (
        SELECT *, ROW_NUMBER() OVER (
            PARTITION BY cohort_id, person_id
            ORDER BY rule_count DESC, min_rule_id, start_date, op_start_date, op_end_date) AS place
        FROM ranked) WHERE place = 1),
moded AS (
    SELECT cohort_id, rule_0, rule_1, rule_mask, n_events AS n, 0 AS mode_id FROM ranked
    UNION ALL
    SELECT cohort_id, rule_0, rule_1, rule_mask, 1, 1 FROM best)"""


def impact(select: str) -> str:
    return statement((*BASE[:4], RANKED), select)


_RULE_STATS = " UNION ALL ".join(
    f"""SELECT CAST(g."drugId" AS INTEGER) AS cohort_definition_id, {rule} AS rule_sequence, m.mode_id,
        CAST(COALESCE(SUM(CASE WHEN rule_{rule} THEN n END), 0) AS BIGINT) AS person_count,
        CAST(COALESCE(SUM(CASE WHEN rule_{other} AND NOT rule_{rule} THEN n END), 0) AS BIGINT) AS gain_count,
        CAST(COALESCE(SUM(n), 0) AS BIGINT) AS person_total
    FROM {ids("drugId", DRUGS)} g CROSS JOIN (VALUES (0), (1)) m(mode_id)
    LEFT JOIN moded q ON q.cohort_id = g."drugId" AND q.mode_id = m.mode_id
    GROUP BY ALL"""
    for rule, other in ((0, 1), (1, 0))
)

_DOSE_COUNTS = ", ".join(
    f'CAST(COUNT(CASE WHEN cohort_id = {10 + i} THEN 1 END) AS BIGINT) AS "Counts_{label}"'
    for i, label in enumerate(("12", "25", "375", "50", "75", "100"), start=1)
)

DOSE = f"""
SELECT "calDate", {INTERVAL} AS "ageGroup", gender AS "Gender", "totalPatients",
       "Counts_12" + "Counts_25" + "Counts_375" + "Counts_50" + "Counts_75" + "Counts_100" AS "totalCounts",
       "Counts_12", "Counts_25", "Counts_375", "Counts_50", "Counts_75", "Counts_100",
       (12.0::DOUBLE * "Counts_12" + 25.0::DOUBLE * "Counts_25" + 37.5::DOUBLE * "Counts_375"
        + 50.0::DOUBLE * "Counts_50" + 75.0::DOUBLE * "Counts_75" + 100.0::DOUBLE * "Counts_100")
       / "totalPatients" AS rate
FROM (SELECT "calDate", age_band, gender,
             COUNT(DISTINCT CASE WHEN cohort_id = 10 THEN subject_id END) AS "totalPatients", {_DOSE_COUNTS}
      FROM inside GROUP BY ALL)
WHERE "totalPatients" > 0"""

PROFILE = f"""
SELECT i."diseaseId", {INTERVAL} AS "ageGroup", w.gender AS "Gender", w.n AS "totalPatients",
       COALESCE(d.n, 0) AS "Counts", COALESCE(d.n, 0) / w.n AS rate
FROM (SELECT age_band, gender, COUNT(DISTINCT subject_id) AS n FROM inside WHERE cohort_id = 10 GROUP BY ALL) w
CROSS JOIN {ids("diseaseId", DISEASES)} i
LEFT JOIN (SELECT cohort_id, age_band AS band, gender, COUNT(DISTINCT subject_id) AS n
           FROM inside GROUP BY ALL) d
  ON d.cohort_id = i."diseaseId" AND d.band IS NOT DISTINCT FROM w.age_band AND d.gender = w.gender"""


def several_domains() -> str:
    first = """
several AS (
    SELECT person_id, start_date FROM condition_event WHERE codeset_id = 1
    UNION ALL SELECT person_id, start_date FROM observation_event WHERE codeset_id = 1
    UNION ALL SELECT person_id, start_date FROM procedure_event WHERE codeset_id = 1),
first_of AS (
    SELECT t.person_id, MIN(t.start_date) AS start_date
    FROM several t JOIN op ON op.person_id = t.person_id AND t.start_date BETWEEN op.s AND op.e
    WHERE op.s + 365 <= t.start_date AND t.start_date >= DATE '1997-01-01' GROUP BY ALL)"""
    return statement(
        (SOURCES, RESOLVED, EVENTS, first),
        """SELECT 5 AS cohort_definition_id, f.person_id AS subject_id, f.start_date AS cohort_start_date,
                  LEAST(f.start_date + 1, op.e,
                        COALESCE((SELECT MIN(d.death_date) FROM death d WHERE d.person_id = f.person_id
                                  AND d.death_date BETWEEN f.start_date AND op.e), op.e)) AS cohort_end_date
           FROM first_of f JOIN op ON op.person_id = f.person_id AND f.start_date BETWEEN op.s AND op.e""",
    )


DOCUMENT_SETS = statement(
    (SOURCES,),
    """SELECT p_partkey * 4294967296 + 7 AS codeset_id, 10000 + p_partkey AS concept_id FROM part
       UNION ALL
       SELECT p_partkey * 4294967296 + 7, 100 + CAST(replace(p_brand, 'Brand#', '') AS BIGINT)
       FROM part WHERE p_size <= 25""",
)


# One row per stay, however many observation periods the person has.
ONCE = """
once AS (
    SELECT DISTINCT cohort_id, subject_id, opened, "calDate", age_band, gender FROM inside)"""

USERS = """
users AS (
    SELECT * FROM inside WHERE subject_id IN (SELECT subject_id FROM inside WHERE cohort_id = 10))"""

_SPARSE = 'VALUES (1, 10), (2, 11), (3, 16)'
SPARSE_RATES = statement(
    rate_ctes("year"),
    " UNION ALL ".join(
        f"""SELECT '{analysis}' AS analysis, r.* FROM ({pair_rates(counts)}) r
            SEMI JOIN ({_SPARSE}) p(a, b) ON r."diseaseId" = p.a AND r."drugId" = p.b"""
        for analysis, counts in (
            ("Prevalence of Drug in Disease Cohort", "pair_prevalent"),
            ("incidence of Drug in Disease Cohort", "pair_incident"),
        )
    ),
)


def from_documents() -> str:
    """The two written cohorts, word by word."""
    written = """
entered AS (
    SELECT 21 AS cohort_id, person_id, MIN(start_date) AS start_date
    FROM (SELECT t.person_id, t.start_date, op.s, op.e
          FROM (SELECT person_id, start_date FROM condition_event WHERE codeset_id = 1
                UNION ALL SELECT person_id, start_date FROM observation_event WHERE codeset_id = 1
                UNION ALL SELECT person_id, start_date FROM procedure_event WHERE codeset_id = 1) t
          JOIN op ON op.person_id = t.person_id AND t.start_date BETWEEN op.s AND op.e)
    WHERE s + 365 <= start_date AND start_date >= DATE '1997-01-01' GROUP BY person_id
    UNION ALL
    SELECT 22, l.person_id, l.ship_date
    FROM line l JOIN codeset c ON c.codeset_id = 2 AND c.concept_id = 10000 + l.l_partkey
    JOIN op ON op.person_id = l.person_id AND l.ship_date BETWEEN op.s AND op.e
    WHERE l.l_linenumber % 2 = 0 AND op.s + 180 <= l.ship_date AND l.ship_date + 30 <= op.e),
ended AS (
    SELECT t.cohort_id, t.person_id, t.start_date,
           CASE WHEN t.cohort_id = 22 THEN LEAST(t.start_date + 10, op.e)
                ELSE LEAST(t.start_date + 1, op.e,
                           COALESCE((SELECT MIN(d.death_date) FROM death d WHERE d.person_id = t.person_id
                                     AND d.death_date BETWEEN t.start_date AND op.e), op.e)) END AS exit_date
    FROM entered t JOIN op ON op.person_id = t.person_id AND t.start_date BETWEEN op.s AND op.e)"""
    era = eras("written_era", "ended", "cohort_id, person_id", "start_date", "exit_date")
    return statement(
        (SOURCES, RESOLVED, EVENTS, written, era),
        """SELECT cohort_id AS cohort_definition_id, person_id AS subject_id, opened AS cohort_start_date,
                  closed AS cohort_end_date FROM written_era""",
    )


def with_margins(grain: str, select: str) -> str:
    return statement((*rate_ctes(grain), COMBINED_CTE, MARGINS_CTE), select)


_EVENT = "codeset_id, person_id, start_date, end_date, visit_occurrence_id"

SQL: dict[str, str] = {
    "concept_set_descendants": of_base("SELECT * FROM codeset WHERE codeset_id = 2", 2),
    "concept_set_excluded": of_base("SELECT * FROM codeset WHERE codeset_id = 1", 2),
    "codesets_union": of_base("SELECT * FROM codeset", 2),
    "definition_concept_sets": DOCUMENT_SETS,
    "condition_events": of_base(f"SELECT {_EVENT} FROM condition_event", 3),
    "source_code_events": of_base(f"SELECT {_EVENT} FROM drug_event", 3),
    "multi_domain_events": of_base(
        " UNION ALL ".join(
            f"SELECT '{d}' AS domain, person_id, start_date, end_date, visit_occurrence_id "
            f"FROM {d}_event WHERE codeset_id = 1"
            for d in ("condition", "observation", "procedure")
        ),
        3,
    ),
    "death_events": of_base(
        "SELECT person_id, death_date AS start_date, death_date + 1 AS end_date FROM death", 1
    ),
    "primary_events_lookback": of_base(f"SELECT {_INDEX} FROM index_event", 4),
    "rule_at_least_one": of_base(f"SELECT {_INDEX} FROM qualified WHERE rule_0", 4),
    "rule_exactly_zero": of_base(f"SELECT {_INDEX} FROM qualified WHERE rule_1", 4),
    "rules_counting_occurrences": of_base(
        f"""SELECT {_INDEX},
               CASE WHEN (SELECT COUNT(*) FROM condition_event i
                          WHERE i.codeset_id = 3 AND i.person_id = q.person_id
                            AND i.start_date BETWEEN q.op_start_date AND LEAST(q.op_end_date, q.start_date + 30)) >= 2
                    THEN 1::BIGINT ELSE 0 END
             + CASE WHEN (SELECT COUNT(*) FROM condition_event i
                          WHERE i.codeset_id = 1 AND i.person_id = q.person_id
                            AND i.start_date BETWEEN q.op_start_date AND q.start_date) = 1
                    THEN 2::BIGINT ELSE 0 END AS rule_mask
            FROM index_event q WHERE cohort_id = 10""", 4
    ),
    "inclusion_mask": of_base(f"SELECT {_INDEX}, rule_mask FROM qualified", 4),
    "included_events": of_base(f"SELECT {_INDEX} FROM included", 4),
    "date_offset_exit": of_base(
        "SELECT cohort_id, person_id, start_date, op_end_date, LEAST(start_date + 1, op_end_date) AS end_date "
        "FROM included", 4
    ),
    "death_censor": of_base(
        "SELECT cohort_id, person_id, start_date, op_end_date, censor_date FROM censored "
        "WHERE censor_date IS NOT NULL", 4
    ),
    "first_exit": of_base("SELECT cohort_id, person_id, start_date, exit_date FROM stay", 4),
    "era_collapse": drug_eras(0),
    "era_collapse_padded": drug_eras(30),
    "cohort_disease": of_base(_COHORT_ROWS + " WHERE cohort_id < 10"),
    "cohort_drug": of_base(_COHORT_ROWS + " WHERE cohort_id >= 10"),
    "cohort_all": of_base(_COHORT_ROWS),
    "cohort_first_of_several_domains": several_domains(),
    "cohort_counts": of_base(
        f'SELECT cohort_id AS "cohortDefinitionId", {name_of("cohort_id")} AS "cohortName", '
        "COUNT(DISTINCT person_id) AS incidencecounts FROM cohort GROUP BY ALL"
    ),
    "observed_population": observed_population(WINDOW),
    "observed_population_narrow": observed_population(NARROW),
    "cohort_demographics": statement(
        (*BASE, population(), PREPARED),
        f"SELECT cohort_id AS cohort_definition_id, subject_id, opened AS cohort_start_date, "
        f"closed AS cohort_end_date, gender, dob, start_year, start_month, age, {INTERVAL} AS age_group "
        "FROM prepared",
    ),
    "age_groups": statement(
        (*BASE, population(), PREPARED),
        "SELECT age, CAST(age_band AS INTEGER) AS age_band, gender, COUNT(DISTINCT subject_id) AS subjects "
        "FROM prepared WHERE cohort_id < 10 GROUP BY ALL",
    ),
    "population_by_year": population_counts("year"),
    "population_by_month": population_counts("month"),
    "population_by_month_narrow": population_counts("month", NARROW),
    "dataset_counts": statement(
        (SOURCES, population()),
        "SELECT COUNT(DISTINCT subject_id) AS total_counts, "
        "CAST(SUM(round((e - s) / 365.25)) AS BIGINT) AS total_followup_yr FROM observed",
    ),
    "dose_summary": statement((*BASE, population(), PREPARED, in_window("year")), DOSE),
    "diagnosis_profile": statement((*BASE, population(), PREPARED, in_window("year")), PROFILE),
    "rates_combined_year_narrow": statement((*rate_ctes("year", NARROW), COMBINED_CTE), "SELECT * FROM combined"),
    "mask_small_cells": statement((*rate_ctes("year"), COMBINED_CTE), masked("combined")),
    "best_events": impact(
        "SELECT cohort_id, person_id, start_date, op_start_date, op_end_date, rule_count, min_rule_id, "
        "rule_mask, CAST(1 AS BIGINT) AS n_events FROM best"
    ),
    "inclusion_result": impact(
        "SELECT cohort_id AS cohort_definition_id, rule_mask AS inclusion_rule_mask, "
        "CAST(SUM(n) AS BIGINT) AS person_count, mode_id FROM moded GROUP BY ALL"
    ),
    "inclusion_stats": impact(_RULE_STATS),
    "attrition_summary": impact(
        f"""SELECT CAST(g."drugId" AS INTEGER) AS cohort_definition_id, m.mode_id,
               CAST(COALESCE(SUM(n), 0) AS BIGINT) AS base_count,
               CAST(COALESCE(SUM(CASE WHEN rule_0 AND rule_1 THEN n END), 0) AS BIGINT) AS final_count
        FROM {ids("drugId", DRUGS)} g CROSS JOIN (VALUES (0), (1)) m(mode_id)
        LEFT JOIN moded q ON q.cohort_id = g."drugId" AND q.mode_id = m.mode_id GROUP BY ALL"""
    ),
    "rates_view_year": with_margins(
        "year",
        """SELECT "diseaseCohortName", "drugCohortName", CAST("calDate" AS VARCHAR) AS "calDate", "ageGroup",
                  "Gender", round_even(rate * 100, 4) AS incidence_percent
           FROM margins
           WHERE "calDate" > 1996 AND analysis = 'Incidence of Disease' AND "diseaseCohortName" = 'disease one'
             AND "ageGroup" IN ('<18', '25-34', '>=65', 'All') AND "Gender" IN ('Female', 'All')""",
    ),
    "rates_view_month": with_margins(
        "month",
        """SELECT "diseaseCohortName", "drugCohortName", CAST("calDate" AS VARCHAR) AS "calDate", "ageGroup",
                  "Gender", round_even(rate * 100, 4) AS prevalence_percent
           FROM margins
           WHERE "calDate" > DATE '1996-12-31' AND analysis = 'Prevalence of Drug in Disease Cohort'
             AND "diseaseCohortName" = 'indications' AND "drugCohortName" = 'drug'
             AND "ageGroup" = 'All' AND "Gender" = 'All'""",
    ),
    "available_choices": statement(
        (*rate_ctes("year"), COMBINED_CTE),
        """SELECT DISTINCT 'disease' AS kind, "diseaseCohortName" AS name FROM combined
           WHERE analysis = 'Prevalence of Disease' AND "calDate" > 1996
           UNION ALL
           SELECT DISTINCT 'drug', "drugCohortName" FROM combined
           WHERE analysis = 'Prevalence of Drug in Disease Cohort' AND "diseaseCohortName" = 'disease one'
             AND "calDate" > 1996""",
    ),
    "cohort_from_definitions": from_documents(),
    "rates_sparse_pairs": SPARSE_RATES,
    "rates_floor_year": statement(
        (*rate_ctes("year", ("1997-01-01", WINDOW[1])), COMBINED_CTE), "SELECT * FROM combined"
    ),
    "dose_summary_per_person": statement(
        (*BASE, population(), PREPARED, in_window("year"), ONCE), DOSE.replace("FROM inside GROUP", "FROM once GROUP")
    ),
    "diagnosis_profile_in_drug": statement(
        (*BASE, population(), PREPARED, in_window("year"), USERS), PROFILE.replace("FROM inside GROUP BY ALL) d", "FROM users GROUP BY ALL) d")
    ),
}

for _grain in ("year", "month"):
    _ctes = rate_ctes(_grain)
    SQL |= {
        f"disease_incidence_{_grain}": statement(_ctes, cohort_rates("diseaseId", DISEASES, "incident")),
        f"disease_prevalence_{_grain}": statement(_ctes, cohort_rates("diseaseId", DISEASES, "prevalent")),
        f"drug_incidence_{_grain}": statement(_ctes, cohort_rates("drugId", DRUGS, "incident")),
        f"drug_prevalence_{_grain}": statement(_ctes, cohort_rates("drugId", DRUGS, "prevalent")),
        f"drug_in_disease_prevalence_{_grain}": statement(_ctes, pair_rates("pair_prevalent")),
        f"drug_in_disease_incidence_{_grain}": statement(_ctes, pair_rates("pair_incident")),
        f"rates_combined_{_grain}": statement((*_ctes, COMBINED_CTE), "SELECT * FROM combined"),
        f"rates_margins_{_grain}": with_margins(_grain, "SELECT * FROM margins"),
        f"masked_margins_{_grain}": with_margins(_grain, masked("margins")),
    }
