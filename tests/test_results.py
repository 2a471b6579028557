import datetime as dt
import random

from helpers import day, rows

from cohortloom.model import AT_LEAST, DRUG, CohortDefinition, Criterion, Rule
from cohortloom.operators import impact, population as pop, rates, views
from cohortloom.operators.counts import cohort_counts
from cohortloom.operators.disclosure import mask_small_cells
from cohortloom.operators.dose import Strength, dose_summary
from cohortloom.operators.events import CONDITION
from cohortloom.operators.margins import add_margins
from cohortloom.operators.profile import diagnosis_profile
from cohortloom.schemas import RATES_MONTH, RATES_YEAR
from cohortloom.session import local_frame

POPULATION = (
    "subject_id bigint, gender_concept_id int, gender string, dob date, cohort_start_date date, "
    "cohort_end_date date, start_year int, end_year int, start_month date, end_month date, n_periods bigint"
)
COHORT = "cohort_definition_id int, subject_id bigint, cohort_start_date date, cohort_end_date date"
DISEASES, DRUGS = [1, 2], [10, 11]
PAIRS = [(a, b) for a in DISEASES for b in DRUGS]


def span(subject, start, end, gender="Male", dob="1980-01-01", n=1):
    s, e = day(start), day(end)
    return (subject, 0, gender, day(dob), s, e, s.year, e.year, s.replace(day=1), e.replace(day=1), n)


def population(spark, *spans):
    return local_frame(spark, spans, POPULATION)


def test_observed_population_filters_and_labels(spark, make_tables):
    def op(person, start, end):
        return {
            "person_id": person, "observation_period_start_date": day(start), "observation_period_end_date": day(end),
        }

    tables = make_tables(
        person=[
            {"person_id": 1, "gender_concept_id": 8507, "year_of_birth": 1980},
            {"person_id": 2, "gender_concept_id": 8532, "year_of_birth": 1981, "month_of_birth": 2, "day_of_birth": 3},
            {"person_id": 3, "gender_concept_id": 1},
            {"person_id": 4, "gender_concept_id": 1, "year_of_birth": 1990},
        ],
        observation_period=[
            op(1, "2010-03-04", "2012-01-01"), op(1, "2010-03-04", "2012-01-01"), op(1, "2005-01-01", "2011-12-31"),
            op(2, "2021-12-31", "2030-01-01"), op(3, "2013-01-01", "2014-01-01"), op(4, "2022-01-01", "2023-01-01"),
            op(9, "2013-01-01", "2014-01-01"),
        ],
    )
    found = pop.observed_population(tables["person"], tables["observation_period"], 2012, 2021)
    assert rows(found, "subject_id", "gender", "dob", "start_year", "end_month", "n_periods") == [
        (1, "Male", day("1980-07-01"), 2010, day("2012-01-01"), 2),
        (2, "Female", day("1981-02-03"), 2021, day("2030-01-01"), 1),
    ]


def test_demographics_repeat_rows_per_period(spark):
    people = population(spark, span(1, "2010-01-01", "2012-06-01"), span(1, "2013-01-01", "2014-01-01", n=2))
    cohort = local_frame(
        spark, [(1, 1, day("2011-05-06"), day("2011-05-07")), (1, 7, day("2011-05-06"), day("2011-05-07"))], COHORT
    )
    prepared = pop.attach_demographics(cohort, people)
    assert rows(prepared, "subject_id", "n_periods", "start_year", "start_month", "age", "age_band") == [
        (1, 3, 2011, day("2011-05-01"), 31, 2)
    ]
    assert rows(pop.expand_periods(prepared), "subject_id", "age_group") == [(1, "(24,34]")] * 3


def test_population_counts_a_subject_once_however_many_periods(spark):
    people = population(
        spark,
        span(1, "2012-01-15", "2012-03-01"), span(1, "2012-03-20", "2013-02-02"), span(1, "2012-02-01", "2012-02-02"),
        span(2, "2000-01-01", "2030-01-01", "Female", "1995-07-01"),
    )
    assert rows(pop.population_by_year(people, 2012, 2014), "calDate", "age_band", "gender", "totalPatients") == [
        (2012, 0, "Female", 1), (2012, 2, "Male", 1), (2013, 1, "Female", 1), (2013, 2, "Male", 1),
        (2014, 1, "Female", 1),
    ]
    monthly = rows(pop.population_by_month(people, "2012-02-10", "2013-03-31"), "calDate", "gender", "totalPatients")
    assert [m for m, g, _ in monthly if g == "Female"] == [m for m in months("2012-02-01", "2013-03-01")]
    assert [m for m, g, _ in monthly if g == "Male"] == [m for m in months("2012-02-01", "2013-02-01")]
    assert {n for _, _, n in monthly} == {1}


def months(first, last):
    at = day(first)
    while at <= day(last):
        yield at
        at = (at + dt.timedelta(days=32)).replace(day=1)


def test_dataset_counts_round_each_period(spark):
    people = population(
        spark, span(1, "2010-01-01", "2010-06-01"), span(1, "2011-01-01", "2012-09-01", n=2), span(2, "2010-01-01", "2011-01-01")
    )
    assert rows(pop.dataset_counts(people)) == [(2, 0 + 2 * 2 + 1)]


def random_study(spark, seed):
    rng = random.Random(seed)
    people = {
        s: (rng.choice(["Male", "Female"]), day(f"{rng.choice([1900, 1940, 1970, 1990, 2013, 2016])}-03-0{rng.randint(1, 9)}"))
        for s in range(1, 40)
    }
    spans = [
        span(s, f"201{rng.randint(0, 2)}-0{rng.randint(1, 9)}-05", f"201{rng.randint(3, 5)}-0{rng.randint(1, 9)}-20", g, str(b))
        for s, (g, b) in people.items() for _ in range(rng.randint(1, 2))
    ]
    eras = {
        (c, s, dt.date(2012 + rng.randint(0, 2), rng.randint(1, 12), rng.randint(1, 28)))
        for s in people for c in DISEASES + DRUGS for _ in range(rng.randint(0, 4))
    }
    cohort = local_frame(spark, [(c, s, d, d) for c, s, d in sorted(eras)], COHORT)
    return people, spans, eras, pop.attach_demographics(cohort, population(spark, *spans)), population(spark, *spans)


def band(dob, year):
    age = year - dob.year - ((dob.month, dob.day) > (7, 1))
    if dob > dt.date(year, 7, 1):
        age = -(dob.year - year - ((dob.month, dob.day) < (7, 1)))
    if not 0 <= age <= 150:
        return None
    return sum(age > last for last in (17, 24, 34, 44, 54, 64))


def brute_force(people, spans, eras, grain):
    """Every analysis by sets of subjects."""
    def period(d):
        return d.year if grain == rates.YEAR else d.replace(day=1)

    def year(p):
        return p if grain == rates.YEAR else p.year

    calendar = [2012, 2013, 2014] if grain == rates.YEAR else list(months("2012-01-01", "2014-12-01"))
    total = {}
    for p in calendar:
        for s in people:
            if any(
                s == x[0] and (x[6] <= p <= x[7] if grain == rates.YEAR else x[8] <= p <= x[9]) for x in spans
            ):
                total.setdefault((p, band(people[s][1], year(p)), people[s][0]), set()).add(s)
    entered, first = {}, {}
    for c, s, d in eras:
        stratum = (period(d), band(people[s][1], d.year), people[s][0])
        entered.setdefault((c, stratum), set()).add(s)
        if d == min(x for cc, ss, x in eras if (cc, ss) == (c, s)):
            first.setdefault((c, stratum), set()).add(s)
    found = set()
    for kind, counted, single in ((rates.FIRST, first, 0), (rates.ANY, entered, 1)):
        for name, ids, place in (
            (("Incidence of Disease", "Prevalence of Disease")[single], DISEASES, 0),
            (("Incidence of Drug", "Prevalence of Drug")[single], DRUGS, 1),
        ):
            for stratum, subjects in total.items():
                for c in ids:
                    who = (c, None) if place == 0 else (None, c)
                    found.add((name, *who, *stratum, len(subjects), len(counted.get((c, stratum), ()))))
        name = ("incidence of Drug in Disease Cohort", "Prevalence of Drug in Disease Cohort")[single]
        for disease, drug in PAIRS:
            for (c, stratum), subjects in entered.items():
                if c == disease:
                    both = subjects & counted.get((drug, stratum), set())
                    found.add((name, disease, drug, *stratum, len(subjects), len(both)))
    return found


def test_all_rates_equal_brute_force(spark):
    for seed, grain in ((1, rates.YEAR), (2, rates.MONTH)):
        people, spans, eras, prepared, observed = random_study(spark, seed)
        denominator = (
            pop.population_by_year(observed, 2012, 2014)
            if grain == rates.YEAR
            else pop.population_by_month(observed, "2012-01-01", "2014-12-31")
        )
        inside = rates.within_months(prepared, "2012-01-01", "2014-12-31")
        profiles = rates.stratum_profiles(inside, DISEASES + DRUGS, grain)
        found = rates.compute_rates(denominator, profiles, PAIRS)
        columns = ["analysis", "diseaseId", "drugId", "calDate", "age_band", "gender", "totalPatients", "Counts"]
        listed = rows(found, *columns)
        assert len(listed) == len(set(listed))
        assert set(listed) == brute_force(people, spans, eras, grain)


def test_more_cohorts_than_bits_in_a_word(spark):
    ids = list(range(1, 131))
    people = population(spark, span(1, "2010-01-01", "2015-01-01"))
    cohort = local_frame(
        spark,
        [(c, 1, d, d) for c in (1, 62, 63, 64, 124, 125, 130) for d in (day("2012-02-02"), day("2013-02-02"))],
        COHORT,
    )
    profiles = rates.stratum_profiles(pop.attach_demographics(cohort, people), ids, rates.YEAR)
    pairs = [(c, 130) for c in ids if c != 130]
    prevalent = rates.compute_rates(
        pop.population_by_year(people, 2012, 2013), profiles, pairs, [rates.PREVALENCE_OF_DISEASE]
    ).where("Counts > 0")
    assert rows(prevalent, "diseaseId", "calDate") == [
        (c, y) for c in (1, 62, 63, 64, 124, 125) for y in (2012, 2013)
    ]
    incident = rates.compute_rates(None, profiles, pairs, [rates.INCIDENCE_OF_DRUG_IN_DISEASE]).where("Counts > 0")
    assert rows(incident, "diseaseId", "drugId", "calDate") == [(c, 130, 2012) for c in (1, 62, 63, 64, 124, 125)]


def test_plans_do_not_grow_with_the_number_of_cohorts(spark):
    """Five hundred cohorts have a few words more than fifty, and no expression of their own."""
    people = population(spark, span(1, "2010-01-01", "2015-01-01"))

    def of(n):
        days = [(c, 1, day("2012-02-02"), day("2012-02-02")) for c in (1, n - 1, n)]
        prepared = pop.attach_demographics(local_frame(spark, days, COHORT), people)
        profiles = rates.stratum_profiles(prepared, range(1, n + 1), rates.YEAR)
        pairs = [(c, g) for c in range(1, n - 9) for g in range(n - 9, n + 1)]
        found = rates.compute_rates(pop.population_by_year(people, 2012, 2012), profiles, pairs)
        return found, len(found._jdf.queryExecution().optimizedPlan().toString())

    few, size = of(50)
    many, most = of(500)
    assert most < 3 * size
    assert "NestedLoopJoin" not in many._jdf.queryExecution().executedPlan().toString()
    both = many.where("Counts > 0 and analysis = 'Prevalence of Drug in Disease Cohort'")
    assert rows(both, "diseaseId", "drugId", "Counts", "totalPatients") == [(1, 499, 1, 1), (1, 500, 1, 1)]
    assert many.where("analysis = 'Incidence of Disease'").count() == 490


def test_first_entry_is_the_first_inside_the_window(spark):
    people = population(spark, span(1, "2010-01-01", "2015-01-01"))
    cohort = local_frame(
        spark, [(1, 1, day(d), day(d)) for d in ("2011-05-05", "2013-04-04", "2014-01-01")], COHORT
    )
    inside = rates.within_months(pop.attach_demographics(cohort, people), "2012-01-15", "2014-12-31")
    profiles = rates.stratum_profiles(inside, [1, 10], rates.YEAR)
    found = rates.compute_rates(
        pop.population_by_year(people, 2012, 2014), profiles, [(1, 10)], [rates.INCIDENCE_OF_DISEASE]
    )
    assert rows(found, "calDate", "Counts") == [(2012, 0), (2013, 1), (2014, 0)]


def result(spark, *cells, schema=RATES_YEAR):
    """Cells are (calDate, ageGroup, Gender, total, count)."""
    return local_frame(
        spark,
        [("db", "1", "ill", "Nil", "Nil", c, a, g, t, n, n / t, "Incidence of Disease") for c, a, g, t, n in cells],
        schema,
    )


def test_format_names_and_sentinels(spark):
    found = local_frame(
        spark,
        [("Incidence of Drug", None, 10, 2012, None, "Male", 4, 1, 0.25), ("x", 1, 10, 2012, 6, "Male", 4, 1, 0.25),
         ("x", 99, 10, 2012, 6, "Male", 4, 1, 0.25)],
        "analysis string, diseaseId int, drugId int, calDate int, age_band int, gender string, "
        "totalPatients bigint, Counts bigint, rate double",
    )
    registry = rates.registry_frame(spark, [(1, "ill"), (10, "patch")])
    named = rates.format_rates(found, registry, "db")
    assert named.columns == RATES_YEAR.names
    assert rows(named, "diseaseId", "diseaseCohortName", "drugId", "drugCohortName", "ageGroup") == [
        ("1", "ill", "10", "patch", ">=65"), ("Nil", "Nil", "10", "patch", None),
    ]


def test_margins_keep_unknown_age_apart(spark):
    base = result(
        spark, (2012, "<18", "Male", 10, 1), (2012, "<18", "Female", 20, 2), (2012, None, "Male", 5, 5)
    )
    assert rows(add_margins(base), "ageGroup", "Gender", "totalPatients", "Counts") == [
        (None, "All", 5, 5), (None, "Male", 5, 5),
        ("<18", "All", 30, 3), ("<18", "Female", 20, 2), ("<18", "Male", 10, 1),
        ("All", "All", 35, 8), ("All", "Female", 20, 2), ("All", "Male", 15, 6),
    ]


def test_masking(spark):
    base = result(
        spark, *[(2012, "<18", g, t, n) for g, t, n in (("a", 4, 3), ("b", 5, 0), ("c", 5, 4), ("d", 9, 5), ("e", 4, 0))]
    )
    assert rows(mask_small_cells(base, 5), "Gender", "totalPatients", "Counts", "rate") == [
        ("a", "<5", "0", 0.0), ("b", "5", "0", 0.0), ("c", "5", "<5", 0.0), ("d", "9", "5", 5 / 9),
        ("e", "<5", "0", 0.0),
    ]
    assert rows(mask_small_cells(base, 0), "Gender", "Counts") == [
        ("a", "3"), ("b", "0"), ("c", "4"), ("d", "5"), ("e", "0")
    ]


PREPARED = (
    "cohort_definition_id int, subject_id bigint, gender string, n_periods bigint, start_year int, age_band int"
)


def test_dose_counts_patients_once_and_eras_per_period(spark):
    prepared = local_frame(
        spark,
        [
            (10, 1, "Male", 2, 2012, 3), (10, 1, "Male", 2, 2012, 3), (10, 2, "Male", 1, 2012, 3),
            (11, 1, "Male", 2, 2012, 3), (11, 2, "Male", 1, 2012, 3), (12, 2, "Male", 1, 2012, 3),
            (11, 3, "Male", 1, 2013, 3), (10, 4, "Male", 1, 2013, None),
        ],
        PREPARED,
    )
    strengths = [Strength("12", 11, 12.0), Strength("375", 12, 37.5), Strength("75", 12, 75.0)]
    found = dose_summary(prepared, 10, strengths)
    assert found.columns == [
        "calDate", "ageGroup", "Gender", "totalPatients", "totalCounts", "Counts_12", "Counts_375", "Counts_75", "rate",
    ]
    assert rows(found) == [
        (2012, "(34,44]", "Male", 2, 5, 3, 1, 1, (12 * 3 + 37.5 + 75) / 2), (2013, None, "Male", 1, 0, 0, 0, 0, 0.0),
    ]


def test_profile_counts_disease_patients_without_the_drug(spark):
    prepared = local_frame(
        spark,
        [(10, 1, "Male", 1, 2012, 3), (10, 1, "Male", 1, 2013, 3), (1, 5, "Male", 1, 2012, 3),
         (1, 6, "Male", 1, 2012, 3), (1, 6, "Male", 1, 2014, 3), (2, 7, "Female", 1, 2012, 3)],
        PREPARED,
    )
    found = diagnosis_profile(prepared, 10, [1, 2])
    assert rows(found) == [(1, "(34,44]", "Male", 1, 2, 2.0), (2, "(34,44]", "Male", 1, 0, 0.0)]


QUALIFIED = (
    "cohort_id int, person_id bigint, start_date date, op_start_date date, op_end_date date, "
    "rule_mask bigint, n_events bigint"
)


def qualified(spark):
    a, z = day("2010-01-01"), day("2020-01-01")
    return local_frame(
        spark,
        [
            (10, 1, day("2012-01-01"), a, z, 0, 2), (10, 1, day("2013-01-01"), a, z, 2, 1),
            (10, 1, day("2014-01-01"), a, z, 1, 1), (10, 2, day("2012-05-01"), a, z, 3, 4),
            (10, 2, day("2012-01-01"), a, z, 2, 1), (10, 3, day("2012-03-01"), a, z, 0, 1),
        ],
        QUALIFIED,
    )


RULE = Rule(CONDITION, 1, AT_LEAST, 1)
RULED = [
    CohortDefinition(10, "patch", DRUG, (Criterion(CONDITION, 1),), (RULE, RULE)),
    CohortDefinition(20, "nobody", DRUG, (Criterion(CONDITION, 1),), (RULE, RULE)),
]


def test_best_event_has_most_rules_then_the_earliest_rule(spark):
    best = impact.best_events(qualified(spark))
    assert rows(best, "person_id", "start_date", "rule_count", "min_rule_id", "rule_mask") == [
        (1, day("2014-01-01"), 1, 0, 1), (2, day("2012-05-01"), 2, 0, 3), (3, day("2012-03-01"), 0, 0, 0),
    ]


def test_rule_impact(spark):
    catalogue = impact.rule_catalogue(spark, RULED)
    events = impact.inclusion_result(qualified(spark), impact.ALL_EVENTS)
    assert rows(events) == [(10, 0, 3, 0), (10, 1, 1, 0), (10, 2, 2, 0), (10, 3, 4, 0)]
    assert rows(impact.inclusion_stats(events, catalogue, 0)) == [
        (10, 0, 5, 2, 10, 0), (10, 1, 6, 1, 10, 0), (20, 0, 0, 0, 0, 0), (20, 1, 0, 0, 0, 0),
    ]
    assert rows(impact.attrition_summary(events, catalogue, 0)) == [(10, 10, 4, 0), (20, 0, 0, 0)]
    best = impact.inclusion_result(qualified(spark), impact.BEST_EVENT)
    assert rows(best) == [(10, 0, 1, 1), (10, 1, 1, 1), (10, 3, 1, 1)]
    assert rows(impact.attrition_summary(best, catalogue, 1)) == [(10, 3, 1, 1), (20, 0, 0, 1)]


def test_counts_leave_out_empty_cohorts(spark):
    cohort = local_frame(
        spark, [(1, s, day("2012-01-01"), day("2012-01-01")) for s in (5, 5, 6)], COHORT
    )
    registry = rates.registry_frame(spark, [(1, "ill"), (2, "nobody")])
    assert rows(cohort_counts(cohort, registry)) == [(1, "ill", 2)]


def test_view_of_yearly_and_monthly_rates(spark):
    yearly = add_margins(result(spark, (2016, "<18", "Male", 7, 1), (2017, "<18", "Male", 7, 1), (2018, "<18", "Male", 9, 0)))
    choice = dict(database="db", analysis="Incidence of Disease", disease="ill", drug="Nil")
    shown = views.rates_view(yearly, **choice)
    assert shown.columns[-1] == "Incidence(%)"
    assert rows(shown, "calDate", "ageGroup", "Incidence(%)") == [("2017", "All", 14.2857), ("2018", "All", 0.0)]
    monthly = result(
        spark, (day("2016-12-01"), "<18", "Male", 7, 1), (day("2017-01-01"), "<18", "Male", 7, 1), schema=RATES_MONTH
    )
    shown = views.rates_view(monthly, **choice, age_groups=["<18"], genders=["Male", "Female"])
    assert rows(shown, "calDate") == [("2017-01-01",)]


def test_choices(spark):
    analyses = [("Incidence of Disease", "ill", "Nil"), ("Incidence of Disease", "worse", "Nil"),
                ("Prevalence of Drug in Disease Cohort", "ill", "patch"),
                ("Prevalence of Drug in Disease Cohort", "worse", "other")]
    base = local_frame(spark, analyses, "analysis string, diseaseCohortName string, drugCohortName string")
    assert rows(views.available_diseases(base, "Incidence of Disease")) == [("ill",), ("worse",)]
    assert rows(views.available_drugs(base, "Incidence of Disease", "ill")) == [("Nil",)]
    assert rows(views.available_drugs(base, "Prevalence of Drug in Disease Cohort", "worse")) == [("other",)]


def test_only_listed_pairs_are_counted(spark):
    people = population(spark, span(1, "2010-01-01", "2015-01-01"))
    cohort = local_frame(spark, [(c, 1, d, d) for c in (1, 2, 10, 11) for d in (day("2012-02-02"),)], COHORT)
    profiles = rates.stratum_profiles(pop.attach_demographics(cohort, people), [1, 2, 10, 11], rates.YEAR)
    listed = [(1, 10), (2, 11)]
    counts = rates.analysis_counts(profiles, listed, [rates.PREVALENCE_OF_DRUG_IN_DISEASE])
    assert rows(counts, "diseaseId", "drugId") == listed


def test_profile_of_those_who_use_the_drug(spark):
    prepared = local_frame(
        spark,
        [(10, 1, "Male", 1, 2012, 3), (1, 1, "Male", 1, 2012, 3), (1, 6, "Male", 1, 2012, 3),
         (10, 7, "Male", 1, 2012, 2), (1, 7, "Male", 1, 2014, 3)],
        PREPARED,
    )
    found = diagnosis_profile(prepared, 10, [1], restrict_to_drug=True)
    assert rows(found) == [(1, "(24,34]", "Male", 1, 0, 0.0), (1, "(34,44]", "Male", 1, 2, 2.0)]


def test_dose_without_a_count_per_period(spark):
    prepared = local_frame(spark, [(10, 1, "Male", 3, 2012, 3), (11, 1, "Male", 3, 2012, 3)], PREPARED)
    for fanout, eras in ((True, 3), (False, 1)):
        found = dose_summary(prepared, 10, [Strength("12", 11, 12.0)], fanout)
        assert rows(found, "totalPatients", "Counts_12", "rate") == [(1, eras, 12.0 * eras)]
