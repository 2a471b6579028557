import datetime as dt
import random
from dataclasses import replace

from helpers import day, rows
from pyspark.sql import functions as F

from cohortloom.model import AT_LEAST, DISEASE, DRUG, EXACTLY, CohortDefinition, Criterion, Rule
from cohortloom.operators import impact
from cohortloom.operators.concepts import source_codes
from cohortloom.operators.events import CONDITION, DRUG as DRUG_CONCEPT, DRUG_SOURCE, OBSERVATION, domain_events
from cohortloom.operators.rules import meets_all_rules
from cohortloom.plans.cohorts import Codes, build_cohorts, qualified_events
from cohortloom.session import local_frame

ILL, INDICATED, CANCER, PATCH = 1, 2, 3, 10


def period(person, start="2010-01-01", end="2015-12-31"):
    return {
        "person_id": person,
        "observation_period_start_date": day(start),
        "observation_period_end_date": day(end),
    }


def condition(person, concept, start):
    return {"person_id": person, "condition_concept_id": concept, "condition_start_date": day(start)}


def exposure(person, start, code="A"):
    return {"person_id": person, "drug_source_value": code, "drug_exposure_start_date": day(start)}


def death(person, on):
    return {"person_id": person, "death_date": day(on)}


def codes(spark):
    concepts = local_frame(
        spark, [(ILL, 100), (ILL, 101), (INDICATED, 200), (CANCER, 300)], "codeset_id bigint, concept_id bigint"
    )
    return Codes(concepts, source_codes(spark, PATCH, ["A", "B"]))


DISEASE_COHORT = CohortDefinition(ILL, "ill", DISEASE, (Criterion(CONDITION, ILL),))
RULES = (Rule(CONDITION, INDICATED, AT_LEAST, 1, days_after=0), Rule(CONDITION, CANCER, EXACTLY, 0))
PATCH_COHORT = CohortDefinition(PATCH, "patch", DRUG, (Criterion(DRUG_SOURCE, PATCH),), RULES)


def built(spark, tables, *definitions):
    return rows(build_cohorts(tables, codes(spark), definitions or (DISEASE_COHORT,)))


def starts(spark, tables, *definitions):
    return [(person, str(start)) for _, person, start, _ in built(spark, tables, *definitions)]


def test_look_back_and_last_day(spark, make_tables):
    tables = make_tables(
        observation_period=[period(p) for p in (1, 2, 3, 4)],
        condition_occurrence=[
            condition(1, 100, "2011-01-01"), condition(2, 100, "2010-12-31"),
            condition(3, 100, "2015-12-31"), condition(4, 100, "2016-01-01"),
        ],
    )
    assert starts(spark, tables) == [(1, "2011-01-01"), (3, "2015-12-31")]


def test_time_after_the_event_may_be_required(spark, make_tables):
    tables = make_tables(
        observation_period=[period(1), period(2)],
        condition_occurrence=[condition(1, 100, "2015-12-01"), condition(2, 100, "2015-12-02")],
    )
    cohort = CohortDefinition(ILL, "ill", DISEASE, (Criterion(CONDITION, ILL),), post_days=30)
    assert starts(spark, tables, cohort) == [(1, "2015-12-01")]


def test_exit_is_clamped_to_the_period(spark, make_tables):
    tables = make_tables(
        observation_period=[period(1), period(2)],
        condition_occurrence=[condition(1, 100, "2012-05-05"), condition(2, 100, "2015-12-31")],
    )
    assert built(spark, tables) == [
        (ILL, 1, day("2012-05-05"), day("2012-05-06")), (ILL, 2, day("2015-12-31"), day("2015-12-31")),
    ]


def test_death_ends_a_stay_only_from_the_index_day_to_the_end_of_the_period(spark, make_tables):
    tables = make_tables(
        observation_period=[period(p) for p in (1, 2, 3, 4)],
        condition_occurrence=[condition(p, 100, "2012-05-05") for p in (1, 2, 3)] + [condition(4, 100, "2015-12-31")],
        death=[
            death(1, "2012-05-05"), death(2, "2012-05-04"), death(3, "2012-05-04"), death(3, "2012-05-05"),
            death(4, "2016-01-01"),
        ],
    )
    ends = {person: end for _, person, _, end in built(spark, tables)}
    assert ends == {
        1: day("2012-05-05"), 2: day("2012-05-06"), 3: day("2012-05-05"), 4: day("2015-12-31"),
    }


def test_death_is_ignored_where_a_cohort_does_not_censor(spark, make_tables):
    tables = make_tables(
        observation_period=[period(1)], condition_occurrence=[condition(1, 100, "2012-05-05")],
        death=[death(1, "2012-05-05")],
    )
    cohort = CohortDefinition(ILL, "ill", DISEASE, (Criterion(CONDITION, ILL),), censor_at_death=False, exit_days=3)
    assert built(spark, tables, cohort) == [(ILL, 1, day("2012-05-05"), day("2012-05-08"))]


def test_touching_stays_become_one_era(spark, make_tables):
    tables = make_tables(
        observation_period=[period(1)],
        condition_occurrence=[
            condition(1, 100, d) for d in ("2012-05-05", "2012-05-06", "2012-05-06", "2012-05-08")
        ],
    )
    assert built(spark, tables) == [
        (ILL, 1, day("2012-05-05"), day("2012-05-07")), (ILL, 1, day("2012-05-08"), day("2012-05-09")),
    ]


def test_era_pad_is_per_cohort(spark, make_tables):
    tables = make_tables(
        observation_period=[period(1)],
        condition_occurrence=[condition(1, 100, "2012-05-05"), condition(1, 100, "2012-05-08")],
    )
    padded = CohortDefinition(77, "padded", DISEASE, (Criterion(CONDITION, ILL),), era_pad=2)
    assert built(spark, tables, DISEASE_COHORT, padded) == [
        (ILL, 1, day("2012-05-05"), day("2012-05-06")), (ILL, 1, day("2012-05-08"), day("2012-05-09")),
        (77, 1, day("2012-05-05"), day("2012-05-09")),
    ]


def test_indication_up_to_the_index_day(spark, make_tables):
    tables = make_tables(
        observation_period=[period(p) for p in (1, 2, 3)],
        drug_exposure=[exposure(p, "2013-03-03") for p in (1, 2, 3)],
        condition_occurrence=[
            condition(1, 200, "2013-03-03"), condition(2, 200, "2013-03-04"), condition(3, 200, "2009-12-31"),
        ],
    )
    assert starts(spark, tables, PATCH_COHORT) == [(1, "2013-03-03")]


def test_indication_on_the_first_day_of_the_period_counts(spark, make_tables):
    tables = make_tables(
        observation_period=[period(1)], drug_exposure=[exposure(1, "2013-03-03")],
        condition_occurrence=[condition(1, 200, "2010-01-01")],
    )
    assert starts(spark, tables, PATCH_COHORT) == [(1, "2013-03-03")]


def test_exclusion_anywhere_in_the_same_period(spark, make_tables):
    tables = make_tables(
        observation_period=[
            period(1), period(2, "2010-01-01", "2012-12-31"), period(2, "2013-01-01", "2015-12-31"), period(3),
        ],
        drug_exposure=[exposure(1, "2012-03-03"), exposure(2, "2012-03-03"), exposure(3, "2012-03-03", "C")],
        condition_occurrence=[condition(p, 200, "2012-01-01") for p in (1, 2, 3)]
        + [condition(1, 300, "2015-12-31"), condition(2, 300, "2013-01-01")],
    )
    assert starts(spark, tables, PATCH_COHORT) == [(2, "2012-03-03")]


def test_several_occurrences_may_be_required(spark, make_tables):
    rule = Rule(CONDITION, INDICATED, AT_LEAST, 2, days_after=0)
    cohort = CohortDefinition(PATCH, "patch", DRUG, (Criterion(DRUG_SOURCE, PATCH),), (rule,))
    tables = make_tables(
        observation_period=[period(p) for p in (1, 2, 3)],
        drug_exposure=[exposure(p, "2013-03-03") for p in (1, 2, 3)],
        condition_occurrence=[
            condition(1, 200, "2013-01-01"), condition(1, 200, "2013-01-01"),
            condition(2, 200, "2013-01-01"), condition(2, 200, "2013-03-04"),
            condition(3, 200, "2013-01-01"),
        ],
    )
    assert starts(spark, tables, cohort) == [(1, "2013-03-03")]


def test_repeated_periods_do_not_repeat_criterion_events(spark, make_tables):
    rule = Rule(CONDITION, INDICATED, AT_LEAST, 2, days_after=0)
    cohort = CohortDefinition(PATCH, "patch", DRUG, (Criterion(DRUG_SOURCE, PATCH),), (rule,))
    tables = make_tables(
        observation_period=[period(1), period(1)], drug_exposure=[exposure(1, "2013-03-03")],
        condition_occurrence=[condition(1, 200, "2013-01-01")],
    )
    events = qualified_events(tables, codes(spark), (cohort,))
    assert rows(events, "n_events", "rule_mask") == [(2, 0)]


def test_events_in_overlapping_periods_are_kept_per_period(spark, make_tables):
    tables = make_tables(
        observation_period=[period(1), period(1, "2010-06-01", "2014-12-31")],
        condition_occurrence=[condition(1, 100, "2012-05-05")],
    )
    events = qualified_events(tables, codes(spark), (DISEASE_COHORT,))
    assert rows(events, "op_start_date", "n_events") == [(day("2010-01-01"), 1), (day("2010-06-01"), 1)]
    assert built(spark, tables) == [(ILL, 1, day("2012-05-05"), day("2012-05-06"))]


def test_only_the_first_event_where_asked(spark, make_tables):
    first = CohortDefinition(
        5, "first", DISEASE,
        (Criterion(CONDITION, ILL, start_from=day("2012-01-01")), Criterion(OBSERVATION, ILL)), first_only=True,
    )
    tables = make_tables(
        observation_period=[period(1), period(2)],
        condition_occurrence=[
            condition(1, 100, "2011-06-01"), condition(1, 100, "2012-06-01"), condition(1, 101, "2013-06-01"),
            condition(2, 100, "2013-06-01"),
        ],
        observation=[{"person_id": 2, "observation_concept_id": 101, "observation_date": day("2011-06-01")}],
    )
    found = starts(spark, tables, first, DISEASE_COHORT)
    assert [f for f in found if f[0] == 2 or f[1] == "2012-06-01"].count((2, "2011-06-01")) == 1
    assert rows(build_cohorts(tables, codes(spark), (first,)), "subject_id", "cohort_start_date") == [
        (1, day("2012-06-01")), (2, day("2011-06-01")),
    ]


def test_cohorts_of_one_plan_equal_cohorts_built_alone(spark, make_tables):
    tables = make_tables(
        observation_period=[period(p) for p in range(1, 6)],
        drug_exposure=[exposure(p, f"201{p % 4 + 1}-03-0{p}") for p in range(1, 6)],
        condition_occurrence=[condition(p, c, f"2011-0{p}-02") for p in range(1, 6) for c in (100, 200)]
        + [condition(4, 300, "2012-02-02")],
    )
    together = built(spark, tables, DISEASE_COHORT, PATCH_COHORT)
    assert together == built(spark, tables, DISEASE_COHORT) + built(spark, tables, PATCH_COHORT)
    assert {r[0] for r in together} == {ILL, PATCH}


def test_drug_events_end_by_end_date_supply_or_next_day(spark, make_tables):
    tables = make_tables(
        drug_exposure=[
            {**exposure(1, "2013-03-03"), "drug_exposure_end_date": day("2013-03-09"), "days_supply": 30},
            {**exposure(2, "2013-03-03"), "days_supply": 30, "visit_occurrence_id": 8},
            exposure(3, "2013-03-03"),
            exposure(4, "2013-03-03", "unknown"),
        ]
    )
    events = domain_events(tables, DRUG_SOURCE, codes(spark).sources)
    assert rows(events, "person_id", "end_date", "visit_occurrence_id") == [
        (1, day("2013-03-09"), None), (2, day("2013-04-02"), 8), (3, day("2013-03-04"), None),
    ]


def test_drugs_can_be_told_by_concept(spark, make_tables):
    cohort = CohortDefinition(6, "by concept", DRUG, (Criterion(DRUG_CONCEPT, ILL),))
    tables = make_tables(
        observation_period=[period(1)], drug_exposure=[{**exposure(1, "2013-03-03"), "drug_concept_id": 101}]
    )
    assert starts(spark, tables, cohort) == [(1, "2013-03-03")]


def test_an_event_in_two_codesets_serves_both(spark, make_tables):
    both = Codes(local_frame(spark, [(ILL, 100), (INDICATED, 100)], "codeset_id bigint, concept_id bigint"))
    other = CohortDefinition(INDICATED, "other", DISEASE, (Criterion(CONDITION, INDICATED),))
    tables = make_tables(observation_period=[period(1)], condition_occurrence=[condition(1, 100, "2012-05-05")])
    built_rows = rows(build_cohorts(tables, both, (DISEASE_COHORT, other)), "cohort_definition_id", "subject_id")
    assert built_rows == [(ILL, 1), (INDICATED, 1)]


def test_one_person_with_most_of_the_events(spark, make_tables):
    """A person with a third of all events keeps no more rows than there are days."""
    base = dt.date(2011, 1, 1)
    hot = [condition(1, 100, str(base + dt.timedelta(i % 200))) for i in range(3000)]
    others = [condition(p, 100, "2012-05-05") for p in range(2, 200)]
    tables = make_tables(
        observation_period=[period(p) for p in range(1, 200)], condition_occurrence=hot + others
    )
    events = qualified_events(tables, codes(spark), (DISEASE_COHORT,))
    of_hot = events.where("person_id = 1").agg(F.count(F.lit(1)), F.sum("n_events")).first()
    assert tuple(of_hot) == (200, 3000)
    found = built(spark, tables)
    assert found[0] == (ILL, 1, base, base + dt.timedelta(200)) and len(found) == 199


def test_full_mask_is_required(spark, make_tables):
    tables = make_tables(
        observation_period=[period(1)], drug_exposure=[exposure(1, "2013-03-03")],
    )
    events = qualified_events(tables, codes(spark), (PATCH_COHORT,))
    assert rows(events, "rule_mask", "full_mask") == [(2, 3)]
    assert meets_all_rules(events).count() == 0


def test_codes_broadcast_or_not_give_the_same_cohorts(spark, make_tables):
    tables = make_tables(
        observation_period=[period(p) for p in (1, 2)],
        drug_exposure=[exposure(1, "2012-03-03"), exposure(2, "2012-03-03", "C")],
        condition_occurrence=[condition(p, c, "2011-02-02") for p in (1, 2) for c in (100, 200)],
    )
    expected = built(spark, tables, DISEASE_COHORT, PATCH_COHORT)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        few = replace(codes(spark), small=True)
        plan = build_cohorts(tables, few, (DISEASE_COHORT,))._jdf.queryExecution().toString()
        assert "BroadcastHashJoin [condition_concept_id" in plan
        assert rows(build_cohorts(tables, few, (DISEASE_COHORT, PATCH_COHORT))) == expected
        plan = build_cohorts(tables, codes(spark), (DISEASE_COHORT,))._jdf.queryExecution().toString()
        assert "SortMergeJoin [condition_concept_id" in plan
        assert built(spark, tables, DISEASE_COHORT, PATCH_COHORT) == expected
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_more_rules_than_bits_in_a_word(spark, make_tables):
    """Seventy rules, of which the last asks for what one of two persons has."""
    first = [Rule(CONDITION, ILL, EXACTLY, n, days_after=0) for n in range(100, 169)]
    rules = (*[replace(rule, kind=AT_LEAST, occurrences=0, days_after=i) for i, rule in enumerate(first)],
             Rule(CONDITION, INDICATED, AT_LEAST, 1))
    many = CohortDefinition(PATCH, "many", DRUG, (Criterion(DRUG_SOURCE, PATCH),), rules)
    tables = make_tables(
        observation_period=[period(p) for p in (1, 2)],
        drug_exposure=[exposure(1, "2012-03-03"), exposure(2, "2012-03-03")],
        condition_occurrence=[condition(1, 200, "2011-02-02")],
    )
    events = qualified_events(tables, codes(spark), (many,))
    low, high = (1 << 62) - 1, (1 << 8) - 1
    assert rows(events, "person_id", "rule_mask", "rule_mask_1", "full_mask_1") == [
        (1, low, high, high), (2, low, high >> 1, high),
    ]
    assert rows(meets_all_rules(events), "person_id") == [(1,)]
    catalogue = impact.rule_catalogue(spark, [many])
    result = impact.inclusion_result(events, impact.ALL_EVENTS)
    stats = rows(impact.inclusion_stats(result, catalogue, 0), "rule_sequence", "person_count", "gain_count", "person_total")
    assert stats[0] == (0, 2, 0, 2) and stats[62] == (62, 2, 0, 2) and stats[69] == (69, 1, 1, 2)
    assert rows(impact.attrition_summary(result, catalogue, 0), "base_count", "final_count") == [(2, 1)]
    best = rows(impact.best_events(events), "person_id", "rule_count", "min_rule_id", "rule_mask_1")
    assert best == [(1, 70, 0, high), (2, 69, 0, high >> 1)]


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def brute_masks(cohort, indexed, events):
    """Of an index day, the rules that hold, from (concept's codeset, day) of the same period."""
    start, end = day("2010-01-01"), day("2015-12-31")
    mask = 0
    for number, rule in enumerate(cohort.rules):
        last = end if rule.days_after is None else min(end, indexed + dt.timedelta(days=rule.days_after))
        n = sum(c == rule.codeset_id and start <= d <= last for c, d in events)
        if n >= rule.occurrences if rule.kind == AT_LEAST else n == rule.occurrences:
            mask |= 1 << number
    return mask


def many_rules(n):
    kinds = [
        Rule(CONDITION, codeset, kind, times, days_after=days)
        for times in range(9)
        for codeset in (ILL, INDICATED, CANCER)
        for kind in (AT_LEAST, EXACTLY)
        for days in (None, 0, 30, 400)
    ]
    return tuple(kinds[:n])


def test_two_hundred_rules_are_one_running_count(spark, make_tables):
    rng = random.Random(4)
    events = [
        (concept, dt.date(2011, 1, 1) + dt.timedelta(days=rng.randrange(1500)))
        for concept in [rng.choice([100, 101, 200, 300]) for _ in range(40)]
    ]
    tables = make_tables(
        observation_period=[period(1)],
        condition_occurrence=[condition(1, c, str(d)) for c, d in events],
        drug_exposure=[exposure(1, "2012-01-01"), exposure(1, "2013-06-01"), exposure(1, "2015-12-31")],
        death=[death(1, "2015-12-31")],
    )
    cohort = replace(PATCH_COHORT, rules=many_rules(200))
    found = qualified_events(tables, codes(spark), (cohort, DISEASE_COHORT)).where(F.col("cohort_id") == PATCH)
    words = ["rule_mask", *(f"rule_mask_{w}" for w in range(1, 4))]
    codeset = {100: ILL, 101: ILL, 200: INDICATED, 300: CANCER}
    for row in found.collect():
        mask = sum(row[name] << 62 * w for w, name in enumerate(words))
        assert mask == brute_masks(cohort, row.start_date, [(codeset[c], d) for c, d in events])
        assert row.censor_date == day("2015-12-31") and row.n_events == 1

    def windows(rules):
        plan = plan_of(qualified_events(tables, codes(spark), (replace(PATCH_COHORT, rules=rules),)))
        return plan.count("Window [")

    assert windows(many_rules(200)) == windows(many_rules(2)) == 1


def test_a_person_of_a_thousand_periods(spark, make_tables):
    begin = dt.date(2000, 1, 1)
    spans = [
        period(1, str(begin + dt.timedelta(days=10 * i)), str(begin + dt.timedelta(days=10 * i + 400))) for i in range(1000)
    ]
    listed = [begin + dt.timedelta(days=d) for d in (5, 365, 5000, 9999, 20000)]
    tables = make_tables(
        observation_period=[*spans, spans[3], spans[3]],
        condition_occurrence=[condition(1, 100, str(d)) for d in listed],
    )
    found = qualified_events(tables, codes(spark), (DISEASE_COHORT,))
    want = sorted(
        (d, s["observation_period_start_date"], 3 if s is spans[3] else 1)
        for d in listed
        for s in spans
        if s["observation_period_start_date"] + dt.timedelta(days=365) <= d <= s["observation_period_end_date"]
    )
    assert rows(found, "start_date", "op_start_date", "n_events") == want
    plan = plan_of(found)
    # Days meet a person's periods as one row, and only periods that cover a day become rows.
    join = next(line for line in plan.splitlines() if "Join [person_id" in line)
    assert "start_date" not in join.split("Join", 1)[1].split("]", 3)[-1]
    assert "periods" in plan and "Generate inline" in plan
