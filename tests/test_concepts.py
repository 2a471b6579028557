from helpers import rows

from cohortloom.operators.concepts import concept_items, resolve_concept_sets, source_codes


def vocabulary(make_tables):
    return make_tables(
        concept=[
            {"concept_id": 1}, {"concept_id": 2}, {"concept_id": 3, "invalid_reason": "D"},
            {"concept_id": 4, "invalid_reason": "D"}, {"concept_id": 5}, {"concept_id": 6},
        ],
        concept_ancestor=[
            {"ancestor_concept_id": a, "descendant_concept_id": d}
            for a, d in [(1, 1), (1, 2), (1, 3), (1, 5), (5, 5), (5, 6), (1, 6), (4, 4), (4, 2)]
        ],
    )


def resolve(make_tables, items):
    tables = vocabulary(make_tables)
    return rows(resolve_concept_sets(tables["concept"], tables["concept_ancestor"], items), "codeset_id", "concept_id")


def test_invalid_descendants_drop_and_listed_invalid_ones_stay(spark, make_tables):
    assert resolve(make_tables, concept_items(spark, 9, [1, 4])) == [(9, c) for c in (1, 2, 4, 5, 6)]


def test_unknown_listed_concepts_drop(spark, make_tables):
    assert resolve(make_tables, concept_items(spark, 9, [77, 1], descendants=False)) == [(9, 1)]


def test_excluded_descendants_drop(spark, make_tables):
    assert resolve(make_tables, concept_items(spark, 9, [1], exclude=[5])) == [(9, 1), (9, 2)]


def test_invalid_descendant_of_an_excluded_item_does_not_exclude(spark, make_tables):
    listed = concept_items(spark, 9, [3], descendants=False)
    assert resolve(make_tables, listed.unionByName(concept_items(spark, 9, [], exclude=[1]))) == [(9, 3)]


def test_listing_something_as_excluded_does_not_include_it(spark, make_tables):
    assert resolve(make_tables, concept_items(spark, 9, [], exclude=[1])) == []


def test_codesets_are_independent(spark, make_tables):
    both = concept_items(spark, 1, [5]).unionByName(concept_items(spark, 2, [1], exclude=[5]))
    assert resolve(make_tables, both) == [(1, 5), (1, 6), (2, 1), (2, 2)]


def test_source_codes_are_distinct(spark):
    assert rows(source_codes(spark, 3, ["007", "8", "007"])) == [(3, "007"), (3, "8")]
