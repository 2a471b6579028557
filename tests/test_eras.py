import datetime as dt

from helpers import rows
from hypothesis import HealthCheck, given, settings, strategies as st

from cohortloom.operators.eras import collapse_eras
from cohortloom.session import local_frame

EPOCH = dt.date(2020, 1, 1)


def eras(spark, intervals, pad=0):
    frame = local_frame(
        spark, [(k, EPOCH + dt.timedelta(s), EPOCH + dt.timedelta(e)) for k, s, e in intervals], "k int, s date, e date"
    )
    return [
        (k, (s - EPOCH).days, (e - EPOCH).days) for k, s, e in rows(collapse_eras(frame, ["k"], "s", "e", pad), "k", "s", "e")
    ]


def test_touching_intervals_merge(spark):
    assert eras(spark, [(1, 1, 3), (1, 3, 5)]) == [(1, 1, 5)]


def test_neighbouring_days_do_not_merge(spark):
    assert eras(spark, [(1, 1, 3), (1, 4, 5)]) == [(1, 1, 3), (1, 4, 5)]


def test_pad_bridges_a_gap(spark):
    assert eras(spark, [(1, 1, 3), (1, 5, 6)], pad=2) == [(1, 1, 6)]
    assert eras(spark, [(1, 1, 3), (1, 6, 7)], pad=2) == [(1, 1, 3), (1, 6, 7)]


def test_duplicates_contained_and_single_days(spark):
    assert eras(spark, [(1, 1, 9), (1, 1, 9), (1, 2, 3), (1, 1, 4), (2, 5, 5), (2, 5, 5)]) == [(1, 1, 9), (2, 5, 5)]


def test_a_long_interval_reaches_over_later_short_ones(spark):
    assert eras(spark, [(1, 1, 20), (1, 2, 3), (1, 10, 11), (1, 21, 22)]) == [(1, 1, 20), (1, 21, 22)]


def by_sweep(intervals, pad):
    """Counting open intervals over sorted marks, starts before ends on the same day."""
    found = []
    for key in sorted({k for k, _, _ in intervals}):
        marks = sorted(
            [(s, 0) for k, s, e in intervals if k == key] + [(e + pad, 1) for k, s, e in intervals if k == key]
        )
        depth, opened = 0, None
        for at, closing in marks:
            if not closing:
                opened = at if depth == 0 else opened
                depth += 1
            else:
                depth -= 1
                if depth == 0:
                    found.append((key, opened, at - pad))
    return found


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    st.lists(
        st.tuples(st.integers(1, 4), st.integers(0, 60), st.integers(0, 9)).map(lambda t: (t[0], t[1], t[1] + t[2])),
        min_size=1, max_size=60,
    ),
    st.integers(0, 3),
)
def test_same_as_a_sweep_over_marks(spark, intervals, pad):
    assert eras(spark, intervals, pad) == by_sweep(intervals, pad)
