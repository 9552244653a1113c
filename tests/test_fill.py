"""Gap fill and forward fill: edge fixtures and strategy equivalence."""

import datetime as dt

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from rateflow.operators.fill import (
    date_spine,
    forward_fill,
    forward_fill_nonzero,
    gap_fill,
    gap_fill_spine,
    series_span,
)

D0 = dt.date(2020, 1, 1)


def frame(spark, rows):
    return spark.createDataFrame(rows, "series_id string, date date, value double")


def rows_of(df, cols=("series_id", "date", "value")):
    return sorted(tuple(r) for r in df.select(*cols).collect())


def d(n):
    return D0 + dt.timedelta(days=n)


def test_gap_fill_grid_and_carry(spark):
    df = frame(spark, [("A", d(0), None), ("A", d(1), 1.0), ("A", d(4), 0.0), ("A", d(6), 2.0),
                       ("B", d(2), 5.0)])
    out = rows_of(gap_fill(df, missing="null"))
    assert out == [("A", d(0), None), ("A", d(1), 1.0), ("A", d(2), 1.0), ("A", d(3), 1.0),
                   ("A", d(4), 0.0), ("A", d(5), 0.0), ("A", d(6), 2.0), ("B", d(2), 5.0)]


def test_gap_fill_zero_policy_makes_null_a_value(spark):
    df = frame(spark, [("A", d(0), 3.0), ("A", d(1), None), ("A", d(3), 4.0)])
    assert [r[2] for r in rows_of(gap_fill(df, missing="zero"))] == [3.0, 0.0, 0.0, 4.0]


def test_all_null_and_single_row(spark):
    df = frame(spark, [("A", d(0), None), ("A", d(2), None), ("S", d(5), 9.0)])
    assert rows_of(gap_fill(df, missing="null")) == [("A", d(0), None), ("A", d(1), None), ("A", d(2), None),
                                                   ("S", d(5), 9.0)]


def test_unsorted_input_and_row_count(spark):
    df = frame(spark, [("A", d(9), 2.0), ("A", d(0), 1.0), ("A", d(5), None)])
    out = gap_fill(df, missing="null")
    span = series_span(df).first()
    assert out.count() == span.n_days == 10
    assert rows_of(out)[-1] == ("A", d(9), 2.0)


def test_forward_fill_nonzero(spark):
    df = frame(spark, [("A", d(0), 0.0), ("A", d(1), 2.0), ("A", d(2), 0.0), ("A", d(3), None), ("A", d(4), 3.0)])
    assert [r[2] for r in rows_of(forward_fill_nonzero(df))] == [None, 2.0, 2.0, 2.0, 3.0]


def test_gap_fill_is_idempotent(spark):
    df = frame(spark, [("A", d(0), 1.0), ("A", d(3), 2.0), ("B", d(1), None), ("B", d(4), 7.0)])
    once = gap_fill(df, missing="null")
    assert rows_of(gap_fill(once, missing="null")) == rows_of(once)


def test_spine_matches_span(spark):
    df = frame(spark, [("A", d(0), 1.0), ("A", d(3), 2.0)])
    assert [r.date for r in date_spine(df).orderBy("date").collect()] == [d(i) for i in range(4)]


series_rows = st.lists(
    st.tuples(st.sampled_from(["A", "B", "C"]), st.integers(0, 900),
              st.one_of(st.none(), st.sampled_from([0.0, 1.5, 2.25, 100.0]))),
    min_size=1, max_size=40, unique_by=lambda t: (t[0], t[1]))


@settings(max_examples=12, deadline=None)
@given(series_rows, st.sampled_from(["zero", "null"]))
def test_blocked_equals_plain_equals_spine(spark, rows, missing):
    df = frame(spark, [(s, d(n), v) for s, n, v in rows])
    plain = rows_of(gap_fill(df, missing=missing))
    blocked = rows_of(gap_fill(df, missing=missing, block_days=30))
    spine = rows_of(gap_fill_spine(df, missing=missing))
    assert plain == blocked == spine


@settings(max_examples=8, deadline=None)
@given(series_rows)
def test_forward_fill_blocked_equals_plain(spark, rows):
    df = frame(spark, [(s, d(n), v) for s, n, v in rows])
    assert rows_of(forward_fill(df)) == rows_of(forward_fill(df, block_days=7))
    assert rows_of(forward_fill_nonzero(df)) == rows_of(forward_fill_nonzero(df, block_days=7))


def test_bad_policy(spark):
    with pytest.raises(ValueError):
        gap_fill(frame(spark, [("A", d(0), 1.0)]), missing="drop")


def test_plain_window_has_one_exchange(spark):
    df = frame(spark, [("A", d(0), 1.0), ("A", d(3), 2.0)])
    plan = gap_fill(df)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1
    assert "BroadcastNestedLoopJoin" not in plan and "CartesianProduct" not in plan
    assert F is not None
