"""Pairs of the interval join against all pairs compared one by one."""
import datetime as dt
import random

import pytest

from carelake.operators.band_join import following

T0 = dt.datetime(2024, 1, 1)
DAY = 86400


def plain(left, right, span):
    out = []
    for k, i, t in left:
        found = [(j, u) for q, j, u in right if k is not None and t is not None and q == k and u is not None
                 and t < u <= t + dt.timedelta(seconds=span)]
        out += [(k, i, t, j, u) for j, u in found] or [(k, i, t, None, None)]
    return sorted(out, key=str)


def tables(spark, left, right):
    return (spark.createDataFrame(left, "k long, i long, t timestamp_ntz"),
            spark.createDataFrame(right, "k long, j long, u timestamp_ntz"))


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def events(seed, n, days, hot):
    rnd = random.Random(seed)
    return [(rnd.choice([1] * hot + [2, 3, 4, None]), i,
             None if rnd.random() < .03 else T0 + dt.timedelta(days=rnd.randrange(days), seconds=rnd.randrange(3) * 43200))
            for i in range(n)]


@pytest.mark.parametrize("slices", [1, 2, 5])
def test_all_pairs_within_the_span(spark, slices):
    left, right = events(1, 150, 60, 3), events(2, 150, 60, 3)
    a, b = tables(spark, left, right)
    want = plain(left, right, 10 * DAY)
    assert rows_of(following(a, b, "k", "t", "u", 10 * DAY, slices)) == want
    assert rows_of(following(a, b, "k", "t", "u", 10 * DAY, slices, outer=False)) == [r for r in want if r[3] is not None]


def test_bounds_to_the_microsecond_and_before_the_epoch(spark):
    us = dt.timedelta(microseconds=1)
    for start in (T0, dt.datetime(1901, 2, 3, 4, 5, 6)):
        left = [(1, 0, start)]
        right = [(1, 0, start), (1, 1, start + us), (1, 2, start + dt.timedelta(days=30)),
                 (1, 3, start + dt.timedelta(days=30) + us), (2, 4, start + us)]
        a, b = tables(spark, left, right)
        assert [r[3] for r in rows_of(following(a, b, "k", "t", "u", 30 * DAY))] == [1, 2]


def test_a_hot_key_is_dealt_by_time(spark):
    """One key holds everything: no task of the join may see more than a few blocks of it."""
    left = [(1, i, T0 + dt.timedelta(hours=i)) for i in range(2000)]
    right = [(1, i, T0 + dt.timedelta(hours=i)) for i in range(2000)]
    a, b = tables(spark, left, right)
    pairs = following(a, b, "k", "t", "u", 3 * 3600)
    assert pairs.where("j IS NOT NULL").count() == 3 * 2000 - 6
    plan = pairs._jdf.queryExecution().executedPlan().toString()
    assert "_lblock" in plan and "NestedLoop" not in plan and "Cartesian" not in plan


def test_null_keys_stay_out_of_the_join(spark):
    left = [(None, i, T0) for i in range(50)] + [(1, 99, None), (1, 100, T0)]
    a, b = tables(spark, left, [(None, 1, T0), (1, 2, None), (1, 3, T0 + dt.timedelta(days=1))])
    got = rows_of(following(a, b, "k", "t", "u", 2 * DAY))
    assert got == plain(left, [(1, 3, T0 + dt.timedelta(days=1))], 2 * DAY)


def test_empty_sides(spark):
    a, b = tables(spark, [(1, 1, T0)], [(1, 1, T0)])
    assert rows_of(following(a, b.limit(0), "k", "t", "u", DAY)) == [(1, 1, T0, None, None)]
    assert rows_of(following(a.limit(0), b, "k", "t", "u", DAY)) == []
