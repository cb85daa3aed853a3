"""Distinct counts from bitmaps and regressions from moments against plain computation."""
import random
from decimal import Decimal

import numpy as np
import pytest
from pyspark.sql import functions as F

from carelake.operators.bitmaps import distinct_counts, distinct_sets, rollup_levels
from carelake.operators.moments import merged, moments, regression


def rows(seed, n=3000):
    rnd = random.Random(seed)
    return [(rnd.choice(["a", "a", "a", "b", None]), rnd.choice(["x", "y", None]),
             None if rnd.random() < .05 else rnd.choice([0, -1, -70_000, 32768, 32769, 2**40]) + rnd.randrange(400),
             rnd.random() < .3) for _ in range(n)]


def plain_counts(data, level):
    out = {}
    for g, t, v, c in data:
        if v is not None:
            key = (g if level < 2 else None, t if level == 0 else None)
            all_of, some = out.setdefault(key, (set(), set()))
            all_of.add(v)
            if c:
                some.add(v)
    return {k: (len(a), len(b)) for k, (a, b) in out.items()}


def test_rollup_of_distinct_counts(spark):
    data = rows(1)
    df = spark.createDataFrame(data, "g string, t string, v long, c boolean")
    sets = distinct_sets(df, "v", ["g", "t"], {"n": None, "some": F.col("c")})
    found = distinct_counts(sets, rollup_levels(["g", "t"]), ["g", "t"], ["n", "some"]).collect()
    for level, number in ((0, 0), (1, 1), (2, 3)):
        assert {(r.g, r.t): (r.n, r.some) for r in found if r.level == number} == plain_counts(data, level)


def test_stored_bitmaps_of_parts_merge(spark, tmp_path):
    """Sets of two loads, stored apart, give the counts of the whole."""
    data = rows(2)
    whole = plain_counts(data, 0)
    for i, part in enumerate((data[:900], data[900:])):
        df = spark.createDataFrame(part, "g string, t string, v long, c boolean")
        distinct_sets(df, "v", ["g", "t"], {"n": None, "some": F.col("c")}).write.parquet(f"{tmp_path}/load={i}")
    stored = spark.read.parquet(str(tmp_path))
    found = distinct_counts(stored, [["g", "t"]], ["g", "t"], ["n", "some"]).collect()
    assert {(r.g, r.t): (r.n, r.some) for r in found} == whole


def test_no_rows_no_counts(spark):
    df = spark.createDataFrame([("a", None)], "g string, v long")
    assert distinct_counts(distinct_sets(df, "v", ["g"]), rollup_levels(["g"]), ["g"], ["n"]).collect() == []


def measures(seed, n=500, shift=0):
    g = np.random.default_rng(seed)
    x = g.integers(0, 40, n) + shift
    y = (x * 3.25 + g.normal(size=n) * 9).round(2)
    return [(int(i % 9), int(a), Decimal(str(b)), i % 50 == 0) for i, (a, b) in enumerate(zip(x, y, strict=True))]


@pytest.mark.parametrize("shift", [0, 1_000_000])
def test_merged_moments_equal_the_direct_answer(spark, shift):
    data = measures(4, shift=shift)
    df = spark.createDataFrame(data, "day int, x int, y decimal(10,2), gone boolean")
    y = F.when(~F.col("gone"), F.col("y"))
    stored = moments(df, F.col("x"), y, ["day"])
    for by in ([], [(F.col("day") % 2).alias("odd")]):
        for r in merged(stored, by).select("*", *[c.alias(k) for k, c in regression().items()]).collect():
            part = [d for d in data if not d[3] and (not by or d[0] % 2 == r.odd)]
            a, b = np.array([d[1] for d in part], float), np.array([float(d[2]) for d in part])
            da, db = a - a.mean(), b - b.mean()
            slope = (da * db).sum() / (da * da).sum()
            assert r.n == len(part)
            assert r.slope == pytest.approx(slope, rel=1e-9)
            assert r.r == pytest.approx((da * db).sum() / np.sqrt((da * da).sum() * (db * db).sum()), rel=1e-9)
            assert r.intercept == pytest.approx(b.mean() - slope * a.mean(), rel=1e-7)
    direct = df.agg(F.regr_slope(y, F.col("x")).alias("s")).first().s
    assert merged(stored).select(regression()["slope"].alias("s")).first().s == pytest.approx(direct, rel=1e-9)


def test_degenerate_moments_are_null(spark):
    df = spark.createDataFrame([("one", 5, Decimal("2.00")), ("flat", 5, Decimal("2.00")), ("flat", 5, Decimal("3.00")),
                                ("none", None, Decimal("1.00"))], "k string, x int, y decimal(10,2)")
    r = {x.k: x for x in moments(df, F.col("x"), F.col("y"), ["k"]).select("k", "n", *[c.alias(n) for n, c in regression().items()]).collect()}
    assert [(r[k].n, r[k].slope, r[k].r) for k in ("one", "flat", "none")] == [(1, None, None), (2, None, None), (0, None, None)]
    assert r["flat"].mean_y == 2.5 and r["none"].mean_x is None
