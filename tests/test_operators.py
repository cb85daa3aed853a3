"""Scale-safe operators against brute force on small, skewed inputs."""

import datetime as dt
import random

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from carelake.operators.census import daily_census
from carelake.operators.ranking import percentile_cont, rank_table, value_ranks
from carelake.operators.sequence import first_after


def _skewed_values(n=600, seed=7):
    rnd = random.Random(seed)
    rows = []
    for i in range(n):
        g = rnd.choice(["a", "b", None]) if i % 3 else "a"      # group "a" holds a third+ of rows
        v = 42 if i % 3 == 0 else rnd.randint(0, 80)            # one value holds a third of rows
        rows.append((i, g, v))
    return rows


@pytest.mark.parametrize("buckets", [1, 4, 64])
@pytest.mark.parametrize("descending", [True, False])
def test_rank_and_dense_rank_match_pandas(spark, buckets, descending):
    rows = _skewed_values()
    df = spark.createDataFrame(rows, "id long, g string, v long")
    pdf = pd.DataFrame(rows, columns=["id", "g", "v"])
    asc = not descending
    # per group, NULL group included
    got = {(r.g, r.v): (r.rk, r.drk) for r in rank_table(df, "v", ["g"], descending, "rk", "drk", buckets).collect()}
    for g, part in pdf.groupby(pdf["g"].fillna("__null__")):
        key = None if g == "__null__" else g
        rk = part["v"].rank(method="min", ascending=asc)
        drk = part["v"].rank(method="dense", ascending=asc)
        for v, a, b in zip(part["v"], rk, drk):
            assert got[(key, v)] == (int(a), int(b))
    # global
    got = {r.v: r.rk for r in rank_table(df, "v", [], descending, rank="rk", n_buckets=buckets).collect()}
    rk = pdf["v"].rank(method="min", ascending=asc)
    assert all(got[v] == int(a) for v, a in zip(pdf["v"], rk))


def test_value_ranks_counts_cover_every_row(spark):
    df = spark.createDataFrame(_skewed_values(), "id long, g string, v long")
    r = value_ranks(df, "v", ["g"], n_buckets=8).groupBy("g").agg(
        F.max(F.col("before") + F.col("n")).alias("m"), F.sum("n").alias("s")).collect()
    assert all(x.m == x.s for x in r)


def test_percentile_cont_matches_numpy(spark):
    rnd = random.Random(3)
    rows = [(rnd.choice(["x", "y"]), float(rnd.choice([10, 10, 10, rnd.randint(0, 500)]))) for _ in range(700)]
    rows += [("z", 5.0)]
    df = spark.createDataFrame(rows, "g string, v double")
    fr = {"p10": 0.1, "p25": 0.25, "p50": 0.5, "p90": 0.9, "p100": 1.0}
    got = {r.g: r for r in percentile_cont(df, "v", ["g"], fr, n_buckets=16).collect()}
    pdf = pd.DataFrame(rows, columns=["g", "v"])
    for g, part in pdf.groupby("g"):
        for name, p in fr.items():
            assert got[g][name] == pytest.approx(float(np.percentile(part["v"], p * 100)), abs=1e-9)
    glob = percentile_cont(df, "v", [], {"p50": 0.5}).collect()[0]
    assert glob.p50 == pytest.approx(float(np.percentile(pdf["v"], 50)))


def test_first_after_matches_pairwise_scan(spark):
    rnd = random.Random(11)
    base = dt.datetime(2020, 1, 1)
    events = []
    for k in range(6):
        n = 200 if k == 0 else 15                     # key 0 is hot
        for _ in range(n):
            events.append((k, base + dt.timedelta(hours=rnd.randint(0, 24 * 200))))
    anchors = [(i, k, base + dt.timedelta(days=rnd.randint(0, 200))) for i, k in
               enumerate(rnd.choice(range(6)) for _ in range(300))]
    anchors += [(1000, 1, events[210][1])]           # anchor exactly at an event time: strictly after
    ev = spark.createDataFrame(events, "k long, t timestamp_ntz")
    an = spark.createDataFrame(anchors, "id long, k long, at timestamp_ntz")
    horizon = 30 * 86400
    got = {r.id: r.next_t for r in first_after(an, ev, "k", "at", "t", horizon).collect()}
    for i, k, at in anchors:
        later = [t for kk, t in events if kk == k and at < t <= at + dt.timedelta(seconds=horizon)]
        assert got[i] == (min(later) if later else None), i


def test_daily_census_matches_expansion(spark):
    rows = [(1, dt.datetime(2024, 1, 1, 10), dt.date(2024, 1, 3), 1),
            (2, dt.datetime(2024, 1, 2, 9), None, 2),
            (3, dt.datetime(2024, 1, 5, 1), dt.date(2024, 1, 5), 3),
            (4, dt.datetime(2024, 1, 2, 1), dt.date(2024, 1, 2), None)]
    adm = spark.createDataFrame(rows, "admission_id long, admission_date timestamp_ntz, discharge_date date, "
                                      "bed_id long")
    as_of = dt.date(2024, 1, 8)
    got = {r.day: r.in_house for r in daily_census(adm, as_of).collect()}
    want = {}
    for _, start, end, bed in rows:
        if bed is None:
            continue
        d, last = start.date(), end or as_of
        while d <= last:
            want[d] = want.get(d, 0) + 1
            d += dt.timedelta(days=1)
    assert got == want


def test_ranks_on_generated_skewed_inputs(spark):
    """Hypothesis-generated inputs: hot values, NULL groups, negative and repeated values."""
    from hypothesis import given, settings, strategies as st

    row = st.tuples(st.sampled_from(["a", "b", None]), st.one_of(st.just(7), st.integers(-50, 50)))

    @settings(max_examples=12, deadline=None)
    @given(st.lists(row, min_size=1, max_size=120), st.sampled_from([2, 5, 16]), st.booleans())
    def check(rows, buckets, descending):
        df = spark.createDataFrame(rows, "g string, v long")
        pdf = pd.DataFrame(rows, columns=["g", "v"])
        got = {(r.g, r.v): (r.rk, r.drk)
               for r in rank_table(df, "v", ["g"], descending, "rk", "drk", buckets).collect()}
        for g, part in pdf.groupby(pdf["g"].fillna("__null__")):
            key = None if g == "__null__" else g
            rk = part["v"].rank(method="min", ascending=not descending)
            drk = part["v"].rank(method="dense", ascending=not descending)
            for v, a, b in zip(part["v"], rk, drk):
                assert got[(key, v)] == (int(a), int(b))

    check()


def test_expand_levels_on_a_tree_is_linear(spark):
    """A binary tree of 4 levels: every node once, at its depth, and no collected list in the plan."""
    from carelake.operators.hierarchy import expand_levels
    parent = {i: i // 2 for i in range(2, 32)}
    nodes = spark.createDataFrame([(f"n{i}", f"n{parent[i]}" if i in parent else None) for i in range(1, 32)],
                                  "dept_name string, above string")
    got = expand_levels(nodes, "dept_name", F.col("dept_name"), F.col("above"), F.col("dept_name") == "n1", max_depth=3)
    want = []
    for i in range(1, 16):
        chain = [i]
        while chain[0] in parent:
            chain.insert(0, parent[chain[0]])
        want.append((f"n{i}", "n1", len(chain) - 1, " > ".join(f"n{k}" for k in chain)))
    assert sorted(map(tuple, got.collect())) == sorted(want)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "collect_list" not in plan and "Subquery" not in plan


def test_expand_levels_shared_parent_key(spark):
    """Nodes that report to a class of nodes: each root has every other node below it."""
    from carelake.operators.hierarchy import expand_levels
    nodes = spark.createDataFrame([("a", "24"), ("b", "24"), ("c", "8")], "dept_name string, hours string")
    got = expand_levels(nodes, "dept_name", F.col("hours"), F.lit("24"), F.col("hours") == "24")
    assert sorted((r.root_dept_name, r.level, r.dept_name) for r in got.collect()) == [
        ("a", 0, "a"), ("a", 1, "b"), ("a", 1, "c"), ("b", 0, "b"), ("b", 1, "a"), ("b", 1, "c")]


def test_ranking_many_groups_without_a_broadcast(spark):
    df = spark.range(200_000).select((F.col("id") % 100_000).alias("g"), (F.col("id") * 7 % 1000).alias("v"))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # only a hint could broadcast now
    try:
        r = rank_table(df, "v", ["g"], rank="rk")
        assert "BroadcastExchange" not in r._jdf.queryExecution().executedPlan().toString()
        assert r.agg(F.count("*"), F.max("rk")).first()[1] <= 2
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_weighted_percentiles_match_repeated_rows(spark):
    rows = [("x", float(v), n) for v, n in ((1, 3), (2, 1), (5, 4), (9, 2))]
    wide = spark.createDataFrame([(g, v) for g, v, n in rows for _ in range(n)], "g string, v double")
    short = spark.createDataFrame(rows, "g string, v double, n long")
    fr = {"p25": 0.25, "p50": 0.5, "p90": 0.9}
    assert percentile_cont(short, "v", ["g"], fr, weight="n").collect() == percentile_cont(wide, "v", ["g"], fr).collect()


def test_first_after_to_the_microsecond(spark):
    import datetime as dt
    t = dt.datetime(2024, 1, 1)
    us, day = dt.timedelta(microseconds=1), dt.timedelta(days=30)
    anchors = spark.createDataFrame([(k, t) for k in range(1, 5)], "k long, t timestamp_ntz")
    events = spark.createDataFrame([(1, t + dt.timedelta(milliseconds=500)), (2, t + day + us), (3, t + day), (4, t)],
                                   "k long, e timestamp_ntz")
    got = {r.k: r.next_t for r in first_after(anchors, events, "k", "t", "e", 30 * 86400).collect()}
    assert got == {1: t + dt.timedelta(milliseconds=500), 2: None, 3: t + day, 4: None}


def test_value_ranks_without_broadcast_hints_agrees(spark):
    df = spark.createDataFrame(_skewed_values(), "id long, g string, v long")
    hinted = sorted(map(tuple, value_ranks(df, "v", ["g"], n_buckets=8, few_groups=True).collect()), key=lambda t: (t[0] or "", t[1]))
    planned = sorted(map(tuple, value_ranks(df, "v", ["g"], n_buckets=8, few_groups=False).collect()),
                     key=lambda t: (t[0] or "", t[1]))
    assert hinted == planned


def test_left_join_salted_nulls_keeps_all_rows_once(spark):
    from carelake.operators.joins import left_join_salted_nulls
    rows = [(i, None if i % 3 == 0 else i % 4) for i in range(60)]
    left = spark.createDataFrame(rows, "id long, k long")
    right = spark.createDataFrame([(0, "a"), (1, "b"), (2, "c")], "rk long, name string")
    got = sorted((r.id, r.name) for r in left_join_salted_nulls(left, right, "k", "rk", buckets=8).collect())
    names = {0: "a", 1: "b", 2: "c"}
    assert got == sorted((i, names.get(k) if k is not None else None) for i, k in rows)
