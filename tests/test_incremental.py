"""Headcount deltas and the specialty rule as streams: any order, split and repetition equals the batch answer."""
import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from carelake.session import staging_path
from carelake.streaming import headcount as hc
from carelake.streaming import specialty_rule as sr

T0 = dt.datetime(2024, 1, 1)


def files(spark, path, rows, schema, cuts):
    for a, b in zip([0, *cuts], [*cuts, len(rows)], strict=True):
        if a < b:
            spark.createDataFrame(rows[a:b], schema).coalesce(1).write.mode("append").parquet(path)


def moves(seed, n=120):
    """Change records and the department of each staff member after them."""
    rnd, now, out = random.Random(seed), {}, []
    for i in range(n):
        s = rnd.randrange(30)
        new = rnd.choice(["ER", "ER", "ICU", "Lab", None])
        out.append((i, T0 + dt.timedelta(minutes=i), s, now.get(s), new))
        now[s] = new
    return out, now


def departments(spark):
    return spark.createDataFrame([("ER", "24 Hours", 0), ("ICU", "24 Hours", 0), ("Lab", "day", 0), ("Empty", "day", 0)],
                                 "dept_name string, operating_hours string, staff_headcount int")


def counts(spark, store):
    return {r.dept_name: r.staff_headcount for r in hc.headcount(departments(spark), store).collect()}


def recount(now):
    return {d: sum(x == d for x in now.values()) for d in ("ER", "ICU", "Lab", "Empty")}


@pytest.mark.parametrize("seed", [1, 2])
def test_deltas_in_any_split_equal_the_recount(spark, seed):
    log, now = moves(seed)
    again = [*log, *log[::7]]  # records that come twice
    random.Random(seed).shuffle(again)
    source = staging_path(spark, "src")
    files(spark, source, again, hc.CHANGE_SCHEMA, [10, 70])
    store = hc.run_headcount_stream(spark, source, files_per_trigger=1)
    assert counts(spark, store) == recount(now)


def test_a_batch_that_runs_again_counts_once_and_snapshots_agree(spark):
    log, now = moves(3)
    store = staging_path(spark, "store")
    assert counts(spark, store) == recount({})
    for i in range(3):
        part = spark.createDataFrame(log[i * 40:(i + 1) * 40], hc.CHANGE_SCHEMA)
        hc.apply_batch(part, store, i)
        hc.apply_batch(part, store, i)
        if i == 1:
            assert hc.compact(spark, store) == 1
            hc.apply_batch(part, store, 1)  # run again after the snapshot that counts it
    assert counts(spark, store) == recount(now)
    assert hc.compact(spark, store) == 2 and hc.compact(spark, store) == 2
    assert counts(spark, store) == recount(now)


def test_a_stopped_headcount_goes_on(spark):
    log, now = moves(4)
    source, store, ckpt = (staging_path(spark, n) for n in ("src", "store", "ckpt"))
    files(spark, source, log[:50], hc.CHANGE_SCHEMA, [])
    hc.run_headcount_stream(spark, source, store, ckpt)
    files(spark, source, log[50:] + log[45:50], hc.CHANGE_SCHEMA, [])
    hc.run_headcount_stream(spark, source, store, ckpt)
    assert counts(spark, store) == recount(now)


def events(seed, doctors=12, n=400):
    rnd, now, out = random.Random(seed), {}, []
    out += [(10_000 + d, T0, "doctor", d, None) for d in range(doctors)]
    for i in range(n):
        d, s = rnd.randrange(doctors + 2), f"s{rnd.randrange(9)}"  # the last two are on no books
        held = now.setdefault(d, {})
        kind = "loss" if held.get(s) else "gain"
        held[s] = kind == "gain"
        out.append((i, T0 + dt.timedelta(minutes=i // 3), kind, d, s))
    want = {}
    for d in range(doctors):
        c = sum(now.get(d, {}).values())
        if not 1 <= c <= 5:
            want[d] = c
    return out, want


@pytest.mark.parametrize("seed", [1, 5])
def test_specialty_stream_equals_batch(spark, seed):
    log, want = events(seed)
    shuffled = [*log, *log[::5]]
    random.Random(seed).shuffle(shuffled)  # late and repeated records
    source = staging_path(spark, "src")
    files(spark, source, shuffled, sr.EVENT_SCHEMA, [100, 300])
    out = sr.run_specialty_stream(spark, source, files_per_trigger=1)
    assert {r.doctor_id: r.specialty_count for r in sr.current_violations(spark, out).collect()} == want


def test_both_bounds_are_reported_and_taken_back(spark):
    steps = [[(1, T0, "doctor", 7, None)],
             [(2, T0, "gain", 7, "a")],
             [(10 + i, T0, "gain", 7, f"s{i}") for i in range(5)],
             [(20, T0, "gain", 7, "x")],
             [(30 + i, T0 + dt.timedelta(days=1), "loss", 7, n) for i, n in enumerate(["a", "x"])],
             [(2, T0, "gain", 7, "a")]]  # an old record again
    source, out, ckpt = (staging_path(spark, n) for n in ("src", "out", "ckpt"))
    seen = []
    for rows in steps:
        files(spark, source, rows, sr.EVENT_SCHEMA, [])
        sr.run_specialty_stream(spark, source, out, ckpt)
        total = spark.read.schema(sr.OUT).parquet(out).groupBy("specialty_count").agg(
            F.sum("change").alias("c")).where("c <> 0").collect()
        seen.append([(r.specialty_count, r.c) for r in total])
    assert seen == [[(0, 1)], [], [(6, 1)], [(7, 1)], [], []]
