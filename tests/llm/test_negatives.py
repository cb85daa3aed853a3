"""Hard negatives against a plain search of all pairs with Python integers."""
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from carelake.llm import negatives

SCHEMA = "vec_id long, embedding array<double>, label long"


def plain(rows, n_positives=5, n_negatives=10, low=30, high=90, every=100, scale=256):
    e = [(i, l, [math.floor(scale * x) for x in v]) for i, v, l in rows
         if i is not None and l is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for at, (i, label, q) in enumerate(e):
        if i % every:
            continue
        scored = [(-sum(a * b for a, b in zip(q, r, strict=False)), j, m) for k, (j, m, r) in enumerate(e) if k != at]
        for s, j, _ in sorted(x for x in scored if x[2] == label)[:n_positives]:
            found = sorted(x for x in scored if x[2] != label and low * -s <= 100 * -x[0] <= high * -s)[:n_negatives]
            out += [(i, j, r + 1, n, -s, -t) for r, (t, n, _) in enumerate(found)]
    return sorted(out)


def mined(df, **kw):
    return sorted(tuple(r) for r in negatives.mine(df, **kw).collect())


def vectors(n, seed=0, dim=12, labels=3):
    g = np.random.default_rng(seed)
    centre = g.normal(size=dim)
    return [(int(i), (centre * .7 + g.normal(size=dim) * .5).tolist(), int(g.integers(labels))) for i in range(n)]


@pytest.mark.parametrize("dealt", [(7, 11), (8192, 1 << 16)])
def test_against_plain_search(spark, monkeypatch, dealt):
    monkeypatch.setattr(negatives, "ANCHORS", dealt[0])
    monkeypatch.setattr(negatives, "ROWS", 60 * dealt[1])
    rows = vectors(900)
    assert mined(spark.createDataFrame(rows, SCHEMA), every=20) == plain(rows, every=20)


def test_overlapping_windows_and_ties(spark):
    """Few different scores: every slot and window is full of ties, which ids settle."""
    rows = [(i, [float(1 + i % 5), 1.0], i % 2) for i in range(400)]
    found = mined(spark.createDataFrame(rows, SCHEMA), every=50, scale=1, n_negatives=4, low=10, high=95)
    assert found == plain(rows, every=50, scale=1, n_negatives=4, low=10, high=95)
    assert found


def test_zero_and_negative_positives(spark):
    rows = [(0, [1.0, 0.0], 0), (1, [-2.0, 5.0], 0), (2, [0.0, 3.0], 0), (3, [0.0, -7.0], 1), (4, [0.0, 1.0], 2),
            (5, [3.0, 0.0], 1), (6, [-1.0, 0.0], 1)]
    found = mined(spark.createDataFrame(rows, SCHEMA))
    assert found == plain(rows)
    assert {(r[1], r[3]) for r in found} == {(2, 3), (2, 4)}


def test_odd_rows_and_clashing_names(spark):
    nan, inf = float("nan"), float("inf")
    rows = vectors(150, seed=4) + [
        (200, None, 1), (200, [nan] * 12, 1), (300, [inf] + [1.0] * 11, 1), (300, [1.0] * 12, None), (400, [], 0),
        (None, [1.0] * 12, 1), (500, [None] + [1.0] * 11, 1), (600, [2.0, 1.0], 1), (700, [0.5] * 12, 2), (700, [0.5] * 12, 2)]
    df = spark.createDataFrame(rows, SCHEMA)
    odd = df.selectExpr("*", "1 AS row", "2 AS id", "3 AS q", "4 AS slot", "5 AS score", "6 AS anchor", "7 AS ab", "8 AS kind",
                        "9 AS positives", "0 AS scores")
    assert mined(odd) == plain(rows)
    assert mined(odd.limit(0)) == []
    assert mined(odd.where("vec_id % 100 <> 0")) == []


def test_products_beyond_doubles_are_exact(spark):
    big = float(2 ** 30 + 1)
    rows = [(0, [big, 1.0], 0), (1, [big, 3.0], 0), (2, [big, 2.0], 0)] + [(i, [big / 2, float(i)], 1) for i in range(3, 30)]
    df = spark.createDataFrame(rows, SCHEMA)
    assert mined(df, scale=1) == plain(rows, scale=1)
    huge = spark.createDataFrame([(0, [1e300], 0), (1, [1e300], 0), (2, [1e299], 1)], SCHEMA)
    assert [tuple(r)[4:] for r in negatives.mine(huge, low=0, high=100).collect()] == [(2**63 - 1, 2**63 - 1)]


def test_label_expression(spark):
    rows = vectors(300, seed=9)
    shifted = [(i, v, (m + 1) % 3 if i % 7 == 0 else m) for i, v, m in rows]
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 3).otherwise(F.col("label"))
    assert mined(spark.createDataFrame(rows, SCHEMA), every=30, label=label) == plain(shifted, every=30)
