"""Collision counting against the cosines of all pairs."""
import math

import numpy as np
import pytest

from carelake.llm import collisions

SCHEMA = "vec_id long, embedding array<float>, label int"


def plain(rows, least=0.98):
    """(vec_id, n_links, component_id, kept) in the order of the rows, and the number of links."""
    n = len(rows)
    fit = [v is not None and m is not None and all(x is not None and math.isfinite(x) for x in v) and any(v) for _, v, m in rows]
    unit = [np.array(v, np.float64) / np.linalg.norm(np.array(v, np.float64)) if f else None
            for (_, v, _), f in zip(rows, fit, strict=True)]
    root, links = list(range(n)), [0] * n

    def top(i):
        while root[i] != i:
            i = root[i]
        return i
    for i in range(n):
        for j in range(i):
            if fit[i] and fit[j] and rows[i][2] == rows[j][2] and len(unit[i]) == len(unit[j]) and unit[i] @ unit[j] >= least:
                links[i] += 1
                links[j] += 1
                root[top(i)] = top(j)
    least_id = {}
    for i in range(n):
        if rows[i][0] is not None:
            least_id[top(i)] = min(rows[i][0], least_id.get(top(i), rows[i][0]))
    return [(r[0], links[i], least_id.get(top(i)), r[0] == least_id.get(top(i))) for i, r in enumerate(rows)], sum(links) // 2


def found(df, **kw):
    return sorted((tuple(r) for r in collisions.near_duplicates(df, **kw).select(
        "vec_id", "n_links", "component_id", "kept").collect()), key=str)


def clusters(seed, n, dim, spread, labels=2, copies=6):
    g = np.random.default_rng(seed)
    rows = []
    while len(rows) < n:
        centre = g.normal(size=dim)
        centre /= np.linalg.norm(centre)
        for _ in range(int(g.integers(1, copies))):
            v = centre + g.normal(size=dim) * spread / math.sqrt(dim)
            rows.append((len(rows), (v * g.uniform(.5, 2)).astype(np.float32).tolist(), int(g.integers(labels))))
    return rows


@pytest.mark.parametrize(("aim", "cell"), [(512, 2048), (4, 2048), (20, 16)])
def test_clear_clusters_are_found_exactly(spark, monkeypatch, aim, cell):
    """Near copies far within the threshold, with small cells, groups of several projections and cut cells."""
    monkeypatch.setattr(collisions, "AIM", aim)
    monkeypatch.setattr(collisions, "CELL", cell)
    rows = clusters(1, 600, 32, 0.02)
    want, many = plain(rows)
    assert many > 200
    assert found(spark.createDataFrame(rows, SCHEMA)) == sorted(want, key=str)


def test_recall_at_the_threshold(spark, monkeypatch):
    """Pairs at cosines of 0.98 to 0.982: at least 0.95 are found, none below the threshold."""
    monkeypatch.setattr(collisions, "AIM", 16)
    g = np.random.default_rng(5)
    rows = []
    for _ in range(400):
        a = g.normal(size=64)
        a /= np.linalg.norm(a)
        b = g.normal(size=64)
        b -= (b @ a) * a
        b /= np.linalg.norm(b)
        c = g.uniform(.978, .982)
        for v in (a, c * a + math.sqrt(1 - c * c) * b):
            rows.append((len(rows), v.astype(np.float32).tolist(), 1))
    want, many = plain(rows)
    got = {r[0]: r for r in found(spark.createDataFrame(rows, SCHEMA))}
    right = sum(got[r[0]] == r for r in want if r[1])
    assert many > 100 and right >= 0.95 * 2 * many
    assert all(got[r[0]] == r for r in want if not r[1])


def test_one_large_cluster_is_cut(spark, monkeypatch):
    monkeypatch.setattr(collisions, "CELL", 50)
    g = np.random.default_rng(2)
    rows = [(i, (np.ones(16) + g.normal(size=16) * .01).astype(np.float32).tolist(), 0) for i in range(400)]
    assert {r[1:] for r in found(spark.createDataFrame(rows, SCHEMA))} == {(399, 0, True), (399, 0, False)}


def test_odd_rows_and_clashing_names(spark):
    nan, inf = float("nan"), float("inf")
    rows = clusters(7, 60, 8, 0.05) + [
        (100, None, 0), (101, [0.0] * 8, 0), (102, [0.0] * 8, 0), (103, [nan] + [1.0] * 7, 0), (104, [nan] + [1.0] * 7, 0),
        (105, [inf] * 8, 0), (106, [None] + [1.0] * 7, 0), (107, [1.0] * 8, None), (108, [1.0] * 8, None), (109, [], 0),
        (110, [1.0] * 8, 0), (110, [1.0] * 8, 0), (111, [2.0] * 8, 0), (112, [1.0] * 8, 1), (113, [1.0] * 4, 0),
        (None, [1.0] * 8, 0), (None, [3.0] * 4, 5), (None, None, 5), (114, [1e-30] * 8, 1), (115, [1e30] * 8, 1)]
    df = spark.createDataFrame(rows, SCHEMA)
    want, _ = plain(rows)
    odd = df.selectExpr("*", "1 AS row", "2 AS id", "3 AS x", "4 AS node", "5 AS root", "6 AS n_links", "7 AS component_id",
                        "8 AS len", "9 AS fits", "0 AS kept")
    assert found(odd) == sorted([(a, b, c, d if a is not None else c is None) for a, b, c, d in want], key=str)
    assert found(odd.limit(0)) == []


def test_calibration():
    for largest in (1, 600, 50_000, 10**9):
        d = collisions.calibrated(largest, 0.98, 0.99)
        p = collisions.collides()
        assert (1 - p ** d.size) ** d.groups <= 0.005
        assert sum(math.comb(d.total, k) * p ** k * (1 - p) ** (d.total - k) for k in range(d.least_collisions)) <= 0.005
        assert d.total >= d.size * d.groups
