"""Recursion to a fixpoint against plain breadth-first search and path enumeration."""
import random

import pytest
from pyspark.sql import functions as F

from carelake.operators.recursion import walk, whole
from carelake.session import staging_path


def edges_of(spark, pairs):
    return spark.createDataFrame(pairs, "parent long, child long")


def nodes_of(spark, nodes):
    return spark.createDataFrame([(n,) for n in nodes], "node long")


def union_walk(roots, pairs):
    """(root, node, parent, level, path, is_cycle) with each node once a root."""
    edges = {(a, b) for a, b in pairs if a is not None and b is not None}
    out = []
    for root in {r for r in roots if r is not None}:
        level, seen, now = 0, {root}, {root: (root,)}
        out.append((root, root, None, 0, (root,), False))
        while now:
            level += 1
            new, back = {}, {}
            for a, path in now.items():
                for x, b in edges:
                    if x != a:
                        continue
                    longer = (*path, b)
                    if b in path:
                        back[b, a] = min(longer, back.get((b, a), longer))
                    elif b not in seen:
                        new[b] = min(longer, new.get(b, longer))
            out += [(root, b, p[-2], level, p, False) for b, p in new.items()]
            out += [(root, b, a, level, p, True) for (b, a), p in back.items()]
            seen |= set(new)
            now = new
    return sorted(out, key=str)


def path_walk(roots, pairs):
    """The same with every path without a repeated node."""
    edges = {(a, b) for a, b in pairs if a is not None and b is not None}
    out, now = [], [(r, (r,), False) for r in {r for r in roots if r is not None}]
    while now:
        out += [(r, p[-1], p[-2] if len(p) > 1 else None, len(p) - 1, p, c) for r, p, c in now]
        now = [(r, (*p, b), b in p) for r, p, c in now if not c for a, b in edges if a == p[-1]]
    return sorted(out, key=str)


def rows_of(df):
    return sorted(((r.root, r.node, r.parent, r.level, tuple(r.path), r.is_cycle) for r in df.collect()), key=str)


def graph(seed, n=40, m=60):
    rnd = random.Random(seed)
    return [(rnd.randrange(n), rnd.randrange(n)) for _ in range(m)]


@pytest.mark.parametrize("seed", [1, 2])
def test_graph_with_cycles_and_several_parents(spark, seed):
    pairs = [*graph(seed), (3, 3), (1, None), (None, 2), (5, 6), (5, 6)]
    roots = [0, 5, 5, None, 999]
    assert rows_of(walk(nodes_of(spark, roots), edges_of(spark, pairs))) == union_walk(roots, pairs)


def test_every_path(spark):
    pairs = graph(7, n=9, m=16)
    assert rows_of(walk(nodes_of(spark, [0, 1]), edges_of(spark, pairs), every_path=True)) == path_walk([0, 1], pairs)


def test_depth_is_not_given_beforehand(spark):
    """A chain of 25 steps whose end leads back to its middle."""
    pairs = [(i, i + 1) for i in range(25)] + [(25, 12)]
    found = rows_of(walk(nodes_of(spark, [0]), edges_of(spark, pairs)))
    assert found == union_walk([0], pairs)
    assert [r[:4] for r in found if r[5]] == [(0, 12, 25, 26)]
    assert max(r[3] for r in walk(nodes_of(spark, [0]), edges_of(spark, pairs), max_level=4).collect()) == 4


def test_a_hot_child_and_a_hot_parent(spark):
    pairs = [(0, i) for i in range(1, 3000)] + [(i, 5000) for i in range(1, 3000)]
    found = rows_of(walk(nodes_of(spark, [0]), edges_of(spark, pairs)))
    assert len(found) == 3001
    assert [r for r in found if r[1] == 5000] == [(0, 5000, 1, 2, (0, 1, 5000), False)]


def test_a_broken_run_goes_on_after_its_last_whole_round(spark):
    pairs = [(i, i + 1) for i in range(6)]
    roots, edges = nodes_of(spark, [0]), edges_of(spark, pairs)
    folder = staging_path(spark, "walk")
    walk(roots, edges, folder, max_level=3).collect()
    # a round that was being written when the run broke has no marker
    spark.createDataFrame([(1,)], "x int").write.option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "false").parquet(
        folder + "/round-000004")
    assert whole(spark, folder + "/round-000003") and not whole(spark, folder + "/round-000004")
    # the rounds there are taken as they are: with other edges they would differ
    later = edges_of(spark, [(3, 4), (4, 5), (5, 6)])
    assert rows_of(walk(roots, later, folder)) == union_walk([0], pairs)


def test_no_roots_and_no_edges(spark):
    assert rows_of(walk(nodes_of(spark, []), edges_of(spark, [(1, 2)]))) == []
    assert rows_of(walk(nodes_of(spark, [4]), edges_of(spark, []))) == [(4, 4, None, 0, (4,), False)]


def test_string_nodes_and_other_columns(spark):
    roots = spark.createDataFrame([("a", 1)], "node string, level int")
    edges = spark.createDataFrame([("a", "b", "x"), ("b", "a", "y")], "parent string, child string, path string")
    got = walk(roots, edges).select(F.concat_ws("/", "path").alias("p"), "is_cycle").collect()
    assert {(r.p, r.is_cycle) for r in got} == {("a", False), ("a/b", False), ("a/b/a", True)}
