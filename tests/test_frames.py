"""Distributed row frames and chunks against plain lists."""
import json
import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from carelake.operators.chunks import assembled, ordered_chunks
from carelake.operators.frames import Frames, numbered, prefix_sums


def rows(seed, n, hot=4):
    rnd = random.Random(seed)
    return [(rnd.choice(["a"] * hot + ["b", "c", None]), None if rnd.random() < .05 else rnd.randrange(12), i,
             None if rnd.random() < .15 else Decimal(rnd.randrange(-500, 500)) / 100) for i in range(n)]


SCHEMA = "g string, t int, id long, x decimal(10,2)"


def order(r):
    """NULLs first, as in the operator."""
    return (r[1] is not None, r[1] or 0, r[2])


def plain(data, by):
    out = {}
    groups = {}
    for r in data:
        groups.setdefault(r[0] if by else 0, []).append(r)
    for part in groups.values():
        part.sort(key=order)
        for i, r in enumerate(part):
            seen = [x[3] for x in part[:i + 1] if x[3] is not None]
            last = [x[3] for x in part[max(0, i - 4):i + 1] if x[3] is not None]
            out[r[2]] = (sum(seen) if seen else None, len(seen), sum(last) if last else None, len(last),
                         part[i - 2][3] if i >= 2 else None)
    return out


@pytest.mark.parametrize("by", [(), ("g",)])
@pytest.mark.parametrize("block", [7, 64, 100_000])
def test_frames_match_plain_lists(spark, by, block):
    data = rows(3, 500)
    placed = numbered(spark.createDataFrame(data, SCHEMA), ["t", "id"], by, group=2)
    got = (Frames(placed, by, block=block, group=3).running_sum("total", "x").running_count("seen", "x")
           .moving("s5", F.sum("x"), 4).moving("n5", F.count("x"), 4).lag("two_back", "x", 2).result())
    assert got.columns == ["g", "t", "id", "x", "place", "s5", "n5", "two_back", "total", "seen"]
    assert {r.id: (r.total, r.seen, r.s5, r.n5, r.two_back) for r in got.collect()} == plain(data, by)
    places = {r.id: r.place for r in got.collect()}
    assert sorted(places.values()) == list(range(1, 501))
    if not by:
        assert [i for i, _ in sorted(places.items(), key=lambda p: p[1])] == [r[2] for r in sorted(data, key=order)]


def test_no_task_holds_the_table(spark):
    placed = numbered(spark.createDataFrame(rows(1, 200), SCHEMA), ["t", "id"])
    got = Frames(placed, block=20).running_sum("total", "x").lag("before", "x").result()
    got.collect()
    assert "SinglePartition" not in got._jdf.queryExecution().executedPlan().toString()


def test_frames_only_look_back_within_a_block(spark):
    placed = numbered(spark.createDataFrame(rows(1, 30), SCHEMA), ["t", "id"])
    with pytest.raises(ValueError):
        Frames(placed, block=5).lag("x6", "x", 6)
    exact = Frames(placed, block=5).lag("x5", "x", 5).result().orderBy("place").collect()
    assert [r.x5 for r in exact] == [None] * 5 + [r.x for r in exact][:25]


def test_empty_table(spark):
    placed = numbered(spark.createDataFrame([], SCHEMA), ["t", "id"])
    assert Frames(placed).running_sum("total", "x").moving("m", F.sum("x"), 3).result().collect() == []


def test_prefix_sums_in_two_levels(spark):
    values = {i: (i * 7) % 11 for i in range(0, 50) if i % 6}
    sums = spark.createDataFrame(list(values.items()), "at int, v long")
    got = {r["at"]: r.v for r in prefix_sums(sums, "at", ["v"], 49, group=4).collect()}
    assert got == {i: sum(v for j, v in values.items() if j < i) for i in values}


def test_chunks_of_a_hot_key(spark):
    """One key with nearly all rows: chunks stay of the given size, and together are the ordered list."""
    data = [("hot", (i * 37) % 5000, i) for i in range(5000)] + [("b", 2, 1), ("b", 1, 2), (None, 1, 3), ("n", None, 4)]
    df = spark.createDataFrame(data, "k string, t long, id long")
    item = F.struct("t", "id")
    chunks = ordered_chunks(df, "k", ["t", "id"], item, 64, [F.max("t").alias("last")])
    found = chunks.collect()
    assert max(r.n_items for r in found) == 64
    assert sorted(r.chunk for r in found if r.k == "hot") == list(range(79))
    assert all(r.last == max(x["t"] for x in json.loads(r["items"])) for r in found if r.k == "hot")
    whole = {r.k: [x["id"] for x in json.loads(r["items"])] for r in assembled(chunks, "k").collect()}
    want = {}
    for k, _, i in sorted(data, key=lambda r: (r[1] is not None, r[1] or 0, r[2])):
        want.setdefault(k, []).append(i)
    assert whole == want
