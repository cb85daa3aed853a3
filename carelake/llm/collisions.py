"""Embedding near-duplicates by collision-counting projections.

Vectors of one label and length link at a cosine of ``least`` or more.  Every vector, scaled to
length one, is projected on many fixed random directions.  A linked pair lies at most
``d = sqrt(2 - 2 least)`` apart, and its distance along one direction has a standard deviation of
``d / sqrt(length)``; the window around a query is ``WINDOW`` of these, so that a pair just at the
threshold collides in about 95 of 100 projections and a closer one in more.  Pairs that collide in
``least_collisions`` of all projections are verified by their cosine in double precision; that
count is calibrated so that the binomial tail at the threshold keeps the wanted recall.

Finding the pairs.  Counting the collisions of all pairs is quadratic, so the projections are dealt
into groups of a few; only pairs that collide in every projection of some group are counted, and
the number of groups is calibrated like the count.  (A single projection separates a linked pair
from others by a factor of at most seven, so no number of single projections would do.)  The cells
of a group are two windows wide in each of its projections; a vector is at home in its cell
and a guest in the next ones wherever its window reaches over the border, and a pair meets once, in
the cell that is the larger of its two home cells in every projection.  Within a cell the vectors are sorted by
the group's first projection and each queries the window that follows it.  A pair that an earlier
group has found is left to that group, so links are counted without rows for pairs.

Scale.  Equal vectors are reduced to one with a number of copies.  Projections of a group grow with
the logarithm of the largest label, so cells stay small.  Cells of more than ``CELL`` vectors are cut
into blocks, and each pair of blocks is a unit of its own; a task holds one unit at a time,
however large a label, a cell or a cluster is.  Units emit for each vector its number of
links and one edge to the smallest vector it is joined with there; components come from alternating
stars of these edges, each round written.  The whole work on a cluster of n different but linked
vectors is n * n / 2 comparisons, spread over units, because each of its links counts.

Recall is ``recall`` at the threshold and more above it (0.99 by default).  It is the mean over pairs
and directions; tests measure it.

Cases: vectors that are null, of length zero, or that hold a null, NaN or infinite component, and
rows with a null label link with nothing and are their own component; vectors of different
lengths don't link; repeated rows are vectors of their own (they link with each other);
a null id is not the smallest of a component that has others, and alone it is kept; an empty table
gives no rows; other columns are ignored.
"""

from __future__ import annotations

import itertools
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from carelake.llm.common import col, staged
from carelake.llm.simhash import components

#: half-width of a window, in standard deviations of a linked pair's distance along a direction
WINDOW = 2.0
#: that half-width as an integer step: projections are held in units of the 2**-20th of it
STEP = 1 << 20
#: vectors of a unit's side, about
CELL = 2048
#: vectors of a cell that the number of projections of a group aims at
AIM = 512
#: directions that are counted, at least
PROJECTIONS = 24
#: pairs that are compared at one time
PAIRS = 1 << 15


@dataclass(frozen=True)
class Design:
    """Directions, how they are grouped, and the calibrated number of collisions."""

    least: float
    size: int  # projections of a group
    groups: int
    total: int  # projections in all
    least_collisions: int


def collides(sigmas: float = WINDOW) -> float:
    """Probability that a pair at the threshold collides in one projection."""
    return math.erf(sigmas / math.sqrt(2))


def calibrated(largest: int, least: float, recall: float) -> Design:
    """Half of what recall may lose goes to the groups, half to the count."""
    lost = (1 - recall) / 2
    p = collides()
    size = max(1, math.ceil(math.log(max(1, largest) / AIM, 4))) if largest > AIM else 1
    groups = max(1, math.ceil(math.log(lost) / math.log1p(-p ** size)))
    total = max(PROJECTIONS, size * groups)
    tail, count = 0.0, -1
    while tail <= lost:  # P(at most count collisions)
        count += 1
        tail += math.comb(total, count) * p ** count * (1 - p) ** (total - count)
    return Design(least, size, groups, total, count)


def directions(total: int, length: int) -> np.ndarray:
    """Fixed random unit vectors."""
    x = np.random.default_rng([length, 13]).standard_normal((total, length))
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def unit_vectors(values: pa.Array) -> np.ndarray:
    """Rows of equal length as doubles scaled to length one."""
    offsets = values.offsets.to_numpy()
    flat = values.values.to_numpy(zero_copy_only=False)[offsets[0]:offsets[-1]].astype(np.float64)
    x = flat.reshape(len(values), -1)
    # squares of very large or small components leave the doubles, so scale by the largest first
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def projected(x: np.ndarray, design: Design) -> np.ndarray:
    """Projections as integers: a window's half-width is STEP."""
    length = x.shape[1]
    window = WINDOW * math.sqrt(max(0.0, 2 - 2 * design.least) / length)
    return np.floor(x @ directions(design.total, length).T * (STEP / max(window, 1e-9))).astype(np.int64)


def placed(distinct: DataFrame, design: Design) -> DataFrame:
    """(label, len, g, cell, at, node, copies, h, x): every vector at home and as a guest in each group's cells."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            label, length, node, copies = (b.column(i).to_numpy() for i in range(4))
            for n in np.unique(length):
                mine = np.flatnonzero(length == n)
                values = b.column(4).take(pa.array(mine))
                h = projected(unit_vectors(values), design)
                for g in range(design.groups):
                    own = h[:, g * design.size:(g + 1) * design.size]
                    cell, inside = own // (2 * STEP), own % (2 * STEP)
                    for over in itertools.product((0, 1), repeat=design.size):
                        # a guest in the next cell where the window reaches over the border
                        there = np.flatnonzero(((inside >= STEP) | (np.array(over) == 0)).all(axis=1))
                        if not len(there):
                            continue
                        at = np.ascontiguousarray(cell[there] + np.array(over))
                        rows = mine[there]
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(label[rows]), pa.array(length[rows]), pa.array(np.full(len(there), g, np.int32)),
                             pa.array([r.tobytes() for r in at], pa.binary()), pa.array(own[there, 0]),
                             pa.array(node[rows]), pa.array(copies[rows]),
                             pa.array([r.tobytes() for r in h[there]], pa.binary()), values.take(pa.array(there))],
                            names=["label", "len", "g", "cell", "at", "node", "copies", "h", "x"])

    src = distinct.select("label", "len", "node", "copies", "x")
    kind = src.schema["x"].dataType.simpleString()
    return src.mapInArrow(run, "label long, len int, g int, cell binary, at long, node long, copies long, h binary, "
                          f"x {kind}")


def units(cells: DataFrame) -> DataFrame:
    """The rows of each cell in each pair of its blocks, sorted by the group's first projection."""
    key = ["label", "len", "g", "cell"]
    many = cells.groupBy(*key).agg(F.count(F.lit(1)).alias("many")).where(F.col("many") > CELL)
    blocks = F.coalesce(F.ceil(F.col("many") / CELL), F.lit(1)).cast("int")
    block = F.pmod(F.xxhash64("node"), blocks).cast("int")
    dealt = cells.join(many, key, "left").withColumn("blocks", blocks).withColumn("block", block).withColumn(
        "other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    unit = F.xxhash64(*key, F.least("block", "other"), F.greatest("block", "other"))
    return dealt.select(unit.alias("unit"), *key, F.least("block", "other").alias("b1"), F.greatest("block", "other").alias("b2"),
                        "at", "block", "node", "copies", "h", "x").repartition("unit").sortWithinPartitions(
        "unit", *key, "b1", "b2", "at")


class Unit:
    """Vectors of one unit in the order of the group's first projection; finds the links among them."""

    def __init__(self, batch: pa.Table, design: Design):
        self.design = design
        self.g = batch["g"][0].as_py()
        self.cross = batch["b1"][0].as_py() != batch["b2"][0].as_py()
        self.cell = np.frombuffer(batch["cell"][0].as_py(), np.int64)
        self.block, self.node, self.copies = (batch[c].to_numpy() for c in ("block", "node", "copies"))
        self.h = np.frombuffer(b"".join(batch["h"].to_pylist()), np.int64).reshape(batch.num_rows, design.total)
        self.x = unit_vectors(batch["x"].combine_chunks())

    def of_group(self, g: int) -> slice:
        return slice(g * self.design.size, (g + 1) * self.design.size)

    def pairs(self) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Linked pairs, in parts."""
        d, h = self.design, self.h
        at = h[:, self.g * d.size]
        last = np.searchsorted(at, at + STEP, "right")
        size = last - np.arange(len(at)) - 1
        upto = np.cumsum(size)
        start = 0
        while start < len(at):
            end = max(start + 1, int(np.searchsorted(upto, (upto[start - 1] if start else 0) + PAIRS, "right")))
            many = size[start:end]
            i = np.repeat(np.arange(start, end), many)
            j = i + 1 + np.arange(len(i)) - np.repeat(np.cumsum(many) - many, many)
            for at0 in range(0, len(i), PAIRS):
                yield self.verified(i[at0:at0 + PAIRS], j[at0:at0 + PAIRS])
            start = end

    def verified(self, i: np.ndarray, j: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        d, h = self.design, self.h
        ok = self.block[i] != self.block[j] if self.cross else np.ones(len(i), bool)
        own = self.of_group(self.g)
        a, b = h[i, own], h[j, own]
        ok &= (np.abs(a - b) <= STEP).all(axis=1)
        # the one cell in which the pair counts
        ok &= (np.maximum(a // (2 * STEP), b // (2 * STEP)) == self.cell).all(axis=1)
        i, j = i[ok], j[ok]
        near = np.abs(h[i] - h[j]) <= STEP
        earlier = near[:, :self.g * d.size].reshape(len(i), self.g, d.size).all(axis=2).any(axis=1)
        ok = ~earlier & (near.sum(axis=1) >= d.least_collisions)
        i, j = i[ok], j[ok]
        ok = np.einsum("ij,ij->i", self.x[i], self.x[j]) >= d.least
        return i[ok], j[ok]

    def links(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(node, smallest node joined with here, links counted with copies) of each linked vector."""
        n = len(self.node)
        count, root = np.zeros(n, np.int64), np.argsort(np.argsort(self.node, kind="stable"))
        of_rank = np.sort(self.node)
        found = list(self.pairs())
        for i, j in found:
            np.add.at(count, i, self.copies[j])
            np.add.at(count, j, self.copies[i])
        before = None
        while before is None or (before != root).any():
            before = root.copy()
            for i, j in found:
                low = np.minimum(root[i], root[j])
                np.minimum.at(root, i, low)
                np.minimum.at(root, j, low)
        linked = np.flatnonzero(count)
        return self.node[linked], of_rank[root[linked]], count[linked]


def found_links(dealt: DataFrame, design: Design) -> DataFrame:
    """(node, root, links): what the units find."""
    key = ["unit", "label", "len", "g", "cell", "b1", "b2"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest: list[pa.RecordBatch] = []

        def done(t: pa.Table) -> Iterator[pa.RecordBatch]:
            if t.num_rows > 1:
                out = Unit(t, design).links()
                if len(out[0]):
                    yield pa.RecordBatch.from_arrays([pa.array(x) for x in out], names=["node", "root", "links"])

        for b in itertools.chain(batches, [None]):
            if b is not None:
                rest.append(b)
            if not rest:
                break
            now = pa.Table.from_batches(rest).combine_chunks()
            new = np.ones(now.num_rows, bool)
            if now.num_rows > 1:
                new[1:] = False
                for name in key:
                    c = now[name].combine_chunks()
                    new[1:] |= pc.not_equal(c.slice(1), c.slice(0, len(c) - 1)).to_numpy(zero_copy_only=False)
            starts = np.flatnonzero(new).tolist()
            # the last unit may go on in the next batch
            ends = [*starts[1:], now.num_rows] if b is None else starts[1:]
            for s, e in zip(starts, ends, strict=False):
                yield from done(now.slice(s, e - s))
            rest = [] if b is None else now.slice(starts[-1]).to_batches()

    return dealt.mapInArrow(run, "node long, root long, links long")


def near_duplicates(vectors: DataFrame, least: float = 0.98, recall: float = 0.99, vec_id: str = "vec_id",
                    embedding: str = "embedding", label: str = "label") -> DataFrame:
    """vec_id, n_links, component_id, kept: one row a vector."""
    x = col(embedding)
    fits = F.coalesce(F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
                      & F.exists(x, lambda v: v != 0), F.lit(False)) & col(label).isNotNull()
    rows = staged(vectors.select(F.monotonically_increasing_id().alias("row"), col(vec_id).cast("long").alias("id"),
                                 col(label).cast("long").alias("label"), F.size(x).alias("len"),
                                 F.when(fits, x).alias("x"), fits.alias("fits")), "vectors")
    key = ["label", "len", "x"]
    distinct = staged(rows.where("fits").groupBy(*key).agg(
        F.min("row").alias("node"), F.count(F.lit(1)).alias("copies"), F.min("id").alias("least_id")), "distinct")
    largest = distinct.groupBy("label", "len").count().agg(F.max("count")).first()[0] or 0
    design = calibrated(largest, least, recall)
    found = staged(found_links(units(placed(distinct, design)), design), "links")
    roots = components(found.where("node <> root").select(F.col("node").alias("a"), F.col("root").alias("b")).distinct())
    links = found.groupBy("node").agg(F.sum("links").alias("links"))
    named = distinct.join(links, "node", "left").join(roots.withColumnRenamed("root", "r"), "node", "left").select(
        *key, F.coalesce("r", "node").alias("root"), "least_id",
        (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"))
    named = staged(named, "named")
    smallest = named.groupBy("root").agg(F.min("least_id").alias("component_id"))
    per_vector = named.join(smallest, "root").select(*key, "n_links", "component_id")
    same = [F.col(f"o.{c}") == F.col(f"p.{c}") for c in key]
    linked = rows.where("fits").alias("o").join(per_vector.alias("p"), same).select("id", "n_links", "component_id")
    alone = rows.where("NOT fits").select("id", F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component_id"))
    return linked.unionByName(alone).select(
        F.col("id").alias("vec_id"), "n_links", "component_id", F.col("id").eqNullSafe(F.col("component_id")).alias("kept"))
