"""Hard negatives by slot-decomposed selection.

An anchor's positives are the ``n_positives`` other rows of its label with the highest inner
products.  For a positive of score s, the first ``n_negatives`` rows of other labels with a score
between ``low`` and ``high`` hundredths of s are wanted, so the windows of an anchor overlap.

Slots.  The upper limits of the positives' windows, in descending order, cut the scores below the
first of them into disjoint slots: slot j lies below limit j and above limit j + 1.  A row falls
into one slot of an anchor and is kept there only if it is among the best ``n_negatives`` of that
slot; what falls below the lowest window is not kept.  The window of positive j is all slots from
j downwards, cut at its lower limit.  So one merge from the last slot upwards, each step the best
of a slot and of what lies below it, answers every window: what the lower limit cuts off is the
end of that list.

Scale.  Anchors (a stated query set) are dealt into blocks of about ``ANCHORS`` and rows into
blocks of about ``ROWS``; each pair of blocks is one unit of a shuffle, in which the anchors come
first and the rows stream past them.  A task holds one block of anchors, one batch of rows and the
best of each slot, and hands on at most n_positives x n_negatives rows an anchor (the combiner);
windows with a group limit merge these.  Labels play no part in how rows are dealt, so a hot
label meets the same blocks as others.  Nothing passes the driver but two counts.

Scores are exact: components become floor(scale * x) as integers, products are summed in doubles
while they stay below 2**53 and in Python integers otherwise.

Cases: rows with a null label, id or vector, or with a null, NaN or infinite component, take no
part; a vector that ends early counts as if zeros followed; scores and components beyond a long are
held at its ends; repeated rows are rows of their own (an anchor leaves out only itself); equal
scores go to the smaller id, then label; a positive of negative score has an empty window, one of score 0 has that
of score 0; fewer rows than asked for give all there are; an empty table, or one without anchors,
gives no rows; other columns are ignored.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from carelake.llm.common import arrow_type, col, staged

#: anchors and rows of a pair of blocks, about
ANCHORS = 8192
ROWS = 1 << 16
#: scores that are worked out at one time
ANCHOR_STEP, ROW_STEP = 256, 4096
LONG = np.iinfo(np.int64)
EXACT = float(1 << 53)


def prepared(vectors: DataFrame, scale: int, vec_id: str, embedding: str, label: Column) -> DataFrame:
    """(row, id, label, q): rows that take part, numbered, their components as integers."""
    x = F.transform(col(embedding), lambda v: v.cast("double"))
    fits = F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    q = F.transform(x, lambda v: F.floor(F.least(F.greatest(v * scale, F.lit(-9.2e18)), F.lit(9.2e18))))
    src = vectors.select(col(vec_id).cast("long").alias("id"), label.cast("long").alias("label"), x.alias("x"), q.alias("q"),
                         fits.alias("fits"))
    return staged(src.where(F.col("id").isNotNull() & F.col("label").isNotNull() & F.col("fits")).select(
        F.monotonically_increasing_id().alias("row"), "id", "label", "q"), "vectors")


def blocks_of(rows: DataFrame, anchors: DataFrame) -> tuple[int, int]:
    """Numbers of anchor and row blocks: bounded blocks, and a unit for every core at least."""
    n_anchors, n_rows = anchors.count(), rows.count()
    across = max(1, -(-n_anchors // ANCHORS))
    cores = rows.sparkSession.sparkContext.defaultParallelism
    return across, max(1, -(-n_rows // ROWS), -(-2 * cores // across))


def paired(rows: DataFrame, anchors: DataFrame, state: list[str], across: int, down: int) -> DataFrame:
    """Every anchor (with its ``state`` columns) and every row in each unit of their blocks, anchors first."""
    a = anchors.select(
        F.pmod(F.xxhash64("row"), F.lit(across)).cast("int").alias("ab"),
        F.explode(F.sequence(F.lit(0), F.lit(down - 1))).alias("rb"), F.lit(0).alias("kind"), "row", "id", "label", "q", *state)
    none = [F.lit(None).cast(anchors.schema[c].dataType).alias(c) for c in state]
    r = rows.select(
        F.explode(F.sequence(F.lit(0), F.lit(across - 1))).alias("ab"),
        F.pmod(F.xxhash64("row", F.lit(1)), F.lit(down)).cast("int").alias("rb"), F.lit(1).alias("kind"), "row", "id",
        "label", "q", *none)
    return a.unionByName(r).repartition("ab", "rb").sortWithinPartitions("ab", "rb", "kind")


def matrix(q: pa.Array) -> tuple[np.ndarray, int]:
    """Integer vectors as rows, ends filled with zeros, and the largest magnitude."""
    offsets = q.offsets.to_numpy()
    values = q.values.to_numpy()[offsets[0]:offsets[-1]]
    size = np.diff(offsets)
    out = np.zeros((len(q), int(size.max(initial=0))), np.int64)
    out[np.arange(out.shape[1])[None, :] < size[:, None]] = values
    return out, int(max(abs(int(values.min(initial=0))), int(values.max(initial=0))))


def products(a: np.ndarray, most_a: int, b: np.ndarray, most_b: int) -> np.ndarray:
    """Exact inner products of the rows of two integer matrices."""
    d = min(a.shape[1], b.shape[1])
    a, b = a[:, :d], b[:, :d]
    if d * most_a * most_b < EXACT:
        return (a.astype(np.float64) @ b.T.astype(np.float64)).astype(np.int64)
    exact = a.astype(object) @ b.T.astype(object) if d else np.zeros((len(a), len(b)), object)
    return np.clip(exact, LONG.min, LONG.max).astype(np.int64)


class Best:
    """The best ``k`` candidates of each (anchor, slot): highest score, then smallest id, label and row."""

    FIELDS = ("anchor", "slot", "score", "id", "label", "row")

    def __init__(self, anchors: int, slots: int, k: int):
        self.k, self.slots = k, slots
        self.held = {f: np.zeros(0, np.int64) for f in self.FIELDS}
        #: no score below it can enter
        self.bar = np.full((anchors, slots), LONG.min)

    def add(self, **new: np.ndarray) -> None:
        enters = new["score"] >= self.bar[new["anchor"], new["slot"]]
        x = {f: np.concatenate((self.held[f], new[f][enters])) for f in self.FIELDS}
        # ~score sorts as -score does, without its overflow
        order = np.lexsort((x["row"], x["label"], x["id"], ~x["score"], x["slot"], x["anchor"]))
        place = x["anchor"][order] * self.slots + x["slot"][order]
        first = np.searchsorted(place, place, "left")
        rank = np.arange(len(place)) - first
        keep = order[rank < self.k]
        self.held = {f: v[keep] for f, v in x.items()}
        full = order[rank == self.k - 1]
        self.bar[x["anchor"][full], x["slot"][full]] = x["score"][full]


def candidates(dealt: DataFrame, state: list[str], slots: int, k: int, pick) -> DataFrame:
    """The combiner: (anchor, slot, score, id, label, row) of the best k of each slot in each unit.

    ``pick(scores, anchors, rows)`` gives for a matrix of scores the wanted (anchor, row)
    positions and their slots.
    """
    fields = [("anchor", "long"), ("slot", "int"), ("score", "long"), ("id", "long"), ("label", "long"), ("row", "long")]
    schema = ", ".join(f"{n} {t}" for n, t in fields)
    names = ["ab", "rb", "kind", "row", "id", "label", "q", *state]
    q_at = names.index("q")
    q_type = arrow_type(dealt.schema["q"].dataType)

    def side(batch: pa.RecordBatch) -> dict:
        q, most = matrix(batch.column(q_at).cast(q_type))
        out = {n: batch.column(i) for i, n in enumerate(names) if i > 2 and n != "q"}
        return {n: v.to_numpy(zero_copy_only=False) if n in ("row", "id", "label") else v for n, v in out.items()} | {
            "q": q, "most": most}

    def done(anchors: list[dict], best: list[Best]) -> Iterator[pa.RecordBatch]:
        for a, b in zip(anchors, best, strict=True):
            h = b.held | {"anchor": a["row"][b.held["anchor"]]}
            yield pa.RecordBatch.from_arrays(
                [pa.array(h[n], pa.int32() if t == "int" else pa.int64()) for n, t in fields], names=[n for n, _ in fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, anchors, best = None, [], []
        for b in batches:
            ab, rb, kind = (b.column(i).to_numpy() for i in range(3))
            cuts = np.flatnonzero((np.diff(ab) != 0) | (np.diff(rb) != 0) | (np.diff(kind) != 0)) + 1
            for s, e in itertools.pairwise([0, *cuts.tolist(), b.num_rows]):
                if s == e:
                    continue
                if key != (ab[s], rb[s]):
                    yield from done(anchors, best)
                    key, anchors, best = (ab[s], rb[s]), [], []
                if kind[s] == 0:
                    for i in range(s, e, ANCHOR_STEP):
                        anchors.append(side(b.slice(i, min(ANCHOR_STEP, e - i))))
                        best.append(Best(len(anchors[-1]["row"]), slots, k))
                    continue
                for i in range(s, e, ROW_STEP):
                    rows = side(b.slice(i, min(ROW_STEP, e - i)))
                    for a, of in zip(anchors, best, strict=True):
                        x, y, slot, score = pick(products(a["q"], a["most"], rows["q"], rows["most"]), a, rows)
                        if len(x):
                            of.add(anchor=x, slot=slot, score=score, id=rows["id"][y], label=rows["label"][y],
                                   row=rows["row"][y])
        yield from done(anchors, best)

    return dealt.select(*names).mapInArrow(run, schema)


def best_first(by: list[str]):
    return Window.partitionBy(*by).orderBy(F.desc("score"), "id", "label", "row")


def positives(rows: DataFrame, anchors: DataFrame, k: int, across: int, down: int) -> DataFrame:
    """(anchor, positives): the best k other rows of each anchor's label, in order, as an array."""
    def pick(scores, a, r):
        x, y = np.nonzero((a["label"][:, None] == r["label"][None, :]) & (a["row"][:, None] != r["row"][None, :]))
        return x, y, np.zeros(len(x), np.int64), scores[x, y]

    found = candidates(paired(rows, anchors, [], across, down), [], 1, k, pick)
    ranked = found.withColumn("rank", F.row_number().over(best_first(["anchor"]))).where(F.col("rank") <= k)
    return ranked.groupBy("anchor").agg(F.array_sort(F.collect_list(F.struct("rank", "id", "score"))).alias("positives"))


def limits(scores: np.ndarray, low: int, high: int) -> tuple[np.ndarray, np.ndarray]:
    """Smallest and largest integer score of each positive's window, without overflow."""
    s = [int(v) for v in scores]
    return (np.array([-(-low * v // 100) for v in s], np.int64), np.array([high * v // 100 for v in s], np.int64))


def slot_candidates(rows: DataFrame, anchors: DataFrame, slots: int, k: int, low: int, high: int, across: int,
                    down: int) -> DataFrame:
    """(anchor, slot, score, id, label, row): the best k rows of other labels of each slot in each unit."""
    def bounds(a: dict) -> tuple[np.ndarray, np.ndarray]:
        if "upper" not in a:
            # an unused slot's upper limit lets nothing in; the first limit of an anchor is its highest
            upper = np.full((len(a["row"]), slots), LONG.min)
            lower = np.full(len(a["row"]), LONG.max)
            for i, scores in enumerate(a["scores"].to_pylist()):
                lo, hi = limits(np.array(scores, object), low, high)
                upper[i, :len(hi)] = hi
                lower[i] = lo.min(initial=LONG.max)
            a["upper"], a["lower"] = upper, lower
        return a["lower"], a["upper"]

    def pick(scores, a, r):
        lower, upper = bounds(a)
        x, y = np.nonzero((scores <= upper[:, :1]) & (scores >= lower[:, None])
                          & (a["label"][:, None] != r["label"][None, :]))
        score = scores[x, y]
        return x, y, (score[:, None] <= upper[x]).sum(axis=1) - 1, score

    return candidates(paired(rows, anchors, ["scores"], across, down), ["scores"], slots, k, pick)


def slot_entries(slot: int) -> Column:
    return F.transform(F.filter("entries", lambda e: e["slot"] == slot), lambda e: e["entry"])


def mine(vectors: DataFrame, n_positives: int = 5, n_negatives: int = 10, low: int = 30, high: int = 90,
         every: int = 100, scale: int = 256, vec_id: str = "vec_id", embedding: str = "embedding",
         label: Column | str = "label") -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    Anchors are the rows whose id ``every`` divides; ``label`` may be an expression.
    """
    rows = prepared(vectors, scale, vec_id, embedding, col(label) if isinstance(label, str) else label)
    anchors = rows.where(F.col("id") % every == 0)
    across, down = blocks_of(rows, anchors)
    chosen = staged(positives(rows, anchors, n_positives, across, down), "positives")
    with_scores = anchors.join(chosen, F.col("row") == F.col("anchor")).select(
        "row", "id", "label", "q", F.col("positives.score").alias("scores"))
    found = slot_candidates(rows, with_scores, n_positives, n_negatives, low, high, across, down)
    place = F.row_number().over(best_first(["anchor", "slot"]))
    entry = F.struct(F.bitwise_not("score").alias("order"), "id", "label", "row", "score")
    slots = found.withColumn("place", place).where(F.col("place") <= n_negatives).groupBy("anchor").agg(
        F.collect_list(F.struct("slot", entry.alias("entry"))).alias("entries"))
    joined = chosen.join(slots, "anchor").join(anchors.select(F.col("row").alias("anchor"), F.col("id").alias("anchor_id")),
                                               "anchor")
    # from the last slot upwards: the best of a slot and of all that lies below it
    below, windows = None, []
    for j in reversed(range(n_positives)):
        own = slot_entries(j)
        joined = joined.withColumn(f"upto{j}", F.slice(F.array_sort(
            F.concat(own, below) if below is not None else own), 1, n_negatives))
        below = F.col(f"upto{j}")
        windows.append(F.struct(F.get("positives", F.lit(j)).alias("positive"), below.alias("negatives")))
    s = F.col("w.positive.score").cast("decimal(19,0)")
    n = F.col("n.score").cast("decimal(19,0)")
    return joined.select("anchor_id", F.explode(F.array(*windows)).alias("w")).where("w.positive IS NOT NULL").select(
        "anchor_id", "w", F.posexplode("w.negatives").alias("at", "n")).where(
        (s * low <= n * 100) & (n * 100 <= s * high)).select(
        "anchor_id", F.col("w.positive.id").alias("positive_id"), (F.col("at") + 1).cast("int").alias("rank"),
        F.col("n.id").alias("negative_id"), F.col("w.positive.score").alias("positive_score"),
        F.col("n.score").alias("negative_score"))
