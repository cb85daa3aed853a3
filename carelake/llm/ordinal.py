"""Quality classifier: ordinal cumulative-link regression on graded ratings.

A text becomes a set of hashed features: its words, their first letters and, in tenths,
how much of it is upper case, symbols, repetition and the like.  One weight vector is
shared by all grades; ordered thresholds cut the score s = w.x:
P(grade >= j) = sigmoid(s - threshold_j).  The fit minimises the negative log likelihood
with an L1 penalty by accelerated proximal gradient steps.  Scoring gives the expected
grade and the tail probability of the grade that selection asks for.

The fit uses a sample of ``SAMPLE_ROWS`` labelled documents at most (those with the
smallest hashed ids), a row of which has ``2 ** BITS`` features at most.  The model, of
that size too, is broadcast; every document is scored on its whole text.

Cases: a null text is empty; an empty text has only the feature that says so; rows with a
null id or grade teach nothing; several ratings of an id count as its lowest; documents
that repeat an id are separate examples; without any rating every grade is the highest;
grades that do not occur keep a small prior; other columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from carelake.llm.common import col, map_text, restore

BITS = 18
SAMPLE_ROWS = 8000
FEATURES = T.StructType([T.StructField("x", T.BinaryType())])
SCORES = T.StructType([T.StructField("expected_grade", T.DoubleType()), T.StructField("tail_probability", T.DoubleType())])
EDGES = re.compile(r"^\W+|\W+$")


def bucket(name: str) -> int:
    return xxhash.xxh32_intdigest(name) & ((1 << BITS) - 1)


class Features:
    """Hashed features of texts; what frequent words give is kept."""

    def __init__(self, most: int = 200_000):
        self.known: dict[str, tuple[int, ...]] = {}
        self.most = most

    def of_word(self, word: str) -> tuple[int, ...]:
        bare = EDGES.sub("", word).lower()
        if not bare:
            return ()
        return (bucket("w " + bare), *(bucket(f"{n} {bare[:n]}") for n in (4, 5) if len(bare) >= n))

    def of_text(self, text: str | None) -> np.ndarray:
        words = (text or "").split()
        n = len(words)
        if not n:
            return np.array([bucket("empty")], np.int32)
        distinct = set(words)
        known = self.known
        if len(known) > self.most:
            known.clear()
        found: set[int] = set()
        for w in distinct:
            x = known.get(w)
            if x is None:
                x = known[w] = self.of_word(w)
            found.update(x)
        lines = text.split("\n")
        plain = sum(map(str.isalpha, words))
        shares = {"upper": sum(map(str.isupper, words)) / n,
                  "symbols": sum(1 for w in words if not w[-1].isalnum() and w[-1] not in ".,;:?)\"'") / n,
                  "alpha": plain / n,
                  "same as next": sum(map(str.__eq__, words, words[1:])) / n,
                  "bars": words.count("|") / n,
                  "same lines": 1 - len(set(lines)) / len(lines)}
        for name, share in shares.items():
            for tenth in range(1, 1 + int(10 * share)):
                found.add(bucket(f"share {name} {tenth}"))
        return np.fromiter(found, np.int32, len(found))


@dataclass
class OrdinalModel:
    weights: np.ndarray
    thresholds: np.ndarray

    def scores(self, features: Sequence[np.ndarray]) -> np.ndarray:
        return np.array([self.weights[x].sum() for x in features], float)

    def tails(self, s: np.ndarray) -> np.ndarray:
        """P(grade >= j) for j = 1, 2, ... in columns."""
        return sigmoid(s[:, None] - self.thresholds[None, :])


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * (1 + np.tanh(0.5 * x))


def fit_ordinal(features: Sequence[np.ndarray], grades: Sequence[int], top: int, penalty: float = 2e-4,
                least_docs: int = 3, most_share: float = 0.3, steps: int = 400) -> OrdinalModel:
    """Weights of buckets that ``least_docs`` examples have, but no more than ``most_share`` of
    all (what most texts share tells little), and ``top`` ordered thresholds."""
    y = np.asarray(grades, int)
    share = np.array([np.count_nonzero(y == g) for g in range(top + 1)], float) + 0.5
    if not len(y):
        return OrdinalModel(np.zeros(1 << BITS), np.full(top, -50.0))
    share /= share.sum()
    above = np.cumsum(share[::-1])[::-1][1:]
    theta = -np.log(above / (1 - above))
    sizes = np.array([len(x) for x in features])
    flat = np.concatenate(features)
    kept, place = np.unique(flat, return_inverse=True)
    seen = np.bincount(place)
    frequent = (seen >= least_docs) & (seen <= most_share * len(y))
    number = np.cumsum(frequent) - 1
    mask = frequent[place]
    rows = np.repeat(np.arange(len(y)), sizes)[mask]
    cols = number[place[mask]]
    m, n = int(frequent.sum()), len(y)

    def tail(s, theta):
        """P(grade >= y) and P(grade > y) of each row."""
        lo = np.where(y > 0, s - theta[np.maximum(y - 1, 0)], np.inf)
        hi = np.where(y < top, s - theta[np.minimum(y, top - 1)], -np.inf)
        return sigmoid(lo), sigmoid(hi)

    def gradient(w, theta):
        s = np.bincount(rows, w[cols], n)
        a, b = tail(s, theta)
        p = np.maximum(a - b, 1e-12)
        g = np.bincount(cols, (a + b - 1)[rows], m) / n
        t = np.zeros(top)
        np.add.at(t, np.maximum(y - 1, 0), np.where(y > 0, a * (1 - a) / p, 0))
        np.add.at(t, np.minimum(y, top - 1), np.where(y < top, -b * (1 - b) / p, 0))
        return -np.log(p).mean(), g, t / n

    w = np.zeros(m)
    # the Hessian is at most X'X / 2n, which the row sums of X'X bound feature by feature
    rate = 2 * n / np.maximum(np.bincount(cols, np.bincount(rows, minlength=n)[rows], m), 1)
    momentum, back, back_theta = 1.0, w, theta
    for _ in range(steps):
        loss, g, t = gradient(back, back_theta)
        new = back - rate * g
        new = np.sign(new) * np.maximum(np.abs(new) - rate * penalty, 0)
        new_theta = np.maximum.accumulate(back_theta - 0.5 * t)
        later = (1 + (1 + 4 * momentum ** 2) ** 0.5) / 2
        k = (momentum - 1) / later
        back, back_theta = new + k * (new - w), new_theta + k * (new_theta - theta)
        w, theta, momentum = new, new_theta, later
    weights = np.zeros(1 << BITS)
    weights[kept[frequent]] = w
    return OrdinalModel(weights, theta)


def featured(docs: DataFrame, text: str, carry: Sequence[str]) -> DataFrame:
    def start():
        tool = Features()
        return lambda texts: ([tool.of_text(t).tobytes() for t in texts],)

    return map_text(docs, text, FEATURES, start, carry)


def fit(docs: DataFrame, ratings: DataFrame, top: int, doc_id: str = "doc_id", text: str = "text",
        sample_rows: int = SAMPLE_ROWS, **options) -> OrdinalModel:
    """Fit on a bounded sample.  ``ratings``: rows of (the id, grade 0..top)."""
    rated = ratings.select(col(doc_id).alias("__id"), F.col("grade").cast("int").alias("__grade")).where(
        "__id is not null and __grade is not null")
    chosen = rated.groupBy("__id").agg(F.min("__grade").alias("__grade")).orderBy(
        F.xxhash64("__id"), "__id").limit(sample_rows)
    picked = docs.select(col(doc_id).alias("id"), col(text).alias("text")).join(
        F.broadcast(chosen), F.col("id") == F.col("__id")).select("id", "text", "__grade")
    # features are bounded, texts are not; documents that repeat an id could exceed the number of rows
    made = featured(picked.withColumn("th", F.xxhash64("text")), "text", ["__grade", "id", "th"])
    rows = made.orderBy(F.xxhash64("c1"), "c1", "c2").limit(sample_rows).collect()
    return fit_ordinal([np.frombuffer(r.r_x, np.int32) for r in rows], [r.c0 for r in rows], top, **options)


def score(docs: DataFrame, model: OrdinalModel, select_grade: int, text: str = "text",
          carry: Sequence[str] = ("doc_id",)) -> DataFrame:
    """The carried columns as c0, c1, ..., r_expected_grade and r_tail_probability (of ``select_grade`` or more)."""
    sent = docs.sparkSession.sparkContext.broadcast((model.weights, model.thresholds))

    def start():
        tool, m = Features(), OrdinalModel(*sent.value)

        def each(texts: list):
            tails = m.tails(m.scores([tool.of_text(t) for t in texts]))
            return tails.sum(axis=1).tolist(), tails[:, select_grade - 1].tolist()
        return each

    return map_text(docs, text, SCORES, start, list(carry))


def graded(labels: DataFrame, doc_id: str = "doc_id") -> DataFrame:
    """Grades of the label table: 0 poor, 1 sound but toxic, 2 sound and clean."""
    grade = F.when(F.col("quality") == 0, 0).when(F.col("toxic") == 1, 1).when(
        (F.col("quality") == 1) & (F.col("toxic") == 0), 2)
    return labels.select(col(doc_id), grade.alias("grade"))


def classify(docs: DataFrame, labels: DataFrame, least: float = 0.8, carry: Sequence[str] = ("doc_id",),
             **options) -> DataFrame:
    """Score every document by a model fitted on the labels; ``keep``: P(grade 2) is ``least`` or more."""
    model = fit(docs, graded(labels), top=2, **options)
    return score(docs, model, 2, carry=carry).withColumn("keep", F.col("r_tail_probability") >= least)


def keep_selected(docs: DataFrame, labels: DataFrame, **options) -> DataFrame:
    """The documents that the classifier selects, with all their columns."""
    names = docs.columns
    return classify(docs, labels, carry=names, **options).where("keep").select(*restore(docs, names))
