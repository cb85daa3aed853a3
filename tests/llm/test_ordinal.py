import random

import numpy as np
from pyspark.sql import functions as F

from carelake.llm import ordinal


def corpus(n, seed):
    rnd = random.Random(seed)
    words = [f"{a}{b}{c}" for a in ("ba", "mo", "ri", "ten") for b in ("lu", "ka", "zo") for c in ("na", "el", "is")]
    out = []
    for i in range(n):
        w = [rnd.choice(words) for _ in range(rnd.randint(5, 80))]
        grade = rnd.choice([0, 1, 2, 2])
        if grade == 0:
            w = [x.upper() + "!!" for x in w]
        if grade == 1:
            w.insert(rnd.randrange(len(w)), rnd.choice(["vilefoo", "vilebar", "vilequx"]))
        out.append((i, " ".join(w), grade))
    return out


def test_held_out_accuracy_and_order():
    rows = corpus(900, 1)
    tool = ordinal.Features()
    x, y = [tool.of_text(t) for _, t, _ in rows], np.array([g for *_, g in rows])
    m = ordinal.fit_ordinal(x[:600], y[:600], 2)
    assert m.thresholds[0] <= m.thresholds[1]
    tails = m.tails(m.scores(x[600:]))
    assert (tails[:, 0] >= tails[:, 1]).all()
    assert ((tails > 0.5).sum(axis=1) == y[600:]).mean() > 0.97


def test_gradient_lowers_the_likelihood_to_that_of_the_truth():
    rows = corpus(300, 2)
    tool = ordinal.Features()
    x, y = [tool.of_text(t) for _, t, _ in rows], [g for *_, g in rows]

    def loss(m):
        t = m.tails(m.scores(x))
        p = np.where(np.array(y) == 0, 1 - t[:, 0], np.where(np.array(y) == 1, t[:, 0] - t[:, 1], t[:, 1]))
        return -np.log(np.maximum(p, 1e-12)).mean()
    assert loss(ordinal.fit_ordinal(x, y, 2, steps=200)) < loss(ordinal.fit_ordinal(x, y, 2, steps=5)) < 1.2


def test_classify(spark):
    rows = corpus(600, 3)
    docs = spark.createDataFrame([(i, t) for i, t, _ in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(g > 0), int(g == 1)) for i, _, g in rows if i % 2] + [(None, 1, 0), (1, None, 0)],
                                   "doc_id long, quality int, toxic int")
    got = {r.c0: r for r in ordinal.classify(docs, labels, least=0.5).collect()}
    held = [(got[i].keep, g == 2) for i, _, g in rows if i % 2 == 0]
    assert np.mean([a == b for a, b in held]) > 0.97
    assert all(0 <= r.r_tail_probability <= r.r_expected_grade <= 2 for r in got.values())


def test_odd_rows(spark, odd_docs, no_docs):
    labels = spark.createDataFrame([(1, 1, 0), (1, 0, 0), (4, 1, 0), (6, 1, 1)], "doc_id long, quality int, toxic int")
    none = labels.limit(0)
    assert ordinal.classify(odd_docs, labels).count() == odd_docs.count()
    kept = ordinal.keep_selected(odd_docs, none)
    assert kept.columns == odd_docs.columns and kept.count() == odd_docs.count()
    assert ordinal.keep_selected(no_docs, labels).count() == 0
    assert {r.grade for r in ordinal.graded(labels).where(F.col("doc_id") == 6).collect()} == {1}
