import random

import numpy as np
import xxhash

from carelake.llm import simhash


def plain(text, n=3):
    import re
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    w = re.findall(r"[^\x20\x09-\x0D]+", low)
    if not w:
        return 0
    h = [xxhash.xxh64(" ".join(w[i:i + n]).encode(), seed=42).intdigest() for i in range(max(1, len(w) - n + 1))]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def test_fingerprint():
    for t in (None, "", "One", "one TWO", "a b c", "É a b c\x0bd " * 7, "x " * 70_000):
        assert simhash.fingerprint(t) == plain(t)


def test_links_keep_every_component():
    rnd = random.Random(4)
    for trial in range(3):
        base = [rnd.getrandbits(64) for _ in range(30)]
        prints = set(base)
        for _ in range(400):  # chains of near fingerprints
            f = rnd.choice(sorted(prints))
            for _ in range(rnd.randint(1, 4)):
                f ^= 1 << rnd.randrange(64)
            prints.add(f)
        prints = sorted(prints)
        fp = np.array(prints, np.uint64)
        found = simhash.linked_within(np.zeros(len(fp)), np.ones(len(fp), bool), fp, 3)
        assert all((prints[a] ^ prints[b]).bit_count() <= 3 for a, b in found)
        want = simhash.brute_force(list(range(len(fp))), prints)
        assert len(found) == len(fp) - len(set(want))


def test_crowded_cells_are_cut_and_keep_every_component(spark, monkeypatch):
    rnd = random.Random(9)
    base = rnd.getrandbits(64)
    prints = {base ^ sum(1 << b for b in rnd.sample(range(26), rnd.randint(0, 9))) for _ in range(500)}
    for _ in range(150):
        f = rnd.choice(sorted(prints))
        prints.add(f ^ 1 << rnd.randrange(64) ^ 1 << rnd.randrange(64) ^ 1 << rnd.randrange(64))
    prints |= {rnd.getrandbits(64) for _ in range(200)}
    prints = sorted(prints)
    table = spark.createDataFrame([(simhash.signed(p),) for p in prints], "fp long")
    whole = simhash.units(table, 3).groupBy("k").count().agg({"count": "max"}).first()[0]
    monkeypatch.setattr(simhash, "CROWD", 24)
    largest = simhash.units(table, 3).groupBy("k").count().agg({"count": "max"}).first()[0]
    assert whole > 300 and largest <= 60
    found = [(prints.index(r.a & (1 << 64) - 1), prints.index(r.b & (1 << 64) - 1))
             for r in simhash.links(table, 3).collect()]
    assert all((prints[a] ^ prints[b]).bit_count() <= 3 for a, b in found)
    root = list(range(len(prints)))
    for a, b in found:
        old, new = root[b], root[a]
        root = [new if r == old else r for r in root]
    want = simhash.brute_force(list(range(len(prints))), prints)
    assert len(set(root)) == len(set(want))
    assert all((root[i] == root[j]) == (want[i] == want[j]) for i in range(len(root)) for j in range(i))


def test_near_duplicates_match_brute_force(spark):
    rnd = random.Random(6)
    words = [f"w{i}" for i in range(400)]
    texts = []
    for _ in range(25):
        w = [rnd.choice(words) for _ in range(rnd.randint(60, 200))]
        for _ in range(rnd.randint(1, 6)):
            v = list(w)
            for _ in range(rnd.randint(0, 2)):
                v[rnd.randrange(len(v))] = rnd.choice(words)
            texts.append(" ".join(v))
    texts += ["", None, "", "x y", "X Y"]
    rows = [(1000 - 3 * i, t) for i, t in enumerate(texts)]
    got = {r.doc_id: r.component_id for r in simhash.near_duplicates(
        spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    want = simhash.brute_force([i for i, _ in rows], [plain(t) for _, t in rows])
    assert [got[i] for i, _ in rows] == want


def test_long_chain(spark):
    chain = [0]
    for b in range(64):
        chain.append(chain[-1] | 1 << b)
    signed = [(x - (1 << 64) if x >> 63 else x,) for x in chain]
    roots = simhash.components(simhash.links(spark.createDataFrame(signed, "fp long"), 3)).collect()
    assert len({r.root for r in roots}) == 1 and len(roots) == 64  # all but the root


def test_odd_rows(odd_docs, no_docs):
    got = simhash.near_duplicates(odd_docs).collect()
    assert len(got) == odd_docs.count()
    assert {r.component_id for r in got if r.fp == 0} == {2}
    kept = simhash.keep_first(odd_docs)
    assert kept.columns == odd_docs.columns
    ids = [r.doc_id for r in kept.collect()]
    assert 2 in ids and 3 not in ids and 4 in ids and 5 not in ids and ids.count(None) == 1  # the empty row without id goes with 2
    assert simhash.near_duplicates(no_docs).count() == 0


def test_keep_first_keeps_one_row(spark):
    """Repeated rows, an id with two texts, and copies among null ids and beside rows with one."""
    a, b, c, d = (" ".join(f"{x}{i}" for i in range(80)) for x in "abcd")
    rows = [(1, a)] * 3 + [(1, b), (2, b), (2, c), (3, c)] + [(None, d)] * 4 + [(None, a), (None, c)]
    kept = simhash.keep_first(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted(((r.doc_id, r.text) for r in kept), key=str) == sorted([(1, a), (1, b), (2, c), (None, d)], key=str)
