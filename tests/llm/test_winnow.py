import hashlib
import random

import numpy as np
import pyarrow as pa
import pytest

from carelake.llm import winnow


def test_entries_match_brute_force():
    rnd = random.Random(1)
    for k, window in ((5, 4), (8, 7), (3, 1), (32, 64)):
        tool = winnow.Winnower(k, window)
        for n in (0, 1, 4, 5, 9, 12, 60, 300):
            text = "".join(rnd.choice("abé漢 ") for _ in range(n))
            want = "".join(f"{h}{p:08x}" for h, p in winnow.brute_force(text, k, window))
            assert winnow.as_text(tool.entries(text)) == want


def test_shared_run_gives_shared_entry():
    tool = winnow.Winnower(8, 10)
    rnd = random.Random(2)
    run = "".join(rnd.choice("abcdefgh ") for _ in range(17))  # k + window - 1
    a, b = "x" * 40 + run + "y" * 40, "z" * 13 + run + "w" * 25
    assert set((tool.entries(a) >> np.uint64(32)).tolist()) & set((tool.entries(b) >> np.uint64(32)).tolist())


def test_rightmost_of_equal_hashes():
    tool = winnow.Winnower(2, 4)
    positions = (tool.entries("aaaaaaa") & np.uint64(0xFFFFFFFF)).tolist()
    assert positions == [3, 4, 5]


def test_likeness():
    a, b = np.array([1, 2, 3], np.uint64), np.array([2, 3, 4], np.uint64)
    assert winnow.likeness(a, b) == 0.5
    assert winnow.likeness(a[:0], a[:0]) == 1.0 and winnow.likeness(a, a[:0]) == 0.0


def test_larger_windows_choose_from_smaller_ones():
    rnd = random.Random(5)
    text = "".join(rnd.choice("abc ") for _ in range(500))
    fine, coarse = (set(winnow.Winnower(6, w).entries(text).tolist()) for w in (5, 31))
    assert coarse < fine
    tool = winnow.Winnower(6, 31, short=500, short_window=5)
    assert set(tool.entries(text).tolist()) == fine and tool.entries(text + "d").size < len(fine)


def test_edited_texts_share_entries_from_64_code_points():
    tool = winnow.Winnower(16, 64, 512, 16)
    rnd = random.Random(7)
    word = lambda n: "".join(rnd.choice("abcdefghijklmnopqrstuvwxyz ") for _ in range(n))
    for n in (*range(64, 200, 3), 300, 511, 512, 513, 700, 1024, 1025, 3000):
        text = word(n)
        for following in ("", word(20), word(5000)):
            a, b = (np.unique(tool.entries(t) >> np.uint64(32)) for t in (text, winnow.edited(text, following)))
            assert winnow.likeness(a, b) > 0


@pytest.fixture
def small_blocks():
    old, winnow.ROWS_PER_BLOCK, winnow.SAMPLES = (winnow.ROWS_PER_BLOCK, winnow.SAMPLES), 9, 4
    yield
    winnow.ROWS_PER_BLOCK, winnow.SAMPLES = old


def test_neighbours_follow_descending_ids(spark, small_blocks):
    rnd = random.Random(3)
    texts = {i * 7 - 50: "".join(rnd.choice("abcdef ") for _ in range(rnd.randint(0, 200))) for i in range(60)}
    texts |= {1 << 60: "far away", -(1 << 63): "least"}  # ids out of line with the others
    rows = winnow.fingerprint_neighbours(
        spark.createDataFrame(list(texts.items()), "doc_id long, text string"), k=6, window=20, short=90, short_window=8).collect()
    ids = sorted(texts, reverse=True)
    tool = winnow.Winnower(6, 20, 90, 8)
    hashes = lambda t: np.unique(tool.entries(t) >> np.uint64(32))
    got = {r.doc_id: r for r in rows}
    assert len(rows) == len(ids)
    for i, following in zip(ids, ids[1:] + ids[:1], strict=True):
        t = texts[i]
        e = t[:len(t) - len(t) // 2] + texts[following][:len(t) // 2]
        assert got[i].n_chars == len(t)
        assert got[i].edited_sha256 == hashlib.sha256(e.encode()).hexdigest()
        assert got[i].fingerprint == winnow.as_text(tool.entries(t))
        assert got[i].edited_fingerprint == winnow.as_text(tool.entries(e))
        assert got[i].near_edited == winnow.likeness(hashes(t), hashes(e))
        assert got[i].near_next == winnow.likeness(hashes(t), hashes(texts[following]))


def test_hot_ids_are_cut_by_text_and_every_block_has_one_guest(spark, small_blocks):
    rows = ([(None, f"no id {i}") for i in range(150)] + [(7, f"seven {i}") for i in range(150)] + [(7, "same")] * 60
            + [(i, f"own {i}") for i in range(100, 200)] + [(1 << 60, "far")])
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    dealt = winnow.blocks(docs, "doc_id", "text").collect()
    home = [r for r in dealt if not r.guest]
    assert sorted(map(repr, ((r.id, r.t) for r in home))) == sorted(map(repr, rows))
    guests = {r.block: r for r in dealt if r.guest}
    assert len(guests) == len(dealt) - len(home)
    numbers = sorted({r.block for r in home})
    assert sorted(guests) == numbers
    per = {b: [r for r in home if r.block == b] for b in numbers}  # rows of a block come sorted
    for b, after in zip(numbers, numbers[1:] + numbers[:1], strict=True):
        assert (guests[b].id, guests[b].t) == (per[after][0].id, per[after][0].t)
    ids = [r.id for b in numbers for r in per[b]]
    assert ids == sorted((i for i in ids if i is not None), reverse=True) + [None] * 150
    assert sum(any(r.id is None for r in v) for v in per.values()) > 4
    assert sum(any(r.id == 7 for r in v) for v in per.values()) > 4
    assert winnow.fingerprint_neighbours(docs).count() == len(rows)


def test_block_numbers_rise_in_descending_id_order():
    ids = [5] * 40 + list(range(-20, 40)) + [None] * 9 + [2**63 - 1, -2**63]
    rnd = random.Random(8)
    bounds = winnow.Bounds(pa.chunked_array([pa.array(ids, pa.int64())]))
    rows = sorted(((i is None, ~(i or 0), rnd.randrange(1 << 63)) for i in ids))
    null, down, th = (np.array(x) for x in zip(*rows, strict=True))
    found = bounds.find(down, null, th)
    assert (np.diff(found) >= 0).all()
    empty = winnow.Bounds(pa.chunked_array([pa.array([], pa.int64())]))
    assert empty.find(down, null, th).tolist() == [1 if x else 0 for x in null]


def test_odd_rows(odd_docs, no_docs):
    rows = winnow.fingerprint_neighbours(odd_docs).collect()
    assert len(rows) == odd_docs.count()
    assert [r.fingerprint for r in rows if r.n_chars == 0] == ["", "", ""]
    assert len({r.fingerprint for r in rows if r.n_chars > 100_000}) == 1
    assert winnow.fingerprint_neighbours(no_docs).count() == 0
