import random

import pytest
import xxhash

from carelake.llm import substring


def corpus(seed, words):
    rnd = random.Random(seed)
    voc = [f"w{i}" for i in range(words)]
    base = [[rnd.choice(voc) for _ in range(rnd.randint(20, 60))] for _ in range(8)]
    rows = []
    for i in range(120):
        w = []
        for _ in range(rnd.randint(0, 4)):
            if rnd.random() < 0.5:
                w += rnd.choice(base)[rnd.randint(0, 10):]
            else:
                w += [rnd.choice(voc) for _ in range(rnd.randint(1, 30))]
        rows.append((i * 3 - 100, " ".join(w)))
    return rows


@pytest.mark.parametrize("words, most", [(40, 256), (40, 2), (2, 256)])
def test_matches_brute_force(spark, monkeypatch, words, most):
    monkeypatch.setattr(substring, "MOST_PIECES", most)
    rows = corpus(words, words)
    got = substring.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    want = substring.brute_force(rows)
    assert {r.c0: r.r_kept for r in got} == {i: " ".join(w) for i, w in want.items()}
    for r in got:
        assert r.r_n_removed == sum(s["end"] - s["start"] for s in r.r_spans) == r.r_n_words - len(want[r.c0])


def test_statistics_match_brute_force():
    rnd = random.Random(9)
    for _ in range(60):
        pieces = [[rnd.choice("abc") for _ in range(rnd.randint(0, 15))] for _ in range(4)]
        known = substring.SuffixAutomaton()
        for p in pieces:
            known.add(p)
        text = [rnd.choice("abcd") for _ in range(30)]
        joined = ["".join(p) for p in pieces]
        want = [max(n for n in range(i + 2) if any("".join(text[i + 1 - n:i + 1]) in p for p in joined)) for i in range(30)]
        assert known.statistics(text) == want


def test_word_hashes_follow_the_words():
    tool = substring.Hasher()
    a, b = tool.words("x é y \t漢 x"), tool.words("x")
    assert len(a) == 4 and a[0] == a[3] == b[0] and len(set(a.tolist())) == 3


def test_odd_rows(odd_docs, no_docs):
    got = substring.remove_repeats(odd_docs).collect()
    assert len(got) == odd_docs.count()
    by_id = {}
    for r in got:
        by_id.setdefault(r.c0, []).append((r.r_n_words, r.r_n_removed))
    assert by_id[2] == [(0, 0)] and by_id[3] == [(0, 0)] and by_id[8] == [(0, 0)]
    assert by_id[4] == [(60000, 0)] and by_id[5] == [(60000, 60000)] * 2
    assert by_id[6] == [(43, 0)] and sorted(by_id[7]) == [(6, 0), (43, 40)]
    assert sorted(by_id[None]) == [(0, 0), (42, 40)]
    done = substring.rewrite(odd_docs)
    assert done.columns == odd_docs.columns
    five = done.where("doc_id = 5").first()
    assert (five.text, five.n_chars) == ("", 0)
    assert done.where("doc_id = 9").first().text == "é ü ñ 漢字 text"  # it repeats itself
    assert done.where("doc_id = 6").first().text == odd_docs.where("doc_id = 6").first().text
    assert substring.rewrite(no_docs).count() == 0


def kept(spark, rows):
    got = substring.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    return sorted(((r.c0, r.r_n_words, r.r_n_removed) for r in got), key=str)


@pytest.mark.parametrize("most", [256, 1])
def test_repeated_rows_do_not_repeat_themselves(spark, monkeypatch, most):
    monkeypatch.setattr(substring, "MOST_PIECES", most)
    passage = " ".join(f"p{i}" for i in range(40))
    rows = [(1, "one " + passage + " end")] * 3 + [(2, "another " + passage + " stop")] * 2
    assert kept(spark, rows) == [(1, 42, 0)] * 3 + [(2, 42, 40)] * 2


def test_null_ids_with_like_hashes(spark):
    """Two texts without an id that agree in the hash's low bits are two documents."""
    passage = " ".join(f"p{i}" for i in range(40))
    seen = {}
    for i in range(1_000_000):
        t = f"{passage} {i} " + "x " * (i % 2 * 60)
        other = seen.setdefault(xxhash.xxh64_intdigest(t, 42) & 0x7FFFFFFF, t)
        if len(other) != len(t) and abs(len(other) - len(t)) > 50:
            break
    n = {x: len(x.split()) for x in (t, other)}
    alone = {x: kept(spark, [(None, x)])[0][2] for x in n}
    total = sum(r[2] for r in kept(spark, [(1, passage), (None, t), (None, other)]))
    longest = max(n, key=n.get)
    assert sorted(n.values()) == [41, 101] and total == 80 + alone[longest]


@pytest.mark.parametrize("window", [5, 23, 50])
def test_other_windows_match_brute_force(spark, window):
    rows = corpus(window, 40)
    rnd = random.Random(window)
    long = [f"v{rnd.randrange(300)}" for _ in range(400)]
    rows += [(1000 + i, " ".join(long[i * 9:i * 9 + 200])) for i in range(12)]
    got = substring.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string"), window=window).collect()
    assert {r.c0: r.r_kept for r in got} == {i: " ".join(w) for i, w in substring.brute_force(rows, window).items()}
