"""The divergence audit against plain Python integers over dense tables."""
import random
import re
from collections import Counter

import pytest

from carelake.llm import divergence

TERM = re.compile("[^\x00-\x40\x5b-\x60\x7b-\x7f]+")


def plain(rows, min_docs=10, top=10):
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    n, df, groups = Counter(), Counter(), set()
    for text, lang, source in rows:
        lang, source = lang or "", source or ""
        groups.add((lang, source))
        words = TERM.findall((text or "").translate(lower))
        for w in words:
            n[lang, source, w] += 1
        for w in set(words):
            df[lang, w] += 1
    out = set()
    for lang in {g for g, _ in groups}:
        kept = sorted(w for (lg, w), c in df.items() if lg == lang and c >= min_docs)
        sources = [s for lg, s in groups if lg == lang]

        def table(counts):
            total = sum(counts)
            return [1 + 10**9 * (c + 2) // (total + 2 * len(kept)) for c in counts]
        p = {s: table([n[lang, s, w] for w in kept]) for s in sources}
        q = table([sum(n[lang, s, w] for s in sources) for w in kept])
        f = lambda a, b: (a - b) ** 2 // (a + b)
        for s in sources:
            pairs = [(sum(map(f, p[s], p[o])), o) for o in sources if o != s]
            terms = [(f(a, b), w) for w, a, b in zip(kept, p[s], q, strict=True) if n[lang, s, w] and a > b]
            for part, found, limit in (("pair", pairs, None), ("term", terms, top)):
                found.sort(key=lambda x: (-x[0], x[1].encode()))
                out |= {(lang, s, part, item, value, i + 1) for i, (value, item) in enumerate(found[:limit])}
    return out


def rows_of(df):
    return [tuple(r) for r in df.select("lang", "source", "part", "item", "value", "rank").collect()]


def corpus(spark, seed=3, docs=400):
    rnd = random.Random(seed)
    words = [f"w{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(120)] + ["Straße", "Ünder", "漢字", "it's", "x1y", "don’t"]
    rows = []
    for _ in range(docs):
        source = rnd.choice(["hot"] * 6 + [f"s{i}" for i in range(6)] + [None, "é", "z"])
        lo = rnd.randrange(40)
        text = " ".join(rnd.choice(words[lo:]).title() if rnd.random() < .2 else rnd.choice(words[lo:])
                        for _ in range(rnd.randrange(40)))
        rows.append((text if rnd.random() < .95 else None, rnd.choice(["en", "en", "de", None]), source))
    rows += [("only here", "xx", "alone"), ("too rare", "yy", "a"), ("", "yy", "b"), (None, "yy", None)]
    rows += [("same words in every copy", "en", "copies")] * 30
    return rows, spark.createDataFrame(rows, "text string, lang string, source string")


@pytest.mark.parametrize("block", [3, 512])
def test_against_plain_integers(spark, block):
    rows, docs = corpus(spark)
    found = rows_of(divergence.audit(docs, block=block))
    assert len(found) == len(set(found))
    assert set(found) == plain(rows)


def test_ties_go_to_the_smaller_item(spark):
    rows = [(f"a b c d e f {s}x", "en", s) for s in "pqrs" for _ in range(12)]
    found = rows_of(divergence.audit(spark.createDataFrame(rows, "text string, lang string, source string"), top_terms=2))
    assert set(found) == plain(rows, top=2)
    assert [r[3] for r in sorted(found, key=lambda r: r[5]) if r[:3] == ("en", "p", "pair")] == ["q", "r", "s"]


def test_few_documents_keep_no_term(spark):
    docs = spark.createDataFrame([("a b", "en", "x"), ("a c", "en", "y")], "text string, lang string, source string")
    assert sorted(rows_of(divergence.audit(docs))) == [("en", "x", "pair", "y", 0, 1), ("en", "y", "pair", "x", 0, 1)]


def test_odd_rows_and_clashing_names(spark):
    rows, docs = corpus(spark, seed=5, docs=80)
    odd = docs.selectExpr("*", "1 AS n", "2 AS df", "'t' AS term", "3 AS t", "4 AS p", "5 AS value", "6 AS rank", "7 AS no",
                          "8 AS base", "9 AS rows", "0 AS `a.b`")
    assert set(rows_of(divergence.audit(odd))) == plain(rows)
    assert rows_of(divergence.audit(odd.limit(0))) == []


def test_long_text_is_read_whole(spark):
    long = "start " + "filler " * 400_000 + "END"
    assert [w for part in divergence.term_pieces(long.encode()) for w in part] == long.lower().encode().split()
    rows = [(long, "en", "a"), ("end filler", "en", "b")] * 10
    found = rows_of(divergence.audit(spark.createDataFrame(rows, "text string, lang string, source string")))
    assert set(found) == plain(rows)


def test_values_stay_exact_where_floats_do_not(spark):
    """Counts near the top of a long: p is taken with decimals."""
    from pyspark.sql import functions as F
    n, total, v = 9_000_000_000_000_000_000, 9_100_000_000_000_000_001, 1_234_567
    got = spark.range(1).select(divergence.smoothed(F.lit(n), F.lit(total), F.lit(v)).alias("p")).first().p
    assert got == 1 + 10**9 * (n + 2) // (total + 2 * v)
