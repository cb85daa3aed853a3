import hashlib
import random

from carelake.llm import decontam


def test_search_matches_brute_force():
    rnd = random.Random(5)
    words = ["a", "b", "Cé", "d1", "ee"]
    for window in (1, 2, 3, 5, 13):
        items = [(str(i), " ".join(rnd.choice(words) for _ in range(rnd.randint(0, 16)))) for i in range(8)]
        found = decontam.machines(items, window)
        for _ in range(40):
            text = " ".join(rnd.choice(words) for _ in range(rnd.randint(0, 60)))
            w, hits, names = decontam.words_of(text), [], set()
            for m in found:
                m.search(w, hits, names)
            n_words, n_hit, want, _ = decontam.brute_force(text, items, window)
            assert (len(w), sum(e - s for s, e in decontam.merge_spans(hits)), sorted(names)) == (n_words, n_hit, want)


def test_words():
    assert decontam.words_of("Ab-9É x_y\n`Z") == [b"ab", "9É".encode(), b"x", b"y", b"z"]
    assert decontam.words_of(None) == []


def test_documents_in_one_shard_and_in_several(spark, sf):
    docs, bench = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("documents", "benchmark"))
    whole = decontam.digest(decontam.find_contamination(docs, bench))
    parts = decontam.digest(decontam.find_contamination(docs, bench, max_shard_bytes=1500))
    assert whole.exceptAll(parts).count() == 0 and whole.count() == parts.count()
    items = [(str(r.item_id), r.text) for r in bench.collect()]
    got = {r.doc_id: r for r in whole.collect()}
    for d in docs.limit(40).collect():
        n, hit, names, bad = decontam.brute_force(d.text, items)
        g = got[d.doc_id]
        assert (g.n_words, g.n_hit, g.n_items, g.contaminated) == (n, hit, len(names), bad)
        assert g.items_sha256 == hashlib.sha256(",".join(names).encode()).hexdigest()


def test_odd_rows(spark, odd_docs, no_docs):
    bench = spark.createDataFrame([(1, "alpha beta"), (1, "gamma"), (2, None), (3, "  "), (None, "shared1 shared2")],
                                  "item_id long, text string")
    got = decontam.digest(decontam.find_contamination(odd_docs, bench)).collect()
    assert len(got) == odd_docs.count()
    first = next(r for r in got if r.doc_id == 1)
    assert (first.n_words, first.n_hit, first.n_items, first.contaminated) == (120, 90, 1, True)
    kept = decontam.drop_contaminated(odd_docs, bench)
    assert kept.columns == odd_docs.columns and kept.where("doc_id = 1").count() == 0
    assert decontam.drop_contaminated(odd_docs, bench.limit(0)).count() == odd_docs.count()
    assert decontam.drop_contaminated(no_docs, bench).count() == 0
