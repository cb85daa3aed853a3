import corpus_pipeline
import public_tokenizers
import pytest

from carelake.llm import decontam, ordinal, packing, simhash, substring
from carelake.llm.common import table


def test_run_matches_brute_force(spark, sf):
    """The stages' decisions, each taken by plain code from what the stage before kept."""
    docs = table(spark, sf, "documents")
    kept = {r.c0: r.r_tail_probability for r in ordinal.classify(docs, table(spark, sf, "labels")).collect()}
    rows = [(r.doc_id, r.text) for r in docs.collect() if kept[r.doc_id] >= 0.8]
    least = simhash.brute_force([i for i, _ in rows], [simhash.fingerprint(t) for _, t in rows])
    rows = [r for r, c in zip(rows, least, strict=True) if r[0] == c]
    words = substring.brute_force(rows)
    rows = [(i, t if len(words[i]) == len(substring.words_of(t)) else " ".join(words[i])) for i, t in rows]
    items = [(str(r.item_id), r.text) for r in table(spark, sf, "benchmark").collect()]
    rows = [(i, t) for i, t in rows if not decontam.brute_force(t, items)[3]]
    cache = packing.WordCache(public_tokenizers.path("word_bpe_49k.json"))
    want = sorted((i, k, min(4096, n - 4096 * k)) for i, t in rows for n in [len(cache.ids(t)) // 4 + 1]
                  for k in range(-(-n // 4096)))
    got = corpus_pipeline.run(spark, sf).collect()
    assert sorted((r.doc_id, r.piece, r.length) for r in got) == want


def test_stages_return_documents(spark, sf, odd_docs):
    cols = table(spark, sf, "documents").columns
    docs = odd_docs.selectExpr("doc_id", "text", "'en' AS lang", "'s' AS source", "cast(n_chars AS long) AS n_chars")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, sf)
        assert docs.columns == cols, name
    assert corpus_pipeline.STAGES[-1][1](spark, docs, sf).count() >= docs.count()
    empty = table(spark, sf, "documents").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, empty, sf).count() == 0
    assert corpus_pipeline.ORACLE_SQL is None


def test_planted_cases_are_caught_and_clean_documents_kept(spark, sf):
    clean = " ".join(f"clean{i}" for i in range(120))
    item = table(spark, sf, "benchmark").where("length(text) > 150").first().text
    rows = [(900001, clean), (900002, clean), (900003, item + " " + " ".join(f"x{i}" for i in range(40)))]
    docs = spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in rows], table(spark, sf, "documents").schema)
    stages = dict(corpus_pipeline.STAGES)
    assert [r.doc_id for r in stages["SimHash near-dedup"](spark, docs, sf).orderBy("doc_id").collect()] == [900001, 900003]
    assert [r.doc_id for r in stages["benchmark decontamination"](spark, docs, sf).orderBy("doc_id").collect()] == [900001, 900002]
    with pytest.raises(KeyError):
        dict(corpus_pipeline.STAGES)["none"]
