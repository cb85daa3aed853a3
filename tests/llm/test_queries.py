"""The queries against their SQL, on the smallest tables."""
import duckdb
import pandas as pd
import pytest

from carelake.llm import queries

COLUMNS = {
    "op1_": ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"],
    "op2_": ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"],
    "op4_": ["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"],
    "op5_": ["doc_id", "fingerprint", "component_id"],
    "op6_": ["page_id", "url", "text", "n_chars"],
    "op7_": ["doc_id", "n_words", "n_removed", "kept_sha256"],
    "op8_": ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"],
    "op11_": ["lang", "source", "part", "item", "value", "rank"],
    "op12_": ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"],
    "op13_": ["vec_id", "n_links", "component_id", "kept"],
    "op10_": ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"],
}


@pytest.mark.parametrize("name", sorted(queries.queries()))
def test_query(spark, sf, name):
    got = queries.queries()[name](spark, sf)
    want = next((c for p, c in COLUMNS.items() if name.startswith(p)), [])
    assert set(want) <= set(got.columns)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    a = got.toPandas()
    source = {"op2_": "pages", "op6_": "pages", "op13": "embeddings"}.get(name[:4], "documents")
    if not name.startswith(("op10_", "op11_", "op12_")):  # those have rows of other things
        assert len(a) >= spark.read.parquet(f"{sf}/{source}.parquet").count()
    if name in queries.oracle_sql():
        con = duckdb.connect()
        for t in ("documents", "benchmark", "pages", "conversations", "embeddings"):
            con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
        b = con.sql(queries.oracle_sql()[name]).df()
        cols = sorted(a.columns)
        assert cols == sorted(b.columns)
        key = [c for c in cols if c.endswith("_id")] + cols
        a, b = (x[cols].sort_values(list(dict.fromkeys(key))).reset_index(drop=True) for x in (a, b))
        pd.testing.assert_frame_equal(a, b, check_dtype=False)


def test_entry_registers_everything():
    import __spark_entry__ as entry

    names = set(entry.queries())
    assert {f"op{n}" for n in range(1, 14)} == {n.split("_")[0] for n in names if n.startswith("op")}
    assert "pipeline" in names
