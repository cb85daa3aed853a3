"""The driver contract of __spark_entry__.py."""

import inspect
import re

import __spark_entry__ as entry


OTHERS = r"op\d+_|pipeline$"  # the training-data queries have tests of their own


def test_every_oracle_has_a_query_and_every_query_has_an_oracle():
    qs, sqls = entry.queries(), entry.oracle_sql()
    assert set(sqls) <= set(qs)
    assert {n for n in qs if not re.match(OTHERS, n)} <= set(sqls)  # none relies on the weaker rows-only check


def test_query_callables_take_spark_and_folder():
    for name, fn in entry.queries().items():
        assert len(inspect.signature(fn).parameters) == 2, name


def test_query_names():
    for name in entry.queries():
        assert re.match(OTHERS, name) or re.fullmatch(r"[a-z]\d{1,2}(_[a-z]\d{2})?_[a-z0-9_]+", name), name


def test_oracle_sql_reads_only_the_driver_views():
    driver = {"region", "nation", "customer", "supplier", "part", "orders"}
    for name, sql in entry.oracle_sql().items():
        assert "read_parquet" not in sql and "/root/" not in sql, name
        assert re.match(OTHERS, name) or any(re.search(rf"\bFROM {t}\b", sql) for t in driver), name
