import re

import __spark_entry__ as entry_mod

from conftest import SF0001


def _training(key):
    return key == "pipeline" or re.match(r"op\d+_", key)


def test_queries_and_oracle_keys_line_up():
    qs, sql = entry_mod.queries(), entry_mod.oracle_sql()
    assert set(sql) <= set(qs)
    # every library query has an oracle; some training-data ones have no SQL form
    assert {k for k in qs if not _training(k)} == {k for k in sql if not _training(k)}


def test_entry_runs(spark):
    df = entry_mod.entry(spark)
    assert df.columns == ["genre", "title", "loan_count", "genre_rank"]
    assert df.count() > 0


def test_every_query_builds_lazily(spark):
    for key, fn in entry_mod.queries().items():
        if _training(key):  # these write intermediate tables; tests/llm runs them
            continue
        df = fn(spark, SF0001)
        assert df.columns, key
