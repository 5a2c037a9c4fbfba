"""Every registered query against its DuckDB oracle (sf0.001), and every
query without one runs and returns rows."""

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from conftest import SF_SMALL
from oracle_check import check

# trained stages are exercised in test_models; streaming in test_streaming
SLOW = {"als_embeddings", "content_embeddings", "embed_all", "rank_mlp", "rank_wide",
        "recommend", "diversify_topk"}


def test_every_oracle_key_is_a_query():
    assert set(oracle_sql()) <= set(queries())


@pytest.mark.parametrize("key", sorted(oracle_sql()))
def test_matches_duckdb(spark, key):
    res = check(spark, SF_SMALL, [key], verbose=False)[key]
    assert res[0] == "OK", res


@pytest.mark.parametrize("key", sorted(set(queries()) - set(oracle_sql()) - SLOW))
def test_rows_only_queries_run(spark, key):
    assert queries()[key](spark, SF_SMALL).count() > 0


def test_entry(spark):
    df = entry(spark)
    assert df.columns == ["user_id", "rank", "post_id", "probability", "score"]
    assert df.count() > 0


def test_entry_module_loads_by_path(tmp_path, monkeypatch):
    import importlib.util
    import os
    import sys
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    monkeypatch.chdir(tmp_path)
    monkeypatch.setattr(sys, "path", [p for p in sys.path if os.path.abspath(p or ".") != root])
    spec = importlib.util.spec_from_file_location("entry_by_path", os.path.join(root, "__spark_entry__.py"))
    mod = importlib.util.module_from_spec(spec)
    spec.loader.exec_module(mod)
    assert set(mod.oracle_sql()) <= set(mod.queries())
