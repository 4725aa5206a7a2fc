"""Registered queries against their independent DuckDB SQL twins (sf0.001).

The driver runs the full set at sf0.01; here every query with a SQL twin is
checked on the smallest scale, and the rows-only ones must run.
"""

import pytest

from textflow.checks.compare import compare
from textflow.plans.lineage import drop_stage_tables

from __spark_entry__ import oracle_sql, queries

SMALL = "/root/testdata/sf0.001"
# driver loops of a minute or more: checked at sf0.01 only
SLOW = {"param_search", "training_curves", "linear_svm_tfidf"}
WITH_SQL = sorted(set(oracle_sql()) - SLOW)
ROWS_ONLY = sorted(set(queries()) - set(oracle_sql()))


def test_every_query_has_a_name_and_sql_is_subset():
    assert set(oracle_sql()) <= set(queries())


@pytest.mark.parametrize("name", WITH_SQL)
def test_query_matches_sql(spark, duck_small, name):
    out = compare(spark, name, SMALL, duck_small)
    drop_stage_tables(spark)
    assert out["match"], out


@pytest.mark.parametrize("name", ROWS_ONLY)
def test_rows_only_query_runs(spark, name):
    df = queries()[name](spark, SMALL)
    assert df.count() > 0
    drop_stage_tables(spark)


def test_entry_smoke(spark):
    from __spark_entry__ import entry
    df = entry(spark)
    rows = df.collect()
    assert len(rows) > 0
    assert df.columns == ["class", "precision", "recall", "f1", "support"]
