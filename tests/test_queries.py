"""Every registered query: equal to its SQL, and with a plan that scales."""

import re

import pytest
from compare import connect, difference
from conftest import SF_SMALL

import __spark_entry__ as entry_points
from foliospark.catalog.oracles import ORACLES
from foliospark.catalog.queries import QUERIES


@pytest.fixture(scope="module")
def con():
    return connect(SF_SMALL)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(entry_points.queries())
    assert set(ORACLES) <= set(entry_points.oracle_sql())


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, con, name):
    df = QUERIES[name](spark, SF_SMALL)
    assert difference(df, con, ORACLES[name]) is None
    plan = df._jdf.queryExecution().executedPlan().toString()
    # no Python workers, no all-pairs joins, no task that sees all rows
    if name != "classify_large_rule_set":  # one automaton of all keywords
        assert not re.search(r"Python|Pandas|Arrow", plan)
    assert not re.search(r"CartesianProduct|BroadcastNestedLoop", plan)
    if name not in ("duplicate_alert_rows", "max_docs_limit", "first_documents_ingested", "files_by_bytes"):  # windows within key ranges
        assert "Window" not in plan


def test_entry(spark):
    df = entry_points.entry(spark)
    assert df.columns == ["vendor_name", "net_spend", "doc_count"] and df.count() > 0
