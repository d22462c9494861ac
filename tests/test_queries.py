"""Every registered query against its SQL on DuckDB, at the smallest scale."""

from __future__ import annotations

import os

import pytest

import check_oracle
from __spark_entry__ import entry, oracle_sql, queries
from freightlens.plans import all_queries

SF_DIR = os.environ.get("FREIGHTLENS_TEST_DATA", "/root/testdata/sf0.001")

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="test tables absent")


@pytest.fixture(scope="module")
def con():
    return check_oracle.connect(SF_DIR)


def test_entry(spark):
    row = entry(spark).collect()
    assert len(row) == 1 and row[0].delivered_last_30 > 0


def test_every_star_query_has_an_oracle():
    assert set(all_queries()[0]) == set(all_queries()[1])
    assert set(oracle_sql()) <= set(queries())


def test_no_plan_compares_all_pairs(spark):
    for name, query in all_queries()[0].items():
        if not name.startswith(("refresh", "load_model", "stream", "publish", "read_", "write_")):
            plan = query(spark, SF_DIR)._jdf.queryExecution().executedPlan().toString()
            assert "NestedLoop" not in plan and "CartesianProduct" not in plan, name


@pytest.mark.parametrize("name", sorted(oracle_sql()))
def test_query(spark, con, name):
    assert check_oracle.compare(spark, con, SF_DIR, name, oracle_sql()[name]) is None
