"""Registered queries against their SQL, and the plans Spark makes for them."""

import pytest
from oracle import compare, connect

from panelweave.workload import QUERIES, SQL

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


def test_every_query_has_sql():
    assert set(SQL) == set(QUERIES)


@pytest.mark.parametrize("name", QUERIES)
def test_query_equals_sql(spark, con, name):
    assert compare(spark, con, SF_DIR, QUERIES[name], SQL[name]) is None


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_only_wanted_columns_are_scanned(spark):
    text = plan(QUERIES["load_pruned"](spark, SF_DIR))
    assert "l_orderkey" in text and "l_quantity" in text
    assert not any(c in text for c in ("l_shipdate", "l_extendedprice", "l_discount", "l_returnflag"))


def test_filters_reach_the_scan(spark):
    assert "PushedFilters: [IsNotNull(n_regionkey), LessThan(n_regionkey,4)]" in plan(
        QUERIES["left_join_lookup"](spark, SF_DIR)
    )


@pytest.mark.parametrize("name", ["count_by_sweep", "ever_in_window", "panel_wide", "first_per_group", "bcs70_marstat"])
def test_no_python_no_cross_join(spark, name):
    text = plan(QUERIES[name](spark, SF_DIR))
    assert not any(node in text for node in ("Python", "InPandas", "CartesianProduct", "NestedLoop"))


def test_counts_are_combined_before_the_shuffle(spark):
    assert "partial_count" in plan(QUERIES["count_by_sweep"](spark, SF_DIR))
    assert "partial_bit_or" in plan(QUERIES["ever_in_window"](spark, SF_DIR))
