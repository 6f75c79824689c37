"""Every catalog query that has a SQL counterpart, against DuckDB on the smallest tables."""

from __future__ import annotations

import pytest
from check_oracles import compare, connect
from conftest import SMALL

from ledgerloom.catalog import QUERIES
from ledgerloom.oracles import ORACLES

# Results that no SQL text describes: fitted models and their scores.
WITHOUT_SQL = {
    "cluster_profile", "cluster_job", "customer_segments", "demand_job", "cluster_selection", "customer_clusters", "demand_forecast",
    "demand_leaderboard", "feature_importance", "score_demand", "score_segment",
    "score_segment_stream",
}


@pytest.fixture(scope="module")
def duck():
    return connect(SMALL)


def test_every_query_has_a_counterpart():
    assert set(QUERIES) - set(ORACLES) == WITHOUT_SQL and set(ORACLES) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_matches_sql(spark, duck, name):
    assert compare(QUERIES[name](spark, SMALL), duck, ORACLES[name]) == ""


def test_entry_file(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).count() == 80
    assert set(entry.queries()) >= set(QUERIES) and set(entry.oracle_sql()) >= set(ORACLES)
