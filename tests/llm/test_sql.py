"""Queries that SQL can express, next to DuckDB on the smallest tables."""

from __future__ import annotations

import pytest
from check_oracles import compare, connect
from conftest import SMALL

from ledgerloom.llm.queries import ORACLES, QUERIES

WITHOUT_SQL = {"op1_token_store", "op5_bpe", "op6_toxicity", "op8_quality", "op9_simhash", "pipeline"}


def test_every_operator_is_registered():
    import __spark_entry__ as entry

    assert set(QUERIES) - set(ORACLES) == WITHOUT_SQL
    assert {n.split("_")[0] for n in QUERIES} == {*(f"op{i}" for i in range(1, 14)), "pipeline"}
    assert set(QUERIES) <= set(entry.queries()) and set(ORACLES) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_matches_sql(spark, name):
    assert compare(QUERIES[name](spark, SMALL), connect(SMALL), ORACLES[name]) == ""
