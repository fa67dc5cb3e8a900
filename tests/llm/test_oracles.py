"""The queries that SQL can express, against DuckDB."""

import pytest
from compare import compare, duck

from watchpath.llm.queries import oracle_sql, queries

SMALL = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(oracle_sql()))
def test_query_matches_oracle(spark, name):
    ok, message = compare(queries()[name](spark, SMALL), duck(SMALL), oracle_sql()[name])
    assert ok, message


def test_thirteen_operators_and_the_pipeline():
    assert sorted(n.split("_")[0] for n in queries()) == sorted([*(f"op{i}" for i in range(1, 14)), "pipeline"])
