"""Every registered corpus query that SQL can express, against DuckDB."""

import pytest

from mise.llm.queries import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("key", sorted(ORACLES))
def test_query_matches_sql(spark, key):
    from tools.oracle_check import duck, rows_of
    got = rows_of(QUERIES[key](spark, SF).toPandas())
    assert got == rows_of(duck(SF).execute(ORACLES[key]).fetchdf())
