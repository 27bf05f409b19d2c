"""Text queries next to their DuckDB text on a small table."""

import duckdb
import pytest
from check import rows_of
from conftest import SMALL

from tradeledger.llm.checks import CHECKS
from tradeledger.llm.queries import QUERIES


@pytest.mark.parametrize("key", sorted(CHECKS))
def test_query_equals_check(spark, key):
    con = duckdb.connect()
    for name in ("documents", "benchmark", "pages", "labels"):
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{SMALL}/{name}.parquet')")
    frame = QUERIES[key](spark, SMALL)
    result = con.execute(CHECKS[key])
    names = [c[0] for c in result.description]
    assert sorted(names) == sorted(frame.columns)
    found = rows_of(frame.columns, [tuple(r) for r in frame.collect()])
    assert found == rows_of(names, result.fetchall()) and found
