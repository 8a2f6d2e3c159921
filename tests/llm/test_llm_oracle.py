"""The corpus queries that SQL can express, against DuckDB at the smallest scale."""

import pytest

from coursemart.llm.queries import ORACLES, QUERIES
from verification.compare import canonical, database

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, name):
    frame = QUERIES[name](spark, SF)
    result = database(SF).execute(ORACLES[name])
    columns = [d[0] for d in result.description]
    assert canonical(frame.columns, frame.collect()) == canonical(columns, result.fetchall())
