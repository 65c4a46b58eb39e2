"""The training-data queries that SQL can express, against their SQL in DuckDB, whole tables."""

import pytest

from scenetext.llm.queries import ORACLE, QUERIES
from tests.oracle import _rows, database


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_sql(spark, sf_dir, name):
    df = QUERIES[name](spark, sf_dir)
    result = database(sf_dir).execute(ORACLE[name])
    columns = [d[0] for d in result.description]
    wanted = result.fetchall()
    assert sorted(df.columns) == sorted(columns)
    assert _rows(df.columns, [tuple(r) for r in df.collect()]) == _rows(columns, wanted)
