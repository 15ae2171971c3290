"""Every dealt query that has SQL equals it."""

import os

import duckdb
import pytest

from roadcast.llm.oracle import ORACLE
from roadcast.llm.queries import QUERIES

SF_DIR = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_sql(spark, name):
    duck = duckdb.connect()
    for file in os.listdir(SF_DIR):
        duck.execute(f"CREATE VIEW {file.removesuffix('.parquet')} AS SELECT * FROM '{SF_DIR}/{file}'")
    result = duck.execute(ORACLE[name])
    names = [d[0] for d in result.description]
    frame = QUERIES[name](spark, SF_DIR)
    assert sorted(frame.columns) == sorted(names)
    order = lambda row: tuple((v is not None, v) for v in row)
    expected = sorted(map(tuple, result.fetchall()), key=order)
    assert sorted(map(tuple, frame.select(*names).collect()), key=order) == expected
    assert expected
