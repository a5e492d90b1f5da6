"""Every registered query against its SQL oracle on the smallest supplied tables."""

from __future__ import annotations

from pathlib import Path

import duckdb
import pytest

from contract.adapters import BASE_TABLES
from contract.queries import CHECKS

SMALL = "/root/testdata/sf0.001"
TYPES = {"bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "boolean": "BOOLEAN"}

pytestmark = pytest.mark.skipif(not Path(SMALL).exists(), reason="supplied tables are not here")


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for table in BASE_TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SMALL}/{table}.parquet'")
    return connection


@pytest.mark.parametrize("name", sorted(CHECKS))
def test_query_equals_oracle(spark, duck, name):
    check = CHECKS[name]
    df = check.run(spark, SMALL)
    columns = sorted(df.columns)
    result = duck.execute(check.sql)
    oracle = {d[0]: (i, str(d[1])) for i, d in enumerate(result.description)}
    assert sorted(oracle) == columns
    assert {c: TYPES[t] for c, t in df.dtypes} == {c: oracle[c][1] for c in columns}
    expected = sorted((tuple(row[oracle[c][0]] for c in columns) for row in result.fetchall()), key=repr)
    assert sorted((tuple(r[c] for c in columns) for r in df.collect()), key=repr) == expected
    assert expected, "the query should find rows"
