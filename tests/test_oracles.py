"""Every registered query against its SQL on the same tables, value for value."""

from __future__ import annotations

from collections import Counter
from datetime import date, datetime
from pathlib import Path

import duckdb
import pytest

from clickmart.plans.oracles import ORACLES
from clickmart.plans.queries import QUERIES


@pytest.fixture(scope="module")
def duck(sf_dir):
    connection = duckdb.connect()
    for path in Path(sf_dir).glob("*.parquet"):
        connection.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return connection


def canonical(value):
    if isinstance(value, date) and not isinstance(value, datetime):
        return datetime(value.year, value.month, value.day)
    return round(value, 9) if isinstance(value, float) else value


def rows(records, names):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return Counter(tuple(canonical(record[i]) for i in order) for record in records)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)


SPARK_TYPES = {
    "bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "double": "DOUBLE",
    "boolean": "BOOLEAN", "date": "DATE", "timestamp_ntz": "TIMESTAMP",
}


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_sql(spark, duck, sf_dir, name):
    frame = QUERIES[name](spark, sf_dir)
    expected = duck.execute(ORACLES[name])
    types = {column[0]: str(column[1]) for column in expected.description}
    expected_rows = expected.fetchall()
    assert sorted(frame.columns) == sorted(types)
    assert {c: SPARK_TYPES[t] for c, t in frame.dtypes} == types
    got, want = rows(frame.collect(), frame.columns), rows(expected_rows, list(types))
    assert sum(want.values()) > 0
    assert got == want
